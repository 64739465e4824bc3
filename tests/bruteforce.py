"""Plain-Python, one-document-at-a-time versions of the classifiers.

Written directly from the semantics (sequential loops, dictionaries) to check
the Spark operators on small inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import regex

STOP = set("a an and are as at be but by for if in into is it no not of on or such that the "
           "their then there these they this to was will with".split())


def java_blank(w: str) -> bool:
    return all(ord(c) <= 0x20 for c in w)


def bayes(train, test):
    """train: [(doc_id, text, label)], test: [(doc_id, text)] -> {doc_id: 0|1}"""
    dfp, dfn = Counter(), Counter()
    npos = sum(1 for _, _, l in train if l == "pos")
    nneg = len(train) - npos
    vocab = set()
    for _, text, label in train:
        ws = {w for w in text.split(" ") if not java_blank(w)}
        vocab |= ws
        (dfp if label == "pos" else dfn).update(ws)
    out = {}
    for did, text in test:
        sp = sn = 0.0
        for w in text.split(" "):
            if w in vocab:
                sp += math.log(max(dfp[w], 1) / npos)
                sn += math.log(max(dfn[w], 1) / nneg)
        out[did] = int(round(sp - sn, 6) > 0)
    return out


_SYM = regex.compile(r"[^\p{L}\p{N}]+")


def _clean(text):
    return [c for c in (_SYM.sub("", w) for w in text.split(" ")) if c]


def centroid(train, test, tie="neg"):
    cf = {"pos": Counter(), "neg": Counter()}
    n = Counter(l for _, _, l in train)
    for _, text, label in train:
        cf[label].update(_clean(text))
    vocab = set(cf["pos"]) | set(cf["neg"])
    mean = {"pos": defaultdict(float), "neg": defaultdict(float)}
    for _, text, label in train:
        L = len(text.rstrip(" ").split(" "))  # trailing empty pieces dropped
        for t, f in Counter(_clean(text)).items():
            mean[label][t] += (f / L) * math.log10(cf[label][t] / f) / n[label]
    out = {}
    for did, text in test:
        toks = [t for t in _clean(text) if t in vocab]
        T = len(toks)
        sims = {}
        for c in ("pos", "neg"):
            num = den = 0.0
            for t, f in Counter(toks).items():
                if cf["pos"][t] > 0 and cf["neg"][t] > 0:
                    x = (f / T) * math.log10(cf[c][t] / f)
                else:
                    x = 0.0
                m = mean[c][t]
                num += min(x, m)
                den += max(x, m)
            sims[c] = None if den == 0 else num / den
        if sims["pos"] is None or sims["neg"] is None:
            out[did] = 0
        else:
            d = round(sims["pos"] - sims["neg"], 9)
            out[did] = int(d > 0 if tie == "neg" else d >= 0)
    return out


_RUN = regex.compile(r"[\p{L}\p{N}]+")


def knn_hits(train, test, k):
    """-> {qid: [(doc_id, is_pos, score)] best first}"""
    post = {}
    df = Counter()
    for did, text, label in train:
        terms = [t for t in _RUN.findall(text.lower()) if t not in STOP]
        post[did] = (Counter(terms), len(terms), label == "pos")
        df.update(set(terms))
    N = len(train)
    out = {}
    for qid, text in test:
        qtext = re.sub(r"[^a-zA-Z ]+", "", text.lower())
        q = Counter(t for t in _RUN.findall(qtext) if t not in STOP)
        scores = []
        for did, (tf, ln, ip) in post.items():
            s = 0.0
            hit = False
            for t, qtf in q.items():
                if tf[t]:
                    idf = 1.0 + math.log((N + 1) / (df[t] + 1))
                    s += qtf * (idf * idf * math.sqrt(tf[t]) / math.sqrt(ln))
                    hit = True
            if hit:
                scores.append((round(s, 9), did, ip))
        scores.sort(key=lambda x: (-x[0], x[1]))
        out[qid] = [(d, ip, s) for s, d, ip in scores[:k]]
    return out


def knn_rules(hits, k, pol):
    pos = sum(1 for _, ip, _ in hits[:k] if ip)
    cos = sum((s if ip else -s) for _, ip, s in hits[:k])
    knn = 2 * pos / k - 1
    maj = int(round(knn, 9) > 0)
    sen = 0 if pol is None else int(round(0.2 * pol + 0.8 * knn, 9) > 0)
    return maj, sen, int(round(cos, 9) > 0)


def negation_fold(tokens, tags, negators=("no", "not")):
    """Sequential negation flag for each content token: [(idx, negated)]."""
    flag = False
    out = []
    for i, (tok, tag) in enumerate(zip(tokens, tags)):
        if re.match(r"^(JJ|RB|NN|V)", tag):
            out.append((i, flag))
        elif tok in negators:
            flag = True
        else:
            flag = False
    return out
