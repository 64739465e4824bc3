"""Operators 11, 12 and 13 against plain Python, on odd rows and small blocks."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import manifest, prefix_trie, sampling

CONV = "conv_id long, turn long, role string, text string, extra string"


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


# 11 -----------------------------------------------------------------------------

def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    for v in convs.values():
        v.sort(key=lambda x: x[:2])
    own = {c: [x[2:] for x in v] for c, v in convs.items()}
    path = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        path[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, p in path.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1].encode()) if k else 0)
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                   sha(",".join(str(c) for c in sorted(m) if len(path[c]) == len(k)))) for k, m in members.items())


def trie_rows(df):
    return sorted((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in df.collect())


def odd_conversations(seed, n=120, longest=9):
    rng = random.Random(seed)
    words = ["", "a", "é", "the same", "x" * 50]
    rows = []
    for c in [*range(-7, n), 2**40, 2**40 + 1]:
        k = rng.choice([1, 2, 3, rng.randint(1, longest)])
        for t in range(k):
            rows.append((c, None if t == 0 and c % 4 == 0 else t, rng.choice(["user", "bot", None]), rng.choice([*words, None]) if c % 3 else "one", "z"))
    rows += [(c, t, "user", "hot", "z") for c in range(500, 560) for t in range(4)]  # copies
    rows += [(None, 1, "user", "lost", "z")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment,shard_rows", [(256, 1 << 16), (3, 4)])
def test_trie_equals_brute_force(spark, segment, shard_rows):
    rows = odd_conversations(segment)
    df = spark.createDataFrame(rows, CONV)
    assert trie_rows(prefix_trie.conversation_trie(df, segment, shard_rows)) == brute_trie(rows)


def test_trie_of_one_long_conversation(spark):
    rows = [(5, t, "user", f"turn {t % 7}", "") for t in range(700)] + [(6, t, "user", f"turn {t % 7}", "") for t in range(300)]
    assert trie_rows(prefix_trie.conversation_trie(spark.createDataFrame(rows, CONV), 256, 4)) == brute_trie(rows)


def test_trie_of_empty_table_and_lone_root(spark):
    assert trie_rows(prefix_trie.conversation_trie(spark.createDataFrame([], CONV))) == []
    lone = next(c for c in range(1, 5000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)  # no base: no turns are left
    rows = [(lone, 0, "user", "gone", "")]
    assert trie_rows(prefix_trie.conversation_trie(spark.createDataFrame(rows, CONV))) == brute_trie(rows) == [(lone, 0, None, 1, 0, 1, 0, sha(str(lone)))]


# 12 -----------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, g string, pos long"


def brute_manifest(rows):
    """rows: doc_id, text, lang, source, n_chars."""
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    def tree(leaves):
        """Root and the (left, right) siblings of each leaf on its way."""
        level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
        while len(level) > 1:
            for k, i in enumerate(at):
                run = i // 8 * 8
                paths[k].append(("".join(level[run:i]), "".join(level[i + 1:run + 8])))
            level = [sha("".join(level[k:k + 8])) for k in range(0, len(level), 8)]
            at = [i // 8 for i in at]
        return level[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for g in order}
    trees = {g: tree([leaf(r, r[1]) for r in subs[g]]) for g in order}
    root, over = tree([trees[g][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for r, path in zip(subs[g], trees[g][1]):
            mine = leaf(r, r[1])
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = text.translate({k: k + 32 for k in range(65, 91)})
            value = leaf(r, text)
            for left, right in path + over[k]:
                value = sha(left + value + right)
            out.append((str(r[0]), mine, trees[g][0], root, sha("".join(a + b for a, b in path + over[k])), value))
    return sorted(out)


def run_manifest(spark, rows, levels):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS)
    text = F.col("text")
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, manifest.lower_ascii(text)).otherwise(text)
    found = manifest.manifest(df, tampered={"text": altered}, levels=levels).collect()
    return sorted((str(r["id"]), r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in found)


@pytest.mark.parametrize("levels", [1, 4])
def test_manifest_equals_brute_force(spark, levels):
    rng = random.Random(levels)
    rows = [(i, rng.choice(["", None, "Abc É", "lower", "X" * 3000]), rng.choice(["en"] * 30 + [None, "", "é", "zh", "a"]), rng.choice(["s", None]), rng.choice([None, 7])) for i in range(700)]
    rows += [(None, "No id", "en", "s", 1)] * 3 + [(9, "Twice", "en", "s", 1)] * 4
    rows += [(10_000 + i, "Alone", f"l{i}", "s", 1) for i in range(9)]
    rng.shuffle(rows)
    found = run_manifest(spark, rows, levels)
    assert found == brute_manifest(rows)
    assert 0 < sum(r[5] != r[3] for r in found) < len(found)


@pytest.mark.parametrize("n", [0, 9, 73])
def test_manifest_of_round_sizes(spark, n):
    rows = [(i, "Text", "en", None, 4) for i in range(n)]
    assert run_manifest(spark, rows, 1) == (brute_manifest(rows) if n else [])


# 13 -----------------------------------------------------------------------------

def exact(a: str, b: str) -> float:
    x, y = (Counter(t.lower().split()) for t in (a, b))
    return sum((x & y).values()) / sum((x | y).values())


def test_samples_follow_generalised_jaccard():
    """The mean collision rate of many pairs of weighted sets is their similarity."""
    rng = random.Random(3)
    errors = []
    sampler = sampling.Sampler()
    for k in range(150):
        words = [f"w{k}x{i}" for i in range(rng.randint(2, 40))]
        a = " ".join(w for w in words for _ in range(rng.randint(0, 6))) or "a"
        b = " ".join(w for w in words for _ in range(rng.randint(0, 6))) or "b"
        errors.append(sampling.likeness(*sampler.fingerprints([a.encode(), b.encode()])) - exact(a, b))
    assert abs(np.mean(errors)) < 0.015  # 150 x 64 samples: the standard error is 0.005
    assert np.std(errors) < 0.09  # 64 samples: 0.0625 at most


def test_draws_have_their_distributions():
    r, c, b = sampling.draws(np.arange(1, 4001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for x in (r, np.exp(c)):  # gamma of shape 2: mean 2, variance 2
        assert abs(x.mean() - 2) < 0.02 and abs(x.var() - 2) < 0.06
    assert abs(b.mean() - 0.5) < 0.01 and b.min() >= 0 and b.max() < 1


def test_fingerprints_do_not_depend_on_the_group():
    texts = [f"the {i % 5} cat sat on the {i} mat".encode() for i in range(40)]
    alone = [sampling.Sampler().fingerprints([t])[0] for t in texts]
    together = sampling.Sampler()
    assert together.fingerprints(texts) == alone == together.fingerprints(texts)


def test_fingerprint_documents(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "Beta", "é", "delta", f"w{rng.randint(0, 999)}"]) for _ in range(rng.randint(0, 200))) for _ in range(150)]
    rows = [(i * 7, t) for i, t in enumerate(texts)] + [(7, None), (14, texts[2]), (14, texts[2]), (None, "no id"), (3000, "word " * 40_000), (3001, " \n ")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, part string, edge int")
    found = sampling.fingerprint_documents(df).collect()
    assert len(found) == len(rows)
    by_id = defaultdict(list)
    for i, t in rows:
        by_id[i].append(t or "")
    unique = sorted(i for i in by_id if i is not None and len(by_id[i]) == 1)
    order = sorted(by_id, key=lambda i: (i is not None, i or 0))
    at = {i: k for k, i in enumerate(order)}
    for r in found:
        i = r["doc_id"]
        after = order[(at[i] + 1) % len(order)] if i in at else None
        if i not in unique or len(by_id[after]) > 1:
            continue
        text, following = by_id[i][0], by_id[after][0]
        half = math.floor(len(text) / 2)
        changed = text[:len(text) - half] + following[:half]
        own, changed_print, next_print = sampling.Sampler().fingerprints([text.encode(), changed.encode(), following.encode()])
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), sha(changed), own.hex(), changed_print.hex())
        assert (r["near_edited"], r["near_next"]) == (sampling.likeness(own, changed_print), sampling.likeness(own, next_print))
    same = {r["fingerprint"] for r in found if r["doc_id"] == 14}
    assert len(same) == 1
    assert sampling.fingerprint_documents(df.limit(0)).count() == 0
    one = sampling.fingerprint_documents(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == sha("a b a b")


# 3, 1 and the pipeline -----------------------------------------------------------

def test_joined_chunks_encode_as_alone():
    from tokenizers import Tokenizer

    from reviewlens.llm import packing
    from reviewlens.llm.queries import TOKENIZER

    t = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(11)
    odd = ["e\u0301", "\u0301x", "\u00a0", "a\u00a0b", "\u2028", "\x1c", "it's", "ΑΣ", "İ", "ß", "<|endoftext|>", "a<|startoftext|>b", "\ufffd", "\u200b", "한국", "😀👍🏽", "Ǆ", "\x00"]
    chunks = [rng.choice([*odd, "".join(rng.choice("abcé'1.,#") for _ in range(rng.randint(1, 30)))]).encode() for _ in range(3000)]
    alone = [np.array(t.encode(c.decode(), add_special_tokens=False).ids, np.uint32).tobytes() for c in chunks]
    assert packing.encode_joined(lambda s: t.encode(s, add_special_tokens=False), chunks) == alone


def test_candidates_grow_with_a_group(spark, monkeypatch):
    """Of a group of near copies, pairs that are no links go to verification in proportion to the group."""
    from fractions import Fraction

    from reviewlens.llm import ngram_join

    rng, sizes = random.Random(1), {}
    words = [f"w{i}" for i in range(5000)]
    save = ngram_join.save
    for n in (40, 160):
        seen = sizes[n] = Counter()

        def counted(df, name, seen=seen):
            out = save(df, name)
            if name in ("ngram-stars", "ngram-turn-likely", "ngram-second"):
                seen[name] += out.count()
            return out

        monkeypatch.setattr(ngram_join, "save", counted)
        base = [rng.choice(words) for _ in range(400)]
        rows = []
        for i in range(n):
            text = list(base)
            for _ in range(rng.randint(3, 8)):
                text[rng.randrange(400)] = rng.choice(words)
            rows.append((i, " ".join(text)))
        found = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 3, Fraction(9, 10)).collect()
        sets = [{tuple(t.split()[k:k + 3]) for k in range(398)} for _, t in rows]
        label = list(range(n))
        for i in range(n):
            for j in range(i):
                if label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                    a, b = sorted((label[i], label[j]))
                    label = [a if x == b else x for x in label]
        assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(label))
    assert sum(sizes[160].values()) < 8 * sum(sizes[40].values())


def test_near_dedup_keeps_other_texts_of_a_dropped_id(spark):
    import corpus_pipeline

    rng = random.Random(2)
    words = [f"v{i}" for i in range(3000)]
    text = [rng.choice(words) for _ in range(200)]
    near = [*text[:100], "other", *text[101:]]
    rows = [(1, " ".join(text)), (5, " ".join(near)), (5, "an unrelated text with the id of a near copy"), (None, " ".join(near)), (1, " ".join(text))]
    df = spark.createDataFrame([(i, t, "en", "s", len(t), 7, 8) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, text_hash long, node long")
    out = corpus_pipeline.near_dedup(spark, df, "")
    assert out.columns == df.columns
    kept = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert kept == Counter([rows[0], rows[4], rows[2], rows[3]])
