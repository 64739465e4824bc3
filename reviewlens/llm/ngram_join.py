"""Operator 1: n-gram Jaccard join with token-combination prefixes.

A text's set are the distinct hashes (64 bits) of its word n-grams; texts with
the same set are one node.  Two sets of Jaccard similarity t share all but a
few of the first tokens of any global order.  Here rare tokens come first, in
order of their hashes, then frequent ones.  A set of n tokens may lack
floor((1 - t) n) tokens of a partner, so its prefix is extended until the
signatures in it cannot all be lost with that many tokens: each rare token is a
signature; frequent tokens are split into subclasses by their hashes, and every
pair of a subclass's prefix tokens is a signature (p tokens bear p - 1 losses).
Subclasses depend on the size of the set (its power of two; a set that may have
a partner in the next one up has signatures of both).  So linked sets share a
signature.

Frequent tokens: those whose counts, summed over batches in which a token makes
1 in ``SLOTS`` of the batch's tokens, reach 1 in ``SLOTS`` of all tokens; at
most ``SLOTS`` of them, sent to all tasks.  Which they are does not change the
result, only its cost.

Pairs are verified in rounds, so that a group of similar texts is not
expanded into all its pairs:
 1. each signature's nodes against the first of them (a star), then components;
 2. again stars, in signatures whose nodes are in several components: a node of
    the largest one, that which has the most such signatures, against the nodes of
    the others; in later rounds other leads.  A signature of many nodes has several leads
    of its own: a group of near copies shares many signatures, so each of its nodes
    meets as many different leads.  They go on while components merge;
 3. of signatures whose nodes still are in several components, all pairs of nodes
    of different components, compared by longer sketches.  Similar texts share many
    signatures and would be compared in each: of signatures with the same nodes one
    is left, and none whose nodes are all in another one that they have in common
    among their largest.
A pair goes to verification only if its sizes and the parity sketches of its
sets allow the similarity (the sketches' different bits are at most the sets'
different tokens, so no link is lost); verification intersects the sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import checked_broadcast, look_up, save
from reviewlens.llm.words import as_bytes, groups, lean, mix, shingles, slices

SLOTS = 1 << 22
#: 64-bit words of a set's parity sketch
SKETCH = 32
#: sets of more tokens have a longer sketch too
LONG = 64 * SKETCH
#: sketch words of postings by grade of their sets' sizes: the fewest whose random halves still exceed the bits that linked sets may differ in
GRADES = (16, SKETCH, SKETCH)
#: words to which the longer sketches of the last grade are folded there (its sets all have one of as many or more)
FOLDED = 128
#: rounds of stars after the first, and the share of the nodes in mixed signatures that have to change their component for another
STAR_ROUNDS, STAR_GAIN = 1, 0.02
#: signatures of more nodes have so many leads of their own
MANY_NODES, LEADS = 32, 4
#: so many of a node's largest signatures are tried for one that holds all nodes of a smaller one
LARGEST = 4
_PAIR_TOKENS = 4  # frequent prefix tokens that a subclass has on average
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def frequent_tokens(texts: DataFrame, width: int, slots: int = SLOTS) -> np.ndarray:
    """The frequent tokens, sorted (texts: one column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for part in slices([batch]) for g in groups(as_bytes(part.column(0))) for s in sets_of(g, width)]
            tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            del sets
            tokens.sort()
            total = len(tokens)
            first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if total else np.zeros(0, np.int64)
            n = np.diff(first, append=total)
            tokens = tokens[first]
            often = n >= max(2, total / slots)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(tokens[often].view(np.int64), 0)), pa.array(np.append(n[often], total).astype(np.int64)), pa.array(np.append(np.ones(often.sum(), bool), False))],
                                             ["token", "n", "is_token"])

    counts = save(texts.mapInArrow(lean(run), "token long, n long, is_token boolean").groupBy("is_token", "token").agg(F.sum("n").alias("n")), "ngram-frequent")
    total = counts.filter("not is_token").agg(F.sum("n")).first()[0] or 0
    chosen = counts.filter(F.col("is_token") & (F.col("n") >= max(16, total / slots))).select("token").toArrow()  # ``slots`` at most
    return np.sort(chosen["token"].to_numpy().view(np.uint64)) if chosen.num_rows else np.zeros(0, np.uint64)


def sets_of(g, width: int) -> Iterator[np.ndarray]:
    _, _, h, at = g.words(lower=True)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield shingles(h[a:b], width)


def _levels(n: int, keep: Fraction) -> set[int]:
    return {n.bit_length(), int(n / keep).bit_length()}


def signatures(tokens: np.ndarray, frequent: np.ndarray, similarity: Fraction) -> np.ndarray:
    """The distinct signatures of a set (sorted tokens).

    For a similarity of 3/4 or more the subclasses are few enough for a prefix
    within the set, but for a single frequent token; such a set has no partner.
    """
    n = len(tokens)
    lost = int(n * (1 - similarity))
    often = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens if len(frequent) else np.zeros(n, bool)
    rare, common = tokens[~often], tokens[often]
    single, need = rare[:lost + 1], lost + 1 - len(rare)
    out = []
    for level in _levels(n, similarity):
        salt = np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        out.append(mix(single ^ salt))
        if need > 0:
            classes = max(1, int((1 << level) * (1 - similarity)) // _PAIR_TOKENS)
            of = (mix(common) % np.uint64(classes)).astype(np.int64)
            bears = np.ones(len(common), np.int64)
            bears[np.unique(of, return_index=True)[1]] = 0  # a subclass's first token
            enough = np.flatnonzero(np.cumsum(bears) >= need)
            end = int(enough[0]) + 1 if len(enough) else len(common)
            by = np.argsort(of[:end], kind="stable")
            cls, tok = of[:end][by], common[:end][by]
            for gap in range(1, end):  # pairs of a subclass, by their distance in it
                same = cls[gap:] == cls[:-gap]
                if not same.any():
                    break
                out.append(mix(mix(tok[:-gap][same] ^ salt) + tok[gap:][same]))
    return np.unique(np.concatenate(out))


def sketch(tokens: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """For each bit of ``words`` 64-bit words (a power of two) the parity of the tokens that fall on it.  The halves of
    a longer sketch, one XOR the other, are the sketch of half the words."""
    n = np.bincount((mix(tokens ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(n.astype(np.uint8), bitorder="little").view(np.int64)


def long_sketch(tokens: np.ndarray) -> np.ndarray | None:
    """A sketch of 2 bits a token or more, for sets that would fill a short one."""
    return sketch(tokens, 1 << (len(tokens) // 32).bit_length()) if len(tokens) > LONG else None


def node_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set (its tokens are mixed and added up, with its size)."""
    return int((mix(mix(tokens) + np.uint64(1)).sum(dtype=np.uint64) ^ mix(np.array([len(tokens)], np.uint64))[0]).astype(np.int64)) if len(tokens) else 0


def _threshold(a: str, b: str, similarity: Fraction) -> Column:
    """Whether sizes a and b allow the similarity."""
    p, q = similarity.numerator, similarity.denominator
    return (F.least(a, b) * q >= F.greatest(a, b) * p)


def describe(docs: DataFrame, frequent: np.ndarray, width: int, similarity: Fraction) -> DataFrame:
    """doc_id, text_hash, node (null for an empty set), n, sketch words s0.., signatures, long sketch (or null) of every row (saved)."""
    words = ", ".join(f"s{k} long" for k in range(SKETCH))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for g in groups(as_bytes(batch.column(1)), 1 << 22):
                sets = list(sets_of(g, width))
                sk = np.array([sketch(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(g.first, len(sets)), batch.column(2).slice(g.first, len(sets)), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     *(pa.array(sk[:, k]) for k in range(SKETCH)), pa.array([signatures(s, frequent, similarity).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets], pa.list_(pa.int64())),
                     pa.array([long_sketch(s) for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "node", "n", *(f"s{k}" for k in range(SKETCH)), "signatures", "long"])

    return save(docs.mapInArrow(lean(run), f"doc_id long, text_hash long, node long, n long, {words}, signatures array<long>, `long` array<long>"), "ngram-rows")


def possible(similarity: Fraction, a: str = "a_", b: str = "b_") -> Column:
    """Whether sizes and sketches of two nodes allow the similarity."""
    p, q = similarity.numerator, similarity.denominator
    differ = sum((F.bit_count(F.col(f"{a}s{k}").bitwiseXOR(F.col(f"{b}s{k}"))) for k in range(1, SKETCH)), F.bit_count(F.col(f"{a}s0").bitwiseXOR(F.col(f"{b}s0"))))
    # |x ^ y| <= (q - p) / (q + p) * (|x| + |y|) for a similarity of p / q
    return _threshold(a + "n", b + "n", similarity) & (differ * (q + p) <= (F.col(a + "n") + F.col(b + "n")) * (q - p))


def possible_folded(similarity: Fraction, a: str = "a_", b: str = "b_") -> Column:
    """Whether the folded longer sketches of two nodes, in the last grade, allow the similarity."""
    p, q = similarity.numerator, similarity.denominator
    differ = F.expr(f"aggregate(zip_with({a}long, {b}long, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
    return F.col(a + "long").isNull() | F.col(b + "long").isNull() | (differ * (q + p) <= (F.col(a + "n") + F.col(b + "n")) * (q - p))


def graded(rows: DataFrame, similarity: Fraction) -> DataFrame:
    """rows (n, s0.., and long, if they have it) with ``grade``; the sketch is folded to the words of the grade, the others
    are 0 (and take no room on disk).  The longer sketch is folded to ``FOLDED`` words in the last grade and null in others.

    A grade holds the sets up to a size, and those that may have a partner up to it, so these have a row in the next
    grade too: linked sets are in one grade together.
    """
    share = 2 * (1 - similarity) / (1 + similarity)
    most = [int(64 * w / (share * Fraction(12, 5))) for w in GRADES[:-1]]
    least = [0, *most]
    ends = [int(m / similarity) for m in most]
    in_grade = [(F.col("n") > lo) & (F.col("n") <= hi) for lo, hi in zip(least, ends)] + [F.col("n") > least[-1]]
    grades = F.filter(F.array(*[F.when(c, F.lit(g)) for g, c in enumerate(in_grade)]), lambda g: g.isNotNull())

    def word(k: int) -> Column:
        out = F.lit(0).cast("long")
        for g, w in enumerate(GRADES):
            if k < w:
                folded = F.col(f"s{k}")
                for j in range(k + w, SKETCH, w):
                    folded = folded.bitwiseXOR(F.col(f"s{j}"))
                out = F.when(F.col("grade") == g, folded).otherwise(out)
        return out

    names = [*(f"s{k}" for k in range(SKETCH)), "long"]
    rows = rows.withColumn("grade", F.explode(grades))
    long = F.expr(f"transform(sequence(0, {FOLDED - 1}), i -> aggregate(sequence(0, size(`long`) div {FOLDED} - 1), 0L, (x, j) -> x ^ `long`[i + {FOLDED} * cast(j as int)]))")
    long = F.when((F.col("grade") == len(GRADES) - 1) & (F.size("long") >= FOLDED), long).alias("long")
    return rows.select(*[F.col(c) for c in rows.columns if c not in names], *[word(k).alias(f"s{k}") for k in range(SKETCH)], *([long] if "long" in rows.columns else []))


def not_within(postings: DataFrame, most: int = LARGEST) -> DataFrame:
    """The postings (sig, node, size: nodes of sig; saved) without those of signatures whose nodes all have a larger one
    (or an equal one of smaller name) in common among the ``most`` largest of each: its pairs include theirs."""
    by_size = Window.partitionBy("node").orderBy(F.desc("size"), "sig")
    top = postings.withColumn("_rank", F.row_number().over(by_size)).filter(F.col("_rank") <= most).select("node", F.col("size").alias("top_size"), F.col("sig").alias("top"))
    larger = postings.join(top, "node").filter("top_size > size or (top_size = size and top < sig)")
    within = larger.groupBy("sig", "size", "top").agg(F.count(F.lit(1)).alias("n")).filter("n = size").select("sig").distinct()
    return postings.join(within, "sig", "left_anti")


def possible_long(pairs: DataFrame, nodes: DataFrame, similarity: Fraction) -> DataFrame:
    """Of the pairs (a, b; saved) those whose long sketches, where both have one, allow the similarity."""
    p, q = similarity.numerator, similarity.denominator
    has = nodes.filter("`long` is not null")
    pairs = pairs.join(has.select(F.col("node").alias("a"), F.col("n").alias("an"), F.col("long").alias("al")), "a", "left")
    pairs = pairs.join(has.select(F.col("node").alias("b"), F.col("n").alias("bn"), F.col("long").alias("bl")), "b", "left")
    # the sizes differ by a factor below 2, so the longer sketch is folded once at most
    folded = "if(size({0}) > size({1}), transform({1}, (x, i) -> {0}[i] ^ {0}[i + size({1})]), {0})"
    differ = F.expr(f"aggregate(zip_with({folded.format('al', 'bl')}, {folded.format('bl', 'al')}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
    return pairs.filter(F.col("al").isNull() | F.col("bl").isNull() | (differ * (q + p) <= (F.col("an") + F.col("bn")) * (q - p))).select("a", "b")


def verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, similarity: Fraction) -> DataFrame:
    """Of the pairs (a, b: nodes; saved) those that have the similarity; docs: doc_id, text; nodes: node, first_id."""
    involved = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    involved = checked_broadcast(save(involved.join(nodes.select("node", "first_id"), "node"), "ngram-involved"))
    texts = docs.join(involved, docs["doc_id"].eqNullSafe(involved["first_id"]), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for g in groups(as_bytes(batch.column(1)), 1 << 22):
                sets = [s.view(np.int64) for s in sets_of(g, width)]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s.view(np.uint64)) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "tokens"])

    sets = texts.select("doc_id", "text").mapInArrow(lean(run), "node long, tokens array<long>")
    sets = save(sets.join(involved, "node", "left_semi").dropDuplicates(["node"]), "ngram-sets")
    # a is a star's centre in many pairs: its pairs are dealt over as many salts as they need
    per = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select(F.col("a").alias("node"), F.ceil(F.col("n") / 256).alias("parts"))
    centre = sets.join(per, "node").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(F.col("node").alias("a"), "salt", F.col("tokens").alias("ta"))
    parts = per.select(F.col("node").alias("a"), "parts")
    salted = pairs.join(parts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")))
    both = salted.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b").join(centre, ["a", "salt"])
    shared = F.size(F.array_intersect("ta", "tb"))
    p, q = similarity.numerator, similarity.denominator
    both = both.withColumn("shared", shared).filter(F.col("shared") * q >= (F.size("ta") + F.size("tb") - F.col("shared")) * p)
    return save(both.select("a", "b"), "ngram-links")


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) of all nodes; saved.  Labels spread along links and jump to
    their labels' labels, so the rounds grow with the logarithm of a component's diameter."""
    ends = save(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = save(ends.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        spread = ends.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        new = labels.join(spread, "node").select("node", F.least("label", "near").alias("new"), "label")
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("jump"))
        new = save(new.join(jump, F.col("new") == F.col("_n"), "left").select("node", F.least("new", F.coalesce("jump", F.col("new"))).alias("label"), F.col("label").alias("was")), "labels")
        labels = new.select("node", "label")
        if not new.filter("label <> was").limit(1).count():
            break
    return nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def ngram_join(docs: DataFrame, width: int = 3, similarity: Fraction = Fraction(9, 10), id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id of its component), links_verified (links of its
    set with other sets, as far as they had to be verified: no degree, as sets that are known to be in one component
    are not compared further) and text_hash (xxhash64 of the text, to find the row again) of every row of docs.

    Words are runs without white space, A-Z in lower case; a text with fewer
    than ``width`` words is one n-gram; one without words (or null) is linked
    with nothing and its own component.  Null ids take part and are never the
    smallest (a component of null ids only has a null id).  Each of repeated
    rows gets its row.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    if not Fraction(3, 4) <= similarity < 1:
        raise ValueError("similarities from 3/4 on")
    found = describe(rows, frequent_tokens(rows.select("text"), width, slots), width, similarity)
    sketch_cols = ["n", *(f"s{k}" for k in range(SKETCH))]
    full = found.filter("node is not null")
    nodes = save(full.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_id")), "ngram-nodes")
    several = checked_broadcast(save(nodes.filter("rows > 1").select("node"), "ngram-several"))

    def one_row_each(*columns: str) -> DataFrame:
        """The columns of one row of each node: only rows of nodes that have several are shuffled."""
        rows_of = full.select("node", *columns)
        return rows_of.join(several, "node", "left_anti").unionByName(rows_of.join(several, "node", "left_semi").groupBy("node").agg(*[F.first(c).alias(c) for c in columns]))

    described = save(one_row_each(*sketch_cols, "long"), "ngram-sketches")
    postings = one_row_each("signatures", "n").select("node", F.col("n").cast("int").alias("n"), F.explode("signatures").alias("sig"))
    buckets = postings.groupBy("sig").agg(F.min("node").alias("lead"), F.max("node").alias("last"), F.count(F.lit(1)).alias("size"), F.min("n").alias("least"), F.max("n").alias("most"))
    # most signatures that several nodes have are those of two nodes, and most of these are of sizes that cannot be linked
    sizes_allow = F.col("least").cast("long") * similarity.denominator >= F.col("most").cast("long") * similarity.numerator
    buckets = save(buckets.filter(F.expr("lead <> last") & ((F.col("size") > 2) | sizes_allow)).select("sig", "lead", "size"), "ngram-buckets")
    postings = postings.drop("n")
    # nodes of signatures that several nodes have
    shared = look_up(postings, buckets, "sig", "size", buckets.agg(F.sum("size")).first()[0] or 0).filter("lead is not null")
    shared = save(shared.select("sig", "node", "lead"), "ngram-shared")
    def named(prefix: str) -> DataFrame:
        return described.select(F.col("node").alias(prefix), *[F.col(c).alias(f"{prefix}_{c}") for c in sketch_cols])

    def candidates(pairs: DataFrame) -> DataFrame:
        return pairs.join(named("a"), "a").join(named("b"), "b").filter(possible(similarity)).select("a", "b")

    stars = save(candidates(shared.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()), "ngram-stars")
    links = verify(save(possible_long(stars, described, similarity), "ngram-likely"), rows, nodes, width, similarity)
    labels = save(components(links, nodes), "ngram-labels")

    def mixed_postings(once: bool = False) -> DataFrame:
        """sig, node, label, main (the signature's largest component), size (its nodes) of signatures whose nodes are in several components;
        ``once``: of signatures with the same nodes (by 128 bits of hashes) one only."""
        labelled = shared.join(labels, "node").select("sig", "node", "label")
        hashes = {f"h{k}": F.xxhash64("node", F.lit(k)) for k in range(2)} if once else {}
        per_label = labelled.groupBy("sig", "label").agg(F.count(F.lit(1)).alias("n"), *[F.bit_xor(h).alias(c) for c, h in hashes.items()])
        mixed = per_label.groupBy("sig").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("k"), *[F.bit_xor(c).alias(c) for c in hashes]).filter("k > 1")
        if once:
            mixed = mixed.groupBy("size", *hashes).agg(F.min("sig").alias("sig"), F.first("m").alias("m"))
        return save(labelled.join(mixed.select("sig", F.col("m.label").alias("main"), "size"), "sig"), "ngram-mixed")

    checked = stars.select("a", "b")
    for turn in range(STAR_ROUNDS):
        left = mixed_postings()
        degree = left.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
        # the first round's leads are the best connected ones, later ones differ from signature to signature
        best = F.col("degree") if turn == 0 else F.xxhash64("node", F.lit(turn))
        many = F.col("size") > MANY_NODES
        rank = F.struct(F.when(many, F.xxhash64("node", "sig", F.lit(turn))).otherwise(best), "node")
        slot = F.when(many, F.pmod(F.xxhash64("node"), F.lit(LEADS))).otherwise(0).alias("slot")
        lead = left.filter("label = main").join(degree, "node").groupBy("sig", slot).agg(F.max(rank)["node"].alias("lead")).drop("slot")
        pairs = left.filter("label <> main").join(lead, "sig").select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
        pairs = save(pairs.join(checked, ["a", "b"], "left_anti"), "ngram-turn")
        likely = save(candidates(pairs), "ngram-turn-likely")
        checked = checked.unionByName(likely)
        found_links = verify(save(possible_long(likely, described, similarity), "ngram-likely"), rows, nodes, width, similarity)
        n_mixed, n_found = left.select("node").distinct().count(), found_links.count()
        if n_found:
            links = save(links.union(found_links), "ngram-links")
            labels = save(components(links, nodes), "ngram-labels")
        if n_found <= STAR_GAIN * n_mixed:
            break
    left = save(not_within(mixed_postings(once=True)).drop("size").join(graded(described, similarity), "node"), "ngram-left")
    # all pairs of different components, of which one is not in the signature's largest
    cols = lambda p: [F.col("node").alias(p), F.col("label").alias(p + "_label"), *[F.col(c).alias(f"{p}_{c}") for c in (*sketch_cols, "long")]]
    others = left.filter("label <> main").select("sig", "grade", *cols("a"))
    everyone = left.select("sig", "grade", (F.col("label") == F.col("main")).alias("in_main"), *cols("b"))
    second = others.join(everyone, ["sig", "grade"]).filter((F.col("a_label") != F.col("b_label")) & (F.col("in_main") | (F.col("a") < F.col("b"))) & possible(similarity) & possible_folded(similarity))
    second = save(second.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(checked, ["a", "b"], "left_anti"), "ngram-second")
    if second.limit(1).count():
        second = save(possible_long(second, described, similarity), "ngram-likely")
        links = save(links.union(verify(second, rows, nodes, width, similarity)), "ngram-all-links")
        labels = save(components(links, nodes), "ngram-all-labels")
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("links_verified"))
    first = nodes.join(labels, "node").groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = save(nodes.select("node", F.col("rows").alias("n_rows")).join(labels, "node").join(first, "label").join(degree, "node", "left").select("node", "n_rows", "component_id", F.coalesce("links_verified", F.lit(0)).alias("links_verified")), "ngram-classes")
    out = look_up(found.select("doc_id", "text_hash", "node", F.col("n").alias("n_shingles")), classes, "node", "n_rows", found.count())
    empty = F.col("node").isNull()
    return out.select("doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("links_verified", F.lit(0)).cast("long").alias("links_verified"), "text_hash")
