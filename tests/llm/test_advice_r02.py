"""Cases that the second review found."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from reviewlens.llm import langid, mixing

# -- 2 -------------------------------------------------------------------------------------------------------------------


def brute_schedule(sources):
    """Slot -> (source, block), earliest deadline first with exact weights, until a source runs out."""
    total = sum(Fraction(w) for _, w, _ in sources)
    share, blocks = {s: Fraction(w) / total for s, w, _ in sources}, {s: n for s, _, n in sources}
    had, out = dict.fromkeys(share, 0), []
    while True:
        s = min((math.ceil((had[s] + 1) / w), -w, s) for s, w in share.items() if math.floor(had[s] / w) <= len(out))[2]
        if had[s] == blocks[s]:
            return out
        out.append((s, had[s]))
        had[s] += 1


@pytest.mark.parametrize("window", [5, 64])
@pytest.mark.parametrize("sources", [
    [("a", math.sqrt(83_000), 800), *((f"s{i:02}", math.sqrt(8_800), 260) for i in range(19))],
    [("big", 1e4, 1500), *((f"s{i:03}", 1.0, 2) for i in range(80))],
    [("x", 1.0, 40), ("y", 1.0, 40), ("z", 1.0, 7)],
])
def test_exact_weights_hold_in_every_slot(spark, sources, window):
    rows = mixing.schedule(spark.createDataFrame(sources, "source string, weight double, blocks long"), window).collect()
    assert {(r.source, r.k) for r in rows} == {(s, k) for s, _, n in sources for k in range(n)} and len({r.slot for r in rows}) == len(rows)
    total = sum(Fraction(w) for _, w, _ in sources)
    for r in rows:
        w = Fraction(dict((s, w) for s, w, _ in sources)[r.source]) / total
        assert r.release == math.floor(r.k / w) <= r.slot < r.deadline == math.ceil((r.k + 1) / w)
    at = {r.slot: (r.source, r.k) for r in rows}
    assert all(at[t] == x for t, x in enumerate(brute_schedule(sources)))


def test_more_sources_than_a_cycle_has_slots(spark):
    docs = spark.createDataFrame([(i, "big" if i < 900 else f"s{i}") for i in range(2000)], "doc_id long, source string")
    weights = spark.createDataFrame([("big", 1e4), ("absent", 1e6), *((f"s{i}", 1.0) for i in range(900, 2000))], "source string, weight double")
    out = mixing.mix(docs, weights, block_rows=1).orderBy("mix_slot").collect()
    assert sorted(r.row.doc_id for r in out) == list(range(2000)) and len({r.mix_slot for r in out}) == 2000
    had = 0
    for t, r in enumerate(out[:900]):
        assert r.mix_slot == t
        had += r.source == "big"
        assert abs(had - (t + 1) * Fraction(10_000, 11_100)) < 1


# -- 9 -------------------------------------------------------------------------------------------------------------------

FOREIGN = [
    "La pioggia cadeva lentamente sulla vecchia città mentre gli abitanti tornavano a casa dopo una lunga giornata di lavoro nei campi",
    "Deszcz padał powoli na stare miasto podczas gdy mieszkańcy wracali do domu po długim dniu pracy w polu",
    "Sade lankesi hitaasti vanhan kaupungin ylle kun asukkaat palasivat kotiin pitkän työpäivän jälkeen pelloilta",
    "Дождь медленно падал на старый город пока жители возвращались домой после долгого рабочего дня",
    "xqzj wvkp ggtrx qqpl zzxv bnmk jhgf wqrt plkj vcxz mnbq",
]


@pytest.mark.parametrize("langs", [("en", "fr", "de", "es"), ("en", "de", "es"), ("en",)])
def test_foreign_texts_and_junk_are_rejected(spark, sf_dir, langs):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    learned = docs.filter(F.col("lang").isin(*langs))
    model = langid.train(learned)
    planted = spark.createDataFrame([(i, x, "foreign") for i, x in enumerate(FOREIGN)], "doc_id long, text string, lang string")
    shares = {r.lang: r.share for r in langid.predict(docs.union(planted), model, keep=("lang",)).groupBy("lang").agg(F.avg(F.col("rejected").cast("double")).alias("share")).collect()}
    assert shares["foreign"] == 1
    for lang in ("en", "fr", "de", "es"):
        assert shares[lang] <= 0.02 if lang in langs else shares[lang] >= 0.95, lang


def test_training_rows_are_bounded_where_ids_repeat(spark):
    rows = [(None, f"text number {i}", "en") for i in range(300)] + [(7, "the same text", "fr")] * 300 + [(9, "another", "fr")]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(r.lang, r.mixed_up): r["count"] for r in langid.training_rows(labelled, 20).groupBy("lang", "mixed_up").count().collect()} == {(x, y): 20 for x in ("en", "fr") for y in (False, True)}


# -- pipeline ------------------------------------------------------------------------------------------------------------

def test_mixing_order_reaches_the_end_of_the_pipeline(spark, sf_dir, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed = mixing.mix(docs, mixing.flattened_weights(docs)).select("id", "mix_slot", "mix_place").collect()
    out = corpus_pipeline.run(spark, sf_dir).select("doc_id", "mix_slot", "mix_place").collect()
    assert {tuple(r) for r in out} == {tuple(r) for r in placed} and len(out) == len({(r.mix_slot, r.mix_place) for r in out}) == docs.count()
    # the stage's own rows are in that order
    first = [(r.mix_slot, r.mix_place) for r in corpus_pipeline.mix_sources(spark, docs, sf_dir).collect()]
    assert first == sorted(first)
