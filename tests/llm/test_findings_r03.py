"""Findings of the third review on the operators of llm/."""

import numpy as np

from reviewlens.llm import langid, lbl


def test_driver_gets_the_fitted_language_model_alone(spark, monkeypatch):
    texts = {"en": "the film was good and the story was better", "de": "der Film war gut und die Handlung war besser"}
    docs = spark.createDataFrame([(i, texts[lang] + f" {i}", lang) for i in range(60) for lang in texts], "doc_id long, text string, lang string")
    monkeypatch.setattr(type(docs), "toArrow", lambda self: (_ for _ in ()).throw(AssertionError("rows sent to the driver")))  # before: all examples
    model = langid.train(docs)
    assert model.langs == ["de", "en"] and model.table.shape == (langid.BUCKETS, 3) and model.table.dtype == np.float32
    got = {r.doc_id: r.lang_pred for r in langid.predict(spark.createDataFrame([(1, texts["en"]), (2, texts["de"]), (3, None)], "doc_id long, text string"), model).collect()}
    assert got == {1: "en", 2: "de", 3: "und"}


def test_held_back_texts_are_read_once_and_gradients_of_repeated_rows_add_up(spark, monkeypatch):
    names, kept = [], lbl.save
    monkeypatch.setattr(lbl, "save", lambda df, name: names.append(name) or kept(df, name))
    docs = spark.createDataFrame([(i, f"a b c d e {i % 7}") for i in range(400)], "doc_id long, text string")
    lbl.score_documents(docs, top=8).collect()
    assert names.count("lm-held-back") == 1  # before: filtered out of all texts after every round
    rng, n = np.random.default_rng(1), 500
    trainer = lbl.Trainer(lbl.Model(np.arange(40.0, 0, -1)), 3)
    i, rows = rng.integers(0, 41, n), rng.normal(size=(n, lbl.DIM)).astype(np.float32)
    want = trainer.m.word.astype(np.float64)
    for k in set(i.tolist()):
        g = rows[i == k].astype(np.float64).sum(axis=0)
        want[k] -= lbl.RATE * g / np.sqrt(1 + (g * g).mean())
    trainer.change(i, (0, trainer.m.word, rows))
    assert np.allclose(trainer.m.word, want, atol=1e-5)


def test_near_copies_meet_several_leads(spark, monkeypatch):
    """Of a group of near copies of which most pairs are no links, few nodes are left for the comparison of all pairs."""
    import random
    from fractions import Fraction

    from reviewlens.llm import ngram_join

    save, left = ngram_join.save, {}

    def kept(df, name):
        left[name] = save(df, name)
        return left[name]

    monkeypatch.setattr(ngram_join, "save", kept)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    found = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 5, Fraction(4, 5)).collect()
    sets = [{tuple(t.split()[k:k + 5]) for k in range(146)} for _, t in rows]
    label = list(range(300))
    for i in range(300):
        for j in range(i):
            if label[i] != label[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(label))
    alone = sum(label.count(x) == 1 for x in label)
    outside = left["ngram-left"].filter("label <> main").select("node").distinct().count()
    assert outside <= 1.5 * alone + 5


def test_pairs_without_link_are_compared_in_few_signatures(spark, monkeypatch):
    """Texts that share most signatures, and large texts that share a passage, are not compared in each of them; links stay found."""
    import random
    from fractions import Fraction

    from reviewlens.llm import ngram_join

    save, left = ngram_join.save, {}

    def kept(df, name):
        left[name] = save(df, name)
        return left[name]

    monkeypatch.setattr(ngram_join, "save", kept)
    rng = random.Random(5)
    draw = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for _ in range(6):  # 400 words each: some 0.6 alike, one pair linked
        base = draw(400)
        texts += [base[:300] + draw(100), base[:300] + draw(100), base[:300] + draw(100)]
        texts.append([*texts[-1][:395], *draw(5)])
    passage = draw(600)
    texts += [draw(5400) + passage for _ in range(8)]
    texts.append([*texts[-1][:5900], *draw(100)])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 5, Fraction(4, 5)).collect()
    sets = [{tuple(t[k:k + 5]) for k in range(len(t) - 4)} for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    assert len(set(label)) == len(texts) - 7
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(label))
    assert left["ngram-left"].count() <= 20 * len(texts)  # before: every shared signature of every text
    large = left["ngram-sketches"].filter("n > 5000").select("node")
    assert not left["ngram-second"].join(large, left["ngram-second"]["a"] == large["node"], "left_semi").count()  # before: short sketches let all pairs pass


def test_signatures_within_others_are_left_out(spark):
    from reviewlens.llm.ngram_join import not_within

    sets = {1: "abcd", 2: "abc", 3: "abcd", 4: "de", 5: "e", 6: "bf"}
    postings = spark.createDataFrame([(sig, ord(n), len(nodes)) for sig, nodes in sets.items() for n in nodes], "sig long, node long, size long")
    assert {r.sig for r in not_within(postings).collect()} == {1, 4, 6}
    assert {r.sig for r in not_within(postings, 1).collect()} == {1, 4, 6}
