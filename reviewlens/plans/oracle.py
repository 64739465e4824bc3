"""Oracle SQL (DuckDB dialect) for each registered query.

The views ``documents labels pages`` are the same parquet tables the Spark
queries read.  Each statement is written independently from the Spark code
and states the semantics directly.
"""

from __future__ import annotations

# Shared CTE bodies -----------------------------------------------------------

LAB = ("lab AS (SELECT d.doc_id, d.text, CASE WHEN l.quality = 1 THEN 'pos' ELSE 'neg' END AS label "
       "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)")
UNL = ("unl AS (SELECT d.doc_id, d.text FROM documents d "
       "WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))")
SPLIT = ("spl AS (SELECT doc_id, text, label, CASE WHEN "
         "CAST('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 7) AS BIGINT) % 10 >= 9 "
         "THEN 'test' ELSE 'train' END AS split FROM lab)")
TRAIN = "trn AS (SELECT doc_id, text, label FROM spl WHERE split = 'train')"
TEST = "tst AS (SELECT doc_id, text, label FROM spl WHERE split = 'test')"

NON_BLANK = r"regexp_matches(word, '[^\x00-\x20]')"


def bayes_ctes(train: str, test: str) -> str:
    """CTEs dw, df, ncls, lp, occ, sc for naive Bayes of ``test`` given ``train``."""
    return f"""
dw AS (SELECT DISTINCT doc_id, label, word FROM
        (SELECT doc_id, label, unnest(string_split(text, ' ')) AS word FROM {train})
       WHERE {NON_BLANK}),
df AS (SELECT word, CAST(count_if(label = 'pos') AS BIGINT) AS df_pos,
              CAST(count_if(label = 'neg') AS BIGINT) AS df_neg FROM dw GROUP BY word),
ncls AS (SELECT count_if(label = 'pos') AS n_pos, count_if(label = 'neg') AS n_neg FROM {train}),
lp AS (SELECT word, ln(greatest(df_pos, 1) / n_pos) AS lp_pos, ln(greatest(df_neg, 1) / n_neg) AS lp_neg,
              greatest(df_pos, 1) / n_pos AS p_pos, greatest(df_neg, 1) / n_neg AS p_neg
       FROM df, ncls),
occ AS (SELECT doc_id, word, count(*) AS n FROM
         (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM {test})
        WHERE {NON_BLANK} GROUP BY doc_id, word),
sc AS (SELECT t.doc_id, coalesce(s.score_pos, 0.0) AS score_pos, coalesce(s.score_neg, 0.0) AS score_neg,
              coalesce(s.prob_pos, 1.0) AS prob_pos, coalesce(s.prob_neg, 1.0) AS prob_neg
       FROM {test} t LEFT JOIN
        (SELECT doc_id, sum(n * lp_pos) AS score_pos, sum(n * lp_neg) AS score_neg,
                product(pow(p_pos, n)) AS prob_pos, product(pow(p_neg, n)) AS prob_neg
         FROM occ JOIN lp USING (word) GROUP BY doc_id) s ON t.doc_id = s.doc_id),
pred AS (SELECT doc_id, CAST(score_pos - score_neg > 1e-12 * (abs(score_pos) + abs(score_neg)) AS INTEGER) AS prediction FROM sc)"""


CONFUSION = """
conf AS (SELECT CAST(count_if(p.prediction = 1 AND t.label = 'pos') AS BIGINT) AS tp,
                CAST(count_if(p.prediction <> 1 AND t.label <> 'pos') AS BIGINT) AS tn,
                CAST(count_if(p.prediction = 1 AND t.label <> 'pos') AS BIGINT) AS fp,
                CAST(count_if(p.prediction <> 1 AND t.label = 'pos') AS BIGINT) AS fn
         FROM pred p JOIN tst t ON p.doc_id = t.doc_id)"""


ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------------------
# M0
# ---------------------------------------------------------------------------

ORACLE["space_tokens"] = rf"""
SELECT doc_id, idx, word FROM (
  SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS idx, unnest(s) AS word
  FROM (SELECT doc_id, string_split(text, ' ') AS s FROM documents))
WHERE {NON_BLANK}"""

ORACLE["class_doc_counts"] = f"""
WITH {LAB} SELECT label, count(*) AS n_docs FROM lab GROUP BY label"""

ORACLE["term_doc_freq"] = f"""
WITH {LAB},
dw AS (SELECT DISTINCT doc_id, label, word FROM
        (SELECT doc_id, label, unnest(string_split(text, ' ')) AS word FROM lab)
       WHERE {NON_BLANK})
SELECT word, CAST(count_if(label = 'pos') AS BIGINT) AS df_pos,
       CAST(count_if(label = 'neg') AS BIGINT) AS df_neg FROM dw GROUP BY word"""

ORACLE["bayes_scores"] = f"""
WITH {LAB}, {UNL}, {bayes_ctes('lab', 'unl')}
SELECT doc_id, round(score_pos, 6) AS score_pos, round(score_neg, 6) AS score_neg FROM sc"""

ORACLE["bayes_predict"] = f"""
WITH {LAB}, {UNL}, {bayes_ctes('lab', 'unl')}
SELECT doc_id, prediction FROM pred"""

# ---------------------------------------------------------------------------
# M1
# ---------------------------------------------------------------------------

ORACLE["holdout_split"] = f"""
WITH {LAB}, {SPLIT} SELECT doc_id, label, split FROM spl"""

ORACLE["holdout_split_exact"] = f"""
WITH {LAB},
num AS (SELECT doc_id, label, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR))) - 1 AS seq,
               count(*) OVER () AS n FROM lab)
SELECT doc_id, label, CASE WHEN seq < (n * 9) // 10 THEN 'train' ELSE 'test' END AS split FROM num"""

ORACLE["bayes_confusion"] = f"""
WITH {LAB}, {SPLIT}, {TRAIN}, {TEST}, {bayes_ctes('trn', 'tst')}, {CONFUSION}
SELECT tp, tn, fp, fn FROM conf"""

ORACLE["bayes_accuracy"] = f"""
WITH {LAB}, {SPLIT}, {TRAIN}, {TEST}, {bayes_ctes('trn', 'tst')}, {CONFUSION}
SELECT tp + tn + fp + fn AS n_eval,
       round(CASE WHEN tp + tn + fp + fn = 0 THEN NULL
                  ELSE CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) END, 9) AS accuracy
FROM conf"""

ORACLE["bayes_prediction_lines"] = f"""
WITH {LAB}, {UNL}, {bayes_ctes('lab', 'unl')}
SELECT CAST(doc_id AS VARCHAR) AS id, CAST(doc_id AS VARCHAR) || ' ' || CAST(prediction AS VARCHAR) AS line
FROM pred"""

ORACLE["bayes_scores_product"] = f"""
WITH {LAB}, {UNL}, {bayes_ctes('lab', 'unl')}
SELECT doc_id, CAST(prob_pos > prob_neg AS INTEGER) AS prediction FROM sc"""

ORACLE["doc_distinct_words"] = f"""
WITH {LAB}
SELECT DISTINCT doc_id, word FROM
  (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM lab)
WHERE {NON_BLANK}"""

ORACLE["train_union"] = f"""
WITH {LAB}
SELECT doc_id, label, md5(text) AS text_md5 FROM lab WHERE label = 'neg'
UNION ALL
SELECT doc_id, label, md5(text) AS text_md5 FROM lab WHERE label = 'pos'"""

ORACLE["limited_docs"] = f"""
WITH {LAB}
SELECT doc_id, label FROM (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS rn FROM lab)
WHERE rn <= 50"""

ORACLE["review_id_from_path"] = """
SELECT page_id, split_part(string_split(url, '/')[-1], '.', 1) AS id FROM pages"""

ORACLE["label_from_path"] = f"""
WITH {LAB},
p AS (SELECT doc_id, 'processed_data/train/' || label || '/' || CAST(doc_id AS VARCHAR) || '.json' AS path FROM lab)
SELECT doc_id, path,
       CASE WHEN string_split(path, '/')[-2] IN ('pos', 'neg') THEN string_split(path, '/')[-2] END AS label,
       split_part(string_split(path, '/')[-1], '.', 1) AS id
FROM p"""


# ---------------------------------------------------------------------------
# M2: class-mean vectors
# ---------------------------------------------------------------------------

STRIP = r"regexp_replace(raw, '[^\p{L}\p{N}]+', '', 'g')"


def centroid_ctes(train: str, test: str, tie: str = ">", n_docs: int | None = None,
                  shared_neg: bool = False) -> str:
    """CTEs tf, stats, ttf, iv, xw, sims, cpred for class-mean scoring.
    ``n_docs``: constant divisor of the means; ``shared_neg``: both
    similarities use the negative-class weight."""
    ncl = (f"SELECT {n_docs} AS n_pos, {n_docs} AS n_neg" if n_docs is not None else
           f"SELECT count_if(label = 'pos') AS n_pos, count_if(label = 'neg') AS n_neg FROM {train}")
    xcf = "cf_neg" if shared_neg else "cf_pos"
    return f"""
pc AS (SELECT doc_id, label, n_pieces, {STRIP} AS word FROM
        (SELECT doc_id, label, len(string_split(rtrim(text, ' '), ' ')) AS n_pieces,
                unnest(string_split(text, ' ')) AS raw FROM {train})),
tf AS (SELECT doc_id, label, word, n_pieces, count(*) AS f FROM pc WHERE word <> ''
       GROUP BY doc_id, label, word, n_pieces),
cfs AS (SELECT word,
          CAST(sum(CASE WHEN label = 'pos' THEN f ELSE 0 END) AS BIGINT) AS cf_pos,
          CAST(sum(CASE WHEN label = 'neg' THEN f ELSE 0 END) AS BIGINT) AS cf_neg
        FROM tf GROUP BY word),
sums AS (SELECT word, cf_pos, cf_neg,
          sum(CASE WHEN label = 'pos' THEN f / n_pieces * log10(cf_pos / f) ELSE 0.0 END) AS sum_pos,
          sum(CASE WHEN label = 'neg' THEN f / n_pieces * log10(cf_neg / f) ELSE 0.0 END) AS sum_neg
        FROM tf JOIN cfs USING (word) GROUP BY word, cf_pos, cf_neg),
ncl AS ({ncl}),
stats AS (SELECT word, cf_pos, cf_neg, sum_pos / n_pos AS mean_pos, sum_neg / n_neg AS mean_neg FROM sums, ncl),
ttf AS (SELECT doc_id, word, count(*) AS f FROM
         (SELECT doc_id, {STRIP} AS word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS raw FROM {test}))
        WHERE word <> '' GROUP BY doc_id, word),
iv AS (SELECT t.doc_id, t.word, t.f, s.cf_pos, s.cf_neg, s.mean_pos, s.mean_neg,
              sum(t.f) OVER (PARTITION BY t.doc_id) AS count_terms
       FROM ttf t JOIN stats s ON t.word = s.word),
xw AS (SELECT doc_id, word, mean_pos, mean_neg,
         CASE WHEN cf_pos > 0 AND cf_neg > 0 THEN f / count_terms * log10({xcf} / f) ELSE 0.0 END AS x_pos,
         CASE WHEN cf_pos > 0 AND cf_neg > 0 THEN f / count_terms * log10(cf_neg / f) ELSE 0.0 END AS x_neg
       FROM iv),
sg AS (SELECT doc_id, sum(least(x_pos, mean_pos)) AS np, sum(greatest(x_pos, mean_pos)) AS dp,
              sum(least(x_neg, mean_neg)) AS nn, sum(greatest(x_neg, mean_neg)) AS dn
       FROM xw GROUP BY doc_id),
sims AS (SELECT t.doc_id,
           CASE WHEN sg.dp = 0 THEN NULL ELSE sg.np / sg.dp END AS sim_pos,
           CASE WHEN sg.dn = 0 THEN NULL ELSE sg.nn / sg.dn END AS sim_neg
         FROM {test} t LEFT JOIN sg ON t.doc_id = sg.doc_id),
cpred AS (SELECT doc_id, CAST(coalesce(sim_pos - sim_neg {tie} {'-' if '=' in tie else ''}1e-12 * greatest(abs(sim_pos), abs(sim_neg)), false) AS INTEGER) AS prediction
          FROM sims)"""


HELD = ("held AS (SELECT doc_id, text, label FROM spl s WHERE NOT EXISTS "
        "(SELECT 1 FROM trn t WHERE t.doc_id = s.doc_id))")
DEDUP = ("dd AS (SELECT min(doc_id) AS doc_id, text, arg_max(label, label = 'neg') AS label, "
         "count(*) AS n_copies FROM held GROUP BY text)")

ORACLE["clean_tokens"] = rf"""
SELECT doc_id, idx, word FROM (
  SELECT doc_id, idx, {STRIP} AS word FROM (
    SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS idx, unnest(s) AS raw
    FROM (SELECT doc_id, string_split(text, ' ') AS s FROM documents)))
WHERE word <> ''"""

ORACLE["term_collection_freq"] = f"""
WITH {LAB}
SELECT word, CAST(count_if(label = 'pos') AS BIGINT) AS cf_pos, CAST(count_if(label = 'neg') AS BIGINT) AS cf_neg
FROM (SELECT label, {STRIP} AS word FROM (SELECT label, unnest(string_split(text, ' ')) AS raw FROM lab))
WHERE word <> '' GROUP BY word"""

ORACLE["doc_term_counts"] = f"""
SELECT doc_id, word, n_pieces, count(*) AS f FROM
  (SELECT doc_id, n_pieces, {STRIP} AS word FROM
    (SELECT doc_id, len(string_split(rtrim(text, ' '), ' ')) AS n_pieces,
            unnest(string_split(text, ' ')) AS raw FROM documents))
WHERE word <> '' GROUP BY doc_id, word, n_pieces"""

ORACLE["in_vocab_counts"] = f"""
WITH {LAB}, {UNL}, {centroid_ctes('lab', 'unl')}
SELECT doc_id, word, f, CAST(count_terms AS BIGINT) AS count_terms FROM iv"""

ORACLE["mean_vectors"] = f"""
WITH {LAB}, {UNL}, {centroid_ctes('lab', 'unl')}
SELECT word, round(mean_pos, 12) AS mean_pos, round(mean_neg, 12) AS mean_neg FROM stats"""

ORACLE["test_doc_weights"] = f"""
WITH {LAB}, {UNL}, {centroid_ctes('lab', 'unl')}
SELECT doc_id, word, round(x_pos, 12) AS x_pos, round(x_neg, 12) AS x_neg FROM xw"""

ORACLE["weighted_jaccard"] = f"""
WITH {LAB}, {UNL}, {centroid_ctes('lab', 'unl')}
SELECT doc_id, round(sim_pos, 9) AS sim_pos, round(sim_neg, 9) AS sim_neg FROM sims"""

ORACLE["centroid_predict"] = f"""
WITH {LAB}, {UNL}, {centroid_ctes('lab', 'unl')}
SELECT doc_id, prediction FROM cpred"""

ORACLE["centroid_predict_numbered"] = f"""
WITH {LAB}, {UNL}, {centroid_ctes('lab', 'unl')},
num AS (SELECT doc_id, prediction, printf('%05d', row_number() OVER (ORDER BY doc_id) - 1) AS seq FROM cpred)
SELECT seq, doc_id, prediction, seq || ' ' || CAST(prediction AS VARCHAR) AS line FROM num"""

ORACLE["heldout_docs"] = f"""
WITH {LAB}, {SPLIT}, {TRAIN}, {HELD} SELECT doc_id, label FROM held"""

ORACLE["heldout_dedup"] = f"""
WITH {LAB}, {SPLIT}, {TRAIN}, {HELD}, {DEDUP} SELECT doc_id, label, n_copies FROM dd"""

ORACLE["centroid_precision"] = f"""
WITH {LAB}, {SPLIT}, {TRAIN}, {HELD}, {DEDUP}, {centroid_ctes('trn', 'dd', '>=')},
ev AS (SELECT count_if((p.prediction = 1) = (d.label = 'pos')) AS c, count_if((p.prediction = 1) <> (d.label = 'pos')) AS w
       FROM cpred p JOIN dd d ON p.doc_id = d.doc_id)
SELECT CAST(c AS BIGINT) AS n_correct, CAST(w AS BIGINT) AS n_wrong,
       round(CASE WHEN c + w = 0 THEN NULL ELSE c / (c + w) END, 9) AS precision FROM ev"""

LIMITED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS rn FROM lab),
trn AS (SELECT doc_id, text, label FROM ranked WHERE rn <= 40),
held AS (SELECT doc_id, text, label FROM ranked WHERE rn > 40 AND rn <= 55)"""

ORACLE["heldout_unread_docs"] = f"""
WITH {LAB}, {LIMITED} SELECT doc_id, label FROM held"""

ORACLE["centroid_precision_limited"] = ORACLE["centroid_precision"].replace(f"{SPLIT}, {TRAIN}, {HELD}", LIMITED)

ORACLE["scored_review_round_trip"] = f"""
WITH {LAB} SELECT CAST(doc_id AS VARCHAR) AS id, label, md5(text) AS text_md5, CAST(length(text) AS DOUBLE) AS pos_score, doc_id / 4 AS neg_score FROM lab"""


# ---------------------------------------------------------------------------
# M3: TF-IDF neighbours
# ---------------------------------------------------------------------------

STOPS = ("['a', 'an', 'and', 'are', 'as', 'at', 'be', 'but', 'by', 'for', 'if', 'in', 'into', "
         "'is', 'it', 'no', 'not', 'of', 'on', 'or', 'such', 'that', 'the', 'their', 'then', "
         "'there', 'these', 'they', 'this', 'to', 'was', 'will', 'with']")
RUNS = r"'[\p{L}\p{N}]+'"


def knn_ctes(train: str, test: str, k: int) -> str:
    """CTEs post, nd, dfs, qt, ps, hits, votes for neighbour search."""
    return f"""
pt AS (SELECT doc_id, label = 'pos' AS is_pos,
              list_filter(regexp_extract_all(lower(text), {RUNS}), lambda x: NOT list_contains({STOPS}, x)) AS terms
       FROM {train}),
post AS (SELECT doc_id, is_pos, doc_len, word, count(*) AS tf FROM
          (SELECT doc_id, is_pos, len(terms) AS doc_len, unnest(terms) AS word FROM pt)
         GROUP BY doc_id, is_pos, doc_len, word),
nd AS (SELECT count(*) AS n FROM {train}),
dfs AS (SELECT word, count(*) AS df FROM post GROUP BY word),
qt AS (SELECT qid, word, count(*) AS qtf FROM
        (SELECT doc_id AS qid,
                unnest(regexp_extract_all(regexp_replace(lower(text), '[^a-zA-Z ]+', '', 'g'), {RUNS})) AS word
         FROM {test})
       WHERE NOT list_contains({STOPS}, word) GROUP BY qid, word),
ps AS (SELECT q.qid, p.doc_id, p.is_pos,
              sum(q.qtf * ((1.0 + ln((nd.n + 1) / (dfs.df + 1))) * (1.0 + ln((nd.n + 1) / (dfs.df + 1)))
                           * sqrt(p.tf) / sqrt(p.doc_len))) AS score
       FROM qt q JOIN post p ON q.word = p.word JOIN dfs ON dfs.word = q.word CROSS JOIN nd
       GROUP BY q.qid, p.doc_id, p.is_pos),
hits AS (SELECT * FROM
          (SELECT qid, doc_id, is_pos, round(score, 9) AS score,
                  CAST(row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id ASC) AS INTEGER) AS rn
           FROM ps)
         WHERE rn <= {k}),
votes AS (SELECT t.doc_id AS qid, CAST(coalesce(h.n_hits, 0) AS BIGINT) AS n_hits,
                 CAST(coalesce(h.pos_hits, 0) AS BIGINT) AS pos_hits, coalesce(h.cos_sum, 0.0) AS cos_sum
          FROM {test} t LEFT JOIN
           (SELECT qid, count(*) AS n_hits, count_if(is_pos) AS pos_hits,
                   CAST(sum(CASE WHEN is_pos THEN CAST(score AS DECIMAL(38, 9)) ELSE -CAST(score AS DECIMAL(38, 9)) END) AS DOUBLE) AS cos_sum
           FROM hits GROUP BY qid) h
          ON t.doc_id = h.qid)"""


ORACLE["analyzed_terms"] = f"""
SELECT doc_id, idx, word, list_contains({STOPS}, word) AS is_stop FROM (
  SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS idx, unnest(s) AS word
  FROM (SELECT doc_id, regexp_extract_all(lower(text), {RUNS}) AS s FROM documents))"""

ORACLE["normalized_query_text"] = f"""
WITH {UNL} SELECT doc_id, regexp_replace(lower(text), '[^a-zA-Z ]+', '', 'g') AS query_text FROM unl"""

ORACLE["tfidf_corpus_stats"] = f"""
WITH {LAB}, {UNL}, {knn_ctes('lab', 'unl', 61)}
SELECT word, df, n AS n_docs, round(1.0 + ln((n + 1) / (df + 1)), 9) AS idf FROM dfs, nd"""

ORACLE["tfidf_pair_scores"] = f"""
WITH {LAB}, {UNL}, {knn_ctes('lab', 'unl', 61)}
SELECT qid, doc_id, is_pos, round(score, 9) AS score FROM ps"""

ORACLE["knn_top_hits"] = f"""
WITH {LAB}, {UNL}, {knn_ctes('lab', 'unl', 61)}
SELECT qid, rn, doc_id, is_pos, score FROM hits"""

ORACLE["knn_votes"] = f"""
WITH {LAB}, {UNL}, {knn_ctes('lab', 'unl', 61)}
SELECT qid, n_hits, pos_hits, round(cos_sum, 6) AS cos_sum FROM votes"""

ORACLE["knn_predict_cos"] = f"""
WITH {LAB}, {UNL}, {knn_ctes('lab', 'unl', 61)}
SELECT qid AS doc_id, CAST(cos_sum > 0 AS INTEGER) AS prediction FROM votes"""

ORACLE["knn_predict_majority"] = f"""
WITH {LAB}, {UNL}, {knn_ctes('lab', 'unl', 61)}
SELECT qid AS doc_id, CAST(round(2 * pos_hits / 61 - 1, 9) > 0 AS INTEGER) AS prediction FROM votes"""


# ---------------------------------------------------------------------------
# M4: preprocessing (lexicon scoring with negation)
# ---------------------------------------------------------------------------

TOKRE = r"'[\p{L}\p{N}]+|[^\s\p{L}\p{N}]'"


def html_sql(col: str) -> str:
    x = (f"regexp_replace(regexp_replace(regexp_replace({col}, '(?is)<!--.*?-->', '', 'g'), "
         f"'(?is)<(script|style)\\b.*?</(script|style)>', '', 'g'), '(?s)<([a-zA-Z]|[/!?])[^>]*>', '', 'g')")
    for ent, ch in [("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"),
                    ("&apos;", "''''"), ("&nbsp;", "chr(160)"), ("&copy;", "chr(169)"),
                    ("&middot;", "chr(183)"), ("&amp;", "'&'")]:
        x = f"replace({x}, '{ent}', {ch})"
    return x


# lexicon derived from the corpus vocabulary, rendered as file lines
LEXICON = rf"""
vocab AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), {RUNS})) AS word FROM documents),
lrows AS (SELECT word, r, md5(word || '#' || CAST(r AS VARCHAR)) AS h
          FROM vocab CROSS JOIN (VALUES (1), (2)) v(r)
          WHERE r = 1 OR CAST('0x' || substr(md5(word), 1, 1) AS INTEGER) < 4),
lexrows AS (SELECT CAST('0x' || substr(h, 4, 7) AS BIGINT) * 2 + (r - 1) AS line_no,
                   ['a', 'a', 'v', 'n'][CAST('0x' || substr(h, 1, 1) AS INTEGER) % 4 + 1] AS pos_tag,
                   (CAST('0x' || substr(h, 2, 1) AS INTEGER) % 9) / 8.0 AS pos,
                   (CAST('0x' || substr(h, 3, 1) AS INTEGER) % 9) / 8.0 AS neg,
                   word || '#' || CAST(r AS VARCHAR) AS term
            FROM lrows),
lines AS (SELECT line_no, pos_tag || ' ' || CAST(line_no AS VARCHAR) || ' ' || CAST(pos AS VARCHAR) || ' '
                 || CAST(neg AS VARCHAR) || ' ' || term || ' gloss' AS line FROM lexrows),
parsed AS (SELECT line_no, p[1] AS pos_tag, split_part(p[5], '#', 1) AS word,
                  CAST(p[3] AS DOUBLE) AS pos, CAST(p[4] AS DOUBLE) AS neg
           FROM (SELECT line_no, string_split_regex(trim(line), '\s+') AS p FROM lines
                 WHERE starts_with(line, 'a') OR starts_with(line, 'v'))
           WHERE len(p) >= 5),
fs AS (SELECT word, arg_min(pos, line_no) AS pos, arg_min(neg, line_no) AS neg FROM parsed GROUP BY word)"""

TAGS = rf"""
toks AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), {TOKRE})) AS token FROM documents),
tagt AS (SELECT token, CASE WHEN NOT regexp_full_match(token, {RUNS}) THEN '.'
                            WHEN token = 'no' THEN 'DT' WHEN token = 'not' THEN 'RB'
                            ELSE ['JJ', 'JJR', 'JJS', 'RB', 'NN', 'NNS', 'NNP', 'VB', 'VBD', 'VBG',
                                  'DT', 'IN', 'CC', 'PRP', 'MD', 'CD'][CAST('0x' || substr(md5(token), 1, 1) AS INTEGER) + 1]
                       END AS tag FROM toks)"""


def sentiment_ctes(docs: str) -> str:
    """CTEs rt, tg, ng, dsent for lexicon scoring of ``docs`` (doc_id, text)."""
    return f"""{LEXICON}, {TAGS},
rt AS (SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS idx, unnest(s) AS token
       FROM (SELECT doc_id, regexp_extract_all({html_sql('lower(text)')}, {TOKRE}) AS s FROM {docs})),
tg0 AS (SELECT rt.doc_id, rt.idx, rt.token,
               coalesce(g.tag, CASE WHEN regexp_full_match(rt.token, {RUNS}) THEN 'NN' ELSE '.' END) AS tag,
               coalesce(fs.pos, 0.0) AS pos, coalesce(fs.neg, 0.0) AS neg
        FROM rt LEFT JOIN tagt g ON g.token = rt.token LEFT JOIN fs ON fs.word = rt.token),
tg AS (SELECT *, regexp_matches(tag, '^(JJ|RB|NN|V)') AS content FROM tg0),
ng AS (SELECT *, coalesce(last_value(CASE WHEN content THEN NULL WHEN token IN ('no', 'not') THEN true ELSE false END
                                     IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS negated
       FROM tg),
dsent AS (SELECT d.doc_id, coalesce(s.pos_score, 0.0) AS pos_score, coalesce(s.neg_score, 0.0) AS neg_score,
                 coalesce(s.text, '') AS text
          FROM {docs} d LEFT JOIN
           (SELECT doc_id, sum(CASE WHEN negated THEN neg ELSE pos END) AS pos_score,
                   sum(CASE WHEN negated THEN pos ELSE neg END) AS neg_score,
                   string_agg(token || ' ', '' ORDER BY idx) AS text
            FROM ng WHERE content GROUP BY doc_id) s ON d.doc_id = s.doc_id)"""


ORACLE["html_to_text"] = f"""
SELECT page_id, {html_sql('lower(html)')} AS text FROM pages"""

ORACLE["word_tokens"] = f"""
SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS idx, unnest(s) AS token
FROM (SELECT doc_id, regexp_extract_all({html_sql('lower(text)')}, {TOKRE}) AS s FROM documents)"""

ORACLE["lexicon_parse"] = f"""
WITH {LEXICON} SELECT line_no, pos_tag, word, pos, neg FROM parsed"""

ORACLE["lexicon_first_sense"] = f"""
WITH {LEXICON} SELECT word, pos, neg FROM fs"""

ORACLE["tagged_tokens"] = f"""
WITH {sentiment_ctes('documents')} SELECT doc_id, idx, token, tag FROM tg"""

ORACLE["content_words"] = f"""
WITH {sentiment_ctes('documents')} SELECT doc_id, idx, token, tag FROM tg WHERE content"""

ORACLE["negated_tokens"] = f"""
WITH {sentiment_ctes('documents')} SELECT doc_id, idx, token, negated FROM ng WHERE content"""

ORACLE["token_sentiment"] = f"""
WITH {sentiment_ctes('documents')} SELECT doc_id, idx, token, pos, neg, negated FROM ng WHERE content"""

ORACLE["doc_sentiment"] = f"""
WITH {sentiment_ctes('documents')} SELECT doc_id, pos_score, neg_score FROM dsent"""

ORACLE["retained_text"] = f"""
WITH {sentiment_ctes('documents')} SELECT doc_id, text FROM dsent"""

ORACLE["sentiment_disagreement"] = f"""
WITH {LAB}, {sentiment_ctes('lab')}
SELECT CAST(count_if(s.pos_score > s.neg_score AND l.label = 'neg') AS BIGINT) AS pos_but_neg,
       CAST(count_if(s.neg_score > s.pos_score AND l.label = 'pos') AS BIGINT) AS neg_but_pos
FROM dsent s JOIN lab l ON s.doc_id = l.doc_id"""


# ---------------------------------------------------------------------------
# M5: sentiment-blended votes and the K sweep
# ---------------------------------------------------------------------------

POL = ("CASE WHEN pos_score + neg_score = 0 THEN NULL "
       "ELSE (pos_score - neg_score) / (pos_score + neg_score) END")

ORACLE["doc_polarity"] = f"""
WITH {UNL}, {sentiment_ctes('unl')} SELECT doc_id, round({POL}, 9) AS polarity FROM dsent"""

ORACLE["knn_predict_sentiment"] = f"""
WITH {LAB}, {UNL}, {knn_ctes('lab', 'unl', 61)}, {sentiment_ctes('unl')}
SELECT v.qid AS doc_id,
       CAST(coalesce(round(0.2 * {POL} + 0.8 * (2 * v.pos_hits / 61 - 1), 9) > 0, false) AS INTEGER) AS prediction
FROM votes v LEFT JOIN dsent s ON s.doc_id = v.qid"""

PREFIX = """
run AS (SELECT qid, rn,
               count_if(is_pos) OVER (PARTITION BY qid ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos_hits,
               CAST(sum(CASE WHEN is_pos THEN CAST(score AS DECIMAL(38, 9)) ELSE -CAST(score AS DECIMAL(38, 9)) END)
                   OVER (PARTITION BY qid ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cos_sum,
               count(*) OVER (PARTITION BY qid) AS n_hits
        FROM hits),
ks AS (SELECT CAST(k AS INTEGER) AS k FROM range(1, 201) t(k)),
pv AS (SELECT r.qid, ks.k, CAST(r.pos_hits AS BIGINT) AS pos_hits, r.cos_sum
       FROM run r JOIN ks ON ks.k = r.rn OR (r.rn = r.n_hits AND ks.k > r.rn)
       UNION ALL
       SELECT t.doc_id AS qid, ks.k, CAST(0 AS BIGINT) AS pos_hits, 0.0 AS cos_sum
       FROM tst t CROSS JOIN ks WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.qid = t.doc_id))"""

ORACLE["knn_prefix_votes"] = f"""
WITH {LAB}, {SPLIT}, {TRAIN}, {TEST}, {knn_ctes('trn', 'tst', 200)}, {PREFIX}
SELECT qid, k, pos_hits, round(cos_sum, 6) AS cos_sum FROM pv"""

ORACLE["knn_sweep"] = f"""
WITH {LAB}, {SPLIT}, {TRAIN}, {TEST}, {knn_ctes('trn', 'tst', 200)}, {PREFIX}, {sentiment_ctes('tst')},
j AS (SELECT pv.k, pv.pos_hits, pv.cos_sum, t.label = 'pos' AS truth, {POL} AS pol
      FROM pv JOIN tst t ON t.doc_id = pv.qid LEFT JOIN dsent s ON s.doc_id = pv.qid)
SELECT k,
       round(avg(CAST((round(2 * pos_hits / k - 1, 9) > 0) = truth AS DOUBLE)), 9) AS acc_knn,
       round(avg(CAST(coalesce(round(0.2 * pol + 0.8 * (2 * pos_hits / k - 1), 9) > 0, false) = truth AS DOUBLE)), 9)
           AS acc_knn_sentiment,
       round(avg(CAST((cos_sum > 0) = truth AS DOUBLE)), 9) AS acc_cos
FROM j GROUP BY k"""

ORACLE["centroid_predict_parity"] = f"""
WITH {LAB}, {UNL}, {centroid_ctes('lab', 'unl', '>', n_docs=10000, shared_neg=True)}
SELECT doc_id, prediction FROM cpred"""
