"""Registered queries of the operators and of the pipeline, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer(file: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(file)


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import subwords

    return subwords.digests(subwords.encode(table(spark, sf, "documents"), tokenizer("piece_bpe_32k.model")))


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import common, tokenfiles

    folder = common.shared_folder(spark)
    tokenfiles.write(table(spark, sf, "documents"), folder, tokenizer("byte_bpe_50k.json"), end_id=2)
    return tokenfiles.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op2_quality")
def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import quality
    from briefwright.llm.common import remainder

    docs, held = table(spark, sf, "documents"), F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    model = quality.fit(docs, table(spark, sf, "labels"), ~held)
    return docs.select("doc_id", held.alias("held_out"), quality.score(F.col("text"), model, spark).alias("score")).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op5_language")
def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import language
    from briefwright.llm.common import remainder

    docs, held = table(spark, sf, "documents"), F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    trees = language.fit(docs.where(~held))
    return docs.select("doc_id", held.alias("held_out"), language.predict(F.col("text"), trees, spark).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import toxicity
    from briefwright.llm.common import remainder

    docs, held = table(spark, sf, "documents"), F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf, "labels"), ~held)
    return docs.select("doc_id", held.alias("held_out"), toxicity.score(F.col("text"), model, spark).alias("score")).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT DISTINCT item_id, least(len(w), 10) AS t, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT t FROM bi),
di AS (SELECT doc_id, t, i, array_to_string(w[i : i + t - 1], ' ') AS run FROM (SELECT doc_id, w, t, unnest(range(1, len(w) - t + 2)) AS i FROM d, lengths WHERE len(w) >= t)),
hit AS (SELECT doc_id, di.t, di.i, item_id FROM di JOIN bi ON di.t = bi.t AND di.run = bi.run),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + t)) AS p FROM (SELECT DISTINCT doc_id, t, i FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op3_decontamination", OP3_SQL)
def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import decontamination

    found = decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query("op4_secrets")
def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import secretscan

    found = secretscan.scan(table(spark, sf, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secretscan.listed(F.col("base")), 256).alias("base_sha256"), secretscan.listed(F.col("spans")).alias("spans"))


@query("op10_vectors")
def op10_vectors(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import vectors

    return vectors.near_duplicates(table(spark, sf, "embeddings"))


OP1_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 5 * shared >= 4 * (na.n + nb.n - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, min(reach.b) AS class_id, CAST(any_value(coalesce(l.n_links, 0)) AS BIGINT) AS n_links, d.doc_id = min(reach.b) AS kept
FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) l ON l.a = d.doc_id GROUP BY d.doc_id
"""


@query("op1_ngram_join", OP1_SQL)
def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import ngramjoin

    found = ngramjoin.similar(table(spark, sf, "documents"))
    return found.select("doc_id", "class_id", "n_links", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("kept"))


@query("op8_licences")
def op8_licences(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import licences

    one = F.transform("licences", lambda x: F.concat_ws(":", x["licence"], x["first"].cast("string"), x["end"].cast("string"), F.format_number(x["coverage"], 3)))
    return licences.scan(table(spark, sf, "documents")).select("doc_id", F.size("licences").cast("long").alias("n_found"), F.array_join(one, ",").alias("licences"))


OP11_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT doc_id, part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM w),
m AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
k AS (SELECT part, fails, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (good = 1) AS BIGINT) AS good, CAST(count(*) FILTER (toxic = 1) AS BIGINT) AS toxic FROM f LEFT JOIN m USING (doc_id) GROUP BY ALL),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS x),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT o, step, list_slice(o, 1, step - 1) AS before, o[step] AS own FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
j AS (SELECT part, o, step, own, n, good, toxic, fails[own] AS hit, len(list_filter(before, lambda x: fails[x])) > 0 AS gone, len(list_filter([1, 2, 3, 4, 5], lambda x: fails[x])) = 1 AS alone FROM s, k),
r AS (SELECT part, o, step, own, sum(n) FILTER (NOT hit AND NOT gone) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed, sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (hit AND alone) AS unique_fails,
    sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(toxic) FILTER (hit AND NOT gone) AS toxic_lost FROM j GROUP BY ALL)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
FROM r
"""


@query("op11_filter_audit", OP11_SQL)
def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import filteraudit

    return filteraudit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


OP12_SQL = r"""
WITH e AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 50 = 0),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
neg AS (SELECT anchor_id, positive_id, positive_score, p.id AS negative_id, score AS negative_score, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, p.id) AS INT) AS rank
  FROM pos JOIN p USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import hardnegatives

    rows, key = table(spark, sf, "embeddings"), F.col("vec_id")
    rows = rows.select("vec_id", F.when(key % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
    return hardnegatives.mine(rows, key % 50 == 0)


OP13_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT doc_id, line, i, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), '')) AS kept_sha256 FROM k LEFT JOIN c USING (key) GROUP BY doc_id
"""

#: Groups of files that operator 13 takes as batches.
LINE_BATCHES = 4


@query("op13_line_dedup", OP13_SQL)
def op13_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from briefwright.llm import linededup

    docs = table(spark, sf, "documents")
    files = sorted(docs.inputFiles())
    batches = [spark.read.schema(docs.schema).parquet(*files[i::LINE_BATCHES]) for i in range(min(LINE_BATCHES, len(files)))]
    return linededup.dedup_lines(docs, batches).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("pipeline")
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
