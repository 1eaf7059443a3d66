"""Steps that do their work once: pages in batches, rules that read a text once, rows that are written before they are ranked."""

import pyarrow as pa
from pyspark.sql import functions as F

from briefwright.functions import markdown as M, text as T
from briefwright.lexicon import Lexicon, compact_line, one_line
from briefwright.operators import filters as O
from briefwright.plans import reports as P
from briefwright.sources import pages


def test_page_nodes_keep_keys_beside_a_null_key(spark):
    rows = spark.createDataFrame([(2**53 + 1, "<p>a <b>b</b></p>"), (None, "<p>c</p>"), (7, None), (8, "")], "page_id long, html string").coalesce(1)
    found = {(r.page_id, r.tag, r.text) for r in pages.page_nodes(rows).collect()}
    assert found == {(2**53 + 1, "p", "ab"), (2**53 + 1, "#text", "a"), (2**53 + 1, "b", "b"), (2**53 + 1, "#text", "b"), (None, "p", "c"), (None, "#text", "c")}


def test_page_nodes_come_in_batches_of_many_pages(spark):
    rows = spark.range(300).select(F.col("id").alias("page_id"), F.lit("<p>x</p>").alias("html")).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    found = pages.page_nodes(rows).mapInArrow(sizes, "n long").collect()
    assert sum(r.n for r in found) == 600 and len(found) < 10


def test_ad_words_are_looked_up_before_the_patterns(spark):
    assert O._plain_words(r"\b(sponsored|promoted)\b") == ["sponsored", "promoted"] and O._plain_words(r"#ad\b|#sponsored\b") == ["#ad", "#sponsored"]
    assert O._plain_words(r"\ba.b\b") is None and O._plain_words("été") is None
    texts = ["PROMO CODE here", "ſponsored", "promoted", "promotıon lİmited offer", "nothing", "", "限时优惠", "ponsored #ADs #ad", "a1b"]
    rows = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], "id int, title string, content string")
    found = [r.r for r in rows.select("id", O.ad_keyword_reason([r"\ba\db\b"]).alias("r")).orderBy("id").collect()]
    patterns = [*O.AD_PATTERNS, r"\ba\db\b"]
    plain = [f"concat('keyword_match: ', regexp_substr(concat(title, ' '), r'(?iu){p}'))" for p in patterns]
    assert found == [r.r for r in rows.select("id", F.expr(f"coalesce({', '.join(plain)})").alias("r")).orderBy("id").collect()]
    assert found[4] is None and found[1] == "keyword_match: ſponsored"


def test_one_line_and_compact_form_as_the_patterns(spark):
    texts = ["".join(chr(c) + "x" for c in range(1, 0x3100)), "a \t\n b　 c\x1c\x1dd", "  A_B-c: d：e/f·g.h'i\"j“k”l‘m’n「o」p  ", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.lower("t").alias("t"))
    for r in rows.select("t", F.regexp_replace("t", r"(?U)\s+", " ").alias("f")).select("t", "f", T.compact(F.col("f")).alias("c")).collect():
        assert one_line(r.t) == r.f and compact_line(r.f) == r.c



def test_stop_words_are_a_set(spark):
    rows = spark.createDataFrame([("The model2 of Spark and a.b x12 httpx 模型",)], "t string")
    for column in (T.keywords(F.col("t"), Lexicon()), T.report_keywords(F.col("t"), Lexicon())):
        assert "INSET" in rows.select(column)._jdf.queryExecution().optimizedPlan().toString()
    assert rows.select(T.keywords(F.col("t"), Lexicon()).alias("k")).first().k == ["model2", "Spark", "模型"]


def counted(spark, rows, column):
    """``rows`` with a column whose computation is counted."""
    calls = spark.sparkContext.accumulator(0)

    def one(value):
        calls.add(1)
        return value

    return rows.withColumn(column, F.udf(one, rows.schema[column].dataType)(column)), calls


def test_lines_of_a_chunk_read_their_rows_once(spark):
    rows = spark.range(40).select(
        (F.col("id") % 2).alias("chunk"), F.col("id").alias("ord"), F.concat(F.lit("t"), "id").alias("event_title"), F.lit("https://a.example").alias("url"),
        F.lit("s").alias("source"), (F.col("id") % 3).cast("string").alias("category"), F.lit("r").alias("reason"), F.lit("").alias("_run"), F.col("id").alias("event_rank"),
        F.lit(1.0).alias("score"), F.lit(1.0).alias("source_weight"), F.lit(False).alias("selected"), F.lit(None).cast("long").alias("selection_rank"), F.lit("e").alias("event_id"))
    rows, calls = counted(spark, rows, "event_title")
    assert P.numbered(P.chunk_lines(rows, ["chunk"]), ["chunk"]).count() > 40
    assert calls.value == 40


def test_labels_and_titles_of_links(spark):
    rows = spark.createDataFrame([(0, "[a] [b]", "https://x.example/a b"), (1, None, "https://x.example"), (2, "[]", "ftp://x"), (3, "\n- line\nnext", "")], "id int, t string, u string")
    found = [r.l for r in rows.select("id", M.item_link(F.col("t"), F.col("u")).alias("l")).orderBy("id").collect()]
    assert found == ["[a b](https://x.example/a%20b)", "[link](https://x.example)", "link", "line"]
