"""The registered queries against their SQL, and the pipeline against its parts."""

import hashlib

import pytest
import sentencepiece
from check_oracle import compare, connect
from edge_cases import PIECES, TEXTS, documents
from test_decontamination import brute as contaminated
from test_ngramjoin import brute as groups
from test_secretscan import brute as secret_spans

import corpus_pipeline
from briefwright.llm import language, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    ok, message = compare(spark, connect(SF), SF, queries.QUERIES[name], queries.SQL[name])
    assert ok, message


def test_token_queries_equal_the_libraries(spark):
    from tokenizers import Tokenizer
    import zlib
    import numpy as np

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in queries.QUERIES["op7_sentencepiece"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    tokenizer, start = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json")), 0
    rows = sorted(queries.QUERIES["op9_token_files"](spark, SF).collect(), key=lambda r: r.doc_id)
    for r in rows:
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pipeline_equals_its_parts_by_brute_force(spark):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = {r.doc_id for r in corpus_pipeline.languages(spark, docs, SF).collect()}
    assert len(known) >= 0.97 * len(rows)
    left = sorted((i, rows[i].text) for i in known)
    first = [i for i, c, _ in groups(left) if i == c]
    kept = [i for i in first if not contaminated(rows[i].text, items)[1]]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def masked(text):
        out, at = "", 0
        for s, _, e in secret_spans(text):
            out += text[at:s] + "<secret>" if s >= at else ""
            at = max(at, e)
        return out + text[at:]

    want = {i: len(library.encode(masked(rows[i].text), add_bos=True, add_eos=True)) for i in kept}
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_bear_all_rows_and_keep_columns(spark):
    from pyspark.sql import functions as F

    docs = documents(spark).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for rows in (docs, docs.where("false")):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, rows, SF)
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= len(TEXTS)
    assert language.UNDETERMINED == "und"


NAMES = ["_id", "_h", "_spans", "_rows", "_links", "_language", "id", "h", "row", "of", "spans", "changed", "language", "bad_id", "kept_id", "a.b", "a`b", "c d"]


@pytest.mark.parametrize("names", [NAMES, ["_" + n for n in NAMES]])
def test_stages_keep_columns_of_any_name(spark, names):
    from pyspark.sql import functions as F

    rows = [(1, "The quick brown fox jumps over the lazy dog and runs away from here."), (1, "The quick brown fox jumps over the lazy dog and runs away from here."),
            (2, "Another text with a password=hunter22 in it, and enough plain words to see that it is written in English."), (None, "A row without an id whose words nobody else has, all of them plain English ones.")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.concat(F.lit(f"{k}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for k, n in enumerate(names)])
    for name, step in corpus_pipeline.STAGES[1:-1]:
        out = step(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert len(got) == (3 if name == "near_duplicates" else 4)
        for r in got:
            assert list(r)[5:] == [f"{k}:{'none' if r.doc_id is None else r.doc_id}" for k in range(len(names))], name
    assert any("<secret>" in r.text for r in corpus_pipeline.secrets(spark, docs, SF).collect())
    first = corpus_pipeline.languages(spark, docs, SF)
    assert first.columns == docs.columns and all(list(r)[5:] == [f"{k}:{'none' if r.doc_id is None else r.doc_id}" for k in range(len(names))] for r in first.collect())
    assert corpus_pipeline.tokens(spark, docs, SF).count() == 4
