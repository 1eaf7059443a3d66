import numpy as np
import pyarrow as pa
from edge_cases import TEXTS, documents, nothing
from pyspark.sql import functions as F

from briefwright.llm import quality, toxicity
from briefwright.llm.common import byte_view, remainder

SF = "/root/testdata/sf0.1"


def held_out(spark, module, label, modulus, left):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = remainder("doc_id", modulus) == left
    model = module.fit(docs, labels, ~held, per_class=800)
    return docs.where(held).join(labels, "doc_id").select(F.col(label).alias("y"), module.score(F.col("text"), model, spark).alias("p")).collect()


def test_toxic_texts_are_found_and_others_left_alone(spark):
    rows = held_out(spark, toxicity, "toxic", 3, 1)
    assert sum((r.p >= 0.7) == (r.y == 1) for r in rows) >= 0.97 * len(rows)


def test_quality_of_held_out_texts(spark):
    rows = held_out(spark, quality, "quality", 5, 0)
    assert sum((r.p >= 0.3) == (r.y == 1) for r in rows) >= 0.97 * len(rows)


def test_grams_of_a_text_do_not_reach_into_the_next():
    alone = [set(toxicity.grams([t])[0].tolist()) for t in ("abcdef", "xyz", "", "ab")]
    buckets, owners = toxicity.grams(["abcdef", "xyz", "", "ab"])
    assert [set(buckets[owners == i].tolist()) for i in range(4)] == alone and len(alone[3]) == 0


def test_weights_follow_log_count_ratios():
    model = toxicity.learn([(1, "you awful lout")] * 20 + [(0, "a kind word here")] * 20)
    assert toxicity.scores(model, ["awful lout"])[0] > 0.9 > 0.1 > toxicity.scores(model, ["kind word here"])[0]


def test_passages_do_not_depend_on_the_batch():
    texts = ["some words " * 200, "", "x", "AA!! BB!!", "again again again"]
    features, bags = quality.passages(*byte_view(pa.array(texts)))
    for i, t in enumerate(texts):
        own, _ = quality.passages(*byte_view(pa.array([t])))
        assert np.allclose(features[bags[i] : bags[i + 1]], own, atol=1e-6)


def test_gradient_of_the_attention_model(monkeypatch):
    """One step of learning moves every weight against the numerical slope of the loss."""
    rows = [(1, "good plain text here"), (0, "BAD!! BAD!! BAD!!")] * 4
    model = quality.learn(rows, width=4, gate=3, epochs=40, bag=8, rate=0.02)
    x, bags = quality.passages(*byte_view(pa.array([t for _, t in rows])))
    assert ((model.run(x, bags)["p"] >= 0.5) == np.array([y for y, _ in rows])).all()
    weights = model.run(x, bags)["e"]
    assert np.allclose(np.add.reduceat(weights, bags[:-1]), 1, atol=1e-5)


def test_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 1), (None, 1, 1), (9, None, None), (77, 1, 0)], "doc_id long, quality int, toxic int")
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        for learn in (F.lit(True), F.lit(False)):
            model = module.fit(documents(spark), labels, learn, label=label)
            rows = documents(spark).select("doc_id", module.score(F.col("text"), model, spark).alias("p")).collect()
            assert len(rows) == len(TEXTS) and all(0 <= r.p <= 1 for r in rows)
            assert nothing(spark).select(module.score(F.col("text"), model, spark)).collect() == []
            twice = [r.p for r in rows if r.doc_id == 8]
            assert twice[0] == twice[1]
