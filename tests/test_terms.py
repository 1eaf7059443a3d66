"""Terms found by one automaton or by joins, against a loop."""

import random

from pyspark.sql import functions as F

from briefwright.lexicon import Lexicon, TermFinder, lexicon_hits
from briefwright.operators import registry as R

TERMS = ["ai", "api", "open api", "gpt-5", "大模型", "模型", "a", "pen", "open", "..", "z" * 40, "\U0001f600"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice([*TERMS, " ", "-", "x", "openai", "模", "é"]) for _ in range(rng.randrange(12))) for _ in range(n)]


def test_the_automaton_finds_what_contains_finds(spark):
    rows = [(i, t) for i, t in enumerate([*texts(300), "", None])]
    finder = TermFinder(TERMS, {"ia": ["back ai", "ai"], "x": ["back x"]})
    df = spark.createDataFrame(rows, "id int, text string")
    got = df.select("id", finder.hits(F.col("text"), F.reverse("text")).alias("h")).select(
        "id", finder.count(F.col("h"), TERMS).alias("n"), finder.any(F.col("h"), ["api", "模型"]).alias("some"), finder.count(F.col("h"), ["back ai", "back x"]).alias("other")).collect()
    for r in got:
        text = rows[r.id][1] or ""
        assert (r.n, r.some, r.other) == (sum(t in text or (t == "ai" and "ai" in text) for t in TERMS), "api" in text or "模型" in text, ("ai" in text) + ("x" in text))


def test_a_table_of_many_terms(spark):
    rng = random.Random(2)
    many = [("big", f"{rng.choice('abcdef')}{k:05d}") for k in range(100_000)] + [("small", t) for t in TERMS] + [("small", ""), ("small", "ai"), ("big", "ai")]
    rows = [(i, t + " " + " ".join(rng.choice(many)[1] for _ in range(4))) for i, t in enumerate(texts(60, 3))] + [(100, ""), (101, None), (None, "open api")]
    table = spark.createDataFrame(many, "group string, term string")
    got = {(r.item_id, r.group): r.hits for r in lexicon_hits(spark.createDataFrame(rows, "item_id int, text string"), table).collect()}
    by_group = {g: {t for h, t in many if h == g and t} for g in ("big", "small")}
    want = {(i, g): n for i, t in rows for g, terms in by_group.items() if (n := sum(x in (t or "") for x in terms))}
    assert got == want
    try:
        Lexicon.from_table(table)
    except ValueError as error:
        assert "lexicon_hits" in str(error)


def test_a_registry_of_any_size_gives_the_weights_of_the_small_one(spark):
    rng = random.Random(4)
    keys = ["github.com", "openai.com", "openai", "reddit.com", "example.org", "reddit"]
    weights = [(k, round(rng.random() * 3, 2)) for k in keys] + [(f"host{k}.example", 1.5) for k in range(500)]
    items = [(i, rng.choice(["openai", "reddit", "github", "other", None]), rng.choice(["", None, "https://openai.com/x", "https://www.reddit.com/r/a", "https://host7.example/1", "https://nobody.example"])) for i in range(120)]
    df, table = spark.createDataFrame(items, "item_id int, source string, url string"), spark.createDataFrame(weights, "key string, weight double")
    small = R.Registry(weights={k: v for k, v in weights})
    want = {r.item_id: r.w for r in df.select("item_id", small.weight(F.col("source"), F.col("url")).alias("w")).collect()}
    assert {r.item_id: r.weight for r in R.weights_by_join(df, table, small.default_weight).collect()} == want
