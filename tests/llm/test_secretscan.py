import random
import re
import string

from edge_cases import TEXTS, documents, nothing
from pyspark.sql import functions as F

from briefwright.llm import secretscan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_pattern_spans_are_those_of_a_plain_search(spark):
    rng = random.Random(5)
    bits = ["password", "PassWd", "token", "api_key", "APIKEY", "secret", "=", ":", " = ", "\"", "'", "abc", "abcdef12", "a1" * 12, "AKIA", "AKIA" + "Z9" * 9, "é", "😀", " ", "\n", "token=token", ".x-y_z/="]
    docs = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 25)))) for i in range(400)] + [(1000 + i, t) for i, (_, t) in enumerate(TEXTS)]
    rows = secretscan.scan(documents(spark, docs)).collect()
    texts = dict(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert [tuple(x) for x in r.base] == brute(texts[r.doc_id]), texts[r.doc_id]
        assert {tuple(x) for x in r.base} <= {tuple(x) for x in r.spans}


def test_random_runs_pass_and_words_do_not(spark):
    rng = random.Random(6)
    alphabets = [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", "0123456789ABCDEF"]
    keys = ["".join(rng.choice(a) for _ in range(n)) for a in alphabets for n in (40, 48, 64) for _ in range(30)]
    words = ["".join(rng.choice(["the", "Tion", "er", "ing", "and", "Re", "ed", "es", "20", "in"]) for _ in range(20)) for _ in range(200)]
    words += ["getElementByIdFromTheDocument1", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaB1", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789ABCDEF" * 3]
    docs = [(i, f"see {t} there") for i, t in enumerate(keys + words)]
    rows = secretscan.scan(documents(spark, docs)).select("doc_id", F.size(F.filter("spans", lambda x: x["k"] == 3)).alias("n")).collect()
    flagged = {r.doc_id for r in rows if r.n}
    assert len(flagged & set(range(len(keys)))) >= 0.85 * len(keys) and len([i for i in flagged if i >= len(keys)]) <= 4


def test_the_battery_is_calibrated(spark):
    rng = random.Random(7)
    runs = [("".join(rng.choice(string.ascii_letters + string.digits) for _ in range(60)),) for _ in range(1500)]
    tested = secretscan.battery(spark.createDataFrame(runs, "v string")).collect()
    for p in ("p_chi", "p_runs", "p_serial", "p"):
        below = sum(r[p] < 0.1 for r in tested) / len(tested)
        assert 0.05 < below < 0.17, (p, below)


def test_values_after_names_and_keys_of_short_alphabets_are_judged(spark):
    rng = random.Random(8)
    base64, base32, base36 = string.ascii_letters + string.digits + "+/", string.ascii_uppercase + "234567", string.digits + string.ascii_lowercase
    shapes = [("AWS_SECRET_ACCESS_KEY=", base64, 40, ""), ("AccountKey=", base64, 86, "=="), ("see ", base32, 32, ""), ("seed=", base32, 32, ""), ("key=", base36, 40, ""), ("see ", "0123456789abcdef", 22, "")]
    docs, want = [], {}
    for k, (name, alphabet, n, pad) in enumerate(shapes):
        for i in range(40):
            value = "".join(rng.choice(alphabet) for _ in range(n)) + pad
            docs.append((100 * k + i, f"{name}{value} there"))
            want[100 * k + i] = (len(name), 3, len(name) + len(value))
    words = ["".join(rng.choice(["the", "tion", "er", "ing", "and", "re", "ed", "es", "20", "in"]) for _ in range(n)) for n in (9, 13) for _ in range(100)]
    docs += [(1000 + i, f"see {w} and name={w.upper()} there") for i, w in enumerate(words)]
    found = {r.doc_id: [tuple(x) for x in r.spans] for r in secretscan.scan(documents(spark, docs)).collect()}
    for k in range(len(shapes)):
        assert sum(want[100 * k + i] in found[100 * k + i] for i in range(40)) >= 34, shapes[k]
    assert sum(len(found[1000 + i]) for i in range(len(words))) <= 8


def passed(spark, rows):
    return {r.v for r in secretscan.passing(spark.createDataFrame(rows, "encoding string, n int, v string, p double")).collect()}


def test_lone_keys_pass_and_copies_count_once(spark):
    assert passed(spark, [("base62", 40, "a", 0.3), ("base64", 40, "b", 0.06), ("base64", 90, "c", 1e-9)]) == {"a", "b"}
    keys = [("base62", 40, f"k{i}", (i + 0.5) / 100) for i in range(100)]
    words = [("base62", 40, f"w{i}", 0.003 + 0.0001 * i) for i in range(400)]
    alone = passed(spark, keys + words)
    assert {f"k{i}" for i in range(5, 100)} <= alone and len([v for v in alone if v[0] == "w"]) <= 25
    for p in (0.3, 0.7):
        assert passed(spark, keys + words + [("base62", 40, "copy", p)] * 2000) - {"copy"} == alone
    many = [("base36", 20, f"w{i}", 0.1 * i / 1000) for i in range(1000)]  # no random run among them
    assert len(passed(spark, many)) <= 5
    rng = random.Random(12)
    one = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40))
    rows = secretscan.scan(documents(spark, [(1, f"see {one} there"), *[(i, f"again {one}") for i in range(2, 60)]])).collect()
    assert all(len(r.spans) == 1 for r in rows)


def test_masking_keeps_rows_and_columns(spark):
    rows = [(1, "a password=hunter22 b AKIA" + "Z" * 16 + " c"), (1, "a password=hunter22 b AKIA" + "Z" * 16 + " c"), (2, "token: " + "a" * 30), (3, "clean"), (None, "secret=abcdefg!"), (4, None)]
    out = secretscan.masked(documents(spark, rows))
    assert out.columns == documents(spark).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == sorted([(1, "a <secret> b <secret> c")] * 2 + [(2, "<secret>"), (3, "clean"), (0, "<secret>!"), (4, "")])


def test_edge_cases(spark):
    rows = secretscan.scan(documents(spark)).collect()
    assert len(rows) == len(TEXTS) and not any(r.spans for r in rows)
    assert secretscan.scan(nothing(spark)).collect() == []
    many = secretscan.scan(documents(spark, [(1, "token=abcdef1 " * 3000)])).first()
    assert len(many.base) == 3000 and tuple(many.base[-1]) == (14 * 2999, 0, 14 * 2999 + 13)


def test_time_and_results_of_many_spans_in_one_text(spark):
    import time

    took = []
    for n in (10_000, 100_000):
        text = "".join(f"{i % 10}{'0a1b2c3d' * 3} {'é' * (i % 3)}" for i in range(n))
        docs = documents(spark, [(1, text)]).repartition(1)
        start = time.time()
        row = secretscan.scan(docs).first()
        took.append(time.time() - start)
        assert [tuple(x) for x in row.base] == brute(text) and len(row.base) == n
        start = time.time()
        out = secretscan.masked(docs).first().text
        took.append(time.time() - start)
        assert out == "".join(f"<secret> {'é' * (i % 3)}" for i in range(n))
    print(took)
    assert took[2] < 40 and took[3] < 60


def test_random_runs_beside_pattern_spans(spark):
    rng = random.Random(3)
    cases = []
    for _ in range(300):
        base = sorted((s := rng.randrange(60), rng.randrange(3), s + rng.randrange(1, 9)) for _ in range(rng.randrange(6)))
        cuts = sorted(rng.sample(range(70), 2 * rng.randrange(1, 5)))
        extra = [(s, 3, e) for s, e in zip(cuts[::2], cuts[1::2], strict=True)]
        cases.append((base, extra, sorted(base + [x for x in extra if not any(b[0] < x[2] and x[0] < b[2] for b in base)])))
    rows = spark.createDataFrame([(i, b, x) for i, (b, x, _) in enumerate(cases)], "i int, base array<struct<s:int,k:int,e:int>>, extra array<struct<s:int,k:int,e:int>>")
    for r in rows.select("i", secretscan._with_extra(F.col("base"), F.col("extra")).alias("got")).collect():
        assert [tuple(x) for x in r.got] == cases[r.i][2], cases[r.i]
