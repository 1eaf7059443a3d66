"""Operator 4: secret scans. Built-in functions only.

Fixed patterns find assignments to password-like names, access keys and long lower-case hex runs. Beside them, a battery of tests
asks of every long run of key characters whether it looks drawn at random from its alphabet, the smallest of the usual encodings
that holds it: chi-squared for equal shares of the symbols, runs above and below the middle of the alphabet, and correlation of
neighbours. The three p-values are joined by Fisher's method.

Ordinary words must not pass for random ones. Among the different runs of one encoding and length band (copies count once), random
ones have p-values that are spread evenly, so those above one half tell how many there are; the cut is the smallest at which the
surplus of passing runs over that number, the expected false discoveries, is at most ``FDR``, give or take the error of that number.
Where it rests on few runs, up to ``FEW`` may be surplus, but they need a p-value of ``LEVEL``; so a lone random run passes.
The runs are counted in bins before that, so the state is a few numbers per band.

Cases: null texts count as empty and have no spans; places are code points, ends exclusive; repeated rows and ids are each answered, ids
may be null; long texts are whole; other columns are ignored. A random run that meets a span of the patterns adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from briefwright.llm.common import column, identified, stage, with_rows

#: Fixed patterns, and the order of kinds. "Letters in either case" holds for the names only.
NAMES = ["password", "passwd", "secret", "token"]
_either = lambda word: "".join(f"[{c.upper()}{c}]" for c in word)
ASSIGN = rf"(?:{'|'.join(map(_either, NAMES))}|{_either('api')}_?{_either('key')})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Runs that are too short are left out; as both run to the end of their alphabet, asking for the length finds the same ones.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]

#: '=' only pads the end of a run; after a name it stands between two runs.
RUN = r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?"
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings: name, what a run must be, and its alphabet in the order of its values.
ENCODINGS = [
    ("hex", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", _DIGITS + "abcdef"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", _UPPER + "234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", _DIGITS + _LOWER),
    ("base36", r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", _DIGITS + _UPPER),
    ("base62", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$", _UPPER + _LOWER + _DIGITS),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_"),
]
FDR = 0.05
BINS = 200
#: In a band whose count of random runs is within ``FEW`` of none: how many may pass beyond it, and the p-value they need.
FEW, LEVEL = 4.0, 0.05


def _found(text: Column, pattern: str, group: int) -> tuple[Column, Column]:
    """Texts between the matches, and the matches (or a group of each)."""
    return F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Items of an array that are taken in one go: lists of so many numbers are copied once per item, and a list with one number per block once per block.
FOLD = 256


def _before(items: Column, at: Column, advance) -> Column:
    """array<int>: the state before each item, which ``advance`` takes from item to item. Only numbers are gathered, in blocks, as
    Spark copies the state of an aggregate with each item."""
    def gather(x: Column, start: Column, step) -> Column:
        first = F.struct(start.alias("at"), F.array().cast("array<int>").alias("list"))
        return F.aggregate(x, first, lambda s, v: F.struct(step(s["at"], v).alias("at"), F.concat(s["list"], F.array(s["at"])).alias("list")), lambda s: s["list"])

    def gathered(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / FOLD).cast("int")), lambda i: F.slice(x, i * FOLD + 1, F.lit(FOLD)))
        starts = lambda b: gather(b, at, lambda a, block: F.aggregate(block, a, advance))
        return _let(blocks, lambda b: _let(starts(b), lambda first: F.flatten(F.transform(b, lambda block, i: gather(block, F.get(first, i), advance)))))

    return F.when(F.size(items) > 0, gathered(items)).otherwise(F.array().cast("array<int>"))


def _with_state(items: Column, at: Column, advance, give) -> Column:
    """``give`` (state before, item) of all items, without nulls."""
    return _let(items, lambda x: _let(_before(x, at, advance), lambda states: F.filter(F.transform(x, lambda v, i: give(F.get(states, i), v)), lambda v: v.isNotNull())))


def spans(text: Column, pattern: str, value: int | None = None, least: int = 0) -> Column:
    """array<struct<s, e, v>>: places and texts of all matches, leftmost first and apart; those whose group ``value`` has fewer
    than ``least`` characters are dropped."""
    between, whole = _found(text, pattern, 0)
    kept = F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else whole
    length = lambda c: F.coalesce(F.length(c), F.lit(0))
    # the last gap has no match: its row has null as match and gives nothing
    pieces = F.arrays_zip(between.alias("gap"), whole.alias("m"), kept.alias("v"))
    one = lambda at, p: F.struct((at + length(p["gap"])).alias("s"), (at + length(p["gap"]) + length(p["m"])).alias("e"), p["v"].alias("v"))
    found = _with_state(pieces, F.lit(0), lambda at, p: at + length(p["gap"]) + length(p["m"]), lambda at, p: F.when(F.length(p["v"]) >= least, one(at, p)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<s:int,e:int,v:string>>"))


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e>> of the patterns' matches, in order of place and kind (k: place in ``KINDS``)."""
    of = lambda found, k: F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))
    return F.array_sort(F.concat(of(spans(text, ASSIGN, 1, 6), 0), of(spans(text, ACCESS), 1), of(spans(text, HEX), 2)))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a normal variable, by a rational approximation (error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(runs: DataFrame) -> DataFrame:
    """``runs`` (with a column v) whose alphabet is known, with encoding, n and p."""
    encoding = F.coalesce(*[F.when(F.col("v").rlike(shape), F.struct(F.lit(name).alias("encoding"), F.lit(alphabet).alias("alphabet"))) for name, shape, alphabet in ENCODINGS])
    known = runs.withColumn("x", encoding).where(F.col("x").isNotNull()).select("*", "x.*").drop("x")
    known = known.withColumn("body", F.regexp_replace("v", "=+$", "")).withColumns({"n": F.length("body"), "a": F.length("alphabet").cast("double")})
    chars = F.split("body", "")
    values = known.withColumn("c", chars).withColumn("i", F.transform("c", lambda c: F.instr(F.col("alphabet"), c) - 1))
    n, a = F.col("n").cast("double"), F.col("a")
    squares = F.aggregate(F.array_distinct("c"), F.lit(0.0), lambda s, c: s + F.pow((F.length("body") - F.length(F.replace(F.col("body"), c, F.lit("")))).cast("double"), F.lit(2.0)))
    pairs = F.arrays_zip(F.slice("i", F.lit(1), F.col("n") - 1).alias("x"), F.slice("i", F.lit(2), F.col("n") - 1).alias("y"))
    half, mean, var = a / 2, (a - 1) / 2, (a * a - 1) / 12
    changes = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.when((p["x"] < half) != (p["y"] < half), 1.0).otherwise(0.0))
    products = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["x"] - mean) * (p["y"] - mean))
    stats = values.withColumns({"q": squares, "changes": changes, "products": products}).drop("c", "i")
    df = a - 1
    chi = a / n * F.col("q") - n
    zs = {"z_chi": (F.pow(F.greatest(chi, F.lit(1e-9)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)),
          "z_runs": (F.col("changes") - (n - 1) / 2) / F.sqrt((n - 1) / 4), "z_serial": F.col("products") / (var * F.sqrt(n - 1))}
    tested = stats.withColumns(zs)
    least = lambda p: F.greatest(p, F.lit(1e-300))
    ps = tested.withColumns({"p_chi": least(_upper_tail(F.col("z_chi"))), "p_runs": least(F.least(F.lit(1.0), 2 * _upper_tail(F.abs("z_runs")))),
                             "p_serial": least(F.least(F.lit(1.0), 2 * _upper_tail(F.abs("z_serial"))))})
    half_sum = -(F.log("p_chi") + F.log("p_runs") + F.log("p_serial"))
    return ps.withColumn("w", half_sum).withColumn("p", F.exp(-F.col("w")) * (1 + F.col("w") + F.col("w") * F.col("w") / 2)).drop("body", "a", "alphabet", "q", "changes", "products", "w")


def passing(tested: DataFrame, fdr: float = FDR) -> DataFrame:
    """The tested runs that pass for random, the share of ordinary ones among them being held per encoding and length band."""
    banded = tested.withColumns({"band": F.floor(F.log2("n") * 2).cast("int"), "bin": F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int")})
    from pyspark.sql import Window

    different = banded.select("encoding", "band", "bin", "v").distinct()
    counts = different.groupBy("encoding", "band", "bin").agg(F.count("*").alias("m"))  # a few hundred numbers per band
    up = Window.partitionBy("encoding", "band").orderBy(F.col("bin").desc())
    all_of = Window.partitionBy("encoding", "band")
    upper = F.sum(F.when(F.col("bin") >= BINS // 2, F.col("m")).otherwise(0)).over(all_of) * 2.0
    above = counts.withColumns({"above": F.sum("m").over(up), "random": upper})
    surplus = F.col("above") - F.col("random") * (1 - F.col("bin") / BINS)
    sure = F.sqrt("random") >= FEW
    held = surplus <= fdr * F.col("above") + F.greatest(F.sqrt("random"), F.lit(FEW))
    cut = above.where(held & (sure | (F.col("bin") >= int(LEVEL * BINS)))).groupBy("encoding", "band").agg(F.min("bin").alias("cut"))
    # the lowest bin holds what is surely not random; it never passes
    return banded.join(cut, ["encoding", "band"]).where((F.col("bin") >= F.col("cut")) & (F.col("bin") > 0)).drop("band", "bin", "cut")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, h (hash of the text), base and all: array<struct<s, k, e>> of the patterns, and with the random runs."""
    text = F.coalesce(column(text_col), F.lit(""))
    d = docs.select(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("h"), text.alias("text"))
    base = d.select("id", "h", base_spans(F.col("text")).alias("base"))
    runs = d.where(F.col("text").rlike(RUN)).select("id", "h", F.explode(spans(F.col("text"), RUN)).alias("x")).select("id", "h", "x.*").distinct()
    random = passing(stage(battery(runs))).groupBy("id", "h").agg(F.collect_list(F.struct("s", F.lit(3).alias("k"), "e")).alias("extra"))
    joined = with_rows(base, random)
    return joined.select("id", "h", "base", F.when(F.col("extra").isNull(), F.col("base")).otherwise(_with_extra(F.col("base"), F.col("extra"))).alias("spans")).withColumnRenamed("id", id_col)


def _with_extra(base: Column, extra: Column) -> Column:
    """The base spans and those of the others that meet none, in order: one way from the left, which knows how far the base spans reach, and
    one from the right, which knows where the next one begins."""
    is_base = lambda x: x["k"] < 3
    left = _with_state(F.array_sort(F.concat(base, extra)), F.lit(0), lambda at, x: F.when(is_base(x), F.greatest(at, x["e"])).otherwise(at),
                       lambda at, x: F.when(is_base(x) | (x["s"] >= at), x))
    return F.reverse(_with_state(F.reverse(left), F.lit(2**31 - 1), lambda at, x: F.when(is_base(x), x["s"]).otherwise(at), lambda at, x: F.when(is_base(x) | (x["e"] <= at), x)))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


#: Characters of a block of a text that is cut at many places.
BLOCK = 1024


def _masked(text: Column, spans: Column, mark: str) -> Column:
    """A text whose spans are replaced; a span that begins inside the last one only lengthens it. The text is taken in blocks, so that a place far
    behind is not counted out from its beginning."""
    gaps = _with_state(spans, F.lit(0), lambda at, x: F.greatest(at, x["e"]), lambda at, x: F.when(x["s"] >= at, F.struct(at.alias("a"), x["s"].alias("b"))))
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def piece(parts: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / BLOCK).cast("int")
        here = F.array_join(F.slice(parts, first + 1, F.floor(b / BLOCK).cast("int") - first + 1), "")
        return F.substring(here, a - first * BLOCK + 1, b - a)

    pieces = _let(blocks, lambda parts: F.transform(gaps, lambda g: piece(parts, g["a"], g["b"])))
    last = _let(blocks, lambda parts: piece(parts, F.aggregate(spans, F.lit(0), lambda m, x: F.greatest(m, x["e"])), F.length(text)))
    return F.concat(F.array_join(pieces, mark), F.lit(mark), last)


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with all spans of its texts replaced by ``mark``; all columns and rows stay."""
    found = scan(docs, id_col, text_col).select(column(id_col).alias("of"), F.col("h").alias("of_h"), "spans").where(F.size("spans") > 0).dropDuplicates(["of", "of_h"])
    joined = identified(docs, id_col, text_col).join(found, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left")
    out = joined.select("row", F.when(F.col("spans").isNull(), F.col("text")).otherwise(_masked(F.col("text"), F.col("spans"), mark)).alias("changed"))
    # fields are named by the type of the row, so no name of a column can clash
    return out.select(*[(F.col("changed") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
