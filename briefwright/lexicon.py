"""Lexicon argument of the rules: default word lists, overlaid by the user's (group, term) rows.

Rules with many terms look them up with one automaton (``TermFinder``): a text is read once, whatever the number of terms and groups.
A table of any number of terms is joined (``lexicon_hits``).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from briefwright.lexicons import TERMS, TOPIC_KEYWORDS


@dataclass(frozen=True)
class Lexicon:
    groups: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {name: tuple(terms) for name, terms in TERMS.items()}
    )
    topics: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {name: tuple(terms) for name, terms in TOPIC_KEYWORDS.items()}
    )

    def __getitem__(self, group: str) -> tuple[str, ...]:
        return self.groups[group]

    def replace(self, **groups: Iterable[str]) -> "Lexicon":
        merged = dict(self.groups)
        merged.update({name: tuple(dict.fromkeys(terms)) for name, terms in groups.items()})
        return Lexicon(merged, self.topics)

    @classmethod
    def from_table(cls, table: DataFrame, max_terms: int = 20_000) -> "Lexicon":
        """Overlay the defaults with a (group, term) table. The table is a dimension: its size is checked
        before it is read to the driver, where it becomes literals of the plan. A larger table stays a table: ``lexicon_hits`` finds
        its terms by joins, with the same hits."""
        rows = table.select("group", "term").distinct().limit(max_terms + 1).collect()
        if len(rows) > max_terms:
            raise ValueError(f"lexicon table has more than {max_terms} terms; lexicon_hits takes tables of any size")
        found: dict[str, list[str]] = {}
        for row in rows:
            found.setdefault(row["group"], []).append(row["term"])
        return cls().replace(**{name: sorted(terms) for name, terms in found.items()})


def constant(value, ddl: str) -> Column:
    """A constant of any type as one literal that Catalyst folds; keeps plans of large lists small."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), ddl)


def term_array(terms: Iterable[str]) -> Column:
    """A constant array of strings."""
    terms = list(terms)
    if not terms:
        return F.expr("cast(array() as array<string>)")
    return F.split(F.lit("\u0001".join(terms)), "\u0001")


def constant_map(mapping: Mapping[str, object], kind: str = "string") -> Column:
    return constant(dict(mapping), f"map<string,{kind}>")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row. An expression used inside a lambda is evaluated
    for every element; as the only element of an array it is evaluated once and passed on by name."""
    return F.element_at(F.transform(F.array(value), body), 1)


def substring_hits(text: Column, terms: Iterable[str]) -> Column:
    """Number of distinct terms that occur anywhere in the text (no word boundaries)."""
    return let(text, lambda t: F.size(F.filter(term_array(terms), lambda term: t.contains(term))))


def any_substring(text: Column, terms: Iterable[str]) -> Column:
    return let(text, lambda t: F.exists(term_array(terms), lambda term: t.contains(term)))


def token_hits(tokens: Column, terms: Iterable[str]) -> Column:
    """Number of distinct terms that are members of the token set."""
    return F.size(F.array_intersect(tokens, term_array(terms)))


# --- many terms at once -----------------------------------------------------------------------------------

# The white space of Unicode other than the space, and the light punctuation that the compact form of a text drops.
WHITE = "\t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LIGHT = "_-:：/·.'\"“”‘’「」"


def one_line(text: str) -> str:
    """Runs of white space become one space. Whole-text replacements are several times faster than a pattern."""
    for ch in WHITE:
        text = text.replace(ch, " ")
    while "  " in text:
        text = text.replace("  ", " ")
    return text


def compact_line(line: str) -> str:
    """A text on one line, without spaces and light punctuation."""
    for ch in " " + LIGHT:
        line = line.replace(ch, "")
    return line


@lru_cache(maxsize=16)
def _automaton(words: tuple[tuple[str, tuple[int, ...]], ...]):
    import ahocorasick

    out = ahocorasick.Automaton()
    for word, numbers in words:
        out.add_word(word, numbers)
    out.make_automaton()
    return out


class TermFinder:
    """Numbers terms, and finds which of them a text holds: an automaton over all terms reads the text once, in Arrow batches. A term
    counts wherever it stands, also inside a word or another term. ``forms`` are words of a second text, each with the terms that it stands for."""

    def __init__(self, terms: Iterable[str], forms: Mapping[str, Iterable[str]] | None = None):
        own, forms = sorted({t for t in terms if t}), {w: sorted(set(t)) for w, t in (forms or {}).items() if w}
        self.number = {t: i for i, t in enumerate(sorted({*own, *[t for some in forms.values() for t in some]}))}
        self.words = [tuple((t, (self.number[t],)) for t in own), tuple((w, tuple(self.number[t] for t in some)) for w, some in sorted(forms.items()))]

    def hits(self, text: Column, second: Column | None = None) -> Column:
        """array<int>: the numbers of the terms that are in the text, or have a form in the second one; each once."""
        words = self.words

        def search(columns: list[pa.Array]) -> pa.Array:
            out: list[set[int]] = [set() for _ in range(len(columns[0]))]
            for some, column in zip(words, columns, strict=False):
                if not some:
                    continue
                find = _automaton(some).iter
                for found, value in zip(out, column.to_pylist(), strict=True):
                    if value:
                        for _, numbers in find(value):
                            found.update(numbers)
            return pa.array([sorted(x) for x in out], pa.list_(pa.int32()))

        def one(a: pa.Array) -> pa.Array:
            return search([a])

        def two(a: pa.Array, b: pa.Array) -> pa.Array:
            return search([a, b])

        return arrow_udf(one, "array<int>")(text) if second is None else arrow_udf(two, "array<int>")(text, second)

    def hits_in_line(self, text: Column) -> Column:
        """As ``hits`` of the lower-case text on one line, with its compact form as the second text."""
        words = self.words

        def line(column: pa.Array) -> pa.Array:
            find = [_automaton(some).iter if some else None for some in words]
            out = []
            for value in column.to_pylist():
                found: set[int] = set()
                flat = one_line(value or "")
                for search, form in zip(find, (flat, compact_line(flat)), strict=True):
                    if search and form:
                        for _, numbers in search(form):
                            found.update(numbers)
                out.append(sorted(found))
            return pa.array(out, pa.list_(pa.int32()))

        return arrow_udf(line, "array<int>")(text)

    def numbers(self, terms: Iterable[str]) -> Column:
        return constant([self.number[t] for t in dict.fromkeys(terms) if t], "array<int>")

    def count(self, hits: Column, terms: Iterable[str]) -> Column:
        """Number of distinct terms among the hits."""
        return F.size(F.array_intersect(hits, self.numbers(terms)))

    def any(self, hits: Column, terms: Iterable[str]) -> Column:
        return F.arrays_overlap(hits, self.numbers(terms))


def lexicon_hits(texts: DataFrame, table: DataFrame, id_col: str = "item_id", text_col: str = "text", gram: int = 4) -> DataFrame:
    """(id, group, hits): how many distinct terms of each group of a (group, term) table of any size are in each text, for those that hold
    any. The first ``gram`` characters of a term (all of a shorter one) are its key; the distinct runs of so many characters of the texts are joined
    with the keys, and what meets is searched in the text. Empty terms count for nothing; a repeated id counts once per text."""
    rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text <> ''").withColumn("h", F.xxhash64("text"))
    terms = table.select("group", "term").where("term <> ''").distinct().withColumn("key", F.substring("term", 1, gram))
    sizes = F.array(*[F.lit(n) for n in range(1, gram + 1)])
    runs = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("text") - n + 1)), lambda i: F.substr("text", i, n))
    grams = rows.select("id", "h", F.explode(F.array_distinct(F.flatten(F.transform(sizes, runs)))).alias("key"))
    met = grams.join(terms, "key").select(F.col("id").alias("of"), F.col("h").alias("of_h"), "group", "term")
    both = rows.join(met, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")))
    found = both.where(F.contains("text", "term")).select("id", "h", "group", "term").distinct()
    return found.groupBy("id", "h", "group").agg(F.count(F.lit(1)).cast("int").alias("hits")).select(F.col("id").alias(id_col), "group", "hits")
