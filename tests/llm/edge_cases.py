"""Rows that every operator on texts must bear: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import public_tokenizers

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = "alpha beta gamma delta epsilon " * 4000 + "end"
TEXTS = [(1, "The quick brown fox jumps over the lazy dog and runs away from here."), (2, ""), (3, None), (4, "  \n\t "), (5, "!!! ???"), (6, LONG),
         (7, "x" * 30_000), (8, "Größe über Ñandú — naïve 日本語 😀"), (8, "Größe über Ñandú — naïve 日本語 😀"), (9, "one"), (None, "a text without an id but with enough words in it"), (None, None)]
SCHEMA = "doc_id long, text string, id string, h string, c string, n string, score string, n_links string, words string, path string"


def documents(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "id", "h", "c", "n", "s", "l", "w", "p") for i, t in rows], SCHEMA)


def nothing(spark):
    return documents(spark, TEXTS).where("false")
