import random

import numpy as np
from edge_cases import PIECES, TEXTS, documents, nothing

from briefwright.llm import subwords


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_same_ids_and_text_as_the_library():
    model, rng = subwords.Pieces(PIECES), random.Random(1)
    letters = ["a", "b", "th", "e", "r", " ", "  ", "\n", ".", "é", "日", "▁", "😀", "\t", "1", "<s>", "\x00"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 120))) for _ in range(1500)] + [t or "" for _, t in TEXTS]
    want = model.library.encode(texts, add_bos=True, add_eos=True)
    got = [model.encode(t) for t in texts]
    assert [ids(i) for i, _ in got] == want
    assert [d.decode() for _, d in got] == [model.library.decode(w) for w in want]


def test_both_agendas_merge_alike():
    model, rng = subwords.Pieces(PIECES), random.Random(2)
    for _ in range(500):
        chunk = "▁" + "".join(rng.choice("etaoinshr.▁") for _ in range(rng.randrange(1, 80)))
        assert model._short(chunk) == model._long(chunk)


def test_any_ids_decode_as_in_the_library():
    model, rng = subwords.Pieces(PIECES), random.Random(3)
    for _ in range(3000):
        some = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randrange(0, 9))]
        assert model.decode(some) == model.library.decode(some)


def test_a_full_memory_changes_nothing(monkeypatch):
    model = subwords.Pieces(PIECES)
    want = [model.encode(t or "") for _, t in TEXTS]
    monkeypatch.setattr(subwords, "REMEMBERED", 2)
    assert [subwords.Pieces(PIECES).encode(t or "") for _, t in TEXTS] == want


def test_edge_cases(spark):
    rows = subwords.encode(documents(spark), PIECES, check=True).collect()
    assert len(rows) == len(TEXTS) and sorted(r.n_tokens for r in rows)[:3] == [2, 2, 2]
    back = {r.doc_id: r.text for r in subwords.decode(subwords.encode(documents(spark), PIECES), PIECES).collect() if r.doc_id}
    assert back[8] == TEXTS[7][1] and back[3] == "" and back[6] == TEXTS[5][1]
    assert subwords.digests(subwords.encode(nothing(spark), PIECES)).collect() == []


def test_every_batch_is_checked_with_the_library(monkeypatch):
    import pytest

    texts = [t or "" for _, t in TEXTS] + ["a  b\nc\n\nd   e", " lead", "trail ", "x\ty", "▁mark", "日本語\n日本語", "\n\n", "one\r\ntwo"]
    model = subwords.Pieces(PIECES)
    done = [model.encode(t) for t in texts]
    assert model.fresh
    model.check(texts, done)
    assert not model.fresh
    wrong = subwords.Pieces(PIECES)
    monkeypatch.setattr(wrong, "merged", lambda chunk: list(chunk))  # no merge at all
    done = [wrong.encode(t) for t in texts]
    with pytest.raises(ValueError, match="otherwise"):
        wrong.check(texts, done)


def test_a_memory_that_is_full_of_long_chunks_changes_nothing(monkeypatch):
    texts = ["日本語" * 400 + str(i) for i in range(20)] + [f"w{i} " + "é" * 40 + str(i) for i in range(300)]
    want = [subwords.Pieces(PIECES).encode(t) for t in texts]
    monkeypatch.setattr(subwords, "REMEMBERED_BYTES", 10_000)
    model = subwords.Pieces(PIECES)
    assert [model.encode(t) for t in texts] == want and model.used < 40_000


def test_agendas_of_many_chunks_merge_as_those_of_one():
    rng = random.Random(4)
    chunks = {"▁" + "".join(rng.choice("etaoinshrdlu.é日😀1\x07") for _ in range(rng.randrange(0, 60))) for _ in range(1500)}
    model, one = subwords.Pieces(PIECES), subwords.Pieces(PIECES)
    model.solve_many(list(chunks))
    assert model.tables and sorted(model.fresh) == sorted(chunks)
    assert model.memory == {c: one.solve(c) for c in chunks}


def test_many_texts_at_once_are_encoded_and_checked():
    import pytest

    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("etaoinshr\n日é") for _ in range(rng.randrange(0, 12))) for _ in range(60)) for _ in range(40)] + [t or "" for _, t in TEXTS]
    model = subwords.Pieces(PIECES)
    done = model.encode_all(texts)
    want = model.library.encode(texts, add_bos=True, add_eos=True)
    assert [ids(i) for i, _ in done] == want and [d.decode() for _, d in done] == [model.library.decode(w) for w in want]
    kept = model.fresh, model.fresh_ids
    model.check(texts, done)
    # two ids of one chunk change places, and a chunk gives its last id to the next one
    k = next(k for k, (c, i) in enumerate(zip(*kept)) if c[1:].isalpha() and c[0] == "▁" and len(i) > 8 and kept[0][k + 1][0] == "▁")
    swapped, moved = list(kept[1]), list(kept[1])
    swapped[k] = swapped[k][:-8] + swapped[k][-4:] + swapped[k][-8:-4]
    moved[k], moved[k + 1] = moved[k][:-4], moved[k][-4:] + moved[k + 1]
    for wrong in (swapped, moved):
        model.fresh, model.fresh_ids = list(kept[0]), wrong
        with pytest.raises(ValueError, match="otherwise"):
            model.check(texts, done)
