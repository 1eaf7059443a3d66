import glob
import random

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import BPE, TEXTS, documents, nothing
from tokenizers import Tokenizer

from briefwright.llm import tokenfiles
from briefwright.llm.common import byte_view


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 50_257, 4096), np.array([5]), np.array([0, 2**32 - 1] * 7), np.full(9, 7), rng.zipf(1.3, 3000) % 2**32, np.append(np.zeros(500), 40_000)):
        for percentile in (0.0, 0.5, 0.95, 1.0):
            ids = ids.astype(np.uint32)
            assert (tokenfiles.unpack_block(tokenfiles.pack_block(ids, percentile)) == ids).all()


def test_outliers_are_exceptions():
    ids = np.append(np.arange(4000) % 100, [50_000]).astype(np.uint32)
    assert len(tokenfiles.pack_block(ids, 0.95)) < 4001 * 7 / 8 + 40


def test_same_ids_as_the_library(monkeypatch):
    library, rng = Tokenizer.from_file(BPE), random.Random(4)
    letters = [*"ab c's're n'11.,!\n\t\r  é日", "<|endoftext|>", "\xa0", "\x1c", " ", "½", "'ll", "\n\n", "—", "ſ"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 50))) for _ in range(4000)] + [t or "" for _, t in TEXTS]
    for memory in (3_000_000, 50):
        monkeypatch.setattr(tokenfiles, "REMEMBERED", memory)
        ids, counts = tokenfiles.Chunks(BPE).encode(*byte_view(pa.array(texts)))
        cuts = np.concatenate([[0], np.cumsum(counts)])
        for i, t in enumerate(texts):
            assert ids[cuts[i] : cuts[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("block", [1, 64, 4096])
def test_files_hold_all_documents_in_order(spark, tmp_path, block):
    folder = f"file://{tmp_path}/tokens"
    n = tokenfiles.write(documents(spark).repartition(3), folder, BPE, end_id=2, block=block)
    rows = sorted(tokenfiles.read(spark, folder).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(BPE)
    want = {(i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in TEXTS}
    assert {(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows} == want and len(rows) == len(TEXTS)
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])])[:-1].tolist()
    assert n == sum(r.n_tokens for r in rows)
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)
    for path in glob.glob(f"{tmp_path}/tokens/part-*"):  # any run of ids can be read by itself
        file = tokenfiles.TokenFile(f"file://{path}")
        whole = file.ids(0, file.n)
        for first, size in ((0, 1), (file.n // 2, 70), (file.n - 1, 1), (3, 0)):
            assert (file.ids(first, size) == whole[first : first + size]).all()


def test_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert tokenfiles.write(nothing(spark), folder, BPE) == 0
    assert tokenfiles.read(spark, folder).collect() == []
    folder = f"file://{tmp_path}/no-partition"
    assert tokenfiles.write(spark.createDataFrame([], documents(spark).schema), folder, BPE) == 0 and tokenfiles.read(spark, folder).collect() == []
