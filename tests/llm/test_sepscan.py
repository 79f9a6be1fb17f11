import os

import numpy as np
import pytest
import tiktoken  # noqa: F401

from citylake.llm import sepscan
from citylake.llm.sepscan import count_tokens, documents_in, encoding
from tests.llm.helpers import awkward, awkward_rows, clashing, empty

END = 9


def slow(ids):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == END:
            out.append((len(out), start, i - start, True))
            start = i + 1
    if start < len(ids):
        out.append((len(out), start, len(ids) - start, False))
    return out


FILES = {
    "plain.bin": [1, 2, 9, 3, 9, 9, 4, 4, 4],
    "none.bin": [1] * 23,
    "ends.bin": [9] * 11,
    "empty.bin": [],
    "long.bin": [9, *[1] * 50, 9, 2, 9],
    "edge.bin": [1, 2, 3, 9, 1, 2, 3, 9],
    "random.bin": np.random.default_rng(4).choice([1, 2, 9], 400, p=[0.5, 0.3, 0.2]).tolist(),
}


@pytest.mark.parametrize("block", [1, 3, 4, 1 << 20])
@pytest.mark.parametrize("run", [2, 1024])
def test_scan_against_a_loop(spark, tmp_path, monkeypatch, block, run):
    monkeypatch.setattr(sepscan, "RUN_BLOCKS", run)
    for name, ids in FILES.items():
        np.array(ids, "<u2").tofile(tmp_path / name)
    out = documents_in(spark, f"file://{tmp_path}", block, END).collect()
    want = {(name, *row) for name, ids in FILES.items() for row in slow(ids)}
    assert {tuple(r) for r in out} == want and len(out) == len(want)


def lengths(rows):
    import public_tokenizers

    coder = encoding(public_tokenizers.path(sepscan.VOCABULARY), public_tokenizers.PATTERN)
    return sorted(((r[0], len(coder.encode_ordinary(r[1] or ""))) for r in rows), key=str)


@pytest.mark.parametrize("rows", [awkward, clashing])
@pytest.mark.parametrize("block", [1000, 1 << 20])
def test_awkward_rows(spark, rows, block):
    out = count_tokens(rows(spark), block_tokens=block)
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in out.collect()), key=str) == lengths(awkward_rows())


def test_empty_table(spark):
    assert count_tokens(empty(spark)).collect() == []


def test_query_against_the_tokeniser(spark, sf_dir):
    from citylake.llm.queries import QUERIES

    docs = [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = QUERIES["op9_separator_scan"](spark, sf_dir).collect()
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in out), key=str) == lengths(docs)


def test_files_are_bare_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").coalesce(1)
    sepscan.write_token_files(docs, f"file://{tmp_path}")
    ids = [np.fromfile(tmp_path / f, "<u2") for f in os.listdir(tmp_path) if f.endswith(".bin")]
    assert sorted(np.concatenate(ids).tolist().count(sepscan.END) for _ in [0]) == [2]
