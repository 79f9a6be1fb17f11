import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from citylake.llm.bpe import VOCABULARY, Bpe, encode_documents
from tests.llm.helpers import awkward, awkward_rows, clashing, empty


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return (
        len(ids),
        hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


TEXTS = [
    "",
    "It's we'LL they'd 'S 12345 a1b2",
    "<|endoftext|><|startoftext|>x<|endoftext",
    "İ ΌΣΟΣ ﬁ é é Å",
    "\x1ca\x1fb\x85c d e　f​g",
    "a" * 3000,
    "abc" * 1500 + " " + "\U0001f600" * 300,
]


def test_every_code_point_as_the_library(library):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = TEXTS + [" ".join(chars[i : i + 97]) for i in range(0, len(chars), 97)]
    bpe = Bpe(public_tokenizers.path(VOCABULARY))
    ids, edges = bpe.encode(pa.array(texts))
    decoded = bpe.decode(ids, edges)
    for k, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[edges[k] : edges[k + 1]].tolist() == want
        assert decoded[k].as_py() == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("rows", [awkward, clashing])
def test_awkward_rows(spark, library, rows):
    out = encode_documents(rows(spark)).collect()
    want = [(r[0], *digests(library, r[1])) for r in awkward_rows()]
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in out:
        assert hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest() == r["ids_sha256"]


def test_empty_table(spark):
    assert encode_documents(empty(spark)).collect() == []


def test_query_as_the_library(spark, library, sf_dir):
    from citylake.llm.queries import QUERIES

    out = QUERIES["op10_bpe_segment_tree"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {(d["doc_id"], *digests(library, d["text"])) for d in docs}
    assert {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out} == want
    assert len(out) == len(docs)
