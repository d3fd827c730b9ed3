"""Pre-tokens, BPE, token counts and token files against the public libraries."""
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scorecraft.llm import bpe
from scorecraft.llm.batches import steps, text_buffer
from scorecraft.llm.pretokens import boundaries
from scorecraft.llm.token_counts import token_counts
from scorecraft.llm.token_files import pack, read_token_files, unpack, write_token_files
from scorecraft.session import scratch_path

from tests.llm.helpers import awkward_texts, documents, empty

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
ALPHABET = "abst re'slvdm' ' \n\t  \r12é²ñ½÷×—’“!?..A\x1c\xa0漢🙂́\x85ª"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.load_ranks(RANKS))


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocabulary.rank, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abst re'lvdm' \n\t\r12é²ñ½÷×—’!?.", max_size=40), min_size=1, max_size=6))
def test_boundaries_are_the_patterns(texts):
    buf, off = text_buffer(pa.array(texts, pa.large_string()))
    start, unknown = boundaries(buf, off)
    assert not unknown.any()
    want = []
    for t, at in zip(texts, off):
        for piece in regex.findall(P.PATTERN, t):
            want.append(int(at))
            at += len(piece.encode())
    assert np.flatnonzero(start).tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=8))
def test_ids_are_the_librarys(vocabulary, reference, texts):
    buf, off = text_buffer(pa.array(texts, pa.large_string()))
    ids, ends = bpe.encode_texts(vocabulary, buf, off, P.PATTERN)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [reference.encode_ordinary(t) for t in texts]


def test_long_tree_equals_side_by_side_trees(vocabulary):
    rnd = random.Random(5)
    pieces = ["".join(rnd.choice("abthern") for _ in range(rnd.randrange(2, 64))).encode() for _ in range(200)]
    ids, count = vocabulary.encode_distinct(pa.array(pieces, pa.large_binary()))
    ends = np.concatenate([[0], np.cumsum(count)])
    for piece, a, b in zip(pieces, ends[:-1], ends[1:]):
        if piece not in vocabulary.rank:
            assert vocabulary.encode_long(piece) == ids[a:b].tolist()


def test_encode_decode_of_a_table(spark, reference):
    docs = documents(spark)
    rows = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS).collect()
    assert len(rows) == docs.count()
    texts = awkward_texts()
    for r in rows:
        t = (texts[r.doc_id] if r.doc_id is not None else texts[6]) or ""
        assert r.ids == reference.encode_ordinary(t) and bytes(r.decoded) == t.encode()
    assert bpe.decode(bpe.encode(empty(spark), RANKS, P.PATTERN), RANKS).count() == 0
    assert bytes(bpe.decode(spark.createDataFrame([(1, None)], "decoded int, ids array<int>").select("ids"), RANKS).head().decoded) == b""


def test_rank_file_must_be_complete(tmp_path):
    bad = tmp_path / "ranks"
    bad.write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.load_ranks(str(bad))


def test_counts_are_the_librarys(spark, library):
    docs = documents(spark)
    rows = token_counts(docs, JSON).collect()
    assert len(rows) == docs.count()
    texts = awkward_texts()
    for r in rows:
        t = (texts[r.doc_id] if r.doc_id is not None else texts[6]) or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(library.encode(t, add_special_tokens=False)))
    assert token_counts(empty(spark), JSON).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r) for r in token_counts(blank, JSON).collect()} == {(1, 0, 0), (2, 0, 0)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_variable_length_coding_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = pack(v)
    assert len(control) == -(-len(v) // 4)
    assert unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(v)).tolist() == values


@pytest.mark.parametrize("shuffled", [False, True])
def test_token_files(spark, library, shuffled):
    docs = documents(spark)
    if shuffled:  # then blocks overlap and rows are partitioned by range
        docs = docs.repartition(5, F.hash("doc_id")).orderBy(F.rand(3))
    folder = scratch_path(spark, "test_files")
    write_token_files(docs, JSON, folder)
    rows = read_token_files(spark, folder).collect()
    rows.sort(key=lambda r: r.start)
    texts = awkward_texts()
    assert [r.doc_id for r in rows] == [None, *sorted([*range(len(texts)), 6, 6])]
    at = 0
    for r in rows:
        t = (texts[r.doc_id] if r.doc_id is not None else texts[6]) or ""
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.tokens) == (at, len(ids), ids)
        at += len(ids)
    crc = read_token_files(spark, folder, lambda ids: zlib.crc32(ids.tobytes()), "long").where("doc_id = 1").head().tokens
    assert crc == zlib.crc32(np.array([0], "<u4").tobytes())
    # the most frequent id has rank 0
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").head().id
    every = [i for r in rows for i in r.tokens]
    assert every.count(ranks) == max(every.count(i) for i in set(every))


def test_token_files_of_an_empty_table(spark):
    folder = scratch_path(spark, "test_files")
    write_token_files(empty(spark), JSON, folder)
    assert read_token_files(spark, folder).count() == 0


def test_steps_cut_between_rows():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(["aaaa", "b" * 50, "", "cc"])], ["id", "text"])
    parts = list(steps(iter([batch]), "text", 10))
    assert [p.column(0).to_pylist() for p in parts] == [[1], [2], [3, 4]]
