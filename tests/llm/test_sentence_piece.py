"""SentencePiece ids and texts against the public library."""
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from scorecraft.llm import sentence_piece
from scorecraft.llm.batches import text_buffer
from scorecraft.llm.queries import op13_sentence_piece

from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward_texts, documents, empty

MODEL = P.path("piece_bpe_32k.model")
ALPHABET = "abst re'slvdm \n\t  12é²漢🙂\u2581\x00ーの中в"


@pytest.fixture(scope="module")
def model():
    return sentence_piece.Model(sentence_piece.load(MODEL)), sentence_piece.Surfaces(sentence_piece.load(MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def check(model, library, texts):
    ids, ends = model[0].encode(*text_buffer(pa.array(texts, pa.large_string())))
    got = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
    assert got == [library.encode(t, add_bos=True, add_eos=True) for t in texts]
    assert model[1].decode(ids, ends) == [library.decode(x) for x in got]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=8))
def test_ids_and_texts_are_the_librarys(model, library, texts):
    check(model, library, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6))
def test_any_characters(model, library, texts):
    check(model, library, texts)


def test_runs_of_blanks_and_of_one_letter(model, library):
    check(model, library, [" " * k for k in range(70)] + ["a" + " " * k + "b" for k in range(40)] + ["x" * k for k in range(60)])


def test_long_texts(model, library):
    rnd = random.Random(3)
    check(model, library, [t or "" for t in awkward_texts()] + ["".join(rnd.choice("abcdef") for _ in range(50000)), " " * 3000,
                                                                "".join(chr(rnd.randrange(0x4E00, 0x9F00)) for _ in range(5000))])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from([0, 1, 2, 259, 28705]), st.integers(3, 258), st.integers(259, 31999)), max_size=9), min_size=1, max_size=6))
def test_any_ids_decode_as_the_librarys(model, library, lists):
    off = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    assert model[1].decode(np.array([y for x in lists for y in x], np.int64), off) == [library.decode(x) for x in lists]


def test_frames(spark, library):
    docs = documents(spark)
    coded = sentence_piece.encode(docs, MODEL)
    assert coded.columns == ["doc_id", "ids"]
    back = sentence_piece.decode(coded, MODEL).collect()
    want = sorted((str(r.doc_id), library.encode(r.text or "", add_bos=True, add_eos=True)) for r in docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in back) == want
    assert all(r.decoded == library.decode(r.ids) for r in back)
    assert sentence_piece.decode(sentence_piece.encode(empty(spark), MODEL), MODEL).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in sentence_piece.decode(nulls, MODEL).collect()] == ["", ""]


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "m.model"
    path.write_bytes(open(MODEL, "rb").read().replace(b"\x18\x01 \x002\x00", b"\x18\x00 \x002\x00"))
    with pytest.raises(ValueError):
        sentence_piece.read_model(str(path))


def test_query(spark, library):
    got = {r.doc_id: r for r in op13_sentence_piece(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_bos=True, add_eos=True)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
