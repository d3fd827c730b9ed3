"""Runs against brute force over all starts and periods."""
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorecraft.llm.batches import text_buffer
from scorecraft.llm.periodic_runs import _step, lyndon_groups, periodic_runs, runs_of, words_of
from scorecraft.llm.queries import op11_periodic_runs

from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward_texts, documents, empty


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i - q] for i in range(q, len(w))))


def brute(w, least, exponent):
    """Stretches with words q apart equal that no neighbour extends, q their smallest period."""
    out, n = set(), len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and w[k] == w[k + q]:
                k += 1
            if k > i:
                s, e = i, k + q
                if e - s >= max(least, exponent * q) and smallest_period(w[s:e]) == q:
                    out.add((s, e - s, q))
            i = k + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def longest_lyndon(w, i):
    def lyndon(x):
        return all(x < x[k:] for k in range(1, len(x)))
    return max(k for k in range(1, len(w) - i + 1) if lyndon(w[i:i + k]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=24))
def test_phase_one_gives_the_lyndon_array(w):
    length, group = lyndon_groups(w)
    assert length == [longest_lyndon(w, i) for i in range(len(w))]
    by = {}
    for i, g in enumerate(group):
        by.setdefault(g, set()).add(tuple(w[i:i + length[i]]))
    assert all(len(x) == 1 for x in by.values()) and len({x for v in by.values() for x in v}) == len(by)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.sampled_from([(2, 2), (6, 4), (3, 3)]))
def test_runs_are_all_found(w, rule):
    assert runs_of(np.array(w), *rule) == brute(w, *rule)


def fold(w, blocks):
    """Words with planted repetitions, so that runs lie in, beside and over each other."""
    rnd = random.Random(blocks)
    out = list(w)
    for _ in range(blocks % 5):
        at, n = rnd.randrange(len(out)), rnd.randrange(1, 5)
        out[at:at + n] = out[at:at + n] * rnd.randrange(2, 7)
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=30), st.integers(0, 10**6))
def test_planted_runs(w, seed):
    w = fold(w, seed)
    assert runs_of(np.array(w), 6, 4) == brute(w, 6, 4)


def rows_of(texts, least=6, exponent=4):
    buf, off = text_buffer(pa.array(texts, pa.large_string()))
    runs, counts, stay, joined, letters, of_text = _step(buf, off, least, exponent)
    ends = np.concatenate([[0], np.cumsum(counts)])
    return [runs[a:b] for a, b in zip(ends, ends[1:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 12), max_size=30), st.integers(0, 10**6)), min_size=1, max_size=5))
def test_batches_and_separators(many):
    words = [fold(w, s) if w else [] for w, s in many]
    assert rows_of([" ".join(map(str, w)) for w in words]) == [brute(w, 6, 4) for w in words]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(" \t\n\r\x0b\x0cabé漢\xa0\x1c", max_size=20), min_size=1, max_size=5))
def test_words(texts):
    buf, off = text_buffer(pa.array(texts, pa.large_string()))
    first, stop, of_text = words_of(buf, off)
    got = [[buf[a:b].tobytes().decode() for a, b in zip(first[x:y], stop[x:y])] for x, y in zip(of_text, of_text[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]


def test_long_runs_take_no_square_time():
    assert rows_of(["a " * 200000])[0] == [(0, 200000, 1)]
    block = " ".join(f"w{k}" for k in range(20000))
    assert rows_of([" ".join([block] * 5)])[0] == [(0, 100000, 20000)]


def test_frames(spark):
    docs = documents(spark)
    got = periodic_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    want = sorted(str((r.doc_id, len(words(r.text)), brute(words(r.text), 6, 4))) for r in docs.where(F.length("text") < 5000).collect())
    some = docs.where(F.length("text") < 5000)
    assert sorted(str((r.doc_id, r.n_words, [tuple(x) for x in r.runs])) for r in periodic_runs(some).collect()) == want
    assert got.count() == docs.count()
    assert periodic_runs(empty(spark)).count() == 0
    none = [r for r in got.collect() if r.doc_id is not None and r.doc_id < 4]
    assert [(r.n_words, r.runs, r.collapsed) for r in none] == [(0, [], "")] * 4
    with pytest.raises(ValueError):
        periodic_runs(docs, exponent=1)


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w, 6, 4)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = None
    for s, m, q in runs:
        if best is None or m * best[2] > best[1] * q:
            best = (s, m, q)
    s, m, q = best or (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), s, m, q, None if best is None else 1000 * m // q,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_query(spark):
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = op11_periodic_runs(spark, SF_SMALL).select(*cols).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(F.length("text") < 6000).collect()
    by = {r.doc_id: tuple(r) for r in got}
    assert len(got) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert any(zlib.crc32(str(d.doc_id).encode()) % 10 == 0 for d in docs)
    for d in docs:
        assert by[d.doc_id] == expected(d.doc_id, d.text)
    assert sum(by[d.doc_id][1] > 0 for d in docs) > 3
