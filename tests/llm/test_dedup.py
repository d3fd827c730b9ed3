"""Exact, SimHash, line and embedding dedup, and components, against brute force."""
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from scorecraft.llm.components import components
from scorecraft.llm.embedding_dedup import embedding_dedup
from scorecraft.llm.exact_dedup import exact_dedup
from scorecraft.llm.line_dedup import line_dedup
from scorecraft.llm.simhash import fingerprints, links, simhash_dedup
from scorecraft.llm.batches import text_buffer

from tests.llm.helpers import awkward_texts, documents, empty, text


class Union:
    def __init__(self):
        self.up = {}

    def find(self, k):
        while self.up.setdefault(k, k) != k:
            k = self.up[k]
        return k

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# -- components -----------------------------------------------------------------
@pytest.mark.parametrize("edges", [
    [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 80)],
    [(random.Random(1).randrange(50), k) for k in range(50)], [(1, 1), (2, None)], []])
def test_components(spark, edges):
    want = Union()
    for a, b in edges:
        if a != b and b is not None:
            want.join(a, b)
    got = components(spark.createDataFrame([*edges, *edges], "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((k, want.find(k)) for k in list(want.up))


# -- exact ----------------------------------------------------------------------
def _groups(rows):
    out = {}
    for k, t in rows:
        out.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(k)
    return out


def _check_exact(rows, got):
    groups = _groups(rows)
    norm = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, t in rows}
    assert len(got) == len(rows)
    for r in got:
        members = groups[norm[r.doc_id]]
        low = [m for m in members if m is not None]
        assert (r.keep_id, r.group_size) == (min(low) if low else None, len(members))
        if r.kept:
            assert r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)


def test_exact_awkward(spark):
    docs = documents(spark)
    _check_exact([tuple(r) for r in docs.select("doc_id", "text").collect()], exact_dedup(docs).collect())
    assert exact_dedup(empty(spark)).count() == 0


def test_exact_with_a_hot_text_and_a_common_beginning(spark):
    rnd = random.Random(3)
    hot, begin = text(9, 60), "same beginning " * 30
    rows = [(k, hot if k % 3 == 0 else begin + str(rnd.randrange(400)) if k % 3 == 1 else text(k, 12)) for k in range(3000)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    _check_exact(rows, exact_dedup(docs).collect())


def test_exact_runs_no_python(spark):
    plan = exact_dedup(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- simhash --------------------------------------------------------------------
def _fingerprint(t, size=3):
    b = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", b)
    sh = [b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0


def test_fingerprints():
    texts = [t or "" for t in awkward_texts()]
    buf, off = text_buffer(pa.array(texts, pa.large_string()))
    assert fingerprints(buf, off, 3).tolist() == [_fingerprint(t) for t in texts]


def test_simhash_awkward(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    fp = {k: _fingerprint(t) for k, t in rows if k is not None}
    want = Union()
    for a in fp:
        for b in fp:
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                want.join(a, b)
    got = simhash_dedup(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.fingerprint, r.component_id, r.kept) == (format(fp[r.doc_id], "016x"), want.find(r.doc_id), want.find(r.doc_id) == r.doc_id)
    assert simhash_dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3, 4])
def test_links_find_every_component(spark, bits, monkeypatch):
    """Random fingerprints, chains and a dense ball, with tiny tiles."""
    monkeypatch.setattr("scorecraft.llm.simhash.TILE", 50)
    rnd = random.Random(bits)
    fps = {rnd.getrandbits(64) for _ in range(1200)}
    for f in list(fps)[:200]:
        for _ in range(rnd.randrange(1, 6)):
            f ^= sum({1 << rnd.randrange(64) for _ in range(rnd.randrange(1, 5))})
            fps.add(f)
    center = rnd.getrandbits(64)
    fps |= {center ^ 1 << a ^ 1 << b for a in range(20) for b in range(a)}
    fps = sorted(fps)
    rnd.shuffle(fps)
    a = np.array(fps, np.uint64)
    want = Union()
    for k in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[k] ^ a[:k]) <= bits):
            want.join(k, int(j))
    points = spark.createDataFrame(list(zip(a.view(np.int64).tolist(), range(len(a)))), "fp long, rep long")
    got = dict(map(tuple, components(links(points, bits)).collect()))
    assert [got.get(k, k) for k in range(len(a))] == [want.find(k) for k in range(len(a))]


# -- lines ----------------------------------------------------------------------
def _chunks(t, window=2, spread=2):
    mask = (1 << 64) - 1
    lines = re.findall(rb"[^\n]*\n|[^\n]+$", t.encode())
    h = [xxhash.xxh64_intdigest(x) for x in lines]
    out, now = [], []
    for k, x in enumerate(lines):
        long = len(re.findall(rb"[^\x20\x09-\x0D]+", x)) > 50
        if long:
            out += [now] * bool(now) + [[x]]
            now = []
            continue
        now.append(x)
        r = h[k]
        for j in range(1, window):
            r = (r * 0x100000001B3 + (h[k - j] if k >= j else 0)) & mask
        if ((r * 0x9E3779B97F4A7C15 & mask) >> 33) % spread == 0 and len(now) >= 2:
            out.append(now)
            now = []
    return [*out, now] if now else out


def _cleaned(rows):
    seen, out = {}, {}
    for k, t in sorted((k, t or "") for k, t in rows if k is not None):
        left = []
        for no, c in enumerate(_chunks(t)):
            b = b"".join(c)
            if (len(c) >= 2 or len(b.split()) > 50) and seen.setdefault(b, (k, no)) != (k, no):
                continue
            left.append(b)
        out[k] = b"".join(left).decode()
    return out


def test_lines_awkward(spark):
    docs = documents(spark)
    want = _cleaned([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = line_dedup(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.text == (awkward_texts()[6] if r.doc_id is None else want[r.doc_id])
    assert line_dedup(empty(spark)).count() == 0


def test_lines_shared_passage_goes_wherever_it_stands(spark):
    passage = "".join(text(1000 + k, 12, 100) + "\n" for k in range(30))
    rows = [(k, "".join(text(k * 100 + j, 7, 100) + "\n" for j in range(k % 7)) + (passage if k % 2 else "") + text(k * 100 + 50, 9, 100)) for k in range(60)]
    got = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = _cleaned(rows)
    assert {k: r.text for k, r in got.items()} == want
    assert got[1].n_removed == 0
    for k in range(3, 60, 2):  # but for the ends of the passage
        assert len(got[k].text) < len(rows[k][1]) - 0.7 * len(passage)
    assert all(got[k].text == rows[k][1] for k in range(0, 60, 2))


# -- embeddings -----------------------------------------------------------------
def _check_embeddings(rows, got, threshold=0.9):
    good = [(k, np.array(v, float) / max(map(abs, v))) for k, v in rows if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, want = {k: 0 for k, _ in rows}, Union()
    for i, (a, x) in enumerate(good):
        for b, y in good[:i]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                n[a] += 1
                n[b] += 1
                want.join(a, b)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == (n[r.vec_id], None if r.vec_id is None else want.find(r.vec_id)), r


def test_embeddings_awkward(spark):
    rows = [(0, None), (1, []), (2, [0.0, 0.0, 0.0]), (3, [1.0, None, 0.0]), (4, [float("nan"), 1.0, 0.0]), (5, [float("inf"), 1.0, 0.0]),
            (6, [1.0, 0.0, 0.0]), (7, [2.0, 0.0, 0.0]), (8, [1.0, 0.1, 0.0]), (9, [-1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (11, [1e200, 0.0, 0.0]),
            (12, [0.0, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (14, [0.0, 1.0, 0.0]), (15, [1.0, 0.1])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, v int, n int")
    _check_embeddings(rows, embedding_dedup(frame).collect())
    assert embedding_dedup(frame.limit(0)).count() == 0


def test_embeddings_with_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr("scorecraft.llm.embedding_dedup.TILE", 32)
    monkeypatch.setattr("scorecraft.llm.embedding_dedup.BLOCK", 60)
    rng = np.random.default_rng(2)
    near = rng.standard_normal(24)
    x = np.concatenate([near + 0.1 * rng.standard_normal((150, 24)), np.repeat(near[None], 50, 0), rng.standard_normal((250, 24))]).astype(np.float32)
    rows = [(int(k), [float(z) for z in v]) for k, v in zip(rng.permutation(len(x)), x)]
    _check_embeddings(rows, embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
