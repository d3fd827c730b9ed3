"""The trie against a dictionary of all beginnings."""
import hashlib
import random
import zlib

import pytest

from scorecraft.llm import prefix_trie as pt
from scorecraft.llm.queries import _rebuilt, op12_prefix_trie

from tests.conftest import SF_SMALL

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(convs):
    """convs: id -> list of (role, text)."""
    members, ends = {}, {}
    for c, turns in convs.items():
        turns = tuple(turns)
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children = {}
    for x in members:
        if x:
            children[x[:-1]] = children.get(x[:-1], 0) + 1
    leaves, saved = {}, {}
    for x, m in members.items():
        for d in range(len(x) + 1):
            leaves[x[:d]] = leaves.get(x[:d], 0) + (x not in children)
            saved[x[:d]] = saved.get(x[:d], 0) + ((len(m) - 1) * len(x[-1][1].encode()) if x else 0)
    return sorted(str((min(m), len(x), min(members[x[:-1]]) if x else None, len(m), children.get(x, 0), leaves[x], saved[x],
                       hashlib.sha256(",".join(map(str, sorted(ends.get(x, [])))).encode()).hexdigest())) for x, m in members.items())


def ordered(rows):
    """id -> turns of (conv, turn, role, text) rows."""
    out = {}
    mark = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    for c, n, r, t in sorted(((c, (n is not None, n or 0), r or "", t or "") for c, n, r, t in rows if c is not None),
                             key=lambda x: (x[0], x[1], x[2], mark(x[2], x[3]))):
        out.setdefault(c, []).append((r, t))
    return out


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def result(df):
    return sorted(str(tuple(r)) for r in df.select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, depth int, path string")


def some(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for k in range(rnd.randrange(1, 7)):
            rows.append((c, rnd.choice([k, k, k, None]) if k else k, rnd.choice(["u", "a", None]), rnd.choice(["x", "yé", "", None, "long " * 9])))
    return rows


@pytest.mark.parametrize("seed,shards", [(1, 1), (2, 3), (3, 8), (4, 40)])
def test_trie(spark, seed, shards):
    rows = some(seed)
    assert result(pt.prefix_trie(pt.paths(frame(spark, rows)), shards)) == brute(ordered(rows))


def test_copies_over_many_shards(spark):
    rows = [(c, k, "u", f"t{k}") for c in range(300) for k in range(3)] + [(300 + c, 0, "u", "t0") for c in range(200)]
    rows += [(600, 0, "u", "t0"), (600, 1, "u", "t1"), (600, 2, "u", "other"), (601, 0, "u", "t0"), (601, 1, "u", "t1")]
    assert result(pt.prefix_trie(pt.paths(frame(spark, rows)), 16)) == brute(ordered(rows))


def test_beginnings_longer_than_a_splitter(spark, monkeypatch):
    monkeypatch.setattr(pt, "SPLITTER_TURNS", 2)
    rows = [(c, k, "u", f"t{k if k < 5 else (k, c % 3)}") for c in range(60) for k in range(8)]
    assert result(pt.prefix_trie(pt.paths(frame(spark, rows)), 7)) == brute(ordered(rows))


def test_chunks_of_ids(spark, monkeypatch):
    monkeypatch.setattr(pt, "_CHUNK", 32)
    monkeypatch.setattr(pt, "_ROWS", 3)
    rows = [(c, 0, "u", "same") for c in range(-20, 200)]
    assert result(pt.prefix_trie(pt.paths(frame(spark, rows)), 5)) == brute(ordered(rows))


def test_long_conversation_and_awkward_rows(spark):
    rows = [(1, k, "u", f"{k}") for k in range(400)] + [(2, k, "u", f"{k}") for k in range(399)]
    rows += [(3, 0, "u", "x" * 100000), (3, 0, "u", "x" * 100000), (3, None, None, None), (None, 0, "u", "lost"), (None, None, None, None), (-7, 1, "", "")]
    assert result(pt.prefix_trie(pt.paths(frame(spark, rows)), 4)) == brute(ordered(rows))
    assert pt.prefix_trie(pt.paths(frame(spark, rows).limit(0))).count() == 0


def test_conversations_without_turns(spark):
    empty = spark.createDataFrame([(5, b"", []), (7, b"", []), (9, b"a" * 16, [3])], "conv_id long, path binary, sizes array<long>")
    got = pt.prefix_trie(empty, 3).orderBy("depth").collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves) for r in got] == [(5, 0, 3, 1, 1), (9, 1, 1, 0, 1)]
    assert got[0].ends_sha256 == hashlib.sha256(b"5,7").hexdigest()


def test_rebuilt(spark):
    rows = some(9, 80)
    rows = [r for r in rows if r[0] not in (5, 20)]
    assert result(pt.prefix_trie(_rebuilt(pt.paths(frame(spark, rows))), 6)) == brute(rebuilt(ordered(rows)))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(op12_prefix_trie(spark, SF_SMALL)) == brute(rebuilt(ordered(rows)))
