"""Passages of whole lines against brute force."""
import random
import re

import pytest

from scorecraft.llm.line_dedup import passage_dedup
from scorecraft.llm.queries import QUERIES

from tests.llm.helpers import awkward_texts, documents, empty, text


def _left(rows, min_lines=2, min_words=50):
    """{id: what is left of it}, every window and paragraph looked up among all before it."""
    texts = {k: re.findall(rb"[^\n]*\n|[^\n]+$", (t or "").encode()) for k, t in rows if k is not None}
    first, out = {}, {}
    for k, lines in sorted(texts.items()):
        gone = set()
        for no in range(len(lines)):
            units = [1] if len(re.findall(rb"[^\x20\x09-\x0D]+", lines[no])) > min_words else []
            for n in units + [min_lines] * (no + min_lines <= len(lines)):
                at = first.setdefault(tuple(re.sub(rb"\r?\n?$", b"", x) for x in lines[no:no + n]), (k, no))
                if at[0] != k or at[1] + n <= no:
                    gone |= set(range(no, no + n))
        out[k] = b"".join(x for no, x in enumerate(lines) if no not in gone).decode()
    return out


def _check(spark, rows):
    got = passage_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.text for r in got} == _left(rows)
    return {r.doc_id: r for r in got}


def test_passages_awkward(spark):
    docs = documents(spark)
    want = _left([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = passage_dedup(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.text == (awkward_texts()[6] if r.doc_id is None else want[r.doc_id])
    assert passage_dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("size", [2, 3, 4, 5])
def test_short_passages_go_whole(spark, size):
    line = lambda k: text(k, 30, 100) + "\n"
    rows = []
    for p in range(20):  # each stands in two documents, between lines of their own
        passage = "".join(line(1000 + p * 10 + j) for j in range(size))
        rows += [(2 * p + k, line(5000 + 4 * p + k) + passage + line(7000 + 4 * p + k)) for k in range(2)]
    random.Random(size).shuffle(rows)
    got = _check(spark, rows)
    for p in range(20):
        assert got[2 * p].n_removed == 0 and got[2 * p + 1].n_removed == size


def test_runs_of_one_and_two_lines_are_bounded(spark):
    rows = [(1, "same\n" * 9), (2, "own\n" + "same\n" * 40 + "end\n"), (3, "a\nb\n" * 20), (4, "x\n" + "a\nb\n" * 3 + "y\n")]
    got = _check(spark, rows)
    assert [got[k].text for k in (1, 2, 3, 4)] == ["same\n" * 2, "own\nend\n", "a\nb\n", "x\ny\n"]


def test_random_lines(spark):
    rnd = random.Random(4)
    lines = [text(k, 60 if k % 5 == 0 else 4, 100) + "\n" for k in range(12)]
    _check(spark, [(k, "".join(rnd.choice(lines) for _ in range(rnd.randrange(9)))) for k in range(120)])


def test_query_removes_whole_passages(spark, tmp_path):
    passage = "".join(text(k, 30, 100) + "\n" for k in range(2))
    rows = [(k, text(50 + k, 9, 100) + "\n" + passage + text(90 + k, 9, 100) + "\n") for k in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in QUERIES["op6_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {k: t if k == 0 else t.replace(passage, "") for k, t in rows}


def test_line_ends_do_not_matter(spark):
    long, a, b = (text(k, n, 100).replace("\n", " ") for k, n in ((1, 70), (2, 9), (3, 9)))
    rows = [(1, f"one\n{long}\n{a}\n{b}\nend"), (2, f"two\n{long}"), (3, f"three\r\n{a}\r\n{b}"), (4, f"four\r\n{long}\r\n{a}\n{b}\r\nend4\r\n"), (5, f"{a}\r")]
    got = _check(spark, rows)
    assert [got[k].text for k in range(1, 6)] == [rows[0][1], "two\n", "three\r\n", "four\r\nend4\r\n", f"{a}\r"]
