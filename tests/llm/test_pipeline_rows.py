"""The pipeline's stages decide on rows, not on ids."""
from collections import Counter

from pyspark.sql import functions as F

from corpus_pipeline import STAGES
from scorecraft.llm.mixing import mix

from tests.llm.helpers import text

STAGE = dict(STAGES)


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def _left(name, spark, rows):
    out = STAGE[name](spark, _docs(spark, rows), "")
    assert out.columns == ["doc_id", "text", "source"]
    return Counter((r.doc_id, r.text) for r in out.collect())


def test_exact_keeps_one_row_of_equal_texts(spark):
    rows = [(None, "n n", "a"), (None, "n n", "a"), (None, "alone", "a"), (7, "x y", "a"), (7, "x y", "b"), (8, "p q", "a"), (8, "r s", "a"), (3, "r  s", "a"),
            (9, "p q", "a"), (None, "p q", "a")]
    want = Counter([(None, "n n"), (None, "alone"), (7, "x y"), (8, "p q"), (3, "r  s")])
    assert _left("exact_dedup", spark, rows) == want


def test_near_keeps_one_row_of_a_group(spark):
    a, b, c, d = (text(k, 60) for k in (1, 2, 3, 4))
    rows = [(None, a, "a"), (None, a.replace(" ", "  "), "a"), (7, b, "a"), (7, b.replace(" ", "  "), "a"), (8, c, "a"), (8, d, "a"), (3, d.replace(" ", "  "), "a"), (None, c, "a")]
    got = _left("simhash_dedup", spark, rows)
    assert sum(got.values()) == 4
    assert sorted((k or -1, " ".join(t.split())) for k, t in got) == sorted([(-1, " ".join(a.split())), (7, " ".join(b.split())), (8, " ".join(c.split())), (3, " ".join(d.split()))])


def test_mixing_takes_every_row_by_its_own_repeats(spark):
    rows = [(k if k % 5 else None, text(k, 5 + k % 7), s) for k in range(60) for s in ("a", "b", "c")]
    times = {(r.doc_id, r.source): r.repeats for r in mix(_docs(spark, rows)).collect()}
    assert any(n for (k, _), n in times.items() if k is None) and any(times[k, "a"] != times[k, "c"] for k in range(1, 5))
    want = Counter({(k, t, s): 0 for k, t, s in rows})
    for k, t, s in rows:
        want[k, t, s] += times[k, s]
    got = Counter(map(tuple, STAGE["mixing"](spark, _docs(spark, rows), "").collect()))
    assert got == +want


def test_whole_chain_of_rows(spark):
    docs = _docs(spark, [(None, "n n", "a"), (None, "n n", "a"), (5, "x y z", "a"), (5, "x y z", "b")])
    left = STAGE["simhash_dedup"](spark, STAGE["exact_dedup"](spark, docs, ""), "")
    assert left.agg(F.count("*")).head()[0] == 2
