"""Quality, mixing, URL filter, the queries' SQL, and the pipeline's stages."""
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scorecraft.llm.mixing import mix, targets
from scorecraft.llm.quality import Network, fit_quality, held_out, score_quality
from scorecraft.llm.queries import QUERIES, SQL
from scorecraft.llm.url_filter import url_filter

from tests.llm.helpers import documents, empty, text

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF), duck.sql(SQL[name])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_returns_every_row(spark, duck, name):
    column = {"op4_embedding_dedup": ("vec_id", "embeddings"), "op5_url_filter": ("page_id", "pages")}.get(name, ("doc_id", "documents"))
    got = QUERIES[name](spark, SF).select(column[0]).collect()
    assert sorted(r[0] for r in got) == sorted(x[0] for x in duck.sql(f"SELECT {column[0]} FROM {column[1]}").fetchall())


# -- quality --------------------------------------------------------------------
def _labelled(spark, n=400):
    good = lambda k: text(k, 60)
    junk = lambda k: " ".join(w.upper() + "!!" for w in text(k, 60).split())
    rows = [(k, junk(k) if k % 4 == 0 else good(k), int(k % 4 != 0)) for k in range(n)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(n, None), (n + 1, ""), (n + 2, text(5, 30000))], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(1, 1), (None, 1), (2, None), (10**6, 0)], "doc_id long, quality int")
    return docs, labels, {r[0]: r[2] for r in rows}


def test_quality_separates_held_out_rows(spark):
    docs, labels, y = _labelled(spark)
    network = fit_quality(docs, labels, updates=90)
    rows = {r.doc_id: r for r in score_quality(docs, network).withColumn("held", held_out(F.col("doc_id"))).collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows.values())
    held = [k for k in y if rows[k].held]
    assert np.mean([(rows[k].score >= 0.3) == y[k] for k in held]) > 0.97
    again = fit_quality(docs.repartition(3), labels, updates=90)
    assert all(np.array_equal(network.w[k], again.w[k]) for k in network.w)  # the sample does not depend on the partitions
    assert score_quality(empty(spark), network).count() == 0
    assert score_quality(documents(spark), network).count() == documents(spark).count()
    assert 0 <= fit_quality(docs, labels.limit(0), updates=9).score(np.zeros(0, np.uint8), np.array([0, 0]))[0] <= 1


def test_held_out_labels_do_not_matter(spark):
    docs, labels, _ = _labelled(spark, 60)
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = fit_quality(docs, labels, train_rows=20, updates=9), fit_quality(docs, flipped, train_rows=20, updates=9)
    assert all(np.array_equal(a.w[k], b.w[k]) for k in a.w)


def test_gradient_is_the_numerical_one():
    net = Network.start(3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    texts = [text(k, 50).encode() for k in range(3)] + [b""]
    buf, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    y, w = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 1])
    loss = lambda: float((np.logaddexp(0, net.logits(buf, off)) - y * net.logits(buf, off)) @ w / w.sum())
    g = net._gradient(buf, off, y, w)
    rng = np.random.default_rng(0)
    for k, v in net.w.items():
        at = np.unravel_index(np.argmax(np.abs(g[k])), v.shape)
        before = v[at]
        v[at] = before + 1e-3
        up = loss()
        v[at] = before - 1e-3
        down = loss()
        v[at] = before
        assert abs((up - down) / 2e-3 - g[k][at]) < 2e-2 * max(abs(g[k][at]), 1e-2), k
    assert rng is not None


# -- mixing ---------------------------------------------------------------------
def test_targets_fill_up_to_the_caps(spark):
    sizes = spark.createDataFrame([("a", 10, 1), ("b", 100, 2), ("c", 1000, 3), ("d", 0, 1), ("e", 5, 3)], "key string, source_size long, weight int")
    got = {r.key: r.target for r in targets(sizes, 3).collect()}
    assert got["a"] == 30 and got["e"] == 15 and got["b"] == 300 and got["d"] == 0
    assert abs(sum(got.values()) - 1115) < 1e-9 and got["c"] <= 3000


def test_mix_awkward(spark):
    docs = documents(spark)
    rows = mix(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        assert 0 <= r.repeats <= 3 and r.taken == r.repeats * r.size
        by.setdefault(r.source, []).append(r)
    for group in by.values():
        assert sum(r.size for r in group) == group[0].source_size
        assert group[0].target <= 3 * group[0].source_size
    assert abs(sum(g[0].target for g in by.values()) - sum(r.size for r in rows)) < 1e-6
    assert sorted(map(str, rows)) == sorted(map(str, mix(docs.repartition(4)).collect()))
    assert mix(empty(spark)).count() == 0


def test_mix_comes_near_its_targets(spark):
    docs = spark.createDataFrame([(k, text(k, 5 + k % 30), "abc"[k % 17 % 3] if k % 3 else "hot") for k in range(4000)], "doc_id long, text string, source string")
    got = mix(docs).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) <= 0.003 * r.g for r in got)


# -- urls -----------------------------------------------------------------------
def test_urls(spark):
    link = '<html><LINK href="{}" rel=canonical></html>'
    hop = "<meta content='0; url={}' http-equiv='Refresh'>"
    rows = [(0, "http://a.bad.net/x", None), (1, "http://clean.com/1", link.format("http://a.bad.net/x")), (2, "http://clean.com/2", hop.format("/1")),
            (3, "http://ok.bad.net/en/z", link.format("http://clean.com/2")), (4, "http://Fine.org/", link.format("http://fine.org/other")),
            (5, None, None), (6, "no scheme", link.format("http://b.bad.net/")), (7, "http://far.com/", hop.format("//b.bad.net/q")),
            (8, "http://x.com?u=http://bad.net/", "<link rel=stylesheet href=http://a.bad.net/x>"), (9, "http://notbad.net/", ""), (1, "http://clean.com/1", None)]
    rules = [("bad.net/", "block"), ("ok.bad.net/en/", "allow")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, rule string")
    got = sorted(map(tuple, url_filter(frame, rules).select("page_id", "host", "path", "rule", "verdict").collect()))
    by = {g[0]: g[1:] for g in got}
    assert len(got) == len(rows)
    assert by[0] == ("a.bad.net", "/x", "bad.net/", "block") and by[3] == ("ok.bad.net", "/en/z", "ok.bad.net/en/", "allow")
    assert by[1][3] == by[2][3] == "allow"   # shielded by the explicit allow in their component
    assert by[4] == ("fine.org", "/", None, "allow") and by[5] == ("", "", None, "allow")
    assert by[6][3] == by[7][3] == "block" and by[8] == ("x.com", "", None, "allow") and by[9][3] == "allow"
    without = sorted(map(tuple, url_filter(frame.where("page_id <> 3"), rules).select("page_id", "verdict").collect()))
    assert dict(without)[1] == dict(without)[2] == "block"
    assert url_filter(frame.limit(0), rules).count() == 0
    extra = spark.createDataFrame([("http://fine.org/", "http://a.bad.net/x"), (None, "http://far.com/")], "a string, b string")
    assert url_filter(frame.where("page_id in (0, 4)").replace("http://Fine.org/", "http://fine.org/"), rules, extra).where("page_id = 4").head().verdict == "block"


# -- pipeline -------------------------------------------------------------------
@pytest.fixture
def short_fit(monkeypatch):
    """The quality stage with few updates; the full fit is op2's."""
    monkeypatch.setattr(corpus_pipeline, "fit_quality", lambda *a: fit_quality(*a, updates=30))


def test_pipeline_stages(spark, short_fit):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "simhash_dedup", "mixing", "bpe"]
    stage = dict(corpus_pipeline.STAGES)

    good = stage["quality"](spark, docs, SF)
    network = fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"), updates=30)
    want = {r.doc_id for r in score_quality(docs, network).where("score >= 0.3").collect()}
    assert {r.doc_id for r in good.collect()} == want and good.columns == docs.columns

    rows = docs.select("doc_id", "text").collect()
    first = {}
    for k, t in sorted((r.doc_id, re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")) for r in rows):
        first.setdefault(t, k)
    unique = stage["exact_dedup"](spark, docs, SF)
    assert {r.doc_id for r in unique.collect()} == set(first.values()) and unique.columns == docs.columns

    fps = {r.doc_id: int(r.fingerprint, 16) for r in QUERIES["op7_simhash"](spark, SF).collect()}
    low = {a: min(b for b in fps if (fps[a] ^ fps[b]).bit_count() <= 3) for a in fps}
    near = {r.doc_id for r in stage["simhash_dedup"](spark, docs, SF).collect()}
    assert near <= {a for a in fps if low[a] == a} and all(any((fps[a] ^ fps[b]).bit_count() <= 3 for b in near) or low[a] != a for a in fps)

    times = {r.doc_id: r.repeats for r in mix(docs).collect()}
    mixed = stage["mixing"](spark, docs, SF)
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {k: v for k, v in times.items() if v}

    last = stage["bpe"](spark, docs, SF)
    assert last.count() == docs.count() and last.where("n_tokens <> size(ids)").count() == 0


def test_pipeline_runs(spark, short_fit):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "ids", "n_tokens"] and out.count() > 0


@pytest.mark.parametrize("name", ["exact_dedup", "simhash_dedup", "mixing", "bpe", "quality"])
def test_stages_take_awkward_rows(spark, short_fit, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = documents(spark).withColumn("lang", F.lit("en"))
    out = stage(spark, docs, SF)
    assert out.count() >= 1
    assert stage(spark, docs.limit(0), SF).count() == 0
