"""Cases in which one row, slot, node or character must not decide for others."""
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scorecraft.llm import components as comp
from scorecraft.llm import quality
from scorecraft.llm.batches import text_buffer
from scorecraft.llm.library import Library, read_spec
from scorecraft.llm.mixing import mix
from scorecraft.llm.token_counts import token_counts
from scorecraft.llm.url_filter import page_edges, url_filter

from tests.llm.helpers import awkward_texts, text

JSON = P.path("byte_bpe_50k.json")


# -- mixing ---------------------------------------------------------------------
def _misses(rows):
    """For each source: words off its target, and half of the smallest slot not taken (+1)."""
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    out = {}
    for source, group in by.items():
        least = min(r.repeats for r in group)
        left = [r.size for r in group if r.repeats == least and r.size]
        out[source] = abs(sum(r.taken for r in group) - group[0].target), (min(left) / 2 if left else 0) + 1e-6
    return out


@pytest.mark.parametrize("each,long", [(10, 0), (50, 0), (50, 100_000), (300, 100_000)])
def test_few_or_dominating_documents_come_near(spark, each, long):
    rows = [(1000 * s + k, " w" * (20 + (k * 37 + s * 11) % 400), f"s{s}") for s in range(6) for k in range(each)]
    if long:
        rows += [(9000 + s, " w" * long, f"s{s}") for s in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs).collect()
    for source, (off, bound) in _misses(got).items():
        assert off <= bound, source
    assert all(r.taken <= 3 * r.size for r in got)


# -- quality --------------------------------------------------------------------
def test_one_very_long_text_leaves_the_sample_as_it_is(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality.Network, "fit", classmethod(lambda cls, texts, *a, **k: seen.append(texts) or cls.start(1)))
    rows = [(k, text(k, 30)) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int")
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string")
    quality.fit_quality(frame(rows), labels, train_bytes=100_000)
    rows[101] = (101, text(101, 30) * 1000)
    rows[4] = (4, text(4, 30) * 1000)
    quality.fit_quality(frame(rows), labels, train_bytes=100_000)
    before, after = ({len(t): t for t in x} for x in seen)
    long = [t for t in seen[1] if len(t) > 2000]
    assert not long and len(seen[0]) - len(seen[1]) <= 2 and len(seen[1]) > 100


def _plain_score(net, data: bytes) -> float:
    """The network's forward pass, chunk by chunk and filter by filter."""
    w = {k: v.astype(np.float64) for k, v in net.w.items()}
    half, width, stride = quality.HALF, quality.WIDTH, quality.STRIDE
    halves = max(2, -(-(len(data) + width) // half))
    codes = [*data] + [quality.PAD] * (halves * half - len(data))
    features = []
    for c in range(halves - 1):
        values = []
        lo, hi = c * half, (c + 2) * half
        for f in range(quality.FILTERS):
            best = -np.inf
            for at in range(lo, hi, stride):
                # windows begin in the chunk and end in the text
                if at + width <= len(codes):
                    best = max(best, float(np.concatenate([w["embed"][b] for b in codes[at:at + width]]) @ w["filters"][:, f]))
            values.append(best + w["bias"][f])
        full = sum(sum(b != quality.PAD for b in codes[a:a + half]) / half for a in (lo, lo + half))
        features.append(np.tanh(np.array([*values, full]) @ w["hidden"] + w["hidden_bias"]))
    features = np.array(features)
    logit = np.concatenate([features.mean(axis=0), features.max(axis=0)]) @ w["out"] + w["out_bias"][0]
    return 1 / (1 + np.exp(-logit))


def test_scores_are_those_of_a_plain_loop():
    net = quality.Network.start(5)
    rng = np.random.default_rng(2)
    for v in net.w.values():
        v += rng.normal(size=v.shape).astype(np.float32) * 0.1
    texts = ["", "a", text(1, 20), text(2, 90), "x" * 116, "x" * 117, "é" * 300]
    got = net.score(*text_buffer(pa.array(texts, pa.large_string())))
    want = [_plain_score(net, t.encode()) for t in texts]
    np.testing.assert_allclose(got, want, atol=2e-5)


# -- urls -----------------------------------------------------------------------
def test_comments_and_scripts_hold_no_links(spark):
    bad = "<link rel=canonical href=http://a.bad.net/x>"
    html = [f"<!-- {bad} -->", f"<script>var s = '{bad}';</script>", f"<SCRIPT type=x>{bad}</script >", f"<style>{bad}</style>", f"<!-- {bad}", f"<script>{bad}",
            f"<!-- a --> {bad} <!-- b -->", f"<script></script>{bad}<script></script>", "x" * 3_000_000 + bad]
    pages = spark.createDataFrame([(k, f"http://p{k}.com/", h) for k, h in enumerate(html)] + [(99, "http://a.bad.net/x", None)], "page_id long, url string, html string")
    assert sorted(r["a"] for r in page_edges(pages).collect()) == ["http://p6.com/", "http://p7.com/", "http://p8.com/"]
    got = {r.page_id: r.verdict for r in url_filter(pages, [("bad.net/", "block")]).collect()}
    assert [got[k] for k in range(9)] == ["allow"] * 6 + ["block"] * 3


# -- components -----------------------------------------------------------------
@pytest.mark.parametrize("rows", [2_000_000, 0])
def test_a_hub_and_a_path(spark, rows, monkeypatch):
    monkeypatch.setattr(comp, "DEFAULT_BROADCAST_ROWS", rows)  # 0: edges too many to send out
    edges = [(0, k) for k in range(1, 400)] + [(1000 + k, 1001 + k) for k in range(60)] + [(500, 399), (2000, 2000), (None, 3)]
    got = {r["node"]: r["component"] for r in comp.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(400)} | {500: 0} | {1000 + k: 1000 for k in range(61)}
    assert got == want


# -- tokens ---------------------------------------------------------------------
OTHERS = ["price 5€ and 7 €", "a\xa0b\x85c", "привет мир, 12ый", "🙂🙂 ok 👍🏽", "漢字かな 混じり文", "Ἑλλάς ελλάδα", "क्षि नमस्ते", "tab\tand wide　space", "x‍ýz'll  'S"]


def test_other_scripts_are_cut_into_pre_tokens():
    """Only texts with added strings are whole; all others go by pre-token, as the library does."""
    lib, tokenizer = Library(read_spec(JSON)), Tokenizer.from_file(JSON)
    texts = [*OTHERS, *(t or "" for t in awkward_texts())]
    buf, off = text_buffer(pa.array(texts, pa.large_string()))
    starts, whole = lib.cut(buf, off)
    assert [texts[k] for k in np.flatnonzero(whole)] == [t for t in texts if "<|endoftext|>" in t]
    for k, t in enumerate(texts):
        if whole[k] or not t:
            continue
        at = [int(s) for s in starts if off[k] <= s < off[k + 1]] + [int(off[k + 1])]
        pieces = [buf[a:b].tobytes() for a, b in zip(at, at[1:])]
        flat, count = lib.of_pieces(pa.array(pieces, pa.large_binary()))
        assert flat.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t
        assert lib.count_pieces(pieces) == count.tolist()


def test_counts_of_other_scripts(spark):
    tokenizer = Tokenizer.from_file(JSON)
    docs = spark.createDataFrame(list(enumerate(OTHERS * 2)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, JSON).collect()}
    assert got == {k: len(tokenizer.encode(t, add_special_tokens=False).ids) for k, t in enumerate(OTHERS * 2)}
