"""One query per operator: ``opN_<name>`` applies it to its whole table."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM n""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts (white space normalised) among all documents."""
    from scorecraft.llm.exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op3_mixing", r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 3))::INT AS slot FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
r AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k FROM s),
c AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
             sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
             (SELECT sum(source_size) FROM s) AS total FROM r),
l AS (SELECT arg_min((total - gone)::DOUBLE / open::DOUBLE, k) AS level FROM c WHERE cap > (total - gone)::DOUBLE / open::DOUBLE * weight),
t AS (SELECT source, source_size, least(cap::DOUBLE, level * weight) AS target FROM r, l),
w AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
g AS (SELECT *, target - whole * source_size AS goal FROM w),
b AS (SELECT source, slot, sum(size)::BIGINT AS words FROM d GROUP BY source, slot),
o AS (SELECT g.source, goal, list(slot ORDER BY slot) AS slots, list(words ORDER BY slot) AS sums FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source
      WHERE goal > 0 GROUP BY g.source, goal),
p AS (SELECT source, 0 AS i, 0::BIGINT AS filled, false AS took FROM o
      UNION ALL SELECT p.source, i + 1, CASE WHEN filled + sums[i + 1] <= goal THEN filled + sums[i + 1] ELSE filled END, filled + sums[i + 1] <= goal
      FROM p JOIN o ON p.source IS NOT DISTINCT FROM o.source WHERE i < len(slots)),
u AS (SELECT p.source, slots[i] AS slot, sums[i] AS words, took, goal - max(filled) OVER (PARTITION BY p.source) AS gap
      FROM p JOIN o ON p.source IS NOT DISTINCT FROM o.source WHERE i > 0),
f AS (SELECT source, min({'off': abs(words - gap), 'slot': slot, 'gap': gap}) AS fit FROM u WHERE NOT took GROUP BY source),
h AS (SELECT source, slot FROM u WHERE took UNION ALL SELECT source, fit.slot FROM f WHERE fit.off < fit.gap)
SELECT doc_id, size::BIGINT AS size, source_size, target, ((whole + (h.slot IS NOT NULL)::INT) * size)::BIGINT AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN h ON d.source IS NOT DISTINCT FROM h.source AND d.slot = h.slot""")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents: sources weigh 1, 2, 3 in turn, at most 3 epochs each."""
    from scorecraft.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op4_embedding_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a""")
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.9 or more among all embeddings, and their components."""
    from scorecraft.llm.embedding_dedup import embedding_dedup
    return embedding_dedup(table(spark, sf_dir, "embeddings"), 0.9)


# Urls are judged once each; links come from canonical and refresh tags, resolved against the page.
_URL_SQL = r"""
WITH RECURSIVE read_html AS (SELECT url, regexp_replace(html, '(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)', ' ', 'g') AS html
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM read_html),
raw AS (SELECT url AS a, CASE
    WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) END AS b FROM tags),
e0 AS (SELECT DISTINCT a, CASE WHEN starts_with(b, '//') THEN regexp_extract(a, '(?s)^(.*?)://', 1) || ':' || b
    WHEN starts_with(b, '/') THEN regexp_extract(a, '(?s)^.*?://[^/?#]*') || b ELSE b END AS b FROM raw WHERE b <> ''),
e AS (SELECT a, b FROM e0 WHERE a <> b UNION SELECT b, a FROM e0 WHERE a <> b),
reach AS (SELECT DISTINCT a AS node, a AS other FROM e UNION SELECT reach.node, e.b FROM reach JOIN e ON reach.other = e.a),
urls AS (SELECT url FROM pages UNION SELECT node FROM reach),
parts AS (SELECT url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM urls),
fit AS (SELECT *, '.' || host AS h FROM parts),
judged AS (SELECT url, host, path, CASE WHEN ends_with(h, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with(h, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with(h, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN ends_with(h, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM fit),
own AS (SELECT *, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' END AS said FROM judged),
alias AS (SELECT node, coalesce(bool_or(said = 'block'), false) AND NOT coalesce(bool_or(said = 'allow'), false) AS spread FROM reach JOIN own ON own.url = other GROUP BY node)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN spread THEN 'block' ELSE 'allow' END) AS verdict
FROM pages JOIN own ON pages.url IS NOT DISTINCT FROM own.url LEFT JOIN alias ON alias.node = pages.url"""

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query("op5_url_filter", _URL_SQL)
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by the longest rule or its aliases."""
    from scorecraft.llm.url_filter import url_filter
    return url_filter(table(spark, sf_dir, "pages"), URL_RULES).drop("component")


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints (3-word shingles) and components over at most 3 differing bits."""
    from scorecraft.llm.simhash import simhash_dedup
    return simhash_dedup(table(spark, sf_dir, "documents"), 3, 3).select("doc_id", "fingerprint", "component_id")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written to binary files in ascending doc_id order, then read back."""
    from scorecraft.llm.token_files import read_token_files, write_token_files
    from scorecraft.session import scratch_path
    folder = scratch_path(spark, "token_files")
    write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return (read_token_files(spark, folder, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "long")
            .withColumnRenamed("tokens", "ids_crc32"))


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    from scorecraft.llm.bpe import decode, encode
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = decode(encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    from scorecraft.llm.token_counts import token_counts
    rows = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out ids are not learned from."""
    from scorecraft.llm.quality import fit_quality, held_out, score_quality
    docs = table(spark, sf_dir, "documents")
    network = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, network).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                               (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document less the passages of whole lines that stand in an earlier one."""
    from scorecraft.llm.line_dedup import passage_dedup
    return passage_dedup(table(spark, sf_dir, "documents"))


@query("op13_sentence_piece")
def op13_sentence_piece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, with begin and end ids, and the text they decode to, as digests."""
    from scorecraft.llm.sentence_piece import decode, encode
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode(encode(table(spark, sf_dir, "documents"), model), model, digest="ids_sha256")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def _with_repetitions(docs: DataFrame) -> DataFrame:
    """Texts, of which one in ten repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("words", F.when(F.col("chosen"), words)).withColumn("n", F.size("words").cast("long"))
    a = F.col("g") % F.col("n")
    rows = rows.withColumn("a", a).withColumn("p", 1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8)))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get(
        "words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), F.concat_ws(" ", again)).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every document, the one of the greatest exponent, and the text without repetitions."""
    from scorecraft.llm.periodic_runs import periodic_runs
    rows = periodic_runs(_with_repetitions(table(spark, sf_dir, "documents")))
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("start", "length", "period")])
    # the first of the greatest ratios; lengths and periods are far below the root of 2^63
    best = F.aggregate("runs", zero, lambda m, r: F.when((m["period"] == 0) | (r["length"] * m["period"] > m["length"] * r["period"]), r).otherwise(m))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    rows = rows.withColumn("best", F.when(F.size("runs") > 0, best))
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _rebuilt(rows: DataFrame) -> DataFrame:
    """Paths with the first turns of the conversation of the next lower multiple of five put first."""
    from scorecraft.llm.prefix_trie import head, tail
    conv = F.col("conv_id")
    rows = rows.withColumn("h", (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int"))
    first, sizes = head(F.col("path"), F.col("sizes"), F.lit(8))
    base = rows.where(conv % 5 == 0).select(conv.alias("base"), first.alias("base_path"), sizes.alias("base_sizes"))
    own, own_sizes = tail(F.col("path"), F.col("sizes"), F.col("h"))
    took, took_sizes = head(F.coalesce("base_path", F.lit(b"")), F.coalesce("base_sizes", F.array().cast("array<long>")), F.col("h"))
    return rows.join(base, conv - conv % 5 == F.col("base"), "left").select(
        "conv_id", F.concat(took, own).alias("path"), F.concat(took_sizes, own_sizes).alias("sizes"))


@query("op12_prefix_trie", """
WITH t0 AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t1 AS (SELECT *, sha256(strlen(role)::VARCHAR || ':' || role || text) AS mark FROM t0),
t AS (SELECT conv_id, mark, strlen(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, mark) AS k FROM t1),
c AS (SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(s) + 1), lambda i: ord(s[i]))),
        lambda x, b: list_reduce(list_prepend(xor(x, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 9 AS h
      FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM t0)),
r AS (SELECT c.conv_id, 0 AS part, k, mark, size FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 WHERE k <= h
      UNION ALL SELECT c.conv_id, 1, k, mark, size FROM c JOIN t ON t.conv_id = c.conv_id WHERE k > h),
o AS (SELECT *, row_number() OVER w AS d, sha256(string_agg(mark, '') OVER w) AS node FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, k)),
p AS (SELECT conv_id, d, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY d), 'root') AS up, size FROM o
      UNION ALL SELECT conv_id, 0, 'root', NULL, 0 FROM c),
n AS (SELECT node, min(conv_id) AS conv_id, any_value(d) AS depth, any_value(up) AS up, any_value(size) AS size, count(*) AS n_convs FROM p GROUP BY node),
kids AS (SELECT up, count(*) AS n_children FROM n GROUP BY up),
e AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends
      FROM (SELECT conv_id, arg_max(node, d) AS node FROM p GROUP BY conv_id) GROUP BY node),
b AS (SELECT p.node, sum((n.n_convs - 1) * n.size) AS saved, count_if(kids.n_children IS NULL) AS leaves
      FROM n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.depth LEFT JOIN kids ON kids.up = n.node GROUP BY p.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children, b.leaves::BIGINT AS n_leaves,
       b.saved::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM n JOIN b ON b.node = n.node LEFT JOIN n a ON a.node = n.up LEFT JOIN kids ON kids.up = n.node LEFT JOIN e ON e.node = n.node""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    from scorecraft.llm.prefix_trie import paths, prefix_trie
    from scorecraft.llm.staging import staged
    return prefix_trie(_rebuilt(staged(paths(table(spark, sf_dir, "conversations")), "turns")))
