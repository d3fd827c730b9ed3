"""URL filters with redirect equivalence.

Every url is judged by the longest rule that fits its host and path.  Urls that
redirect to one another (a page's refresh target) or name one another as canonical
are one resource: connected components over those edges carry block decisions to
aliases.  Explicit allow takes precedence: an allowed url stays allowed, and it
shields the aliases without a rule of their own in its component.

Html is scanned by JVM regular expressions for the two kinds of link; only edges,
urls and rules are shuffled, never html.  Urls are one node each, however many
pages share them; a node with many links is a skewed join key, which adaptive
execution splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.components import components
from scorecraft.llm.staging import staged
from scorecraft.operators.joins import sized_join

# A canonical link or a refresh, with its target; attributes in any order, quoted or not.
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits.  A rule
    ``host/path`` fits its host and all subdomains if the path starts with its path;
    of equally long ones, allow wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, kind in sorted(rules, key=lambda r: (len(r[0]), r[1] == "allow")):  # the last that fits wins
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _bare(url: Column) -> Column:
    """Without its fragment."""
    return F.regexp_extract(url, r"(?s)^[^#]*", 0)


def _without_dots(path: Column) -> Column:
    """``path`` (empty or from its first slash) without ``.`` and ``..`` segments."""
    parts = F.split(path, "/", -1)
    step = lambda done, x: (F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
                            .when(x == ".", done).otherwise(F.concat(done, F.array(x))))
    done = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")).cast("array<string>"), step)
    ends = path.rlike(r"(?s)/\.\.?$")  # names a folder
    return F.when(path == "", path).otherwise(F.array_join(F.when(ends, F.concat(done, F.array(F.lit("")))).otherwise(done), "/"))


def resolved(target: Column, page: Column) -> Column:
    """The url that a reference in the html of ``page`` means (RFC 3986), without its
    fragment; null where it is no url with ``://`` or the page's is none to resolve against."""
    ref = _bare(F.regexp_replace(target, "(?i)&(amp|#38|#x26);", "&"))
    scheme, site = F.regexp_extract(page, r"(?s)^(.*?)://", 1), F.regexp_extract(page, r"(?s)^.*?://[^/?#]*", 0)
    path, query = path_of(page), F.regexp_extract(page, r"(?s)^[^?#]*(\?[^#]*)", 1)
    own, more = F.regexp_extract(ref, r"(?s)^[^?]*", 0), F.regexp_extract(ref, r"(?s)(\?.*)$", 1)  # its path and query
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^.*/", 0))
    full = (F.when(ref == "", F.concat(site, path, query))
            .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), ref)
            .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
            .when(ref.startswith("/"), F.concat(site, ref))
            .when(ref.startswith("?"), F.concat(site, path, ref))
            .otherwise(F.concat(site, folder, own, more)))
    whole = F.regexp_extract(full, r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*", 0)
    clean = F.concat(whole, _without_dots(path_of(full)), F.regexp_extract(full, r"(?s)^[^?]*(\?.*)$", 1))
    return F.when(whole != "", clean)


# What a browser does not read as tags: comments (to the end, if it is missing), scripts and styles.
UNREAD = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (a, b) between a page's url and what it redirects to or calls canonical,
    both without fragments.  Tags in comments, scripts and styles are none."""
    # only a page with one of these words can hold such a tag
    some = pages.where(F.col(url_col).isNotNull() & F.col(html_col).rlike("(?i)canonical|refresh"))
    html = F.regexp_replace(html_col, UNREAD, " ")
    found = some.select(
        F.col(url_col).alias("a"), F.explode(F.concat(F.regexp_extract_all(html, F.lit(CANONICAL), 1), F.regexp_extract_all(html, F.lit(REFRESH), 1))).alias("b"))
    return found.select(_bare(F.col("a")).alias("a"), resolved(F.col("b"), F.col("a")).alias("b")).where("b is not null").distinct()


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id_col, host, path, rule (the longest fitting one
    or null), verdict and component (the smallest url among a url's aliases, itself
    without any).  ``rules`` is a list of (rule, ``allow`` or ``block``), held in the
    plan; ``redirects`` adds edges (a, b) between urls, from a crawl log for example.

    References are resolved against the page's url; urls that differ in the fragment
    only are one resource to links, so component has none where there are aliases.

    Cases: a null url or one without ``://`` has empty host and path, fits no rule and
    has no alias; null html has no links; without a rule the verdict is block if a url
    of the component is blocked and none is allowed, else allow; repeated rows are
    judged alike; an empty table gives an empty result; other columns are not read."""
    edges = page_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(_bare(F.col("a")).alias("a"), _bare(F.col("b")).alias("b"))).distinct()
    found = staged(components(edges), "aliases")  # urls in edges only
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judge = lambda df, url: df.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url))).withColumn("rule", rule).withColumn("own", verdict)
    # targets that are not pages count as well: a redirect to a blocked url is blocked
    spread = (judge(found, "node").groupBy("component")
              .agg(F.max(F.col("own") == "block").alias("blocked"), F.max(F.col("own") == "allow").alias("allowed")))
    alias = found.join(spread, "component").select(F.col("node").alias("bare"), "component", (F.col("blocked") & ~F.coalesce("allowed", F.lit(False))).alias("spread"))
    rows = judge(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), "url").withColumn("bare", _bare(F.col("url")))
    out = sized_join(rows, staged(alias, "aliases"), "bare", "left", written=True)
    method = F.when(F.coalesce("spread", F.lit(False)), "block").otherwise("allow")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("own", method).alias("verdict"), F.coalesce("component", "url").alias("component"))
