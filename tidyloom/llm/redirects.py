"""URL filters with redirect equivalence: block decisions reach every alias of a page.

Only DataFrame functions run. A page's canonical link and its refresh target
are edges between addresses; connected components over them are the aliases. A
rule that fits a page's own address decides first, and the longest rule wins.
A page without a rule of its own is blocked where an alias is blocked, unless
an alias is allowed by a rule: an explicit allow takes precedence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyloom.llm.store import connected, saved

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MARKED = r"(?i)canonical|http-equiv"
_TAG = r"(?i)<(?:link|meta)\b[^>]*+"
# Of a tag: whether it names the canonical address or a refresh, and the address. A value ends at its quote, or else at a blank.
_CANONICAL = r"(?is)^<link\b.*?(?<![\w-])rel\s*+=\s*+(?:\"(?:[^\"]*\s)?canonical[\s\"]|'(?:[^']*\s)?canonical[\s']|canonical(?![^\s/]))"
_HREF = r"(?is)(?<![\w-])href\s*+=\s*+(\"[^\"]*+|'[^']*+|[^\s\"'>]++)"
_REFRESH = r"(?is)^<meta\b.*?(?<![\w-])http-equiv\s*+=\s*+[\"']?\s*+refresh\b"
_URL = r"(?is)(?<![\w-])url\s*+=\s*+[\"']?\s*+([^\"'\s>]++)"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path; both empty for a null address or one without ``://``."""
    rest = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def address(url: Column) -> Column:
    """What stands for an address in edges: host, path and query; scheme and fragment do not matter."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*(\?[^#]*)?", 1)
    path = F.when(path == "", F.lit("/")).when(path.rlike(r"/\.\.?(?:/|$)"), _undotted(path)).otherwise(path)
    return F.when(host != "", F.concat(host, path, query))


def _undotted(path: Column) -> Column:
    """The path without its steps ``.`` and ``..``."""
    steps = F.split(path, "/")
    up = lambda kept: F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
    kept = F.aggregate(
        F.slice(steps, 2, F.size(steps)),
        F.array().cast("array<string>"),
        lambda kept, step: F.when(step == ".", kept).when(step == "..", up(kept)).otherwise(F.concat(kept, F.array(step))),
    )
    closed = F.when(path.rlike(r"/\.\.?$"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(closed, "/"))


def _targets(html: Column) -> Column:
    """All addresses that canonical links and refreshes of a page name, as written but for the escape of ``&``."""
    tags = F.regexp_extract_all(html, F.lit(_TAG), F.lit(0))
    links = F.transform(F.filter(tags, lambda tag: tag.rlike(_CANONICAL)), lambda tag: F.regexp_extract(tag, _HREF, 1))
    refreshes = F.transform(F.filter(tags, lambda tag: tag.rlike(_REFRESH)), lambda tag: F.regexp_extract(tag, _URL, 1))
    plain = lambda t: F.regexp_replace(F.regexp_replace(t, r"^[\s\"']+|\s+$", ""), "(?i)&(?:amp|#0*38|#x0*26);", "&")
    return F.when(html.rlike(_MARKED), F.transform(F.concat(links, refreshes), plain))


def _resolved(target: Column, host: Column, path: Column) -> Column:
    """The target as an absolute address, read on a page of the host and path; null where it is none."""
    page = F.concat(F.lit("http://"), host)
    whole = F.when(path == "", F.lit("/")).otherwise(path)
    return (
        F.when(target.rlike(_SCHEME + "//"), target)
        .when(target.rlike(_SCHEME) | target.startswith("#"), F.lit(None).cast("string"))  # mailto: and the like; the page itself
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(page, target))
        .when(target.startswith("?"), F.concat(page, whole, target))
        .otherwise(F.concat(page, F.regexp_replace(whole, "[^/]*$", ""), target))
    )


def judged(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """The id, ``host``, ``path``, ``rule``, ``verdict`` and ``alias_rule`` (decided by aliases) for every page.

    ``rules`` are (verdict, host, path) with verdict allow or block. A rule fits
    its host and all subdomains when the path starts with the rule's; the
    longest (host and path together) wins, allow before block at one length.
    ``redirects`` may add edges between addresses (columns ``source``, ``target``).

    Defined cases: a null address, or one without ``://``, has an empty host and
    path, no rule and no alias and is allowed; null or empty html has no edge;
    relative link targets are resolved against the page's address; every canonical
    link and refresh of a page is an edge; repeated rows are each
    judged; an empty table gives no row. Other columns are ignored.
    """
    url, html = F.col(url_column), F.col(html_column)
    host, path = host_and_path(url)
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in reversed(ordered):
        fits = _fits(F.col("host"), F.col("path"), rule_host, rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    rows = pages.select(F.col(id_column).alias("id"), url.alias("url"), host.alias("host"), path.alias("path"), address(url).alias("node"), _targets(html).alias("targets"))
    rows = saved(rows.withColumns({"rule": rule, "own": verdict}), "pages")
    edges = rows.where("node is not null").select("node", "host", "path", F.explode("targets").alias("t")).where("t <> ''")
    edges = saved(edges.select(F.col("node").alias("a"), _resolved(F.col("t"), F.col("host"), F.col("path")).alias("t")), "targets")
    edges = edges.select("a", address(F.col("t")).alias("b"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(address(F.col("source")).alias("a"), address(F.col("target")).alias("b")))
    groups = saved(connected(edges, "a", "b"), "aliases")
    # What each group of aliases has been told: pre-aggregated, so a large group is no large task.
    told = rows.where("own is not null").select("node", "own").distinct().join(groups, "node")
    heard = told.groupBy("component").agg(F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
    heard = saved(groups.join(heard, "component").select("node", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("alias_rule")), "heard")
    out = rows.where("node is not null").join(heard, "node", "left").select("id", "host", "path", "rule", "own", "alias_rule")
    out = out.unionByName(rows.where("node is null").select("id", "host", "path", "rule", "own", F.lit(None).cast("string").alias("alias_rule")))
    return out.select(F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("own", "alias_rule", F.lit("allow")).alias("verdict"), "alias_rule")
