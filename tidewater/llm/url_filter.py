"""URL filters with redirect equivalence: rules on hosts and paths, carried over to aliases.

Redirects (meta refresh) and canonical links join URLs into components, found by
distributed label propagation. A URL that no rule fits is blocked if a rule blocks any
URL of its component; a URL that a rule fits keeps that rule's verdict, so an explicit
allow is never overridden by an alias.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import with_row_id
from tidewater.llm.graph import components

#: The rules of the registered query: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none or the URL is NULL."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _plain(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    step = lambda kept, x: (F.when(x == ".", kept)
                            .when(x == "..", F.slice(kept, 1, F.greatest(F.lit(1), F.size(kept) - 1)))
                            .otherwise(F.concat(kept, F.array(x))))
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), step)
    last = F.element_at(parts, -1)
    return F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")


def resolved(target: Column, url: Column) -> Column:
    """``target`` as an absolute URL, as a link on the page ``url``; NULL for another kind of address, such as mailto."""
    scheme = F.regexp_extract(url, r"^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0))
    page = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    path, rest = F.regexp_extract(target, r"^[^?#]*", 0), F.regexp_extract(target, r"^[^?#]*(.*)$", 1)
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*(\?[^#]*)", 1)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(site, _plain(path), rest))
            .when(target.startswith("?"), F.concat(site, page, target))
            .when(target.startswith("#"), F.concat(site, page, query, target))
            .otherwise(F.concat(site, _plain(F.concat(F.regexp_extract(page, r"^.*/", 0), path)), rest)))


def link_targets(html: Column, url: Column) -> Column:
    """URLs that a page's head names as itself elsewhere, canonical links and refresh redirects, made absolute by the page's."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    canonical = F.filter(tags, lambda t: t.rlike(r"(?is)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"))
    refresh = F.filter(tags, lambda t: t.rlike(r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"))
    href = F.transform(canonical, lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1))
    move = F.transform(refresh, lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)", 1))
    named = F.filter(F.concat(href, move), lambda u: u != "")
    found = F.filter(F.transform(named, lambda u: resolved(u, url)), lambda u: u.isNotNull())
    # most pages have neither word, and need no look at their tags
    return F.when(html.rlike(r"(?i)canonical|http-equiv"), found).otherwise(F.array().cast("array<string>"))


def url_key(url: Column) -> Column:
    """What makes two URLs the same here: all but the scheme, the host's case and the fragment."""
    return F.concat(host_of(url), F.regexp_extract(after_scheme(url), r"^[^/?#]*([^#]*)", 1))


def fit(urls: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """The longest rule for each row of ``urls`` (``key``, host, path): key, rule, rule_verdict; rows without one are left out.

    A host is looked up by each of its suffixes, an equality join that needs no pass over all
    rules; Spark broadcasts the rules if they are small. Of rules as long as each other the
    allowing one, then the greater text wins. Rules with a NULL part fit nothing.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    r = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    hits = (urls.select(key, "path", F.explode(suffixes).alias("r_host"))
            .join(r, "r_host").where(F.col("path").startswith(F.col("r_path")) & F.col("r_verdict").isNotNull()))
    rule = F.concat("r_host", "r_path")
    best = F.max(F.struct(F.length(rule), F.col("r_verdict") == "allow", rule.alias("rule"), "r_verdict"))
    return hits.groupBy(key).agg(best.alias("b")).select(key, F.col("b.rule").alias("rule"), F.col("b.r_verdict").alias("rule_verdict"))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "page_id",
          extra_links: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for each page.

    ``extra_links`` (from_url, to_url): redirects known from elsewhere, such as a crawl log.
    NULL or scheme-less URLs have empty host and path, fit no rule and are allowed; NULL
    html has no links; relative links follow the page's URL. Repeated pages and ids each keep their row; other columns are not read.
    """
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    links = p.select("url", F.explode(link_targets(F.col("html"), F.col("url"))).alias("to"))
    if extra_links is not None:
        links = links.union(extra_links.select(F.col("from_url"), F.col("to_url")))
    links = links.where((F.instr("url", "://") > 0) & (F.instr("to", "://") > 0))
    alias = components(links.select(url_key(F.col("url")).alias("a"), url_key(F.col("to")).alias("b")), "a", "b")

    # a component is blocked if a rule blocks one of its URLs, be it a page here or not
    node_host, node_path = F.regexp_extract("node", r"^[^/?#]*", 0), F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1)
    nodes = alias.select("node", "component", node_host.alias("host"), node_path.alias("path"))
    blocked = (alias.join(fit(nodes, rules, "node").where(F.col("rule_verdict") == "block"), "node")
               .select("component").distinct().withColumn("alias_blocked", F.lit(True)))
    by_alias = alias.join(blocked, "component").select("node", "alias_blocked")

    own = with_row_id(p.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                               F.when(F.instr("url", "://") > 0, url_key(F.col("url"))).alias("node")))
    verdict = F.coalesce("rule_verdict", F.when(F.col("alias_blocked"), F.lit("block")), F.lit("allow"))
    return (own.join(fit(own, rules, "rid"), "rid", "left").join(by_alias, "node", "left")
            .select("page_id", "host", "path", "rule", verdict.alias("verdict")))


def oracle(table: str = "pages") -> str:
    """DuckDB SQL for ``judge`` with RULES over pages that carry no redirect or canonical link to another URL."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {rules}),
p AS (SELECT row_number() OVER () AS rid, page_id,
             CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM {table}),
q AS (SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
fit AS (SELECT rid, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
               arg_max(r_verdict, length(r_host || r_path)) AS verdict
        FROM q JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
        GROUP BY rid)
SELECT q.page_id, q.host, q.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
FROM q LEFT JOIN fit ON q.rid = fit.rid"""
