"""URL block and allow rules that reach all aliases of an address.

Addresses, host and path, are linked by redirects and canonical links.  Connected
components of these links are the aliases; the rules that fit any of them decide about
those that no rule fits, and an explicit allow goes before a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.common import ascii_lower, checkpointed
from auditflow.llm.components import connected_components

#: The rules of the query, as action, host and path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_TAG = r"(?i)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b"
_REFRESH = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b"
_HREF = r"(?i)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
_TARGET = r"(?i)\burl\s*=\s*[\"']?([^\"'>]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 2)


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "action string, host string, path string")


def links_of(html: Column) -> Column:
    """References of canonical links and of redirects by refresh, in the order of the page."""
    def reference(tag: Column) -> Column:
        href = F.concat(*[F.regexp_extract(tag, _HREF, i) for i in (1, 2, 3)])
        return F.trim(F.when(tag.rlike(_CANONICAL), href).when(tag.rlike(_REFRESH), F.regexp_extract(tag, _TARGET, 1)).otherwise(""))

    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TAG), F.lit(0))
    return F.filter(F.transform(tags, reference), lambda r: r != "")


def resolved(reference: Column, host: Column, path: Column) -> Column:
    """A full URL for a reference found at ``host`` and ``path``."""
    return (F.when(reference.contains("://"), reference)
            .when(reference.startswith("//"), F.concat(F.lit("http:"), reference))
            .when(reference.startswith("/"), F.concat(F.lit("http://"), host, reference))
            .when(reference.rlike("^[?#]"), F.concat(F.lit("http://"), host, path))
            .otherwise(F.concat(F.lit("http://"), host, F.regexp_replace(path, "[^/]*$", ""), reference)))


def address_key(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


def explicit_decisions(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``node, rule, action`` of the addresses ``node, host, path`` that some rule fits.

    A rule fits its host and all subdomains if the path starts with its own; the longest
    wins, and of equally long ones an allow.
    """
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    asked = addresses.select("node", "path", F.explode(suffixes).alias("suffix"))
    named = rules.where("host IS NOT NULL").select(
        "action", F.col("host").alias("suffix"), F.coalesce("path", F.lit("")).alias("rule_path"))
    rule = F.concat("suffix", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("size"), (F.col("action") == "allow").alias("allows"), rule.alias("rule"), "action")).alias("best")
    return asked.join(named, "suffix").where(F.col("path").startswith(F.col("rule_path"))).groupBy("node").agg(best).select(
        "node", "best.rule", "best.action")


def alias_decisions(edges: DataFrame, decided: DataFrame) -> DataFrame:
    """``node, component, action`` of every linked address; the action is null if no rule fits any alias."""
    found = checkpointed(connected_components(edges, "a", "b"))
    allows, blocks = (F.bool_or(F.col("action") == a).alias(a) for a in ("allow", "block"))
    known = found.join(decided.select("node", "action"), "node").groupBy("component").agg(allows, blocks)
    verdict = F.when(F.col("allow"), F.lit("allow")).when(F.col("block"), F.lit("block"))
    return found.join(checkpointed(known), "component", "left").select("node", "component", verdict.alias("action"))


def judge_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None, page_id: str = "page_id", url: str = "url",
               html: str | None = "html") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, component``.

    The verdict is that of the page's own rule; else that of its aliases, where an
    explicit allow of any alias goes before a block; else allow.  Links come from the
    pages themselves and from ``edges (from_url, to_url)`` such as a redirect log.  A
    null url and one without ``://`` have an empty host and path, are aliases of
    nothing and are allowed.  Repeated pages get equal rows; an empty table gives none.
    """
    columns = [F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")]
    links = links_of(F.col(html)) if html else F.array().cast("array<string>")
    rows = checkpointed(pages.select(*columns, links.alias("links")).withColumn("node", address_key(F.col("host"), F.col("path"))))
    out = rows.where("host <> ''").select("node", "host", "path", F.explode("links").alias("link"))
    out = out.select(F.col("node").alias("a"), resolved(F.col("link"), F.col("host"), F.col("path")).alias("to"))
    if edges is not None:
        known = edges.select(*[f(F.col(c)).alias(f"{n}_{c}") for c in ("from_url", "to_url") for f, n in ((host_of, "h"), (path_of, "p"))], "to_url")
        known = known.where("h_from_url <> ''").select(address_key(F.col("h_from_url"), F.col("p_from_url")).alias("a"), F.col("to_url").alias("to"),
                                                       F.col("h_from_url").alias("host"), F.col("p_from_url").alias("path"))
        extra = known.select(F.col("a").alias("node"), "host", "path")
        out = out.union(known.select("a", "to"))
    else:
        extra = rows.select("node", "host", "path").limit(0)
    out = checkpointed(out.select("a", host_of(F.col("to")).alias("host"), path_of(F.col("to")).alias("path")).where("host <> ''")
                       .withColumn("b", address_key(F.col("host"), F.col("path"))))
    addresses = rows.select("node", "host", "path").union(out.select("b", "host", "path")).union(extra).where("host <> ''").distinct()
    decided = checkpointed(explicit_decisions(addresses, rules))
    aliases = checkpointed(alias_decisions(out.select("a", "b"), decided))
    own = decided.select("node", "rule", F.col("action").alias("own"))
    judged = rows.join(own, "node", "left").join(aliases, "node", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("own", "action", F.lit("allow")).alias("verdict"),
                         F.coalesce("component", "node").alias("component"))


ORACLE = r"""
WITH RECURSIVE rules(action, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
p AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
tags AS (SELECT host, path, unnest(regexp_extract_all(coalesce(html, ''), '(?i)<(?:link|meta)\b[^>]*>')) AS tag FROM p WHERE host <> ''),
refs AS (SELECT host, path, trim(CASE
    WHEN regexp_matches(tag, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b')
      THEN concat(regexp_extract(tag, '(?i)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 1),
                  regexp_extract(tag, '(?i)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 2),
                  regexp_extract(tag, '(?i)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 3))
    WHEN regexp_matches(tag, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''>]*)', 1)
    ELSE '' END) AS ref FROM tags),
full_refs AS (SELECT host, path, CASE WHEN contains(ref, '://') THEN ref WHEN starts_with(ref, '//') THEN 'http:' || ref
    WHEN starts_with(ref, '/') THEN 'http://' || host || ref WHEN regexp_matches(ref, '^[?#]') THEN 'http://' || host || path
    ELSE 'http://' || host || regexp_replace(path, '[^/]*$', '') || ref END AS url FROM refs WHERE ref <> ''),
e AS (SELECT host, path, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS to_host,
         regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS to_path FROM full_refs),
links AS (SELECT DISTINCT host || ' ' || path AS a, to_host || ' ' || to_path AS b FROM e WHERE to_host <> ''),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
nodes AS (SELECT host || ' ' || path AS node, host, path FROM p WHERE host <> '' UNION SELECT to_host || ' ' || to_path, to_host, to_path FROM e WHERE to_host <> ''),
fits AS (SELECT node, r.host || r.path AS rule, action,
    row_number() OVER (PARTITION BY node ORDER BY length(r.host || r.path) DESC, action = 'allow' DESC, r.host || r.path DESC) AS n
    FROM nodes JOIN rules r ON (nodes.host = r.host OR ends_with(nodes.host, '.' || r.host)) AND starts_with(nodes.path, r.path)),
own AS (SELECT node, rule, action FROM fits WHERE n = 1),
alias AS (SELECT reach.a AS node, CASE WHEN bool_or(action = 'allow') THEN 'allow' WHEN bool_or(action = 'block') THEN 'block' END AS action
          FROM reach JOIN own ON reach.b = own.node GROUP BY reach.a)
SELECT page_id, host, path, own.rule AS rule, coalesce(own.action, alias.action, 'allow') AS verdict
FROM p LEFT JOIN own ON p.host <> '' AND own.node = host || ' ' || path LEFT JOIN alias ON p.host <> '' AND alias.node = host || ' ' || path"""
