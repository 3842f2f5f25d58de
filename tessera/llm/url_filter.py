"""URL allow and block rules, carried over redirects and canonical links.

Method: a rule names a host (it fits its subdomains too) and a path prefix;
the longest rule that fits decides.  Pages that redirect (``meta refresh``) or
name a canonical address are aliases of the target.  Connected components over
these edges form classes of equivalent URLs; a page without a rule of its own
gets its class's decision: allow if any member is explicitly allowed, else
block if any member is blocked, else allow.

Rules are joined by host suffix, so their number may grow; only distinct hosts
and paths travel, never a page's html.  Everything is DataFrame expressions.

Defined cases: a null url, or one without ``://``, has an empty host and path
and is in no class; a null html has no links; pages with one url share a
verdict; rules of equal length that both fit: an allow rule wins, then the
smaller name; extra columns of the pages are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import REGISTRY, saved, table
from tessera.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """What identifies a URL here: host, path and query, without scheme and fragment."""
    rest = F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host(url), rest))


def rule_table(spark: SparkSession, rules=None) -> DataFrame:
    """(action, rule_host, rule_path) from a list of rules."""
    return spark.createDataFrame(RULES if rules is None else rules, "action string, rule_host string, rule_path string")


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) for the distinct (host, path) of ``places`` that a rule fits."""
    parts = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))
    wide = places.select("host", "path").distinct().select("host", "path", F.explode(F.array_distinct(suffixes)).alias("rule_host"))
    fit = wide.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    name = F.concat("rule_host", "rule_path")
    best = F.max_by(F.struct(name.alias("rule"), "action"),
                    F.struct(F.length(name), (F.col("action") == "allow").cast("int"),
                             F.transform(F.split(name, ""), lambda c: -F.ascii(c))))
    return fit.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.action")


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)\b{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def declared_targets(html: Column) -> Column:
    """The addresses a page's canonical link and its refresh name (empty: none)."""
    html = F.coalesce(html, F.lit(""))
    link = F.regexp_extract(html, r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    refresh = F.regexp_extract(html, r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    moved = F.trim(F.regexp_extract(_attribute(refresh, "content"), r"(?is)url\s*=\s*['\"]?([^'\"]*)", 1))
    named = F.trim(_attribute(link, "href"))
    return F.transform(F.filter(F.array(named, moved), lambda t: t != ""), lambda t: F.regexp_replace(t, "&amp;", "&"))


def _absolute(url: Column, target: Column) -> Column:
    scheme = F.regexp_extract(url, "(?s)^(.*?://)", 1)
    return (F.when(target.contains("://"), target)
            .when(target.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), target))
            .when(target.startswith("/"), F.concat(scheme, host(url), target))
            .otherwise(F.concat(scheme, host(url), F.regexp_replace(path(url), "[^/]*$", ""),
                                F.when(path(url) == "", F.lit("/")).otherwise(F.lit("")), target)))


def link_edges(pages: DataFrame) -> DataFrame:
    """(u, v, url_u, url_v): a page and the address it redirects to or calls canonical."""
    target = pages.where(F.col("url").contains("://")).select("url", F.explode(declared_targets(F.col("html"))).alias("target"))
    return (target.select(F.col("url").alias("url_u"), _absolute(F.col("url"), F.col("target")).alias("url_v"))
            .select(address(F.col("url_u")).alias("u"), address(F.col("url_v")).alias("v"), "url_u", "url_v")
            .where("u <> v").distinct())


def class_verdicts(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """(address, class_verdict) for every address that has an alias."""
    ends = edges.select(F.col("u").alias("address"), F.col("url_u").alias("url")).unionByName(
        edges.select(F.col("v").alias("address"), F.col("url_v").alias("url")))
    ends = ends.select("address", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).distinct()
    decided = ends.join(match_rules(ends, rules), ["host", "path"], "left")
    roots = connected_components(edges.select("u", "v")).withColumnRenamed("node", "address")
    member = decided.join(roots, "address")
    verdict = member.groupBy("root").agg(
        F.when(F.max(F.col("action") == "allow"), "allow").when(F.max(F.col("action") == "block"), "block")
        .otherwise("allow").alias("class_verdict"))
    return roots.join(verdict, "root").select("address", "class_verdict")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, alias) for every row of ``pages``; alias: the class decided."""
    url = F.col("url")
    rows = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), address(url).alias("address"))
    classes = class_verdicts(saved(link_edges(pages.select("url", "html")), "op5-edges"), rules)
    return (rows.join(match_rules(rows, rules), ["host", "path"], "left").join(classes, "address", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("action", "class_verdict", F.lit("allow")).alias("verdict"),
                    (F.col("action").isNull() & F.col("class_verdict").isNotNull()).alias("alias")))


_ATTR = r"""coalesce(nullif(regexp_extract({0}, '(?is)\b{1}\s*=\s*"([^"]*)"', 1), ''), nullif(regexp_extract({0}, '(?is)\b{1}\s*=\s*''([^'']*)''', 1), ''), regexp_extract({0}, '(?is)\b{1}\s*=\s*([^\s"''>]+)', 1))"""
OP5_SQL = r"""
WITH RECURSIVE p AS (SELECT row_number() OVER () AS r, page_id, url, html,
  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(action, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
link AS (SELECT r, url, host, regexp_extract(coalesce(html, ''), '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>') AS tag FROM p WHERE contains(url, '://')),
target AS (SELECT url, host, trim(@HREF) AS t FROM link),
edge AS (SELECT host || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS u,
  translate(regexp_extract(t, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS vh,
  regexp_extract(t, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS vp, regexp_extract(t, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS vr FROM target WHERE contains(t, '://')),
both_ways AS (SELECT u AS a, vh || vr AS b FROM edge UNION SELECT vh || vr, u FROM edge),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT reach.a, e.b FROM reach JOIN both_ways e ON reach.b = e.a),
node AS (SELECT DISTINCT host || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS n, host AS h, path AS pa FROM p WHERE contains(url, '://')
         UNION SELECT vh || vr, vh, vp FROM edge),
fit AS (SELECT n.h, n.pa, arg_max({'rule': rh || rp, 'action': action}, length(rh || rp)) AS best FROM (SELECT DISTINCT h, pa FROM node) n
        JOIN rules ON (n.h = rh OR suffix(n.h, '.' || rh)) AND starts_with(n.pa, rp) GROUP BY n.h, n.pa),
cls AS (SELECT reach.a, CASE WHEN bool_or(best.action = 'allow') THEN 'allow' WHEN bool_or(best.action = 'block') THEN 'block' ELSE 'allow' END AS cv
        FROM reach JOIN node ON node.n = reach.b LEFT JOIN fit ON fit.h = node.h AND fit.pa = node.pa GROUP BY reach.a)
SELECT page_id, p.host, p.path, best.rule AS rule, coalesce(best.action, cv, 'allow') AS verdict, best IS NULL AND cv IS NOT NULL AS alias
FROM p LEFT JOIN fit ON fit.h = p.host AND fit.pa = p.path
LEFT JOIN cls ON contains(url, '://') AND cls.a = p.host || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1)
""".replace("@HREF", _ATTR.format("tag", "href"))


@REGISTRY("op5_redirect_equivalence", OP5_SQL)
def op5(spark, sf_dir):
    """Host, path, rule and verdict of every page."""
    return judge(table(spark, sf_dir, "pages"), rule_table(spark))
