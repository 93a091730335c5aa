"""URL filter with redirect equivalence; built-in expressions only.

A rule fits a host with its subdomains and a path prefix; the longest rule wins,
an allow before a block of the same length. URLs that no rule fits take their
equivalence class's verdict: canonical links and redirects (a ``meta refresh``
in the page, or pairs given by the caller) connect URLs, components of this
graph are classes. An explicit allow of any member comes before a block of any
member; a class without a rule, or an URL without links, is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.graph import components
from lamina.plans.joins import sized_broadcast

#: So many rules become one CASE expression; more are a table that hosts' suffixes join.
CASE_RULES = 500

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str      # "allow" or "block"
    host: str
    path: str         # begins with "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the rule that decides, by one expression; null if none fits."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow", r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def with_rule(df: DataFrame, rules: Sequence[Rule], text_col: str, verdict_col: str) -> DataFrame:
    """``df`` (with host and path) and its rules' text and verdict. Long lists are joined:
    a distinct (host, path) with the rules of each suffix of its host."""
    if len(rules) <= CASE_RULES:
        text, verdict = matched_rule(F.col("host"), F.col("path"), rules)
        return df.withColumn(text_col, text).withColumn(verdict_col, verdict)
    table = df.sparkSession.createDataFrame(
        [(r.host, r.path, r.verdict, r.text) for r in rules], "__of string, __path string, __verdict string, __text string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    order = F.struct(F.length("__text").alias("n"), (F.col("__verdict") == "allow").alias("allow"),
                     F.col("__text").alias("text"), F.col("__verdict").alias("verdict"))
    best = (df.select("host", "path").distinct().withColumn("__of", F.explode(suffixes))
            .join(sized_broadcast(table), "__of").filter(F.col("path").startswith(F.col("__path")))
            .groupBy("host", "path").agg(F.max(order).alias("__best")))
    return (df.join(best, ["host", "path"], "left").withColumn(text_col, F.col("__best.text"))
            .withColumn(verdict_col, F.col("__best.verdict")).drop("__best"))


def node_of(url: Column) -> Column:
    """An URL without its fragment, scheme and host A-Z lower-cased, an empty path as /."""
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    site = F.regexp_extract(plain, r"(?s)^(.*?://[^/?#]*)", 1)
    rest = F.substr(plain, F.length(site) + 1)
    return F.when(site == "", plain).otherwise(F.concat(
        F.translate(site, _UPPER, _LOWER), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))))


def _resolved(link: Column, url: Column) -> Column:
    """A link's absolute URL, as seen from the page's."""
    link = F.regexp_replace(F.trim(link), "&amp;", "&")
    scheme = F.regexp_extract(url, r"(?s)^(.*?://)", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*/)", 1)
    return (F.when(link == "", F.lit(None))
            .when(link.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(site == "", F.lit(None))
            .when(link.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), link))
            .when(link.startswith("/"), F.concat(site, link))
            .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), link)))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): a page's URL and its canonical links and meta-refresh targets, of all its
    tags. A tag is closed, and holds no < within."""
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.col(url_col)

    def found(name: str, kind: str, link: str) -> Column:
        tags = F.regexp_extract_all(html, F.lit(rf"(?i)<{name}\b([^<>]*+)>"), F.lit(1))
        return F.transform(F.filter(tags, lambda t: t.rlike(rf"""(?i)\b{kind}\b""")),
                           lambda t: F.regexp_extract(t, rf"""(?i)\b{link}\s*=\s*["']?([^"'\s>]*)""", 1))

    links = F.concat(found("link", r"""rel\s*=\s*["']?canonical""", "href"),
                     found("meta", r"""http-equiv\s*=\s*["']?refresh""", "url"))
    return (pages.filter(url.isNotNull())
            .select(node_of(url).alias("a"), F.explode(links).alias("link"))
            .filter("link != ''")
            .select("a", node_of(_resolved(F.col("link"), F.col("a"))).alias("b"))
            .filter("b IS NOT NULL AND a != b"))


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, host, path, rule, verdict.

    ``redirects`` (columns a, b) adds pairs of equivalent URLs. A null URL, or one
    without ``://``, has an empty host and path, no rule and no class: allow.
    Repeated pages each get their row; other columns are not read.
    """
    edges = link_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("a")).alias("a"),
                                                   node_of(F.col("b")).alias("b")))
    member = components(edges)
    placed = member.withColumn("host", host_of(F.col("node"))).withColumn("path", path_of(F.col("node")))
    of_class = (with_rule(placed, rules, "rule", "said").groupBy("component")
                .agg(F.max(F.col("said") == "allow").alias("allowed"),
                     F.max(F.col("said") == "block").alias("blocked")))
    blocked = (of_class.filter("blocked AND NOT allowed").join(member, "component")
               .select(F.col("node").alias("__node")))     # one row per URL
    url = F.col("url")
    rows = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
            .withColumn("host", host_of(url)).withColumn("path", path_of(url)))
    rows = with_rule(rows, rules, "rule", "__said")
    rows = rows.join(blocked.withColumn("__by_class", F.lit(True)),
                     node_of(url) == F.col("__node"), "left")
    by_class = F.when(F.col("__by_class"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "url", "host", "path", "rule",
                       F.coalesce("__said", by_class).alias("verdict"))
