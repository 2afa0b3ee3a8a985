"""URL verdicts over classes of equivalent URLs.

A URL's own verdict is that of the longest rule that fits its host (or a domain above it) and the start
of its path. URLs without one take their class's verdict. Classes are the connected components of
redirect and canonical-link edges: all ``<link rel="canonical">`` and ``<meta http-equiv="refresh">``
targets of a page (resolved against the page's ``<base href>``, else its url, as in RFC 3986) and an optional table of redirects.
URLs that RFC 3986 makes equal, by the case of scheme and host, an empty path or a fragment, are one node. With ``fold`` so are those that sites
usually redirect to each other, though no edge says so: by scheme, ``www.`` or ``m.`` in front, closing slash, default index page,
tracking parameters and their order. A class with an explicit allow is allowed, else one with a block is blocked, else allowed; so an allow
takes precedence, and a rule that fits a URL itself takes precedence over its class.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule, has no
aliases and is allowed. Null html gives no edge. Repeated rows get one verdict each. Targets that are no
pages still count with the rules that fit them. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: More rules than this are joined as a table.
MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rules(lines: list[str]) -> list[Rule]:
    """From lines like ``block example.com/de/``."""
    out = []
    for line in lines:
        verdict, name = line.split()
        host, slash, path = name.partition("/")
        if verdict not in ("allow", "block") or not host:
            raise ValueError(line)
        out.append(Rule(verdict, host, slash + path))
    return out


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(name, verdict) of the longest rule that fits, else null, as one expression."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def with_rule(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows (host, path, ...) with ``r``, the (name, verdict) of the longest rule that fits, else null.

    Up to ``MAX_RULES`` rules are an expression. More are a table: each different host and path is joined with
    the rules of its host and of the domains above, and the longest that fits is kept.
    """
    if len(rules) <= MAX_RULES:
        return rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    table = rows.sparkSession.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in rules], "domain string, start string, name string, verdict string")
    parts = F.split("host", "\\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    urls = rows.select("host", "path").distinct().select("host", "path", F.explode(above).alias("domain"))
    fits = urls.join(table, "domain").where(F.col("path").startswith(F.col("start")))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("name", "verdict"), F.struct(F.length("name"), "name")).alias("r"))
    return rows.join(best, ["host", "path"], "left")


def node_of(url: Column, fold: bool = False) -> Column:
    """One name for the URLs that are equal by RFC 3986 or, with ``fold``, by the usual redirects of sites; null where there is no ``://``."""
    host, path = host_path(url)
    plain = F.regexp_replace(url, "#[\\s\\S]*$", "")
    if not fold:
        scheme = F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)
        out = F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.regexp_extract(plain, r"\?[\s\S]*$", 0))
        return F.when(F.instr(url, "://") > 0, out)
    host = F.regexp_replace(host, r"^(www|m)\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.(html?|php)$", "/"), r"/+$", "")
    query = F.regexp_extract(plain, r"\?([\s\S]*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[^=]*|fbclid|gclid|ref)(=|$)"))
    query = F.concat_ws("&", F.array_sort(kept))
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed and written into the plan once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def without_dots(path: Column) -> Column:
    """A path that begins with '/', its '.' and '..' segments resolved."""
    parts = F.split(path, "/", -1)
    # a dot segment at the end leaves the slash before it
    parts = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    step = lambda acc, p: F.when(p == ".", acc).when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p)))
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def resolve(base: Column, ref: Column) -> Column:
    """The absolute URL of a reference on the page ``base``; null where there is none, as for ``mailto:`` or an empty one."""
    return bound(base, lambda b: bound(ref, lambda t: bound(_joined(b, t), _absolute)))


def _joined(base: Column, ref: Column) -> Column:
    scheme, origin = F.regexp_extract(base, r"^[^:/?#]*:", 0), F.regexp_extract(base, r"^[^:/?#]*://[^/?#]*", 0)
    path, query = F.regexp_extract(base, r"^[^:/?#]*://[^/?#]*([^?#]*)", 1), F.regexp_extract(base, r"^[^?#]*(\?[^#]*)?", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    return (
        F.when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), ref)
        .when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | (ref == "") | (origin == ""), F.lit(None))
        .when(ref.startswith("//"), F.concat(scheme, ref))
        .when(ref.startswith("#"), F.concat(origin, path, query, ref))
        .when(ref.startswith("?"), F.concat(origin, path, ref))
        .when(ref.startswith("/"), F.concat(origin, ref))
        .otherwise(F.concat(origin, folder, ref))
    )


def _absolute(joined: Column) -> Column:
    """The URL with the dot segments of its path resolved."""
    start, own = F.regexp_extract(joined, r"^[^:/?#]*://[^/?#]*", 0), F.regexp_extract(joined, r"^[^:/?#]*://[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(joined, r"^[^?#]*([\s\S]*)$", 1)
    return F.when(own.rlike(r"/\.\.?(/|$)"), F.concat(start, without_dots(own), tail)).otherwise(joined)


#: A link tag one of whose rel words is canonical.
CANONICAL = r"""(?i)\brel\s*=\s*("([^">]*\s)?canonical[\s"]|'([^'>]*\s)?canonical[\s']|canonical[\s/>])"""
REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""


def link_targets(url: Column, html: Column) -> Column:
    """The absolute targets of a page's canonical links and refreshes, each once."""
    tags = lambda name: F.regexp_extract_all(html, F.lit(rf"(?i)<{name}\b[^>]*>"), F.lit(0))
    value = lambda tag, name: F.replace(F.regexp_extract(tag, rf"(?i)\b{name}\s*=\s*[\"']?([^\"'\s>]+)", 1), F.lit("&amp;"), F.lit("&"))
    base_tag = F.regexp_extract(html, r"(?i)<base\b[^>]*\bhref\s*=[^>]*>", 0)
    base = F.coalesce(resolve(url, value(base_tag, "href")), url)
    links = F.transform(F.filter(tags("link"), lambda t: t.rlike(CANONICAL)), lambda t: value(t, "href"))
    jumps = F.transform(F.filter(tags("meta"), lambda t: t.rlike(REFRESH)), lambda t: value(t, "url"))
    return F.array_distinct(F.filter(F.transform(F.concat(links, jumps), lambda t: resolve(base, t)), lambda t: t.isNotNull()))


def judge_urls(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None, fold: bool = False, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, host, path, rule, verdict. ``redirects``: (source, target) URLs."""
    host, path = host_path(F.col("url"))
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = named.select("id", host.alias("host"), path.alias("path"), node_of(F.col("url"), fold).alias("node"))
    rows = with_rule(rows, rules)
    # html is read for the edges alone, and only where a tag is there
    tagged = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).where(F.col("html").rlike(r"(?i)canonical|http-equiv"))
    links = tagged.select(F.col("url").alias("source"), F.explode(link_targets(F.col("url"), F.col("html"))).alias("target"))
    if redirects is not None:
        links = links.unionByName(redirects.select("source", "target"))
    edges = links.select(node_of(F.col("source"), fold).alias("a"), node_of(F.col("target"), fold).alias("b"))
    roots = components(edges)
    ends = links.select(F.explode(F.array("source", "target")).alias("url"))
    t_host, t_path = host_path(F.col("url"))
    ends = with_rule(ends.select(node_of(F.col("url"), fold).alias("node"), t_host.alias("host"), t_path.alias("path")), rules)
    decided = rows.select("node", F.col("r.verdict").alias("v")).unionByName(ends.select("node", F.col("r.verdict").alias("v")))
    per_node = decided.where("v IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(F.max(F.col("v") == "allow").alias("ok"), F.max(F.col("v") == "block").alias("no"))
    grouped = lambda df: df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_root = grouped(per_node).groupBy("root").agg(F.max("ok").alias("ok"), F.max("no").alias("no"))
    out = grouped(rows).join(per_root, "root", "left")
    verdict = F.when(F.col("r").isNotNull(), F.col("r.verdict")).when(F.coalesce("no", F.lit(False)) & ~F.coalesce("ok", F.lit(False)), "block").otherwise("allow")
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("r.name").alias("rule"), verdict.alias("verdict"))
