"""URL filters with redirect equivalence.

Pages and the addresses they point to form a graph: an edge joins a page's address to
the target of its canonical link, to the target of its meta refresh, and to its own plain
form (lower-case scheme-free host without ``www.`` or ``m.``, no fragment, no tracking
parameters, no index page, no trailing slash), which all redirect to one another. Nodes
are 64-bit hashes of the plain form, so equal aliases are one node before any edge is
drawn. Connected components are found by star contraction.

A page that a rule fits takes the rule's decision. Any other page takes its component's (pages
and link targets): ``allow`` if any member is explicitly allowed, else ``block`` if any is blocked, else
``allow``.

Rules are a small configured list and are matched inside the scan (the suffixes of a
host are compared, not a join).

Defined results: a null url, or one without ``://``, has an empty host and path, fits no
rule and has no aliases: it is allowed. Null html has no links. A target is taken with its
character references (numbers and the five of XML) read and relative to the page's url
(``<base>`` is not read); one of another scheme (``mailto:``) is no link. Rules are applied to
targets too, whether or not they are pages of the table. Repeated rows are judged alike.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroscope.llm.common import lower_ascii, written
from metroscope.llm.components import connected_components

# Query parameters that never change the page.
TRACKING = r"(?:utm_[a-z]+|ref|gclid|fbclid|mc_cid|mc_eid|sessionid)"

ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path prefix (``example.com/en/``)."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


# The contract's rules.
RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Text of the longest rule that fits; ties cannot differ in text."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = (host == r.host) | host.endswith("." + r.host)
        fits = fits & path.startswith(r.path)
        out = F.when(fits, r.text) if out is None else out.when(fits, r.text)
    return out.otherwise(F.lit(None).cast("string")) if out is not None else F.lit(None).cast("string")


def plain_form(url: Column) -> Column:
    """The address without what a redirect strips; null without ``://``."""
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    path = F.rtrim(F.regexp_replace(path_of(url), r"/index\.(?:html?|php)$", "/"), F.lit("/"))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(?:=|$)")))
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, F.when(
        F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def link_targets(html: Column) -> Column:
    """Canonical-link and meta-refresh targets as written in the html. Each tag is taken up to
    its ``>`` and read as a whole; one that never closes ends the search, so that such html
    costs linear time."""
    def tags(name: str, marked: str) -> Column:
        found = F.regexp_extract_all(html, F.lit(rf"(?i)<{name}\b[^>]*+(?:>|\z)"), F.lit(0))
        return F.filter(found, lambda t: t.endswith(">") & t.rlike(marked))

    def value(pattern: str):
        return lambda t: F.concat(F.regexp_extract(t, pattern, 1), F.regexp_extract(t, pattern, 2))

    href = r"(?i)\bhref\s*+=\s*+(?:[\"']([^\"'>]+)|([^\"'>\s]+))"
    return F.concat(
        F.transform(tags("link", r"(?i)\brel\s*+=\s*+[\"']?canonical\b"), value(href)),
        F.transform(tags("meta", r"(?i)http-equiv\s*+=\s*+[\"']?refresh\b"), value(r"(?i)url\s*+=\s*+[\"']?([^\"'> ]+)()")))


def decoded(text: Column) -> Column:
    """``text`` with its character references read, each once."""
    def char(ref: Column) -> Column:
        n = F.when(ref.rlike("^&#[xX]"), F.conv(F.regexp_extract(ref, "[xX]([^;]+)", 1), 16, 10)).otherwise(
            F.regexp_extract(ref, "&#([0-9]+)", 1))
        n = F.when(ref.startswith("&#"), n).cast("long")
        out = F.when(n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        for name, said in ENTITIES.items():
            out = out.when(F.lower(ref) == f"&{name};", said)
        return out.otherwise(ref)

    pattern = rf"(?i)&(?:{'|'.join(ENTITIES)}|#x[0-9a-f]{{1,6}}|#[0-9]{{1,7}});"
    chars = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), char)
    whole = F.array_join(F.zip_with(F.split(text, pattern), chars, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(F.instr(text, "&") > 0, whole).otherwise(text)


def resolved(target: Column, url: Column) -> Column:
    """The address that ``target`` means on the page ``url``; null where it is none."""
    t = F.regexp_replace(decoded(target), r"^[\x00-\x20]++|(?<![\x00-\x20])[\x00-\x20]++$", "")
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.concat(F.regexp_extract(path_of(url), r"(?s)^(.*)/", 1), F.lit("/"))
    path, rest = F.regexp_extract(t, r"(?s)^([^?#]*)", 1), F.regexp_extract(t, r"(?s)^[^?#]*(.*)$", 1)
    path = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    steps = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), lambda done, x: F.when(x == ".", done).when(
        x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.concat(done, F.array(x))))
    path = F.when(path.rlike(r"/\.\.?(?:/|$)"), F.array_join(steps, "/")).otherwise(path)
    return (F.when(t == "", F.lit(None).cast("string")).when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*+://"), t)
            .when(t.startswith("//"), F.concat(F.lit("http:"), t))
            .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*+:"), F.lit(None).cast("string"))
            .when(t.rlike(r"^[?#]"), F.concat(origin, path_of(url), t)).otherwise(F.concat(origin, path, rest)))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``,
    ``component`` (null without an address)."""
    url = F.col(url_col)
    targets = F.filter(F.transform(link_targets(F.col(html_col)), lambda t: resolved(t, url)), lambda t: t.isNotNull())

    def ruled(rule: Column) -> Column:
        out = F.lit(None).cast("string")
        for r in rules:
            out = F.when(rule == r.text, r.verdict).otherwise(out)
        return out

    def target(t: Column) -> Column:
        said = ruled(longest_rule(host_of(t), path_of(t), rules))
        return F.struct(F.xxhash64(plain_form(t)).alias("to"), (said == "allow").alias("allowed"), (said == "block").alias("blocked"))

    none = F.array().cast("array<struct<to:bigint,allowed:boolean,blocked:boolean>>")
    rows = pages.select(
        F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
        F.xxhash64(plain_form(url)).alias("hash"), plain_form(url).isNotNull().alias("real"),
        F.coalesce(F.transform(targets, target), none).alias("targets"),
    ).select(
        "page_id", "host", "path", longest_rule(F.col("host"), F.col("path"), rules).alias("rule"),
        F.when(F.col("real"), F.col("hash")).alias("node"), "targets")
    rows = written(rows.withColumn("ruled", ruled(F.col("rule"))), "url-rows")
    addressed = rows.filter("node is not null")
    links = addressed.select("node", F.inline("targets"))
    roots = connected_components(links.select("node", "to").filter("node != to"))
    # one row a node before the join: a third of all pages may share an address
    said = addressed.select("node", (F.col("ruled") == "allow").alias("allowed"), (F.col("ruled") == "block").alias("blocked"))
    nodes = said.unionByName(links.select(F.col("to").alias("node"), "allowed", "blocked")).groupBy("node").agg(
        F.bool_or("allowed").alias("allowed"), F.bool_or("blocked").alias("blocked"))
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    decided = rooted.groupBy("root").agg(F.bool_or("allowed").alias("a"), F.bool_or("blocked").alias("b"))
    verdicts = rooted.select("node", "root").join(decided, "root").select(
        "node", F.col("root").alias("component"),
        F.when(F.col("a"), "allow").when(F.col("b"), "block").otherwise("allow").alias("group_verdict"))
    return rows.join(verdicts, "node", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", "group_verdict", F.lit("allow")).alias("verdict"), "component")
