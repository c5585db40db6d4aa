"""URL filter: host and path rules, spread over redirect and canonical-link aliases.

A rule is a host with a path prefix; it fits its host and all subdomains, and the longest rule string wins. Pages that
name another address by ``<link rel=canonical>`` or ``<meta http-equiv=refresh>`` (or by given redirect edges) form
groups of aliases, found as connected components. Targets are resolved against the page's url or its ``<base href>``, with
their character references decoded; nodes are compared with scheme and host in lower case. A url with a rule of its own keeps that rule's verdict, so an explicit
allow is never overruled. A url without one is blocked if any alias is blocked by a rule, and allowed otherwise.

Null urls and urls without ``://`` have empty host and path, fit no rule with a host, have no aliases and are allowed.
Repeated rows each get their row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape
from html.entities import html5
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cohortlane.llm.components import connected_components
from cohortlane.session import cut, local_rows


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str = "/"


#: The rules of the production query.
RULES = (
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"(?i)<link\b[^>]*>"
CANONICAL = r"(?i)\brel\s*=\s*[\"']?canonical\b"
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
META = r"(?i)<meta\b[^>]*>"
REFRESH = r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"
REFRESH_URL = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)"

#: For code only, the SQL does without.
BASE = r"(?i)<base\b[^>]*>"
TAGS = r"(?i)<(?:link|meta|base)\b[^>]*>"
REFERENCE = re.compile(r"&(?:#[xX][0-9a-fA-F]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*);?")
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(url.contains("://"), F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def address(url: Column) -> Column:
    """What redirects and canonical links name: a url without its fragment, with scheme and host in lower case."""
    whole = F.substring_index(url, "#", 1)
    front = "^([^:/?#]+://)([^/?#]*@)?([^/?#]*)"
    part = lambda i: F.regexp_extract(whole, front, i)
    rest = F.regexp_replace(whole, front, "")
    return F.concat(F.translate(part(1), UPPER, LOWER), part(2), F.translate(part(3), UPPER, LOWER), rest)


def decoded(value: str) -> str:
    """An attribute with its character references decoded; like browsers, ``&copy=1`` is left as it stands."""
    def one(found: re.Match) -> str:
        name = found[0][1:]
        if name.startswith("#"):
            return unescape(found[0])
        return found[0] if not name.endswith(";") and found.string[found.end() :][:1] == "=" else html5.get(name, found[0])

    return REFERENCE.sub(one, value)


def resolved(base: str, target: str) -> str | None:
    """The absolute address of a target; None where it has none (``mailto:``, ``javascript:``)."""
    if scheme := SCHEME.match(target):
        return target if target.startswith("//", scheme.end()) else None
    front = re.match("([^:/?#]+:)//[^/?#]*", base)
    if not front or not target:
        return None
    if target.startswith("//"):
        return front[1] + target
    if target.startswith("/") and "/." not in target:
        return front[0] + target
    try:
        return urljoin(base, target)
    except ValueError:  # brackets that are no address
        return None


def _targets(batches):
    inside = [(re.compile(t, re.ASCII), re.compile(m, re.ASCII), re.compile(v, re.ASCII))
              for t, m, v in ((LINK, CANONICAL, HREF), (META, REFRESH, REFRESH_URL))]
    base_tag, href = re.compile(BASE, re.ASCII), re.compile(HREF, re.ASCII)
    for batch in batches:
        rows = []
        for url, tags in zip(batch["url"], batch["tags"]):
            named = [href.search(t) for t in tags if base_tag.match(t)]
            first = next((decoded(n[1]) for n in named if n), "")
            base = resolved(url, first) or url
            for tag in tags:
                for kind, mark, value in inside:
                    if kind.match(tag) and mark.search(tag):
                        # a reference ends with a semicolon, and so does the url of a refresh: decoded first
                        found = value.search(decoded(tag)) if kind is inside[1][0] else value.search(tag)
                        target = found and resolved(base, found[1] if kind is inside[1][0] else decoded(found[1]))
                        if target:
                            rows.append((url, target))
        yield pd.DataFrame(rows, columns=["a", "b"], dtype=object)


def link_edges(pages: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` from a page's url to the address that its html names as canonical or refreshes to."""
    found = F.regexp_extract_all("html", F.lit(TAGS), F.lit(0))
    marked = lambda tag: (tag.rlike(LINK) & tag.rlike(CANONICAL)) | (tag.rlike(META) & tag.rlike(REFRESH))
    tagged = pages.filter(F.col("url").contains("://") & F.col("html").isNotNull()).select("url", found.alias("tags"))
    edges = tagged.filter(F.exists("tags", marked)).mapInPandas(_targets, "a string, b string")
    return edges.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b")).distinct()


def match_rules(addresses: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(address, rule, action)`` of every address that a rule fits: host suffixes joined to the rules' hosts."""
    table = local_rows(
        addresses.sparkSession, [(r.host.translate(str.maketrans(UPPER, LOWER)), r.path, r.action) for r in rules],
        "rule_host string, rule_path string, action string")
    host, path = host_and_path(F.col("address"))
    labels = F.split("host", r"\.")
    suffixes = addresses.select("address", host.alias("host"), path.alias("path")).select(
        "address", "path",
        F.explode(F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("rule_host"))
    fitting = suffixes.join(table, "rule_host").filter(F.expr("startswith(path, rule_path)"))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), F.col("action").alias("action")))
    return fitting.groupBy("address").agg(best.alias("best")).select("address", "best.rule", "best.action")


def url_verdicts(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per page; ``redirects(a, b)`` adds edges to those in the html."""
    edges = link_edges(pages)
    if redirects is not None:
        edges = edges.union(redirects.select(address(F.col("a")), address(F.col("b")))).distinct()
    edges = cut(edges)
    groups = cut(connected_components(edges))
    own = pages.select(address(F.col("url")).alias("address"))
    known = own.union(groups.select("node")).filter("address is not null").distinct()
    ruled = cut(match_rules(known, rules))
    spread = groups.join(ruled, groups.node == ruled.address)
    blocked = spread.filter("action = 'block'").select("component").distinct()
    aliases = groups.join(blocked, "component").select(F.col("node").alias("alias"))
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"), address(F.col("url")).alias("address"))
    judged = judged.join(ruled, "address", "left").join(aliases, F.col("address") == F.col("alias"), "left")
    verdict = F.coalesce("action", F.when(F.col("alias").isNotNull(), "block"), F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    values = ", ".join(f"('{r.host}', '{r.path}', '{r.action}')" for r in rules)
    lower = "translate({}, '" + UPPER + "', '" + LOWER + "')"
    host = lower.format("regexp_extract(substr({0}, strpos({0}, '://') + 3), '^([^/?#]*)', 1)")
    path = "regexp_extract(substr({0}, strpos({0}, '://') + 3), '^[^/?#]*([^?#]*)', 1)"
    quoted = lambda pattern: pattern.replace("'", "''")
    return f"""
with recursive rules(rh, rp, action) as (values {values}),
links as (
  select url, regexp_extract(tag, '{quoted(HREF)}', 1) as t
  from (select url, unnest(regexp_extract_all(html, '{LINK}')) as tag from pages where contains(url, '://'))
  where regexp_matches(tag, '{quoted(CANONICAL)}')
  union all
  select url, regexp_extract(tag, '{quoted(REFRESH_URL)}', 1)
  from (select url, unnest(regexp_extract_all(html, '{META}')) as tag from pages where contains(url, '://'))
  where regexp_matches(tag, '{quoted(REFRESH)}')),
edges as (
  select split_part(url, '#', 1) as a, split_part(case when contains(t, '://') then t
    when starts_with(t, '//') then split_part(url, '://', 1) || ':' || t
    when starts_with(t, '/') then split_part(url, '://', 1) || '://' || regexp_extract(url, '://([^/?#]*)', 1) || t
    end, '#', 1) as b from links),
both_ways as (select a, b from edges where b is not null union select b, a from edges where b is not null),
reach(a, b) as (select a, a from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a),
known as (select split_part(url, '#', 1) as address from pages where url is not null union select a from both_ways),
parts as (select address, case when contains(address, '://') then {host.format('address')} else '' end as host,
  case when contains(address, '://') then {path.format('address')} else '' end as path from known),
ruled as (select address, max_by(rh || rp, length(rh || rp)) as rule, max_by(action, length(rh || rp)) as action
  from parts join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by address),
aliases as (select distinct r.a as alias from reach r join ruled on ruled.address = r.b where action = 'block')
select page_id,
  case when contains(url, '://') then {host.format('url')} else '' end as host,
  case when contains(url, '://') then {path.format('url')} else '' end as path,
  rule, coalesce(action, case when alias is not null then 'block' end, 'allow') as verdict
from pages left join ruled on address = split_part(url, '#', 1) left join aliases on alias = split_part(url, '#', 1)"""
