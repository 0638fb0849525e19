"""URL filter with redirect equivalence.

Rules judge a url by host and path. Urls that redirect to one another, or name one another as
canonical, are aliases: connected components over these links carry decisions to urls that no rule
fits. An explicit allow in a component outweighs its blocks; a rule of the url's own outweighs both.
Only DataFrame functions are used.
"""

from __future__ import annotations

import json
from functools import reduce
from html.entities import html5
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import Store, components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Scheme, host, path, query.
URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
# Comments and elements whose content is no markup; an unclosed one goes to the end.
_RAW = ("script", "style", "textarea", "title")
NO_MARKUP = r"(?is)<!--(?:-?>|.*?(?:-->|\z))" + "".join(rf"|<{tag}\b[^>]*(?:>.*?(?:</{tag}|\z)|\z)" for tag in _RAW)
# A tag of at most 64 attributes with values; a quote counts only behind an equals sign.
TAG = r"(?is)(<%s[\s/][^<>=]*+(?:=\s*+(?:\"[^\"<]*+\"|'[^'<]*+'|[^\s<>\"'][^\s<>]*+|)[^<>=]*+){0,64}+>)"
# One attribute: name, then its value in double, in single or without quotes.
ATTRIBUTE = r"(?s)([^\s\"'<>/=][^\s<>/=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'][^\s]*)))?"
# What a refresh names behind its seconds.
REFRESH = r"(?is)^\s*[0-9.]+\s*[;,\s]\s*(?:url\s*=\s*)?(?:\"([^\"]*).*|'([^']*).*|(.*))$"
# A character reference that ends with a semicolon: decimal, hexadecimal or a name.
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
NAMES = json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")})


class Rule(NamedTuple):
    """A host with an optional beginning of the path, as ``example.org/en/``, and what it decides."""

    text: str
    allow: bool

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 2), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for a null url or one without ``://``."""
    return F.coalesce(F.regexp_extract(url, URL, 3), F.lit(""))


def node(url: Column) -> Column:
    """Identity of a url among aliases: without scheme and fragment. Null if it has no host."""
    text = F.concat(host(url), path(url), F.coalesce(F.regexp_extract(url, URL, 4), F.lit("")))
    return F.when(host(url) != "", text)


def fitting_rule(of_host: Column, of_path: Column, rules: list[Rule]) -> Column:
    """Text of the longest rule whose host is the url's or a parent of it and whose path begins the url's."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [((of_host == r.host) | of_host.endswith(f".{r.host}")) & of_path.startswith(r.path) for r in ordered]
    return reduce(lambda rest, pair: F.when(pair[0], F.lit(pair[1].text)).otherwise(rest), reversed(list(zip(fits, ordered))), F.lit(None).cast("string"))


def allows(rule: Column, rules: list[Rule]) -> Column:
    """True, false, or null without a rule."""
    return F.when(rule.isin([r.text for r in rules if r.allow]), True).when(rule.isNotNull(), False)


def decoded(text: Column) -> Column:
    """``text`` with its character references replaced, once; unknown ones stay as they are."""
    names = F.from_json(F.lit(NAMES), "map<string,string>")

    def character(ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"^&#[xX]?([0-9a-fA-F]+);$", 1)
        code = F.when(ref.rlike("^&#[xX]"), F.conv(digits, 16, 10)).when(ref.startswith("&#"), digits).cast("long")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        number = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")
        return F.when(ref.startswith("&#"), number).otherwise(F.coalesce(names[F.regexp_extract(ref, "^&([^;]*);$", 1)], ref))

    refs = F.regexp_extract_all(text, F.lit(REFERENCE), 0)
    parts = F.zip_with(F.split(text, REFERENCE, -1), refs, lambda x, ref: F.concat(x, F.coalesce(character(ref), F.lit(""))))
    return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)


def without_dots(of_path: Column) -> Column:
    """A path that begins with ``/``, with its segments ``.`` and ``..`` applied."""
    kept = F.aggregate(
        F.split(of_path, "/", -1), F.array().cast("array<string>"),
        lambda out, x: F.when(x == ".", out).when(x == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(1)))).otherwise(F.concat(out, F.array(x))),
    )
    at_end = F.when(of_path.rlike(r"/\.\.?$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(of_path.rlike(r"/\.\.?(/|$)"), F.array_join(F.concat(kept, at_end), "/")).otherwise(of_path)


def resolved(url: Column, target: Column) -> Column:
    """``target`` as a link on the page ``url``, absolute; a ``<base>`` of the page is not read."""
    server = F.concat(F.regexp_extract(url, URL, 1), F.lit("://"), F.regexp_extract(url, URL, 2))
    # From the first ? or # on, a target is not part of a path.
    own, rest = F.regexp_extract(target, r"(?s)^([^?#]*)(.*)$", 1), F.regexp_extract(target, r"(?s)^([^?#]*)(.*)$", 2)
    here = path(url)
    folder = F.when(here == "", "/").otherwise(F.regexp_extract(here, r"(?s)^(.*/)", 1))
    return (
        F.when(target.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(url, URL, 1), F.lit(":"), target))
        .when(target.startswith("/"), F.concat(server, without_dots(own), rest))
        .when(target.startswith("?"), F.concat(server, here, target))
        .when(~target.startswith("#"), F.concat(server, without_dots(F.concat(folder, own)), rest))
    )


def attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute ``name`` of a tag, empty if it has none."""
    inner = F.regexp_replace(tag, r"^<[a-zA-Z]+|>$", "")
    named = F.filter(
        F.regexp_extract_all(inner, F.lit(ATTRIBUTE), 0), lambda x: F.lower(F.regexp_extract(x, ATTRIBUTE, 1)) == name
    )
    return F.coalesce(_first_group(F.get(named, 0), ATTRIBUTE, (2, 3, 4)), F.lit(""))


def _first_group(text: Column, pattern: str, groups: tuple[int, ...]) -> Column:
    """The groups one after another: at most one of them is not empty."""
    return F.concat(*[F.regexp_extract(text, pattern, g) for g in groups])


def aliases(pages: DataFrame) -> DataFrame:
    """Links ``(url, target)`` from a page to its canonical urls and to where it redirects.

    All links of a page count; relative ones are resolved against its url. Attributes are read by
    name, ``rel`` as a list of words; comments, scripts, styles and titles hold no links. A tag with
    a ``<`` in a value or with more than 64 values is not read.
    """
    def written(tag: str) -> Column:
        return F.coalesce(F.regexp_extract_all("markup", F.lit(TAG % tag), 1), F.array().cast("array<string>"))

    def canonical(tag: Column) -> Column:
        words = F.split(F.lower(attribute(tag, "rel")), r"\s+")
        return F.when(F.array_contains(words, "canonical"), attribute(tag, "href")).otherwise("")

    def refresh(tag: Column) -> Column:
        to = _first_group(attribute(tag, "content"), REFRESH, (1, 2, 3))
        return F.when(F.lower(F.trim(attribute(tag, "http-equiv"))) == "refresh", to).otherwise("")

    markup = pages.where("url IS NOT NULL").select("url", F.regexp_replace("html", NO_MARKUP, "").alias("markup"))
    raw = markup.select("url", F.explode(F.concat(F.transform(written("link"), canonical), F.transform(written("meta"), refresh))).alias("raw"))
    # White space around an address does not count, nor do tabs and line breaks inside.
    raw = raw.select("url", F.trim(F.translate("raw", "\t\n\r\f", "")).alias("raw")).where("raw <> ''")
    target = raw.select("url", decoded(F.col("raw")).alias("target"))
    return target.select("url", resolved(F.col("url"), F.col("target")).alias("target")).where("target IS NOT NULL")


def judge(pages: DataFrame, rules: list[Rule], links: DataFrame | None = None) -> DataFrame:
    """Rows ``(page_id, host, path, rule, verdict)``: one for every page.

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are ignored. ``links`` are more
    rows ``(url, target)``, such as a log of redirects. The verdict is the rule's. Without a rule it
    is allow if an alias is allowed by a rule, else block if one is blocked, else allow. Null urls
    and urls without ``://`` fit no rule and are allowed; repeated pages get equal rows.
    """
    store = Store(pages.sparkSession)
    found = aliases(pages)
    if links is not None:
        found = found.unionByName(links.select("url", "target"))
    edges = store.put(
        found.select(node(F.col("url")).alias("a"), node(F.col("target")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "aliases"
    )
    named = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), node(F.col("url")).alias("node"))
    named = named.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    # A node is host, path and query, so its own rule can be read off it.
    groups = components(edges, store)
    whole = F.concat(F.lit("x://"), F.col("node"))
    own = allows(fitting_rule(host(whole), path(whole), rules), rules)
    decided = groups.withColumn("own", own).groupBy("component").agg(F.max("own").alias("allowed"), F.min("own").alias("least"))
    spread = groups.join(decided, "component").where("least = false").select("node", F.coalesce("allowed", F.lit(True)).alias("inherited"))
    verdict = F.coalesce(allows(F.col("rule"), rules), F.col("inherited"), F.lit(True))
    return named.join(spread, "node", "left").select(
        "page_id", "host", "path", "rule", F.when(verdict, "allow").otherwise("block").alias("verdict")
    )
