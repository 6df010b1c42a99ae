"""Tags and attributes of HTML pages, and references resolved as RFC 3986 says.

Comments, scripts and styles are passed over whole. A tag is scanned attribute by attribute, so a
``>`` inside quotes does not end it and an attribute's name inside another one's value is not taken
for it. All repeats are possessive: a page of any length needs no stack.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let
from corpusloom.functions.text import code_point

# One attribute: a name, and a value in quotes or up to white space.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_ATTRIBUTE = rf"[\s/]*+%s[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+"
_SKIPPED = r"<!--.*?(?:-->|\z)|<script[\s/>].*?(?:</script[\s/>]|\z)|<style[\s/>].*?(?:</style[\s/>]|\z)"

#: White space of HTML.
_SPACE = " \t\n\f\r"


def tags(html: Column, *names: str) -> Column:
    """The start tags of the given names, in page order, from ``<`` to ``>``."""
    attributes = rf"(?:{_ATTRIBUTE % ''})*+[\s/]*+"
    pattern = rf"(?is){_SKIPPED}|<(?:{'|'.join(names)})(?=[\s/>]){attributes}>"
    return F.filter(
        F.regexp_extract_all(html, F.lit(pattern), F.lit(0)),
        lambda t: ~t.rlike(r"(?i)^<(!--|script[\s/>]|style[\s/>])"),
    )


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's first attribute of that name, decoded and trimmed; empty if it has none."""
    others = _ATTRIBUTE % rf"(?!{name}[\s=/>])"
    raw = F.regexp_extract(tag, rf"(?is)^<\w++(?:{others})*+[\s/]*+{name}\s*+=\s*+({_VALUE})", 1)
    quoted = F.left(raw, F.lit(1)).isin('"', "'")
    value = F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    return F.btrim(decoded(value), F.lit(_SPACE))


def decoded(text: Column) -> Column:
    """Character references replaced: the named ones of HTML 4 and ``apos``, decimal and hexadecimal ones.

    A name that is not known stays as it is written.
    """
    # the table of names is a rule of Python's library
    names = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
    table = F.from_json(F.lit(json.dumps(names)), "map<string,string>")

    def piece(p: Column) -> Column:
        number = F.when(
            p.rlike("^&#[0-9]"), F.substr(p, F.lit(3), F.length(p) - 3).cast("long")
        ).otherwise(F.conv(F.substr(p, F.lit(4), F.length(p) - 4), 16, 10).cast("long"))
        return (
            F.when(~p.rlike("^&.+;$"), p)
            .when(p.startswith("&#"), code_point(number))
            .otherwise(F.coalesce(F.element_at(table, F.substr(p, F.lit(2), F.length(p) - 2)), p))
        )

    pieces = F.regexp_extract_all(
        text, F.lit(r"&(?:#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]*+);|[^&]++|&"), F.lit(0)
    )
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


# The five parts of a reference as RFC 3986, appendix B, cuts them, with their marks.
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?((?s:#.*))?"


def _parts(url: Column) -> Column:
    names = ("scheme", "authority", "path", "query", "fragment")
    return F.struct(*[F.regexp_extract(url, _PARTS, i).alias(n) for i, n in enumerate(names, 1)])


def without_dots(path: Column) -> Column:
    """The path without its segments ``.`` and ``..`` (RFC 3986, 5.2.4)."""
    rooted = path.startswith("/")
    segments = F.split(F.when(rooted, F.substr(path, F.lit(2))).otherwise(path), "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, s)),
    )
    # a last segment of dots leaves its slash
    ends = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    joined = F.concat(F.when(rooted, "/").otherwise(""), F.array_join(F.concat(kept, ends), "/"))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(path)


def resolve(reference: Column, base: Column) -> Column:
    """Absolute form of a reference found on the page ``base`` (RFC 3986, 5.2.2)."""

    def target(both: Column) -> Column:
        r, b = both["r"], both["b"]
        own, host, place = r["scheme"] != "", r["authority"] != "", r["path"] != ""
        folder = F.when((b["authority"] != "") & (b["path"] == ""), "/").otherwise(
            F.regexp_extract(b["path"], r"^((?s:.*)/)", 1)
        )
        path = (
            F.when(own | host, without_dots(r["path"]))
            .when(~place, b["path"])
            .when(r["path"].startswith("/"), without_dots(r["path"]))
            .otherwise(without_dots(F.concat(folder, r["path"])))
        )
        query = F.when(own | host | place | (r["query"] != ""), r["query"]).otherwise(b["query"])
        return F.concat(
            F.when(own, r["scheme"]).otherwise(b["scheme"]),
            F.when(own | host, r["authority"]).otherwise(b["authority"]),
            path,
            query,
            r["fragment"],
        )

    return let(F.struct(_parts(reference).alias("r"), _parts(base).alias("b")), target)


def document_base(html: Column, url: Column) -> Column:
    """What a page's references start from: its first ``<base href>``, or its own URL."""
    given = F.get(
        F.filter(F.transform(tags(html, "base"), lambda t: attribute(t, "href")), lambda h: h != ""), F.lit(0)
    )
    return F.when(F.contains(F.lower(html), F.lit("<base")), F.coalesce(resolve(given, url), url)).otherwise(url)
