"""Scalar functions on URLs, file names, tokens and resources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let
from corpusloom.functions.html import attribute, document_base, resolve, tags

# The parts of a URI as RFC 3986, appendix B, cuts them.
_URI = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?[^#]*)?(?:#((?s:.*)))?"

# Hosts that need a route of their own, and the route names.
LINK_HOST = "www.sciencedirect.com"
EMBED_HOST_SUFFIX = "onlinelibrary.wiley.com"


def url_scheme(url: Column) -> Column:
    return F.regexp_extract(url, _URI, 1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, _URI, 2)


def url_fragment(url: Column) -> Column:
    return F.regexp_extract(url, _URI, 4)


def url_site(url: Column) -> Column:
    return F.concat(url_scheme(url), F.lit("://"), url_host(url))


def url_parts(url: Column) -> Column:
    """``struct<scheme, host, fragment>``; absent parts are empty."""
    return F.struct(
        url_scheme(url).alias("scheme"),
        url_host(url).alias("host"),
        url_fragment(url).alias("fragment"),
    )


def entity_key(iri: Column) -> Column:
    """Short id of an entity: second ``-`` field of the IRI's fragment."""
    return F.split_part(url_fragment(iri), F.lit("-"), F.lit(2))


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1)


def read_file_stem() -> Column:
    """Stem of the file a row was read from; Spark gives its path percent-encoded."""
    return file_stem(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def key_id(key: Column, kind: Column | str) -> Column:
    """Id in a store key: fourth ``/`` part, cut at the extension."""
    ext = F.concat(F.lit("."), F.lit(kind) if isinstance(kind, str) else kind)
    return F.split_part(F.split_part(key, F.lit("/"), F.lit(4)), ext, F.lit(1))


def object_path(prefix: Column, kind: Column, key: Column) -> Column:
    return F.concat(prefix, F.lit("/pub/"), kind, F.lit("/"), key, F.lit("."), kind)


def resource_type(declared: Column, content_type: Column) -> Column:
    """Settle an unknown type by the content-type header."""
    return (
        F.when(declared.isin("pdf", "html"), declared)
        .when(
            declared == "unknown",
            F.when(F.contains(content_type, F.lit("text/html")), "html").otherwise("pdf"),
        )
        .otherwise(F.raise_error(F.concat(F.lit("invalid resource type: "), declared)))
    )


def fetch_route(url: Column) -> Column:
    """``links``, ``embed`` or ``direct``, by the host."""
    host = url_host(url)
    return (
        F.when(host == LINK_HOST, "links")
        .when(host.endswith(EMBED_HOST_SUFFIX), "embed")
        .otherwise("direct")
    )


def links(html: Column, url: Column) -> Column:
    """Absolute links of a page in page order; anchors, scripts and mail are left out.

    A link is the ``href`` of an ``<a>``, quoted or not, with its character references decoded,
    resolved against the page's ``<base>`` or its own URL.
    """
    hrefs = F.transform(tags(html, "a"), lambda t: attribute(t, "href"))
    kept = F.filter(hrefs, lambda h: ~h.rlike(r"(?i)^(#|javascript:|mailto:|$)"))
    return let(document_base(html, url), lambda base: F.transform(kept, lambda h: resolve(h, base)))


def embedded_src(html: Column, url: Column) -> Column:
    """Absolute form of the first ``src`` of an ``<embed>`` of the page; null if none."""
    sources = F.filter(F.transform(tags(html, "embed"), lambda t: attribute(t, "src")), lambda s: s != "")
    return resolve(F.get(sources, F.lit(0)), document_base(html, url))


def pdf_flag(content: Column) -> Column:
    return F.substring(content, 1, 5) == F.lit(b"%PDF-")


def quoted_token(token: Column) -> Column:
    """``<token>`` for an IRI, else a quoted literal on one line."""
    escaped = token
    for raw, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(written))
    return F.when(
        token.startswith("http"), F.concat(F.lit("<"), token, F.lit(">"))
    ).otherwise(F.concat(F.lit('"'), escaped, F.lit('"')))


def iso_date(day: Column | None = None) -> Column:
    return F.date_format(F.current_date() if day is None else day, "yyyy-MM-dd")


def to_json_doc(value: Column) -> Column:
    return F.to_json(value)


def from_json_doc(text: Column, schema) -> Column:
    return F.from_json(text, schema)
