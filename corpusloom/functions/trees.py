"""Parsed documents held as one VARIANT per document.

A tree of any depth is walked level by level by one fold inside its own row, so a
corpus of any size is read without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let

# Node types of a parse tree.
SECTION_TYPES = ("word", "line", "character", "paragraph", "heading", "list")
PAGE_TYPES = ("word", "line", "character", "paragraph", "heading")


def _content(node: Column, kind: str) -> Column:
    return F.try_variant_get(node, "$.content", kind)


def node_type(node: Column) -> Column:
    return F.try_variant_get(node, "$.type", "string")


def _leaf(kind: Column, node: Column) -> Column:
    """Text a node gives by itself: a word followed by a blank, or a character."""
    is_text = F.schema_of_variant(F.try_variant_get(node, "$.content", "variant")) == "STRING"
    text = _content(node, "string")
    return F.when((kind == "word") & is_text, F.concat(text, F.lit(" "))).when(
        (kind == "character") & is_text, text
    )


def _walk(node: Column, types: tuple[str, ...], path: Column) -> Column:
    """State of one node: its type, own text, and children still to be walked."""
    inner = [t for t in types if t != "character"]
    return let(
        node_type(node),
        lambda kind: F.struct(
            path.alias("path"),
            kind.alias("type"),
            _leaf(kind, node).alias("text"),
            F.when(kind.isin(inner), _content(node, "array<variant>")).alias("kids"),
        ),
    )


def _most_levels(nodes: Column) -> Column:
    """No tree of these nodes has more levels: every level but the first is in brackets of its own."""

    def brackets(n: Column) -> Column:
        text = F.to_json(F.struct(n.alias("n")))
        return F.length(text) - F.length(F.replace(text, F.lit("["), F.lit("")))

    return F.coalesce(F.array_max(F.transform(nodes, brackets)), F.lit(0))


def _walked(roots: Column, levels: Column, types: tuple[str, ...], spell_out: bool = False) -> Column:
    """All nodes below ``roots``, and these, in tree order: ``array<struct<path, type, text>>``.

    A fold walks one level a step, as many as the row's own nesting asks for. Nodes that
    are finished are set aside and not touched again; only the frontier is expanded, and a step
    with nothing left to expand does nothing. Paths sort into tree order in the end.
    """

    def finished(states: Column) -> Column:
        return F.transform(states, lambda s: F.struct(s["path"], s["type"], s["text"]))

    def kids_of(s: Column) -> Column:
        kids = F.transform(s["kids"], lambda n, i: _walk(n, types, F.concat(s["path"], F.array(i))))
        if not spell_out:
            return kids
        blank = F.struct(
            F.concat(s["path"], F.array(F.size(s["kids"]))).alias("path"),
            F.lit("character").alias("type"),
            F.lit(" ").alias("text"),
            F.lit(None).cast("array<variant>").alias("kids"),
        )
        return F.when(s["type"] == "word", F.concat(kids, F.array(blank))).otherwise(kids)

    def step(state: Column, _) -> Column:
        frontier = F.filter(state["frontier"], lambda s: s["kids"].isNotNull())
        below = F.flatten(F.transform(frontier, kids_of))
        return F.when(F.size(state["frontier"]) == 0, state).otherwise(
            let(below, lambda b: F.struct(F.concat(state["done"], finished(b)).alias("done"), b.alias("frontier")))
        )

    start = let(roots, lambda r: F.struct(finished(r).alias("done"), r.alias("frontier")))
    return F.aggregate(F.sequence(F.lit(0), levels), start, step, lambda state: F.sort_array(state["done"]))


def element_text(
    element: Column,
    types: tuple[str, ...] = SECTION_TYPES,
    space_after_spelled_words: bool = False,
) -> Column:
    """Leaf text of one element in tree order."""
    root = F.array(_walk(element, types, F.array().cast("array<int>")))
    walked = _walked(root, _most_levels(F.array(element)), types, space_after_spelled_words)
    return F.array_join(F.transform(walked, lambda s: F.coalesce(s["text"], F.lit(""))), "")


def pages(doc: Column, paged: bool = False) -> Column:
    """The pages of a tree; ``paged`` says that ``doc`` is their list, one VARIANT each."""
    return doc if paged else F.try_variant_get(doc, "$.pages", "array<variant>")


def elements(doc: Column, paged: bool = False) -> Column:
    """Top-level elements across all pages: ``array<struct<page_no, type, node>>``.

    Elements without a type are left out.
    """

    def of_page(page: Column) -> Column:
        number = F.try_variant_get(page, "$.pageNumber", "int")
        return F.transform(
            F.coalesce(
                F.try_variant_get(page, "$.elements", "array<variant>"),
                F.array().cast("array<variant>"),
            ),
            lambda n: F.struct(
                number.alias("page_no"), node_type(n).alias("type"), n.alias("node")
            ),
        )

    return F.filter(
        F.flatten(F.transform(pages(doc, paged), of_page)), lambda e: e["type"].isNotNull()
    )
