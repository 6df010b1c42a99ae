"""Sections and pages of parsed documents, from trees and from element tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import trees as V
from corpusloom.functions.nodes import leaves, walk
from corpusloom.operators.running import running_total

#: Elements whose nodes are held at a time.
PER_BATCH = 512


def _paged(docs: DataFrame) -> bool:
    """Whether ``doc`` is a list of pages, as the reader gives it, and not one VARIANT."""
    return isinstance(docs.schema["doc"].dataType, T.ArrayType)


def flatten_tree(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``node(key, path, type, text)`` for trees ``(key, doc VARIANT)``.

    A row holds one element of a page, so a task has the nodes of one batch of elements at a time, not of documents.
    """
    elements = F.try_variant_get("page", "$.elements", "array<variant>")
    paged = docs.select(key, F.posexplode(V.pages(F.col("doc"), _paged(docs))).alias("page_pos", "page"))
    rows = paged.select(key, "page_pos", F.posexplode(elements).alias("elem_pos", "node")).select(
        key, "page_pos", "elem_pos", F.to_json(F.struct("node")).alias("json")
    )
    found = T.StructType.fromDDL("path array<int>, type string, text string")
    schema = T.StructType([docs.schema[key], *found.fields])
    inner = frozenset(V.SECTION_TYPES) - {"character"}

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PER_BATCH):
                part = batch.slice(at, PER_BATCH)
                row, path, kind, text = [], [], [], []
                for i, (page, elem, tree) in enumerate(zip(*(part.column(c).to_pylist() for c in (1, 2, 3)))):
                    for below, k, t in walk(tree, inner):
                        row.append(i)
                        path.append([page, elem, *below])
                        kind.append(k)
                        text.append(t)
                columns = [part.column(0).take(pa.array(row, pa.int32())), pa.array(path, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(kind, pa.string()), pa.array(text, pa.string())], schema.names)

    return rows.mapInArrow(nodes, schema)


def _element_rows(docs: DataFrame, key: str, types: tuple[str, ...] | None = None, outer: bool = False) -> DataFrame:
    """A row for every typed element: its document's key and a number of its row, and the JSON of its tree.

    Rows of a document follow each other in order. Elements of other types than ``types`` have no JSON; with
    ``outer`` a document without elements has a row too, where ``known`` says whether it has pages.
    """
    listed = docs.select(key, F.monotonically_increasing_id().alias("row"), V.elements(F.col("doc"), _paged(docs)).alias("list"))
    listed = listed.withColumn("known", F.col("list").isNotNull())
    explode = F.posexplode_outer if outer else F.posexplode
    rows = listed.select(key, "row", "known", explode("list").alias("elem_no", "e"))
    json = F.to_json(F.struct(F.col("e.node").alias("node")))
    wanted = F.col("e.type").isNotNull() if types is None else F.col("e.type").isin(*types)
    return rows.select(key, "row", "known", "e.page_no", "elem_no", "e.type", F.when(wanted, json).alias("json"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PER_BATCH):
            yield batch.slice(at, PER_BATCH)


def tree_sections(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``section(key, sec_no, title, text)`` straight from the trees.

    A heading opens a section and its text is also the start of the section's text; what stands before the first
    heading is dropped; page breaks do not matter. A task holds a batch of elements and one section.
    """
    rows = _element_rows(docs, key, V.SECTION_TYPES).where("json is not null").select(key, "row", "type", "json")
    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL("sec_no int, title string, text string").fields])
    inner = frozenset(V.SECTION_TYPES) - {"character"}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, last, number, texts, done, kind = None, None, 0, [], [], None

        def close() -> None:
            if texts:
                done.append((last, number, texts[0], "".join(t + "\n\n" for t in texts)))

        def rows_done() -> pa.RecordBatch:
            columns = zip(*done) if done else ([],) * 4
            types = kind, pa.int32(), pa.string(), pa.string()
            return pa.RecordBatch.from_arrays([*map(pa.array, columns, types)], schema.names)

        for part in _parts(batches):
            kind = part.schema.field(0).type
            for k, r, t, tree in zip(*(c.to_pylist() for c in part.columns)):
                if r != row or t == "heading":
                    close()
                    number = number + 1 if r == row else int(t == "heading")
                    row, last, texts = r, k, []
                if number:
                    texts.append(leaves(tree, inner))
            yield rows_done()
            done = []
        close()
        if done:
            yield rows_done()

    return rows.mapInArrow(cut, schema)


def tree_page_text(
    docs: DataFrame, page_no: int | None = None, key: str = "doc_id"
) -> DataFrame:
    """Text of a page, or of all pages; lists are not text here. A document without that page gives no row."""
    if page_no is not None:
        numbers = F.transform(
            V.pages(F.col("doc"), _paged(docs)), lambda p: F.try_variant_get(p, "$.pageNumber", "int")
        )
        docs = docs.where(F.array_contains(numbers, page_no))
    rows = _element_rows(docs, key, V.PAGE_TYPES, outer=True)
    if page_no is not None:
        rows = rows.withColumn("json", F.when(F.col("page_no") == page_no, F.col("json")))
    # A document's first row stays, as it may be the only one.
    rows = rows.where("json is not null or coalesce(elem_no, 0) = 0").select(key, "row", "known", "json")
    schema = T.StructType([docs.schema[key], T.StructField("text", T.StringType())])
    inner = frozenset(V.PAGE_TYPES) - {"character"}

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, last, known, texts, done, kind = None, None, False, [], [], None

        def close() -> None:
            if row is not None:
                done.append((last, "".join(texts) if known else None))

        def rows_done() -> pa.RecordBatch:
            columns = zip(*done) if done else ([],) * 2
            return pa.RecordBatch.from_arrays([*map(pa.array, columns, (kind, pa.string()))], schema.names)

        for part in _parts(batches):
            kind = part.schema.field(0).type
            for k, r, has_pages, tree in zip(*(c.to_pylist() for c in part.columns)):
                if r != row:
                    close()
                    row, last, known, texts = r, k, has_pages, []
                if tree is not None:
                    texts.append(leaves(tree, inner) + "\n\n")
            yield rows_done()
            done = []
        close()
        if done:
            yield rows_done()

    return rows.mapInArrow(joined, schema)


def tree_elements(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``element(key, page_no, elem_no, type, text)`` of trees."""
    rows = _element_rows(docs, key).select(key, "page_no", "elem_no", "type", "json")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType())])
    inner = frozenset(V.SECTION_TYPES) - {"character"}

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            text = pa.array([leaves(tree, inner) for tree in part.column("json").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], text], schema.names)

    return rows.mapInArrow(texts, schema)


def leaf_text(nodes: DataFrame) -> DataFrame:
    """Nodes that carry text of their own."""
    return nodes.where(F.col("text").isNotNull())


def _in_order(order: str, text: Column) -> Column:
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), text.alias("text"))))
    return F.array_join(F.transform(pairs, lambda x: x["text"]), "")


def node_text(nodes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Leaf text in tree order for each top-level element (page and element position)."""
    at = F.col("path")
    return (
        nodes.groupBy(
            key, F.get(at, F.lit(0)).alias("page_pos"), F.get(at, F.lit(1)).alias("elem_pos")
        )
        .agg(_in_order("path", F.coalesce("text", F.lit(""))).alias("text"))
    )


def text_elements(elements: DataFrame, with_lists: bool = True) -> DataFrame:
    return elements.where(
        F.col("type").isin(*(V.SECTION_TYPES if with_lists else V.PAGE_TYPES))
    )


def page(elements: DataFrame, n: int) -> DataFrame:
    return elements.where(F.col("page_no") == n)


def assign_sections(
    elements: DataFrame, key: str = "doc_id", order: str = "elem_no"
) -> DataFrame:
    """Number the sections of a table of elements; 0 is what precedes the first heading."""
    flagged = elements.where(F.col("type").isNotNull()).withColumn(
        "_head", (F.col("type") == "heading").cast("long")
    )
    return running_total(flagged, [key], order, "_head", "sec_no").drop("_head")


def drop_preamble(elements: DataFrame) -> DataFrame:
    return elements.where("sec_no >= 1")


def section_text(elements: DataFrame, key: str = "doc_id", order: str = "elem_no") -> DataFrame:
    """Element texts of a section, an empty line after each."""
    body = _in_order(order, F.concat("text", F.lit("\n\n")))
    return elements.groupBy(key, "sec_no").agg(body.alias("text"))


def section_titles(elements: DataFrame, key: str = "doc_id") -> DataFrame:
    """Titles, numbered like the sections they open."""
    return elements.where("type = 'heading'").select(
        key, "sec_no", F.col("text").alias("title")
    )


def sections_with_titles(texts: DataFrame, titles: DataFrame, key: str = "doc_id") -> DataFrame:
    return texts.join(titles, [key, "sec_no"]).select(key, "sec_no", "title", "text")


def sections(elements: DataFrame, key: str = "doc_id", order: str = "elem_no") -> DataFrame:
    """Titled sections of a table of elements in one pass over the numbered rows.

    The heading belongs to its section, so the title is picked up by the same
    aggregation that builds the text and no join is needed.
    """
    numbered = drop_preamble(assign_sections(text_elements(elements), key, order))
    return numbered.groupBy(key, "sec_no").agg(
        F.max(F.when(F.col("type") == "heading", F.col("text"))).alias("title"),
        _in_order(order, F.concat("text", F.lit("\n\n"))).alias("text"),
    )


def page_text(
    elements: DataFrame, n: int | None = None, key: str = "doc_id", order: str = "elem_no"
) -> DataFrame:
    kept = text_elements(elements, with_lists=False)
    if n is not None:
        kept = page(kept, n)
    body = _in_order(order, F.concat("text", F.lit("\n\n")))
    return kept.groupBy(key).agg(body.alias("text"))
