"""Triples, node and edge tables, neighbourhoods."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.scalars import quoted_token
from corpusloom.functions.text import code_point
from corpusloom.operators.running import running_total
from corpusloom.session import checkpointed


def distinct_triples(triples: DataFrame) -> DataFrame:
    return triples.select("s", "p", "o").distinct()


def touching(triples: DataFrame, suffix: str) -> DataFrame:
    """Triples whose subject or object ends with ``suffix``."""
    return triples.where(F.col("s").endswith(suffix) | F.col("o").endswith(suffix))


def neighbourhood(triples: DataFrame, term: str) -> DataFrame:
    return distinct_triples(touching(triples, term))


def index_nodes(triples: DataFrame) -> DataFrame:
    """Number the nodes from 0 by first appearance, subject before object.

    ``triples`` carries ``seq``, the order of the triples. A node is first seen
    at one place only, so places are unique, and ranges of places are counted with the
    sums of the ranges before them. The first places are written once to the shared folder.
    """
    place = F.col("seq").cast("decimal(20,0)") * 2  # twice a long needs more than a long
    seen = triples.select(
        F.inline(
            F.array(
                F.struct(F.col("s").alias("name"), place.alias("place")),
                F.struct(F.col("o").alias("name"), (place + 1).alias("place")),
            )
        )
    )
    first = checkpointed(seen.groupBy("name").agg(F.min("place").alias("place")))
    counted = running_total(first.withColumn("_one", F.lit(1).cast("long")), [], "place", "_one", "_n")
    return counted.select((F.col("_n") - 1).alias("id"), "name")


def collapse_edges(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One undirected edge per pair; the label of the last triple wins."""
    return edges.groupBy(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).agg(
        F.max_by("label", "seq").alias("label")
    )


def named_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Replace the names at both ends of ``edges(a, b, label)`` by node ids."""
    left = nodes.select(F.col("name").alias("a"), F.col("id").alias("a_id"))
    right = nodes.select(F.col("name").alias("b"), F.col("id").alias("b_id"))
    return (
        edges.join(left, "a")
        .join(right, "b")
        .select(
            F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"), "label"
        )
    )


def node_edge_tables(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node table and undirected labelled edge table of ``triples(seq, s, p, o)``.

    Edges are collapsed by name before the names are looked up, so the two joins
    see one row per pair; AQE splits a node that holds very many of them.
    """
    nodes = checkpointed(index_nodes(triples))
    edges = collapse_edges(
        triples.select(
            "seq", F.col("s").alias("a"), F.col("o").alias("b"), F.col("p").alias("label")
        )
    )
    return nodes, named_edges(edges, nodes)


def context_table(spark: SparkSession, context: dict[str, str] | DataFrame) -> DataFrame:
    """A vocabulary as ``(prefix, iri)``; a table of any size stays as it is."""
    if isinstance(context, DataFrame):
        return context.select("prefix", "iri")
    return spark.createDataFrame(pd.DataFrame({"prefix": list(context), "iri": list(context.values())}, dtype="object"), "prefix string, iri string")


def compact_iris(df: DataFrame, columns: list[str], context: dict[str, str] | DataFrame) -> DataFrame:
    """Shorten the IRIs of ``columns`` by the longest namespace of the vocabulary they start with.

    A namespace is found by equality: it is filed under its first characters, as many as
    the largest power of two not above its length, and an IRI looks its own first characters
    up, the longest such cut first. Only namespaces under one key are compared in
    the row. A vocabulary of any size is a table on the small side of a join; namespaces have at most
    32 different cuts, which decide the number of joins. Of several prefixes of one namespace the
    first by name is used; names that begin with ``@`` are not prefixes.
    """
    spaces = context_table(df.sparkSession, context).where(~F.col("prefix").startswith("@"))
    spaces = spaces.groupBy("iri").agg(F.min("prefix").alias("prefix"))
    cut = F.when(F.length("iri") == 0, 0).otherwise(F.call_function("shiftleft", F.lit(1), F.length(F.bin(F.length("iri"))) - 1))
    spaces = spaces.withColumn("_cut", cut)
    cuts = sorted((r[0] for r in spaces.select("_cut").distinct().collect()), reverse=True)  # 32 numbers at most
    filed = spaces.groupBy("_cut", F.substr("iri", F.lit(1), F.col("_cut")).alias("_key")).agg(
        F.sort_array(F.collect_list(F.struct(F.length("iri").alias("size"), "iri", "prefix")), asc=False).alias("_spaces")
    )
    out = df
    for c in columns:
        found = []
        for n in cuts:
            under = filed.where(F.col("_cut") == n).select(F.col("_key").alias(f"_key{n}"), F.col("_spaces").alias(f"_spaces{n}"))
            out = out.join(under, F.substr(F.col(c), F.lit(1), F.lit(n)) == F.col(f"_key{n}"), "left")
            longest = F.get(F.filter(f"_spaces{n}", lambda x: F.col(c).startswith(x["iri"])), F.lit(0))
            found.append(F.concat(longest["prefix"], F.lit(":"), F.substr(F.col(c), longest["size"] + 1)))
        out = out.select(*[F.coalesce(*found, F.col(c)).alias(c) if x == c else F.col(x) for x in df.columns])
    return out


def compact_triples(triples: DataFrame, context: dict[str, str] | DataFrame) -> DataFrame:
    return compact_iris(triples.select("s", "p", "o"), ["s", "p", "o"], context)


def ntriples_lines(triples: DataFrame) -> DataFrame:
    """One ``s p o .`` line per triple."""
    parts = [quoted_token(F.col(c)) for c in ("s", "p", "o")]
    return triples.select(F.concat_ws(" ", *parts, F.lit(".")).alias("value"))


# The terms and escapes of N-Triples. All repeats are possessive, so a literal of any
# length needs no stack. A literal may stand anywhere, as ``ntriples_lines`` writes it.
_CODE = r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}"
_ESCAPE = rf"\\[tbnrf\"'\\]|{_CODE}"
_TERM = rf"(?:<([^>\n\r]*+)>|\"((?:[^\"\\\n\r]++|{_ESCAPE})*+)\"(?:@[A-Za-z0-9-]++|\^\^<[^>\n\r]*+>)?+|(_:[^\s<\"]*[^\s<\".]))"
_LINE = rf"^\s*+{_TERM}\s*+{_TERM}\s*+{_TERM}\s*+\.\s*+(?:#[^\n\r]*+)?$"
_ESCAPED = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}

PERMISSIVE, DROPMALFORMED, FAILFAST = "PERMISSIVE", "DROPMALFORMED", "FAILFAST"


def _unescaped(text: Column, escape: str) -> Column:
    """A term without its escapes, each read once from left to right; an IRI only has those of ``_CODE``."""

    def piece(p: Column) -> Column:
        mark = F.substr(p, F.lit(2), F.lit(1))
        out = F.when(~p.startswith("\\") | (F.length(p) == 1), p)
        out = out.when(mark.isin("u", "U"), code_point(F.conv(F.substr(p, F.lit(3)), 16, 10).cast("long")))
        for written, raw in _ESCAPED.items():
            out = out.when(mark == written, F.lit(raw))
        return out.otherwise(mark)

    pieces = F.regexp_extract_all(text, F.lit(rf"{escape}|[^\\]++|\\"), F.lit(0))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def parse_ntriples(lines: DataFrame, column: str = "value", mode: str = FAILFAST) -> DataFrame:
    """Triples of N-Triples lines; language tags and datatypes are dropped, escapes are read.

    One pattern cuts a line into its terms, in one pass. Blank lines, comments and nulls give no row. What
    becomes of any other line that is no triple is said by ``mode``, as in Spark's readers: it
    is an error, gives no row, or (``PERMISSIVE``) gives a row with null terms, the line in ``bad_line`` and
    in ``reason`` the first part that is wrong.
    """
    if mode not in (PERMISSIVE, DROPMALFORMED, FAILFAST):
        raise ValueError(f"unknown mode {mode}")
    # no term holds a line break, so one stands between what the groups found
    cut = F.regexp_replace(F.col(column), _LINE, "\n".join(f"${i}" for i in range(1, 10)))

    def triple(both: Column) -> Column:
        line = both["line"]
        parts = F.split(both["cut"], "\n", -1)
        good = (F.size(parts) == 9) & ~F.contains(line, F.lit("\n"))

        def term(at: int) -> Column:
            iri, literal, blank = (F.get(parts, F.lit(at + i)) for i in range(3))
            return F.when(good, F.concat(_unescaped(iri, _CODE), _unescaped(literal, _ESCAPE), blank))

        reason = F.lit("no end")
        for n, name in reversed(list(enumerate(("subject", "predicate", "object")))):
            found = line.rlike(rf"^\s*+{n * rf'{_TERM}\s*+'}{_TERM}")
            reason = F.when(~found, f"no {name}").otherwise(reason)
        if mode == FAILFAST:
            reason = F.raise_error(F.concat(F.lit("not a triple, "), reason, F.lit(": "), line)).cast("string")
        return F.struct(
            term(0).alias("s"), term(3).alias("p"), term(6).alias("o"),
            F.when(~good, line).alias("bad_line"), F.when(~good, reason).alias("reason"),
        )

    both = F.struct(F.col(column).alias("line"), cut.alias("cut"))
    read = lines.where(~F.col(column).rlike(r"^\s*+(#.*)?$")).select(F.inline(F.transform(F.array(both), triple)))
    if mode == PERMISSIVE:
        return read
    # the reason is asked for, so that a bad line is met whichever columns are read
    return read.where(F.col("reason").isNull()).select("s", "p", "o")


def jsonld_nodes(
    triples: DataFrame, context: dict[str, str] | DataFrame, per_object: int = 100_000
) -> DataFrame:
    """One JSON-LD node object per subject as a line of JSON.

    JSON-LD allows several node objects with the same ``@id``; a subject with
    more than ``per_object`` triples is written as several, so that no row has to
    hold a subject of any size.
    """
    short = compact_triples(distinct_triples(triples), context)
    large = (
        short.groupBy("s").agg(F.count("*").alias("_n")).where(F.col("_n") > per_object)
    )
    parts = F.ceil(F.col("_n") / per_object)
    placed = short.join(large, "s", "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64("p", "o"), parts), F.lit(0))
    )
    by_predicate = placed.groupBy("s", "_part", "p").agg(
        F.sort_array(F.collect_list("o")).alias("os")
    )
    members = F.sort_array(F.collect_list(F.struct("p", "os")))
    quoted = F.transform(
        members,
        lambda m: F.concat(_json_string(m["p"]), F.lit(":"), F.to_json(m["os"])),
    )
    return by_predicate.groupBy("s", "_part").agg(quoted.alias("_members")).select(
        F.concat(
            F.lit('{"@id":'),
            _json_string(F.col("s")),
            F.lit(","),
            F.array_join("_members", ","),
            F.lit("}"),
        ).alias("value")
    )


def _json_string(value: Column) -> Column:
    as_list = F.to_json(F.array(value))
    return F.substr(as_list, F.lit(2), F.length(as_list) - 2)
