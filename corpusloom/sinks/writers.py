"""Sinks K1-K7."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.operators.corpus import manifest_lines
from corpusloom.operators.graph import distinct_triples, jsonld_nodes, ntriples_lines
from corpusloom.sinks.batches import write_batch


def write_todo(tasks: DataFrame, path: str, todo: str | None = None) -> bool:
    """Write the work list as TSV, publications first; skipped if a list was given."""
    if todo is not None:
        return False
    ordered = tasks.orderBy("part", "entity_id") if "part" in tasks.columns else tasks
    ordered.select("type", "entity_id", "url", "path").write.mode("overwrite").csv(path, sep="\t")
    return True


def write_texts(docs: DataFrame, folder: str, kind: str = "txt", batch: str = "all") -> int:
    """Write the non-empty texts of a batch, one folder per kind; return how many.

    Written again, a batch adds no row; ``batches.read_batches`` reads the complete ones.
    """
    seen = Observation("texts")
    kept = docs.where(F.length("text") > 0).select("doc_id", "text", F.lit(kind).alias("kind"))
    counted = kept.observe(seen, F.count("*").alias("texts"))
    return write_batch(counted, folder, f"{kind}-{batch}", ["kind"], seen)["texts"]


def phrase_documents(phrases: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: a map of phrase to count and score, in rank order.

    The rows of a document are its ranked phrases, at most the ``k`` they were cut to.
    """
    entry = F.struct("rk", "phrase", F.col("cnt").alias("count"), "rank_score")
    ordered = F.sort_array(F.collect_list(entry))
    pairs = F.transform(
        ordered, lambda e: F.struct(e["phrase"], F.struct(e["count"], e["rank_score"]))
    )
    return phrases.groupBy(key).agg(F.map_from_entries(pairs).alias("phrases"))


def section_documents(phrases: DataFrame, sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document with ``(section_title, text_rank)`` in section order.

    A section without phrases stays, with an empty map.
    """
    per_section = phrase_documents(
        phrases.withColumn("_at", F.struct(key, "sec_no")), "_at"
    ).select(f"_at.{key}", "_at.sec_no", "phrases")
    joined = sections.select(key, "sec_no", "title").join(per_section, [key, "sec_no"], "left")
    no_phrases = F.create_map().cast(per_section.schema["phrases"].dataType)
    entry = F.struct(
        "sec_no",
        F.col("title").alias("section_title"),
        F.coalesce("phrases", no_phrases).alias("text_rank"),
    )
    return joined.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(entry), lambda x, y: x["sec_no"] - y["sec_no"]),
            lambda e: F.struct(e["section_title"], e["text_rank"]),
        ).alias("sections")
    )


def write_phrases(nested: DataFrame, path: str) -> None:
    """Write nested phrases as JSON, one line per document; non-ASCII is kept."""
    nested.write.mode("overwrite").json(path)


def write_manifest(row: DataFrame, path: str) -> None:
    """``key: value`` lines of a one-row manifest in one small file."""
    manifest_lines(row).orderBy("line_no").select("value").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def write_ntriples(triples: DataFrame, path: str) -> None:
    ntriples_lines(distinct_triples(triples)).write.mode("overwrite").text(path)


def write_jsonld(triples: DataFrame, context: dict[str, str] | DataFrame, path: str) -> None:
    """Write compacted node objects, one per line."""
    jsonld_nodes(triples, context).write.mode("overwrite").text(path)


def sync_missing(files: DataFrame, done: DataFrame, target: str, batch: str) -> tuple[int, int]:
    """Write what the target lacks as a batch; return how many were there and how many are new.

    ``files(entity_id, kind, ...)``, ``done(entity_id, kind)``. Both counts are taken by the one job that
    writes. A batch that is complete is not written again and gives the counts of its first time.
    """
    seen = Observation("seen")
    known = done.select("entity_id", "kind").distinct()
    missing = files.join(known, ["entity_id", "kind"], "left_anti").withColumn("_new", F.lit(True))
    # what is there passes by to be counted; an observation below the join would be lost with an empty side
    both = missing.unionByName(known.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    counted = both.observe(seen, F.count_if(~F.col("_new")).alias("there"), F.count_if("_new").alias("new"))
    counts = write_batch(counted.where("_new").drop("_new"), target, batch, ["kind"], seen)
    return counts["there"], counts["new"]
