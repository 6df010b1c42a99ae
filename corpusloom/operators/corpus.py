"""Corpus accounting: entities, work lists, finished and missing files.

Entities are ``(id, type, access_urls, access_is_list, page_url)``, file listings
``(path, length)``. Every join is an equi join on an id; the file side is made
distinct first, so that copies cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.scalars import entity_key, file_stem, key_id

# Entity types, task types, folders and the placeholder page.
PUBLICATION = "ResearchPublication"
DATASET = "Dataset"
PUBLICATION_FOLDER = "pub/pdf/"
DATASET_FOLDER = "dat/"
PLACEHOLDER_PAGE = "http://example.com"
KINDS = ("pdf", "json", "txt")


def entities_of(records: DataFrame, column: str = "record") -> DataFrame:
    """Project VARIANT records of a corpus.

    The access field is an object, or a list of objects when the corpus holds a
    copy of the publication.
    """
    v = F.col(column)
    access = F.try_variant_get(v, "$.openAccess", "variant")
    as_list = F.try_variant_get(v, "$.openAccess", "array<variant>")

    def value(node: Column) -> Column:
        return F.try_variant_get(node, '$["@value"]', "string")

    return records.select(
        F.try_variant_get(v, '$["@id"]', "string").alias("id"),
        F.try_variant_get(v, '$["@type"]', "string").alias("type"),
        F.when(as_list.isNotNull(), F.transform(as_list, value))
        .when(access.isNotNull(), F.array(value(access)))
        .alias("access_urls"),
        F.coalesce(F.schema_of_variant(access).startswith("ARRAY"), F.lit(False)).alias(
            "access_is_list"
        ),
        F.try_variant_get(v, '$["foaf:page"]["@value"]', "string").alias("page_url"),
    )


def corpus_size(entities: DataFrame) -> DataFrame:
    return entities.agg(F.count("*").alias("n"))


def of_type(entities: DataFrame, kind: str) -> DataFrame:
    return entities.where(F.col("type") == kind)


def with_entity_id(entities: DataFrame) -> DataFrame:
    return entities.withColumn("entity_id", entity_key(F.col("id")))


def access_url(entities: DataFrame) -> DataFrame:
    return entities.withColumn("url", F.get("access_urls", F.lit(0)))


def duplicate_publications(entities: DataFrame) -> DataFrame:
    """Publications whose access field is a list, with all its URLs."""
    return with_entity_id(of_type(entities, PUBLICATION).where("access_is_list")).select(
        "entity_id", "access_urls"
    )


def page_url(entities: DataFrame) -> DataFrame:
    """Keep rows with a page that is not a placeholder."""
    url = F.col("page_url")
    return entities.where(url.isNotNull() & ~url.startswith(PLACEHOLDER_PAGE)).withColumn(
        "url", url
    )


def as_tasks(df: DataFrame, kind: str, path: str) -> DataFrame:
    return df.select(
        F.lit(kind).alias("type"), "entity_id", "url", F.lit(path).alias("path")
    )


def non_empty(files: DataFrame) -> DataFrame:
    return files.where("length > 0")


def of_kind(keys: DataFrame, kind: str, column: str = "path") -> DataFrame:
    return keys.where(F.col(column).endswith(f".{kind}"))


def id_set(files: DataFrame, column: str = "path") -> DataFrame:
    """Distinct file stems."""
    return files.select(file_stem(F.col(column)).alias("entity_id")).distinct()


def id_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("entity_id").subtract(right.select("entity_id"))


def _without(left: DataFrame, done: DataFrame) -> DataFrame:
    return left.join(done, "entity_id", "left_anti")


def finished(left: DataFrame, done: DataFrame) -> DataFrame:
    """The rows an anti join would drop."""
    return left.join(done, "entity_id", "left_semi")


def pending_publications(
    entities: DataFrame, files: DataFrame, force: bool = False, path: str = PUBLICATION_FOLDER
) -> DataFrame:
    pubs = access_url(with_entity_id(of_type(entities, PUBLICATION)))
    if not force:
        pubs = _without(pubs, id_set(of_kind(files, "pdf")))
    return as_tasks(pubs, "pdf", path)


def pending_datasets(
    entities: DataFrame, files: DataFrame, force: bool = False, path: str = DATASET_FOLDER
) -> DataFrame:
    """A file of any extension counts as fetched."""
    sets = page_url(with_entity_id(of_type(entities, DATASET)))
    if not force:
        sets = _without(sets, id_set(files))
    return as_tasks(sets, "unknown", path)


def worklist(publications: DataFrame, datasets: DataFrame) -> DataFrame:
    """Publication tasks, then dataset tasks; ``part`` keeps that order."""
    return publications.withColumn("part", F.lit(0)).unionByName(
        datasets.withColumn("part", F.lit(1))
    )


def pending_conversions(pdfs: DataFrame, texts: DataFrame) -> DataFrame:
    """Non-empty PDFs that have no non-empty text."""
    return id_difference(id_set(non_empty(pdfs)), id_set(non_empty(texts)))


def pending_parses(pdfs: DataFrame, parsed: DataFrame, force: bool = False) -> DataFrame:
    """PDFs without a parsed file; sizes do not matter."""
    ids = id_set(pdfs)
    return ids if force else _without(ids, id_set(parsed))


def stored_ids(keys: DataFrame, kind: str, prefix: str = "corpus_docs") -> DataFrame:
    """Ids already in the store for one kind."""
    listed = of_kind(keys, kind).where(F.col("path").startswith(f"{prefix}/pub/{kind}"))
    return listed.select(key_id(F.col("path"), kind).alias("entity_id")).distinct()


def pending_uploads(local: DataFrame, done: DataFrame, kind: str) -> DataFrame:
    files = of_kind(local, kind)
    return _without(files.withColumn("entity_id", file_stem(F.col("path"))), done)


def missing_resources(
    entities: DataFrame, pub_files: DataFrame, dat_files: DataFrame
) -> DataFrame:
    """Distinct ids, per type, that still have no file."""
    ids = with_entity_id(entities).select("type", "entity_id")
    pubs = _without(of_type(ids, PUBLICATION), id_set(of_kind(pub_files, "pdf")))
    sets = _without(of_type(ids, DATASET), id_set(dat_files))
    return pubs.unionByName(sets).distinct()


def resource_stats(entities: DataFrame, pub_files: DataFrame, dat_files: DataFrame) -> DataFrame:
    """Per type: records, fetched (records less distinct missing ids), missing."""
    total = (
        entities.where(F.col("type").isin(PUBLICATION, DATASET))
        .groupBy("type")
        .agg(F.count("*").alias("total"))
    )
    missing = (
        missing_resources(entities, pub_files, dat_files)
        .groupBy("type")
        .agg(F.count("*").alias("missing"))
    )
    lacking = F.coalesce("missing", F.lit(0)).cast("long")
    return total.join(missing, "type", "left").select(
        "type",
        "total",
        (F.col("total") - lacking).alias("fetched"),
        lacking.alias("missing"),
    )


def manifest(
    local: DataFrame,
    keys: DataFrame,
    date: str,
    release: str,
    kinds=KINDS,
    prefix: str = "corpus_docs",
) -> DataFrame:
    """One row: date, release and, per kind, stored plus newly stored files."""
    parts = []
    for kind in kinds:
        done = stored_ids(keys, kind, prefix)
        new = pending_uploads(local, done, kind).select("entity_id")
        parts.append(done.unionByName(new).select(F.lit(kind).alias("kind")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    counts = rows.agg(
        *[F.count_if(F.col("kind") == kind).alias(f"uploaded_{kind}") for kind in kinds]
    )
    return counts.select(
        F.lit(date).alias("date"),
        F.lit(release).alias("release"),
        *[f"uploaded_{kind}" for kind in kinds],
    )


def manifest_lines(row: DataFrame) -> DataFrame:
    """``key: value`` lines of a one-row manifest, in column order."""
    pairs = [
        F.struct(
            F.lit(i).alias("line_no"),
            F.concat_ws(": ", F.lit(name), F.col(name).cast("string")).alias("value"),
        )
        for i, name in enumerate(row.columns)
    ]
    return row.select(F.inline(F.array(*pairs)))


def first_keys(
    keys: DataFrame, n: int = 10, prefix: str = "corpus_docs", column: str = "path"
) -> DataFrame:
    return keys.where(F.col(column).startswith(prefix)).orderBy(column).limit(n)
