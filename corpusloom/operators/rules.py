"""Labelled pattern matches (F9) and table clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import spread

# The rules of the default configuration.
DEFAULT_RULES = [
    ("Car", r"([A-Z]{2}\-[\d]{3}\-[A-Z]{2})"),
    ("Age", r"(\d+)[ -]*(ans|jarige)"),
    ("Percent", r"([\-]?(\d)+[\.\,]*(\d)*)[ ]*(%|per|percent|pourcent|procent)"),
]


def label_matches(
    docs: DataFrame, rules: list[tuple] | DataFrame = DEFAULT_RULES, key: str = "doc_id"
) -> DataFrame:
    """One row per match: ``(key, label, match_no, match)``.

    ``rules`` are rows ``(label, regex, case_sensitive, all_matches)``, as the reader of a
    configuration gives them, or tuples of these; each rule goes by flags of its own, and a
    missing flag is true. The rules are one value that every text is matched with, so
    a text is read once and no row is made for a rule that matches nothing.
    """
    if isinstance(rules, DataFrame):
        value = rules.agg(F.sort_array(F.collect_list(_rule(*(F.col(c) for c in RULE_COLUMNS))))).scalar()
    else:
        value = F.array(*[_rule(*(F.lit(v) for v in (*r, *(True, True)[len(r) - 2 :]))) for r in rules])

    def found(rule: Column) -> Column:
        hits = F.regexp_extract_all(F.col("text"), rule["pattern"], F.lit(0))
        kept = F.when(rule["all_matches"], hits).otherwise(F.slice(hits, 1, 1))
        return F.transform(
            kept, lambda m, i: F.struct(rule["label"].alias("label"), i.alias("match_no"), m.alias("match"))
        )

    ruled = spread(docs).select(key, "text", value.alias("_rules"))
    return ruled.select(key, F.inline(F.flatten(F.transform("_rules", found))))


RULE_COLUMNS = ("label", "regex", "case_sensitive", "all_matches")


def _rule(label: Column, regex: Column, case_sensitive: Column, all_matches: Column) -> Column:
    exact = F.coalesce(case_sensitive, F.lit(True))
    return F.struct(
        label.alias("label"),
        F.when(exact, regex).otherwise(F.concat(F.lit("(?i)"), regex)).alias("pattern"),
        F.coalesce(all_matches, F.lit(True)).alias("all_matches"),
    )


def clean_table(table: DataFrame) -> DataFrame:
    """Drop columns named ``Unnamed...``; empty cells become one blank.

    Only a string column can hold a blank, so every column that may be empty is cast.
    """
    kept = [f for f in table.schema.fields if not f.name.startswith("Unnamed")]
    return table.select(
        *[
            F.coalesce(F.col(f"`{f.name}`").cast(T.StringType()), F.lit(" ")).alias(f.name)
            if f.nullable
            else F.col(f"`{f.name}`")
            for f in kept
        ]
    )
