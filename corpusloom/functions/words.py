"""Tokens and stop words."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let

# Names under which Spark ML ships its stop-word lists.
LANGUAGES = {
    "da": "danish",
    "de": "german",
    "en": "english",
    "es": "spanish",
    "fi": "finnish",
    "fr": "french",
    "hu": "hungarian",
    "it": "italian",
    "nl": "dutch",
    "no": "norwegian",
    "pt": "portuguese",
    "ru": "russian",
    "sv": "swedish",
    "tr": "turkish",
}
DEFAULT_LANGUAGE = "en"

#: Stands for a stop word or a run of punctuation in a token sequence. Line
#: breaks of the text are turned into blanks first, so no token can hold one.
BREAK = "\n"

WHITE_SPACE = "\t\n\x0b\f\r"


def stop_words(lang: str) -> list[str]:
    return StopWordsRemover.loadDefaultStopWords(LANGUAGES[lang])


def tokens(text: Column, lang: Column | None = None, languages=tuple(LANGUAGES)) -> Column:
    """Lower-cased words of a text with every stop word or punctuation run
    replaced by ``BREAK``.

    A language outside ``languages`` (or none) is read as English.
    """
    spaced = F.translate(F.lower(text), WHITE_SPACE, " " * len(WHITE_SPACE))
    raw = F.split(F.regexp_replace(spaced, r"[^\p{L}\p{N} ]+", f" {BREAK} "), " ")
    kept = F.filter(raw, lambda t: t != "")
    if lang is None:
        stops = stop_words(DEFAULT_LANGUAGE)
        return F.transform(kept, lambda t: F.when(t.isin(stops), F.lit(BREAK)).otherwise(t))
    codes = dict.fromkeys([DEFAULT_LANGUAGE, *languages])
    # One look-up for all languages: a hashed set of each code with each of its words.
    named = [f"{code} {word}" for code in codes for word in stop_words(code)]
    code = F.when(lang.isin(list(codes)), lang).otherwise(F.lit(DEFAULT_LANGUAGE))
    return let(
        F.concat(code, F.lit(" ")),
        lambda c: F.transform(kept, lambda t: F.when(F.concat(c, t).isin(named), F.lit(BREAK)).otherwise(t)),
    )


def phrases(toks: Column) -> Column:
    """Candidate phrases: the longest runs of kept words, in text order."""
    runs = F.split(F.array_join(toks, " "), BREAK)
    return F.filter(F.transform(runs, lambda r: F.trim(r)), lambda r: r != "")
