"""Lines and paragraphs of a text that is held in one cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Python's str.strip removes; none lies above U+3000.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def code_point(number: Column) -> Column:
    """The character of a code point; U+FFFD where there is none."""
    known = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))


def dehyphenate(text: Column) -> Column:
    """Trim, delete every hyphen that a blank follows, end with a line break."""
    return F.concat(F.replace(strip(text), F.lit("- "), F.lit("")), F.lit("\n"))


def paragraphs(lines: Column, keep_tail: bool = False) -> Column:
    """Paragraphs of an array of lines.

    An empty line closes a paragraph and belongs to it. What follows the last
    empty line is lost unless ``keep_tail``. No line can hold a line break, so
    one marks the ends while the lines are joined.
    """
    stripped = F.transform(lines, strip)
    marked = F.transform(stripped, lambda x: F.when(x == "", F.lit("\n")).otherwise(x))
    parts = F.split(F.array_join(marked, " "), "\n", -1)
    if keep_tail:
        size = F.size(parts) - F.when(strip(F.element_at(parts, -1)) == "", 1).otherwise(0)
    else:
        size = F.size(parts) - 1
    return F.transform(F.slice(parts, F.lit(1), size), dehyphenate)


def document_text(lines: Column, keep_tail: bool = False) -> Column:
    return F.array_join(paragraphs(lines, keep_tail), "\n")
