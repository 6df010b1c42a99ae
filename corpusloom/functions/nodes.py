"""The nodes of one element's tree, read from its JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator


class _Number(str):
    """A number as it is written; not a text."""


def _name(kind) -> str | None:
    """A node's type as text, whatever it is."""
    if kind is None or isinstance(kind, str):
        return kind
    return json.dumps(kind, ensure_ascii=False, separators=(",", ":"))


def walk(text: str, inner: frozenset[str]) -> Iterator[tuple[list[int], str | None, str | None]]:
    """``(path below the element, type, own text)`` of the element and all nodes below it that have a type, in tree order.

    Only nodes of the types ``inner`` are entered. A word's text ends with a blank.
    """
    open_ = [([], json.loads(text, parse_int=_Number, parse_float=_Number).get("node"))]
    while open_:
        path, node = open_.pop()
        if not isinstance(node, dict):
            continue
        kind, content = _name(node.get("type")), node.get("content")
        if kind is None:
            continue
        own = None
        if type(content) is str and kind in ("word", "character"):
            own = f"{content} " if kind == "word" else content
        yield path, kind, own
        if type(content) is list and kind in inner:
            open_ += [([*path, i], content[i]) for i in range(len(content) - 1, -1, -1)]


def leaves(text: str, inner: frozenset[str]) -> str:
    """Leaf text of the element in tree order."""
    return "".join(own for _, _, own in walk(text, inner) if own)
