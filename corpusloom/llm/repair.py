"""Conversation structure repair: the cheapest edits, found by a Viterbi search with survivor coalescence.

A repaired conversation has the role initials ``(s?(ua)+)?``. Each row is kept (0), given the
role user or assistant (1) or deleted (2); a row with empty text may be inserted anywhere (5).
Blank and duplicate rows have to be deleted, a truncated row that stays adds 5. Of the cheapest
lists of edits the one whose initials (K, R, D, I) come first as a string is taken.

The search has one survivor per state: nothing yet, after ``s``, after ``u``, after ``a``.
Survivors are leaves of a tree of edits, each node pointing back to the edit before it and
counting what refers to it. A node that nothing refers to is taken away; when all survivors share
an ancestor, the edits up to it are final, are given out and are forgotten. So the tree holds
only what is unresolved, however long a conversation is. Of two paths
of one cost into a state their whole strings decide, which differ only after the last
common ancestor: exactly the unresolved part. Equal costs never leave one string as the
beginning of the other, as the string gives the cost. The survivors of the first two states are dropped
once the last state is so much cheaper that it can follow any of their continuations and still win.

Rows of a conversation come by ``turn``, nulls first, rows of one turn by role and then by the MD5
of role and text. They are sorted by Spark and streamed through the task that has their conversation;
nothing of a conversation is gathered. Whether a row's role and text came before is worked out beforehand, by
an aggregation that a hot conversation spreads over many tasks: it marks the first row of each.

A null role or text is one space. A null ``conv_id`` is a conversation of its own, a
null ``turn`` comes first. Repeated rows are duplicates and deleted. Roles are judged by
their first letter. A conversation of which nothing stays gives only deletions, an
empty table gives no rows. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the contract.
BLANK = " \t\n\x0b\x0c\r"
SOUND, EMPTY, TORN = 0, 1, 2
FAULTS = ("", "blank", "truncated", "duplicate")
START, SYSTEM, USER, ASSISTANT = range(4)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Where a row with this initial leads from a state, and where a row of a free role leads.
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
FREE = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
FIELDS = "conv_id long, at long, edit string, fault string, cost int, turn long, had_role string, role string, text string"


class Node:
    """An edit, the one before it, and how many survivors and later edits refer to it."""

    __slots__ = ("parent", "edit", "row", "role", "fault", "cost", "refs", "depth", "children")

    def __init__(self, parent, edit, row=None, role=None, fault=0, cost=0):
        self.parent, self.edit, self.row, self.role, self.fault, self.cost = parent, edit, row, role, fault, cost
        self.refs, self.children = 0, set()
        self.depth = parent.depth + 1 if parent else 0


class Search:
    """One conversation; ``add`` takes its rows in order and gives the edits that are final by then."""

    def __init__(self):
        self.root = Node(None, "")
        self.root.refs = 1
        self.best = {START: (0, self.root)}

    def add(self, row: tuple, initial: str, fault: int) -> list[Node]:
        self._insert()
        found: dict[int, tuple[int, Node]] = {}
        extra = UNFINISHED if fault == TORN else 0
        for state, (cost, node) in self.best.items():
            self._offer(found, state, cost + DELETE, Node(node, "D", row, None, fault, DELETE))
            if fault in (SOUND, TORN):
                if (state, initial) in KEEP:
                    self._offer(found, KEEP[state, initial], cost + extra, Node(node, "K", row, row[2], fault, extra))
                role = FREE[state]
                self._offer(found, role, cost + REROLE + extra, Node(node, "R", row, ROLE[role], fault, REROLE + extra))
        if ASSISTANT in found:
            bar = found[ASSISTANT][0]
            for state, slack in ((START, DELETE), (SYSTEM, 0)):
                if state in found and found[state][0] > bar + slack:
                    del found[state]
        self._replace(found)
        return self._final()

    def end(self) -> list[Node]:
        """The edits that were still open."""
        self._insert()
        state = min((s for s in (START, ASSISTANT) if s in self.best), key=lambda s: (self.best[s][0], self._string(s)))
        self._replace({state: self.best[state]})
        return self._final()

    def _string(self, state: int) -> str:
        edits, node = [], self.best[state][1]
        while node is not self.root:
            edits.append(node.edit)
            node = node.parent
        return "".join(reversed(edits))

    def _offer(self, found: dict, state: int, cost: int, node: Node) -> None:
        old = found.get(state)
        if old is None or cost < old[0] or (cost == old[0] and before(node, old[1])):
            found[state] = (cost, node)

    def _insert(self) -> None:
        """Rows that could be inserted here: at most one of each role pays."""
        found = dict(self.best)
        for state, new in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if state in found:
                cost, node = found[state]
                self._offer(found, new, cost + INSERT, Node(node, "I", None, ROLE[new], 0, INSERT))
        self._replace(found)

    def _replace(self, found: dict) -> None:
        for _, node in found.values():
            node.refs += 1
            while node.parent is not None and node not in node.parent.children:
                node.parent.children.add(node)
                node.parent.refs += 1
                node = node.parent
        for _, node in self.best.values():
            node.refs -= 1
            while not node.refs and node.parent is not None:
                node.parent.children.discard(node)
                node.parent.refs -= 1
                node = node.parent
        self.best = found

    def _final(self) -> list[Node]:
        """Edits that all survivors share, from the root on."""
        out = []
        while self.root.refs == 1 and self.root.children:
            self.root = self.root.children.pop()
            self.root.parent = None
            out.append(self.root)
        return out


def before(one: Node, other: Node) -> bool:
    """Whether the edits up to ``one`` come first as a string; only the part after the common ancestor is read."""
    x, y = [], []
    while one is not other:
        if one.depth >= other.depth:
            x.append(one.edit)
            one = one.parent
        else:
            y.append(other.edit)
            other = other.parent
    return x[::-1] < y[::-1]


def digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def ordered(rows: DataFrame) -> DataFrame:
    """All rows with their faults, sorted within the task of their conversation.

    The row of kind 1 that follows a row of kind 0 with its place and digest is the first with its role and text.
    """
    full = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("digest", digest(F.col("role"), F.col("text")))
    end = F.rtrim("text", F.lit(BLANK))
    fault = F.when(end == "", EMPTY).when(F.right(end, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TORN)
    early = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    firsts = full.groupBy("conv_id", "role", "digest").agg(early)
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", "kind"]
    both = full.select("conv_id", "turn", "role", "digest", F.lit(1).alias("kind"), "text", fault.alias("fault")).union(
        firsts.select("conv_id", F.col("first.turn"), "role", "digest", F.lit(0), F.lit(None).cast("string"), F.lit(0))
    )
    return both.repartition("conv_id").sortWithinPartitions(*order)


def edits(rows: DataFrame) -> DataFrame:
    """``conv_id, at, edit, fault, cost, turn, had_role, role, text``: every edit of every conversation.

    ``at`` counts a conversation's edits from 0. ``turn`` and ``had_role`` are those of the row that
    is edited (null for an insertion), ``role`` and ``text`` those of the row that stays (null for a deletion).
    """

    def run(batches):
        search = conv = None
        at, mark = 0, None
        names = [f.split()[0] for f in FIELDS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()]

        def rows_of(nodes):
            nonlocal at
            for n in nodes:
                turn, text, had = n.row[:3] if n.row else (None, "", None)
                yield conv, at, n.edit, FAULTS[n.fault], n.cost, turn, had, n.role, None if n.edit == "D" else text
                at += 1

        def packed(out):
            columns = zip(*out) if out else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            out = []
            for c, turn, role, key, kind, text, fault in zip(*(x.to_pylist() for x in batch.columns)):
                if search is None or c != conv:
                    if search is not None:
                        out += rows_of(search.end())
                    search, conv, at, mark = Search(), c, 0, None
                if kind == 0:
                    mark = (turn, role, key)
                    continue
                if fault != EMPTY and mark != (turn, role, key):
                    fault = 3
                mark = None
                out += rows_of(search.add((turn, text, role), role[:1], fault))
            yield packed(out)
        if search is not None:
            yield packed(list(rows_of(search.end())))

    return ordered(rows).mapInArrow(run, FIELDS)


def summary(found: DataFrame) -> DataFrame:
    """One row per conversation from its edits: gaps, faults, illegal neighbours, cost, audit and the repaired rows' digest."""
    one = F.sort_array(F.collect_list(F.struct("at", "edit", "turn", "had_role", "role", "text")))
    count = lambda name: F.count_if(F.col("fault") == name).alias(name)
    by = found.groupBy("conv_id").agg(one.alias("e"), count("blank"), count("duplicate"), count("truncated"), F.sum("cost").cast("long").alias("cost"))
    turns = F.array_distinct(F.filter(F.transform("e", lambda x: x["turn"]), lambda t: t.isNotNull()))
    initials = F.transform(F.filter("e", lambda x: x["edit"] != "I"), lambda x: F.left(x["had_role"], F.lit(1)))
    by = by.select("*", turns.alias("turns"), initials.alias("initials"))
    gaps = F.coalesce(F.array_max("turns") - F.array_min("turns") + 1 - F.size("turns"), F.lit(0)).cast("long")
    pairs = F.zip_with(F.slice("initials", F.lit(1), F.greatest(F.size("initials") - 1, F.lit(0))), F.slice("initials", 2, 1 << 30), lambda a, b: F.concat(a, b))
    illegal = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long")
    kept = F.transform(F.filter("e", lambda x: x["edit"] != "D"), lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    return by.select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", illegal.alias("illegal"), "cost",
        F.array_join(F.transform("e", lambda x: x["edit"]), "").alias("audit"),
        F.sha2(F.array_join(kept, "\n"), 256).alias("repaired_sha256"),
    )
