"""F1 of the fourth round: texts of a line difference are compressed and shuffled once."""

import random
from itertools import product

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpusloom.functions.lines as lines
from corpusloom.operators import versions
from corpusloom.operators.running import overlapping_ranges
from corpusloom.session import evened

SCHEMA = "doc_id string, ver long, text string"


def cut(text):
    return [] if text is None else text.split("\n")


def plain(log):
    """Pairs of neighbours in the order of a key's versions, every row of the one with every row of the other."""
    out = []
    for key in {k for k, v, _ in log if k is not None and v is not None}:
        of_key = sorted(v for k, v, _ in log if k == key and v is not None)
        for old, new in zip(of_key, of_key[1:]):
            texts = [[t for k, v, t in log if (k, v) == (key, x)] for x in (old, new)]
            for a, b in product(*texts):
                out += [(key, old, new, no, *row) for no, row in enumerate(lines.changes(cut(a), cut(b)), 1)]
    return sorted(out, key=repr)


def history(seed, keys, most, rows=300):
    rnd = random.Random(seed)
    texts = [None, "", "\n", *("\n".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(1, 12))) for _ in range(20))]
    return [(rnd.choice(keys), rnd.choice([None, *range(most)]), rnd.choice(texts)) for _ in range(rows)]


def test_texts_are_shuffled_once(spark, rows):
    log = [(f"k{i % 50}", i // 50, "\n".join(f"line {j}" for j in range(i % 7, 40))) for i in range(200)]
    found = versions.line_changes(spark.createDataFrame(log, SCHEMA).repartition(8))
    plan = found._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert "_packed" in plan[plan.index("Exchange hashpartitioning") :]  # before the shuffle
    assert rows(found) == plain(log)


@pytest.mark.parametrize("batch", ["2", "10000"])
def test_hot_keys_and_repeated_versions(spark, rows, batch):
    """One key has nearly all rows, versions repeat, keys and versions may be null; rows of a pair may lie in two batches."""
    log = history(3, ["hot"] * 20 + ["cold", None], 90)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert rows(versions.line_changes(spark.createDataFrame(log, SCHEMA).repartition(3))) == plain(log)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_neighbours_of_a_hot_key_meet_in_one_range(spark):
    log = spark.range(0, 3000).selectExpr("if(id % 10 = 0, 'cold', 'hot') doc_id", "id * 7 % 3001 ver")
    found = overlapping_ranges(log, ["doc_id"], "ver", "again").where("doc_id = 'hot'").collect()
    values = sorted(r["ver"] for r in found if not r["again"])
    ranges = {}
    for r in found:
        ranges.setdefault(r["_range"], set()).add(r["ver"])
    assert len(values) == 2700 and len(ranges) > 4
    assert all(any({a, b} <= of for of in ranges.values()) for a, b in zip(values, values[1:]))
    assert sum(r["again"] for r in found) == len(ranges) - 1


def test_chunks_and_batches_do_not_show(monkeypatch):
    log = sorted((r for r in history(5, ["k"], 40, 70) if r[1] is not None), key=lambda r: r[1])
    places = pa.array([0] * len(log), pa.int32())
    texts = pa.RecordBatch.from_pydict(
        {"doc_id": ["k"] * len(log), "ver": [r[1] for r in log], "_range": places, "_again": [False] * len(log), "text": [r[2] for r in log]}
    )
    every = sorted({r[1] for r in log})
    number = {"_row": range(1, len(log) + 1), "_version": [every.index(r[1]) + 1 for r in log]}
    expected = plain(log)
    for frame, size, out, batch in ((1 << 20, 1, 1, 1), (30, 50, 7, 13), (0, 1 << 20, 1 << 16, 1000)):
        monkeypatch.setattr(versions, "FRAME", frame)
        monkeypatch.setattr(versions, "CHUNK", size)
        monkeypatch.setattr(versions, "PER_BATCH", out)
        packed = [r for b in versions._packed(iter([texts.slice(0, 20), texts.slice(20)])) for r in b.to_pylist()]
        assert max(len(r["_held"]) for r in packed) == {0: 2, 30: 4, 1 << 20: 4}[frame]
        rows = pa.Table.from_pylist([{"doc_id": r["doc_id"], **h, "_raw": r["_raw"], "_packed": r["_packed"]} for r in packed for h in r["_held"]])
        for name, column in number.items():
            rows = rows.append_column(name, pa.array(column))
        found = list(versions._compared(iter(rows.to_batches(max_chunksize=batch))))
        assert max(b.num_rows for b in found) <= out
        assert sorted((tuple(r.values()) for b in found for r in b.to_pylist()), key=repr) == expected


def test_alike_versions_take_the_room_of_one():
    """A text of random lines and the same with a line less: what is sent is little more than one of them."""
    rnd = random.Random(1)
    text = "\n".join(f"{rnd.getrandbits(60):x}" for _ in range(2000))
    log = {"k": [1, 1, 2], "v": [1, 2, 1], "r": pa.array([0, 0, 0], pa.int32()), "a": [False] * 3, "text": [text, text.partition("\n")[2], None]}
    first, second = next(versions._packed(iter([pa.RecordBatch.from_pydict(log)]))).to_pylist()
    assert [h["v"] for h in first["_held"]] == [1, 2] and [h["_size"] for h in second["_held"]] == [None]
    assert len(first["_packed"]) < 0.7 * len(text) < 0.7 * first["_raw"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 30)), st.lists(st.integers(0, 30)))), st.sampled_from([0, 5]))
def test_arrays_keep_what_lists_keep(pairs, short):
    """Arrays of all pairs at once, against the lists of one pair after the other."""
    before, lines.SHORT = lines.SHORT, short
    try:
        numbers, bounds = lines._numbered(*(x for pair in pairs for x in pair))
        found = [[] for _ in pairs]
        for p, no, kind, i, j, at in zip(*(x.tolist() for x in lines.differences(numbers, bounds))):
            found[p].append((no, kind, i, j, at - bounds[2 * p + (kind == 2)]))
    finally:
        lines.SHORT = before
    for (old, new), got in zip(pairs, found):
        kept = sorted(lines._kept_of_short(old, new))
        expected, a, b = [], 0, 0
        for i, j in [*kept, (len(old), len(new))]:
            expected += [(1, n + 1, 0, n) for n in range(a, i)] + [(2, 0, n + 1, n) for n in range(b, j)]
            expected += [(0, i + 1, j + 1, i)] if i < len(old) else []
            a, b = i + 1, j + 1
        assert got == [(no, *row) for no, row in enumerate(expected, 1)]


def test_even_rows_stay_where_they_are(spark, tmp_path):
    spark.range(4000).repartition(8).write.parquet(f"{tmp_path}/even")
    spark.range(4000).coalesce(1).write.parquet(f"{tmp_path}/one")
    even, one = (evened(spark.read.parquet(f"{tmp_path}/{x}")) for x in ("even", "one"))
    assert "RoundRobinPartitioning" not in even._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning" in one._jdf.queryExecution().toString()
    assert even.count() == one.count() == 4000 and evened(one.limit(0)).isEmpty()
