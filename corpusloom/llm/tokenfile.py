"""Token ids in seekable zstandard files.

A file is a stream of unsigned 32-bit little-endian ids in frames of ``FRAME`` ids, each
compressed by itself. Two skippable frames end it: a directory (documents and their
numbers of ids) and the seek table of the zstandard seekable format, with compressed size, size and
checksum (XXH64, low 32 bits) of every frame. Any zstandard reader can decompress the
file; ours reads the table and then only the frames that hold the documents asked for.

Documents are dealt to files by ranges of ``doc_id``, so files in order are the corpus in
order. A task writes under a name of its own and renames at the end; a task that runs
again writes the same file. Rows without a ``doc_id`` come first, repeated rows follow each other
in the order of their texts, a null text is empty, an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.base import texts
from corpusloom.llm.tokens import Encoder
from corpusloom.session import shared_folder

#: Ids of a frame.
FRAME = 1 << 16
# Fixed values of the zstandard seekable format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_DIRECTORY = 0x184D2A5D
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUM = 0x80

MANIFEST = "file_no int, file string, docs long, ids long, bytes long"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that Spark names by a URI."""
    if re.match(r"file:/+", uri):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)


def u32(*values: int) -> bytes:
    return np.array(values, "<u4").tobytes()


class Writer:
    def __init__(self, out):
        self.out, self.size = out, 0
        self.frames, self.docs, self.lengths = [], [], []
        self.open, self.n_open = [], 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _frame(self, ids: np.ndarray) -> None:
        raw = ids.astype("<u4").tobytes()
        data = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(raw)
        self._put(data)
        self.frames.append((len(data), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.open.append(ids)
        self.n_open += len(ids)
        if self.n_open >= FRAME:
            whole = np.concatenate(self.open)
            cut = len(whole) - len(whole) % FRAME
            for at in range(0, cut, FRAME):
                self._frame(whole[at : at + FRAME])
            self.open, self.n_open = [whole[cut:]], len(whole) - cut

    def close(self) -> None:
        if self.n_open:
            self._frame(np.concatenate(self.open))
        known = np.array([d is not None for d in self.docs], bool)
        ids = np.array([d or 0 for d in self.docs], "<i8")
        body = u32(len(ids)) + known.tobytes() + ids.tobytes() + np.array(self.lengths, "<i8").tobytes()
        body = zstandard.ZstdCompressor().compress(body)
        self._put(u32(SKIPPABLE_DIRECTORY, len(body) + 4) + body + u32(len(body)))
        table = u32(*(x for f in self.frames for x in f))
        table += u32(len(self.frames)) + bytes([HAS_CHECKSUM]) + u32(SEEKABLE_MAGIC)
        self._put(u32(SKIPPABLE_SEEK_TABLE, len(table)) + table)


class Reader:
    """Documents of one file; frames are read and decompressed when they are asked for."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        n, _, magic = np.frombuffer((tail := self._at(end - 9, 9))[:4] + tail[4:5] + bytes(3) + tail[5:], "<u4").tolist()
        if magic != SEEKABLE_MAGIC:
            raise ValueError("the file has no seek table")
        start = end - 9 - 12 * n
        self.table = np.frombuffer(self._at(start, 12 * n), "<u4").reshape(-1, 3).astype(np.int64)
        self.begin = np.cumsum(self.table[:, 0]) - self.table[:, 0]
        start -= 8  # the header of the seek table
        (body,) = np.frombuffer(self._at(start - 4, 4), "<u4").tolist()
        data = zstandard.ZstdDecompressor().decompress(self._at(start - 4 - body, body))
        (docs,) = np.frombuffer(data, "<u4", 1).tolist()
        self.known = np.frombuffer(data, bool, docs, 4)
        self.docs = np.frombuffer(data, "<i8", docs, 4 + docs)
        self.lengths = np.frombuffer(data, "<i8", docs, 4 + 9 * docs)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.held: tuple[int, np.ndarray] | None = None
        self.frames_read = 0

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def frame(self, number: int) -> np.ndarray:
        if self.held is None or self.held[0] != number:
            size, raw_size, check = self.table[number].tolist()
            raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.begin[number]), size), max_output_size=raw_size)
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {number} does not have its checksum")
            self.held = number, np.frombuffer(raw, "<u4")
            self.frames_read += 1
        return self.held[1]

    def ids(self, row: int) -> np.ndarray:
        at, end = int(self.starts[row]), int(self.starts[row] + self.lengths[row])
        if at == end:
            return np.zeros(0, "<u4")
        parts = [self.frame(n)[max(at - n * FRAME, 0) : end - n * FRAME] for n in range(at // FRAME, (end - 1) // FRAME + 1)]
        return np.concatenate(parts)

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``doc_id``, place in the file and ids of the documents asked for."""
        rows = range(len(self.docs)) if wanted is None else np.flatnonzero(self.known & np.isin(self.docs, list(wanted))).tolist()
        for row in rows:
            yield (int(self.docs[row]) if self.known[row] else None), int(self.starts[row]), self.ids(row)


def write_ids(docs: DataFrame, path: str, kind: str = "byte", folder: str | None = None) -> DataFrame:
    """Encode and write all documents, each with end id 0; the manifest has a row per file."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-ids")

    def run(batches):
        store, where = place(folder)
        number = TaskContext.get().partitionId()
        name, own = f"{where}/ids-{number:06d}.zst", f"{where}/.{uuid.uuid4().hex}"
        store.create_dir(where, recursive=True)
        with store.open_output_stream(own, compression=None) as out:
            writer = Writer(out)
            for batch in batches:
                encoded = Encoder.of(path, kind).encode(t.as_py() for t in batch.column(1))
                for doc, ids in zip(batch.column(0).to_pylist(), encoded):
                    writer.add(doc, np.r_[ids, np.uint32(0)])
            writer.close()
        if not writer.docs:
            store.delete_file(own)
            return
        store.move(own, name)
        row = [number], [name.rpartition("/")[2]], [len(writer.docs)], [sum(writer.lengths)], [writer.size]
        kinds = pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["file_no", "file", "docs", "ids", "bytes"])

    dealt = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").withColumn("folder", F.lit(folder))


def read_ids(manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, ids`` from the files: of all documents, or of a few by the seek tables.

    The manifest has one row per file; the ids before a file come from a running sum over it.
    """
    spark: SparkSession = manifest.sparkSession
    rows = sorted(manifest.collect(), key=lambda r: r["file_no"])
    before = np.cumsum([0, *(r["ids"] for r in rows)]).tolist()
    files = [(r["file_no"], f"{r['folder']}/{r['file']}", b) for r, b in zip(rows, before)]
    wanted = None if doc_ids is None else set(doc_ids)

    def run(batches):
        for batch in batches:
            for path, first in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                store, where = place(path)
                with store.open_input_file(where) as source:
                    docs, starts, ids, held = [], [], [], 0
                    for doc, start, found in Reader(source).documents(wanted):
                        docs.append(doc), starts.append(first + start), ids.append(found)
                        held += len(found)
                        if held > 1 << 20:
                            yield out(docs, starts, ids)
                            docs, starts, ids, held = [], [], [], 0
                    if docs:
                        yield out(docs, starts, ids)

    def out(docs, starts, ids):
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int64)
        flat = pa.array(np.concatenate(ids).astype(np.int64))
        lists = pa.LargeListArray.from_arrays(pa.array(ends), flat).cast(pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), lists], ["doc_id", "start", "ids"])

    named = spark.createDataFrame(files, "file_no int, path string, first long")
    spread = named.repartitionByRange(max(1, len(files)), "file_no")
    return spread.mapInArrow(run, "doc_id long, start long, ids array<long>")


def with_checksums(read: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of ids that were read."""

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
