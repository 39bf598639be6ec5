"""Token files with directly addressable codes.

A segment splits its ids into chunks of ``bits`` bits, lowest first.  Level 0
holds the lowest chunk of every id; its continuation bitmap says which ids go on
in level 1, and so on.  A rank directory counts the set bits before every block
of 512, so one id is found with a bit test and a short popcount per level, and
no block is decoded.

A token file is a folder of Parquet files whose rows are such segments in order:
``part`` and ``segment`` number them, ``first`` counts the part's ids before the
segment, ``doc_ids`` and ``doc_tokens`` name its documents.  Spark's writer puts
it in any store and makes retried tasks harmless.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.scratch import partitions
from corpuslens.llm.vocab import memo, shipped

BLOCK = 512
HEAD = struct.Struct("<4sQBB")
LEVEL = struct.Struct("<QQQQ")
SEGMENT_SCHEMA = "part int, segment int, first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, codes binary"


def encode_codes(ids: np.ndarray, bits: int = 8) -> bytes:
    """Bytes of one segment. ``bits`` is 4, 8 or 16; chunks are stored one a byte, or two for 16."""
    kind = np.uint8 if bits <= 8 else np.dtype("<u2")
    left, levels = ids.astype("<u4"), []
    while True:
        more = left >> np.uint32(bits) if bits < 32 else np.zeros_like(left)
        flags = more != 0
        chunk = (left & np.uint32((1 << bits) - 1)).astype(kind).tobytes()
        bitmap = np.packbits(flags, bitorder="little")
        counts = np.bitwise_count(bitmap)
        padded = np.zeros(-(-max(len(counts), 1) // (BLOCK // 8)) * (BLOCK // 8), dtype=np.uint64)
        padded[: len(counts)] = counts
        blocks = padded.reshape(-1, BLOCK // 8).sum(axis=1)
        ranks = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype("<u8").tobytes()
        levels.append((len(left), chunk, bitmap.tobytes(), ranks))
        left = more[flags]
        if not len(left):
            break
    out = [HEAD.pack(b"DAC1", len(ids), bits, len(levels))]
    for n, chunk, bitmap, ranks in levels:
        out += [LEVEL.pack(n, len(chunk), len(bitmap), len(ranks)), chunk, bitmap, ranks]
    return b"".join(out)


class Codes:
    """A segment that is read in place."""

    def __init__(self, raw: bytes):
        magic, self.size, self.bits, n = HEAD.unpack_from(raw)
        if magic != b"DAC1":
            raise ValueError("not a segment of directly addressable codes")
        at, self.levels = HEAD.size, []
        for _ in range(n):
            count, *sizes = LEVEL.unpack_from(raw, at)
            at += LEVEL.size
            arrays = []
            for length, kind in zip(sizes, (np.uint8 if self.bits <= 8 else "<u2", np.uint8, "<u8")):
                arrays.append(np.frombuffer(raw, kind, length // np.dtype(kind).itemsize, at))
                at += length
            self.levels.append((count, *arrays))

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> int:
        """Id ``i``, by one rank query a level."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for k, (_, chunk, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunk[i]) << (k * self.bits)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            between = bitmap[block * (BLOCK // 8) : i >> 3]
            i = int(ranks[block]) + int(np.bitwise_count(between).sum(dtype=np.int64)) + int(bitmap[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
        return value

    def decode(self) -> np.ndarray:
        """All ids."""
        values, at = np.zeros(self.size, dtype="<u4"), None
        for k, (count, chunk, bitmap, _) in enumerate(self.levels):
            part = chunk.astype("<u4") << np.uint32(k * self.bits)
            if at is None:
                values[:] = part
            else:
                values[at] |= part
            flags = np.unpackbits(bitmap, count=count, bitorder="little").view(bool)
            at = np.flatnonzero(flags) if at is None else at[flags]
        return values


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int = 2, bits: int = 8, segment_tokens: int = 1_000_000) -> None:
    """Write the ids of all rows of ``docs`` (doc_id, text) to ``path`` in ascending doc_id order.

    Null and empty texts hold the end id alone; rows with one doc_id stay next
    to each other; a null doc_id comes first; an empty table gives no segments.
    A segment ends with the document that brings it to ``segment_tokens``.
    """

    vocabulary = shipped(docs.sparkSession, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = end_id.to_bytes(4, "little")
        part, segment, first = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        names: list[int | None] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, names, held, segment, first
            codes = encode_codes(np.frombuffer(b"".join(ids), "<u4"), bits)
            values = [part, segment, first, held, names, [len(x) // 4 for x in ids], codes]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in SEGMENT_SCHEMA.split(", ")])
            segment, first = segment + 1, first + held
            ids, names, held = [], [], 0
            return out

        with memo(vocabulary.value) as encoder:
            for batch in batches:
                doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
                for a in range(0, len(doc_ids), 500):
                    for i, found in zip(doc_ids[a : a + 500], encoder.encode(texts.slice(a, 500).to_pylist())):
                        ids.append(found + end)
                        names.append(i)
                        held += len(found) // 4 + 1
                    if held >= segment_tokens:
                        yield flush()
            if ids:
                yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n = partitions(docs.sparkSession)
    ordered = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part: one row a part, so one task may sum them up."""
    totals = _segments(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row a document: doc_id, start, n_tokens, ids_crc32, read from the file's codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = Codes(row["codes"]).decode().tobytes()
                sizes = np.array(row["doc_tokens"], dtype=np.int64)
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(sizes), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["first"] + ends - sizes, pa.int64()), pa.array(sizes), pa.array(crcs, pa.int64())],
                    names=["part", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    docs = _segments(spark, path).select("part", "first", "doc_ids", "doc_tokens", "codes")
    docs = docs.mapInArrow(run, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(part_starts(spark, path), "part").select("doc_id", (F.col("at") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def token_at(spark: SparkSession, path: str, positions: DataFrame, *, together: int = 10_000) -> DataFrame:
    """``position, id`` at global ``positions`` (column ``position``) without decoding segments.

    Positions outside the file, and null ones, have no row; repeated ones have
    one each.  Positions meet the directory of segments by cells of 2**20 ids;
    then at most about ``together`` of a segment's positions travel with its codes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["codes"])
                found = [codes[w] for w in row["within"]]
                yield pa.RecordBatch.from_arrays([pa.array([row["start"] + w for w in row["within"]], pa.int64()), pa.array(found, pa.int64())], names=["position", "id"])

    segments = _segments(spark, path)
    directory = segments.select("part", "segment", "first", "n_tokens").join(part_starts(spark, path), "part")
    directory = directory.select("part", "segment", (F.col("part_start") + F.col("first")).alias("start"), "n_tokens").filter("n_tokens > 0")
    cells = directory.withColumn("cell", F.explode(F.sequence(F.shiftright("start", 20), F.shiftright(F.col("start") + F.col("n_tokens") - 1, 20))))
    positions = positions.select(F.col("position").cast("long").alias("position"))
    asked = positions.distinct().withColumn("cell", F.shiftright("position", 20))
    hit = asked.join(cells, "cell").filter((F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens"))).select("part", "segment", "start", (F.col("position") - F.col("start")).alias("within"))
    slices = hit.groupBy("part", "segment").agg(F.ceil(F.count("*") / together).alias("slices"))
    grouped = hit.join(slices, ["part", "segment"]).groupBy("part", "segment", "start", F.pmod(F.xxhash64("within"), F.col("slices")).alias("slice")).agg(F.collect_list("within").alias("within"))
    found = grouped.join(segments.select("part", "segment", "codes"), ["part", "segment"]).select("start", "within", "codes").mapInArrow(run, "position long, id long")
    return positions.join(found, "position")
