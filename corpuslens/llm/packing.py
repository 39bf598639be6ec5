"""Cost-balanced packing of documents into fixed-length training sequences.

A document of ``n`` tokens costs ``n + n * n / sequence_tokens``: linear layers
plus attention inside the document.  Documents go, in descending length, to the
sequence of lowest cost that has room; what fits nowhere is cut over the
sequences with most room.

Each task packs what it reads, block by block, so no row is shuffled and memory
holds one block of ids.  A block's ``t`` tokens get ``t // sequence_tokens``
full sequences and, for the rest, sequences of falling powers of two, so every
sequence is filled exactly and nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.scratch import tidy
from corpuslens.llm.vocab import memo, shipped

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, cost double"


def cost(tokens: float, sequence_tokens: int) -> float:
    """Linear plus quadratic attention cost of one piece."""
    return tokens + tokens * tokens / sequence_tokens


def capacities(total: int, sequence_tokens: int) -> list[int]:
    """Lengths of sequences that ``total`` tokens fill exactly."""
    full, rest = divmod(total, sequence_tokens)
    return [sequence_tokens] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], sequence_tokens: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these lengths."""
    room = np.array(capacities(sum(lengths), sequence_tokens), dtype=np.int64)
    size, spent = room.copy(), np.zeros(len(room))
    pieces, rests, whole = [], [], 0
    for d, n in enumerate(lengths):
        start = 0
        while n - start >= sequence_tokens:  # a full sequence of its own
            pieces.append((d, start, sequence_tokens, whole, 0))
            room[whole], spent[whole] = 0, cost(sequence_tokens, sequence_tokens)
            whole, start = whole + 1, start + sequence_tokens
        if n > start:
            rests.append((n - start, d, start))
    rests.sort(key=lambda x: (-x[0], x[1]))
    for n, d, start in rests:
        while n:
            fits = np.flatnonzero(room >= n)
            s = int(fits[np.argmin(spent[fits])]) if len(fits) else int(np.argmax(room))
            take = min(n, int(room[s]))
            pieces.append((d, start, take, s, int(size[s] - room[s])))
            room[s] -= take
            spent[s] += cost(take, sequence_tokens)
            n, start = n - take, start + take
    return pieces


def pack(docs: DataFrame, tokenizer_path: str, *, sequence_tokens: int = 2048, end_id: int = 1, block_tokens: int = 2_000_000) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text; other columns are not read).

    Null and empty texts hold the end id alone.  Repeated rows are separate
    documents, an empty table gives no rows, a long text is cut.  Ties in length
    keep the order of reading.  ``sequence_id`` is unique, not dense.
    """

    vocabulary = shipped(docs.sparkSession, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = end_id.to_bytes(4, "little")
        next_id = TaskContext.get().partitionId() << 32
        ids: list[bytes] = []
        names: list[int | None] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, names, held, next_id
            lengths = [len(x) // 4 for x in ids]
            pieces = assign(lengths, sequence_tokens)
            sizes = capacities(sum(lengths), sequence_tokens)
            columns = list(zip(*pieces))
            d, start, length, seq, offset = columns
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in d], pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(ids[i][4 * a : 4 * (a + n)]) for i, a, n in zip(d, start, length)], pa.int64()),
                    pa.array([lengths[i] for i in d], pa.int64()),
                    pa.array([next_id + s for s in seq], pa.int64()),
                    pa.array(offset, pa.int64()),
                    pa.array([sizes[s] for s in seq], pa.int64()),
                    pa.array([cost(n, sequence_tokens) for n in length], pa.float64()),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )
            next_id += len(sizes)
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
                    if held >= block_tokens:
                        yield flush()
            if ids:
                yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), SCHEMA)
