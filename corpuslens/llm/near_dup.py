"""Near-duplicate components by MinHash with tensored banding.

Two small collections of band hashes are made for a set; a table key combines
one band of each, so ``a * b`` tables cost only ``a + b`` bands of minhashes.
Candidates are confirmed on the whole shingle sets.

1. Documents with equal sets form a class; only classes go on, so copies cost a
   row each and no pairs.
2. Every class meets the leader of its table buckets: one pair a class, with the
   leader of which it shares most tables.  Confirmed pairs give components.
   Leaders in other orders then join most of what is still apart.
3. Buckets that still hold several components give the pairs between different
   components, which are confirmed and joined.  Pairs inside a component cannot
   change it and are never made, so a large group of near copies costs a star
   and not its square, and yet no link between components is lost.

Components spread by alternating large-star and small-star steps over stored
tables, until the links are few enough for the driver (``FEW_LINKS``); nothing
but those and counts reaches it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from corpuslens.llm.scratch import by_bytes, remove, stored, stored_at, tidy

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MULTIPLY = _RANDOM.integers(1, 2**63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RANDOM.integers(1, 2**63, 512, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_CHUNK = 1 << 20  # bytes whose polynomials are summed at once
_POWERS: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers() -> list[np.ndarray]:
    """``_CHUNK`` powers of the polynomial's base and of its inverse modulo 2**64."""
    if not _POWERS:
        for base in (_BASE, _UNBASE):
            steps = np.full(_CHUNK, base)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps))
    return _POWERS


def _polynomials(b: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of each word, from ``first`` to ``end``: the sum of its bytes' numbers times the base's powers from 0 on.

    Words are taken in stretches of at most ``_CHUNK`` bytes, a longer word in
    parts, so the working arrays have a fixed size.
    """
    (up, down), out, at = _powers(), np.zeros(len(first), dtype=np.uint64), 0
    while at < len(first):
        a = int(first[at])
        z = int(np.searchsorted(end, a + _CHUNK, side="right"))
        if z == at:  # one word of more than a stretch
            total = 0
            for p in range(a, int(end[at]), _CHUNK):
                part = b[p : min(p + _CHUNK, int(end[at]))]
                total += int((_BYTE[part] * up[: len(part)]).sum(dtype=np.uint64)) * pow(int(_BASE), p - a, 2**64)
            out[at] = total % 2**64
            at += 1
            continue
        part = b[a : int(end[z - 1])]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        out[at:z] = (sums[end[at:z] - a] - sums[first[at:z] - a]) * down[first[at:z] - a]
        at = z
    return out


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    Words are runs of other bytes than blank and 0x09 to 0x0D, A-Z lower-cased;
    a text of fewer than ``width`` words is one shingle, one without words none.
    """
    raw = [b" " if t is None else t.encode("utf-8", "surrogatepass") + b" " for t in texts]
    starts = np.cumsum([0, *(len(r) for r in raw)])
    b = _LOWER[np.frombuffer(b" " + b"".join(raw), np.uint8)]
    blank = _BLANK[b]
    first, end = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    words = _mix(_polynomials(b, first, end) + (end - first).astype(np.uint64))
    cuts = np.searchsorted(first, starts + 1)
    joined = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for k in range(width):
        joined = _mix(joined + words[k : k + len(joined)] * _MULTIPLY[k])
    out = []
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if z - a >= width:
            out.append(np.unique(joined[a : z - width + 1]))
        elif z > a:
            short = np.full(1, z - a, dtype=np.uint64)
            for k in range(a, z):
                short = _mix(short * np.uint64(3) + words[k : k + 1])
            out.append(short)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def band_counts(similarity: float, widths: tuple[int, int], miss: float = 1e-4) -> tuple[int, int]:
    """Bands of each collection so that a pair at ``similarity`` shares no table with a probability of ``miss`` at most."""
    return tuple(math.ceil(math.log(miss / 2) / math.log(1 - similarity**w)) for w in widths)


def _bands(u: np.ndarray, counts: tuple[int, int], widths: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """Upper halves of the minhashes, and the bands of both collections."""
    n = counts[0] * widths[0] + counts[1] * widths[1]
    least = np.full(n, np.uint64(2**64 - 1))
    for a in range(0, len(u), 4096):
        part = u[a : a + 4096, None]
        least = np.minimum(least, ((part ^ _FLIP[:n]) * _MULTIPLY[:n]).min(axis=0))
    out, at = [(least >> np.uint64(32)).astype(np.uint32).view(np.int32)], 0
    for c, w in zip(counts, widths):
        key = np.zeros(c, dtype=np.uint64)
        for k in range(w):
            key = _mix(key * np.uint64(31) + least[at + k : at + c * w : w])
        out.append(key.view(np.int64))
        at += c * w
    return tuple(out)


PARITY_WORDS = 16


def parities(u: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set: each shingle flips one of ``64 * PARITY_WORDS`` bits.

    Bitmaps of two sets differ in no more bits than the sets in shingles.
    """
    bits = np.bincount((u & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


BASE_SCHEMA = "doc_id long, version long, n_shingles long, h1 long, h2 long, sketch array<int>, bits array<long>, a array<long>, b array<long>"


def _summaries(docs: DataFrame, width: int, counts: tuple[int, int], widths: tuple[int, int]) -> DataFrame:
    """Set size, 128-bit set hash, parity bitmap and bands of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, 1):
                sets = shingle_sets(part.column(1).to_pylist(), width)
                with np.errstate(over="ignore"):
                    h1 = [int(_mix(u).sum(dtype=np.uint64).view(np.int64)) for u in sets]
                    h2 = [int(_mix(u ^ _FLIP[511]).sum(dtype=np.uint64).view(np.int64)) for u in sets]
                bands = [_bands(u, counts, widths) if len(u) else (None, None, None) for u in sets]
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(u) for u in sets], pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array([x[0] for x in bands], pa.list_(pa.int32())), pa.array([parities(u) for u in sets], kind), pa.array([x[1] for x in bands], kind), pa.array([x[2] for x in bands], kind)],
                    names=["doc_id", "version", "n_shingles", "h1", "h2", "sketch", "bits", "a", "b"],
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("version")).mapInArrow(tidy(run), BASE_SCHEMA)


def _sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """``cid, shingles`` (binary) of the classes, from the text of a document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, 1):
                sets = shingle_sets(part.column(1).to_pylist(), width)
                h1 = [int(_mix(u).sum(dtype=np.uint64).view(np.int64)) for u in sets]
                # Another row of the same doc_id may hold another text.
                same = [i for i, (x, y) in enumerate(zip(h1, part.column(2).to_pylist())) if x == y]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(same, pa.int32())), pa.array([sets[i].tobytes() for i in same], pa.binary())], names=["cid", "shingles"])

    rows = docs.join(classes.select("cid", F.col("lead_doc").alias("doc_id"), "h1"), "doc_id").select("cid", "text", "h1")
    return rows.mapInArrow(tidy(run), "cid long, shingles binary").dropDuplicates(["cid"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) whose sets' intersection is at least ``percent`` of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (p, q) in enumerate(zip(batch.column(2), batch.column(3))):
                u, v = (np.frombuffer(s.as_buffer(), np.uint64) for s in (p, q))
                both = len(np.intersect1d(u, v, assume_unique=True))
                if 100 * both >= percent * (len(u) + len(v) - both):
                    keep.append(i)
            at = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["x", "y"])

    left = sets.select(F.col("cid").alias("x"), F.col("shingles").alias("p"))
    right = sets.select(F.col("cid").alias("y"), F.col("shingles").alias("q"))
    return pairs.join(left, "x").join(right, "y").select("x", "y", "p", "q").mapInArrow(tidy(run), "x long, y long")


#: Links that the driver joins by itself: about 2 MB, whatever the input's size.
FEW_LINKS = 100_000


def components(edges: DataFrame, *, few: int = FEW_LINKS) -> DataFrame:
    """``node, root`` of every node of ``edges`` (x, y); the root is a component's smallest node.

    Up to ``few`` edges are joined on the driver, where rounds of tiny tasks would
    take most of the time; more than that spread in rounds until they are few or
    nothing changes.
    """

    def counted(df: DataFrame) -> tuple[DataFrame, str, dict]:
        # Sums that stay the same mean that no edge changed.
        seen = Observation()
        new = df.filter("x <> y").distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("sum"))
        return *stored_at(new, "edges"), seen.get

    edges, path, now = counted(edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")))
    before = None
    while now["n"] > few and now != before:
        # Large star: neighbours above a node move to its smallest neighbour.
        both = edges.union(edges.select("y", "x"))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.join(low, "x").filter(F.col("y") > F.col("x")).select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        # Small star: neighbours below a node, and the node, move to the smallest of them.
        down = large.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).filter("x <> y")
        low = down.groupBy("x").agg(F.min("y").alias("m"))
        small = down.join(low, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).union(low.select("x", F.col("m").alias("y")))
        before = now
        edges, new_path, now = counted(small)
        remove(edges.sparkSession, path)
        path = new_path
    if now["n"] <= few:
        return _joined(edges)
    return edges.select(F.col("x").alias("node"), F.col("y").alias("root")).union(edges.select("y", "y").distinct())


def _joined(edges: DataFrame) -> DataFrame:
    """``components`` of few edges, by union-find on the driver."""
    above: dict[int, int] = {}

    def top(n: int) -> int:
        while (up := above.setdefault(n, n)) != n:
            above[n] = n = above[up]
        return n

    for x, y in zip(*(c.to_pylist() for c in edges.toArrow().columns)):
        p, q = top(x), top(y)
        above[max(p, q)] = min(p, q)
    nodes = sorted(above)
    if not nodes:
        return edges.select(F.col("x").alias("node"), F.col("y").alias("root"))
    found = pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array([top(n) for n in nodes], pa.int64())})
    return stored(edges.sparkSession.createDataFrame(found), "roots")


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, widths: tuple[int, int] = (2, 3), miss: float = 1e-4, orders: int = 3) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, version`` for each row of ``docs`` (doc_id, text).

    ``version`` is the text's xxhash64, which tells rows of one doc_id apart.

    Documents are linked where 100 * intersection >= percent * union of their
    shingle sets; ``component_id`` is the smallest doc_id reachable.  Texts
    without words, and null ones, have an empty set and are linked with nothing,
    not even each other.  Rows with a null doc_id are never linked: component
    null, kept true.  Repeated rows are all returned; extra columns are ignored.
    A pair just at the threshold is missed as a candidate with a probability of
    twice ``miss`` at most (no common table, or sketches that disagree by
    chance), one above it with less.  ``orders`` counts the further leaders
    that are tried before buckets of several components are compared in full.
    """
    counts = band_counts(percent / 100, widths, miss)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = stored(_summaries(docs, width, counts, widths), "summaries")

    grouped = base.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2")
    classes = grouped.agg(F.min("doc_id").alias("lead_doc"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("bits").alias("bits"), F.first("a").alias("a"), F.first("b").alias("b"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    def positions(name: str, n: int):
        return F.array(*[F.struct(F.lit(i).alias("i"), F.get(name, i).alias("band")) for i in range(n)])

    crossed = F.flatten(F.transform(positions("a", counts[0]), lambda p: F.transform(positions("b", counts[1]), lambda q: F.xxhash64(p["i"], q["i"], p["band"], q["band"]))))
    keys = classes.select("cid", F.posexplode(crossed).alias("table", "key"))
    bucket = Window.partitionBy("key")
    met = keys.select("cid", "table", "key", F.min("cid").over(bucket).alias("lead"), F.max("cid").over(bucket).alias("last")).filter(F.col("lead") < F.col("last"))
    met = stored(met.select("cid", "table", "key", "lead"), "buckets")

    shared = met.filter(F.col("cid") > F.col("lead")).groupBy("cid", "lead").agg(F.count("*").alias("tables"))
    star = shared.groupBy("cid").agg(F.max_by("lead", F.struct("tables", -F.col("lead"))).alias("y")).select(F.col("cid").alias("x"), "y")
    needed = least_agreement(percent / 100, counts[0] * widths[0] + counts[1] * widths[1], miss)
    shapes = classes.select("cid", "n", "bits", "sketch")
    wanted = met.select("cid").distinct()
    sets = stored(_sets(docs, classes.join(wanted, "cid", "left_semi"), width), "sets")
    links = stored(_confirmed(_likely(star, shapes, percent, needed), sets, percent), "links")
    roots = components(links)

    def joined(more: DataFrame) -> tuple[DataFrame, int]:
        """Roots with these links too, which meet stars rather than all earlier links; and their number."""
        seen = Observation()
        more = stored(more.observe(seen, F.count(F.lit(1)).alias("n")), "links")
        return (components(roots.toDF("x", "y").union(more)) if seen.get["n"] else roots), seen.get["n"]

    def rooted(ids: DataFrame) -> DataFrame:
        return ids.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))

    # Other leaders, in orders of their own, join most of a group; what is left is compared below.
    for salt in range(1, orders + 1):
        leader = F.min(F.struct(F.xxhash64("cid", F.lit(salt)).alias("h"), "cid", "root")).over(bucket)
        apart = rooted(met.select("cid", "key")).withColumn("leader", leader).filter("leader.root <> root")
        apart = apart.groupBy("cid", F.col("leader.cid").alias("y")).agg(F.count("*").alias("tables"))
        nearest = Window.partitionBy("cid").orderBy(F.desc("tables"), "y")
        near = apart.withColumn("place", F.row_number().over(nearest)).filter("place <= 3").select(F.col("cid").alias("x"), "y")
        roots, n = joined(_confirmed(_likely(near, shapes, percent, needed), sets, percent))
        if not n:
            break

    placed = rooted(met.select("cid", "table", "key"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
    bands = classes.select("cid", "n", "bits", "sketch", "a", "b")
    open_ = stored(placed.join(mixed, "key").join(bands, "cid"), "open")
    one, two = (open_.select("key", *[F.col(k).alias(f"{k}_{c}") for k in ("cid", "root", "table", "n", "bits", "sketch", "a", "b")]) for c in "xy")
    meet = (one["key"] == two["key"]) & (F.col("root_x") < F.col("root_y")) & (F.col("table_x") == F.col("table_y"))
    across = one.join(two, meet & _alike(percent, needed) & _first_met(counts[1])).select(F.col("cid_x").alias("x"), F.col("cid_y").alias("y"))
    roots, _ = joined(_confirmed(across, sets, percent))

    of_class = classes.select("cid", "h1", "h2", "lead_doc").join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    first_doc = of_class.groupBy("root").agg(F.min("lead_doc").alias("component"))
    named = of_class.join(first_doc, "root").select("h1", "h2", "component")
    out = base.select("doc_id", "version", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "version")


def least_agreement(similarity: float, n: int, miss: float) -> int:
    """Most minhashes of ``n`` that a pair at ``similarity`` agrees in but for a probability of ``miss``."""
    below = 0.0
    for k in range(n + 1):
        below += math.comb(n, k) * similarity**k * (1 - similarity) ** (n - k)
        if below > miss:
            return k
    return n


def _alike(percent: int, needed: int):
    """Condition on (n, bits, sketch) of x and y: sizes and bitmaps allow the similarity, and the sketches agree often enough.

    Sizes and bitmaps bound the similarity from above, so they lose no link.
    """
    differ = sum((F.bit_count(F.col("bits_x")[i].bitwiseXOR(F.col("bits_y")[i])) for i in range(PARITY_WORDS)), F.lit(0))
    close = (100 + percent) * differ <= (100 - percent) * (F.col("n_x") + F.col("n_y"))
    agree = F.size(F.filter(F.zip_with("sketch_x", "sketch_y", lambda p, q: p == q), lambda e: e))
    return (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")) & close & (agree >= needed)


def _first_met(columns: int):
    """Condition that ``table_x`` is the first table that both classes share.

    A pair shares every table of a band ``a`` and a band ``b`` that it shares,
    so the first one belongs to the first equal band of each; thus no pair is
    made twice, and pairs need no shuffle to become distinct.
    """

    def first(k: str):
        return F.array_position(F.zip_with(f"{k}_x", f"{k}_y", lambda p, q: p == q), True) - 1

    return F.col("table_x") == first("a") * columns + first("b")


def _likely(pairs: DataFrame, shapes: DataFrame, percent: int, needed: int) -> DataFrame:
    """Pairs that sizes, bitmaps and sketches leave possible."""
    x, y = (shapes.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "xy")
    return pairs.join(x, "x").join(y, "y").filter(_alike(percent, needed)).select("x", "y")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` whose document stays: one document of each component, all columns kept.

    Rows that share the kept doc_id but not its text go with their own
    component; rows equal in both are one document and stay or go together.
    Null and empty texts stay, as do rows without a doc_id.
    """
    judged = near_duplicates(docs, **options).filter("NOT kept").select("doc_id", "version").distinct()
    same = (docs["doc_id"].cast("long") == judged["doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == judged["version"])
    return docs.join(judged, same, "left_anti")
