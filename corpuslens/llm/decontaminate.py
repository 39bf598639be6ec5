"""Benchmark decontamination by size-partitioned MinHash containment search.

Words are maximal runs of letters and digits, lower-cased; a text's set is its
distinct shingles of ``width`` words (a shorter text is one shingle).  A short
item inside a long document has a tiny Jaccard similarity, so documents are
partitioned by the power of two above their number of distinct shingles and keep a
bottom-k MinHash sketch whose ``k`` is a fixed share of that bound: the share,
and not the document's length, decides whether the small hashes of an item that
it contains are in its sketch.  Items are partitioned by size as well, and each
partition has a share of its own: large items need a small one.  An item probes
with its own smallest hashes.  Candidates are then confirmed by the exact
containment of the item's shingles.

A bitmap of fixed size holds all probes, so that only hashes which some item
may ask for leave a document's sketch.  Only DataFrame functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.scratch import stored


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column, width: int) -> Column:
    """Hashes of all shingles of ``width`` words, with repeats; none for a text without words."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))

    def joined(h: Column) -> Column:
        n = F.size(h)
        several = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))
        return F.when(n >= width, several).when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    # A one-element array names the hashed words, so they are computed once.
    return F.get(F.transform(F.array(hashed), joined), 0)


BITMAP_WORDS = 1 << 14  # of 64 bits: 128 KB, whatever the number of items


def bit_word(value: Column) -> Column:
    """Place of a hash's word in the bitmap."""
    return F.shiftrightunsigned(value, 6).bitwiseAND(F.lit(BITMAP_WORDS - 1)).cast("int")


def _bitmap(probe: DataFrame) -> Column:
    """Constant array of words in which the bit of every probe's ``hash`` is set."""
    bit = F.expr("shiftleft(1L, CAST(hash & 63 AS INT))")
    words = [0] * BITMAP_WORDS
    for row in probe.groupBy(bit_word(F.col("hash")).alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        words[row["word"]] = row["bits"]
    return F.from_json(F.lit(str(words)), "array<bigint>")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, width: int = 5, threshold: float = 0.8, miss: float = 1e-7) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` of all pairs at or above ``threshold``.

    An item of ``q`` shingles whose containment reaches the threshold has at
    least ``threshold * q`` of its hashes in the document, each in the sketch
    with a probability of the share at least.  Items of one power of two have
    one share, set from the smallest of that size so that all those hashes are
    outside with a probability of at most half of ``miss``.  An item probes with
    so many of its smallest hashes that none of them is in the document with the
    other half; the smallest one that is there is the first to be in the sketch.

    Null and empty texts, on either side, match nothing; repeated rows, and
    rows with one doc_id and several texts, are reported once for each item;
    empty tables give no rows; extra columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.array_distinct(shingles(F.col("text").cast("string"), width)).alias("item_set"))
    items = items.filter(F.size("item_set") > 0)
    outside = miss / 2
    probes = 1 if threshold >= 1 else max(1, math.ceil(math.log(outside) / math.log(1 - threshold)))
    # Sizes from 2**level on; at least ceil(threshold * 2**level) of their hashes are in the document.
    level = F.floor(F.log2(F.size("item_set")))
    share = 1 - F.pow(F.lit(outside), 1 / F.ceil(F.lit(threshold) * F.pow(F.lit(2.0), level)))
    probe = items.select("item_id", share.alias("share"), F.explode(F.slice(F.sort_array("item_set"), 1, probes)).alias("hash"))
    probe = stored(probe, "probes")
    largest = probe.agg(F.max("share")).first()[0] or 0.0
    bits = _bitmap(probe)

    sets = docs.filter(F.col("text").isNotNull()).select("doc_id", F.sort_array(F.array_distinct(shingles(F.col("text"), width))).alias("sorted"))
    bound = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.size("sorted"), F.lit(1))))).cast("int")
    sketch = F.slice("sorted", F.lit(1), F.greatest(F.ceil(bound * largest), F.lit(1)).cast("int"))
    asked = sets.select("doc_id", bound.alias("bound"), F.transform(sketch, lambda h, i: F.struct(h.alias("hash"), (i + 1).alias("place"))).alias("sketch"), bits.alias("bits"))

    def wanted(entry: Column) -> Column:
        return F.getbit(F.get("bits", bit_word(entry["hash"])), entry["hash"].bitwiseAND(F.lit(63)).cast("int")) == 1

    asked = asked.select("doc_id", "bound", F.explode(F.filter("sketch", wanted)).alias("entry")).select("doc_id", "bound", "entry.*")
    found = asked.join(probe, "hash").filter(F.col("place") <= F.ceil(F.col("bound") * F.col("share"))).select("doc_id", "item_id").distinct()
    found = stored(found, "candidates")

    hit = docs.join(found.select("doc_id").distinct(), "doc_id", "left_semi").filter(F.col("text").isNotNull())
    full = hit.select("doc_id", F.array_distinct(shingles(F.col("text"), width)).alias("doc_set"))
    checked = full.join(found, "doc_id").join(items, "item_id")
    checked = checked.select("doc_id", "item_id", F.size(F.array_intersect("doc_set", "item_set")).cast("long").alias("n_shared"), F.size("item_set").cast("long").alias("n_item"))
    checked = checked.filter(F.col("n_shared") >= F.lit(threshold) * F.col("n_item"))
    return checked.distinct().withColumn("containment", F.col("n_shared") / F.col("n_item"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that contain no benchmark item; all columns are kept.

    A null doc_id cannot be named by a hit, so such rows are kept.
    """
    bad = contaminated(docs, benchmark, **options).select("doc_id").distinct()
    return docs.join(bad, docs["doc_id"].cast("long") == bad["doc_id"], "left_anti")
