"""Writers of tables, single JSON and text files, reports, and search indexes, for any store that Spark reaches.

Everything is written beside its place and renamed when it is whole; what stood
there before stays until then and comes back if the rename fails.
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.operators.corpus import suffix_of

SCHEMA_VERSION = 1
CHANNELS = ("content_word", "content_ngram", "context_word")
# Suffixes that a histogram shows by name, columns of a review sheet (fixed values).
SHOWN_SUFFIXES = (".pdf", ".docx", ".pptx", ".xlsx", ".csv", ".png")
REVIEW_COLUMNS = ("query_id", "query_type", "query", "is_auto_evaluated", "rank", "score", "chunk_id", "relative_path", "locator", "parser_name", "unit_type", "channel_ranks", "is_expected_match", "text_preview", "notes")


def _store(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _store(spark, path)
    return store.exists(at)


def replace(spark: SparkSession, path: str, write: Callable[[str], None], *, overwrite: bool = True) -> str:
    """Let ``write`` fill a folder beside ``path``, then put it in place of ``path``."""
    if not overwrite and exists(spark, path):
        raise FileExistsError(path)
    made, old = f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp", f"{path.rstrip('/')}.{uuid.uuid4().hex}.bak"
    store, at = _store(spark, path)
    new, kept = _store(spark, made)[1], _store(spark, old)[1]
    try:
        write(made)
        stood = store.exists(at)
        if stood and not store.rename(at, kept):
            raise OSError(f"cannot move {path}")
        if not store.rename(new, at):
            if stood:
                store.rename(kept, at)
            raise OSError(f"cannot rename {made}")
        if stood:
            store.delete(kept, True)
    finally:
        store.delete(new, True)
    return path


def write_lines(df: DataFrame, path: str, *, overwrite: bool = True) -> str:
    """A table as JSON lines, nulls included."""
    return replace(df.sparkSession, path, lambda to: df.write.option("ignoreNullFields", "false").json(to), overwrite=overwrite)


def write_table(df: DataFrame, path: str, *by: str, overwrite: bool = True) -> str:
    """A table as Parquet, in folders by ``by``."""
    return replace(df.sparkSession, path, lambda to: (df.write.partitionBy(*by) if by else df.write).parquet(to), overwrite=overwrite)


def write_text(spark: SparkSession, path: str, text: str, *, bom: bool = False) -> str:
    """One small text file, written by the driver."""
    store, at = _store(spark, path)
    made = _store(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
    try:
        stream = store.create(made, True)
        stream.write(bytearray(text.encode("utf-8-sig" if bom else "utf-8")))
        stream.close()
        if store.exists(at):
            store.delete(at, False)
        if not store.rename(made, at):
            raise OSError(f"cannot write {path}")
    finally:
        store.delete(made, False)
    return path


def write_json(spark: SparkSession, path: str, value: object) -> str:
    """One small JSON file with sorted keys."""
    return write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n")


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def write_extraction(folder: str, files: DataFrame, rows: DataFrame, summary: DataFrame) -> dict[str, str]:
    """Units, issues, failures, unsupported files and the summary of an extraction, each in its place below ``folder``."""
    failed = rows.filter("error IS NOT NULL")
    parts = {
        "units": rows.filter("unit_index IS NOT NULL").drop("issue", "error"), "issues": rows.filter("issue IS NOT NULL").select("path", "parser", "issue", F.col("text").alias("message"), "locator", "metadata"),
        "failures": failed.filter("error <> 'unsupported'").select("path", "parser", "error"), "unsupported": failed.filter("error = 'unsupported'").select("path"),
        "documents": files.join(failed.select(F.col("path").alias("relative_path")), "relative_path", "left_anti").drop("content"), "summary": summary,
    }
    return {name: write_table(part, f"{folder.rstrip('/')}/{name}") for name, part in parts.items()}


def processed(documents: DataFrame, failures: DataFrame, unsupported: DataFrame, files: DataFrame) -> DataFrame:
    """``path, outcome`` of every discovered file; raises unless the three tables part the files among them."""
    out = documents.select("path", F.lit("document").alias("outcome")).unionByName(failures.select("path", F.lit("failure").alias("outcome"))).unionByName(unsupported.select("path", F.lit("unsupported").alias("outcome")))
    twice = out.groupBy("path").count().filter("count > 1")
    lost = files.select("path").join(out, "path", "left_anti")
    if twice.limit(1).count() or lost.limit(1).count():
        raise ValueError("files are lost or counted twice")
    return out


def suffix_histogram(files: DataFrame) -> DataFrame:
    """``suffix, n`` with the shown suffixes by name, zeros included, and all others as ``other``."""
    known = files.sparkSession.createDataFrame([(s,) for s in (*SHOWN_SUFFIXES, "other")], "suffix string")
    own = suffix_of(F.col("path"))
    counted = files.select(F.when(own.isin(*SHOWN_SUFFIXES), own).otherwise("other").alias("suffix")).groupBy("suffix").agg(F.count("*").alias("n"))
    return known.join(counted, "suffix", "left").select("suffix", F.coalesce("n", F.lit(0)).alias("n"))


def write_index(folder: str, records: DataFrame, channels: dict[str, DataFrame], *, settings: dict | None = None, overwrite: bool = False) -> str:
    """An index: ``records`` (record, chunk_id, ...), each channel's postings in a folder by channel, and a manifest.

    ``channels`` maps names to weighted postings (token, record, weight), sorted
    by token in every file so that a query's tokens skip most row groups.
    """
    spark = records.sparkSession

    def write(to: str) -> None:
        records.write.parquet(f"{to}/records")
        for name, postings in channels.items():
            postings.sortWithinPartitions("token").write.parquet(f"{to}/postings/channel={name}")
        counted = spark.read.parquet(f"{to}/records").agg(F.count("*").alias("n")).first()["n"]
        write_json(spark, f"{to}/manifest.json", {"schema_version": SCHEMA_VERSION, "record_count": counted, "channels": sorted(channels), "settings": settings or {}})

    return replace(spark, folder, write, overwrite=overwrite)


def load_index(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame], dict]:
    """Records, postings by channel, and the manifest of an index; one that is incomplete raises."""
    folder = folder.rstrip("/")
    if not exists(spark, f"{folder}/manifest.json"):
        raise FileNotFoundError(f"{folder}/manifest.json")
    manifest = json.loads(read_text(spark, f"{folder}/manifest.json"))
    if manifest.get("schema_version") != SCHEMA_VERSION:
        raise ValueError(f"index of version {manifest.get('schema_version')}")
    if not set(manifest["channels"]) <= set(CHANNELS):
        raise ValueError(f"unknown channels: {manifest['channels']}")
    records = spark.read.parquet(f"{folder}/records")
    seen = records.agg(F.count("*").alias("n"), F.count_distinct("record").alias("records"), F.min("record").alias("least"), F.max("record").alias("most")).first()
    if seen["n"] != manifest["record_count"] or seen["records"] != seen["n"]:
        raise ValueError("records are lost or repeated")
    if "chunk_id" in records.columns and records.groupBy("chunk_id").count().filter("count > 1").limit(1).count():
        raise ValueError("a chunk_id is repeated")
    absent = [c for c in manifest["channels"] if not exists(spark, f"{folder}/postings/channel={c}")]
    if absent:
        raise FileNotFoundError(f"channels without postings: {absent}")
    return records, {c: spark.read.parquet(f"{folder}/postings/channel={c}") for c in manifest["channels"]}, manifest


def search_result(results: DataFrame, query: str, top: int) -> str:
    """A query's results (rank, ...) as one JSON text."""
    rows = [json.loads(r[0]) for r in results.filter(F.col("rank") <= top).orderBy("rank").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]
    return json.dumps({"query": query, "top_k": top, "results": rows}, ensure_ascii=False, sort_keys=True)


def review_sheet(rows: list[dict]) -> str:
    """Results as CSV for reviewers; scores have twelve significant digits."""
    out = io.StringIO()
    sheet = csv.DictWriter(out, REVIEW_COLUMNS, extrasaction="ignore", lineterminator="\n")
    sheet.writeheader()
    for r in rows:
        sheet.writerow({c: "" if r.get(c) is None else f"{r[c]:.12g}" if c == "score" else r[c] for c in REVIEW_COLUMNS})
    return out.getvalue()


def markdown_report(title: str, sections: dict[str, DataFrame | dict], *, most: int = 1000) -> str:
    """A report: each section a small table (a row of measures, or at most ``most`` rows in their order) or a mapping."""
    cell = lambda v: str("" if v is None else round(v, 6) if isinstance(v, float) else v).replace("|", "\\|").replace("\n", " / ")
    lines = [f"# {title}", ""]
    for name, content in sections.items():
        lines += [f"## {name}", ""]
        if isinstance(content, DataFrame):
            rows = content.limit(most).collect()
            if len(rows) == 1 and len(content.columns) > 3:
                content = rows[0].asDict()
            else:
                lines += [f"| {' | '.join(content.columns)} |", f"|{'---|' * len(content.columns)}", *(f"| {' | '.join(map(cell, r))} |" for r in rows), ""]
                continue
        lines += [*(f"- {k}: {cell(v)}" for k, v in content.items()), ""]
    return "\n".join(lines)


def write_scores(judged: DataFrame, path: str) -> str:
    """Headerless CSV of idx, label and tokens."""
    return replace(judged.sparkSession, path, lambda to: judged.select("idx", "label", "tokens").sortWithinPartitions("idx").write.csv(to))
