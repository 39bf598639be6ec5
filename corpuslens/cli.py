"""Command line: ``python -m corpuslens.cli COMMAND ...``; wrong input ends with exit code 2.

Every command reads and writes folders of any store that Spark reaches.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions import text as X
from corpuslens.operators import chunking as K
from corpuslens.operators import comparison as P
from corpuslens.operators import items as I
from corpuslens.operators import quality as V
from corpuslens.operators import search as S
from corpuslens.operators import summaries as M
from corpuslens.plans.stages import environment, strict_gate
from corpuslens.sources import parsers, readers, sinks

INPUT_ERRORS = (FileNotFoundError, NotADirectoryError, FileExistsError, ValueError)


def session() -> SparkSession:
    return SparkSession.builder.appName("corpuslens").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _files(spark: SparkSession, source: str) -> DataFrame:
    return parsers.discover(spark, source)


def scan(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Manifest of a source folder, with a histogram of suffixes and what was ignored."""
    files = parsers.listing(spark, a.source)
    kept = files.filter("reason IS NULL").select(F.col("relative_path").alias("path"), "name", "suffix", "mime_type", F.col("length").alias("size_bytes"), "modificationTime", F.sha2("content", 256).alias("sha256"))
    sinks.write_lines(kept, f"{a.out}/manifest")
    return {"suffixes": {r["suffix"]: r["n"] for r in sinks.suffix_histogram(kept).collect()}, "ignored": {r["reason"]: r["n"] for r in parsers.ignored_by_reason(files).collect()}}


def extract(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Units, issues, failures and unsupported files of a source folder."""
    files = _files(spark, a.source).select("relative_path", F.col("length").alias("size_bytes"), "content")
    rows = parsers.extract(files)
    sinks.write_table(rows, f"{a.out}/rows")
    rows = spark.read.parquet(f"{a.out}/rows")
    own = rows.groupBy("path").agg(F.max("parser").alias("parser"), F.max(F.col("error").isNotNull()).alias("failed"))
    listed = files.select(F.col("relative_path").alias("path"), F.col("size_bytes")).join(own, "path", "left")
    issues = rows.filter("issue IS NOT NULL").select(F.col("issue").alias("issue_type"))
    summary = M.extraction_summary(listed, rows.filter("unit_index IS NOT NULL"), issues)
    sinks.write_extraction(a.out, files, rows, summary)
    return {f"{r['measure']}{'.' if r['key'] else ''}{r['key']}": r["n"] for r in summary.collect()}


def _extracted(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    units = spark.read.parquet(f"{folder}/units")
    documents = spark.read.parquet(f"{folder}/documents").select(F.col("relative_path").alias("path"), "size_bytes")
    parser = units.select("path", "parser").distinct()
    issues = spark.read.parquet(f"{folder}/issues")
    return documents.join(parser, "path", "left").select("path", F.coalesce("parser", F.lit("")).alias("parser"), "size_bytes"), units, V.extraction_issues(issues)


def audit(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Issues, summaries and samples of an extraction, with a report."""
    documents, units, told = _extracted(spark, a.input)
    sinks.write_table(V.audit(documents, units, told, large=a.large), f"{a.out}/issues")
    issues = spark.read.parquet(f"{a.out}/issues")
    summary = V.audit_summary(documents, units, told, issues)
    sections = {"Summary": summary, "Parsers": V.audit_by_parser(documents, units, issues), "Issues": K.zero_filled(issues, "issue", V.AUDIT_ISSUES)}
    sinks.write_lines(V.sample_documents(documents, units), f"{a.out}/samples")
    sinks.write_text(spark, f"{a.out}/report.md", sinks.markdown_report("Audit", sections))
    return summary.first().asDict()


def chunk(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Chunks of an extraction, their issues and summary."""
    documents, units, _ = _extracted(spark, a.input)
    chunks, issues = K.chunk_units(documents, units, most=a.most, overlap=a.overlap, table_rows=a.table_rows)
    sinks.write_table(chunks, f"{a.out}/chunks")
    sinks.write_table(issues, f"{a.out}/issues")
    chunks, issues = spark.read.parquet(f"{a.out}/chunks"), spark.read.parquet(f"{a.out}/issues")
    return K.chunk_summary(documents, units, chunks, issues).first().asDict()


def validate(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Errors and summary of chunks against the extraction they come from."""
    documents, units, _ = _extracted(spark, a.extraction)
    counts = documents.join(units.groupBy("path").agg(F.count("*").cast("int").alias("n_units")), "path", "left").select("path", F.coalesce("n_units", F.lit(0)).alias("n_units"))
    chunks = spark.read.parquet(f"{a.input}/chunks").withColumn("explained", F.col("details.original_unit_characters").isNotNull())
    sinks.write_table(V.validate_chunks(chunks, counts, most=a.most), f"{a.out}/errors")
    summary = V.validation_summary(chunks, counts, spark.read.parquet(f"{a.out}/errors"))
    sinks.write_text(spark, f"{a.out}/report.md", sinks.markdown_report("Chunk validation", {"Summary": summary}))
    return summary.first().asDict()


def channels_of(chunks: DataFrame) -> dict[str, DataFrame]:
    """Records with the tokens of each channel, from chunks with a ``record``."""
    content = X.normalize(F.col("text"))
    metadata = {k: F.coalesce(K.string_value(F.col("metadata"), k), F.array_join(K.string_list(F.col("metadata"), k), " ")) for k in X.CONTEXT_KEYS}
    context = X.normalize(X.context_text(F.col("path"), F.col("parser"), F.col("unit_type"), F.col("locator"), metadata))
    tokens = {"content_word": X.word_tokens(content), "content_ngram": X.cjk_ngrams(content), "context_word": X.word_tokens(context)}
    return {name: S.with_sentinel(S.spread(chunks).select("record", t.alias("tokens"))) for name, t in tokens.items()}


def index(spark: SparkSession, a: argparse.Namespace) -> dict:
    """A search index of chunks."""
    chunks = P.record_index(spark.read.parquet(f"{a.input}/chunks")).withColumnRenamed("record_index", "record")
    records = chunks.select("record", "chunk_id", "path", "locator", "parser", "unit_type", "text", "metadata")
    sinks.write_index(a.out, records, {n: S.weighted_postings(r) for n, r in channels_of(chunks).items()}, settings={"k1": S.K1, "b": S.B, "rrf_k": S.RRF_K}, overwrite=a.overwrite)
    return sinks.load_index(spark, a.out)[2]


def _asked(queries: DataFrame) -> DataFrame:
    content = X.normalize(F.col("text"))
    return queries.withColumn("words", X.word_tokens(content)).withColumn("grams", X.cjk_ngrams(content))


def _searched(spark: SparkSession, folder: str, queries: DataFrame, top: int) -> DataFrame:
    records, postings, _ = sinks.load_index(spark, folder)
    asked = S.checked_queries(_asked(queries), top, "words", "grams")
    per = {n: (postings.get(n), asked.select("query", F.col("grams" if n == "content_ngram" else "words").alias("tokens"))) for n in sinks.CHANNELS}
    return S.materialized(S.search(per, top), records)


def search(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Answers of an index to one query."""
    queries = spark.createDataFrame([("query", a.query)], "query string, text string")
    found = _searched(spark, a.index, queries, a.top).drop("query").withColumn("text", X.joined_preview(F.col("text"), 200))
    text = sinks.search_result(found, a.query, a.top)
    if a.out:
        sinks.write_text(spark, a.out, text)
    return json.loads(text)


def evaluate(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Hits of an index over a query file: summary, results, review sheet, report."""
    asked = readers.read_queries(spark, a.queries)
    queries = asked.select(F.col("query_id").alias("query"), F.col("query").alias("text"))
    wanted = asked.select("query_id", F.explode("expected_relevant").alias("e")).select(F.col("query_id").alias("query"), F.col("e.relative_path").alias("path"), F.col("e.locator").alias("wanted"))
    sinks.write_table(_searched(spark, a.index, queries, a.top), f"{a.out}/results")
    results = spark.read.parquet(f"{a.out}/results")
    hits = results.join(wanted, ["query", "path"]).filter(F.col("wanted").isNull() | F.col("wanted").eqNullSafe(F.col("locator"))).select("query", "record").distinct()
    evaluated = S.evaluate(results, hits, queries).drop("auto")
    auto = wanted.select("query").distinct().withColumn("auto", F.lit(True))
    evaluated = evaluated.join(auto, "query", "left").withColumn("auto", F.coalesce("auto", F.lit(False)))
    for k in (1, 3, 5, 10):
        evaluated = evaluated.withColumn(f"hit_at_{k}", F.when(F.col("auto"), F.coalesce(F.col("first_rank") <= k, F.lit(False))))
    evaluated = evaluated.withColumn("reciprocal_rank", F.when(F.col("auto"), F.coalesce(1.0 / F.col("first_rank"), F.lit(0.0))))
    evaluated = evaluated.join(asked.select(F.col("query_id").alias("query"), "query_type", "notes"), "query")
    sinks.write_lines(evaluated, f"{a.out}/query_results")
    summary, by = P.evaluation_counts(evaluated, results), P.evaluation_counts(evaluated, None, "query_type")
    review = results.join(hits.withColumn("is_expected_match", F.lit(True)), ["query", "record"], "left").join(asked.select(F.col("query_id").alias("query"), "query_type", F.col("query").alias("question"), "notes"), "query")
    review = review.withColumn("text_preview", X.joined_preview(F.col("text"), 200)).orderBy("query", "rank").limit(a.review_rows)
    rows = [r.asDict() | {"query_id": r["query"], "query": r["question"], "relative_path": r["path"], "parser_name": r["parser"]} for r in review.collect()]
    sinks.write_text(spark, f"{a.out}/review.csv", sinks.review_sheet(rows), bom=True)
    sinks.write_json(spark, f"{a.out}/summary.json", summary.first().asDict())
    sinks.write_text(spark, f"{a.out}/report.md", sinks.markdown_report("Search evaluation", {"Summary": summary, "Query types": by}))
    return summary.first().asDict()


def compare(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Changes between the results of two evaluations."""
    old, new = (spark.read.parquet(f"{folder}/results").select("query", "rank", "path", "unit_type", "metadata") for folder in (a.old, a.new))
    sinks.write_lines(P.path_changes(old, new), f"{a.out}/changes")
    summary = P.comparison_summary(P.path_changes(old, new))
    sinks.write_text(spark, f"{a.out}/report.md", sinks.markdown_report("Comparison", {"Summary": summary}))
    return summary.first().asDict()


def diagnose(spark: SparkSession, a: argparse.Namespace) -> dict:
    """What the bytes of PDF files tell: size, header, end mark."""
    files = _files(spark, a.source).filter("suffix = '.pdf'").select(F.col("relative_path").alias("path"), "content")
    records = I.pdf_records(files)
    sinks.write_lines(records, f"{a.out}/records")
    return records.agg(F.count("*").alias("files"), F.count_if("header").alias("header_is_pdf"), F.count_if(F.col("size") == 0).alias("empty")).first().asDict()


def sample(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Files near evenly spaced quantiles of size, for conversion trials."""
    files = _files(spark, a.source).select(F.col("relative_path").alias("path"), F.col("length").alias("size_bytes"))
    chosen = P.quantile_sample(files, a.per_suffix, tuple(s if s.startswith(".") else f".{s}" for s in a.formats.lower().split(",")))
    sinks.write_lines(chosen, f"{a.out}/selection")
    return {r["suffix"]: r["n"] for r in chosen.groupBy("suffix").agg(F.count("*").alias("n")).collect()}


def rebuild(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Extraction, audit, chunks, validation and index one after another; with ``--strict`` errors end the run."""
    step = lambda **more: argparse.Namespace(**{**vars(a), **more})
    done = {"scan": scan(spark, step(out=f"{a.out}/scan")), "extract": extract(spark, step(out=f"{a.out}/extraction"))}
    done["audit"] = audit(spark, step(input=f"{a.out}/extraction", out=f"{a.out}/audit"))
    done["chunk"] = chunk(spark, step(input=f"{a.out}/extraction", out=f"{a.out}/chunks"))
    done["validate"] = validate(spark, step(extraction=f"{a.out}/extraction", input=f"{a.out}/chunks", out=f"{a.out}/validation"))
    if a.strict:
        strict_gate({"failed_files": done["extract"].get("failed_files", 0), "validation_errors": done["validate"]["errors"]})
    done["index"] = index(spark, step(input=f"{a.out}/chunks", out=f"{a.out}/index", overwrite=True))
    sinks.write_json(spark, f"{a.out}/manifest.json", done | {"environment": environment(spark)})
    return done


def _parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="corpuslens", description=__doc__.splitlines()[0])
    commands = out.add_subparsers(dest="command", required=True)
    source = (("--source",), {"default": os.environ.get("SOURCE_ROOT"), "help": "folder of files; SOURCE_ROOT by default"})
    folder, given = (("--out",), {"required": True}), (("--input",), {"required": True})
    sizes = [(("--most",), {"type": int, "default": 4000}), (("--overlap",), {"type": int, "default": 200}), (("--table-rows",), {"type": int, "default": 25})]
    large, top = (("--large",), {"type": int, "default": 20_000}), (("--top",), {"type": int, "default": 10})
    place, overwrite = (("--index",), {"required": True}), (("--overwrite",), {"action": "store_true"})
    table: dict[Callable, list] = {
        scan: [source, folder], extract: [source, folder], audit: [given, folder, large], chunk: [given, folder, *sizes], validate: [given, (("--extraction",), {"required": True}), folder, sizes[0]], index: [given, folder, overwrite],
        search: [place, (("--query",), {"required": True}), top, (("--out",), {})], evaluate: [place, (("--queries",), {"required": True}), folder, top, (("--review-rows",), {"type": int, "default": 10_000})],
        compare: [(("--old",), {"required": True}), (("--new",), {"required": True}), folder], diagnose: [source, folder], sample: [source, folder, (("--per-suffix",), {"type": int, "default": 3}), (("--formats",), {"default": "pdf,docx,pptx"})],
        rebuild: [source, folder, large, *sizes, (("--strict",), {"action": "store_true"})],
    }
    for run, options in table.items():
        command = commands.add_parser(run.__name__, help=run.__doc__.splitlines()[0])
        command.set_defaults(run=run)
        for names, kind in options:
            command.add_argument(*names, **kind)
    return out


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(arguments)
    if getattr(a, "source", "") is None:
        print("no source: give --source or set SOURCE_ROOT", file=sys.stderr)
        return 2
    try:
        print(json.dumps(a.run(spark or session(), a), ensure_ascii=False, indent=2, sort_keys=True, default=str))
    except INPUT_ERRORS as error:
        print(f"{type(error).__name__}: {error}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
