"""Audit of extracted documents and validation of chunks: rules, metrics, summaries.

Rules read one narrow projection of the units: texts leave it as their length
and a 128-bit digest, so no shuffle carries them.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.text import preview
from corpuslens.operators.chunking import SEVERITIES, TABLE_HEADERS, TABLE_ROWS
from corpuslens.operators.corpus import ABSOLUTE_PATH, locator_issue
from corpuslens.operators.summaries import OCR_UNITS, whole_number

# Issue types of the audit and their severities as extraction raises them (fixed values).
ISSUE_SEVERITIES = {
    **dict.fromkeys(("pdf_encrypted_unreadable", "pdf_unreadable", "image_unreadable", "image_invalid_dimensions", "image_pixel_limit_exceeded", "image_mode_conversion_failed", "xlsx_not_ooxml", "xlsx_zip_unreadable", "xlsx_uncompressed_size_limit_exceeded", "xlsx_compression_ratio_limit_exceeded", "xlsx_unreadable"), "error"),
    **dict.fromkeys(("document_has_no_text", "pdf_page_ocr_no_text", "pdf_page_ocr_failed", "ocr_model_unavailable", "ocr_engine_initialization_failed", "ocr_processing_failed", "ocr_no_text"), "warning"),
    **dict.fromkeys(("low_text_content", "image_dominant_document", "pdf_page_needs_ocr", "pdf_partially_needs_ocr", "pdf_page_extraction_failed", "pdf_page_ocr_applied", "pdf_page_ocr_low_confidence", "ocr_low_confidence", "ocr_region_metadata_truncated"), "info"),
    **dict.fromkeys(("xlsx_sheet_has_no_cells", "xlsx_hidden_sheet", "xlsx_metadata_limited", "xlsx_formula_cached_value_missing", "xlsx_large_sheet", "xlsx_very_wide_sheet", "xlsx_large_cell_value"), "info"),
}
AUDIT_ISSUES = ("document_has_no_units", "document_has_no_text", "empty_unit", "missing_required_locator", "invalid_locator_format", "duplicate_unit_text", "large_unit", *(i for i in ISSUE_SEVERITIES if i != "document_has_no_text"))
OCR_FAILURES = ("ocr_model_unavailable", "ocr_engine_initialization_failed", "ocr_processing_failed", "image_unreadable", "image_invalid_dimensions", "image_pixel_limit_exceeded", "image_mode_conversion_failed")
VALIDATION_ISSUES = ("duplicate_chunk_id", "duplicate_chunk_content", "empty_text_chunk", "nul_text_chunk", "invalid_document_reference", "invalid_unit_reference", "absolute_path_detected", "invalid_locator", "json_metadata_error", "oversized_chunk")
TABLE_CHUNKS = ("table_rows", "xlsx_table_rows", *TABLE_HEADERS, *TABLE_ROWS)


def extraction_issues(found: DataFrame) -> DataFrame:
    """``found`` (path, parser, issue, ...) with the severity that belongs to its issue; an unknown issue raises."""
    severity = F.lit(None).cast("string")
    for level in SEVERITIES:
        severity = F.when(F.col("issue").isin(*[i for i, s in ISSUE_SEVERITIES.items() if s == level]), level).otherwise(severity)
    return found.withColumn("severity", F.coalesce(severity, F.raise_error(F.concat(F.lit("unknown issue: "), F.col("issue"))).cast("string")))


def _digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def unit_issues(units: DataFrame, large: int = 20_000) -> DataFrame:
    """``path, unit_index, issue, severity`` of units (path, unit_index, unit_type, text, locator)."""
    narrow = units.select("path", "unit_index", locator_issue(F.col("unit_type"), F.col("locator")).alias("at_fault"), F.length("text").alias("size"), _digest(F.col("text")).alias("digest"))
    same = Window.partitionBy("path", "digest").orderBy("unit_index").rowsBetween(Window.unboundedPreceding, -1)
    narrow = narrow.withColumn("again", (F.col("size") > 0) & (F.count("*").over(same) > 0))
    rule = lambda when, issue, severity: F.when(when, F.struct(issue.alias("issue"), F.lit(severity).alias("severity")))
    rules = F.array(
        rule(F.col("size") == 0, F.lit("empty_unit"), "info"),
        rule(F.col("at_fault").isNotNull(), F.col("at_fault"), "warning"),
        rule(F.col("size") > large, F.lit("large_unit"), "warning"),
        rule(F.col("again"), F.lit("duplicate_unit_text"), "info"),
    )
    return narrow.select("path", "unit_index", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("r")).select("path", "unit_index", "r.issue", "r.severity")


def document_issues(documents: DataFrame, units: DataFrame, extraction: DataFrame) -> DataFrame:
    """``path, unit_index, issue, severity`` of documents (path, parser, size_bytes) without units or without text.

    A document of no bytes is a mere information; a parser that has already said
    ``document_has_no_text`` isn't repeated.
    """
    sizes = units.groupBy("path").agg(F.sum(F.length("text")).alias("characters"))
    said = extraction.filter(F.col("issue") == "document_has_no_text").select("path").distinct().withColumn("said", F.lit(True))
    rows = documents.join(sizes, "path", "left").join(said, "path", "left")
    no_units = F.when(F.col("characters").isNull(), F.lit("document_has_no_units"))
    no_text = F.when((F.coalesce("characters", F.lit(0)) == 0) & F.col("said").isNull(), F.lit("document_has_no_text"))
    found = F.filter(F.array(no_units, no_text), lambda x: x.isNotNull())
    return rows.select("path", F.lit(None).cast("int").alias("unit_index"), F.explode(found).alias("issue"), F.when(F.col("size_bytes") == 0, "info").otherwise("warning").alias("severity"))


def audit(documents: DataFrame, units: DataFrame, extraction: DataFrame, *, large: int = 20_000) -> DataFrame:
    """All issues of a corpus: what extraction found (path, issue, severity), and the document and unit rules."""
    given = extraction.select("path", F.lit(None).cast("int").alias("unit_index"), "issue", "severity")
    return given.unionByName(document_issues(documents, units, extraction)).unionByName(unit_issues(units, large))


def document_metrics(documents: DataFrame, units: DataFrame, issues: DataFrame) -> DataFrame:
    """One row a document: units, characters, empty units, locator issues, repeats, largest unit."""
    n = F.length("text").cast("long")
    measured = units.groupBy("path").agg(F.count("*").alias("units"), F.sum(n).alias("characters"), F.count_if(F.col("text") == "").alias("empty_units"), F.max(n).alias("largest_unit"))
    faults = issues.groupBy("path").agg(F.count_if(F.col("issue").isin("missing_required_locator", "invalid_locator_format")).alias("locator_issues"), F.count_if(F.col("issue") == "duplicate_unit_text").alias("duplicates"), F.count("*").alias("issues"))
    joined = documents.select("path", "parser", F.col("size_bytes").cast("long").alias("size_bytes")).join(measured, "path", "left").join(faults, "path", "left")
    return joined.na.fill(0, ["units", "characters", "empty_units", "largest_unit", "locator_issues", "duplicates", "issues"])


def _spread(column: str, name: str) -> list[Column]:
    """Least, most, mean, median and interpolated 95th percentile; zeros for no values."""
    v = F.col(column).cast("double")
    stats = {"least": F.min(v), "most": F.max(v), "mean": F.avg(v), "median": F.median(v), "p95": F.percentile(v, F.lit(0.95))}
    return [F.round(F.coalesce(s, F.lit(0.0)), 6).alias(f"{name}_{k}") for k, s in stats.items()]


def audit_by_parser(documents: DataFrame, units: DataFrame, issues: DataFrame) -> DataFrame:
    """Metrics of each parser's documents, with the spread of characters by document and by unit."""
    total = lambda c: F.sum(c).alias(c)
    metrics = document_metrics(documents, units, issues)
    by = metrics.groupBy("parser").agg(
        F.count("*").alias("documents"), total("units"), total("characters"), F.sum("size_bytes").alias("source_bytes"), F.count_if(F.col("units") == 0).alias("documents_without_units"), F.count_if(F.col("characters") == 0).alias("documents_without_text"),
        total("empty_units"), total("locator_issues"), total("duplicates"), total("issues"), *_spread("characters", "document"),
    )
    parsers = documents.select("path", "parser")
    by_unit = units.select("path", F.length("text").alias("unit_size")).join(parsers, "path").groupBy("parser").agg(*_spread("unit_size", "unit"))
    return by.join(by_unit, "parser", "left").na.fill(0.0, [f"unit_{k}" for k in ("least", "most", "mean", "median", "p95")])


def audit_summary(documents: DataFrame, units: DataFrame, extraction: DataFrame, issues: DataFrame) -> DataFrame:
    """One row of measures of the whole corpus, with PDF, image and workbook counts; each kind of table is aggregated once."""
    metrics = document_metrics(documents, units, issues)
    totals = metrics.agg(
        F.count("*").alias("documents"), *[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (("units", "total_units"), ("characters", "total_characters"), ("size_bytes", "total_source_bytes"), ("empty_units", "empty_units"), ("locator_issues", "units_without_required_locator"), ("duplicates", "duplicate_units"))],
        F.count_if(F.col("units") == 0).alias("documents_with_no_units"), F.count_if(F.col("characters") == 0).alias("documents_with_no_text"), F.count_if(F.col("parser") == "easyocr_png").alias("png_documents"), *_spread("characters", "document"),
    )
    counted = lambda i, name: F.count_if(F.col("issue") == i).alias(name)
    faults = issues.agg(
        F.count("*").alias("total_issues"), *[F.count_if(F.col("severity") == s).alias(f"{s}_issues") for s in SEVERITIES],
        *[counted(i, name) for i, name in (("large_unit", "large_units"), ("pdf_page_needs_ocr", "pdf_pages_needing_ocr"), ("pdf_page_ocr_applied", "pdf_pages_ocr_success"), ("pdf_page_ocr_no_text", "pdf_pages_ocr_no_text"), ("pdf_page_ocr_failed", "pdf_pages_ocr_failed"), ("xlsx_hidden_sheet", "xlsx_hidden_sheets"), ("xlsx_sheet_has_no_cells", "xlsx_empty_sheets"), ("xlsx_large_sheet", "xlsx_large_sheets"), ("xlsx_very_wide_sheet", "xlsx_very_wide_sheets"))],
    )
    ocr = F.col("unit_type").isin(*OCR_UNITS)
    number = lambda key: F.when(ocr, whole_number(F.col("metadata"), key))
    regions, confidence = number("included_region_count"), F.try_variant_get(F.try_parse_json("metadata"), "$.mean_confidence", "double")
    weighs = (regions > 0) & confidence.isNotNull()
    of_units = units.agg(
        F.count_if(F.col("unit_type") == "pdf_page_text").alias("pdf_pages_with_text"), F.count_if(F.col("unit_type") == "xlsx_table_rows").alias("xlsx_row_blocks"),
        *[F.coalesce(F.sum(number(k)), F.lit(0)).alias(name) for k, name in (("recognized_region_count", "ocr_regions_detected"), ("included_region_count", "ocr_regions_included"), ("excluded_low_confidence_region_count", "ocr_regions_low_confidence"), ("ocr_text_characters", "ocr_characters"))],
        F.round(F.coalesce(F.try_divide(F.sum(F.when(weighs, confidence * regions)), F.sum(F.when(weighs, regions))), F.lit(0.0)), 9).alias("mean_ocr_confidence"), F.count_distinct(F.when(ocr, F.col("path"))).alias("documents_with_ocr"),
    )
    books = units.filter(F.col("unit_type") == "xlsx_workbook_summary").join(documents.filter(F.col("parser") == "openpyxl_xlsx").select("path"), "path", "left_semi").groupBy("path").agg(F.min_by("metadata", "unit_index").alias("metadata"))
    of_books = books.agg(*[F.coalesce(F.sum(whole_number(F.col("metadata"), k)), F.lit(0)).alias(name) for k, name in (("sheet_count", "xlsx_sheets"), ("non_empty_cell_count", "xlsx_non_empty_cells"), ("formula_cell_count", "xlsx_formula_cells"), ("formula_without_cached_value_count", "xlsx_formula_without_cached_values"), ("merged_range_count", "xlsx_merged_ranges"), ("excel_table_count", "xlsx_excel_tables"))])
    images = documents.filter(F.col("parser") == "easyocr_png").select("path")
    read = units.filter(F.col("unit_type") == "image_ocr_text").select("path")
    said = lambda kinds: extraction.filter(F.col("issue").isin(*kinds)).select("path")
    of_images = [images.join(rows, "path", "left_semi").agg(F.count("*").alias(name)) for rows, name in ((read, "png_ocr_success"), (said(("ocr_no_text",)), "png_ocr_no_text"), (said(OCR_FAILURES), "png_ocr_failed"))]
    pages = documents.filter(F.col("parser") == "pypdf").select("path").join(page_counts(units, extraction), "path", "left").agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("pdf_pages"))
    out = totals
    for one in (faults, of_units, of_books, pages, *of_images):
        out = out.join(one)  # of one row each
    return out


def page_counts(units: DataFrame, extraction: DataFrame) -> DataFrame:
    """``path, pages``: the first page_count of a path's units, else of its issues' metadata, else its number of text pages."""
    own = units.select("path", F.struct(F.lit(0).alias("source"), F.col("unit_index").cast("long").alias("at")).alias("place"), whole_number(F.col("metadata"), "page_count").alias("pages"))
    if "metadata" in extraction.columns:
        told = extraction.select("path", F.struct(F.lit(1).alias("source"), F.monotonically_increasing_id().alias("at")).alias("place"), whole_number(F.col("metadata"), "page_count").alias("pages"))
        own = own.unionByName(told)
    told = own.filter("pages IS NOT NULL").groupBy("path").agg(F.min_by("pages", "place").alias("told"))
    counted = units.groupBy("path").agg(F.count_if(F.col("unit_type") == "pdf_page_text").alias("counted"))
    return counted.join(told, "path", "full").select("path", F.coalesce("told", "counted").alias("pages"))


def _even(n: Column, count: int) -> Column:
    """Places, from 0, of ``count`` evenly spaced items among ``n``."""
    if count <= 0:
        return F.array().cast("array<bigint>")
    few = F.least(F.lit(count).cast("long"), n)
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), few - 1), lambda i: F.bround(i * (n - 1) / F.greatest(few - 1, F.lit(1))).cast("long"))))


def numbered(rows: DataFrame, order: list[str], *by: str, ranges: int = 64) -> DataFrame:
    """``rows`` with ``place``, from 0 in each group in this order, and ``n``, the group's rows.

    Rows are sorted within ranges of the whole order, and numbers follow from the
    counts of the ranges before, so no task gets a whole group.  The ranges'
    bounds are a few keys that the driver draws by their hash; they decide how
    even the ranges are, never the numbers.  ``order`` should be unique.
    """
    keys = [*by, *order]
    kinds = [rows.schema[k].dataType for k in keys]
    drawn = rows.select(*keys).distinct().orderBy(F.xxhash64(*keys)).limit(ranges - 1).collect()
    bounds = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(r, kinds))]) for r in drawn])
    own = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    placed = rows.withColumn("_range", F.size(F.filter(bounds, lambda b: b <= own)) if drawn else F.lit(0))
    sizes = placed.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # of one row a range
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("n", F.sum("_n").over(group))
    within = Window.partitionBy(*by, "_range").orderBy(*order)
    out = placed.withColumn("_within", F.row_number().over(within) - 1).join(sizes.drop("_n"), [*by, "_range"])
    return out.withColumn("place", F.col("_before") + F.col("_within")).drop("_range", "_within", "_before")


def sample_documents(documents: DataFrame, units: DataFrame, *, per_parser: int = 3, per_document: int = 3, preview_chars: int = 200) -> DataFrame:
    """Evenly spaced documents of each parser by path, with evenly spaced previews of their units."""
    ordered = numbered(documents.select("path", "parser", "size_bytes"), ["path"], "parser")
    chosen = ordered.filter(F.array_contains(_even(F.col("n"), per_parser), F.col("place"))).select("path", "parser", "size_bytes")
    own = units.join(chosen.select("path"), "path", "left_semi")
    counts = own.groupBy("path").agg(F.count("*").alias("units"), F.sum(F.length("text")).cast("long").alias("characters"))
    own = own.join(counts, "path").filter(F.array_contains(_even(F.col("units"), per_document), F.col("unit_index").cast("long")))
    shown = F.lit("") if preview_chars == 0 else preview(F.col("text"), preview_chars)
    samples = own.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("unit_index", "unit_type", "locator", shown.alias("preview")))).alias("samples"))
    return chosen.join(counts, "path", "left").join(samples, "path", "left").na.fill(0, ["units", "characters"])


def chunk_locator_valid(unit_type: Column, locator: Column) -> Column:
    """Whether a chunk's locator fits its unit type; a null one always does."""
    xlsx = F.when(unit_type == "xlsx_workbook_summary", locator == "workbook").when(unit_type == "xlsx_sheet_summary", locator.startswith("sheet:")).otherwise(locator.startswith("sheet:") & locator.contains("range:"))
    return (
        F.when(locator.isNull(), True)
        .when(unit_type.startswith("pdf_"), locator.startswith("page:"))
        .when(unit_type.startswith("pptx_"), locator.startswith("slide:"))
        .when(unit_type.startswith("xlsx_"), xlsx)
        .when(unit_type == "image_ocr_text", locator.startswith("image:"))
        .otherwise(True)
    )


def metadata_path(metadata: Column) -> Column:
    """Whether a string under a key that contains ``path``, at any depth of the JSON object, holds an absolute path.

    Only objects that have such a key and a slash are parsed in Python.
    """
    import re

    pattern = re.compile(ABSOLUTE_PATH.removeprefix("(?U)"))

    def holds(key: str, value: object) -> bool:
        if isinstance(value, str):
            return "path" in key.lower() and bool(pattern.search(value))
        if isinstance(value, list):
            return any(holds(key, v) for v in value)
        return isinstance(value, dict) and any(holds(k, v) for k, v in value.items())

    @F.pandas_udf("boolean")
    def search(objects: pd.Series) -> pd.Series:
        def one(text: str | None) -> bool:
            try:
                return text is not None and holds("", json.loads(text))
            except ValueError:
                return False

        return objects.map(one)

    likely = metadata.rlike(r'(?i)"[^"]*path[^"]*"\s*:') & metadata.rlike(r"[/\\]")
    return F.coalesce(search(F.when(likely, metadata)), F.lit(False))


def validate_chunks(chunks: DataFrame, unit_counts: DataFrame, *, most: int = 4000) -> DataFrame:
    """``chunk_id, path, issue, severity`` of chunks (chunk_id, path, unit_type, text, locator, source_unit_indices, metadata, explained).

    ``metadata`` is a JSON object or null; ``explained`` says that a chunk may be
    longer than ``most``, as splitting or OCR made it so.  ``unit_counts`` has
    path and n_units of the source documents.
    """
    counts = unit_counts.select("path", "n_units")
    rows = chunks.join(counts, "path", "left")
    outside = F.exists("source_unit_indices", lambda i: (i < 0) | (i >= F.col("n_units")))
    rules = [
        (~F.coalesce(F.col("text").rlike(r"(?U)\S"), F.lit(False)), "empty_text_chunk"),
        (F.col("text").contains("\0"), "nul_text_chunk"),
        (F.col("path").rlike(ABSOLUTE_PATH) | metadata_path(F.col("metadata")), "absolute_path_detected"),
        (F.col("n_units").isNull(), "invalid_document_reference"),
        (F.coalesce(outside, F.lit(False)), "invalid_unit_reference"),
        (~chunk_locator_valid(F.col("unit_type"), F.col("locator")), "invalid_locator"),
        (F.col("metadata").isNotNull() & F.try_parse_json("metadata").isNull(), "json_metadata_error"),
        ((F.length("text") > most) & ~F.coalesce("explained", F.lit(False)), "oversized_chunk"),
    ]
    found = F.filter(F.array(*[F.when(c, F.lit(name)) for c, name in rules]), lambda x: x.isNotNull())
    each = rows.select("chunk_id", "path", F.explode(found).alias("issue"), F.lit("error").alias("severity"))
    none = F.lit(None).cast("string")
    ids = chunks.groupBy("chunk_id").agg(F.count("*").alias("n")).filter("n > 1").select("chunk_id", none.alias("path"), F.lit("duplicate_chunk_id").alias("issue"), F.lit("error").alias("severity"))
    texts = chunks.groupBy("path", _digest(F.col("text")).alias("digest")).agg(F.count("*").alias("n")).filter("n > 1").select(none.alias("chunk_id"), "path", F.lit("duplicate_chunk_content").alias("issue"), F.lit("warning").alias("severity"))
    return each.unionByName(ids).unionByName(texts)


def validation_summary(chunks: DataFrame, unit_counts: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: sizes, severities, issues by type, spread of chunk lengths, and text, table and OCR chunks."""
    ocr, tables = F.col("unit_type").isin(*OCR_UNITS), F.col("unit_type").isin(*TABLE_CHUNKS)
    v = F.length("text").cast("double")
    zero = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6)
    sizes = chunks.agg(
        F.count("*").alias("chunks"), F.coalesce(F.max(F.length("text")), F.lit(0)).cast("long").alias("maximum_chunk_characters"), zero(F.avg(v)).alias("mean_chunk_characters"), zero(F.percentile(v, F.lit(0.5))).alias("median_chunk_characters"), zero(F.percentile(v, F.lit(0.95))).alias("p95_chunk_characters"),
        F.count_if(~ocr & ~tables).alias("text_chunks"), F.count_if(tables).alias("table_chunks"), F.count_if(ocr).alias("ocr_chunks"),
    )
    sources = unit_counts.agg(F.count("*").alias("source_documents"), F.coalesce(F.sum("n_units"), F.lit(0)).cast("long").alias("source_units"))
    counted = errors.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"), *[F.count_if(F.col("issue") == i).alias(i) for i in VALIDATION_ISSUES])
    return sizes.join(sources).join(counted)  # of one row each
