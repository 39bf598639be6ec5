"""Summaries of extraction runs and of unit metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.corpus import suffix_of

# Unit types that OCR makes (fixed values).
OCR_UNITS = ("image_ocr_text", "pdf_page_ocr")


def whole_number(metadata: Column, key: str) -> Column:
    """The integer at ``key`` of a JSON object; null for other types, broken JSON and objects without the key."""
    value = F.try_variant_get(F.try_parse_json(metadata), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def ocr_confidence(units: DataFrame) -> DataFrame:
    """Mean confidence of OCR units (unit_type, confidence, regions), weighted by regions; 0 without any region."""
    counted = units.filter(F.col("unit_type").isin(*OCR_UNITS) & F.col("confidence").isNotNull() & (F.col("regions") > 0))
    mean = F.try_divide(F.sum(F.col("confidence") * F.col("regions")), F.sum("regions"))
    return counted.agg(F.round(F.coalesce(mean, F.lit(0.0)), 9).alias("mean_confidence"), F.coalesce(F.sum("regions"), F.lit(0)).cast("long").alias("regions"))


def first_number(units: DataFrame, issues: DataFrame, key: str) -> DataFrame:
    """First integer at ``key`` of each path's unit metadata (path, unit_index, metadata), else of its issues' (path, issue_index, metadata)."""
    parts = [rows.select("path", F.struct(F.lit(source).alias("source"), F.col(index).cast("long").alias("at")).alias("place"), whole_number(F.col("metadata"), key).alias("number")) for source, (rows, index) in enumerate(((units, "unit_index"), (issues, "issue_index")))]
    found = parts[0].unionByName(parts[1]).filter(F.col("number").isNotNull())
    return found.groupBy("path").agg(F.min_by("number", "place").alias("number"))


def extraction_summary(files: DataFrame, units: DataFrame, issues: DataFrame) -> DataFrame:
    """``measure, key, n`` of an extraction: totals, files by parser and by suffix, issues by type.

    ``files`` has path, parser (null where no parser takes the file) and failed;
    ``units`` has text, ``issues`` issue_type.  A file counts under its suffix
    whether or not it was read, under its parser only if it was.
    """
    supported = F.col("parser").isNotNull()
    done = supported & ~F.coalesce("failed", F.lit(False))
    counts = {"discovered_files": F.count("*"), "supported_files": F.count_if(supported), "succeeded_files": F.count_if(done), "failed_files": F.count_if(supported & ~done), "unsupported_files": F.count_if(~supported)}

    def totals(rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
        one = rows.agg(*[c.cast("long").alias(name) for name, c in measures.items()])
        return one.select(F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.lit("").alias("key"), F.col(m).alias("n")) for m in measures])).alias("r")).select("r.*")

    def by(rows: DataFrame, measure: str, key: Column) -> DataFrame:
        return rows.groupBy(key.alias("key")).agg(F.count("*").alias("n")).select(F.lit(measure).alias("measure"), "key", "n")

    parts = [
        totals(files, counts),
        totals(units, {"total_units": F.count("*"), "total_characters": F.coalesce(F.sum(F.length("text")), F.lit(0))}),
        totals(issues, {"total_issues": F.count("*")}),
        by(files.filter(done), "by_parser", F.col("parser")),
        by(files, "by_suffix", suffix_of(F.col("path"))),
        by(issues, "issues_by_type", F.col("issue_type")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
