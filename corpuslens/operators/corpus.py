"""Text chunks, locators, distributions, diagnoses, range overlap, reading order, and answers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.text import chunk_id, line_number, split_segments

# Locator prefixes that unit types need (fixed values).
LOCATOR_PREFIXES = {
    "docx_heading": "item:", "docx_paragraph": "item:", "docx_list_item": "item:", "docx_table": "table:", "docx_table_row": "table:",
    "markdown_section": "line:", "notebook_cell": "cell:", "notebook_output": "cell:", "image_ocr_text": "image:", "pdf_page_text": "page:", "pdf_page_ocr": "page:",
    "pptx_slide_title": "slide:", "pptx_slide_text": "slide:", "pptx_speaker_notes": "slide:", "pptx_slide_table": "slide:", "pptx_slide_table_row": "slide:",
    "table_header": "row:", "table_row": "row:", "xlsx_workbook_summary": "workbook", "xlsx_sheet_summary": "sheet:", "xlsx_table_rows": "sheet:",
}
# Absolute paths of both systems, and suffixes of office files (fixed values).
ABSOLUTE_PATH = r"""(?U)[A-Za-z]:[\\/][^\s"']+|(?<![\w:])/[^\s"']+"""
OFFICE_SUFFIXES = (".doc", ".docx", ".xls", ".xlsx", ".xlsm", ".ppt", ".pptx")


def suffix_of(path: Column) -> Column:
    """Lower-cased suffix of a path's last part: from its last dot, unless that leads it."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)\z", 1))


def text_chunks(units: DataFrame, most: int = 4000, overlap: int = 200) -> DataFrame:
    """Chunks of text units (path, unit_index, text): index, character span, line locator and content id."""
    cut = units.select("path", "unit_index", "text", F.posexplode(split_segments(F.col("text"), most, overlap)).alias("split_index", "s"))
    piece = F.substring("text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start"))
    locator = F.concat(F.lit("line:"), line_number(F.col("text"), F.col("s.start")), F.lit("-"), line_number(F.col("text"), F.col("s.end")))
    rows = cut.select("path", "unit_index", "split_index", F.col("s.start").alias("start"), F.col("s.end").alias("end"), piece.alias("piece"), locator.alias("locator"))
    order = Window.partitionBy("path").orderBy("unit_index", "split_index")
    rows = rows.withColumn("chunk_index", (F.row_number().over(order) - 1).cast("int"))
    ident = chunk_id(F.col("chunk_index"), F.col("locator"), F.lit("plain_text"), F.col("path"), F.array("unit_index"), F.col("piece"), F.lit("text"))
    return rows.withColumn("chunk_id", ident)


def locator_issue(unit_type: Column, locator: Column) -> Column:
    """``missing_required_locator``, ``invalid_locator_format`` or null."""
    prefix = F.lit(None).cast("string")
    for kind, start in LOCATOR_PREFIXES.items():
        prefix = F.when(unit_type == kind, F.lit(start)).otherwise(prefix)
    needed = prefix.isNotNull() | (unit_type == "json_value")
    return F.when(needed & locator.isNull(), F.lit("missing_required_locator")).when(prefix.isNotNull() & ~locator.startswith(prefix), F.lit("invalid_locator_format"))


def distribution(values: DataFrame, column: str, *by: str) -> DataFrame:
    """Count, minimum, maximum, mean, median and interpolated 95th percentile; zeros for no values."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    v = F.col(column).cast("double")
    stats = [F.count(column).alias("n"), zero(F.min(v)).alias("least"), zero(F.max(v)).alias("most"), F.round(zero(F.avg(v)), 6).alias("mean"), zero(F.median(v)).alias("median"), F.round(zero(F.percentile(v, F.lit(0.95))), 6).alias("p95")]
    return values.groupBy(*by).agg(*stats)


def pdf_diagnosis(size: Column, header: Column, eof: Column, readable: Column, encrypted: Column, decrypted: Column, converted: Column, sampled: Column) -> Column:
    """First fitting label of the ordered diagnosis (fixed values)."""
    return (
        F.when(size == 0, "empty_file")
        .when(~header, "not_pdf")
        .when(encrypted & ~decrypted, "encrypted_unreadable")
        .when(~eof & ~readable, "pdf_header_only")
        .when(~readable, "pypdf_unreadable")
        .when(converted.isin("success", "partial_success"), "docling_success")
        .when(converted == "failed", "docling_backend_failure")
        .when(sampled > 0, "readable_text_pdf")
        .otherwise("readable_image_or_empty_text_pdf")
    )


def dispatch(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files with the parser of their suffix, null where none; two parsers for a suffix are an error."""
    if registry.groupBy("suffix").count().filter("count > 1").limit(1).count():
        raise ValueError("more than one parser for a suffix")
    return files.withColumn("suffix", suffix_of(F.col("path"))).join(registry, "suffix", "left")


def overlapping(ranges: DataFrame, areas: DataFrame) -> DataFrame:
    """First area (by ``area``) of the same sheet that each cell range meets.

    Boxes are compared once each, whatever the number of ranges and areas that
    have them; the ranges then look up their own.
    """
    box = ["sheet", "row1", "row2", "col1", "col2"]
    meets = (F.col("r.row1") <= F.col("a.row2")) & (F.col("r.row2") >= F.col("a.row1")) & (F.col("r.col1") <= F.col("a.col2")) & (F.col("r.col2") >= F.col("a.col1"))
    asked, known = ranges.select(*box).distinct(), areas.groupBy(*box).agg(F.min("area").alias("area"))
    joined = asked.alias("r").join(known.alias("a"), (F.col("r.sheet") == F.col("a.sheet")) & meets)
    found = joined.groupBy(*[f"r.{c}" for c in box]).agg(F.min("a.area").alias("area"))
    return ranges.join(found, box).groupBy("sheet", "range_id").agg(F.min("area").alias("area"))


def reading_order(regions: DataFrame, tolerance: float = 0.6) -> DataFrame:
    """``page, ord, line, position`` of OCR regions (page, ord, x0, y0, x1, y1): lines from top to bottom, then left to right.

    From the top down a region joins the first line whose centre is within
    ``tolerance`` of the larger height (1 at least), else it opens one; a line's
    centre is the mean of its regions'.  The fold is sequential within a page.
    """

    def fold(g: pd.DataFrame) -> pd.DataFrame:
        lines: list[dict] = []
        for r in g.sort_values(["y0", "x0", "ord"]).itertuples():
            tall = max(0.0, r.y1 - r.y0)
            centre, height = r.y0 + tall / 2, max(1.0, tall)
            line = next((x for x in lines if abs(x["centre"] - centre) <= tolerance * max(x["height"], height)), None)
            if line is None:
                line = {"centres": [], "height": height, "rows": []}
                lines.append(line)
            line["rows"].append(r)
            line["centres"].append(centre)
            line["centre"] = sum(line["centres"]) / len(line["centres"])
            line["height"] = max(line["height"], tall)
        out = [(r.page, r.ord, i, k) for i, x in enumerate(sorted(lines, key=lambda x: x["centre"])) for k, r in enumerate(sorted(x["rows"], key=lambda r: (r.x0, r.ord)))]
        return pd.DataFrame(out, columns=["page", "ord", "line", "position"])

    return regions.groupBy("page").applyInPandas(fold, "page long, ord int, line int, position int")


def answer_score(judged: DataFrame) -> DataFrame:
    """Mean of the labels' values."""
    value = F.when(F.col("label") == "Perfect", 1.0).when(F.col("label") == "Acceptable", 0.5).when(F.col("label") == "Missing", 0.0).when(F.col("label") == "Incorrect", -1.0)
    return judged.agg(F.count("*").alias("answers"), F.round(F.avg(value), 9).alias("score"))
