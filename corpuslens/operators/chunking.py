"""Chunks of units of any type: text is split, table rows are packed, the rest passes.

Routes are plain filters over one unit table.  Only table units are put in
order; greedy packing under a character limit is sequential within a table, so
it runs as a fold over sorted rows that holds one open group and no table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.text import chunk_id, line_number, split_segments
from corpuslens.operators.summaries import whole_number

# Unit types by their route, issue types and severities (fixed values).
TABLE_HEADERS = ("table_header", "docx_table", "pptx_slide_table")
TABLE_ROWS = ("table_row", "docx_table_row", "pptx_slide_table_row")
KNOWN_UNITS = (
    "text", "markdown_section", "json_value", "notebook_cell", "notebook_output", "image_ocr_text", "table_header", "table_row",
    "docx_heading", "docx_paragraph", "docx_list_item", "docx_table", "docx_table_row",
    "pptx_slide_title", "pptx_slide_text", "pptx_speaker_notes", "pptx_slide_table", "pptx_slide_table_row",
    "pdf_page_text", "pdf_page_ocr", "xlsx_workbook_summary", "xlsx_sheet_summary", "xlsx_table_rows",
)
CHUNK_ISSUES = ("source_document_has_no_units", "empty_source_unit_skipped", "fallback_chunking_used", "table_metadata_missing", "chunk_limit_violation")
SEVERITIES = ("error", "warning", "info")

DETAILS = "source_locator string, split_index int, split_count int, original_unit_characters int, start_character int, end_character int, start_row long, end_row long, row_count int, delimiter string, headers array<string>"
GROUP_SCHEMA = "path string, anchor int, position int, unit_indices array<int>, start_row long, end_row long, row_count int, body string"


def string_list(metadata: Column, key: str) -> Column:
    """The strings at ``key`` of a JSON object; null unless all of a list are strings."""
    value = F.try_variant_get(F.try_parse_json(metadata), f"$.{key}", "variant")
    items = F.try_variant_get(value, "$", "array<string>")
    return F.when(F.schema_of_variant(value).isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(items, lambda x: x.isNull()), items)


def string_value(metadata: Column, key: str) -> Column:
    """The string at ``key`` of a JSON object; null for other types."""
    value = F.try_variant_get(F.try_parse_json(metadata), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _details(**known: Column) -> Column:
    fields = [f.split() for f in DETAILS.split(", ")]
    return F.struct(*[known.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])


def table_blocks(units: DataFrame) -> DataFrame:
    """Table units with ``anchor``, the unit_index of their header; null for rows without one.

    In delimited text every row belongs to the document's first header; elsewhere
    a block is a header and the rows that follow it without a gap.
    """
    head, row = F.col("unit_type").isin(*TABLE_HEADERS), F.col("unit_type").isin(*TABLE_ROWS)
    tables = units.filter(head | row)
    delimited = F.col("parser") == "delimited_text"
    order = Window.partitionBy("path").orderBy("unit_index")
    opens = head | ~F.coalesce(F.lag("unit_index").over(order) + 1 == F.col("unit_index"), F.lit(False))
    office = tables.filter(~delimited).withColumn("opens", opens)
    first = F.last(F.when(F.col("opens"), F.struct(head.alias("head"), F.col("unit_index").alias("at"))), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    office = office.withColumn("first", first).select(*units.columns, F.when(F.col("first.head"), F.col("first.at")).alias("anchor"))
    first_heads = tables.filter(delimited & head).groupBy("path").agg(F.min("unit_index").alias("anchor"))
    return office.unionByName(tables.filter(delimited).join(first_heads, "path", "left").select(*units.columns, "anchor"))


def pack_rows(rows: DataFrame, most: int, size: int) -> DataFrame:
    """Groups of rows (path, anchor, unit_index, row_number, line, head_size): closed at ``size`` rows or before ``most`` characters are passed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, group, held, position = None, [], 0, 0
        out: list[tuple] = []

        def close() -> None:
            nonlocal group, held, position
            if group:
                out.append((*table, position, [g[0] for g in group], group[0][1], group[-1][1], len(group), "\n".join(g[2] for g in group)))
                position += 1
            group, held = [], 0

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=[f.split()[0] for f in GROUP_SCHEMA.split(", ")])

        for batch in batches:
            for path, anchor, index, number, line, head in zip(*(c.to_pylist() for c in batch.columns)):
                if (path, anchor) != table:
                    close()
                    table, position = (path, anchor), 0
                if group and (len(group) >= size or head + held + 1 + len(line) > most):
                    close()
                group.append((index, number, line))
                held += 1 + len(line)
                if len(out) >= 1000:
                    yield batch_of(out)
                    out = []
        close()
        if out:
            yield batch_of(out)

    ordered = rows.repartition("path", "anchor").sortWithinPartitions("path", "anchor", "unit_index")
    return ordered.select("path", "anchor", "unit_index", "row_number", "line", "head_size").mapInArrow(run, GROUP_SCHEMA)


def chunk_units(documents: DataFrame, units: DataFrame, *, most: int = 4000, overlap: int = 200, table_rows: int = 25) -> tuple[DataFrame, DataFrame]:
    """Chunks and issues of ``documents`` (path, parser) and their ``units`` (path, parser, unit_index, unit_type, text, locator, metadata as JSON).

    Chunks: path, parser, chunk_index, unit_type, text, locator,
    source_unit_indices, metadata (the unit's), details, chunk_id.  Issues: path,
    parser, issue, severity, unit_index, locator.
    """
    if table_rows <= 0:
        raise ValueError("table_rows must be positive")
    units = units.select("path", "parser", "unit_index", "unit_type", "text", "locator", "metadata")
    blocks = table_blocks(units)
    is_head = F.col("unit_index") == F.col("anchor")
    number, values = whole_number(F.col("metadata"), "logical_row_number"), string_list(F.col("metadata"), "values")
    head_row = F.col("unit_type").isin(*TABLE_HEADERS)
    anchored = blocks.filter(F.col("anchor").isNotNull())
    heads = anchored.filter(is_head).select("path", "anchor", "parser", F.col("unit_type").alias("head_type"), F.col("text").alias("head_text"), F.col("locator").alias("head_locator"), F.col("metadata").alias("head_metadata"), string_list(F.col("metadata"), "headers").alias("headers"), F.coalesce(string_value(F.col("metadata"), "delimiter"), F.lit("")).alias("delimiter"))
    good = F.coalesce(values.isNotNull() & (number > 0), F.lit(False))
    checked = anchored.groupBy("path", "anchor").agg(F.count_if(~head_row).alias("n_rows"), F.bool_and(head_row | good).alias("sound"))
    tables = heads.join(checked, ["path", "anchor"])
    sound = tables.filter(F.col("sound") & F.col("headers").isNotNull())
    head_line = F.concat(F.lit("列: "), F.array_join("headers", " | "))

    # Packed rows.
    line = F.concat(F.lit("行"), number, F.lit(": "), F.array_join(values, " | "))
    rows = anchored.filter(~head_row).join(sound.select("path", "anchor", F.length(head_line).alias("head_size")), ["path", "anchor"])
    groups = pack_rows(rows.select("path", "anchor", "unit_index", number.alias("row_number"), line.alias("line"), "head_size"), most, table_rows)
    groups = groups.join(sound, ["path", "anchor"]).withColumn("whole", F.concat_ws("\n", head_line, "body"))
    span = F.concat(F.lit("row:"), F.col("start_row"), F.lit("-"), F.col("end_row"))
    place = F.when((F.col("head_type") == "table_header") | F.col("head_locator").isNull(), span).otherwise(F.concat("head_locator", F.lit("/"), span))
    cut = groups.withColumn("segments", split_segments(F.col("whole"), most, overlap)).select("*", F.posexplode("segments").alias("split_index", "s"))
    was_cut = F.length("whole") > most
    packed = cut.select(
        "path", "parser", F.col("anchor").alias("order_unit"), F.col("position").alias("order_group"), "split_index", F.lit("table_rows").alias("unit_type"),
        F.substring("whole", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("text"), place.alias("locator"), F.concat(F.array("anchor"), F.col("unit_indices")).alias("source_unit_indices"), F.lit(None).cast("string").alias("metadata"),
        _details(source_locator=F.col("head_locator"), split_index=F.when(was_cut, F.col("split_index")), split_count=F.when(was_cut, F.size("segments")), original_unit_characters=F.when(was_cut, F.length("whole")), start_row=F.col("start_row"), end_row=F.col("end_row"), row_count=F.col("row_count"), delimiter=F.col("delimiter"), headers=F.col("headers")).alias("details"),
    )

    # Headers without rows.
    delimited = F.col("parser") == "delimited_text"
    bare = sound.filter("n_rows = 0").select(
        "path", "parser", F.col("anchor").alias("order_unit"), F.lit(0).alias("order_group"), F.lit(0).alias("split_index"), F.lit("table_rows").alias("unit_type"),
        F.when(delimited, head_line).otherwise(F.col("head_text")).alias("text"), F.col("head_locator").alias("locator"), F.array("anchor").alias("source_unit_indices"), F.when(~delimited, F.col("head_metadata")).alias("metadata"),
        _details(source_locator=F.col("head_locator"), start_row=F.lit(1), end_row=F.lit(1), row_count=F.lit(0), delimiter=F.col("delimiter"), headers=F.col("headers")).alias("details"),
    )

    # Units on their own: no table units, rows without a header, and unsound tables.
    unsound = blocks.join(sound.select("path", "anchor"), ["path", "anchor"], "left_anti").select(*units.columns)
    plain = units.filter(~F.col("unit_type").isin(*TABLE_HEADERS, *TABLE_ROWS) & ~delimited)
    single = plain.unionByName(unsound)
    filled = single.filter(F.col("text") != "")
    whole_block = F.col("unit_type") == "xlsx_table_rows"
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), F.length("text").alias("end")))
    kept = filled.filter(whole_block).withColumn("segments", all_of_it).unionByName(filled.filter(~whole_block).withColumn("segments", split_segments(F.col("text"), most, overlap)))
    cut = kept.select("*", F.posexplode("segments").alias("split_index", "s"))
    lines = F.concat(F.lit("line:"), line_number(F.col("text"), F.col("s.start")), F.lit("-"), line_number(F.col("text"), F.col("s.end")))
    own = cut.select(
        "path", "parser", F.col("unit_index").alias("order_unit"), F.lit(0).alias("order_group"), "split_index", "unit_type",
        F.substring("text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("text"), F.coalesce("locator", F.when(F.col("unit_type") == "text", lines)).alias("locator"), F.array("unit_index").alias("source_unit_indices"), "metadata",
        _details(source_locator=F.col("locator"), split_index=F.col("split_index"), split_count=F.size("segments"), original_unit_characters=F.length("text"), start_character=F.col("s.start"), end_character=F.col("s.end")).alias("details"),
    )

    raw = packed.unionByName(bare).unionByName(own)
    order = Window.partitionBy("path").orderBy("order_unit", "order_group", "split_index")
    chunks = raw.withColumn("chunk_index", (F.row_number().over(order) - 1).cast("int"))
    ident = chunk_id(F.col("chunk_index"), F.col("locator"), F.col("parser"), F.col("path"), F.col("source_unit_indices"), F.col("text"), F.col("unit_type"))
    chunks = chunks.withColumn("chunk_id", ident).select("path", "parser", "chunk_index", "unit_type", "text", "locator", "source_unit_indices", "metadata", "details", "chunk_id")

    def issues(rows: DataFrame, issue: str, severity: str, at: Column, locator: Column) -> DataFrame:
        return rows.select("path", "parser", F.lit(issue).alias("issue"), F.lit(severity).alias("severity"), at.cast("int").alias("unit_index"), locator.cast("string").alias("locator"))

    at, locator, none = F.col("unit_index"), F.col("locator"), F.lit(None)
    found = issues(documents.join(units.select("path").distinct(), "path", "left_anti"), CHUNK_ISSUES[0], "info", none, none)
    found = found.unionByName(issues(single.filter(F.col("text") == ""), CHUNK_ISSUES[1], "info", at, locator))
    found = found.unionByName(issues(filled.filter(~F.col("unit_type").isin(*KNOWN_UNITS)), CHUNK_ISSUES[2], "info", at, locator))
    found = found.unionByName(issues(unsound, CHUNK_ISSUES[3], "warning", at, locator))
    found = found.unionByName(issues(raw.filter(F.length("text") > most), CHUNK_ISSUES[4], "error", F.get("source_unit_indices", F.lit(0)), locator))
    return chunks, found


def zero_filled(counted: DataFrame, key: str, keys: tuple[str, ...]) -> DataFrame:
    """``key, n`` of every one of ``keys``, 0 where ``counted`` (any rows with ``key``) has none."""
    known = counted.sparkSession.createDataFrame([(k,) for k in keys], f"{key} string")
    return known.join(counted.groupBy(key).agg(F.count("*").alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def _sizes(rows: DataFrame, prefix: str, *by: str) -> DataFrame:
    n = F.length("text").cast("long")
    most = [F.max(n).alias("maximum_chunk_characters")] if prefix == "chunk" else []
    count = "source_units" if prefix == "source" else "generated_chunks"
    return rows.groupBy(*by).agg(F.count("*").alias(count), F.sum(n).alias(f"{prefix}_characters"), *most)


def chunk_summary_by(units: DataFrame, chunks: DataFrame, by: str) -> DataFrame:
    """Units, characters and chunks by ``by`` ("parser" or "unit_type"), with the keys of both sides."""
    both = _sizes(units, "source", by).join(_sizes(chunks, "chunk", by), by, "full")
    return both.select(by, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("source_units", "source_characters", "generated_chunks", "chunk_characters", "maximum_chunk_characters")])


def chunk_summary(documents: DataFrame, units: DataFrame, chunks: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: counts and characters of both sides, their relation, and issues by severity and type, zeros included."""
    source, made = _sizes(units, "source"), _sizes(chunks, "chunk")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    counted = issues.agg(F.count("*").alias("total_issues"), *[F.count_if(F.col("severity") == s).alias(f"{s}_issues") for s in SEVERITIES], *[F.count_if(F.col("issue") == i).alias(i) for i in CHUNK_ISSUES])
    one = documents.agg(F.count("*").alias("source_documents")).join(source).join(made).join(counted)  # four rows of one each
    rate = F.when(zero("source_characters") == 0, 0.0).otherwise(1 - zero("chunk_characters") / F.col("source_characters"))
    mean = F.when(F.col("generated_chunks") == 0, 0.0).otherwise(zero("chunk_characters") / F.col("generated_chunks"))
    return one.select(
        "source_documents", "source_units", zero("source_characters").alias("source_characters"), "generated_chunks", zero("chunk_characters").alias("chunk_characters"), zero("maximum_chunk_characters").alias("maximum_chunk_characters"),
        F.round(mean, 9).alias("average_chunk_characters"), F.round(rate, 9).alias("character_reduction_rate"), "total_issues", *[f"{s}_issues" for s in SEVERITIES], *CHUNK_ISSUES,
    )
