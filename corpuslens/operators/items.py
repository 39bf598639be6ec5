"""Units and issues from the rows that format libraries deliver: pages, document items, slides, OCR regions.

The libraries themselves are plug-ins; everything behind their rows is columns
and windows.  Running windows only look back, so no document is held whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.text import visible_length
from corpuslens.operators.search import by_key

# Labels of items, thresholds of pages, documents and regions, image limits (fixed values).
HEADINGS = ("section_header", "title", "heading")
LISTS = ("list_item",)
TABLES = ("table",)
PAGE_TEXT, PDF_TEXT, SLIDES_TEXT, IMAGE_RATIO = 20, 50, 20, 0.8
MIN_CONFIDENCE, LOW_CONFIDENCE, MIN_IMAGE_TEXT, MOST_REGIONS = 0.20, 0.50, 2, 500
MOST_PIXELS, RENDER_DPI = 40_000_000, 200
ISSUE_COLUMNS = ("path", "issue", "locator")
SPACE = r"(?U)\A\s+|\s+\z"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, "")


def pdf_text(text: Column) -> Column:
    """Page text: unified line ends, no NUL, no blanks at line ends, at most one empty line in a row, stripped."""
    lines = F.replace(F.regexp_replace(text, r"\r\n?", "\n"), F.lit("\0"), F.lit(""))
    return stripped(F.regexp_replace(F.regexp_replace(lines, r"(?U)[^\S\n]+(?=\n|\z)", ""), r"\n{3,}", "\n\n"))


def ocr_text(text: Column) -> Column:
    """Recognised text: unified line ends, no NUL, stripped."""
    return stripped(F.replace(F.regexp_replace(text, r"\r\n?", "\n"), F.lit("\0"), F.lit("")))


def safe_message(message: Column, path: Column) -> Column:
    """An error message without the file's own path, and of at most 500 characters."""
    masked = F.replace(F.replace(message, path, F.lit("<source>")), F.replace(path, F.lit("\\"), F.lit("\\\\")), F.lit("<source>"))
    return F.when(F.length(masked) > 500, F.concat(F.substring(masked, 1, 500), F.lit("..."))).otherwise(masked)


def header_flags(content: Column) -> tuple[Column, Column]:
    """Whether bytes have a PDF header in their first 1,024 and an end mark in their last 4,096."""
    has = lambda part, mark: F.instr(F.decode(part, "ISO-8859-1"), mark) > 0
    tail = F.substring(content, F.greatest(F.length(content) - 4095, F.lit(1)), F.lit(4096))
    return has(F.substring(content, F.lit(1), F.lit(1024)), "%PDF-"), has(tail, "%%EOF")


def pdf_units(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units and issues of PDF pages (path, page_number, text, error_type).

    A page of fewer than 20 visible characters needs OCR; documents have issues
    by their visible characters and by the share of such pages.
    """
    read = pages.withColumn("text", pdf_text(F.coalesce("text", F.lit("")))).withColumn("visible", visible_length(F.col("text"))).withColumn("needs_ocr", F.col("visible") < PAGE_TEXT)
    read = read.withColumn("locator", F.concat(F.lit("page:"), F.col("page_number")))
    units = read.filter("visible > 0").select("path", F.lit("pdf_page_text").alias("unit_type"), "text", "locator", "page_number", F.col("visible").alias("text_characters"), "needs_ocr")
    by_page = F.filter(F.array(F.when(F.col("error_type").isNotNull(), F.lit("pdf_page_extraction_failed")), F.when(F.col("needs_ocr"), F.lit("pdf_page_needs_ocr"))), lambda i: i.isNotNull())
    found = read.select("path", F.explode(by_page).alias("issue"), "locator")
    n, needing, visible = F.col("n"), F.col("needing"), F.col("visible")
    rules = F.array(
        F.when(visible == 0, F.lit("document_has_no_text")).when(visible < PDF_TEXT, F.lit("low_text_content")),
        F.when(needing / n >= IMAGE_RATIO, F.lit("image_dominant_document")),
        F.when((needing > 0) & (needing < n), F.lit("pdf_partially_needs_ocr")),
    )
    whole = read.groupBy("path").agg(F.count("*").alias("n"), F.count_if("needs_ocr").alias("needing"), F.sum("visible").alias("visible"))
    whole = whole.select("path", F.explode(F.filter(rules, lambda i: i.isNotNull())).alias("issue"), F.lit(None).cast("string").alias("locator"))
    return units, found.unionByName(whole)


def _unit(sub_index: Column, unit_type: Column | str, text: Column, locator: Column, headers: Column | None = None, values: Column | None = None, row: Column | None = None) -> Column:
    none = F.lit(None)
    lists = [(none if c is None else c).cast("array<string>").alias(n) for c, n in ((headers, "headers"), (values, "values"))]
    kind = F.lit(unit_type) if isinstance(unit_type, str) else unit_type
    return F.struct(sub_index.cast("int").alias("sub_index"), kind.alias("unit_type"), text.alias("text"), locator.alias("locator"), *lists, (none if row is None else row).cast("int").alias("logical_row_number"))


def _table_units(unit_type: str, place: Column) -> Column:
    """A table item's own unit and one for each of its rows but the first, which names the columns."""
    data = F.coalesce("table_data", F.array().cast("array<array<string>>"))
    headers = F.coalesce(F.get(data, F.lit(0)), F.array().cast("array<string>"))
    named = F.size(headers) > 0
    body = F.when(named, F.slice(data, F.lit(2), F.size(data))).otherwise(data)
    shown = F.transform(body, lambda cells, at: F.struct((at + F.when(named, 2).otherwise(1)).alias("row"), cells.alias("cells"), F.transform(cells, stripped).alias("shown")))

    def unit(r: Column) -> Column:
        line = F.concat(F.lit("行"), r["row"], F.lit(": "), F.array_join(r["shown"], " | "))
        text = F.when(named, F.concat(F.lit("列: "), F.array_join(headers, " | "), F.lit("\n"), line)).otherwise(line)
        return _unit(r["row"], f"{unit_type}_row", text, F.concat(place, F.lit("/row:"), r["row"]), headers, r["cells"], r["row"])

    filled = F.filter(shown, lambda r: F.exists(r["shown"], lambda v: v != ""))
    return F.concat(F.array(_unit(F.lit(0), unit_type, F.col("text"), place, headers)), F.transform(filled, unit))


def _exploded(routed: DataFrame, keep: list[str], is_table: Column, text_unit: Column, table_units: Column) -> DataFrame:
    """Units of items with text; one pass, as windows behind two branches would run twice."""
    made = F.when(is_table, table_units).otherwise(F.array(text_unit))
    return routed.filter(F.col("text") != "").select(*keep, F.explode(made).alias("u")).select(*keep, "u.*")


def heading_paths(items: DataFrame, levels: int = 9) -> DataFrame:
    """Items (path, item_index, label, text, level) with ``heading_path``: for each level the last heading that none of its or a lower level has ended.

    A heading without text ends others but names nothing; one without a level
    changes nothing.  Levels beyond ``levels`` raise.
    """
    so_far = Window.partitionBy("path").orderBy("item_index").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.lower("label").isin(*HEADINGS) & F.col("level").isNotNull()
    checked = F.when(F.col("level").between(1, levels), F.col("level")).otherwise(F.raise_error(F.concat(F.lit("heading level "), F.col("level"))).cast("int"))
    level = F.when(heading, checked)
    last, found = [], []
    for n in range(1, levels + 1):
        name = F.when(F.col("text") != "", F.col("text"))
        last.append(F.last(F.when(level == n, F.struct(F.col("item_index").alias("at"), name.alias("name"))), ignorenulls=True).over(so_far).alias(f"_last{n}"))
    items = items.select("*", *last)
    ats = [F.col(f"_last{n}.at") for n in range(1, levels + 1)]
    for n in range(1, levels + 1):
        ended = F.greatest(*ats[:n]) if n > 1 else ats[0]
        found.append(F.when(ats[n - 1] == ended, F.col(f"_last{n}.name")))
    items = items.withColumn("heading_path", F.filter(F.array(*found), lambda t: t.isNotNull()))
    return items.drop(*[f"_last{n}" for n in range(1, levels + 1)])


def docx_units(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units and issues of word-processor items (path, item_index, label, text, level, table_data)."""
    items = by_key(items.withColumn("text", stripped(F.coalesce("text", F.lit("")))), "path")
    is_table = F.col("table_data").isNotNull() | F.lower("label").isin(*TABLES)
    is_heading = F.lower("label").isin(*HEADINGS)
    before = Window.partitionBy("path").orderBy("item_index").rowsBetween(Window.unboundedPreceding, 0)
    routed = heading_paths(items).withColumn("table_index", F.sum(F.when(is_table & ~is_heading, 1).otherwise(0)).over(before))
    keep = ["path", "item_index", "heading_path"]
    kind = F.when(is_heading, "docx_heading").when(F.lower("label").isin(*LISTS), "docx_list_item").otherwise("docx_paragraph")
    text_unit = _unit(F.lit(0), kind, F.col("text"), F.concat(F.lit("item:"), F.col("item_index")))
    units = _exploded(routed, keep, is_table & ~is_heading, text_unit, _table_units("docx_table", F.concat(F.lit("table:"), F.col("table_index"))))
    return units, _no_text(items, units)


def pptx_units(items: DataFrame, pictures: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Units and issues of slide items (path, item_index, label, text, slide, table_data); ``pictures`` has path and picture_count."""
    items = items.withColumn("text", stripped(F.coalesce("text", F.lit(""))))
    is_table = F.col("table_data").isNotNull() | F.lower("label").isin(*TABLES)
    is_title = F.lower("label").isin(*HEADINGS) & ~is_table & (F.col("text") != "")
    slide = Window.partitionBy("path", "slide_key").orderBy("item_index")
    earlier = F.last(F.when(is_title & F.col("slide").isNotNull(), F.col("text")), ignorenulls=True).over(slide.rowsBetween(Window.unboundedPreceding, -1))
    keyed = by_key(items.withColumn("slide_key", F.coalesce("slide", F.lit(0))), "path", "slide_key")
    routed = keyed.withColumn("slide_title", F.when(is_title, F.col("text")).otherwise(earlier))
    routed = routed.withColumn("table_index", F.sum(F.when(is_table, 1).otherwise(0)).over(slide.rowsBetween(Window.unboundedPreceding, 0)))
    on_slide = lambda c: F.when(F.col("slide").isNull(), c).otherwise(F.concat(F.lit("slide:"), F.col("slide"), F.lit("/"), c))
    keep = ["path", "item_index", "slide", "slide_title"]
    text_unit = _unit(F.lit(0), F.when(is_title, "pptx_slide_title").otherwise("pptx_slide_text"), F.col("text"), on_slide(F.concat(F.lit("item:"), F.col("item_index"))))
    units = _exploded(routed, keep, is_table, text_unit, _table_units("pptx_slide_table", on_slide(F.concat(F.lit("table:"), F.col("table_index")))))
    seen = items.select("path").distinct().join(units.groupBy("path").agg(F.sum(visible_length(F.col("text"))).alias("visible")), "path", "left")
    seen = seen.join(pictures.select("path", "picture_count"), "path", "left") if pictures is not None else seen.withColumn("picture_count", F.lit(0))
    visible = F.coalesce("visible", F.lit(0))
    rules = F.array(F.when(visible == 0, F.lit("document_has_no_text")).when(visible < SLIDES_TEXT, F.lit("low_text_content")), F.when((F.coalesce("picture_count", F.lit(0)) > 0) & (visible < SLIDES_TEXT), F.lit("image_dominant_document")))
    return units, seen.select("path", F.explode(F.filter(rules, lambda i: i.isNotNull())).alias("issue"), F.lit(None).cast("string").alias("locator"))


def _no_text(items: DataFrame, units: DataFrame) -> DataFrame:
    texts = units.filter(visible_length(F.col("text")) > 0).select("path").distinct()
    return items.select("path").distinct().join(texts, "path", "left_anti").select("path", F.lit("document_has_no_text").alias("issue"), F.lit(None).cast("string").alias("locator"))


def region_boxes(raw: DataFrame) -> DataFrame:
    """Boxes of OCR polygons (points as array of x, y pairs) in pixels and as shares of (width, height); confidence within 0 and 1."""
    side = lambda f, k: f(F.transform("polygon", lambda p: p[k].cast("double")))
    share = lambda v, size: F.when(size > 0, F.least(F.greatest(v / size, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    boxed = raw.withColumn("x0", side(F.array_min, 0)).withColumn("y0", side(F.array_min, 1)).withColumn("x1", side(F.array_max, 0)).withColumn("y1", side(F.array_max, 1))
    for c, size in (("x0", "width"), ("y0", "height"), ("x1", "width"), ("y1", "height")):
        boxed = boxed.withColumn(f"{c}_share", share(F.col(c), F.col(size)))
    return boxed.withColumn("confidence", F.least(F.greatest("confidence", F.lit(0.0)), F.lit(1.0)))


def ocr_units(regions: DataFrame, *, unit_type: str = "image_ocr_text") -> tuple[DataFrame, DataFrame]:
    """Units and issues of ordered OCR regions (path, locator, position, text, confidence).

    Regions below 0.20 are left out.  An image with fewer than two characters of
    text has none; metadata keeps the first 500 regions.
    """
    read = regions.withColumn("text", ocr_text(F.coalesce("text", F.lit(""))))
    kept = (F.col("text") != "") & (F.col("confidence") >= MIN_CONFIDENCE)
    entry = F.when(kept, F.struct("position", "text", "confidence"))
    # Decimal sums are the same in any order; a mean at the threshold must not depend on it.
    exact = F.when(kept, F.col("confidence").try_cast("decimal(20,15)"))
    mean = F.when(F.count(exact) == F.count(entry), F.try_divide(F.sum(exact).cast("double"), F.count(exact))).otherwise(F.avg(F.when(kept, F.col("confidence"))))
    image = read.groupBy("path", "locator").agg(
        F.array_sort(F.collect_list(entry)).alias("kept"), F.count("*").alias("recognized_region_count"), F.count_if((F.col("text") != "") & ~kept).alias("excluded_low_confidence_region_count"),
        mean.alias("mean_confidence"), F.min(F.when(kept, F.col("confidence"))).alias("minimum_confidence"), F.max(F.when(kept, F.col("confidence"))).alias("maximum_confidence"),
    )
    text = F.array_join(F.transform("kept", lambda r, i: F.concat(F.lit("領域"), i + 1, F.lit(": "), r["text"])), "\n")
    image = image.withColumn("text", text).withColumn("included_region_count", F.size("kept").cast("long"))
    enough = F.length("text") >= MIN_IMAGE_TEXT
    units = image.filter(enough).select("path", F.lit(unit_type).alias("unit_type"), "text", "locator", "recognized_region_count", "included_region_count", "excluded_low_confidence_region_count", "mean_confidence", "minimum_confidence", "maximum_confidence", F.length("text").alias("ocr_text_characters"), F.slice("kept", 1, MOST_REGIONS).alias("regions"))
    rules = F.array(F.when(~enough, F.lit("ocr_no_text")), F.when(enough & (F.col("mean_confidence") < LOW_CONFIDENCE), F.lit("ocr_low_confidence")), F.when(enough & (F.size("kept") > MOST_REGIONS), F.lit("ocr_region_metadata_truncated")))
    return units, image.select("path", F.explode(F.filter(rules, lambda i: i.isNotNull())).alias("issue"), "locator")


def image_issue(kind: Column, width: Column, height: Column) -> Column:
    """Why an image is not read, null where it is: its format, its sides, its pixels."""
    return F.when(~F.coalesce(F.upper(kind) == "PNG", F.lit(False)), "image_unreadable").when((width <= 0) | (height <= 0), "image_invalid_dimensions").when(width.cast("long") * height > MOST_PIXELS, "image_pixel_limit_exceeded")


def render_scale(dpi: int = RENDER_DPI) -> float:
    """Scale at which a page of 72 points an inch is rendered."""
    if dpi <= 0:
        raise ValueError("dpi must be positive")
    return dpi / 72


def markdown_table(text: Column) -> Column:
    """Rows of cells of a Markdown table; separator rows are dropped, other lines too."""
    lines = F.filter(F.transform(F.split(text, "\n"), stripped), lambda line: line.startswith("|"))
    cells = F.transform(lines, lambda line: F.transform(F.split(F.regexp_replace(line, r"\A\||\|\z", ""), r"\|"), stripped))
    return F.filter(cells, lambda row: ~F.forall(row, lambda c: c.rlike(r"\A:?-{3,}:?\z")))


def as_markdown(rows: Column) -> Column:
    """A Markdown table's text of rows of cells: ``| a | b |`` a line."""
    return F.array_join(F.transform(rows, lambda row: F.concat(F.lit("| "), F.array_join(row, " | "), F.lit(" |"))), "\n")


def table_value(text: Column) -> Column:
    """Cell text that keeps to one line and column of a table."""
    return F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" / "))


def plain_number(value: Column) -> Column:
    """A double as digits without exponent or trailing zeros; ``NaN`` and ``Infinity`` by name, no negative zero."""
    digits = value.cast("decimal(38,15)").cast("string")
    trimmed = F.when(digits.contains("."), F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", "")).otherwise(digits)
    return F.when(F.isnan(value), "NaN").when(value == float("inf"), "Infinity").when(value == float("-inf"), "-Infinity").when(value == 0, "0").otherwise(trimmed)


def pdf_records(files: DataFrame) -> DataFrame:
    """``path, size, header, eof`` of files (path, content): what a PDF diagnosis needs from the bytes alone."""
    header, eof = header_flags(F.col("content"))
    return files.select("path", F.length("content").cast("long").alias("size"), header.alias("header"), eof.alias("eof"))
