"""Workbooks (OOXML spreadsheets) with the standard library: container checks, cells, row blocks, summaries.

A workbook is one file and one task's work; cells stream out of the sheet XML,
so a task holds one region of a sheet and never the parsed document.
"""

from __future__ import annotations

import hashlib
import io
import math
import posixpath
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, time, timedelta
from decimal import Decimal
from xml.etree import ElementTree

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of containers, blocks and sheets, and cell formats of dates (fixed values).
MAX_UNCOMPRESSED, MAX_RATIO, MAX_METADATA_FILE = 2_000_000_000, 1000.0, 20_000_000
ROWS, COLUMNS, CHARACTERS, CELLS = 25, 20, 4_000, 500
LARGE_SHEET, WIDE_SHEET, LARGE_CELL = 10_000, 100, 4_000
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}

_CELL = re.compile(r"([A-Z]+)(\d+)")


class WorkbookError(ValueError):
    """A workbook that cannot be read; ``issue`` names why."""

    def __init__(self, issue: str, message: str):
        super().__init__(message)
        self.issue = issue


@dataclass(frozen=True)
class Issue:
    """Something that extraction noticed."""

    issue: str
    message: str
    locator: str | None = None
    metadata: dict = field(default_factory=dict)


# --- A1 notation


def letters(column: int) -> str:
    """Letters of a column number, from 1."""
    out = ""
    while column > 0:
        column, rest = divmod(column - 1, 26)
        out = chr(ord("A") + rest) + out
    return out


def number(column: str) -> int:
    """Column number of letters; what follows the letters is ignored."""
    n = 0
    for c in re.match(r"[A-Z]*", column.upper())[0]:
        n = n * 26 + ord(c) - ord("A") + 1
    return n


def bounds(area: str) -> tuple[int, int, int, int] | None:
    """First column and row, last column and row of ``A1:B2`` or ``A1``; null for anything else."""
    parts = [_CELL.fullmatch(p) for p in area.split(":")]
    if not 1 <= len(parts) <= 2 or not all(parts):
        return None
    (a, z) = (parts[0], parts[-1])
    return number(a[1]), int(a[2]), number(z[1]), int(z[2])


def meet(a: tuple[int, int, int, int], b: tuple[int, int, int, int] | None) -> bool:
    return b is not None and a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]


def column_number(text: Column) -> Column:
    """``number`` as a column expression."""
    chars = F.split(F.regexp_extract(F.upper(text), r"\A[A-Z]*", 0), "")
    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0).cast("long"), lambda n, c: n * 26 + (F.ascii(c) - 64))


def column_letters(column: Column) -> Column:
    """``letters`` as a column expression; fourteen steps suffice for every long."""

    def step(a: Column, _: Column) -> Column:
        at = F.greatest(a["rest"] - 1, F.lit(0))
        letter = F.when(a["rest"] > 0, F.char(F.lit(65) + F.pmod(at, F.lit(26)))).otherwise("")
        rest = F.when(a["rest"] > 0, F.call_function("div", at, F.lit(26))).otherwise(F.lit(0).cast("long"))
        return F.struct(rest.alias("rest"), F.concat(letter, a["out"]).alias("out"))

    start = F.struct(column.cast("long").alias("rest"), F.lit("").alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, step, lambda a: a["out"])


# --- cell text


def clean(text: str) -> str:
    return text.replace("\r\n", "\n").replace("\r", "\n").replace("\0", "").strip()


def plain_decimal(value: Decimal) -> str:
    """Digits without exponent or trailing zeros; no negative zero."""
    if not value.is_finite():
        return "NaN" if value.is_nan() else "Infinity" if value > 0 else "-Infinity"
    text = format(value, "f")
    text = text.rstrip("0").rstrip(".") if "." in text else text
    return "0" if text == "-0" else text


def cell_text(value: object) -> str:
    """Text of a cell's value."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return plain_decimal(Decimal(repr(value))) if math.isfinite(value) else plain_decimal(Decimal(value))
    if isinstance(value, Decimal):
        return plain_decimal(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value) if isinstance(value, int) else clean(str(value))


def formula_text(value: object, formula: str) -> str:
    """A formula cell's stored value and formula."""
    shown = cell_text(value)
    return f"{shown} (formula: {clean(formula)})" if shown else f"formula: {clean(formula)}"


def escaped(text: str) -> str:
    """Cell text for one line of a table."""
    return text.replace("|", "\\|").replace("\n", " / ")


# --- container


def check(content: bytes) -> dict:
    """Sizes of a sound container; raises ``WorkbookError`` from the directory alone, before anything is inflated."""
    if not content:
        raise WorkbookError("xlsx_not_ooxml", "empty file")
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as box:
            members = box.infolist()
    except zipfile.BadZipFile as error:
        raise WorkbookError("xlsx_zip_unreadable", "not a ZIP file") from error
    if not {"[Content_Types].xml", "xl/workbook.xml"} <= {m.filename for m in members}:
        raise WorkbookError("xlsx_not_ooxml", "a required member is absent")
    whole, packed = sum(m.file_size for m in members), sum(m.compress_size for m in members)
    if whole > MAX_UNCOMPRESSED:
        raise WorkbookError("xlsx_uncompressed_size_limit_exceeded", "too large when inflated")
    if whole / max(packed, 1) > MAX_RATIO:
        raise WorkbookError("xlsx_compression_ratio_limit_exceeded", "compressed too strongly")
    return {"zip_uncompressed_bytes": whole, "zip_compressed_bytes": packed, "zip_compression_ratio": whole / max(packed, 1)}


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _attribute(node: ElementTree.Element, name: str) -> str | None:
    return next((v for k, v in node.attrib.items() if _local(k) == name), None)


@dataclass
class Sheet:
    """A sheet's name, state, place in the container, and what its XML says besides cells."""

    name: str
    index: int
    state: str
    member: str
    declared: str = "A1:A1"
    merged: list[str] = field(default_factory=list)
    tables: list[dict] = field(default_factory=list)
    hidden_rows: list[int] = field(default_factory=list)
    hidden_columns: list[int] = field(default_factory=list)


@dataclass(frozen=True)
class Cell:
    row: int
    column: int
    value: object
    formula: str | None

    @property
    def text(self) -> str:
        return cell_text(self.value) if self.formula is None else formula_text(self.value, self.formula)


class Workbook:
    """Sheets and cells of an OOXML container."""

    def __init__(self, content: bytes):
        self.sizes = check(content)
        self.box = zipfile.ZipFile(io.BytesIO(content))
        self.limited = len(content) > MAX_METADATA_FILE
        self.members = set(self.box.namelist())
        root = self._xml("xl/workbook.xml")
        links = self._links("xl/workbook.xml")
        nodes = {_local(n.tag): n for n in root}
        self.base = datetime(1904, 1, 1) if "workbookPr" in nodes and nodes["workbookPr"].get("date1904") in ("1", "true") else datetime(1899, 12, 30)
        self.sheets = [Sheet(n.get("name", ""), i, n.get("state", "visible"), links.get(_attribute(n, "id") or "", "")) for i, n in enumerate(nodes.get("sheets", ()), start=1)]
        self.sheets = [s for s in self.sheets if s.member in self.members]
        self.names = [] if self.limited else sorted(self._defined(nodes.get("definedNames", ())), key=lambda d: (d["defined_name"], d["destination_sheet"] or ""))
        self.strings = self._strings()
        self.dates = self._date_styles()

    def _xml(self, member: str) -> ElementTree.Element:
        return ElementTree.fromstring(self.box.read(member))

    def _links(self, member: str) -> dict[str, str]:
        folder, name = posixpath.split(member)
        links = f"{folder}/_rels/{name}.rels"
        if links not in self.members:
            return {}
        resolve = lambda t: t.lstrip("/") if t.startswith("/") else posixpath.normpath(posixpath.join(folder, t))
        return {n.get("Id", ""): resolve(n.get("Target", "")) for n in self._xml(links)}

    @staticmethod
    def _defined(nodes) -> Iterator[dict]:
        for n in nodes:
            places = re.findall(r"(?:'((?:[^']|'')+)'|([^',!]+))!([^,]+)", n.text or "")
            for quoted, bare, area in places or [("", "", "")]:
                sheet = quoted.replace("''", "'") or bare or None
                yield {"defined_name": n.get("name", ""), "destination_sheet": sheet, "destination_range": area or None}

    @staticmethod
    def _joined(node: ElementTree.Element) -> str:
        """Text of a string item: its runs, without phonetic hints."""
        out = []
        for n in node:
            if _local(n.tag) == "t":
                out.append(n.text or "")
            elif _local(n.tag) == "r":
                out += [t.text or "" for t in n if _local(t.tag) == "t"]
        return "".join(out)

    def _strings(self) -> list[str]:
        return [self._joined(n) for n in self._xml("xl/sharedStrings.xml") if _local(n.tag) == "si"] if "xl/sharedStrings.xml" in self.members else []

    def _date_styles(self) -> list[bool]:
        """Whether each cell style shows a date or time."""
        if "xl/styles.xml" not in self.members:
            return []
        nodes = {_local(n.tag): n for n in self._xml("xl/styles.xml")}
        own = {n.get("numFmtId"): n.get("formatCode", "") for n in nodes.get("numFmts", ())}

        def is_date(kind: str) -> bool:
            if kind in own:
                return bool(re.search(r"[dmhys]", re.sub(r'"[^"]*"|\[(?!h+\]|m+\]|s+\])[^\]]*\]|\\.|_.', "", own[kind].split(";")[0]), re.I))
            return int(kind or 0) in DATE_FORMATS

        return [is_date(n.get("numFmtId", "0")) for n in nodes.get("cellXfs", ())]

    def _moment(self, serial: float) -> object:
        if 0 <= serial < 1 and self.base.year == 1899:
            at = datetime(1900, 1, 1) + timedelta(seconds=round(serial * 86_400, 6))
            return time(at.hour, at.minute, at.second, at.microsecond) if at.day == 1 else datetime(1899, 12, 31)
        if self.base.year == 1899 and serial < 60:
            serial += 1  # the calendar's leap day of 1900 never was
        return self.base + timedelta(days=int(serial), milliseconds=round((serial - int(serial)) * 86_400_000))

    def _value(self, node: ElementTree.Element, raw: str | None, inline: str | None) -> object:
        kind = node.get("t", "n")
        if kind == "inlineStr":
            return inline
        if raw is None or raw == "" and kind != "str":
            return None
        if kind == "s":
            return self.strings[int(raw)]
        if kind == "b":
            return raw.strip() in ("1", "true")
        if kind != "n":
            return raw
        found = float(raw) if re.search(r"[.eE]", raw) else int(raw)
        style = int(node.get("s", "0"))
        if style < len(self.dates) and self.dates[style]:
            try:
                return self._moment(float(found))
            except OverflowError:
                return found
        return found

    def rows(self, sheet: Sheet) -> Iterator[list[Cell]]:
        """Rows with their cells, in order; fills the sheet's other fields on the way, complete when all rows are read."""
        links = {} if self.limited else self._links(sheet.member)
        last_row = 0
        with self.box.open(sheet.member) as stream:
            parents: list[ElementTree.Element] = []
            for event, node in ElementTree.iterparse(stream, events=("start", "end")):
                tag = _local(node.tag)
                if event == "start":
                    parents.append(node)
                    continue
                parents.pop()
                if tag == "dimension":
                    sheet.declared = node.get("ref", sheet.declared)
                elif tag == "col" and not self.limited and node.get("hidden") in ("1", "true"):
                    sheet.hidden_columns += range(int(node.get("min", "1")), min(int(node.get("max", "1")), 16_384) + 1)
                elif tag == "mergeCell" and not self.limited:
                    sheet.merged.append(node.get("ref", ""))
                elif tag == "tablePart" and links:
                    table = self._xml(links.get(_attribute(node, "id") or "", ""))
                    area = table.get("ref", "")
                    sheet.tables.append({"name": table.get("name", ""), "display_name": table.get("displayName", table.get("name", "")), "range": area, "header_row": (bounds(area) or (None, None))[1]})
                elif tag == "row":
                    at = last_row = int(node.get("r", last_row + 1))
                    if not self.limited and node.get("hidden") in ("1", "true"):
                        sheet.hidden_rows.append(at)
                    yield list(self._cells(node, at))
                    node.clear()
                    if parents:
                        parents[-1].remove(node)
        sheet.tables.sort(key=lambda t: t["name"])

    def _cells(self, row: ElementTree.Element, at: int) -> Iterator[Cell]:
        column = 0
        for node in row:
            if _local(node.tag) != "c":
                continue
            place = _CELL.fullmatch(node.get("r", ""))
            column = number(place[1]) if place else column + 1
            parts = {_local(n.tag): n for n in node}
            inline = self._joined(parts["is"]) if "is" in parts else None
            value = self._value(node, parts["v"].text if "v" in parts else None, inline)
            formula = f"={parts['f'].text or ''}" if "f" in parts else None
            if formula is None and isinstance(value, str) and value.startswith("="):
                formula = value
            if formula is not None or value is not None:
                yield Cell(at, column, value, formula)


# --- row blocks


def _header_row(first: dict[int, str], n_rows: int, row: int) -> int | None:
    """Row number of a region's header, if its first row looks like one."""
    values = [escaped(v) for v in first.values() if v]
    if n_rows < 2 or len(values) < 2:
        return None
    worded = sum(any(map(str.isalpha, v)) for v in values)
    return row if 2 * worded >= len(values) and 10 * len(set(values)) >= 8 * len(values) else None


class _Region:
    """Rows of a sheet without an empty one between them."""

    def __init__(self, sheet: Sheet):
        self.sheet, self.rows = sheet, []

    def units(self) -> Iterator[tuple[str, str, str, dict]]:
        shown = [(row, {c.column: c.text for c in cells if c.text}, {c.column for c in cells if c.formula is not None}) for row, cells in self.rows]
        used = [c for _, texts, _ in shown for c in texts]
        first, last = min(used), max(used)
        header = _header_row(shown[0][1], len(shown), shown[0][0])
        for left in range(first, last + 1, COLUMNS):
            right = min(last, left + COLUMNS - 1)
            most = max(1, min(ROWS, CELLS // (right - left + 1)))
            at = 0
            while at < len(shown):
                take = min(most, len(shown) - at)
                unit = self._block(shown[at : at + take], left, right, header)
                while take > 1 and len(unit[1]) > CHARACTERS:
                    take = max(1, take // 2)
                    unit = self._block(shown[at : at + take], left, right, header)
                yield unit
                at += take

    def _block(self, rows: list, left: int, right: int, header: int | None) -> tuple[str, str, str, dict]:
        sheet, top, bottom = self.sheet, rows[0][0], rows[-1][0]
        area = f"{letters(left)}{top}:{letters(right)}{bottom}"
        names = [letters(c) for c in range(left, right + 1)]
        values = [[escaped(texts.get(c, "")) for c in range(left, right + 1)] for _, texts, _ in rows]
        lines = [f"シート: {sheet.name}", f"範囲: {area}", f"列: {' | '.join(names)}"]
        lines += [f"行{row}: {' | '.join(v)}" for (row, _, _), v in zip(rows, values)]
        box = (left, top, right, bottom)
        merged = [m for m in sheet.merged if meet(box, bounds(m))]
        if merged:
            lines.append(f"結合セル: {', '.join(merged)}")
        table = next((t for t in sheet.tables if meet(box, bounds(t["range"]))), None)
        text = "\n".join(lines)
        hidden_rows, hidden_columns = sum(top <= r <= bottom for r in sheet.hidden_rows), sum(left <= c <= right for c in sheet.hidden_columns)
        metadata = {
            "sheet_name": sheet.name, "sheet_index": sheet.index, "sheet_state": sheet.state, "start_row": top, "end_row": bottom, "start_column": left, "end_column": right, "start_cell": f"{letters(left)}{top}", "end_cell": f"{letters(right)}{bottom}",
            "range": area, "row_count": len(rows), "column_count": right - left + 1, "non_empty_cell_count": sum(v != "" for row in values for v in row), "header_row_number": header if table is None else table["header_row"], "header_inferred": header is not None,
            "table_name": None if table is None else table["name"], "table_range": None if table is None else table["range"], "formula_cell_count": sum(left <= c <= right for _, _, made in rows for c in made), "merged_ranges": merged,
            "contains_hidden_rows": hidden_rows > 0, "contains_hidden_columns": hidden_columns > 0, "hidden_row_count": hidden_rows, "hidden_column_count": hidden_columns, "headers": names, "values": values[0], "logical_row_number": top,
            "content_sha256": hashlib.sha256(text.encode()).hexdigest(),
        }
        if table is not None:
            metadata["table_display_name"] = table["display_name"]
        return "xlsx_table_rows", text, f"sheet:{sheet.name}/range:{area}", metadata


def _sheet_units(book: Workbook, sheet: Sheet) -> tuple[dict, list]:
    """Measures of a sheet, and its row blocks.  The sheet's ranges stand behind its cells, so it is read twice."""
    for _ in book.rows(sheet):
        pass
    seen = {"cells": 0, "formulas": 0, "uncached": 0, "large": 0}
    edge: list[int] | None = None
    region, units, before = _Region(sheet), [], 0
    scan = Sheet(sheet.name, sheet.index, sheet.state, sheet.member)
    for cells in book.rows(scan):
        row = cells[0].row if cells else before + 1
        filled = False
        for c in cells:
            text = c.text
            seen["uncached"] += c.formula is not None and cell_text(c.value) == ""
            seen["large"] += len(text) > LARGE_CELL
            if c.formula is not None or c.value != "":
                seen["cells"] += 1
                seen["formulas"] += c.formula is not None
                edge = [c.row, c.column, c.row, c.column] if edge is None else [min(edge[0], c.row), min(edge[1], c.column), max(edge[2], c.row), max(edge[3], c.column)]
            filled |= text != ""
        if region.rows and (not filled or row != before + 1):
            units += region.units()
            region = _Region(sheet)
        if filled:
            region.rows.append((row, cells))
        before = row
    if region.rows:
        units += region.units()
    return seen | {"edge": edge}, units


def workbook(content: bytes, path: str) -> Iterator[tuple[str, str, str, dict] | Issue]:
    """Units of a workbook: its summary, and for each sheet a summary and row blocks; then its issues."""
    book = Workbook(content)
    sheets = [(s, *_sheet_units(book, s)) for s in book.sheets]
    states = lambda state: sum(s.state == state for s in book.sheets)
    total = lambda key: sum(m[key] for _, m, _ in sheets)
    edge = lambda m, i: m["edge"][i] if m["edge"] else None
    document = {
        "sheet_count": len(sheets), "visible_sheet_count": states("visible"), "hidden_sheet_count": states("hidden"), "very_hidden_sheet_count": states("veryHidden"), "non_empty_cell_count": total("cells"), "formula_cell_count": total("formulas"),
        "formula_without_cached_value_count": total("uncached"), "merged_range_count": sum(len(s.merged) for s in book.sheets), "excel_table_count": sum(len(s.tables) for s in book.sheets), "row_block_count": sum(len(u) for _, _, u in sheets),
        "text_characters": sum(len(u[1]) for _, _, units in sheets for u in units), "largest_sheet_rows": max((edge(m, 2) or 0 for _, m, _ in sheets), default=0), "largest_sheet_columns": max((edge(m, 3) or 0 for _, m, _ in sheets), default=0), **book.sizes,
    }
    names = [s.name for s in book.sheets]
    lines = ["Excelワークブック", f"シート数: {len(names)}", f"シート: {', '.join(names)}", f"非表示シート数: {states('hidden')}", f"定義名数: {len(book.names)}", f"数式セル数: {total('formulas')}"]
    yield "xlsx_workbook_summary", "\n".join(lines), "workbook", document | {"sheet_names": names, "defined_names": book.names}
    issues = [Issue("xlsx_metadata_limited", "ranges, tables and names were not read: the file is large", None, {"threshold": MAX_METADATA_FILE})] if book.limited else []
    for sheet, m, units in sheets:
        actual = f"{letters(edge(m, 1))}{edge(m, 0)}:{letters(edge(m, 3))}{edge(m, 2)}" if m["edge"] else None
        counts = {"非空セル数": m["cells"], "数式セル数": m["formulas"], "結合セル範囲数": len(sheet.merged), "Excelテーブル数": len(sheet.tables), "非表示行数": len(sheet.hidden_rows), "非表示列数": len(sheet.hidden_columns)}
        lines = [f"シート名: {sheet.name}", f"状態: {sheet.state}", f"使用範囲: {sheet.declared}", f"実データ範囲: {actual or ''}", *(f"{k}: {v}" for k, v in counts.items())]
        metadata = {
            "sheet_name": sheet.name, "sheet_index": sheet.index, "sheet_state": sheet.state, "declared_dimension": sheet.declared, "actual_dimension": actual, "min_row": edge(m, 0), "max_row": edge(m, 2), "min_column": edge(m, 1), "max_column": edge(m, 3),
            "non_empty_cell_count": m["cells"], "formula_cell_count": m["formulas"], "merged_range_count": len(sheet.merged), "table_count": len(sheet.tables), "hidden_row_count": len(sheet.hidden_rows), "hidden_column_count": len(sheet.hidden_columns), "document_metadata": document,
        }
        yield "xlsx_sheet_summary", "\n".join(lines), f"sheet:{sheet.name}", metadata
        yield from units
        rules = [
            ("xlsx_sheet_has_no_cells", m["cells"] == 0, {}), ("xlsx_hidden_sheet", sheet.state != "visible", {}), ("xlsx_large_sheet", (edge(m, 2) or 0) >= LARGE_SHEET, {"threshold": LARGE_SHEET}), ("xlsx_very_wide_sheet", (edge(m, 3) or 0) >= WIDE_SHEET, {"threshold": WIDE_SHEET}),
            ("xlsx_formula_cached_value_missing", m["uncached"] > 0, {"formula_without_cached_value_count": m["uncached"]}), ("xlsx_large_cell_value", m["large"] > 0, {"large_cell_value_count": m["large"]}),
        ]
        issues += [Issue(name, name.replace("_", " "), f"sheet:{sheet.name}", {"sheet_name": sheet.name} | extra) for name, holds, extra in rules if holds]
    yield from sorted(issues, key=lambda i: (i.locator or "", i.issue))


def cells(content: bytes) -> Iterator[tuple[str, int, int, str, str, bool, bool]]:
    """``sheet, row, column, coordinate, text, has_formula, has_value`` of all cells with a value or formula."""
    book = Workbook(content)
    for sheet in book.sheets:
        for row in book.rows(sheet):
            for c in row:
                yield sheet.name, c.row, c.column, f"{letters(c.column)}{c.row}", c.text, c.formula is not None, cell_text(c.value) != ""
