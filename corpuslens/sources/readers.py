"""Strict readers of JSON-lines tables: every record is checked, and a wrong one is named by its line.

Lines are checked as JSON values before any cast, so a number never passes as a
text.  Line numbers come from the scan's own partitions: rows are counted by
block of a file, and nothing but those counts is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """A field of a record: ``kind`` is STRING, BIGINT, DOUBLE, BOOLEAN, OBJECT or ARRAY, ``item`` the kind of a list's items."""

    name: str
    kind: str
    required: bool = True
    nullable: bool = False
    filled: bool = False
    item: tuple[Field, ...] | str | None = None


def problem(value: Column, fields: tuple[Field, ...]) -> Column:
    """The first thing wrong with a JSON object (a variant), null if it is sound."""
    found: list[Column] = []
    for f in fields:
        at = F.try_variant_get(value, f"$.{f.name}", "variant")
        kind = F.schema_of_variant(at)
        absent, null = at.isNull(), kind == "VOID"
        fits = {"DOUBLE": kind.isin("DOUBLE", "FLOAT", "BIGINT") | kind.startswith("DECIMAL"), "OBJECT": kind.startswith("OBJECT"), "ARRAY": kind.startswith("ARRAY")}.get(f.kind, kind == f.kind)
        if f.required:
            found.append(F.when(absent, F.lit(f"{f.name} is missing")))
        if not f.nullable:
            found.append(F.when(null, F.lit(f"{f.name} is null")))
        found.append(F.when(~absent & ~null & ~fits, F.concat(F.lit(f"{f.name} is "), F.lower(kind))))
        if f.filled:
            found.append(F.when(fits & (F.regexp_replace(F.try_variant_get(at, "$", "string"), r"(?U)\s", "") == ""), F.lit(f"{f.name} is empty")))
        if f.item is not None:
            items = F.try_variant_get(at, "$", "array<variant>")
            told = F.filter(F.transform(items, _of_item(f.item)), lambda p: p.isNotNull())
            found.append(F.when(F.size(told) > 0, F.concat(F.lit(f"an item of {f.name}: "), F.get(told, F.lit(0)))))
    return F.coalesce(*found)


def _of_item(item: tuple[Field, ...] | str):
    """What is wrong with a list's item: of another kind than ``item``, or an object with wrong fields."""

    def of(x: Column) -> Column:
        kind = F.coalesce(F.schema_of_variant(x), F.lit("VOID"))
        if isinstance(item, str):
            return F.when(kind != item, F.lower(kind))
        return F.when(~kind.startswith("OBJECT"), "no object").otherwise(problem(x, item))

    return of


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_number, value`` of text files."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("before", before).select("file", "block", "first", "before")
    return rows.join(blocks, ["file", "block"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_number"), "value")


def read_strict(spark: SparkSession, path: str, schema: str, fields: tuple[Field, ...], *, unique: str | None = None, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Records of a JSON-lines file as ``schema``; blank lines, broken JSON, wrong fields and repeated keys raise with file and line.

    Metadata objects may be declared as ``string`` in ``schema``: they stay JSON.
    """
    lines = spark.read.text(path)
    parsed = F.try_parse_json("value")
    fault = F.when(F.trim("value") == "", "blank line").when(parsed.isNull(), "no JSON").when(~F.schema_of_variant(parsed).startswith("OBJECT"), "no object").otherwise(problem(parsed, fields))
    if lines.select(fault.alias("fault")).filter("fault IS NOT NULL").limit(1).count():
        first = numbered_lines(spark, path).withColumn("fault", fault).filter("fault IS NOT NULL").orderBy("file", "line_number").first()
        raise ValueError(f"{first['file']}, line {first['line_number']}: {first['fault']}")
    rows = lines.select(F.from_json("value", schema).alias("r")).select("r.*")
    for name, value in (defaults or {}).items():
        rows = rows.withColumn(name, F.coalesce(name, value))
    if unique and (again := rows.groupBy(unique).count().filter("count > 1").orderBy(unique).first()):
        raise ValueError(f"{path}: {unique} {again[unique]!r} is repeated")
    return rows


_ISSUE = (Field("issue_type", "STRING"), Field("severity", "STRING"), Field("message", "STRING"), Field("locator", "STRING", required=False, nullable=True), Field("metadata", "OBJECT", required=False, nullable=True))
_UNIT = (Field("unit_type", "STRING"), Field("text", "STRING"), Field("locator", "STRING", nullable=True), Field("metadata", "OBJECT"))
_SOURCE = (Field("relative_path", "STRING", filled=True), Field("size_bytes", "BIGINT"))
DOCUMENT_FIELDS = (Field("source", "OBJECT"), Field("parser_name", "STRING", filled=True), Field("units", "ARRAY", item=_UNIT), Field("issues", "ARRAY", required=False, item=_ISSUE))
DOCUMENT_SCHEMA = "source struct<relative_path:string,name:string,suffix:string,mime_type:string,size_bytes:bigint,modified_at:string>, parser_name string, units array<struct<unit_type:string,text:string,locator:string,metadata:string>>, issues array<struct<issue_type:string,severity:string,message:string,locator:string,metadata:string>>"
CHUNK_FIELDS = (
    Field("chunk_id", "STRING", filled=True), Field("relative_path", "STRING", filled=True), Field("parser_name", "STRING"), Field("unit_type", "STRING"), Field("text", "STRING", filled=True), Field("locator", "STRING", nullable=True),
    Field("source_unit_indices", "ARRAY", item="BIGINT"), Field("chunk_index", "BIGINT"), Field("metadata", "OBJECT"),
)
CHUNK_SCHEMA = "chunk_id string, relative_path string, parser_name string, unit_type string, text string, locator string, source_unit_indices array<int>, chunk_index int, metadata string"
_EXPECTED = (Field("relative_path", "STRING", filled=True), Field("locator", "STRING", required=False, nullable=True))
QUERY_FIELDS = (Field("query_id", "STRING", filled=True), Field("query", "STRING", filled=True), Field("query_type", "STRING", filled=True), Field("expected_relevant", "ARRAY", required=False, item=_EXPECTED), Field("notes", "STRING", required=False))
QUERY_SCHEMA = "query_id string, query string, query_type string, expected_relevant array<struct<relative_path:string,locator:string>>, notes string"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Extracted documents; ``issues`` is an empty list where absent."""
    none = F.array().cast("array<struct<issue_type:string,severity:string,message:string,locator:string,metadata:string>>")
    rows = read_strict(spark, path, DOCUMENT_SCHEMA, DOCUMENT_FIELDS, defaults={"issues": none})
    fault = F.try_parse_json(F.to_json("source"))
    if bad := rows.filter(problem(fault, _SOURCE).isNotNull()).first():
        raise ValueError(f"{path}: {bad['source']}: a source needs relative_path and size_bytes")
    return rows


def document_tables(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of extracted documents the tables of documents, units and issues that the operators read."""
    base = documents.select(F.col("source.relative_path").alias("path"), F.col("parser_name").alias("parser"), F.col("source.size_bytes").alias("size_bytes"), "units", "issues")
    units = base.select("path", "parser", F.posexplode("units").alias("unit_index", "u")).select("path", "parser", "unit_index", "u.*")
    issues = base.select("path", "parser", F.explode("issues").alias("i")).select("path", "parser", F.col("i.issue_type").alias("issue"), "i.severity", "i.locator", "i.metadata")
    return base.select("path", "parser", "size_bytes"), units, issues


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks; ids are unique, and ids, paths and texts are filled."""
    return read_strict(spark, path, CHUNK_SCHEMA, CHUNK_FIELDS, unique="chunk_id")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation queries; expectations and notes are empty where absent."""
    none = F.array().cast("array<struct<relative_path:string,locator:string>>")
    return read_strict(spark, path, QUERY_SCHEMA, QUERY_FIELDS, unique="query_id", defaults={"expected_relevant": none, "notes": F.lit("")})


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Query results (query_id first in ``schema``); of a repeated query the last line counts."""
    rows = numbered_lines(spark, path).filter(F.trim("value") != "").select("file", "line_number", F.from_json("value", schema).alias("r"))
    last = rows.groupBy("r.query_id").agg(F.max_by("r", F.struct("file", "line_number")).alias("r"))
    return last.select("r.*")
