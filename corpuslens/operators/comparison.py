"""Summaries of evaluations, comparisons, conversion trials and PDF diagnoses; selections; answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.operators.corpus import suffix_of
from corpuslens.operators.quality import numbered

# Statuses of a conversion, labels of its items, suffixes (fixed values).
STATUSES = ("success", "partial_success", "failed", "skipped")
PROFILES = {"default_local": None, "japanese_ocr": (".pdf", ".png")}
OFFICE_OR_PDF = (".docx", ".pptx", ".pdf")
DIAGNOSES = ("empty_file", "not_pdf", "encrypted_unreadable", "pdf_header_only", "pypdf_unreadable", "docling_success", "docling_backend_failure", "readable_text_pdf", "readable_image_or_empty_text_pdf")
LABEL_GROUPS = {"text_item_count": ("text", "paragraph", "section_header", "title"), "paragraph_count": ("text", "paragraph"), "list_item_count": ("list_item",), "heading_count": ("section_header", "title", "heading")}


def is_office_or_pdf(path: Column) -> Column:
    return suffix_of(path).isin(*OFFICE_OR_PDF)


def is_workbook(path: Column) -> Column:
    return suffix_of(path) == ".xlsx"


def is_ocr_result(unit_type: Column, metadata: Column) -> Column:
    """Whether a result's text was recognised: by its unit type or its metadata (a JSON object)."""
    parsed = F.try_parse_json(metadata)
    engine = F.try_variant_get(parsed, "$.ocr_engine", "variant").isNotNull()
    method = F.coalesce(F.try_variant_get(parsed, "$.extraction_method", "string"), F.lit(""))
    return unit_type.contains("ocr") | F.coalesce(engine, F.lit(False)) | method.contains("ocr")


def evaluation_counts(evaluated: DataFrame, results: DataFrame | None = None, *by: str) -> DataFrame:
    """Counts and rates of hits over automatically evaluated queries, MRR, and manual queries.

    ``evaluated`` has query, auto, hit_at_1, _3, _5, _10 and reciprocal_rank;
    ``results`` (query) adds the queries without any result.
    """
    n = F.count_if("auto")
    columns = [F.count("*").alias("total_queries"), n.alias("auto_evaluated_queries"), F.count_if(~F.col("auto")).alias("manual_review_queries")]
    for k in (1, 3, 5, 10):
        hits = F.count_if(F.col("auto") & F.coalesce(f"hit_at_{k}", F.lit(False)))
        columns += [hits.alias(f"hit_at_{k}_count"), F.round(F.coalesce(F.try_divide(hits.cast("double"), n), F.lit(0.0)), 9).alias(f"hit_at_{k}_rate")]
    columns.append(F.round(F.coalesce(F.try_divide(F.sum(F.when(F.col("auto"), F.coalesce("reciprocal_rank", F.lit(0.0)))), n), F.lit(0.0)), 9).alias("mrr"))
    if results is not None:
        found = results.select("query").distinct().withColumn("has_results", F.lit(True))
        evaluated = evaluated.join(found, "query", "left")
        columns.append(F.count_if(F.col("has_results").isNull()).alias("queries_with_no_results"))
    return evaluated.groupBy(*by).agg(*columns)


def path_changes(old: DataFrame, new: DataFrame, top: int = 5) -> DataFrame:
    """Per query of both runs (query, rank, path, unit_type, metadata): top paths, their overlap, and what kinds the new ones are.

    Runs may hold a query with a null path only: it has no results.  Path lists
    keep repeats; overlap and changes are of their sets.
    """

    def lists(run: DataFrame, name: str) -> DataFrame:
        kept = run.filter((F.col("rank") <= top) | F.col("path").isNull())
        flags = F.struct("rank", "path", is_office_or_pdf(F.col("path")).alias("office"), is_workbook(F.col("path")).alias("book"), is_ocr_result(F.col("unit_type"), F.col("metadata")).alias("ocr"))
        return kept.groupBy("query").agg(F.array_sort(F.collect_list(F.when(F.col("path").isNotNull(), flags))).alias(name))

    both = lists(old, "o").join(lists(new, "n"), "query")
    o, n = F.col("o.path"), F.col("n.path")
    first = lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit(""))
    shared, either = F.size(F.array_intersect(o, n)), F.size(F.array_union(o, n))
    number = lambda kind: F.size(F.filter("n", lambda r: r[kind])).cast("long")
    return both.select(
        "query", o.alias("old_paths"), n.alias("new_paths"), (first(o) != first(n)).alias("top1_changed"), shared.cast("long").alias("overlap"), F.round(F.when(either > 0, shared / either).otherwise(0.0), 9).alias("jaccard"),
        F.array_sort(F.array_except(n, o)).alias("added"), F.array_sort(F.array_except(o, n)).alias("removed"), number("office").alias("new_office_or_pdf"), number("book").alias("new_workbooks"), number("ocr").alias("new_ocr"),
    )


def comparison_summary(changes: DataFrame) -> DataFrame:
    """One row over ``path_changes``: changed queries, mean Jaccard, queries without results, queries with new kinds."""
    empty = lambda c: F.count_if(F.size(c) == 0)
    kind = lambda s: F.count_if(F.exists("new_paths", lambda p: suffix_of(p) == s))
    return changes.agg(
        F.count("*").alias("compared_queries"), F.count_if("top1_changed").alias("top1_changed_queries"), F.count_if((F.size("added") > 0) | (F.size("removed") > 0)).alias("top5_changed_queries"), F.round(F.coalesce(F.avg("jaccard"), F.lit(0.0)), 9).alias("average_top5_jaccard"),
        empty("old_paths").alias("old_queries_with_no_results"), empty("new_paths").alias("new_queries_with_no_results"), (empty("new_paths") - empty("old_paths")).alias("no_result_delta"),
        *[kind(f".{s}").alias(f"{s}_new_top5_queries") for s in ("docx", "pptx", "pdf", "xlsx")], F.count_if(F.col("new_ocr") > 0).alias("ocr_new_top5_queries"),
    )


def quantile_sample(files: DataFrame, per_suffix: int, suffixes: tuple[str, ...]) -> DataFrame:
    """``sample_id, path, suffix, size_bytes, selection_rank, quantile``: files nearest to evenly spaced quantiles of (size, path).

    Two quantiles that round to one file take the nearest unused one, the right
    one first.  Files of a suffix with at most ``per_suffix`` are all taken.
    """
    if per_suffix <= 0:
        raise ValueError("per_suffix must be positive")
    known = files.select("path", suffix_of(F.col("path")).alias("suffix"), F.col("size_bytes").cast("long").alias("size_bytes")).filter(F.col("suffix").isin(*suffixes))
    placed = numbered(known, ["size_bytes", "path"], "suffix")
    spread = [0.5] if per_suffix == 1 else [i / (per_suffix - 1) for i in range(per_suffix)]

    def choose(n: int) -> list[tuple[int, float]]:
        if n <= per_suffix:
            return [(i, i / max(n - 1, 1)) for i in range(n)]
        taken: list[int] = []
        for q in spread:
            target = round(q * (n - 1))
            near = (target + sign * d for d in range(n) for sign in (1, -1))
            taken.append(next(i for i in near if 0 <= i < n and i not in taken))
        return list(zip(taken, spread))

    sizes = placed.groupBy("suffix").agg(F.first("n").alias("n")).collect()  # one row a suffix
    wanted = [(r["suffix"], i, k, q) for r in sizes for k, (i, q) in enumerate(choose(r["n"]), start=1)]
    picks = files.sparkSession.createDataFrame(wanted, "suffix string, place long, selection_rank int, quantile double")
    ident = F.sha2(F.concat_ws("\n", "path", "suffix", F.col("size_bytes").cast("string")), 256)
    return placed.join(picks, ["suffix", "place"]).select(ident.alias("sample_id"), "path", "suffix", "size_bytes", "selection_rank", "quantile")


def applicable(suffix: Column, profile: Column) -> Column:
    """Whether a conversion profile takes files of this suffix; unknown profiles take none."""
    out = F.lit(False)
    for name, kinds in PROFILES.items():
        out = F.when(profile == name, F.lit(True) if kinds is None else suffix.isin(*kinds)).otherwise(out)
    return out


def trial_plan(selection: DataFrame, profiles: tuple[str, ...], *, ocr_usable: bool) -> DataFrame:
    """Every selected file with every profile that takes it; OCR profiles are ``skipped`` where OCR isn't usable."""
    each = selection.withColumn("profile", F.explode(F.array(*[F.lit(p) for p in profiles])))
    status = F.when((F.col("profile") == "japanese_ocr") & F.lit(not ocr_usable), "skipped")
    return each.filter(applicable(F.col("suffix"), F.col("profile"))).withColumn("status", status)


def trial_summary(results: DataFrame, candidates: DataFrame, selection: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """Per suffix: candidates, selected files, results by status (zeros included), means and tables of conversions."""
    known = results.sparkSession.createDataFrame([(s,) for s in suffixes], "suffix string")
    keys = known.union(results.select("suffix")).distinct()
    counted = lambda rows, name: rows.groupBy("suffix").agg(F.count("*").alias(name))
    by = results.groupBy("suffix").agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], F.count_if(F.col("status") != "skipped").alias("executed"), F.round(F.avg("elapsed_seconds"), 9).alias("average_elapsed_seconds"),
        F.round(F.avg("text_characters"), 9).alias("average_text_characters"), F.sum("table_count").cast("long").alias("tables"), F.round(F.avg("provenance_coverage"), 9).alias("average_provenance_coverage"),
    )
    joined = keys.join(counted(candidates, "candidates"), "suffix", "left").join(counted(selection, "selected"), "suffix", "left").join(by, "suffix", "left")
    return joined.na.fill(0, ["candidates", "selected", "executed", *STATUSES])


def structure_summary(items: DataFrame, collections: DataFrame | None = None) -> DataFrame:
    """Per document of items (path, label, has_provenance): items by kind, and the share with provenance.

    ``collections`` (path, tables, pictures) may know of more tables and pictures
    than there are items.
    """
    count = lambda labels: F.count_if(F.col("label").isin(*labels))
    n = F.count_if(F.col("label").isNotNull())
    out = items.groupBy("path").agg(n.alias("total_items"), *[count(v).alias(k) for k, v in LABEL_GROUPS.items()], count(("table",)).alias("table_count"), count(("picture", "image")).alias("picture_count"), F.count_if("has_provenance").alias("provenance_items"))
    if collections is not None:
        out = out.join(collections.select("path", "tables", "pictures"), "path", "left").withColumn("table_count", F.greatest("table_count", F.coalesce("tables", F.lit(0)))).withColumn("picture_count", F.greatest("picture_count", F.coalesce("pictures", F.lit(0)))).drop("tables", "pictures")
    return out.withColumn("provenance_coverage", F.coalesce(F.try_divide(F.col("provenance_items").cast("double"), F.col("total_items")), F.lit(0.0)))


def diagnosis_summary(records: DataFrame) -> DataFrame:
    """One row over PDF diagnoses (header, readable, encrypted, attempted, converted, diagnosis), every diagnosis counted."""
    return records.agg(
        F.count("*").alias("diagnosed_files"), F.count_if("header").alias("header_is_pdf"), F.count_if(~F.col("header")).alias("header_is_not_pdf"), F.count_if("readable").alias("pypdf_readable"), F.count_if(~F.col("readable")).alias("pypdf_unreadable"), F.count_if("encrypted").alias("encrypted"),
        F.count_if("attempted").alias("docling_attempted"), *[F.count_if(F.col("converted") == s).alias(f"converted_{s}") for s in ("success", "partial_success", "failed")], *[F.count_if(F.col("diagnosis") == d).alias(f"diagnosis_{d}") for d in DIAGNOSES],
    )


def conversion_status(status: Column) -> Column:
    """The four statuses of a conversion; anything else has failed."""
    low = F.lower(status)
    return F.when(low.isin(*STATUSES), low).otherwise("failed")


def submission_issues(answers: DataFrame, samples: DataFrame, *, suffix: str = ".csv", path: str = "answers.csv", token_limit: int = 1000, token_count: Column | None = None) -> DataFrame:
    """``issue, n`` of a submission (idx, answer) against the sample's idx; none if it is valid.

    ``token_count`` counts an answer's tokens; without it words are counted, of
    which a text has no more than tokens.
    """
    tokens = token_count if token_count is not None else F.size(F.regexp_extract_all("answer", F.lit(r"\S+"), F.lit(0)))
    checked = answers.agg(F.count_if(F.col("idx").isNull()).alias("index_missing"), F.count_if(F.col("answer").isNull() | (F.trim("answer") == "")).alias("answer_missing"), F.count_if(tokens > token_limit).alias("answer_too_long"))
    rows = checked.select(F.explode(F.array(*[F.struct(F.lit(c).alias("issue"), F.col(c).alias("n")) for c in checked.columns])).alias("r")).select("r.*")
    same = lambda a, b, name: a.select("idx").distinct().join(b.select("idx"), "idx", "left_anti").filter("idx IS NOT NULL").agg(F.lit(name).alias("issue"), F.count("*").alias("n"))
    out = rows.unionByName(same(answers, samples, "unknown_index")).unionByName(same(samples, answers, "answer_absent"))
    repeated = answers.groupBy("idx").count().filter("idx IS NOT NULL AND count > 1").agg(F.lit("index_repeated").alias("issue"), F.count("*").alias("n"))
    wrong = answers.sparkSession.createDataFrame([("wrong_suffix", int(not path.lower().endswith(suffix)))], "issue string, n long")
    return out.unionByName(repeated).unionByName(wrong).filter("n > 0")


def graded(answers: DataFrame, truth: DataFrame) -> DataFrame:
    """Answers (idx, answer, label) joined with their truth (idx, truth)."""
    return answers.join(truth, "idx")


def last_per_query(results: DataFrame) -> DataFrame:
    """Of results (query_id, line_number, ...) the last record of every query."""
    names = [c for c in results.columns if c != "query_id"]
    return results.groupBy("query_id").agg(F.max_by(F.struct(*names), "line_number").alias("r")).select("query_id", "r.*")


def record_index(chunks: DataFrame) -> DataFrame:
    """``chunks`` with a dense ``record_index`` by (path, chunk_index, chunk_id)."""
    return numbered(chunks, ["path", "chunk_index", "chunk_id"]).withColumnRenamed("place", "record_index").drop("n")


def first_issue_rank(results: DataFrame) -> DataFrame:
    """Rank of the first expected result of each query (query, rank, is_expected)."""
    return results.groupBy("query").agg(F.min(F.when(F.col("is_expected"), F.col("rank"))).alias("first_rank"))


def previewed(files: DataFrame, units: DataFrame) -> DataFrame:
    """Per file: units, characters, empty units, units without a locator, and repeats of a locator beyond its first use."""
    base = units.groupBy("path").agg(F.count("*").alias("units"), F.sum(F.length("text")).cast("long").alias("characters"), F.count_if(F.col("text") == "").alias("empty_units"), F.count_if(F.col("locator").isNull()).alias("missing_locators"))
    repeats = units.filter("locator IS NOT NULL").groupBy("path", "locator").agg(F.count("*").alias("n")).groupBy("path").agg(F.sum(F.col("n") - 1).alias("duplicate_locators"))
    return files.select("path").join(base, "path", "left").join(repeats, "path", "left").na.fill(0)


def answer_table(spark, path: str) -> DataFrame:
    """``idx, answer`` of a headerless CSV file."""
    return spark.read.schema("idx int, answer string").option("multiLine", True).csv(path)


def ranked_paths(results: DataFrame, top: int) -> DataFrame:
    """The ``top`` results of each query by rank."""
    order = Window.partitionBy("query").orderBy("rank")
    return results.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= top).drop("_n")
