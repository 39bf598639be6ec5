"""Text functions: normalisation, tokens, n-grams, context, previews, and the splitter."""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Token shapes of the search index (fixed values).
GROUPED_NUMBER = r"\d{1,3}(?:,\d{3})+(?:\.\d+)?"
CJK = r"[ぁ-んァ-ンー一-龯々〆ヶ]+"
# Characters that NFKC leaves and that fold as they are lower-cased, but for ß (fixed values).
UNCHANGED = r"\x00-\x7F¡-§©«¬®°±¶·»¿À-ÿŒœŠšŽžŸ–—‘’‚“”„†‡•‹›€"
WORD_TOKEN = rf"{GROUPED_NUMBER}|[a-z0-9]+(?:[._/-][a-z0-9]+)*|{CJK}"
# Metadata that context text may show (fixed values).
CONTEXT_KEYS = ("heading", "heading_path", "json_pointer", "headers", "cell_type", "output_type")


def _fold(text: Column) -> Column:
    @F.pandas_udf("string")
    def fold(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())

    return fold(text)


def squeeze(text: Column) -> Column:
    """Unify line ends, collapse and strip blanks in lines, strip the whole."""
    lines = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"[ \t\f\x0B]+", " ")
    return F.regexp_replace(F.regexp_replace(lines, r"(?U)(?m)^[^\S\n]+|[^\S\n]+$", ""), r"(?U)\A\s+|\s+\z", "")


def normalize(text: Column) -> Column:
    """NFKC, case folding and white space.

    Texts of ``UNCHANGED`` characters alone, which NFKC leaves and of which only ß
    folds apart, stay in the JVM; the others are folded in Python.
    """
    plain = text.rlike(rf"\A[{UNCHANGED}]*\z")
    return squeeze(F.when(plain, F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))).otherwise(_fold(F.when(~plain, text))))


def word_tokens(normalized: Column) -> Column:
    """Tokens in order; numbers also without commas, compound tokens also by part."""
    return F.flatten(F.transform(F.regexp_extract_all(normalized, F.lit(WORD_TOKEN), F.lit(0)), token_forms))


def token_forms(t: Column) -> Column:
    """A matched token and its further forms; those without a mark inside, nearly all, pass without a regex."""
    plain = F.when(t.rlike(rf"\A(?:{GROUPED_NUMBER})\z"), F.array(F.replace(t, F.lit(","), F.lit("")))).otherwise(F.array().cast("array<string>"))
    parts = F.filter(F.regexp_extract_all(t, F.lit("[a-z0-9]+"), F.lit(0)), lambda p: p != t)
    return F.when(F.translate(t, ",._/-", "") == t, F.array(t)).otherwise(F.concat(F.array(t), plain, parts))


def cjk_ngrams(normalized: Column, least: int = 2, most: int = 3) -> Column:
    """N-grams inside each CJK run, by size, then by position."""
    if least < 1 or most < least:
        raise ValueError("n-gram sizes must be positive and ascending")

    def grams(run: Column) -> Column:
        def of(n: int) -> Column:
            starts = F.when(F.length(run) >= n, F.sequence(F.lit(1), F.length(run) - n + 1)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.substring(run, i, F.lit(n)))

        return F.flatten(F.array(*[of(n) for n in range(least, most + 1)]))

    return F.flatten(F.transform(F.regexp_extract_all(normalized, F.lit(CJK), F.lit(0)), grams))


def context_text(path: Column, parser: Column, unit: Column, locator: Column, metadata: dict[str, Column] | None = None) -> Column:
    """One ``key=value`` a line for file, path, parser, unit, locator and the allowed metadata; nulls and blanks are left out."""
    lines = [F.concat(F.lit("file="), F.element_at(F.split(path, "/"), -1)), F.concat(F.lit("path="), path), F.concat(F.lit("parser="), parser), F.concat(F.lit("unit="), unit), F.concat(F.lit("locator="), locator)]
    for key in CONTEXT_KEYS:
        if metadata and key in metadata:
            lines.append(F.when(metadata[key] != "", F.concat(F.lit(f"{key}="), metadata[key])))
    return F.concat_ws("\n", *lines)


def preview(text: Column, size: int) -> Column:
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)


def visible_length(text: Column) -> Column:
    """Characters that aren't white space."""
    return F.length(F.regexp_replace(text, r"(?U)\s", ""))


def split_windows(lines: Sequence[int], most: int, overlap: int) -> list[tuple[int, int]]:
    """Windows (start, end) of a text whose lines have these lengths: cut after the last blank line, else after the last line end, else at ``most``."""
    if most <= 0 or overlap < 0 or overlap >= most:
        raise ValueError("need most > overlap >= 0")
    ends, at = [], -1  # positions of line ends
    for n in lines[:-1]:
        at += int(n) + 1
        ends.append(at)
    size = at + 1 + int(lines[-1])
    blank = [e for e, after in zip(ends, ends[1:]) if after == e + 1]
    out, at = [], 0
    while at < size:
        end = min(at + most, size)
        if end < size:
            for marks, width in ((blank, 2), (ends, 1)):
                k = bisect_right(marks, end - width) - 1
                if k >= 0 and marks[k] > at:
                    end = marks[k] + width
                    break
        out.append((at, end))
        if end == size:
            break
        at = max(end - min(overlap, end - at), at + 1)
    return out


def split_points(text: str, most: int, overlap: int) -> list[tuple[int, int]]:
    """``split_windows`` of a text, but for windows of white space alone."""
    return [(a, z) for a, z in split_windows([len(line) for line in text.split("\n")], most, overlap) if text[a:z].strip()]


def split_segments(text: Column, most: int, overlap: int) -> Column:
    """Array of (start, end) windows; the fold is sequential, so it runs in an Arrow UDF.

    Python gets the lengths of lines, and those of texts beyond ``most`` only: no
    text leaves the JVM, so workers hold little whatever the texts are.
    """
    if most <= 0 or overlap < 0 or overlap >= most:
        raise ValueError("need most > overlap >= 0")

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def cut(lines: pd.Series) -> pd.Series:
        return lines.map(lambda n: None if n is None else [{"start": a, "end": z} for a, z in split_windows(n, most, overlap)])

    size = F.length(text)
    whole = F.array(F.struct(F.lit(0).alias("start"), size.alias("end")))
    long = cut(F.when(size > most, F.transform(F.split(text, "\n", -1), F.length)))
    filled = lambda w: F.substring(text, w["start"] + 1, w["end"] - w["start"]).rlike(r"(?U)[^\s\x1C-\x1F]")
    return F.filter(F.when(size > most, long).when(size > 0, whole).otherwise(F.array().cast("array<struct<start:int,end:int>>")), filled)


def line_number(text: Column, position: Column) -> Column:
    """Line, from 1, of a 0-based character position."""
    head = F.substring(text, F.lit(1), position)
    return F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit(""))) + 1


def joined_preview(text: Column, size: int, *, mark: str = " ") -> Column:
    """A preview on one line: canonical composition, then lines joined by ``mark``."""

    @F.pandas_udf("string")
    def composed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return preview(F.regexp_replace(composed(text), r"\r\n?|\n", mark), size)


def chunk_id(chunk_index: Column, locator: Column, parser: Column, path: Column, units: Column, text: Column, unit_type: Column) -> Column:
    """SHA-256 of the canonical JSON of what identifies a chunk."""
    record = F.struct(chunk_index.alias("chunk_index"), locator.alias("locator"), parser.alias("parser_name"), path.alias("relative_path"), units.alias("source_unit_indices"), text.alias("text"), unit_type.alias("unit_type"))
    return F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256)
