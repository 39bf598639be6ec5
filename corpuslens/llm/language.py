"""Language identification: script ranges, per-word scores, and Viterbi spans.

A word is a run of letters and marks of one script.  Its scores are sums of
smoothed log-probabilities of its character trigrams, one sum a language.  Only
languages seen in the word's script take part in a word.  A Viterbi pass over
the words, with a penalty for every switch, labels spans of text that mixes
languages; a document gets the language of most of its letters.

All documents of a group advance word by word together, longest first, so the
pass is array arithmetic and not a loop over words.  Groups and the arrays for a
word's scores are bounded in characters; of a very long text only its words'
scores are held whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.scratch import by_bytes

SIZE = 1 << 16
CHUNK = 1 << 18  # characters whose trigrams are summed at once
# First code points of scripts (fixed values); a script reaches to the next one.
SCRIPT_STARTS = (
    (0x0000, 1),  # Latin
    (0x0370, 2),  # Greek
    (0x0400, 3),  # Cyrillic
    (0x0530, 4),  # Armenian
    (0x0590, 5),  # Hebrew
    (0x0600, 6),  # Arabic
    (0x0700, 7),  # Syriac and others
    (0x0900, 8),  # Indic
    (0x0E00, 9),  # Thai, Lao
    (0x0F00, 10),  # Tibetan, Myanmar
    (0x10A0, 11),  # Georgian
    (0x1100, 12),  # Hangul letters
    (0x1200, 13),  # Ethiopic and others
    (0x1C90, 11),
    (0x1CC0, 8),
    (0x1D00, 1),
    (0x1F00, 2),
    (0x2000, 1),
    (0x2C80, 13),
    (0x2D00, 11),
    (0x2D30, 13),
    (0x2DE0, 3),
    (0x2E80, 14),  # Han
    (0x3040, 15),  # kana
    (0x3130, 12),
    (0x3190, 14),
    (0x31F0, 15),
    (0x3200, 14),
    (0xA000, 13),
    (0xA640, 3),
    (0xA6A0, 13),
    (0xA720, 1),
    (0xA800, 8),
    (0xA960, 12),
    (0xA980, 13),
    (0xAC00, 12),
    (0xD800, 16),  # others
    (0xF900, 14),
    (0xFB00, 1),
    (0xFB13, 4),
    (0xFB1D, 5),
    (0xFB50, 6),
    (0xFE00, 16),
    (0xFE70, 6),
    (0xFF00, 1),
    (0xFF66, 15),
    (0xFFA0, 12),
    (0x10000, 16),
    (0x20000, 14),
    (0x40000, 16),
)
SCRIPTS = 17
_SCRIPT: list[np.ndarray] = []


def scripts() -> np.ndarray:
    """Script of every code point, 0 for what is neither a letter nor a mark."""
    if not _SCRIPT:
        starts, kinds = (np.array(x) for x in zip(*SCRIPT_STARTS))
        points = np.arange(0x110000)
        table = kinds[np.searchsorted(starts, points, side="right") - 1].astype(np.uint8)
        table[[i for i in range(0x110000) if unicodedata.category(chr(i))[0] not in "LM"]] = 0
        table[0x40000:] = 0
        _SCRIPT.append(table)
    return _SCRIPT[0]


@dataclass
class Model:
    """Languages, their trigram log-probabilities (SIZE x languages) and the scripts each is written in."""

    langs: list[str]
    table: np.ndarray
    scripts: np.ndarray


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts as one array, two blanks before and after each; where each begins."""
    lower = [(t or "").lower() for t in texts]
    joined = np.frombuffer(("  " + "  ".join(lower) + "  ").encode("utf-32-le", "surrogatepass"), "<u4")
    return joined, np.cumsum([0, *(len(t) + 2 for t in lower)])


def _words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, end and script of each word."""
    kind = scripts()[points]
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    first = edge[kind[edge] > 0]
    end = edge[kind[edge - 1] > 0]
    return first, end, kind[first]


def _stretches(first: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
    """Words from a to z whose characters lie in a stretch of at most ``CHUNK``; a longer word comes alone."""
    at = 0
    while at < len(first):
        begin = int(first[at])
        z = max(at + 1, int(np.searchsorted(end, begin + CHUNK, side="right")))
        yield at, z
        at = z


def _hashes(points: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram bucket around each place from the first word's first to the last word's end, a blank at both ends of every word; and whether it is in a word."""
    begin, stop = int(first[0]), int(end[-1])
    x = points[begin:stop].astype(np.uint32)
    before, after = np.roll(x, 1), np.roll(x, -1)
    before[first - begin] = after[end - 1 - begin] = 32
    edges = np.zeros(len(x) + 1, dtype=np.int8)
    np.add.at(edges, first - begin, 1)
    np.add.at(edges, end - begin, -1)
    mixed = (before * np.uint32(0x01000193) + x) * np.uint32(0x85EBCA6B) + after
    return ((mixed * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int32), np.cumsum(edges[:-1]) > 0


def train(docs: DataFrame, use: Column | None = None) -> Model:
    """Count trigrams and scripts of all rows with a text and a lang (and ``use``, if given).

    The counts of one language are at most SIZE sums, so the driver receives a
    bounded table.  Without such rows the model has no languages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in by_bytes(batch, 1):
                own, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                for lang in dict.fromkeys(own):
                    points, _ = _points([t for t, x in zip(texts, own) if x == lang])
                    total = sums.setdefault(lang, np.zeros(SIZE + SCRIPTS, dtype=np.int64))
                    first, end, kind = _words(points)
                    for a, z in _stretches(first, end):
                        hashes, inside = _hashes(points, first[a:z], end[a:z])
                        total[:SIZE] += np.bincount(hashes[inside], minlength=SIZE)
                    total[SIZE:] += np.bincount(kind, minlength=SCRIPTS)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["lang", "bucket", "n"])

    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if use is not None:
        rows = rows.filter(use)
    counts = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(count, "lang string, bucket int, n long")
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    n = np.zeros((SIZE + SCRIPTS, len(langs)))
    if langs:
        n[found["bucket"].to_numpy(), np.searchsorted(langs, found["lang"].to_numpy())] = found["n"].to_numpy()
    grams, written = n[:SIZE], n[SIZE:]
    table = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * SIZE))
    share = written / np.maximum(written.sum(axis=0), 1)
    return Model(langs, table.astype(np.float32), share > 0.001)


def word_scores(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts: scores by language, lengths in characters, and the number of words of each text."""
    points, starts = _points(texts)
    first, end, kind = _words(points)
    scores = np.zeros((len(first), len(model.langs)), dtype=np.float32)
    for a, z in _stretches(first, end):
        hashes, begin = _hashes(points, first[a:z], end[a:z])[0], first[a]
        sums = np.zeros((len(hashes) + 1, len(model.langs)))
        np.cumsum(model.table[hashes], axis=0, dtype=np.float64, out=sums[1:])
        own = sums[end[a:z] - begin] - sums[first[a:z] - begin]
        allowed = model.scripts[kind[a:z]]
        own[~allowed & allowed.any(axis=1)[:, None]] -= 1e3
        scores[a:z] = np.maximum(own - own.max(axis=1, keepdims=True, initial=-np.inf), -30.0)
    counts = np.diff(np.searchsorted(first, starts))
    return scores, (end - first).astype(np.int32), counts


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word, where ``counts`` consecutive rows of ``scores`` make a text."""
    order = np.argsort(-counts, kind="stable")
    sizes, offsets = counts[order], (np.cumsum(counts) - counts)[order]
    steps = int(sizes[0]) if len(sizes) else 0
    # Texts with more than t words: the first active[t] of the order.
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    value = np.zeros((len(sizes), scores.shape[1]), dtype=np.float32)
    switched = np.zeros(scores.shape, dtype=bool)
    source = np.zeros(len(scores), dtype=np.int32)
    for t in range(steps):
        m = active[t]
        at, v = offsets[:m] + t, value[:m]
        if t:
            b = v.argmax(axis=1)
            best = v[np.arange(m), b][:, None] - np.float32(penalty)
            source[at], switched[at] = b, v < best
            v = np.maximum(v, best)
            v -= v.max(axis=1, keepdims=True)
        value[:m] = v + scores[at]
    label = np.zeros(len(scores), dtype=np.int32)
    state = value.argmax(axis=1).astype(np.int32)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at, s = offsets[:m] + t, state[:m]
        label[at] = s
        state[:m] = np.where(switched[at, s], source[at], s)
    return label


def _has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def detect(docs: DataFrame, model: Model, *, penalty: float = 12.0, words_at_once: int = 300_000) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` for each row of ``docs`` (doc_id, text).

    ``score`` is the share of the text's letters in spans of ``lang_pred``;
    ``spans`` lists (word, words, lang).  Ties go to the language first in the
    alphabet.  Null texts and texts without letters are ``und`` with score 0 and
    no spans, as is every text if the model has no languages.  Repeated rows are
    judged each, an empty table gives no rows; other columns are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal held
            ids = [i for h in held for i in h[0]]
            letters = [x for h in held for x in h[1]]
            counts = np.concatenate([h[4] for h in held])
            lengths = np.concatenate([h[3] for h in held])
            label = viterbi(np.concatenate([h[2] for h in held]), counts, penalty)
            text = np.repeat(np.arange(len(counts)), counts)
            share = np.zeros((len(counts), len(m.langs)))
            np.add.at(share, (text, label), lengths)
            total = share.sum(axis=1)
            best = share.argmax(axis=1)
            known = np.array(letters, dtype=bool) & (total > 0)
            score = np.where(known, share[np.arange(len(best)), best] / np.maximum(total, 1), 0.0)
            starts = np.cumsum(counts) - counts
            new = np.ones(len(label), dtype=bool)
            new[1:] = (label[1:] != label[:-1]) | (text[1:] != text[:-1])
            at = np.flatnonzero(new)
            runs = np.diff(np.concatenate([at, [len(label)]]))
            spans: list[list] = [[] for _ in ids]
            for a, r in zip(at.tolist(), runs.tolist()):
                spans[text[a]].append({"word": a - int(starts[text[a]]), "words": r, "lang": m.langs[label[a]]})
            held = []
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([m.langs[b] if k else "und" for b, k in zip(best, known)]), pa.array(score), pa.array([s if k else [] for s, k in zip(spans, known)], kind)],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

        waiting = 0
        for batch in batches:
            if not m.langs:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(["und"] * n), pa.array([0.0] * n), pa.array([[]] * n, kind)], names=["doc_id", "lang_pred", "score", "spans"])
                continue
            for part in by_bytes(batch, 1):
                texts = part.column(1).to_pylist()
                scores, lengths, counts = word_scores(m, texts)
                held.append((part.column(0).to_pylist(), [_has_letters(t) for t in texts], scores, lengths, counts))
                waiting += len(scores)
                if waiting >= words_at_once:
                    yield flush()
                    waiting = 0
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(judge, "doc_id long, lang_pred string, score double, spans array<struct<word:int,words:int,lang:string>>")
