"""Toxicity by a weighted finite-state pattern grammar over clauses.

Tokens of a clause belong to classes: insults (learned stems), threats, targets,
negations, reports and other words.  Weighted transducers are composed into one
machine: the first picks an insult or a threat as its hit, the next raises the
hit near a target, the others lower it behind a negation and in reported speech.
A clause's weight is the sum over all paths through that machine; a document is
scored from its clauses' weights by a logistic curve.

Insult stems, their weights and the curve are learned from labelled documents.
Stems are chosen greedily for the toxic documents they explain, so a word that
only comes along in copies of one toxic document isn't taken for an insult.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpuslens.llm.scratch import by_bytes, tidy

# Words of the grammar's closed classes (fixed values).
THREATS = "kill murder hurt destroy burn stab shoot strangle umbringen töten erschlagen verbrennen tuer frapper brûler égorger matar golpear quemar destruir".split()
TARGETS = "you your yours u he she they him her them du dich dir dein ihr euch sie tu toi te vous votre ton ustedes usted tú ti vosotros".split()
NEGATIONS = "not never no isn't aren't wasn't don't doesn't nicht nie kein keine pas jamais aucun nunca jamás tampoco".split()
REPORTS = "said says wrote writes claimed quoted reported sagte schrieb behauptete dit écrit affirma dijo escribió afirmó".split()
BREAKS = ".!?;:,\n"
BREAK = re.compile(f"[{BREAKS}]")
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
CLASSES = {w: c for c, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
TOKEN = re.compile(r"[\w']+")

NEAR = 4  # words over which a target or a negation reaches
AIMED, NEGATED, REPORTED = 1.5, 0.5, 0.6  # factors on a hit
THREAT_ALONE, THREAT_AIMED = 0.0, 2.0
HIT_INSULT, HIT_THREAT, DONE = 6, 7, -1
SYMBOLS = range(6)


@dataclass
class Transducer:
    """Weighted finite-state transducer in the real semiring.

    ``arcs[state, symbol]`` lists (next state, output, weight); ``final`` has the
    weights of states in which a clause may end.  The weight of a clause is the
    sum over its accepting paths of the products of their arcs' weights.
    """

    start: object
    arcs: dict[tuple, list[tuple]]
    final: dict

    def then(self, other: Transducer) -> Transducer:
        """Composition: ``other`` reads what this one writes; weights multiply."""
        begin = (self.start, other.start)
        arcs, final, todo, seen = {}, {}, [begin], {begin}
        symbols = {a for _, a in self.arcs}
        while todo:
            p, q = state = todo.pop()
            if p in self.final and q in other.final:
                final[state] = self.final[p] * other.final[q]
            for a in symbols:
                for p2, b, w in self.arcs.get((p, a), ()):
                    for q2, c, v in other.arcs.get((q, b), ()):
                        arcs.setdefault((state, a), []).append(((p2, q2), c, w * v))
                        if (p2, q2) not in seen:
                            seen.add((p2, q2))
                            todo.append((p2, q2))
        return Transducer(begin, arcs, final)


def marker() -> Transducer:
    """Insult and threat transducers as one: a path picks one insult or threat of the clause as its hit."""
    arcs: dict[tuple, list[tuple]] = {}
    for a in SYMBOLS:
        arcs["before", a] = [("before", a, 1.0)]
        arcs["after", a] = [("after", a, 1.0)]
    arcs["before", INSULT].append(("after", HIT_INSULT, 1.0))
    arcs["before", THREAT].append(("after", HIT_THREAT, 1.0))
    return Transducer("before", arcs, {"after": 1.0})


def aimed() -> Transducer:
    """Target transducer: a hit weighs more with a target among the ``NEAR`` words before or behind it."""
    arcs: dict[tuple, list[tuple]] = {}
    hits = ((HIT_INSULT, 1.0, AIMED), (HIT_THREAT, THREAT_ALONE, THREAT_AIMED))
    for left in range(NEAR + 1):  # words over which the last target still reaches
        for a in SYMBOLS:
            arcs[left, a] = [(NEAR if a == TARGET else max(0, left - 1), a, 1.0)]
        for hit, _, aim in hits:
            arcs[left, hit] = [(DONE, hit, aim)] if left else [((hit, NEAR), hit, 1.0)]
    final = {DONE: 1.0}
    for a in SYMBOLS:
        arcs[DONE, a] = [(DONE, a, 1.0)]
    for hit, alone, aim in hits:
        for left in range(1, NEAR + 1):  # words in which a target may still come
            final[hit, left] = alone
            for a in SYMBOLS:
                arcs[(hit, left), a] = [(DONE, a, aim) if a == TARGET else ((hit, left - 1), a, 1.0) if left > 1 else (DONE, a, alone)]
    return Transducer(0, arcs, final)


def weakened(kind: int, factor: float, reach: int | None) -> Transducer:
    """A hit weighs ``factor`` within ``reach`` words behind a word of ``kind``, anywhere behind it if that is None."""
    arcs: dict[tuple, list[tuple]] = {}
    for left in range((reach or 1) + 1):
        for a in SYMBOLS:
            arcs[left, a] = [((reach or 1) if a == kind else left if reach is None else max(0, left - 1), a, 1.0)]
        for hit in (HIT_INSULT, HIT_THREAT):
            arcs[left, hit] = [(DONE, hit, factor if left else 1.0)]
    for a in SYMBOLS:
        arcs[DONE, a] = [(DONE, a, 1.0)]
    return Transducer(0, arcs, {DONE: 1.0})


def grammar() -> Transducer:
    """The composed machine: hits, targets, negation, reported speech."""
    return marker().then(aimed()).then(weakened(NEGATION, NEGATED, NEAR)).then(weakened(REPORT, REPORTED, None))


class Machine:
    """A composed transducer as one matrix of arc weights for each symbol."""

    def __init__(self, machine: Transducer):
        states = [machine.start, *sorted({s for arcs in machine.arcs.values() for s, _, _ in arcs} - {machine.start}, key=repr)]
        at = {s: i for i, s in enumerate(states)}
        self.steps = [np.zeros((len(states), len(states))) for _ in SYMBOLS]
        self.hits = [np.zeros((len(states), len(states))) for _ in SYMBOLS]
        self.final = np.array([machine.final.get(s, 0.0) for s in states])
        for (s, a), arcs in machine.arcs.items():
            for t, out, w in arcs:
                (self.hits if out in (HIT_INSULT, HIT_THREAT) else self.steps)[a][at[s], at[t]] += w

    def weight(self, tokens: list[tuple[int, float]]) -> float:
        """Sum over all paths through a clause of (class, weight) tokens, by the forward algorithm; an insult's arc has its token's weight too."""
        v = np.zeros(len(self.final))
        v[0] = 1.0
        for kind, weight in tokens:
            now = v @ self.steps[kind]
            if kind in (INSULT, THREAT):
                now += (weight if kind == INSULT else 1.0) * (v @ self.hits[kind])
            v = now
        return float(v @ self.final)


_MACHINE: list[Machine] = []


def clause_weight(tokens: list[tuple[int, float]]) -> float:
    """Weight that the composed grammar gives a clause."""
    if not _MACHINE:
        _MACHINE.append(Machine(grammar()))
    return _MACHINE[0].weight(tokens)


@dataclass
class Model:
    """Insult stems with weights, and the curve's coefficients.  A stem ending in ``*`` fits all words it begins."""

    stems: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (-4.0, 1.0, 1.0)

    def __post_init__(self):
        parts = [re.escape(s[:-1]) + r"\w*" if s[-1] == "*" else re.escape(s) + r"\b" for s in sorted(self.stems, key=len, reverse=True)]
        parts += [re.escape(w) + r"\b" for w in THREATS]
        self.pattern = re.compile(r"\b(?:" + "|".join(parts) + ")")
        self.longest = max([len(s) for s in self.stems], default=0)

    def weight(self, word: str) -> float:
        """Weight of the longest stem that fits, 0 without one."""
        if word in self.stems:
            return self.stems[word]
        return next((self.stems[word[:n] + "*"] for n in range(min(len(word), self.longest), 0, -1) if word[:n] + "*" in self.stems), 0.0)

    def classes(self, clause: str) -> list[tuple[int, float]]:
        out = []
        for word in TOKEN.findall(clause):
            w = self.weight(word)
            out.append((INSULT, w) if w else (CLASSES.get(word, OTHER), 0.0))
        return out

    def features(self, text: str | None) -> tuple[float, float]:
        """Sum and maximum of the clauses' weights, damped.  Time grows with the text's length alone, whatever its breaks."""
        text, total, most, end = (text or "").lower(), 0.0, 0.0, 0
        while hit := self.pattern.search(text, end):
            start = max(text.rfind(c, end, hit.start()) for c in BREAKS) + 1
            stop = BREAK.search(text, hit.end())
            start, end = max(start, end), stop.start() if stop else len(text)
            w = clause_weight(self.classes(text[start:end]))
            total, most = total + w, max(most, w)
        return math.log1p(total), math.log1p(most)

    def score(self, text: str | None) -> float:
        a, b, c = self.curve
        x, y = self.features(text)
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, a + b * x + c * y))))


def _stems(word: Column) -> Column:
    """The word itself and its beginnings of four to six letters."""
    begins = F.transform(F.array(F.lit(4), F.lit(5), F.lit(6)), lambda k: F.when(F.length(word) >= k, F.concat(F.substring(word, F.lit(1), k), F.lit("*"))))
    return F.concat(F.array(word), F.filter(begins, lambda s: s.isNotNull()))


def choose(toxic_rows: dict[str, set[int]], clean: dict[str, int], n_toxic: int, n_clean: int, least: int) -> dict[str, float]:
    """Greedy choice of stems, which must explain toxic documents worth ``least`` together.

    A document is worth one, and half as much again for every chosen stem that
    it has; so several insults of a document may be learned, but the many words
    that only copies of one document share are not all taken for insults.
    """
    worth, out = dict.fromkeys(set().union(*toxic_rows.values()) if toxic_rows else (), 1.0), {}
    gain = {s: float(len(rows)) for s, rows in toxic_rows.items()}
    # Of stems with equal gain and fewest clean documents the longest one; gains only fall, so the heap's are bounds.
    heap = [(10 * clean.get(s, 0) - g, -len(s), s) for s, g in gain.items()]
    heapq.heapify(heap)
    while heap:
        _, length, best = heapq.heappop(heap)
        now = sum(worth[i] for i in toxic_rows[best])
        if now < least:
            continue
        if now < gain[best]:
            gain[best] = now
            heapq.heappush(heap, (10 * clean.get(best, 0) - now, length, best))
            continue
        odds = (len(toxic_rows[best]) + 0.5) / (n_toxic + 1) / ((clean.get(best, 0) + 0.5) / (n_clean + 1))
        out[best] = math.log(odds)
        for i in toxic_rows[best]:
            worth[i] /= 2
    return {s: w for s, w in out.items() if w > 1}


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a ridge, by Newton steps; the default curve without rows to fit."""
    if not len(x):
        return Model().curve
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.5 * np.diag([0.02, 1, 1]), a.T @ (p - y) + 0.5 * np.array([0.02, 1, 1]) * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def train(docs: DataFrame, labels: DataFrame, use: Column | None = None, *, sample_rows: int = 20_000, most_stems: int = 4096, least: int = 3) -> Model:
    """Learn from labelled rows (doc_id, toxic), of which at most about ``sample_rows`` are taken, by a hash of doc_id.

    A stem must explain ``least`` documents, and one in 200 toxic ones, by itself;
    the ``most_stems`` best candidates are compared, so the driver holds at most
    their rows of the sample.
    ``use`` filters the labelled rows.  Rows without a label, text or doc_id
    teach nothing; without toxic rows the model knows no stems, and without any
    rows its curve scores texts without hits near 0.
    """
    labels = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    if use is not None:
        labels = labels.filter(use)
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = labels.count()
    if n > sample_rows:
        labels = labels.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1_000_000)) < int(1_000_000 * sample_rows / n))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull()).join(labels, "doc_id")
    words = rows.select("doc_id", "toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}_']+"))).alias("word")).filter(F.length("word") > 1)
    stems = words.select("doc_id", "toxic", F.explode(_stems(F.col("word"))).alias("stem")).distinct()
    sizes = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    least = max(least, math.ceil(sizes.get(1, 0) / 200))
    counts = stems.groupBy("stem").agg(F.sum("toxic").alias("toxic_docs"), F.sum(1 - F.col("toxic")).alias("clean_docs"))
    gain = F.col("toxic_docs") - 10 * F.col("clean_docs")
    counts = counts.filter((F.col("toxic_docs") >= least) & (F.col("clean_docs") * 10 <= F.col("toxic_docs"))).orderBy(gain.desc(), F.length("stem").desc(), "stem").limit(most_stems).toPandas()
    clean = dict(zip(counts["stem"], counts["clean_docs"].tolist()))
    toxic_rows: dict[str, set[int]] = {}
    if clean:
        wanted = docs.sparkSession.createDataFrame(counts[["stem"]])
        for r in stems.filter("toxic = 1").join(F.broadcast(wanted), "stem").groupBy("stem").agg(F.collect_set("doc_id").alias("ids")).collect():
            toxic_rows[r["stem"]] = set(r["ids"])
    model = Model(choose(toxic_rows, clean, sizes.get(1, 0), sizes.get(0, 0), least))
    shared = docs.sparkSession.sparkContext.broadcast((model.stems, model.curve))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            found = [m.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found]), pa.array([f[1] for f in found]), batch.column(1)], names=["x", "y", "toxic"])

    seen = rows.select("text", "toxic").mapInArrow(tidy(measure), "x double, y double, toxic int").toPandas()
    return Model(model.stems, fit_curve(seen[["x", "y"]].to_numpy(), seen["toxic"].to_numpy().astype(float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a ``score`` column (double, 0 to 1) in place of any of that name.

    Null and empty texts get the curve's base score.  Every row is scored by its
    text alone; all other columns are kept.
    """
    docs = docs.drop("score")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.stems, model.curve))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            for part in by_bytes(batch, text):
                found = [m.score(None if t is None else str(t)) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], names=schema.names)

    # Columns go by place, whatever their names hold.
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(tidy(run), schema)
