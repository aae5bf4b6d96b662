"""Toxic passages by maximum-scoring segments of token log-odds.

Tokens are words and their beginnings (stems). Training counts each token in toxic and in clean
documents, and takes the log-odds ratio under an informative Dirichlet prior (the
corpus's own counts). Tokens whose ratio is large and significant score that ratio; every other
token costs a little. A linear scan finds all maximal scoring segments of a text (after
Ruzzo and Tompa). Segment scores over clean text follow an extreme-value law; its rate and
decay, fitted on the clean training documents, turn a segment's score and its text's
length into an expected number of chance hits, and a document's evidence is the sum over
its significant segments. A logistic curve maps evidence to a score from 0 to 1.

Only labels of training rows are read; lang, source and ids never enter a score. The
model is fitted on at most ``SAMPLE`` labelled documents, those with the least hash of their
id, near copies among them mostly once.

What the driver gets of the sample are counts: one for each score in the lexicon and one for each step of
evidence. The lexicon holds every telling token of the sample.

Defined results: a null text counts as an empty one; a text without tokens has no evidence
and gets the curve's lowest score; a label given more than once counts as toxic if any says so;
without usable labels every score is 1 / (1 + e^50); a long text is scanned whole, in time linear in its length; equal texts have
equal scores; repeated rows repeat; a table without rows gives none; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .arrow import fresh, least_hashed, small

#: Labelled documents that the model is fitted on, at most.
SAMPLE = 20_000
#: The least z-score and log-odds ratio of the tokens in the lexicon.
LEAST_Z, LEAST_RATIO = 4.0, 1.0
#: The prior's weight as a share of the corpus counts.
PRIOR = 0.05
#: What a token outside of the lexicon costs.
DRIFT = 0.1
#: Segments expected more often than this by chance are no evidence.
SIGNIFICANT = 0.05

#: Lengths of the word beginnings that are tokens too: stems that go with any ending.
STEMS = (4, 5, 6, 7)
#: In fitting, a document counts a token so many times at most, as repeats of a word say less than new documents; None: as often as it has it.
OFTEN: int | None = 5
#: Steps of evidence in the counts that the curve is fitted on.
STEP = 1e-3

_TOKEN = re.compile(r"[^\W_]+")


def forms(word: str) -> list[str]:
    """A word as a token, and its stems, which end in '*'; the longest first."""
    return [word, *(f"{word[:k]}*" for k in reversed(STEMS) if len(word) > k)]


def hits(tokens: list[str], scores: dict[str, float], heads: frozenset[str]) -> list[tuple[int, float]]:
    """The places and scores of the words that are in the lexicon, or else of their longest stem there."""
    out = []
    for i, t in enumerate(tokens):
        if t[: STEMS[0]] in heads:
            for f in forms(t):
                if f in scores:
                    out.append((i, scores[f]))
                    break
    return out


def heads_of(scores: dict[str, float]) -> frozenset[str]:
    """What the words begin with that can be in the lexicon."""
    return frozenset(t.rstrip("*")[: STEMS[0]] for t in scores)


def segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score), from the scoring tokens (place, score) in order."""
    found: list[list] = []  # first, last, total before, total after, nearest earlier segment that began lower
    total, at = 0.0, 0
    for place, score in hits:
        total -= drift * (place - at)
        low, total, at = total, total + score, place + 1
        first, j = place, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
            j -= 1
        found.append([first, place, low, total, j])
    return [(f, l, after - before) for f, l, before, after, _ in found]


@dataclass
class Model:
    """Token scores, the extreme-value law of chance segments, and the curve from evidence to score."""

    scores: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    rate: float = 1.0
    intercept: float = -50.0
    slope: float = 0.0

    def __post_init__(self):
        self.heads = heads_of(self.scores)

    def passages(self, text: str) -> tuple[int, list[tuple[int, int, float, float]]]:
        """The number of tokens, and each significant segment: first and last token, score, expected chance hits."""
        tokens = list(map(str.lower, _TOKEN.findall(text)))
        n, out = len(tokens), []
        for first, last, score in segments(hits(tokens, self.scores, self.heads)):
            chance = self.rate * n * math.exp(-self.decay * score)
            if chance <= SIGNIFICANT:
                out.append((first, last, score, chance))
        return n, out

    @staticmethod
    def evidence(found: list[tuple[int, int, float, float]]) -> float:
        return math.log1p(sum(-math.log(max(x[3], 1e-300)) for x in found))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.intercept + self.slope * evidence))))


def _lexicon(rows: DataFrame, often: int | None) -> list:
    """The tokens that tell toxic documents, with their log-odds ratio: (token, ratio)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            toxic, clean = Counter(), Counter()
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = Counter(t.lower() for t in _TOKEN.findall(text))
                seen: Counter = Counter()
                for w, n in words.items():
                    for f in forms(w):
                        seen[f] += n
                (toxic if label else clean).update({f: min(n, often or n) for f, n in seen.items()})
            tokens = list({**toxic, **clean})
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array([toxic[t] for t in tokens], pa.int64()), pa.array([clean[t] for t in tokens], pa.int64())], ["token", "toxic", "clean"])

    counted = written(rows.select("text", "toxic").mapInArrow(count, "token string, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("y1"), F.sum("clean").alias("y0")), "tokens")
    n1, n0 = counted.agg(F.sum("y1"), F.sum("y0")).first()
    if not n1 or not n0:
        return []
    prior = (F.col("y1") + F.col("y0")) * PRIOR
    weight = (n1 + n0) * PRIOR
    odds = lambda y, n: F.log((F.col(y) + prior) / (n + weight - F.col(y) - prior))
    rated = lambda rows: rows.withColumn("ratio", odds("y1", n1) - odds("y0", n0)).withColumn("z", F.col("ratio") / F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior)))
    telling = (F.col("z") >= LEAST_Z) & (F.col("ratio") >= LEAST_RATIO)
    best = rated(counted.where("y1 > 0")).where(telling)
    return [(r["token"], r["ratio"]) for r in best.select("token", "ratio").orderBy("token").collect()]  # some of the sample's words


def _calibrate(scores: dict[str, float], rows: DataFrame) -> Model:
    """Fit the extreme-value law on clean documents and the curve on all; rows are at most SAMPLE."""
    heads, least = heads_of(scores), min(scores.values())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts over clean documents: of words (kind 0), of segments (1), and of hits by their score (2)."""
        for b in small(batches):
            seen: Counter = Counter()
            for text in b.column(0).to_pylist():
                tokens = [t.lower() for t in _TOKEN.findall(text)]
                at = hits(tokens, scores, heads)
                seen[0, 0.0] += len(tokens)
                seen[1, 0.0] += sum(x[2] >= least for x in segments(at))
                seen.update((2, x[1]) for x in at)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.int32()), pa.array([v for _, v in seen], pa.float64()), pa.array(seen.values(), pa.int64())], ["kind", "value", "n"])

    counted = rows.where("toxic = 0").select("text").mapInArrow(scan, "kind int, value double, n long").groupBy("kind", "value").agg(F.sum("n").alias("n")).collect()
    of = lambda kind: [(r["value"], r["n"]) for r in counted if r["kind"] == kind]
    words = sum(n for _, n in of(0)) + 1
    # the decay at which the scores of clean text, and one hit more, no longer pay
    chance = np.array([(float(np.mean(list(scores.values()))), 1), *of(2)])
    low, high = 1e-6, 50.0
    for _ in range(100):
        decay = (low + high) / 2
        gain = (np.exp(np.minimum(700.0, decay * chance[:, 0])) * chance[:, 1]).sum() / words + (1 - chance[:, 1].sum() / words) * math.exp(-decay * DRIFT)
        low, high = (decay, high) if gain < 1 else (low, decay)
    rate = (sum(n for _, n in of(1)) + 1) / words * math.exp(decay * least)
    model = Model(scores, decay, rate)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            found = [round(model.evidence(model.passages(x)[1]) / STEP) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), b.column(1)], ["step", "toxic"])

    weighed = rows.select("text", "toxic").mapInArrow(weigh, "step long, toxic int").groupBy("step", "toxic").count().orderBy("step", "toxic").collect()
    x, y, n = (np.array([float(r[c]) for r in weighed]) for c in ("step", "toxic", "count"))
    x *= STEP
    w, design = np.zeros(2), np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):  # Newton's method with a little shrinkage
        p = 1 / (1 + np.exp(-np.clip(design @ w, -50, 50)))
        grad = design.T @ (n * (p - y)) + 1e-2 * w
        hess = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(hess, grad)
    model.intercept, model.slope = map(float, w)
    return model


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text and toxic with two independent least hashes of the text's five-word shingles."""
    for b in small(batches):
        marks = []
        for text in b.column(0).to_pylist():
            words = text.encode().lower().split()
            shingles = map(b" ".join, zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else [b" ".join(words)]
            h = np.fromiter(map(xxhash.xxh64_intdigest, shingles), np.uint64)
            marks.append((h.min(), (h * np.uint64(0x9E3779B97F4A7C15)).min()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(np.array([m[k] for m in marks], np.uint64).view(np.int64), pa.int64()) for k in (0, 1))], ["text", "toxic", "s0", "s1"])


def held_out(key: str = "doc_id") -> Column:
    """True for the fifth of the rows that no model is fitted on."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE, often: int | None = OFTEN) -> Model:
    """A model from at most ``sample`` of the labelled rows that are not held out."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.max("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    usable = written(usable.withColumn("_hash", F.xxhash64(key)), "usable")
    chosen = least_hashed(usable, "_hash", sample).drop("_hash")  # so at most ``sample`` pairs of numbers are broadcast
    rows = docs.select(key, F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(chosen), key)
    rows = rows.select("text", "toxic").mapInArrow(_sketched, "text string, toxic int, s0 long, s1 long")
    for mark in ("s0", "s1"):  # near copies of one document say a thing once: they mostly share a least shingle
        rows = rows.groupBy(mark, "toxic").agg(F.min_by(F.struct("text", "s1"), F.xxhash64("text")).alias("x")).select("x.*", "toxic")
    rows = written(rows.select("text", "toxic"), "labelled")
    found = _lexicon(rows, often)
    return _calibrate(dict(found), rows) if found else Model()


PASSAGES = "array<struct<first: long, last: long, score: double, chance: double>>"


def scored(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str, str]:
    """The columns ``keep`` (all, if none are named) of every row, and two more, whose names follow: score and passages."""
    kept = docs.columns if keep is None else keep
    extra = [fresh(docs.columns, n) for n in ("_score", "_passages")]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    names = ("first", "last", "score", "chance")
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("chance", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            found = [model.passages(x or "")[1] for x in b.column(b.num_columns - 1).to_pylist()]
            scores = [model.score(model.evidence(x)) for x in found]
            rows = [[dict(zip(names, p, strict=True)) for p in x] for x in found]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64()), pa.array(rows, kind)], [*kept, *extra])

    out = docs.select(*kept, F.col(text).alias(fresh(docs.columns, "_text"))).mapInArrow(run, f"{fields}, {extra[0]} double, {extra[1]} {PASSAGES}")
    return out, *extra


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, held_out, score, predicted and passages of every row."""
    out, score, passages = scored(docs, fit(docs, labels, text, key), text, [key])
    return out.select(key, held_out(key).alias("held_out"), F.col(score).alias("score"), (F.col(score) >= 0.5).cast("int").alias("predicted"), F.col(passages).alias("passages"))


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    out, score, _ = scored(docs, fit(docs, labels, text, key), text)
    return out.where(F.col(score) < 0.5).select(docs.columns)
