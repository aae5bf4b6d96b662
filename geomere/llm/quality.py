"""Quality rules: hard rules on counts, then the log-likelihood ratio of hashed n-grams between trusted and all documents.

Tokens are runs of word characters and runs of other marks, as they are written; their n-grams of one and two are hashed
to buckets. One multinomial over the buckets counts all documents, the other those that labels
trust. The score of a document is the mean over its n-grams of log p(bucket | trusted) - log p(bucket | all), so
length alone doesn't move it. The threshold is a fixed number, found from the scores of labelled
documents that the trusted multinomial has not seen; each document is compared with it, none is drawn by chance.

Defined results: a null text counts as an empty one; without words all counts are zero and the rules reject; without tokens (only rare
kinds of white space) the score is 0; a long text is read in slices of a megabyte, repeated windows and lines
are found in all of it; repeated rows repeat; equal texts have equal scores; labels with a null id or an unknown
quality say nothing, of contradicting ones the better holds; without labels of both
qualities the method keeps what the rules keep; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .arrow import least_hashed, slices, small, text_bytes
from .toxicity import held_out

#: Buckets of n-grams are two to this.
BITS = 16
#: Trusted documents that the target multinomial counts, at most; all others serve in the corpus' one alone.
TRUSTED = 20_000
#: N-grams that each bucket counts as having been seen as often as expected.
PRIOR = 4.0
#: Steps of a score that the threshold tells apart.
STEP = 1e-3
#: Trusted documents that the threshold may reject, as a share.
LOST = 0.005
#: The rules: words at least, and the share of words in repeated windows at most.
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 0.5, 3

_SPACE, _SYMBOLS = b"\x20\x09\x0a\x0b\x0c\x0d", b"#*$%&|<>"
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words in windows of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    names: defaultdict[bytes, int] = defaultdict()
    names.default_factory = names.__len__
    ids = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    window = ids[:n]
    for k in range(1, width):  # numbers of windows of k + 1 words, from those of k words: exact, and always small
        window = np.unique(window * len(names) + ids[k : n + k], return_inverse=True)[1]
    often = np.bincount(window)[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k : n + k] |= often
    return int(covered.sum())


def rules(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    words = data.split()
    seen, again = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            again += 1
        elif line and not line.isspace():
            seen.add(line)
    bare = data.translate(None, _SPACE)
    return len(words), len(bare.decode("utf-8", "replace")), len(data) - len(data.translate(None, _SYMBOLS)), again, repeated_words(words)


class Hashed:
    """Buckets of the n-grams of texts. Hashes of tokens are remembered, of ``most`` at a time."""

    def __init__(self, bits: int = BITS, most: int = 200_000):
        self.shift, self.most = np.uint64(64 - bits), most
        self.known: dict[str, int] = {}

    def __call__(self, data: bytes) -> Iterator[np.ndarray]:
        """The buckets of all n-grams of a text, a slice at a time."""
        last = np.empty(0, np.uint64)
        for part in slices(data):
            tokens = _TOKEN.findall(part.decode("utf-8", "replace"))
            if len(self.known) > self.most:
                self.known.clear()
            known = self.known
            for t in set(tokens).difference(known):
                known[t] = xxhash.xxh64_intdigest(t.encode("utf-8", "replace"))
            own = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
            run = np.concatenate([last, own])
            pairs = (run[:-1] * _MIX ^ run[1:]) * _STEP
            last = run[-1:]
            yield (np.concatenate([own, pairs]) * _MIX >> self.shift).astype(np.int64)


@dataclass
class Model:
    """Log-likelihood ratio of each bucket."""

    ratio: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS))

    def score(self, parts: Iterator[np.ndarray]) -> float:
        total, n = 0.0, 0
        for buckets in parts:
            total += float(self.ratio[buckets].sum())
            n += len(buckets)
        return total / n if n else 0.0


def trusted(labels: DataFrame, key: str, quality: str) -> DataFrame:
    """``key`` and quality (0 or 1) of every labelled document, once."""
    usable = labels.where(F.col(key).isNotNull() & F.col(quality).isin(0, 1))
    return usable.groupBy(key).agg(F.max(quality).cast("int").alias("_quality"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", quality: str = "quality", sample: int = TRUSTED) -> Model:
    """The multinomials of all documents and of at most ``sample`` trusted ones that aren't held out, as a model."""
    known = written(trusted(labels, key, quality).where((F.col("_quality") == 1) & ~held_out(key)).select(key, F.xxhash64(key).alias("_hash")), "trusted")
    chosen = least_hashed(known, "_hash", sample).select(F.col(key).alias("_id"), F.lit(True).alias("_trusted"))
    rows = docs.select(F.col(key), text_bytes(text).alias("_text")).join(F.broadcast(chosen), F.col(key) == F.col("_id"), "left").select(F.coalesce("_trusted", F.lit(False)).alias("_trusted"), "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, counts, waiting = Hashed(), np.zeros((2, 1 << BITS), np.int64), ([], [])

        def add():
            for k, parts in enumerate(waiting):
                if parts:
                    counts[k] += np.bincount(np.concatenate(parts), minlength=1 << BITS)
                parts.clear()

        for b in small(batches):
            for is_trusted, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for buckets in hashed(data):
                    waiting[0].append(buckets)
                    if is_trusted:
                        waiting[1].append(buckets)
                    if len(buckets) > 100_000:
                        add()
            add()
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[0][used]), pa.array(counts[1][used])], ["bucket", "n_all", "n_trusted"])

    found = rows.mapInArrow(count, "bucket int, n_all long, n_trusted long").groupBy("bucket").agg(F.sum("n_all").alias("n_all"), F.sum("n_trusted").alias("n_trusted")).collect()  # a row for each bucket at most
    counts = np.zeros((2, 1 << BITS))
    for r in found:
        counts[:, r["bucket"]] = r["n_all"], r["n_trusted"]
    everything, target = counts.sum(axis=1)
    if not target:
        return Model()
    return Model(np.log((counts[1] + PRIOR) / (counts[0] * (target / everything) + PRIOR)))


def measured(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, the counts of the rules and the score of every row."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hashed()
        for b in small(batches):
            texts = b.column(1).to_pylist()
            counts = np.array([rules(x) for x in texts], np.int64).reshape(-1, len(names))
            scores = [model.score(hashed(x)) for x in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, counts.T), pa.array(scores, pa.float64())], [key, *names, "score"])

    return docs.select(F.col(key), text_bytes(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, {', '.join(f'{n} long' for n in names)}, score double")


def threshold(steps: list[tuple[int, int, int]], lost: float = LOST) -> float | None:
    """The least score to keep, from (step of a score, trusted documents, others): it parts the two best, and rejects a share ``lost`` of the trusted ones at most."""
    good, bad = sum(g for _, g, _ in steps), sum(b for _, _, b in steps)
    if not good or not bad:
        return None
    best, at, g, b = 0.0, None, 0, 0
    ordered = sorted(steps)
    for k, (_, own, others) in enumerate(ordered[:-1]):
        g, b = g + own, b + others
        if g > lost * good:
            break
        if b / bad - g / good > best:  # half-way to the next score that was seen
            best, at = b / bad - g / good, (ordered[k][0] + 1 + ordered[k + 1][0]) / 2 * STEP
    return at


def quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """``key``, counts, base_failed, score, threshold and kept of every row."""
    rows = written(measured(docs, fit(docs, labels, text, key, quality), text, key), "measured")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    known = trusted(labels, key, quality).where(held_out(key)).withColumnRenamed(key, "_id")
    steps = rows.where(~failed).join(known, F.col(key) == F.col("_id")).groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(F.sum("_quality").alias("good"), F.sum(1 - F.col("_quality")).alias("bad"))
    least = threshold([tuple(r) for r in steps.collect()])  # a row for each step of a score at most
    keep = F.lit(True) if least is None else F.col("score") >= least
    return rows.select("*", failed.alias("base_failed"), F.lit(least).cast("double").alias("threshold"), (~failed & keep).alias("kept"))

