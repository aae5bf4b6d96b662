"""Spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

Words of one length have a k-d tree over their letter counts. One replaced letter moves the counts by at most two in
L1 distance, one letter more or less by one, so a word is looked for in the tree of its own length within two and in
that of the next length within one; boxes farther off are pruned. A coarse tree, fitted on a bounded sample of the
words, deals all words to its leaves and sends each to the leaves that its ranges meet, lower leaves
to higher ones only, so each pair meets once. In a leaf, which a task holds, a finer tree with tight boxes
is searched in the same way, and the order of letters is compared for what it finds. Leaves of
many words are split in blocks; a task gives a count and a best neighbour for each of its words, never the pairs.

Letters are a-z, each with a count of its own, and U+00C0 to U+00FF, which share six: counts that are shared can only
bring vectors nearer, so no pair is lost.

Defined results: a null text counts as an empty one, a null id as an empty one; texts are read in slices of a megabyte, cut at white space; repeated rows count again;
equal counts are ordered by code points; a table without rows or without frequent words gives none; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .arrow import least_hashed, slices, small, text_bytes

#: Words have so many letters and occur so often at least; a form is so many times as frequent as its variant.
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: Words that the coarse trees are fitted on, leaves that they have in all, and words that a leaf is planned for.
SAMPLE, LEAVES, LEAF = 65_536, 4096, 2048
#: Words of a leaf that one task holds as data, on average at most.
BLOCK = 8192
#: Words in a box of a fine tree, at most, unless their counts are all the same.
BOX = 24
#: Of the planted slips: a run of letters whose checksum this divides loses a letter.
SLIP = 199

_RUN = re.compile("[a-zÀ-ÿ]+")
_SHARED = 6
DIMENSIONS = 26 + _SHARED
_DIMENSION = np.array([c - 97 if 97 <= c <= 122 else 26 + c % _SHARED for c in range(256)], np.intp)


def runs(data: bytes, doc_id: str) -> Iterator[tuple[str, int]]:
    """Each distinct run of letters of a text (of a slice of it), after the planted slips, and how often it occurs."""
    prefix = zlib.crc32(f"{doc_id}:".encode())
    for part in slices(data):
        for run, n in Counter(_RUN.findall(part.lower().decode("utf-8", "replace"))).items():
            h = zlib.crc32(run.encode(), prefix)
            if h % SLIP == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            yield run, n


def frequent(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """word and n of every word of ``length`` letters and ``count`` occurrences at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])
            found.clear()
            return out

        for b in small(batches):
            for doc_id, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for word, n in runs(data, doc_id):
                    if len(word) >= length:
                        found[word] += n
            if len(found) > 300_000:
                yield flushed()
        if found:
            yield flushed()

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_id"), text_bytes(text).alias("_text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def coded(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points, all below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def counts(codes: np.ndarray) -> np.ndarray:
    """How often each letter is in each word."""
    n, length = codes.shape
    if length <= 64:
        out = np.zeros((n, DIMENSIONS), np.int16)
        for k in range(length):
            out[np.arange(n), _DIMENSION[codes[:, k]]] += 1
        return out
    return np.stack([np.bincount(_DIMENSION[row], minlength=DIMENSIONS) for row in codes]).astype(np.int32)


def to_box(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """L1 distance of vectors to a box."""
    return np.maximum(np.maximum(low - vectors, vectors - high), 0).sum(axis=1)


@dataclass
class Tree:
    """A coarse tree: of each node the dimension and the cut (values up to it go left), its children, or its number as a leaf."""

    nodes: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    boxes: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    leaves: int = 0

    def grow(self, vectors: np.ndarray, most: float) -> Tree:
        """Split so that a leaf has ``most`` of the sample's vectors or fewer, or equal ones only."""
        far = np.full(DIMENSIONS, np.iinfo(np.int32).max // 4, np.int32)
        self._grow(vectors, most, -far, far)
        return self

    def _grow(self, vectors: np.ndarray, most: float, low: np.ndarray, high: np.ndarray) -> int:
        own = len(self.nodes)
        self.nodes.append((0, 0, -1, -1, -1))
        self.boxes.append((low, high))
        cut = halved(vectors) if len(vectors) > most else None
        if cut is None:
            self.nodes[own] = (0, 0, -1, -1, self.leaves)
            self.leaves += 1
            return own
        d, at = cut
        left, upper, lower = vectors[:, d] <= at, high.copy(), low.copy()
        upper[d], lower[d] = at, at + 1
        a = self._grow(vectors[left], most, low, upper)
        b = self._grow(vectors[~left], most, lower, high)
        self.nodes[own] = (d, at, a, b, -1)
        return own

    def home(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector is in."""
        out = np.zeros(len(vectors), np.int32)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            d, at, a, b, leaf = self.nodes[node]
            if leaf >= 0:
                out[rows] = leaf
                continue
            left = vectors[rows, d] <= at
            waiting += [(a, rows[left]), (b, rows[~left])]
        return out

    def met(self, vectors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Each vector (by number) and each leaf that its range meets."""
        found = [(np.empty(0, np.intp), np.empty(0, np.int32))]
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            rows = rows[to_box(vectors[rows], *self.boxes[node]) <= radius]
            if not len(rows):
                continue
            _, _, a, b, leaf = self.nodes[node]
            if leaf >= 0:
                found.append((rows, np.full(len(rows), leaf, np.int32)))
            else:
                waiting += [(a, rows), (b, rows)]
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def halved(vectors: np.ndarray) -> tuple[int, int] | None:
    """The dimension of the most even cut near the median, and the cut; None if the vectors are all the same."""
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    wide = np.flatnonzero(high > low)
    if not len(wide):
        return None
    best = None
    for d in wide:
        own = np.bincount(vectors[:, d] - low[d])
        below = np.cumsum(own)[:-1]
        k = int(np.abs(2 * below - len(vectors)).argmin())
        off = abs(2 * int(below[k]) - len(vectors))
        if best is None or off < best[0]:
            best = (off, int(d), int(low[d]) + k)
    return best[1], best[2]


def planted(words: DataFrame, sample: int = SAMPLE, leaf: int = LEAF, leaves: int = LEAVES) -> dict[int, Tree]:
    """A coarse tree for each length of a bounded sample of the words; the sample alone reaches the driver."""
    total = max(words.count(), 1)
    chosen = [r["word"] for r in least_hashed(words.select("word", F.xxhash64("word").alias("_hash")), "_hash", sample).select("word").collect()]
    by_length: dict[int, list[str]] = {}
    for w in chosen:
        by_length.setdefault(len(w), []).append(w)
    most = max(leaf * len(chosen) / total, len(chosen) / leaves, 1.0)
    return {n: Tree().grow(counts(coded(own)), most) for n, own in by_length.items()}


def search(data: np.ndarray, queries: np.ndarray, radius: int, box: int = BOX) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of (query, data) vectors within an L1 distance, by a k-d tree with tight boxes."""
    if not len(data) or not len(queries):
        return
    waiting = [(np.arange(len(data)), np.arange(len(queries)))]
    while waiting:
        own, rows = waiting.pop()
        vectors = data[own]
        rows = rows[to_box(queries[rows], vectors.min(axis=0), vectors.max(axis=0)) <= radius]
        if not len(rows):
            continue
        cut = halved(vectors) if len(own) > box else None
        if cut:
            left = vectors[:, cut[0]] <= cut[1]
            waiting += [(own[left], rows), (own[~left], rows)]
            continue
        same = len(own) > box  # all equal, and in reach as their box is
        step = max(1, 500_000 // (len(own) * (1 if same else DIMENSIONS)))
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            if same:
                yield np.repeat(part, len(own)), np.tile(own, len(part))
            else:
                i, j = np.nonzero(np.abs(queries[part][:, None] - vectors[None]).sum(axis=2) <= radius)
                yield part[i], own[j]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words, row by row, differ by one code point: replaced, or one more in ``b``."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    before = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(axis=1)
    after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return before + after >= length


def near(data: list[str], own: bool, queries: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of (query, data) words one edit apart. Queries have one length, the data's or one less; ``own``: the queries are the data, each pair counts once."""
    if not data or not queries:
        return
    b, a = coded(data), coded(queries)
    apart = b.shape[1] - a.shape[1]
    most = max(1, 4_000_000 // b.shape[1])
    for i, j in search(counts(b), counts(a), 2 - apart):
        if own:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), most):
            x, y = i[k : k + most], j[k : k + most]
            good = one_edit(a[x], b[y])
            yield x[good], y[good]


DATA, VISITOR, SHORTER = 0, 1, 2


def neighbours(words: DataFrame, trees: dict[int, Tree], block: int = BLOCK) -> DataFrame:
    """word, n_near, and the most frequent near word with its count (near_word, near_n), of every word that has one."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            strings = b.column(0).to_pylist()
            lengths = np.fromiter(map(len, strings), np.int32, len(strings))
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                vectors = counts(coded([strings[k] for k in rows]))
                tree = trees.get(length)
                home = tree.home(vectors) if tree else np.zeros(len(rows), np.int32)
                out = [(rows, np.full(len(rows), length), home, DATA)]
                if tree:
                    i, leaf = tree.met(vectors, 2)
                    up = leaf > home[i]
                    out.append((rows[i[up]], np.full(up.sum(), length), leaf[up], VISITOR))
                longer = trees.get(length + 1)
                i, leaf = longer.met(vectors, 1) if longer else (np.arange(len(rows)), np.zeros(len(rows), np.int32))
                out.append((rows[i], np.full(len(i), length + 1), leaf, SHORTER))
                for at, to, leaf, role in out:
                    part = b.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(to, pa.int32()), pa.array(leaf, pa.int32()), pa.array(np.full(len(at), role), pa.int32())], ["word", "n", "length", "leaf", "role"])

    dealt = words.select("word", "n").mapInArrow(deal, "word string, n long, length int, leaf int, role int")
    sizes = dealt.where(F.col("role") == DATA).groupBy("length", "leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    # visitors of a leaf without words find nothing
    placed = dealt.join(sizes, ["length", "leaf"])
    home = F.pmod(F.xxhash64("word"), "blocks").cast("int")
    own = F.col("role") == DATA
    spots = F.when(own, F.transform(F.sequence(home, F.col("blocks") - 1), lambda x: F.struct(x.alias("block"), (x == home).alias("here")))).otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(x.alias("block"), F.lit(False).alias("here"))))
    spread = placed.select("word", "n", "length", "leaf", "role", F.explode(spots).alias("spot"))
    role = F.when(own & ~F.col("spot.here"), VISITOR).otherwise(F.col("role"))
    spread = spread.select("word", "n", "length", "leaf", F.col("spot.block").alias("block"), role.alias("role"))
    keys = ["length", "leaf", "block"]

    def solve(table: pa.Table) -> pa.Table:
        strings, n, roles = table.column("word").to_pylist(), table.column("n").to_numpy(), table.column("role").to_numpy()
        rank = np.empty(len(strings), np.int64)
        rank[sorted(range(len(strings)), key=lambda k: (-n[k], strings[k]))] = np.arange(len(strings))
        by_rank = np.argsort(rank)
        found, best = np.zeros(len(strings), np.int64), np.full(len(strings), len(strings))
        data = np.flatnonzero(roles == DATA)
        for kind in (DATA, VISITOR, SHORTER):
            asking = np.flatnonzero(roles == kind)
            for i, j in near([strings[k] for k in data], kind == DATA, [strings[k] for k in asking]):
                u, v = asking[i], data[j]
                found += np.bincount(u, minlength=len(strings)) + np.bincount(v, minlength=len(strings))
                np.minimum.at(best, u, rank[v])
                np.minimum.at(best, v, rank[u])
        have = np.flatnonzero(found)
        other = by_rank[best[have]]
        return pa.table({"word": pa.array([strings[k] for k in have], pa.string()), "n_near": pa.array(found[have]), "near_word": pa.array([strings[k] for k in other], pa.string()), "near_n": pa.array(n[other], pa.int64())})

    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    solved = spread.repartition(max(parts, words.sparkSession.sparkContext.defaultParallelism), *keys).groupBy(*keys).applyInArrow(solve, "word string, n_near long, near_word string, near_n long")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near_word"))
    return solved.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("x")).select("word", "n_near", F.col("x.near_word").alias("near_word"), (-F.col("x.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root (where its forms lead in the end) of every row of word and form, by doubling the way in each round."""
    now = written(forms.select("word", F.col("form").alias("to")), "forms")
    while True:
        on = now.select(F.col("word").alias("at"), F.col("to").alias("next"))
        then = written(now.join(on, F.col("to") == F.col("at"), "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "forms")
        if not then.where("moved").limit(1).count():
            return then.select("word", F.col("to").alias("root"))
        now = then.select("word", "to")


def variants(docs: DataFrame, text: str = "text", key: str = "doc_id", times: int = TIMES, sample: int = SAMPLE, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near and form_n of every frequent word."""
    words = written(frequent(docs, text, key), "words")
    found = neighbours(words, planted(words, sample, leaf), block)
    is_form = F.col("near_n") >= times * F.col("n")
    known = words.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near_word")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"))
    known = written(known, "variants")
    ends = roots(known.where(F.col("form").isNotNull()))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
