"""Exact top-k search by inner product as a Voronoi kNN join.

Vectors are integers, so scores are exact. Some root of N pivots, drawn from the data, deal data and
queries into Voronoi cells. Summaries of the cells (how far their vectors lie from the pivot, at most) and of the groups of queries (the
longest query, the farthest one from the pivot) bound every score: for a vector x in a cell around c,
q x <= q c + |q| |x - c|. In a first round each query is solved in one home cell only, the one whose pivot
scores best, which gives it a k-th score to beat. Cells whose bound for a group is below
the least of these scores in the group are left out for the whole group, and each query then goes to those other cells only
that its own bound doesn't rule out. So the data is sent once, and of the queries only necessary
copies. Cells are solved locally, in blocks of bounded size, as a product of two matrices, and the best of all are merged.

Equal vectors are one row with their k + 1 least ids, as later ones can't be among the first
k: ties go to the smaller id. Shorter vectors count as if zeros followed.

The bounds spare much where vectors lie in clusters, and little in many dimensions without any; results are whole in both cases.

Defined results: rows whose vector is null or holds null or non-finite components take no part; an empty vector scores 0 with any; rows equal in id and vector count once, of
rows equal in id only all count, though not for a query of that id, which is ranked over all its vectors; a null id takes
no part; fewer than k candidates give fewer rows; a table without rows gives none; other columns are
not read, whatever their names. Scores have to fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Pivots at most (their table is held by each task), rows of data in a block and of queries beside it, and queries multiplied at once.
PIVOTS, BLOCK, QUERIES, AT_ONCE = 4096, 4096, 16384, 512


def integers(table: DataFrame, scale: float, key: str, vector: str) -> DataFrame:
    """_id, v (little-endian 64-bit integers), and its squared length, of the rows that take part."""
    x = F.col(vector)
    doubles = F.transform(x, lambda c: c.cast("double"))
    finite = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.where(F.col(key).isNotNull() & x.isNotNull()).select(F.col(key).cast("long").alias("_id"), doubles.alias("x"), F.coalesce(finite, F.lit(False)).alias("ok")).where("ok")

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = np.floor(b.column(1).flatten().to_numpy() * scale)
            if len(flat) and np.abs(flat).max() >= 2.0**62:
                raise ValueError("a component is too large for an exact score")
            flat, ends = flat.astype("<i8"), b.column(1).offsets.to_numpy() - b.column(1).offsets[0].as_py()
            parts = [flat[ends[i] : ends[i + 1]] for i in range(b.num_rows)]
            squares = [sum(int(c) ** 2 for c in p) if len(p) and np.abs(p).max() > 1 << 20 else int(p @ p) for p in parts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array(map(float, squares), pa.float64())], ["_id", "v", "square"])

    return rows.select("_id", "x").mapInArrow(scaled, "_id long, v binary, square double")


def _matrix(rows: list[bytes], dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def _products(q: np.ndarray, d: np.ndarray, longest: float) -> np.ndarray:
    """Inner products of all rows of two integer matrices, exactly."""
    if longest < 2.0**52:  # no partial sum leaves what a double holds exactly
        return (q.astype(np.float64) @ d.astype(np.float64).T).astype(np.int64)
    return (q.astype(object) @ d.astype(object).T).astype(np.int64)


def _distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (m * m).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * m @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _best(scores: np.ndarray, ids: list, query: int, k: int) -> list[tuple[int, int]]:
    """(score, id) of the best k rows for one query, ties to the smaller id."""
    if len(scores) > k + 1:
        at = np.nonzero(scores >= np.partition(scores, -(k + 1))[-(k + 1)])[0]
    else:
        at = range(len(scores))
    found = sorted((-int(scores[i]), int(x)) for i in at for x in ids[i] if x != query)
    return [(-s, x) for s, x in found[:k]]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(table: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, key: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows for each row that ``is_query`` (a condition on _id) holds for."""
    rows = written(integers(table, scale, key, vector).dropDuplicates(["_id", "v"]), "vectors")
    first = Window.partitionBy("v").orderBy("_id")
    least = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    data = written(least.groupBy("v", "square").agg(F.sort_array(F.collect_list("_id")).alias("ids")), "distinct")
    longest, size, many = data.agg(F.max("square"), F.max(F.length("v")), F.count("*")).first()
    longest, size = longest or 0.0, size or 8
    narrow = "<i2" if longest < 2.0**30 else "<i4" if longest < 2.0**62 else "<i8"  # no component is longer than its vector
    # less than one unit of a score is lost to rounding, but for a share of the greatest one
    slack = 1.0 + 1e-9 * longest

    def padded(vectors: list[bytes]) -> np.ndarray:
        return _matrix([v.ljust(size, b"\0") for v in vectors], "<i8")

    drawn = data.orderBy(F.xxhash64("v"), "v").select("v").limit(max(1, min(pivots, math.isqrt(many)))).collect()
    centres = padded([bytes(r["v"]) for r in drawn]).astype(np.float64) if drawn else np.zeros((1, size // 8))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Data with its cell, that of the nearest pivot, and the distance from it."""
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                part = b.slice(at, AT_ONCE)
                m = padded(part.column(0).to_pylist())
                d = _distances(m.astype(np.float64), centres)
                cell = d.argmin(axis=1)
                small = pa.array([r.tobytes() for r in m.astype(narrow)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(d[np.arange(len(m)), cell], pa.float64()), small, part.column(1)], ["cell", "far", "v", "ids"])

    placed = written(data.select("v", "ids").mapInArrow(cells, "cell int, far double, v binary, ids array<long>"), "cells")
    reach, chunks = np.full(len(centres), -np.inf), {}  # of a cell without data nothing is within reach
    for r in placed.groupBy("cell").agg(F.max("far").alias("far"), F.ceil(F.count("*") / BLOCK).alias("chunks")).collect():  # a row for each pivot
        reach[r["cell"]], chunks[r["cell"]] = r["far"], r["chunks"]
    some = np.array([c in chunks for c in range(len(centres))])

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with their home cell, their own length and their distance from its pivot."""
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                part = b.slice(at, AT_ONCE)
                m = padded(part.column(1).to_pylist()).astype(np.float64)
                cell = np.where(some, m @ centres.T, -np.inf).argmax(axis=1)
                off, long = np.sqrt(((m - centres[cell]) ** 2).sum(1)), np.sqrt((m * m).sum(1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell, pa.int32()), pa.array(off, pa.float64()), pa.array(long, pa.float64())], ["_id", "v", "cell", "off", "long"])

    queries = written(rows.where(is_query).select("_id", "v").mapInArrow(home, "_id long, v binary, cell int, off double, long double"), "queries")

    def solved(asked: DataFrame) -> DataFrame:
        """The best k of a block for each query that is sent to its cell. ``asked``: _id, v, cell."""
        sizes = [(r["cell"], chunks[r["cell"]], r["parts"]) for r in asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).alias("parts")).collect()]  # a row for each pivot
        table_of = F.broadcast(table.sparkSession.createDataFrame(sizes, "cell int, chunks long, parts long"))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        # data of cells that no query goes to is left out, the rest is sent once for each QUERIES that it meets
        blocks = placed.join(table_of, "cell").select("cell", F.pmod(F.xxhash64("v"), "chunks").alias("chunk"), every("parts").alias("part"), "v", "ids")
        sent = asked.join(table_of, "cell").select("cell", every("chunks").alias("chunk"), F.pmod(F.xxhash64("_id", "v"), "parts").alias("part"), "_id", "v")

        def solve(_, d: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple[int, int, int]] = []
            if len(d) and len(q):
                ids, dm, own = d["ids"].tolist(), _matrix(d["v"].tolist(), narrow), q["_id"].tolist()
                for lo in range(0, len(own), AT_ONCE):
                    scores = _products(padded(q["v"].iloc[lo : lo + AT_ONCE].tolist()), dm, longest)
                    for query, s in zip(own[lo : lo + AT_ONCE], scores, strict=True):
                        out += [(query, x, score) for score, x in _best(s, ids, query, k)]
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

        by = ["cell", "chunk", "part"]
        return blocks.groupBy(*by).cogroup(sent.groupBy(*by)).applyInPandas(solve, "query_id long, vec_id long, score long")

    found = written(_ranked(solved(queries), k).drop("rank"), "home")
    kth = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).select(F.col("query_id").alias("_id"), F.when(F.col("n") >= k, F.col("least")).alias("beat"))
    beating = written(queries.join(kth, "_id", "left"), "beating")  # no score to beat where the home cell has fewer than k vectors
    groups = beating.groupBy("cell").agg(F.max("off").alias("off"), F.max("long").alias("long"), F.min(F.coalesce(F.col("beat").cast("double"), F.lit(float("-inf")))).alias("beat")).collect()  # a row for each pivot
    length = np.sqrt((centres * centres).sum(1))
    near = np.zeros((len(centres), -(-len(centres) // 8)), np.uint8)  # a bit for each pair of cells
    for g in groups:  # the cells in which a query of the group may have a better score: q c <= p c + |q - p| |c|
        bound = centres @ centres[g["cell"]] + g["off"] * length + g["long"] * reach
        near[g["cell"]] = np.packbits(some & (bound >= g["beat"] - slack) & (np.arange(len(centres)) != g["cell"]))

    def necessary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once for every cell that its own bound doesn't rule out."""
        for b in batches:
            for i, (v, cell, long, beat) in enumerate(zip(*(b.column(c).to_pylist() for c in (1, 2, 3, 4)), strict=True)):
                at = np.nonzero(np.unpackbits(near[cell], count=len(centres)))[0]
                if beat is not None:
                    q = padded([v])[0].astype(np.float64)
                    at = at[centres[at] @ q + long * reach[at] >= beat - slack]
                if len(at):
                    same = pa.array(np.full(len(at), i))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(same), b.column(1).take(same), pa.array(at, pa.int32())], ["_id", "v", "cell"])

    others = written(beating.select("_id", "v", "cell", "long", "beat").mapInArrow(necessary, "_id long, v binary, cell int"), "necessary")
    return _ranked(found.unionByName(solved(others)), k)
