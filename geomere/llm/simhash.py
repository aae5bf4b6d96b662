"""SimHash near-duplicates: fingerprints of word shingles, compared exactly in tiles.

A tile holds fingerprints with the same population counts in each of four 16-bit lanes, at most some
thousand of them. Two fingerprints that differ in r bits differ by at most r
in the sum over lanes of their counts, so only tiles whose counts are that close are
paired; each such pair is compared by exclusive-or and bit counts, all rows against all rows.
Equal fingerprints are compared once. Inside a pair of tiles a dense block of links is
reduced to a spanning forest, which connects the same rows; components of the links
give the classes.

Defined results: a null text counts as an empty one; a text without words has
fingerprint zero and is linked like any other; a long text is hashed in slices of a megabyte; repeated rows repeat; a null
doc_id is never a component's id unless no other is there; a table without rows
gives none; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import written
from .arrow import fresh, keyed, row_key, slices, small, text_bytes

#: Fingerprints in a tile, on average at most.
TILE = 1024
LANES, LANE_BITS = 4, 16
SEED = 42
_SIDE = LANE_BITS + 1


def fingerprint(data: bytes, width: int = 3) -> int:
    """The majority bits of the hashes of all shingles of ``width`` words."""
    counts, total, tail = np.zeros(64, np.int64), 0, []
    for part in slices(data):
        words = tail + part.lower().split()
        if len(words) >= width:
            shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
            h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - width + 1)
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(h)
        tail = words[-(width - 1) :] if width > 1 else []
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    return int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 3) -> DataFrame:
    """``key``, _row (hash of the text) and fp (the fingerprint as a signed long)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            fp = np.array([fingerprint(x, width) for x in b.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], [key, "_row", "fp"])

    return docs.select(F.col(key), row_key(text).alias("_row"), text_bytes(text).alias("_text")).mapInArrow(run, f"{key} {kind}, _row long, fp long")


def _near_cells(radius: int) -> list[tuple[int, ...]]:
    """Half of the steps between lane counts that ``radius`` bits can make: each pair of cells once."""
    steps = itertools.product(range(-radius, radius + 1), repeat=LANES)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * LANES]


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles of unsigned fingerprints: all that are near, or a forest that connects the same ones."""
    i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
    u, v = a[i], b[j]
    other = u != v
    u, v = u[other], v[other]
    if len(u) <= len(a) + len(b):
        return u, v
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = flat[: len(u)], flat[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``radius`` bits."""
    lane = [F.bit_count(F.shiftrightunsigned("fp", LANE_BITS * k).bitwiseAND(F.lit((1 << LANE_BITS) - 1))) for k in range(LANES)]
    cell = sum((c * F.lit(_SIDE**k) for k, c in enumerate(lane)), F.lit(0))
    celled = distinct.select("fp", cell.alias("cell"))
    sizes = celled.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("chunks"))  # 17^4 rows at most
    chunk = F.pmod(F.xxhash64("fp"), "chunks")
    tiles = written(celled.join(F.broadcast(sizes), "cell").groupBy("cell", chunk.alias("chunk")).agg(F.collect_list("fp").alias("fps")), "tiles")
    steps = F.array(*(F.struct(*(F.lit(x).alias(f"s{k}") for k, x in enumerate(s)), F.lit(sum(x * _SIDE**k for k, x in enumerate(s))).alias("by")) for s in _near_cells(radius)))
    near = F.lit(True)
    for k in range(LANES):
        at = F.floor(F.col("cell") / _SIDE**k) % _SIDE + F.col(f"step.s{k}")
        near &= at.between(0, LANE_BITS)
    left = tiles.withColumn("step", F.explode(steps)).where(near).select((F.col("cell") + F.col("step.by")).alias("cell"), (F.col("step.by") == 0).alias("same"), F.col("chunk").alias("chunk_a"), F.col("fps").alias("a"))
    pairs = left.join(tiles.withColumnRenamed("fps", "b"), "cell").where("not same or chunk_a <= chunk").select("a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            (a, a_at), (b, b_at) = ((c.flatten().to_numpy().view(np.uint64), c.offsets.to_numpy() - c.offsets[0].as_py()) for c in batch.columns)
            for k in range(batch.num_rows):
                u, v = tile_links(a[a_at[k] : a_at[k + 1]], b[b_at[k] : b_at[k + 1]], radius)
                if len(u):
                    us.append(u)
                    vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64), pa.int64()) for x in (us, vs)], ["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, _row, fp and component_id (the least ``key`` of the class) of every row."""
    rows = written(fingerprints(docs, text, key), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    classes = components(links(distinct.select("fp"), radius))
    rooted = written(distinct.join(classes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp")


def kept_one(docs: DataFrame, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each class, with all its columns: the one with the least ``key`` (of those, a fixed one)."""
    classes = near_duplicates(docs, radius, text, key)
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_row").alias("row")))
    keep = classes.groupBy("root").agg(first.alias("x")).select(F.col("x.key").alias("_key"), F.col("x.row").alias("_keep"))
    names = [fresh(docs.columns, n) for n in ("_key", "_none", "_mark")]
    known = dict(zip(names, (*keyed(docs, key), row_key(text)), strict=True))
    keep = written(keep.select(*(c.alias(n) for n, c in zip(names, (*keyed(keep, "_key"), F.col("_keep")), strict=True))), "keep")
    # the rows stay where the join has put them
    return docs.withColumns(known).join(keep, names, "left_semi").dropDuplicates(names).select(docs.columns)
