"""Merkle manifest of a dataset: a digest of each row, a tree over the rows of each group, a tree over the groups, and each row's proof.

Rows are ranked in their group by a range shuffle and running numbers, and cut into aligned blocks of
fanout^levels rows. A block makes its own subtree. Then blocks swap: in round r, block b asks one block of each
sibling subtree of fanout^r blocks for its root (the one with b's place in it, or b's place modulo its size where the
last subtree is short) and hashes the common ancestor itself. All blocks of a subtree so hold its
root and compute it redundantly; after log(blocks) rounds each block has its whole upper proof and the
group's root, and nothing is sent down a tree. Only the digest of each block is shuffled in a round.

Defined results: a null field is ``-``; a null group is a group of its own, before all others; null keys come first; rows of
one key are ordered by their digests; repeated rows have leaves and proofs of their own; a text of any length is one field;
a group of one row is its own root, and so is a lone group; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from ..session import written

#: Children of a node, and levels of the tree that one block has.
FANOUT, LEVELS = 3, 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Siblings of one level, to the left and to the right of the row's node, as hexadecimal digits run together.
PROOF = "array<struct<left: string, right: string>>"


def digest(*fields: Column) -> Column:
    """A row's digest as hexadecimal digits: of each field its length in bytes, a colon and its text, or ``-`` for null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and a proof lead to."""
    return F.aggregate(proof, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, from the leaf to the root and left to right, run together."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def _joined(nodes: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(nodes)).hexdigest().encode()


def subtree(leaves: list[bytes], fanout: int, levels: int | None) -> list[list[bytes]]:
    """The nodes of each level, the leaves first: ``levels`` above them, or as many as leave a single node."""
    out = [leaves]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        out.append([_joined(out[-1][k : k + fanout]) for k in range(0, len(out[-1]), fanout)])
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows (named, g, item) in order, with part (a number of the place they are in, ascending) and at (their number among the rows of their group there)."""
    ordered = rows.repartitionByRange("named", "g", "item").sortWithinPartitions("named", "g", "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            at = pa.array(range(b.num_rows), pa.int64())
            group = pa.compute.binary_join_element_wise(pc.cast(pc.cast(b.column(0), pa.int8()), pa.string()), b.column(1), "")
            new = pc.indices_nonzero(pc.fill_null(pc.not_equal(group.slice(1), group.slice(0, b.num_rows - 1)), False)).to_pylist()
            begins = [0, *(int(k) + 1 for k in new), b.num_rows]
            numbers = []
            for lo, hi in zip(begins, begins[1:]):
                own = group[lo].as_py()
                n = n if own == last else 0
                numbers.append(pc.add(pc.subtract(at.slice(lo, hi - lo), lo), n))
                last, n = own, n + hi - lo
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.concat_arrays(numbers)], [*b.schema.names, "part", "at"])

    schema = T.StructType([*ordered.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])
    return ordered.mapInArrow(run, schema)


def forest(rows: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Trees over the items of each group (named, g), as blocks of items with their upper proofs.

    ``rows``: named, g and item, a struct by which items are ordered, with a field ``leaf`` of digests in binary. The
    result: named, g, block, blocks, items, upper (the proof from the block's node on) and root.
    """
    size = fanout**levels
    ranked = written(_numbered(rows.select("named", "g", "item")), "ranked")
    here = ranked.groupBy("named", "g", "part").agg(F.count("*").alias("n"))
    own = Window.partitionBy("named", "g")  # of a group, a row for each place
    before = here.select("named", "g", "part", (F.sum("n").over(own.orderBy("part")) - F.col("n")).alias("before"), F.ceil(F.sum("n").over(own) / size).alias("blocks"))
    placed = ranked.join(before, ["named", "g", "part"]).withColumn("at", F.col("at") + F.col("before"))
    gathered = placed.groupBy("named", "g", F.floor(F.col("at") / size).alias("block")).agg(F.max("blocks").alias("blocks"), F.array_sort(F.collect_list(F.struct("at", "item"))).alias("items"))

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roots = []
            for blocks, items in zip(b.column(3), b.column(4), strict=True):
                leaves = [x.hex().encode() for x in pc.struct_field(items.values, ["item", "leaf"]).to_pylist()]
                roots.append(subtree(leaves, fanout, levels if blocks.as_py() > 1 else None)[-1][0].decode())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(roots, pa.string())], [*b.schema.names, "root"])

    gathered = gathered.select("named", "g", "block", "blocks", "items")
    made = written(gathered.mapInArrow(top, T.StructType([*gathered.schema.fields, T.StructField("root", T.StringType())])), "blocks")
    state = made.select("named", "g", "block", "blocks", F.col("root").alias("digest"))
    rounds, most, r = [], made.agg(F.max("blocks")).first()[0] or 0, 0
    while fanout**r < most:
        span = fanout**r
        state = written(_swapped(state, fanout, span).withColumn("round", F.lit(r)), "round")
        rounds.append(state)
        r += 1
    if not rounds:
        return made.select("named", "g", "block", "blocks", "items", F.array().cast(PROOF).alias("upper"), "root")
    every = rounds[0]
    for x in rounds[1:]:
        every = every.unionByName(x)
    step = F.array_sort(F.collect_list(F.struct("round", "left", "right")))
    upper = every.groupBy("named", "g", "block").agg(F.transform(step, lambda x: F.struct(x["left"], x["right"])).alias("upper"), F.max_by("digest", "round").alias("top"))
    return made.join(upper, ["named", "g", "block"], "left").select("named", "g", "block", "blocks", "items", F.coalesce("upper", F.array().cast(PROOF)).alias("upper"), F.coalesce("top", "root").alias("root"))


def _swapped(state: DataFrame, fanout: int, span: int) -> DataFrame:
    """One round: each block of a group with more than one subtree of ``span`` blocks gets the roots of the run that its own is in, and hashes them."""
    mine = F.floor(F.col("block") / span)
    nodes = F.ceil(F.col("blocks") / span)
    first = mine - mine % fanout
    asked = F.sequence(first, F.least(first + fanout, nodes) - 1)
    asking = state.where(nodes > 1).select("named", "g", "block", "blocks", mine.alias("mine"), F.explode(asked).alias("node"))
    width = F.least(F.lit(span).cast("long"), F.col("blocks") - F.col("node") * span)
    asking = asking.withColumn("partner", F.col("node") * span + (F.col("block") % span) % width)
    told = asking.join(state.select("named", "g", F.col("block").alias("partner"), "digest"), ["named", "g", "partner"])
    run = F.array_sort(F.collect_list(F.struct("node", "digest")))
    got = told.groupBy("named", "g", "block").agg(F.max("blocks").alias("blocks"), F.max("mine").alias("mine"), run.alias("run"))
    side = lambda keep: F.array_join(F.transform(F.filter("run", keep), lambda x: x["digest"]), "")
    whole = F.sha2(F.array_join(F.transform("run", lambda x: x["digest"]), ""), 256)
    return got.select("named", "g", "block", "blocks", whole.alias("digest"), side(lambda x: x["node"] < F.col("mine")).alias("left"), side(lambda x: x["node"] > F.col("mine")).alias("right"))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS, carry: dict[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``key``, the columns of ``carry``, position in the group, leaf, subroot, root and proof (:data:`PROOF`, from leaf to root) of every row.

    ``carry``: small columns by name, made of those of ``docs``.
    """
    carried = {f"_c{k}": c for k, c in enumerate((carry or {}).values())}
    leaves = docs.select(F.col(group).isNotNull().alias("named"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("g"), F.col(key).alias("_key"), F.unhex(digest(*map(F.col, fields))).alias("leaf"), *(c.alias(n) for n, c in carried.items()), F.xxhash64(F.monotonically_increasing_id()).alias("_salt"))
    leaves = written(leaves, "leaves")  # the salt parts repeated rows, so that any number of them can be dealt out
    item = F.struct(F.col("_key").alias("key"), "leaf", "_salt", *carried)
    trees = written(forest(leaves.select("named", "g", item.alias("item")), fanout, levels), "trees")
    groups = trees.where("block = 0").select(F.lit(True).alias("named"), F.lit("").alias("g"), F.struct("named", "g", F.unhex("root").alias("leaf")).alias("item"))
    over = _proved(forest(groups, fanout, levels), fanout, levels)
    over = over.select(F.col("item.named").alias("named"), F.col("item.g").alias("g"), F.col("proof").alias("over"), F.col("root").alias("top"))
    rows = _proved(trees, fanout, levels).join(over, ["named", "g"])
    return rows.select(F.col("item.key").alias(key), *(F.col(f"item.{n}").alias(name) for n, name in zip(carried, carry or {}, strict=True)), F.col("at").alias("position"), F.lower(F.hex("item.leaf")).alias("leaf"), F.col("root").alias("subroot"), F.col("top").alias("root"), F.concat("proof", "over").alias("proof"))


def _proved(trees: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A row for each item of a :func:`forest`: named, g, at, item, proof and root."""
    entry = trees.schema["items"].dataType.elementType
    schema = T.StructType([T.StructField("named", T.BooleanType()), T.StructField("g", T.StringType()), *entry.fields, T.StructField("proof", T.StructType.fromDDL(f"x {PROOF}")[0].dataType), T.StructField("root", T.StringType())])
    kinds = [f.type for f in to_arrow_schema(schema)]

    def proofs(nodes: list[list[bytes]], upper: list[dict]) -> Iterator[list[dict]]:
        for at in range(len(nodes[0])):
            out = []
            for level in nodes[:-1]:
                first = at - at % fanout
                run = level[first : first + fanout]
                out.append({"left": b"".join(run[: at - first]).decode(), "right": b"".join(run[at - first + 1 :]).decode()})
                at //= fanout
            yield out + upper

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                named, g, blocks, items, upper, root = (batch.column(n)[k] for n in ("named", "g", "blocks", "items", "upper", "root"))
                entries = items.values
                leaves = [x.hex().encode() for x in pc.struct_field(entries, ["item", "leaf"]).to_pylist()]
                nodes = subtree(leaves, fanout, levels if blocks.as_py() > 1 else None)
                n = len(leaves)
                proof = pa.array(proofs(nodes, upper.as_py()), kinds[4])
                yield pa.RecordBatch.from_arrays([pa.array([named.as_py()] * n, kinds[0]), pa.array([g.as_py()] * n, kinds[1]), *(pc.struct_field(entries, f.name) for f in entry.fields), proof, pa.array([root.as_py()] * n, kinds[5])], schema=pa.schema(to_arrow_schema(schema)))

    return trees.mapInArrow(run, schema)


def tampering(text: Column, key: Column) -> Column:
    """The text without its line ends, where the checksum of the row's key is even; nulls stay."""
    return F.when(F.crc32(key.cast("string")) % 2 == 0, F.translate(text, "\n", "")).otherwise(text)


def proved_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``key``, leaf, subroot, root, proof_sha256, folded_root and verified of every row, some of whose texts are tampered with."""
    changed = [tampering(F.col(f), F.col(key)) if f == text else F.col(f) for f in FIELDS]
    found = manifest(docs, key, carry={"_now": F.unhex(digest(*changed))}, fanout=fanout, levels=levels)
    again = found.select("*", folded(F.lower(F.hex("_now")), F.col("proof")).alias("folded_root"))
    return again.select(key, "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
