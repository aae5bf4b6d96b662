"""Best-fit packing of documents into sequences of a fixed number of tokens.

Each document becomes one piece, or full pieces and a rest where it is longer than a
sequence. Full pieces are sequences of their own. The others are dealt by a hash of their place in
the table of pieces into groups of some thousand, so repeated rows are spread like any others; a task packs its group best fit first, the longest
piece first, and then improves the packing by local search: between the emptiest bin
and the other underfull bins it moves a piece, or exchanges one for one, two for one or one
for two, whenever that raises the sum of squared fill, until bins fall empty. What is
left in clearly underfull bins of all groups is dealt and packed once more, so the loss
does not grow with the number of groups.

Only lengths and checksums travel; token ids stay in the task that made them.

Defined results: a null text counts as an empty one and an empty text is one piece of the
end token; a long text's pieces are made from slices, so only its ids are held whole; equal lengths are taken in a
fixed order of their keys; repeated rows are packed each; a table without rows gives no sequences; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .arrow import text_bytes
from .tokens import balanced, id_bytes, memo

#: Pieces that one task packs together, on average.
GROUP = 4096
#: Bins filled less than this take part in the second round.
UNDERFULL = 0.97


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, piece, start, length and ids_crc32 of every piece of every document."""
    kind = docs.schema[key].dataType.simpleString()
    size = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memo(path, "ids")
        end = end_id.to_bytes(4, "little")
        for b in balanced(batches, 1):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(id_bytes(b.column(1).to_pylist(), words)):
                ids += end
                for k in range(0, len(ids), size):
                    part = ids[k : k + size]
                    row.append(i)
                    piece.append(k // size)
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], [key, "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(key), text_bytes(text).alias("_text")).mapInArrow(cut, f"{key} {kind}, piece int, start long, length long, ids_crc32 long")


class _Bins:
    """Bins of one group: the lengths in each, as (length, item) in rising order."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.fill = capacity, [], []

    def best_fit(self, lengths: list[int]) -> None:
        free: list[list[int]] = [[] for _ in range(self.capacity + 1)]  # bins by the room they have
        some = 0  # bit r is set if a bin has room r
        for item, size in sorted(enumerate(lengths), key=lambda x: (-x[1], x[0])):
            if fits := some >> size:
                room = size + (fits & -fits).bit_length() - 1
                bin_ = free[room].pop()
                if not free[room]:
                    some ^= 1 << room
            else:
                room, bin_ = self.capacity, len(self.items)
                self.items.append([])
                self.fill.append(0)
            insort(self.items[bin_], (size, item))
            self.fill[bin_] += size
            if left := room - size:
                free[left].append(bin_)
                some |= 1 << left

    def _shift(self, to: int, give: list, from_: int, take: list) -> None:
        for x in give:
            self.items[to].remove(x)
            insort(self.items[from_], x)
        for x in take:
            self.items[from_].remove(x)
            insort(self.items[to], x)
        moved = sum(x[0] for x in take) - sum(x[0] for x in give)
        self.fill[to] += moved
        self.fill[from_] -= moved

    def improve(self, to: int, from_: int) -> bool:
        """Take the most that fits from bin ``from_`` into the fuller bin ``to``."""
        room, a, b = self.capacity - self.fill[to], self.items[to], self.items[from_]
        least = max(0, self.fill[from_] - self.fill[to])  # more than this raises the squared fill
        best, plan = least, None

        def largest(limit: int, skip: int = -1) -> int:
            i = bisect_left(b, (limit + 1, -1)) - 1
            return i - (i == skip)

        if (i := largest(room)) >= 0 and b[i][0] > best:
            best, plan = b[i][0], ([], [b[i]])
        for i in range(len(b)):  # two at once
            if (j := largest(room - b[i][0], i)) > i and b[i][0] + b[j][0] > best:
                best, plan = b[i][0] + b[j][0], ([], [b[i], b[j]])
        for x in a:
            if best == room:
                break
            if (i := largest(room + x[0])) >= 0 and b[i][0] - x[0] > best:
                best, plan = b[i][0] - x[0], ([x], [b[i]])
            for i in range(len(b)):
                if (j := largest(room + x[0] - b[i][0], i)) > i and b[i][0] + b[j][0] - x[0] > best:
                    best, plan = b[i][0] + b[j][0] - x[0], ([x], [b[i], b[j]])
        for p in range(len(a)):
            for q in range(p + 1, len(a)):
                two = a[p][0] + a[q][0]
                if best < room and (i := largest(room + two)) >= 0 and b[i][0] - two > best:
                    best, plan = b[i][0] - two, ([a[p], a[q]], [b[i]])
        if plan:
            self._shift(to, plan[0], from_, plan[1])
        return bool(plan)

    def local_search(self) -> None:
        fewest = -(-sum(self.fill) // self.capacity)
        open_ = sorted((i for i, f in enumerate(self.fill) if f < self.capacity), key=lambda i: (self.fill[i], i))
        left = sum(f > 0 for f in self.fill)
        for at, bin_ in enumerate(open_):
            if left <= fewest:
                break
            moved = True
            while self.fill[bin_] and moved:  # until no partner is left that can take anything
                moved = False
                for other in reversed(open_[at + 1 :]):
                    if self.fill[bin_] <= self.fill[other] < self.capacity and self.improve(other, bin_):
                        moved = True
                        if not self.fill[bin_]:
                            break
            left -= not self.fill[bin_]


def pack_group(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """For each item its bin and its offset there, and the fill of each bin."""
    bins = _Bins(capacity)
    bins.best_fit(lengths)
    bins.local_search()
    bin_of, offset = [0] * len(lengths), [0] * len(lengths)
    for k, held in enumerate(bins.items):
        at = 0
        for size, item in reversed(held):
            bin_of[item], offset[item] = k, at
            at += size
    return bin_of, offset, bins.fill


def _dealt(items: DataFrame, key: str, capacity: int, round_: int) -> DataFrame:
    """Items with _bin (unique in its group), offset and _fill, packed in groups of about GROUP."""
    n = items.count()
    groups = max(1, round(n / GROUP))
    schema = items.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([key, "piece", "ids_crc32", "length"], kind="stable", ignore_index=True)
        bin_of, offset, fill = pack_group(pdf["length"].tolist(), capacity)
        pdf["sequence_id"] = (pdf["_group"].astype("int64") * 2 + round_) * (1 << 32) + pd.Series(bin_of, dtype="int64")
        pdf["offset"] = pd.Series(offset, dtype="int64")
        pdf["_fill"] = pd.Series([fill[b] for b in bin_of], dtype="int64")
        return pdf.drop(columns="_group")

    # by the row's place in its table: equal rows are dealt apart, so no group is larger than the others
    dealt = items.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(round_)), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(pack, f"{schema}, sequence_id long, offset long, _fill long")


def packed(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every piece of every document with its sequence_id and offset."""
    columns = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    cut = written(pieces(docs, path, capacity, end_id, text, key), "pieces")
    # below zero, so that they meet no packed sequence; a full piece is named by its content and place
    full = cut.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    first = written(_dealt(cut.where(F.col("length") < capacity), key, capacity, 0), "packed")
    well = F.col("_fill") >= int(UNDERFULL * capacity)
    again = _dealt(first.where(~well).drop("sequence_id", "offset", "_fill"), key, capacity, 1)
    return full.select(columns).unionByName(first.where(well).select(columns)).unionByName(again.select(columns))
