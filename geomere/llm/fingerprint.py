"""Order MinHash fingerprints of documents, in DataFrame functions only.

The tokens of a text are its words; of a word over ``LONGEST`` code points, pieces of that many, and in scripts
without spaces single code points. The k-mers are its runs of ``K`` tokens, each numbered by its
occurrence: the second time a k-mer comes, it is another element. Elements have hashes, which lie on
a circle. Each of the ``ENTRIES`` entries of a fingerprint orders the elements by how far they
lie behind its own point of the circle; it takes the two least in the order in
which the text has them, and hashes their hashes together. Two texts are as alike as the share of
their entries that are equal. As entries depend on order, moving passages changes them, as it
changes the edit distance, in short texts too: an entry is a pair wherever the text has two k-mers.

One sorted array of a text's elements serves all entries, so its cost is that of one sort. Places are held beside hashes, whole,
so no length of a text is special; a text has to fit the memory of a task several times over.

Defined results: a null text counts as an empty one, whose fingerprint is empty; a text
of fewer than ``K`` tokens is one k-mer; two empty fingerprints have likeness 1, an empty and another one 0; rows equal in id and
text count as one document in the order of documents and are each returned; rows
equal in id only are ordered by a hash of their text; a null id comes last in
descending order; the next document of the only one is itself; a table without rows gives none;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .arrow import keyed, row_key

#: Tokens in a k-mer, entries of a fingerprint (a power of two), and code points of a token at most.
K, ENTRIES, LONGEST = 3, 64, 16
_BITS = (ENTRIES - 1).bit_length()
#: Bits of a mark that hold a hash; the others hold the number of its entry.
_HASHED = 32 - _BITS
#: Scripts that are written without spaces: Thai to Tibetan, Myanmar, Khmer, kana and ideographs.
_UNSPACED = r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
TOKEN = rf"[^\x20\x09-\x0D{_UNSPACED}]{{1,{LONGEST}}}|[{_UNSPACED}]"


def _begins(a: Column, part) -> Column:
    """The places in a sorted array at which ``part`` of the elements changes."""
    places = F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda j: (j == 0) | (part(F.get(a, j)) != part(F.get(a, j - 1))))


def _kmers(hashes: Column) -> Column:
    """The hashes of a text's k-mers, in order, from those of its tokens."""
    n = F.size(hashes)
    runs = F.transform(hashes, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + j) for j in range(1, K))))
    return F.when(n >= K, F.slice(runs, F.lit(1), n - (K - 1))).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))


def _numbered(s: Column, begins: Column) -> Column:
    """Sorted struct(hash, place) of k-mers as those of elements: a k-mer's hash at first, another one each time that it comes again."""

    def run(a: Column, r: Column) -> Column:
        end = F.coalesce(F.get(begins, r + 1), F.size(s))
        again = lambda j: F.struct(F.when(j == a, F.get(s, j).hash).otherwise(F.xxhash64(F.get(s, j).hash, j - a)).alias("hash"), F.get(s, j).place.alias("place"))
        return F.transform(F.sequence(a, end - 1), again)

    return F.sort_array(F.flatten(F.transform(begins, run)))


def _arc(e: Column) -> Column:
    """The number of the arc between two entries' points that an element lies in; rises with its hash."""
    return F.shiftright(e.hash, 64 - _BITS).cast("int") + ENTRIES // 2


def _firsts(s: Column, begins: Column) -> Column:
    """For each entry the place in the sorted elements of the first one behind its point; past the last one comes the first."""
    before = lambda r: F.when(r > 0, _arc(F.get(s, F.get(begins, r - 1)))).otherwise(-1)
    reached = F.flatten(F.transform(begins, lambda a, r: F.array_repeat(a, _arc(F.get(s, a)) - before(r))))
    return F.when(F.size(s) > 0, F.concat(reached, F.array_repeat(F.lit(0), ENTRIES - 1 - _arc(F.get(s, F.size(s) - 1))))).otherwise(F.array().cast("array<int>"))


def _mark(s: Column, at: Column, entry: Column) -> Column:
    """The entry's number in the upper bits of an int, the hash of its pair in the others."""
    e, f = F.get(s, at), F.get(s, (at + 1) % F.size(s))
    h = F.when(e.place == f.place, F.xxhash64(e.hash)).when(e.place < f.place, F.xxhash64(e.hash, f.hash)).otherwise(F.xxhash64(f.hash, e.hash))
    return F.shiftleft(entry, _HASHED).bitwiseOR(F.shiftrightunsigned(h, 64 - _HASHED).cast("int"))


def with_marks(rows: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with ``name``: the marks (array<int>, in the order of entries) of a text that is not null.

    Each step is a column that the next one reads more than once, so Spark computes it once for a row.
    """
    h, k, s, b = (f"{name}_{x}" for x in ("hashes", "kmers", "sorted", "begins"))
    c = F.col
    rows = rows.withColumn(h, F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda w: F.xxhash64(w)))
    rows = rows.withColumn(k, _kmers(c(h))).withColumn(s, F.sort_array(F.transform(k, lambda x, i: F.struct(x.alias("hash"), i.alias("place")))))
    again = F.size(F.array_distinct(k)) < F.size(k)
    rows = rows.withColumn(b, F.when(again, _begins(c(s), lambda e: e.hash))).withColumn(s, F.when(c(b).isNotNull(), _numbered(c(s), c(b))).otherwise(c(s)))
    rows = rows.withColumn(b, _begins(c(s), _arc)).withColumn(b, _firsts(c(s), c(b)))
    return rows.withColumn(name, F.transform(b, lambda a, i: _mark(c(s), a, i))).drop(h, k, s, b)


def likeness(a: Column, b: Column) -> Column:
    """The share of equal entries."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / ENTRIES)


def shown(marks: Column) -> Column:
    """A fingerprint as a string: eight hex digits for each entry."""
    return F.array_join(F.transform(marks, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def ranked(keys: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """The rows with ``rank``, their place in the global order from 0, and their number. Equal rows must not be."""
    spark = keys.sparkSession
    placed = written(keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).count().orderBy("_part").collect()  # a row for each partition
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r["_part"], before))
        before += r["count"]
    table = spark.createDataFrame(offsets, "_part long, _before long")
    rank = (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank")
    return placed.withColumn("_part", part).join(F.broadcast(table), "_part").select(*keys.columns, rank), before


def edited_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Of every row: ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text of a document has the first half of the next one (in descending order of
    ``key``) in place of its own last half. Texts are shuffled once by their row, and
    only the halves that are passed on a second time.
    """
    known, none = keyed(docs, key)
    rows = docs.select(known.alias("id"), none.alias("none"), row_key(text).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = ["id", "none", "row"]
    renamed = lambda prefix: [F.col(c).alias(f"{prefix}_{c}") for c in names]
    made = written(with_marks(rows, "text", "marks").select(*names, F.length("text").alias("n"), "marks"), "marks")
    order, count = ranked(made.select(*names, "n").distinct(), [F.col("none"), F.col("id").desc(), F.col("row")])
    after = order.select(F.pmod(F.col("rank") - 1, F.lit(max(count, 1))).alias("rank"), *renamed("next"))
    plan = written(order.join(after, "rank").drop("rank"), "plan")
    marks = made.select(*names, "marks").dropDuplicates(names)

    half = F.floor(F.col("n") / 2).cast("int")
    passed = plan.select(*renamed("to"), "n", *(F.col(f"next_{c}").alias(c) for c in names))
    passed = rows.join(marks, names).join(passed, names)
    passed = passed.select(*(F.col(f"to_{c}").alias(c) for c in names), F.left("text", half).alias("tail"), F.col("marks").alias("next_marks")).dropDuplicates(names)
    own = rows.join(marks, names).join(plan.select(*names, "n"), names)
    met = own.select(*names, "n", "marks", F.left("text", F.col("n") - half).alias("head")).join(passed, names)
    edited = met.withColumn("edited", F.concat("head", "tail"))
    edited = with_marks(edited, "edited", "edited_marks").select("id", "none", "n", "marks", "next_marks", F.sha2("edited", 256).alias("edited_sha256"), "edited_marks")
    return edited.select(
        F.when(~F.col("none"), F.col("id")).alias(key),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        shown(F.col("marks")).alias("fingerprint"),
        shown(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
