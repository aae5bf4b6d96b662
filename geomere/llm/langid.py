"""Language identification by Bayesian fusion of four kinds of evidence.

Text: hashed letter trigrams under a smoothed model per language, and a uniform one for
text in none of them. Declared language: how often each declaration goes with each
language. Address suffix and host: priors smoothed from all rows to the suffix to the
host, by grouped sums of the text's own posteriors, each row's own share taken out. Their
logarithms add up to the posterior.

The trigram model has every language that a labelled document names. Each is fitted on its distinct texts, of
which those with the least hashes, some ``SAMPLE``, stand for the others where there are more;
every count of declarations, suffixes and hosts covers all rows.

Defined results: a null text counts as an empty one; a row without letters has lang 'und'
and is rejected; a missing declaration, host or suffix is no evidence; ties go to the
first language in alphabetical order; a long text is counted in slices of a megabyte; repeated rows repeat; a table without rows gives none;
other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .arrow import row_key, slices, small

#: Distinct texts of a language that the trigram model is fitted on, about, where it has more.
SAMPLE = 5_000
BUCKETS = 1 << 14
#: Trigrams past this many repeat the same evidence: longer texts weigh as much as this many.
WEIGHT = 100.0
#: The weight of each level of a prior in the next.
SMOOTH = 5.0
#: The prior of text in no known language.
UNKNOWN = 0.01

_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def trigrams(data: bytes) -> np.ndarray:
    """How often each bucket occurs among the trigrams of letters and word ends of a text."""
    total = np.zeros(BUCKETS, np.int64)
    for part in slices(data):
        words = part.lower().translate(_LETTERS).split()
        if words:
            b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
            h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
            total += np.bincount(h >> np.uint32(18), minlength=BUCKETS)
    return total


@dataclass
class TextModel:
    """Log-probabilities of the buckets: a row for each language, the last for none ('und')."""

    languages: list[str]
    logs: np.ndarray

    def likelihoods(self, data: bytes) -> tuple[int, np.ndarray]:
        counts = trigrams(data)
        n = int(counts.sum())
        at = np.nonzero(counts)[0]
        return n, self.logs[:, at] @ counts[at] * min(1.0, WEIGHT / max(n, 1))


def fit(docs: DataFrame, text: str = "text", label: str = "lang") -> TextModel:
    """The trigram model of the languages that ``label`` names."""
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).alias("lang"), F.col(text).alias("text"), row_key(text).alias("_row"))
    many = rows.select("lang", "_row").distinct().groupBy("lang").count().where(F.col("count") > SAMPLE)
    bounds = many.select("lang", (SAMPLE / F.col("count") * 2.0**64 - 2.0**63).cast("long").alias("_bound"))  # a row for SAMPLE texts at most, so they are broadcast
    sample = rows.join(F.broadcast(bounds), "lang", "left").where("_bound IS NULL OR _row < _bound").groupBy("lang", "_row").agg(F.first("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            by: dict[str, np.ndarray] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by[lang] = by.get(lang, 0) + trigrams(text.encode())
            for lang, n in by.items():
                at = np.nonzero(n)[0]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["lang", "bucket", "n"])

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
    rows = sorted(found.collect(), key=lambda r: r["lang"])
    logs = np.zeros((len(rows) + 1, BUCKETS))
    for k, r in enumerate(rows):
        n = np.full(BUCKETS, 0.1)
        n[r["at"]] += r["n"]
        logs[k] = np.log(n / n.sum())
    logs[-1] = -np.log(BUCKETS)
    return TextModel([r["lang"] for r in rows], logs)


_HTML_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", re.I)
_TAG = re.compile(r"(/?)([A-Za-z][A-Za-z0-9]*)")


def page_text(html: str) -> str:
    """The text of a page, without tags, comments, scripts and styles; one pass."""
    out, inside = [], None
    for k, part in enumerate(html.split("<")):
        tag = _TAG.match(part) if k else None
        name = tag[2].lower() if tag else ""
        if inside:
            if not (tag and tag[1] and name == inside):
                continue
            inside = None
        elif name in ("script", "style") and not tag[1]:
            inside = name
            continue
        out.append(part.partition(">")[2] if k else part)
    return " ".join(out)


def from_page(html: str) -> tuple[str, str | None]:
    declared = _HTML_LANG.search(html)
    return page_text(html), declared[1].lower() if declared else None


def identified(rows: DataFrame, model: TextModel, key: str, text: str, declared: Column | None = None, host: Column | None = None, suffix: Column | None = None, parse: Callable[[str], tuple[str, str | None]] | None = None) -> DataFrame:
    """``key``, _row (hash of the text), lang, confidence, text_lang and declared of every row. ``parse`` gets text and declaration out of a document."""
    none = F.lit(None).cast("string")
    names = [*model.languages, "und"]
    width = len(names)
    kind = rows.schema[key].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            n, logs, said = [], [], []
            for x, d in zip(b.column(5).to_pylist(), b.column(2).to_pylist(), strict=True):
                body, own = parse(x) if parse else (x, None)
                count, ll = model.likelihoods(body.encode())
                n.append(count)
                logs.append(ll)
                said.append(own or d)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(said, pa.string()), b.column(3), b.column(4), pa.array(n, pa.int64()), pa.array(logs, pa.list_(pa.float64()))], [key, "_row", "declared", "host", "suffix", "n", "logs"])

    columns = [F.col(key), row_key(text).alias("_row"), (none if declared is None else F.lower(declared)).alias("declared"), (none if host is None else host).alias("host"), (none if suffix is None else suffix).alias("suffix"), F.coalesce(text, F.lit("")).alias("_text")]
    seen = written(rows.select(columns).mapInArrow(weigh, f"{key} {kind}, _row long, declared string, host string, suffix string, n long, logs array<double>"), "likelihoods")

    top = F.array_max("logs")
    odds = F.transform("logs", lambda x: F.exp(x - top))
    share = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    own = seen.withColumn("own", F.when(F.col("n") > 0, F.transform(odds, lambda x: x / share)).otherwise(F.array_repeat(F.lit(0.0), width)))
    sums = lambda c="own": [F.sum(F.col(c)[k]).alias(f"c{k}") for k in range(width)]
    packed = F.array(*(F.col(f"c{k}") for k in range(width)))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    everything = own.agg(*sums()).first()
    whole = np.array([x or 0.0 for x in everything]) + 1.0 / width
    prior = F.array(*(F.lit(float(x)) for x in whole / whole.sum()))

    hosts = own.groupBy("suffix", "host").agg(*sums()).select("suffix", "host", packed.alias("by_host"))
    by_suffix = hosts.groupBy("suffix").agg(*sums("by_host")).select(F.col("suffix").alias("_suffix"), packed.alias("by_suffix"))
    smoothed = F.zip_with("by_suffix", prior, lambda c, p: c + SMOOTH * p)
    hosts = hosts.join(by_suffix, F.col("suffix").eqNullSafe(F.col("_suffix")), "left")
    hosts = hosts.select(F.col("suffix").alias("_suffix"), F.col("host").alias("_host"), "by_host", smoothed.alias("by_suffix"))
    said = own.where("declared is not null").groupBy("declared").agg(*sums()).select(F.col("declared").alias("_said"), packed.alias("by_said"))

    joined = own.join(hosts, F.col("suffix").eqNullSafe(F.col("_suffix")) & F.col("host").eqNullSafe(F.col("_host")), "left")
    joined = joined.join(said, F.col("declared") == F.col("_said"), "left")
    rest = F.zip_with("by_suffix", "own", lambda c, o: F.greatest(c - o, F.lit(1e-9)))  # without this row's own share
    level = F.transform(rest, lambda x: x / total(rest))
    host_prior = F.zip_with(F.zip_with("by_host", "own", lambda c, o: F.greatest(c - o, F.lit(0.0))), level, lambda c, p: F.log(c + SMOOTH * p))
    declaring = F.array(*(F.lit(float(x)) for x in whole))
    others = F.zip_with("by_said", "own", lambda c, o: F.greatest(c - o, F.lit(0.0)))
    likely = F.when(F.col("by_said").isNotNull(), F.zip_with(others, declaring, lambda c, n: F.log((c + 0.5) / (n + 1.0)))).otherwise(F.array_repeat(F.lit(0.0), width))
    scored = joined.withColumn("_prior", host_prior).withColumn("_likely", likely)
    fused = F.zip_with(F.zip_with("logs", "_prior", lambda a, b: a + b), "_likely", lambda a, b: a + b)
    scored = scored.withColumn("fused", F.transform(fused, lambda x, i: x + F.when(i == width - 1, F.log(F.lit(UNKNOWN))).otherwise(F.lit(0.0))))
    best = F.array_max("fused")
    spread = total(F.transform("fused", lambda x: F.exp(x - best)))
    known = F.array(*(F.lit(x) for x in names))
    pick = lambda c: F.element_at(known, F.array_position(c, F.array_max(c)).cast("int"))
    letters = F.col("n") > 0
    return scored.select(key, "_row", F.when(letters, pick(F.col("fused"))).otherwise("und").alias("lang"), F.when(letters, 1 / spread).otherwise(F.lit(0.0)).alias("confidence"), F.when(letters, pick(F.col("logs"))).otherwise("und").alias("text_lang"), "declared")


def url_host(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))
    return F.when(found != "", found)


def page_languages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, confidence, text_lang, declared and kept of every page; ``docs`` has labelled text."""
    host = url_host(F.col("url"))
    found = identified(pages, fit(docs), "page_id", "html", None, host, F.substring_index(host, ".", -1), from_page)
    return found.drop("_row").withColumn("kept", kept())


def kept() -> Column:
    """True unless a row has no letters or is in no known language more likely than not."""
    return (F.col("lang") != "und") & (F.col("confidence") >= 0.5)


def rejected(docs: DataFrame, text: str = "text", key: str = "doc_id", declared: str = "lang", host: str = "source") -> DataFrame:
    """``key`` and _row of the documents in no known language."""
    found = identified(docs, fit(docs, text, declared), key, text, F.col(declared), F.col(host))
    return written(found.where(~kept()).select(key, "_row").distinct(), "rejected")
