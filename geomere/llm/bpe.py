"""Byte-pair encoding and decoding of whole texts, from the merge table of a tokenizer file.

Encoding: normalise (NFC, lower case), split into words and other runs, map bytes to
the vocabulary's letters, then merge. The symbols of a word form a doubly linked list;
a priority queue holds the ranks of adjacent pairs, and entries whose pair has changed are
skipped when they come up. Decoding joins the vocabulary's strings with spaces, which is what a
tokenizer file without a decoder asks for.

Defined results: a null text counts as an empty one; an empty text has no ids and
decodes to an empty text; special strings inside a text are their own token; repeated
rows give repeated results; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import array
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import folded, slices, text_bytes
from .tokens import LATIN_END, byte_letters, tokenizer

#: Words and runs that a worker remembers; the older half goes first.
REMEMBERED = 800_000
LONGEST_REMEMBERED = 64


class Bpe:
    """A word-ending BPE model: ``encode(bytes)`` gives ids, ``decode(ids)`` the text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.strings = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        letters = byte_letters()
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.last = [vocab[letters[b] + self.suffix] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.runs = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.letter_bytes = {c: b for b, c in letters.items()}
        # Unicode tables differ between libraries outside of Latin: there the tokenizer's own normaliser and splitter are asked
        self.library = tokenizer(path)
        self.words: tuple[dict[bytes, bytes], dict[bytes, bytes]] = ({}, {})
        self.parts: tuple[dict[bytes, bytes], dict[bytes, bytes]] = ({}, {})

    def merged(self, run: bytes) -> list[int]:
        """The ids of one run of bytes."""
        ids = [self.inner[b] for b in run]
        ids[-1] = self.last[run[-1]]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, new, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := self.merges.get((new, ids[k])):
                    heapq.heappush(queue, (m[0], i, m[1], new, ids[k]))
            if (h := before[i]) >= 0 and (m := self.merges.get((ids[h], new))):
                heapq.heappush(queue, (m[0], h, m[1], ids[h], new))
        return [x for x in ids if x >= 0]

    def _part(self, run: bytes) -> bytes:
        new, old = self.parts
        if (v := new.get(run)) is None:
            if (v := old.get(run)) is None:
                v = array.array("I", self.merged(run)).tobytes()
            if len(run) <= LONGEST_REMEMBERED:
                new[run] = v
        return v

    def _word(self, word: bytes) -> bytes:
        text, out, start = word.decode("utf-8", "replace"), [], 0
        for m in self.special_at.finditer(text):
            out += [*self._plain(text[start : m.start()]), array.array("I", [self.special[m[0]]]).tobytes()]
            start = m.end()
        return b"".join(out + self._plain(text[start:]))

    def _plain(self, text: str) -> list[bytes]:
        if not text:
            return []
        if max(text) < LATIN_END:
            return [self._part(r.encode()) for r in self.runs.findall(unicodedata.normalize("NFC", text).lower())]
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [self._part(bytes(map(self.letter_bytes.__getitem__, letters))) for letters, _ in found]

    def encode(self, data: bytes) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        if len(self.words[0]) > REMEMBERED // 2:
            self.words = ({}, self.words[0])
        if len(self.parts[0]) > REMEMBERED // 2:
            self.parts = ({}, self.parts[0])
        out = []
        for part in slices(data):
            words = folded(part).split()
            new, old = self.words
            extra: dict[bytes, bytes] = {}
            for w in set(words).difference(new):
                v = old.get(w)
                (new if len(w) <= LONGEST_REMEMBERED else extra)[w] = self._word(w) if v is None else v
            out.append(b"".join(map(({**new, **extra} if extra else new).__getitem__, words)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, memoryview(ids).cast("I")))


_MODELS: dict[str, Bpe] = {}


def model(path: str) -> Bpe:
    if path not in _MODELS:
        _MODELS[path] = Bpe(path)
    return _MODELS[path]


def _mapped(docs: DataFrame, path: str, text: str, key: str, columns: str, make) -> DataFrame:
    """``key`` and what ``make(model, data)`` gives for each text."""
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, {columns}"
    names = [key, *(c.split()[0] for c in columns.split(", "))]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[c.split()[1]] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                rows = [make(bpe, x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names)

    return docs.select(F.col(key), text_bytes(text).alias("_text")).mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, the ids and the decoded text of every row."""
    return _mapped(docs, path, text, key, "ids array<long>, decoded string", lambda bpe, x: (list(memoryview(ids := bpe.encode(x)).cast("I")), bpe.decode(ids)))


def encoded_digest(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_tokens, ids_sha256 and decoded_sha256 of every row: what :func:`encoded` gives, as digests."""

    def digest(bpe: Bpe, data: bytes):
        ids = bpe.encode(data)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()

    return _mapped(docs, path, text, key, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest)
