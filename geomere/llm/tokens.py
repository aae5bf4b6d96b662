"""Token counts and token ids of whole texts by a public tokenizer, in Arrow functions.

Written for tokenizers that lower-case and drop white space. A text is cut at ASCII white space, which the tokenizer only drops: neither
normalisation, nor pre-tokenisation, nor a merge, nor a special string reaches across
it. So the ids of a text are those of its words in a row. Rows are taken from Arrow in batches that are balanced by
bytes; a longer text is a batch of its own and is taken in slices of a megabyte. The distinct words of a batch
that the worker doesn't remember are encoded together by the library's batch encoding, of which a count
keeps the lengths only. So what a task holds beside an Arrow batch is bounded by one batch of bytes; only a text's own ids, where
they are asked for, and a single word without any white space, are as long as they are.

Defined results: a null text counts as an empty one; an empty text has no tokens;
repeated rows give repeated results; a table without rows gives none; other columns of the
input are not read.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import folded, slices, text_bytes

#: Bytes of text that are encoded together.
BATCH_BYTES = 4 << 20
#: Words that a worker remembers; the older half goes first.
REMEMBERED = 800_000
#: Letters and a run of these behind them are encoded apart. An apostrophe may begin a word ending, so it is not one.
_TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: The first letter past the Latin blocks, in which no letter changes under normalisation.
LATIN_END = "\u0250"
#: Longer words are encoded but not remembered.
LONGEST_REMEMBERED = 64


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where Latin-1 prints it, else the next free one from U+0100."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return {b: chr(b if b in printed else next(free)) for b in range(256)}


def tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class WordMemo:
    """What the tokenizer makes of a word (``kind``: its ids as little-endian bytes, or only their number)."""

    def __init__(self, path: str, value: Callable[[list[int]], object]):
        self.tokenizer, self.value = tokenizer(path), value
        self.direct = value is not len  # ids: words of letters go to the merges at once, without the library's other steps
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.new: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def of(self, words: list[bytes]) -> dict[bytes, object]:
        """A mapping that holds every one of ``words``."""
        if len(self.new) > REMEMBERED // 2:
            self.new, self.old = {}, self.new
        distinct = set(words)
        distinct.difference_update(self.new)
        unseen, joined, extra = set(), [], {}
        for w in distinct:
            if (v := self.old.get(w)) is not None:
                self.new[w] = v
                continue
            core = w.rstrip(_TAIL)
            if core is not w and core and core != w and core.decode("utf-8", "replace").lower().isalpha():
                joined.append((w, core, w[len(core) :]))
                unseen.update(x for x in joined[-1][1:] if x not in self.new)
            else:
                unseen.add(w)
        whole, merge = [], self.tokenizer.model.tokenize
        for w in unseen:
            t = w.decode("utf-8", "replace").lower()
            if self.direct and t.isalpha() and max(t) < LATIN_END:  # one run of letters: only the merges are left to do
                ids = [x.id for x in merge(t.encode().decode("latin-1").translate(self.letters))]
                (self.new if len(w) <= LONGEST_REMEMBERED else extra)[w] = self.value(ids)
            else:
                whole.append(w)
        found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in whole], add_special_tokens=False)
        for w, e in zip(whole, found, strict=True):
            (self.new if len(w) <= LONGEST_REMEMBERED else extra)[w] = self.value(e.ids)
        at = {**self.new, **extra} if extra else self.new
        for w, core, tail in joined:
            v = at[core] + at[tail]
            (self.new if len(w) <= LONGEST_REMEMBERED else extra)[w] = v
        return {**self.new, **extra} if extra else self.new


def _as_bytes(ids: list[int]) -> bytes:
    import array

    return array.array("I", ids).tobytes()


_MEMOS: dict[tuple[str, str], WordMemo] = {}


def memo(path: str, kind: str) -> WordMemo:
    """The worker's memo for a tokenizer file; kept between tasks."""
    if (path, kind) not in _MEMOS:
        _MEMOS[path, kind] = WordMemo(path, len if kind == "length" else _as_bytes)
    return _MEMOS[path, kind]


def balanced(batches: Iterator[pa.RecordBatch], column: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of a binary column; a longer value is a slice of its own."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            held = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, held + limit, "right")))
            yield b.slice(at, to - at)
            at = to


def _split(texts: list[bytes]) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The words of some texts, with the number of each text: of all at once, or of one long one slice by slice."""
    if len(texts) > 1:
        yield [(i, folded(x).split()) for i, x in enumerate(texts)]
    else:
        for x in texts:
            yield from ([(0, folded(part).split())] for part in slices(x))


def lengths(texts: list[bytes], words: WordMemo) -> list[int]:
    """The number of tokens of each of the texts of a balanced batch."""
    out = [0] * len(texts)
    for split in _split(texts):
        known = words.of([w for _, x in split for w in x])
        for i, x in split:
            out[i] += sum(map(known.__getitem__, x))
    return out


def id_bytes(texts: list[bytes], words: WordMemo) -> list[bytes]:
    """The ids of each of the texts of a balanced batch as little-endian unsigned 32-bit integers."""
    out: list[list[bytes]] = [[] for _ in texts]
    for split in _split(texts):
        known = words.of([w for _, x in split for w in x])
        for i, x in split:
            out[i].append(b"".join(map(known.__getitem__, x)))
    return [x[0] if len(x) == 1 else b"".join(x) for x in out]


def token_counts(docs: DataFrame, path: str, limit: int = 2048, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit of every row."""
    kind = docs.schema[key].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memo(path, "length")
        for b in balanced(batches, 1):
            n = lengths(b.column(1).to_pylist(), words)
            yield pa.RecordBatch.from_arrays([b.column(0), pc.binary_length(b.column(1)).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], [key, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(key), text_bytes(text).alias("_text")).mapInArrow(count, f"{key} {kind.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
