"""Token counts, BPE and packing against the tokenizers library and by their own rules."""

import array
import hashlib
import random
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geomere.llm import bpe, packing, tokens


@pytest.fixture(scope="module")
def library(vocabulary):
    return tokens.tokenizer(vocabulary)


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def _noise():
    r = random.Random(5)
    letters = "abZΣσςAÉéé̈ßİıǅﬁ①²½٣漢가​\x1c\x85\xa0　😀'_-!@#. \t\n\x0bǰJ̌K̸"
    out = ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(600)]
    parts = ["it's", "WE'LL", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'S", " ", "\n", "ΣΑΣ", "the,", "12,5"]
    return out + ["".join(r.choice(parts) for _ in range(9)) for _ in range(300)]


def test_ids_of_odd_texts_are_the_librarys(library, vocabulary):
    own, words = bpe.model(vocabulary), tokens.WordMemo(vocabulary, tokens._as_bytes)
    texts = [*_noise(), "a" * 5000, "ab " * 400_000]
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts])], ["t"])
    parts = list(tokens.balanced(iter([batch.slice(3), batch.slice(0, 3)]), 0, 1000))
    assert all(p.num_rows == 1 or sum(map(len, p.column(0).to_pylist())) <= 1000 for p in parts)
    ids = [x for p in parts for x in tokens.id_bytes(p.column(0).to_pylist(), words)]
    for text, split in zip(texts[3:] + texts[:3], ids, strict=True):
        want = array.array("I", _ids(library, text)).tobytes()
        assert split == want, text[:80]
        assert own.encode(text.encode()) == want, text[:80]
        assert own.decode(want) == library.decode(_ids(library, text), skip_special_tokens=False)


def test_counts(docs, empty, library, vocabulary):
    found = tokens.token_counts(docs, vocabulary, 100).collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(_ids(library, r.text)), n > 100) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in found) == want
    assert tokens.token_counts(empty, vocabulary).count() == 0


def test_digests_and_real_outputs_agree(docs, empty, library, vocabulary):
    digest = lambda x: hashlib.sha256(x).hexdigest()
    want = sorted((str(r.doc_id), len(i := _ids(library, r.text)), digest(array.array("I", i).tobytes()), digest(library.decode(i, skip_special_tokens=False).encode())) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encoded_digest(docs, vocabulary).collect()) == want
    real = bpe.encoded(docs, vocabulary).collect()
    assert sorted((str(r.doc_id), len(r.ids), digest(array.array("I", r.ids).tobytes()), digest(r.decoded.encode())) for r in real) == want
    assert bpe.encoded_digest(empty, vocabulary).count() == 0


def test_a_very_long_text_beside_short_ones(spark, vocabulary):
    given = spark.range(3).select(F.col("id").alias("doc_id"), F.expr("IF(id = 1, repeat('old towers ', 6000000), 'old towers')").alias("text")).coalesce(1)
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokens.token_counts(given, vocabulary).collect()} == {0: (10, 2), 1: (66_000_000, 12_000_000), 2: (10, 2)}


def test_a_third_of_all_rows_alike_is_dealt_apart(spark, vocabulary):
    given = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("old towers near cold rivers").alias("text"))
    found = packing.packed(given, vocabulary)
    assert found.agg(F.count("*"), F.sum("length")).first() == (100_000, 600_000)
    assert found.select("sequence_id").distinct().count() <= 600_000 // 4096 * 1.01 + 2
    cut = packing.pieces(given, vocabulary, 4096, 1).withColumn("ids_crc32", F.lit(1).cast("long"))
    assert packing._dealt(cut, "doc_id", 4096, 0).groupBy(F.shiftright("sequence_id", 33)).count().agg(F.max("count")).first()[0] < 2 * packing.GROUP


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_holds_every_piece_once(docs, empty, library, vocabulary, capacity):
    found = packing.packed(docs, vocabulary, capacity).collect()
    want = []
    for r in docs.collect():
        ids = [*_ids(library, r.text), 1]
        want += [(str(r.doc_id), k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(array.array("I", ids[k : k + capacity]).tobytes())) for k in range(0, len(ids), capacity)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(want)
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in found)
    assert len(bins) <= -(-total // capacity) * 1.05 + 1
    assert packing.packed(empty, vocabulary).count() == 0


def test_local_search_never_loses_an_item_and_helps():
    r = random.Random(2)
    for n in (1, 2, 50, 600):
        sizes = [r.randint(1, 1000) for _ in range(n)]
        plain = packing._Bins(1000)
        plain.best_fit(sizes)
        bin_of, offset, fill = packing.pack_group(sizes, 1000)
        assert sum(f > 0 for f in fill) <= len(plain.items)
        for k in set(bin_of):
            own = sorted((offset[i], sizes[i]) for i in range(n) if bin_of[i] == k)
            assert own[0][0] == 0 and all(a + s == b for (a, s), (b, _) in zip(own, own[1:]))
            assert sum(s for _, s in own) == fill[k] <= 1000


def test_exchanges_empty_a_bin_that_best_fit_leaves():
    bins = packing._Bins(10)
    bins.items, bins.fill = [[(3, 0), (5, 1)], [(2, 2), (5, 3)], [(2, 4), (3, 5)]], [8, 7, 5]
    bins.local_search()
    assert sum(f > 0 for f in bins.fill) == 2 and sum(bins.fill) == 20
