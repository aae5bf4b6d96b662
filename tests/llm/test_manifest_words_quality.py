"""Merkle manifest, spelling variants and quality rules against brute force and planted cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from geomere.llm import merkle, quality, spelling


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r):
    return _h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r.doc_id, r.source, r.lang, r.n_chars, r.text)))


def _tree(leaves):
    """Root, and of each leaf its runs (left, right) from the bottom up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    proofs = []
    for at in range(len(leaves)):
        own = []
        for level in levels[:-1]:
            lo = at - at % 3
            own.append(("".join(level[lo:at]), "".join(level[at + 1 : lo + 3])))
            at //= 3
        proofs.append(own)
    return levels[-1][0], proofs


def _manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r.source is not None, (r.source or "").encode()), []).append(r)
    names = sorted(groups)
    trees = {}
    for g in names:
        own = sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, _leaf(r)))
        trees[g] = (own, *_tree([_leaf(r) for r in own]))
    root, over = _tree([trees[g][1] for g in names]) if names else (None, [])
    out = []
    for g, top in zip(names, over, strict=True):
        own, subroot, proofs = trees[g]
        for r, proof in zip(own, proofs, strict=True):
            x = r.asDict()
            if r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                x["text"] = r.text.replace("\n", "")
            h = _leaf(type(r)(**x))
            for left, right in proof + top:
                h = _h(left, h, right)
            out.append((str(r.doc_id), _leaf(r), subroot, root, _h(*(a + b for a, b in proof + top)), h, h == root))
    return sorted(out)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_is_brute_force(docs, levels):
    found = merkle.proved_digest(docs, levels=levels).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found) == _manifest(docs.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 82, 100])
def test_manifest_of_all_sizes(spark, n):
    """Short last subtrees at every round, a lone group, a group of one row."""
    rows = [(i, f"line {i}\nend", "x", "one" if i or n % 2 else None, i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = merkle.proved_digest(docs, levels=1).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found) == _manifest(docs.collect())


def test_manifest_gives_proofs_that_fold(docs, empty):
    found = merkle.manifest(docs, carry={"size": F.length("text")}, levels=1)
    assert found.columns == ["doc_id", "size", "position", "leaf", "subroot", "root", "proof"]
    assert found.where(merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).count() == docs.count()
    assert merkle.proved_digest(empty).count() == 0


def test_manifest_of_repeated_rows(spark):
    docs = spark.createDataFrame([(5, "same", "x", "s", 4)] * 40, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    found = merkle.manifest(docs, levels=1)
    assert sorted(r.position for r in found.collect()) == list(range(40))
    assert found.where(merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).count() == 40


def _words(rows):
    counts = Counter()
    for r in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def _variants(rows):
    n = _words(rows)
    out, form = [], {}
    near = {w: [] for w in n}
    for w in n:
        for v in n:
            if abs(len(w) - len(v)) <= 1 and w != v and _near(w, v):
                near[w].append(v)
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def _corpus(seed=3, letters="abcdéè×É"):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(6, 9))) for _ in range(60)]
    base += ["".join(r.sample(base[0], len(base[0]))) for _ in range(20)]  # anagrams
    words = list(base)
    for w in base:
        for _ in range(4):
            k = r.randrange(len(w))
            words.append(r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1 :]]))
    text = []
    for k, w in enumerate(words):
        text += [w if r.random() < 0.8 else w.upper()] * (r.choice([4, 5, 6, 30, 200]) if k % 3 else 5)
    r.shuffle(text)
    return [(i, " ".join(text[i::50])) for i in range(50)] + [(None, "lonely " * 9), (7, None), (8, ""), (9, ("x" * 3000 + " ") * 6 + ("x" * 2999 + "y ") * 6 + ("x" * 3001 + " ") * 40)]


@pytest.mark.parametrize(("leaf", "block", "sample"), [(2048, 8192, 65536), (8, 5, 65536), (8, 4, 40)])
def test_variants_are_brute_force(spark, leaf, block, sample):
    docs = spark.createDataFrame(_corpus(), "doc_id long, text string").repartition(3)
    found = spelling.variants(docs, leaf=leaf, block=block, sample=sample)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = _variants(docs.collect())
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert any(x[2] not in (x[0], x[1]) for x in want) and any(x[4] > 3 for x in want)


def test_variants_take_odd_and_empty_tables(spark, docs, empty):
    assert sorted(map(tuple, spelling.variants(docs).collect()), key=str) == _variants(docs.collect())
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "few words here")], "doc_id long, text string")).count() == 0


def test_variants_of_the_given_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert sorted(map(tuple, spelling.variants(docs, leaf=64, block=50).collect()), key=str) == _variants(docs.collect())


def _rules(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines, again, seen = text.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered), failed


def test_rules_are_brute_force(spark, docs, empty, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    odd = [(1, "a b c a b c"), (2, "a a a a"), (3, "x\n\nx\n \n x\nx\r\n"), (4, "## | <b> 　"), (5, "w " * 49 + "end"), (6, "\x1c\x85 a\x0bb\x0cc"), (7, " ".join(map(str, range(25))) + " " + " ".join(map(str, range(25))))]
    for table in (docs, spark.createDataFrame(odd, "doc_id long, text string"), spark.read.parquet(f"{data}/documents.parquet")):
        found = quality.quality_rules(table, labels).collect()
        want = sorted((str(r.doc_id), *_rules(r.text)) for r in table.collect())
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found) == want
        assert not any(r.kept and r.base_failed for r in found)
    assert quality.quality_rules(empty, labels).count() == 0


def test_labels_may_be_odd_or_missing(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(None, 1), (0, None), (1, 7), (2, 1), (2, 1), (2, 0), (100, 0)], "doc_id long, quality int")
    for labels in (none, odd):
        found = quality.quality_rules(docs, labels).collect()
        assert len(found) == docs.count() and all(r.kept is not r.base_failed for r in found)


def test_scores_are_brute_force(spark):
    r = random.Random(1)
    docs = [(i, " ".join(f"word{r.randrange(200)}" + r.choice(["", ".", ", and"] if i % 3 else ["##", " |", ","]) for _ in range(60))) for i in range(120)]
    df, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, int(bool(i % 3))) for i in range(90)], "doc_id long, quality int")
    hashed = quality.Hashed()
    grams = {i: [int(b) for part in hashed(t.encode()) for b in part] for i, t in docs}
    every = Counter(b for g in grams.values() for b in g)
    chosen = [i for i in range(90) if i % 3 and zlib.crc32(str(i).encode()) % 5]
    good = Counter(b for i in chosen for b in grams[i])
    share = sum(good.values()) / sum(every.values())
    ratio = {b: math.log((good[b] + quality.PRIOR) / (n * share + quality.PRIOR)) for b, n in every.items()}
    found = {x.doc_id: x for x in quality.quality_rules(df, labels).collect()}
    for i, g in grams.items():
        assert found[i].score == pytest.approx(sum(ratio[b] for b in g) / len(g), abs=1e-9)
    assert all(x.kept == bool(i % 3) for i, x in found.items())  # those without labels too
    tokens = re.findall(r"\w+|[^\w\s]+", docs[1][1])
    assert len(grams[1]) == 2 * len(tokens) - 1


def test_hashes_do_not_depend_on_slices():
    text = " ".join(f"word{k % 977}, x" for k in range(150_000)).encode()
    assert len(text) > 1 << 20
    found = sorted(b for part in quality.Hashed()(text) for b in part.tolist())
    quality_slices, quality.slices = quality.slices, lambda data: iter([data])
    try:
        assert sorted(b for part in quality.Hashed(most=5)(text) for b in part.tolist()) == found
    finally:
        quality.slices = quality_slices


def test_threshold():
    assert quality.threshold([]) is None and quality.threshold([(1, 5, 0)]) is None
    assert quality.threshold([(-10, 0, 50), (10, 100, 0)]) == pytest.approx(0.0005)
    assert quality.threshold([(-10, 1, 50), (-5, 3, 40), (10, 996, 10)]) == pytest.approx(3e-3)
    lost = quality.threshold([(-10, 300, 50), (10, 700, 10)])
    assert lost is None  # any threshold would reject too many trusted documents
