"""SimHash, toxicity, fingerprints, language and personal data against brute force and planted cases."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from conftest import WORDS, rows, text
from pyspark.sql import functions as F

from geomere.llm import fingerprint, langid, pii, simhash, toxicity


def _simhash(t):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(fps, ids, radius=3):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    groups = {}
    for i, x in enumerate(ids):
        if x is not None:
            groups[root(i)] = min(groups.get(root(i), x), x)
    return [groups.get(root(i)) for i in range(len(fps))]


def test_simhash_is_brute_force(docs, empty):
    found = simhash.near_duplicates(docs).collect()
    given = docs.collect()
    fps = [_simhash(r.text) for r in given]
    want = sorted((str(r.doc_id), f, str(c)) for r, f, c in zip(given, fps, _classes(fps, [r.doc_id for r in given]), strict=True))
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in found) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_links_are_whole_for_dense_and_chained_groups(spark):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base[:4]:  # chains, and a ball in which nearly all are near
        x = b
        for _ in range(60):
            x ^= 1 << r.randrange(64)
            x ^= 1 << r.randrange(64)
            fps.add(x)
    fps |= {base[5] ^ (1 << k) for k in range(64)} | {base[5] ^ (1 << k) ^ (1 << j) for k in range(64) for j in range(k)}
    fps = sorted(fps)
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    from geomere.operators.components import components

    found = {x.node % 2**64: x.root for x in components(simhash.links(spark.createDataFrame(signed, "fp long"), 3)).collect()}
    arr, parent = np.array(fps, np.uint64), {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, f in enumerate(fps):
        for j in np.nonzero(np.bitwise_count(arr[i] ^ arr[:i]) <= 3)[0]:
            parent[root(f)] = root(fps[j])
    by_root = {}
    for f in fps:
        by_root.setdefault(root(f), []).append(f)
    for members in by_root.values():
        assert len({found.get(m, m) for m in members}) == 1
    assert len({found.get(f, f) for f in fps}) == len(by_root)


def test_one_row_of_each_class_stays(docs, empty):
    kept = simhash.kept_one(docs)
    assert kept.columns == docs.columns
    given = docs.collect()
    assert kept.count() == len(set(zip(_classes([_simhash(r.text) for r in given], [r.doc_id for r in given]))))
    assert simhash.kept_one(empty).count() == 0


def test_segments_are_the_maximal_ones():
    r = random.Random(1)
    for _ in range(200):
        scores = [r.choice([2.0, 1.0, None, None, None]) for _ in range(r.randrange(1, 25))]
        line = [(-0.75 if s is None else s) for s in scores]

        def split(lo, hi, line=line):
            """All maximal scoring segments by their definition: the best one, then left and right of it."""
            best = max(((sum(line[i:j]), -(j - i), i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=(0,))
            if best[0] <= 0:
                return []
            _, _, i, j = best
            return [*split(lo, i), (i, j - 1, best[0]), *split(j, hi)]

        found = toxicity.segments([(i, s) for i, s in enumerate(scores) if s is not None], 0.75)
        assert [x[:2] for x in found] == [x[:2] for x in split(0, len(line))]
        assert [x[2] for x in found] == pytest.approx([x[2] for x in split(0, len(line))])


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(7)
    docs, labels = [], []
    for i in range(600):
        words = [r.choice(WORDS) + r.choice(WORDS) for _ in range(r.randrange(5, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["blarghead", "snotface", "grubling"]))
        docs.append((i, " ".join(words), "m"))
        labels.append((i, int(toxic)))
    labels += [(3, None), (None, 1), (0, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, _score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_finds_held_out_documents(labelled, docs, empty):
    given, labels = labelled
    out = toxicity.toxicity(given, labels).where("held_out").collect()
    assert len(out) > 80
    assert all((x.predicted == 1) == (x.doc_id % 5 == 0) for x in out)
    assert all(0 <= x.score <= 1 for x in out) and all(bool(x.passages) == bool(x.predicted) for x in out)
    model = toxicity.fit(given, labels)
    odd, score, _ = toxicity.scored(docs, model)
    assert odd.count() == len(rows()) and odd.where(F.col(score) >= 0.5).count() == 0
    assert toxicity.accepted(given, labels).count() == 480 and toxicity.accepted(given, labels).columns == given.columns
    assert toxicity.scored(empty, model)[0].count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).where("predicted = 0").count() == len(rows())


def test_edited_texts_and_fingerprints(docs, empty):
    found = fingerprint.edited_fingerprints(docs).collect()
    assert len(found) == len(rows())
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted((i for i in texts if i is not None), reverse=True)
    by = {r.doc_id: r for r in found}
    for i, nxt in zip(ids, ids[1:]):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[nxt][:half]
        assert by[i].n_chars == len(texts[i])
        assert by[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), i
    assert by[0].fingerprint == by[1].fingerprint != by[8].fingerprint
    assert by[4].fingerprint == by[5].fingerprint == ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert by[1].near_next == 1.0 and by[100].near_edited > 0
    assert fingerprint.edited_fingerprints(empty).count() == 0


def test_a_fingerprint_sees_order_and_repeats(spark):
    words = [f"w{i}" for i in range(400)]
    swapped = words[200:] + words[:200]
    given = [(0, " ".join(words)), (1, " ".join(swapped)), (2, " ".join(words + words)), (3, " ".join(words[:380]))]
    df = fingerprint.with_marks(spark.createDataFrame(given, "i int, t string"), "t", "m").select("i", "m")
    pairs = df.alias("a").join(df.alias("b"), F.col("a.i") == 0).select("b.i", fingerprint.likeness(F.col("a.m"), F.col("b.m")).alias("x"))
    near = {r.i: r.x for r in pairs.collect()}
    assert near[0] == 1.0 and near[3] > 0.7 and near[1] < 0.85 and near[2] < 0.9
    # one mark for each entry
    assert all(len(set(x >> 26 & 63 for x in r.m)) == len(r.m) for r in df.collect())


PARTS = ["+1 (132) 555-1352 ", "4111111111111111", " ", "a@b.co", "1.2.3.4", "é", "😀", ".", "-", "+49 30 1234567 89", "256.1.1.1", "0", "12", "x_y@z.com_w@v.org", "@", "(", "+", "5", "\n", "name (at) host.com", "555-123-4567", "4539 1488 0343 6467"]
def _xx(seed, *parts):
    """Spark's hash of longs and ints (as (value, bytes) or long), one after the other."""
    for x in parts:
        value, n = x if isinstance(x, tuple) else (x, 8)
        seed = xxhash.xxh64_intdigest((value % 256**n).to_bytes(n, "little"), seed)
    return seed


def _brute_marks(t):
    """Every entry's two least elements by their distance behind its point, over all elements."""
    unspaced = "\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\U00020000-\U0003FFFF"
    tokens = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(rf"[^\x20\x09-\x0D{unspaced}]{{1,16}}|[{unspaced}]", t)]
    kmers = [_xx(42, *tokens[i : i + 3]) for i in range(len(tokens) - 2)] if len(tokens) >= 3 else [_xx(42, *tokens)] if tokens else []
    elements, seen = [], {}
    for place, k in enumerate(kmers):
        n = seen[k] = seen.get(k, -1) + 1
        elements.append((_xx(42, k, (n, 4)) if n else k, place))
    out = []
    for entry in range(64 if elements else 0):
        start = (entry - 32) * 2**58
        least = sorted(elements, key=lambda e: (e[0] - start) % 2**64)[:2]
        out.append(entry << 26 | _xx(42, *(h for h, _ in sorted(least, key=lambda e: e[1]))) >> 38)
    return out


def test_marks_are_brute_force(spark):
    r = random.Random(5)
    texts = ["", " ", "one", "two words", "a b c", "a b c d", "x" * 500, "漢字かな交じり文です" * 5, "a b c " * 40, "ไทย text 漢 mixed"]
    texts += [" ".join(r.choice(WORDS[: r.randrange(2, 20)]) for _ in range(r.randrange(1, 900))) for _ in range(60)]
    found = fingerprint.with_marks(spark.createDataFrame(list(enumerate(texts)), "i long, t string"), "t", "m").collect()
    for x in found:
        assert [m % 2**32 for m in x.m] == _brute_marks(x.t), x.t


def test_likeness_and_the_next_document_are_brute_force(docs):
    """near_edited and near_next of the odd rows, from fingerprints made anew in Python."""
    given = {(r.doc_id, r.text or "") for r in docs.collect() if r.doc_id is not None}
    ids = sorted({i for i, _ in given}, reverse=True)
    by_id = {i: [t for j, t in given if j == i] for i in ids}
    like = lambda a, b: 1.0 if not a and not b else sum(x == y for x, y in zip(a, b)) / 64
    found = {(r.doc_id, r.n_chars): r for r in fingerprint.edited_fingerprints(docs).collect()}
    for here, after in zip(ids, ids[1:]):
        if len(by_id[here]) == len(by_id[after]) == 1:
            (t,), (u,) = by_id[here], by_id[after]
            half = len(t) // 2
            row, own = found[here, len(t)], _brute_marks(t)
            assert row.near_edited == like(own, _brute_marks(t[: len(t) - half] + u[:half])) and row.near_next == like(own, _brute_marks(u))
            assert row.fingerprint == "".join(f"{m:08x}" for m in own)


@pytest.mark.parametrize("n", [30, 60, 100, 400])
def test_swapped_halves_of_short_texts_are_half_as_like(spark, n):
    words = [[f"w{k}x{i}" for i in range(n)] for k in range(40)]
    pairs = [(" ".join(w), " ".join(w[n // 2 :] + w[: n // 2])) for w in words]
    df = fingerprint.with_marks(fingerprint.with_marks(spark.createDataFrame(pairs, "t string, u string"), "t", "m"), "u", "o")
    assert 0.35 < df.agg(F.avg(fingerprint.likeness(F.col("m"), F.col("o")))).first()[0] < 0.6



PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _base(t):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = (True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 14 <= len(d) <= 19 and _luhn(d), 10 <= len(d) <= 15)[kind]
            out += [(m.start(), kind, m.end())] * ok
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_personal_data_keeps_the_strict_spans(spark, docs, empty):
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(1, 30))) for _ in range(400)] + [None, "", "7" * 3000, "a." * 3000, "1.2.3.4 " * 2000, "1." * 2000]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for x in pii.personal_data(given).collect():
        want = _base(texts[x.doc_id])
        assert x.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[x.doc_id]
        assert set(want.split(",")) <= set(x.spans.split(",")) or not want
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(p.startswith(k) for p in want.split(",")) for k in pii.KINDS]
    assert pii.personal_data(docs).count() == len(rows()) and pii.personal_data(empty).count() == 0


def test_the_method_adds_cards_that_run_together(spark):
    given = [(i, f"pay by card 4111111111111111 4539148803436467 now, call +1 (201) 555-01{i:02d} please") for i in range(40)]
    out = pii.personal_data(spark.createDataFrame(given, "doc_id long, text string")).collect()
    assert all(x.n_card == 0 and x.spans.count("card:") == 2 for x in out)


def test_the_method_finds_planted_spans_that_the_patterns_miss(spark):
    r = random.Random(11)

    def card():
        body = [4, *(r.randrange(10) for _ in range(14))]
        return "".join(map(str, body)) + str((-sum(sum(divmod(d * (2 if i % 2 == 0 else 1), 10)) for i, d in enumerate(body))) % 10)

    phone = lambda: f"({r.randrange(200, 999)}) {r.randrange(200, 999)}-{r.randrange(10_000):04d}"
    name = lambda: f"{r.choice(WORDS)}.{r.choice(WORDS)}{r.randrange(99)}"
    plain = [lambda: f"write to {name()}@{r.choice(WORDS)}.com", lambda: f"pay by card {card()}", lambda: f"call me at +1 {phone()}", lambda: f"the server {r.randrange(1, 223)}.{r.randrange(256)}.7.{r.randrange(256)}"]
    hidden = {
        "email": lambda: ("mail me: ", f"{name()} (at) {r.choice(WORDS)} (dot) com"), "phone": lambda: ("please call ", phone()),
        "card": lambda: (f"card 4111111111111111 ", card()), "ip": lambda: ("on host ", f"{r.randrange(1, 223)}.{r.randrange(256)}[.]3[.]{r.randrange(256)}"),
    }
    decoys = [lambda: f"order 2024-{r.randrange(100, 999)}-{r.randrange(1000, 9999)}", lambda: f"isbn 978{r.randrange(10**10):010d}", lambda: f"look at page {r.randrange(9)}.", lambda: f"version {r.randrange(300, 999)}.{r.randrange(300, 999)}.{r.randrange(9)}.1[.]2", lambda: f"total 1{r.randrange(10**3):03d} 2{r.randrange(10**2):02d}.50"]
    docs, planted = [], set()
    for i in range(600):
        t = f"{text(6, i)} {r.choice(plain)()} {text(4, i)} "
        if i % 3 == 0:
            kind = r.choice(list(hidden))
            front, span = hidden[kind]()
            t += front
            planted.add((i, f"{kind}:{len(t)}:{len(t) + len(span)}"))
            t += span + " "
        docs.append((i, t + f"{text(4, i)} {r.choice(decoys)()} {text(5, i)}"))
    found = pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    base = {(i, x) for i, t in docs for x in _base(t).split(",")}
    added = {(x.doc_id, s) for x in found for s in x.spans.split(",") if s} - base
    first_cards = {(i, s) for i, s in added - planted if docs[i][1][int(s.split(":")[1]) :].startswith("4111111111111111")}  # the other of two in a run
    hits, wrong = len(added & planted), len(added - planted - first_cards)
    print(f"recall {hits / len(planted):.2f}, precision {hits / (hits + wrong):.2f}")
    assert hits >= 0.9 * len(planted) and wrong <= 0.05 * hits


def test_redaction(spark, docs):
    given = spark.createDataFrame([(1, "mail bob@x.org, card 4111111111111111", "q"), (2, None, "q"), (3, "é 1.2.3.4 ü", "q")], "doc_id long, text string, _spans string")
    out = pii.redacted(given)
    assert out.columns == given.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "mail [EMAIL], card [CARD]", 2: None, 3: "é [IP] ü"}


def test_running_sums(spark):
    lengths = [[], [3], list(range(200)), [1] * 64, [2] * 65]
    df = spark.createDataFrame([(x,) for x in lengths], "a array<int>").select("a", pii.running(F.col("a")).alias("s"))
    for r in df.collect():
        assert list(r.s) == [sum(r.a[:i]) for i in range(len(r.a))]


def test_expectation_maximisation_finds_who_is_right():
    r = random.Random(9)
    truth = [r.random() < 0.6 for _ in range(4000)]
    rates = [(0.95, 0.05), (0.9, 0.1), (0.8, 0.2), (0.85, 0.3), (0.6, 0.4), (0.9, 0.2)]
    counts = {}
    for t in truth:
        v = sum((r.random() < (h if t else a)) << k for k, (h, a) in enumerate(rates))
        counts[v] = counts.get(v, 0) + 1
    prior, found, _ = pii.expectation_maximisation({v: (0, n) for v, n in counts.items()})
    assert prior == pytest.approx(0.6, abs=0.05)
    assert all(abs(h - fh) < 0.06 and abs(a - fa) < 0.06 for (h, a), (fh, fa) in zip(rates, found, strict=True))


def test_base_spans_anchor_expectation_maximisation():
    """With more false candidates than true ones, cases that are known keep the labelers from trading places."""
    r = random.Random(10)
    rates = [(0.95, 0.3), (0.9, 0.2), (0.8, 0.2), (0.85, 0.3), (0.7, 0.4), (0.9, 0.25)]
    counts = {}
    for k in range(6000):
        base = k % 3 == 0
        t = base or r.random() < 0.2
        v = sum((r.random() < (h if t else a)) << j for j, (h, a) in enumerate(rates))
        b, n = counts.get(v, (0, 0))
        counts[v] = (b + base, n + (not base))
    prior, found, post = pii.expectation_maximisation(counts)
    assert prior == pytest.approx(0.2, abs=0.06)
    assert all(abs(h - fh) < 0.08 and abs(a - fa) < 0.08 for (h, a), (fh, fa) in zip(rates, found, strict=True))
    assert post[63] > 0.95 and post[0] < 0.05
    everything_known = {63: (10, 0), 0: (0, 5)}
    assert pii.expectation_maximisation(everything_known)[2][63] > 0.9


LANGS = {"en": "the and of is that with which was from this are", "de": "der und nicht mit eine ist von auch über für", "fr": "le les une avec dans être où très déjà est"}


def test_languages(spark, docs, empty):
    r = random.Random(6)
    made = [(i, " ".join(r.choice(LANGS[lang].split()) for _ in range(40)), lang, "s") for i, lang in enumerate(["en", "de", "fr"] * 40)]
    train = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    html = lambda lang, body, said: f'<html lang="{said}"><head><script>var der = "und";</script></head><body><p>{body}</p><!-- x --></body></html>'
    pages = [(i, f"http://h{i % 3}.example.{lang}/a", html(lang, t, lang)) for i, t, lang, _ in made]
    pages += [(1000, "http://h0.example.en/a", html("en", "der und nicht mit eine ist von auch über", "en")), (1001, None, None), (1002, "x", ""), (1003, "http://h1.example.de", "<p>12 34"), (0, pages[0][1], pages[0][2])]
    out = langid.page_languages(spark.createDataFrame(pages, "page_id long, url string, html string"), train).collect()
    assert len(out) == len(pages)
    by = {x.page_id: x for x in out}
    assert all(by[i].lang == lang and by[i].kept for i, _, lang, _ in made)
    assert by[1000].text_lang == "de" and by[1000].declared == "en"
    assert not any(by[i].kept for i in (1001, 1002, 1003))
    gone = langid.rejected(docs)
    assert {r.doc_id for r in gone.collect()} >= {3, 4, 5}
    assert not {r.doc_id for r in gone.collect()} & {0, 1, 2, 8, 100}
    from geomere.llm.arrow import without

    left = without(docs, gone)
    assert left.columns == docs.columns and 0 < left.count() < docs.count()
    assert langid.rejected(empty).count() == 0


def _made(labels, texts=3):
    """Labelled documents of languages that share no word."""
    words = lambda k: ["".join(chr(97 + (k * 7 + j * (k % 5 + 3) + i * i) % 26) for i in range(7)) for j in range(12)]
    r = random.Random(3)
    return [(k * texts + i, " ".join(r.choice(words(k)) for _ in range(40)), lang, None) for k, lang in enumerate(labels) for i in range(texts)]


def test_every_language_has_a_model(spark):
    labels = [f"l{k:02d}" for k in range(70)]
    docs = spark.createDataFrame(_made(labels), "doc_id long, text string, lang string, source string")
    assert langid.fit(docs).languages == labels
    assert langid.rejected(docs).count() == 0


def test_copies_and_frequent_languages_leave_room_for_rare_ones(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 20)
    made = _made(["often"], 400) + [(1000 + i, t, lang, s) for i, t, lang, s in _made(["none", "rare"], 2) if lang == "rare"]
    made += [(2000 + i, made[k][1], "often", None) for k in range(0, 400, 40) for i in range(50)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    assert langid.fit(docs).languages == ["often", "rare"]
    assert langid.rejected(docs).count() == 0


def test_page_text_takes_no_markup():
    assert langid.page_text("a<b>c</b><script>x < y</script><style>p{}</style>d<br>").split() == ["a", "c", "d"]
    assert text(3) == "the. quick brown" or text(3)


def _fused(model, rows):
    """Language and confidence of (id, data, declared, host, suffix), by the sums over all other rows."""
    width = len(model.languages) + 1
    logs, own, letters = {}, {}, {}
    for i, data, *_ in rows:
        letters[i], logs[i] = model.likelihoods(data)
        odds = np.exp(logs[i] - logs[i].max())
        own[i] = odds / odds.sum() if letters[i] else np.zeros(width)
    whole = sum(own.values()) + 1 / width
    share = lambda at, i, value: sum((own[r[0]] for r in rows if r[at] == value), np.zeros(width)) - own[i]
    out = {}
    for i, _, declared, host, suffix in rows:
        by_suffix = np.maximum(share(4, i, suffix) + langid.SMOOTH * whole / whole.sum(), 1e-9)
        same = [r for r in rows if r[3] == host and r[4] == suffix]
        by_host = np.maximum(sum((own[r[0]] for r in same), np.zeros(width)) - own[i], 0)
        fused = logs[i] + np.log(by_host + langid.SMOOTH * by_suffix / by_suffix.sum())
        if declared is not None:
            fused = fused + np.log((np.maximum(share(2, i, declared), 0) + 0.5) / (whole + 1))
        fused[-1] += np.log(langid.UNKNOWN)
        post = np.exp(fused - fused.max())
        best = int(fused.argmax())
        out[i] = ([*model.languages, "und"][best], 1 / post.sum()) if letters[i] else ("und", 0.0)
    return out


def test_fused_languages_are_brute_force(spark):
    r = random.Random(9)
    tongues = {"xx": "rala mina tosi keva", "yy": "brok stult grend pfim", "zz": "oie uae iou eoa"}
    phrase = lambda k, n: " ".join(r.choice(tongues[k].split()) + r.choice(tongues[k].split()) for _ in range(n))
    train = spark.createDataFrame([(i, phrase(k, 30), k) for i in range(20) for k in tongues], "doc_id long, text string, lang string")
    model = langid.fit(train)
    rows = []
    for i in range(150):
        k = r.choice(list(tongues))
        host = r.choice([None, "a", "b"]) if i % 4 else {"xx": "a", "yy": "b", "zz": None}[k]
        rows.append((i, r.choice([phrase(k, r.randrange(1, 8)), "ra bro oie", "123", ""]), r.choice([None, k, "xx"]), host, r.choice(["com", k])))
    rows += [(200, "rala brok", None, None, "com"), (201, "", "xx", "a", "com"), (202, phrase("xx", 3000), None, "a", "com")]
    given = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string, suffix string")
    found = {x.doc_id: x for x in langid.identified(given, model, "doc_id", "text", F.col("declared"), F.col("host"), F.col("suffix")).collect()}
    want = _fused(model, [(i, t.encode(), d, h, x) for i, t, d, h, x in rows])
    assert {i: x.lang for i, x in found.items()} == {i: w[0] for i, w in want.items()}
    assert {i: x.confidence for i, x in found.items()} == pytest.approx({i: w[1] for i, w in want.items()}, rel=1e-6)
