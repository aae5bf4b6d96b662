"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from two regular expressions per kind: a strict one, whose valid matches (base spans) are
always reported, and a loose one that takes in much more: obfuscated addresses, numbers without a prefix, numbers in a run.
Six labelers vote on each candidate by its own text and what is around it: the format's checks, a gazetteer (endings
of names, issuers of cards, calling codes, networks in use), cue words in front, no counter-cue in front, a regular
shape, and standing apart. Expectation-maximisation over the counts of vote combinations estimates, for each kind, how often each labeler is
right (a model with one hidden class, in which the base spans are known cases). Its posteriors then train
the span classifier, which doesn't see the votes: it is linear in the span's length, digits, groups, separators, borders,
check digit and the word in front of it, with log-odds as weights, from counts over all candidates. It decides on the candidates
that are not base spans.

A regular expression's matches have no places in Spark SQL, so a text is also split by it:
the lengths of gaps and matches, summed up, are the places, in code points.

Defined results: a null text counts as an empty one and has no spans; candidates that touch
a base span of their kind are dropped; equal spans are reported once per kind; without base spans of a kind the
votes alone tell; a long text is searched whole, in time that is linear but for the running sums of places, which take blocks; equal
texts have equal spans; repeated rows repeat; a table without rows gives none; other columns are left alone, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .arrow import fresh

KINDS = ("email", "ip", "card", "phone")

# Possessive quantifiers and the look-behinds only keep the matcher from trying hopeless
# starts and from backtracking; the matches are those of the plain patterns.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"\x20?(?:@|\(at\)|\[at\])\x20?", r"\x20?(?:\.|\(dot\)|\[dot\])\x20?"
LOOSE = {
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++|\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++)",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\[\.\])[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[3-6][0-9]{3}(?:[0-9]{12}|(?:[\x20.-][0-9]{4}){3})|3[47][0-9]{2}[\x20.-]?[0-9]{6}[\x20.-]?[0-9]{5}|[0-9]{13,19})(?![0-9])",
    "phone": r"(?:\+?[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,5}\)\x20?|(?<![0-9.-])[0-9]{2,5}[\x20./-])[0-9]{3,4}(?:[\x20.-][0-9]{2,5}){0,3}(?![0-9])",
}
# Words and endings that labelers look for.
CUES = {
    "email": "mail|contact|write|address|reach|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|address|addr\b|node|serveur|servidor",
    "card": r"card|visa|master|amex|credit|\bpay|karte|carte|tarjeta",
    "phone": r"phone|\bcall|\btel|fax|mobile|cell|contact|reach|anruf|appel|llam",
}
COUNTER_CUES = {
    "email": r"\blook(?:s|ed)? $|\barrived? $",
    "ip": r"version|release|\bv\.? ?$|section|chapter|paragraph",
    "card": r"order|invoice|isbn|serial|tracking|barcode|\bsku|account|reference",
    "phone": r"order|invoice|isbn|issn|serial|version|population|pages?\b|\bsku|card|year|date|total|price|[$€£] ?$",
}
LISTED = {
    "email": r"(?i)(?:com|org|net|edu|gov|mil|int|info|biz|name|io|ai|app|dev|co|me|tv|eu|de|at|ch|fr|be|nl|lu|es|pt|it|uk|ie|dk|se|no|fi|is|pl|cz|sk|hu|ro|bg|gr|hr|si|ee|lv|lt|ru|ua|tr|us|ca|mx|br|ar|cl|pe|au|nz|za|in|jp|cn|kr|sg|hk|tw|il|ae)$",
    # not the networks of no host: this one, loopback, multicast and reserved
    "ip": r"^(?!0+\D|127\D|22[4-9]\D|2[3-5][0-9]\D)",
    # issuers' prefixes, over the digits
    "card": r"^(?:4(?:\d{12}|\d{15}|\d{18})$|5[1-5]\d{14}$|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}$|3[47]\d{13}$|3(?:0[0-5]|[68]\d)\d{11}$|6(?:011|5\d\d|4[4-9]\d)\d{12}$|35(?:2[89]|[3-8]\d)\d{12}$|62\d{14,17}$)",
    # calling codes, over the digits behind + or 00; or an area and exchange of North America; or a trunk zero
    "phone": r"^(?:(?:\+|00)(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69]\d|3[578]\d|42\d|5[09]\d|6[789]\d|8[058]\d|9[679]\d)\d|1?[2-9]\d{2}[2-9]\d{6}$|0[1-9]\d{8,10}$)",
}
SHAPES = {
    "email": r"^[A-Za-z0-9].{2,}[A-Za-z]{2}$",
    "ip": r"^(?:[0-9]|[1-9][0-9]+)(?:(?:\.|\[\.\])(?:[0-9]|[1-9][0-9]+)){3}$",
    "card": r"^(?:[0-9]{4}([\x20.-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20.-]?)[0-9]{6}\2[0-9]{5})$",
    "phone": r"^(?:\+?[0-9]{1,3}[\x20.-])?(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{3,4}(?:([\x20.-])[0-9]{2,5}(?:\1[0-9]{2,5})*)?$",
}
#: The context that labelers and classifier see in front of and behind a span, in code points.
CONTEXT = 32
LABELERS = ("format", "listed", "cue", "no counter-cue", "shape", "apart")
#: The features of the span classifier and how many values each has.
FEATURES = {"length": 8, "digits": 21, "separators": 8, "group": 21, "first": 4, "before": 5, "behind": 5, "check": 2, "word": 32}
_WIDTH = sum(FEATURES.values())
_BLOCK = 64


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once for a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(lengths: Column) -> Column:
    """Sums of all earlier elements of an array of int, by blocks, so that the work stays far below its square."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    n_blocks = F.ceil(F.size(lengths) / F.lit(_BLOCK)).cast("int")
    blocks = F.when(F.size(lengths) == 0, F.array().cast("array<int>")).otherwise(F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))))
    return let(
        blocks,
        lambda sums: let(
            F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b))),
            lambda before: F.transform(lengths, lambda _, i: F.get(before, (i / _BLOCK).cast("int")) + total(F.slice(lengths, (i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK))),
        ),
    )


def matches(text: Column, pattern: str) -> Column:
    """The matches of a pattern: array of struct(start, end, found, ahead, behind), in code points."""
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, F.array().cast(_MATCH)).otherwise(
            let(
                F.split(text, pattern, -1),
                lambda gaps: let(
                    running(F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))),
                    lambda starts: F.transform(
                        found,
                        lambda m, i: F.struct(
                            (F.get(starts, i) + F.length(F.get(gaps, i))).alias("start"),
                            (F.get(starts, i) + F.length(F.get(gaps, i)) + F.length(m)).alias("end"),
                            m.alias("found"),
                            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("ahead"),
                            F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("behind"),
                        ),
                    ),
                ),
            )
        ),
    )


_MATCH = "array<struct<start:int,end:int,found:string,ahead:string,behind:string>>"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    one = lambda d, i: let(d.try_cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x))
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(kind: str, found: Column) -> Column:
    """What a match of the strict pattern must also fulfil."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) <= 3) & (F.coalesce(F.when(q != "", q).otherwise("0").cast("int"), F.lit(999)) <= 255)))
    digits = _digits(found)
    if kind == "card":
        return let(digits, lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    return F.length(digits).between(10, 15)


def _format(kind: str, found: Column) -> Column:
    """Whether a candidate could be what it looks like, by the rules of its kind alone."""
    digits = _digits(found)
    if kind == "email":
        return found.rlike(r"[A-Za-z]{2,}$") & ~found.rlike(r"^[.-]|\.\.")
    if kind == "ip":
        return F.forall(F.split(found, r"\D+"), lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def _listed(kind: str, found: Column) -> Column:
    if kind == "card":
        return _digits(found).rlike(LISTED[kind])
    return (F.regexp_replace(found, "[^0-9+]", "") if kind == "phone" else found).rlike(LISTED[kind])


def _side(c: Column) -> Column:
    """What kind of thing a code point is: nothing, space, letter, digit, other."""
    return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^\p{L}$"), 2).when(c.rlike("^[0-9]$"), 3).otherwise(4)


def _features(m: Column) -> Column:
    """The indices of a span's features, one for each of FEATURES."""
    digits, first = _digits(m.found), F.left(m.found, F.lit(1))
    group = F.array_max(F.transform(F.split(m.found, "[^0-9]+"), lambda g: F.length(g)))
    word = F.lower(F.regexp_extract(m.ahead, r"(\p{L}+)[^\p{L}]*$", 1))
    values = {
        "length": (F.length(m.found) / 4).cast("int"),
        "digits": F.length(digits),
        "separators": F.length(F.regexp_replace(m.found, "[0-9A-Za-z]", "")),
        "group": group,
        "first": F.when(first.rlike("[0-9]"), 0).when(first == "+", 1).when(first == "(", 2).otherwise(3),
        "before": _side(F.right(m.ahead, F.lit(1))),
        "behind": _side(F.left(m.behind, F.lit(1))),
        "check": F.when(luhn(digits), 1).otherwise(0),
        "word": F.pmod(F.xxhash64(word), F.lit(FEATURES["word"])).cast("int"),
    }
    out, at = [], 0
    for name, n in FEATURES.items():
        out.append(F.least(values[name], F.lit(n - 1)) + at)
        at += n
    return F.array(*out)


def _labelled(kind: str, spans: Column, base: bool) -> Column:
    """Candidates with their votes and features: struct(kind, start, end, base, votes, features)."""

    def look(m: Column) -> Column:
        votes = [
            _format(kind, m.found),
            _listed(kind, m.found),
            F.lower(m.ahead).rlike(CUES[kind]),
            ~F.lower(m.ahead).rlike(COUNTER_CUES[kind]),
            m.found.rlike(SHAPES[kind]),
            ~m.ahead.rlike(r"[0-9A-Za-z]$") & ~m.behind.rlike("^[0-9A-Za-z@]"),
        ]
        packed = sum((F.when(v, 1 << k).otherwise(0) for k, v in enumerate(votes)), F.lit(0))
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), m.start.alias("start"), m.end.alias("end"), F.lit(base).alias("base"), packed.alias("votes"), _features(m).alias("features"))

    return F.transform(spans, look)


def candidates(text: Column) -> Column:
    """All candidates of a text: strict ones that are valid, and loose ones that touch none of those of their kind."""
    has_digit, has_at = text.rlike("[0-9]"), text.rlike(r"@|\(at\)|\[at\]|\x20at\x20[A-Za-z0-9-]++\x20dot\x20")
    empty = F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean,votes:int,features:array<int>>>")

    def of(kind: str) -> Column:
        strict = F.filter(matches(text, STRICT[kind]), lambda m: valid(kind, m.found))

        def both(base: Column) -> Column:
            free = F.filter(matches(text, LOOSE[kind]), lambda m: ~F.exists(base, lambda b: (b.start < m.end) & (m.start < b.end)))
            return F.concat(_labelled(kind, base, True), _labelled(kind, free, False))

        return F.when(has_at if kind == "email" else has_digit, let(strict, both)).otherwise(empty)

    return F.concat(*map(of, KINDS))


@dataclass
class Classifier:
    """For each kind, the bias and weights of a linear classifier over span features, and (hit rate, false alarm rate) of each labeler."""

    bias: dict[int, float]
    weights: dict[int, list[float]]
    reliability: dict[int, list[tuple[float, float]]]


def expectation_maximisation(counts: dict[int, tuple[int, int]], rounds: int = 50) -> tuple[float, list[tuple[float, float]], dict[int, float]]:
    """Prior, (hit rate, false alarm rate) of each labeler, and posterior of each vote combination, from (base, other) counts of each.

    The base spans are cases that are known, and together weigh as much as the others at most.
    """
    total, known = sum(n for _, n in counts.values()), sum(n for n, _ in counts.values())
    anchor = min(1.0, max(total, 1) / known) if known else 0.0
    prior, hit, alarm = 0.5, [0.8] * len(LABELERS), [0.2] * len(LABELERS)
    post: dict[int, float] = {}
    for _ in range(rounds):
        for v in counts:
            yes, no = math.log(prior), math.log(1 - prior)
            for k in range(len(LABELERS)):
                on = v >> k & 1
                yes += math.log(hit[k] if on else 1 - hit[k])
                no += math.log(alarm[k] if on else 1 - alarm[k])
            post[v] = 1 / (1 + math.exp(max(-60.0, min(60.0, no - yes))))
        sure = {v: post[v] * n + anchor * b for v, (b, n) in counts.items()}
        positive, negative = sum(sure.values()), sum((1 - post[v]) * n for v, (_, n) in counts.items())
        prior = min(0.99, max(0.01, (sum(post[v] * n for v, (_, n) in counts.items()) + 1) / (total + 2)))
        for k in range(len(LABELERS)):
            p = sum(x for v, x in sure.items() if v >> k & 1)
            q = sum((1 - post[v]) * n for v, (_, n) in counts.items() if v >> k & 1)
            hit[k] = (p + 2) / (positive + 2.5)  # smoothed towards labelers that are right
            alarm[k] = (q + 0.5) / (negative + 2.5)
    return prior, list(zip(hit, alarm, strict=True)), post


def train(found: DataFrame) -> Classifier:
    """A classifier from rows with ``spans`` of candidates. Counts of vote combinations by feature reach the driver: one for each value of each, at most."""
    spans = found.select(F.explode("spans").alias("s")).select("s.kind", "s.base", "s.votes", F.explode("s.features").alias("feature"))
    rows = spans.groupBy("kind", "base", "votes", "feature").count().collect()
    bias, weights, reliability = {}, {}, {}
    for kind in sorted({r["kind"] for r in rows}):
        own = [r for r in rows if r["kind"] == kind]
        counts: dict[int, tuple[int, int]] = {}
        for r in own:
            if r["feature"] < FEATURES["length"]:  # each span once: by its first feature
                b, n = counts.get(r["votes"], (0, 0))
                counts[r["votes"]] = (b + r["count"], n) if r["base"] else (b, n + r["count"])
        prior, reliability[kind], post = expectation_maximisation(counts)
        total, known = sum(n for _, n in counts.values()), sum(b for b, _ in counts.values())
        anchor = min(1.0, max(total, 1) / known) if known else 0.0
        yes, no = np.full(_WIDTH, 0.5), np.full(_WIDTH, 0.5)
        for r in own:
            p = post[r["votes"]]
            yes[r["feature"]] += r["count"] * (anchor if r["base"] else p)
            no[r["feature"]] += 0 if r["base"] else r["count"] * (1 - p)
        at = 0
        w = np.zeros(_WIDTH)
        for n in FEATURES.values():
            w[at : at + n] = np.log(yes[at : at + n] / yes[at : at + n].sum()) - np.log(no[at : at + n] / no[at : at + n].sum())
            at += n
        bias[kind], weights[kind] = math.log(prior / (1 - prior)), w.tolist()
    return Classifier(bias, weights, reliability)


def _accepted(model: Classifier, s: Column) -> Column:
    """The span classifier's decision, as an expression over its weights."""
    bias = F.lit([model.bias.get(k, -math.inf) for k in range(len(KINDS))])
    weights = F.lit([x for k in range(len(KINDS)) for x in model.weights.get(k, [0.0] * _WIDTH)])
    return s.base | (F.aggregate(s.features, F.get(bias, s.kind), lambda t, x: t + F.get(weights, s.kind * _WIDTH + x)) >= 0)


def detected(docs: DataFrame, text: str = "text", carry: list[str] | None = None, name: str = "spans") -> DataFrame:
    """The columns ``carry`` of every row and ``name``: array of struct(start, kind, end, base) in order of place and kind."""
    carried = docs.columns if carry is None else carry
    found = written(docs.select(*carried, candidates(F.coalesce(F.col(text), F.lit(""))).alias(name)), "spans")
    model = train(found.select(F.col(name).alias("spans")))
    chosen = F.transform(F.filter(name, lambda s: _accepted(model, s)), lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end"), s.base.alias("base")))
    return found.withColumn(name, F.array_sort(chosen))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")


def personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, counts of strict spans per kind, digest of the strict spans, and all spans of every row."""
    found = detected(docs, text, [key])
    base = F.filter("spans", lambda s: s.base)
    count = lambda k: F.size(F.filter(base, lambda s: s.kind == k)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(key, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with each span of personal data replaced by its kind in brackets; overlapping spans go as one."""
    spans = fresh(docs.columns, "_spans")
    found = detected(docs, text, name=spans)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    body = F.col(text)

    def step(state: Column, s: Column) -> Column:
        fresh = s.start >= state.at
        piece = F.concat(F.substring(body, state.at + 1, s.start - state.at), F.get(names, s.kind))
        return F.struct(F.greatest(state.at, s.end).alias("at"), F.when(fresh, F.concat(state.out, F.array(piece))).otherwise(state.out).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    joined = F.aggregate(spans, start, step, lambda s: F.concat(F.array_join(s.out, ""), F.substring(body, s.at + 1, F.length(body))))
    return found.withColumn(text, F.when(F.size(spans) > 0, joined).otherwise(body)).select(docs.columns)
