"""Personal data by rules and by boosted trees over candidates, in DataFrame functions only.

Rules find spans of four kinds that are certain. Generators with a high recall propose more
spans, which may overlap, and each candidate gets features of its format and context. What
speaks for or against a candidate is told without the rules: cue words, Luhn, valid ranges
and host names. Those with neither are unlabelled. The candidates of all documents are
counted by feature values (there are at most ``prod(BINS)`` combinations), and gradient
boosting with trees of two levels is done on those counts. Per kind, the threshold is the
lowest score whose labelled candidates in the calibration third are right often enough.
Every candidate is judged by its score alone: those above the threshold are added to the
rules' spans, whatever their label.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqc.llm.common import sha256_hex
from surveyqc.operators.once import with_once
from surveyqc.sources.scratch import materialize

KINDS = ("email", "ip", "card", "phone")

#: The rules. Where a match may start is narrowed by what stands before it, and inner parts
#: give nothing back: the same matches as without, but in linear time. Fixed values.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: What may be personal data of a kind.
GENERATORS = {
    "email": r"(?<![^\s@<>(),;:\x22])[^\s@<>(),;:\x22]++(?:@|\x20?[\[(]at[\])]\x20?)[^\s@<>(),;:\x22]++",
    "ip": r"(?<![0-9.,:])[0-9]{1,4}+(?:[.,:][0-9]{1,4}+){3,7}+",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[\x20.-]?+[0-9]){12,18}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().-]{0,2}+[0-9]){6,14}+(?![0-9A-Za-z])",
}

#: Words that announce personal data.
CUES = r"(?i)(?:mail|phone|tel|call|fax|mobile|card|visa|account|addr|host|contact|ip)\b[^\n]{0,12}$"

#: Words that announce a phone number.
PHONE_CUES = r"(?i)\b(?:(?:tele|mobile\x20)?phone|tel|tel[eé]fono|telefon|t[eé]l[eé]phone|call|fax|mobile|contact)\b[^\n]{0,12}$"
#: An address with a host name of several parts.
HOST = r"(?i)(?:@|\x20?[\[(]at[\])]\x20?)(?:[a-z0-9-]++\.)++[a-z]{2,}+\.?$"
#: Numbers with dots or hyphens that are no phone numbers: addresses and dates.
NO_PHONE = r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9]{4}([.-])[0-9]{2}\1[0-9]{2}|[0-9]{2}([.-])[0-9]{2}\2[0-9]{4})$"

#: Features and how many values each has.
BINS = {"kind": 4, "digits": 14, "size": 10, "marks": 5, "dots": 5, "plus": 2, "before": 4, "after": 4, "cue": 2}
ROUNDS = 24
LEARNING_RATE = 0.4
PRECISION = 0.9
#: What a candidate that nothing speaks for or against counts, as a negative, when trees are fitted.
UNLABELLED = 0.5
_BLOCK = 256


def _plus(x: Column, y: Column) -> Column:
    return x + y


def _larger(x: Column, y: Column) -> Column:
    return F.greatest(x, y)


def with_running(df: DataFrame, arrays: dict[str, Column], combine=_plus) -> DataFrame:
    """Adds running sums, or maxima, from 0 of arrays of integers. They are made in blocks, each
    step a column of its own, so that long arrays stay cheap."""

    def running(x, start):
        empty = F.array().cast("array<int>")
        step = lambda s, v: F.struct(combine(s["t"], v).alias("t"), F.concat(s["a"], F.array(combine(s["t"], v))).alias("a"))
        return F.aggregate(x, F.struct(start.alias("t"), empty.alias("a")), step)["a"]

    def blocks(a):
        at = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int"))
        cut = F.transform(at, lambda i: F.slice(a, i * _BLOCK + 1, _BLOCK))
        return F.when(F.size(a) > 0, cut).otherwise(F.array().cast("array<array<int>>"))

    def joined(name):
        ends = F.col(f"__ends_of_{name}")
        return F.flatten(F.transform(
            f"__blocks_of_{name}", lambda b, i: running(b, F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1)))))

    total = lambda x: F.aggregate(x, F.lit(0), combine)
    df = with_once(df, **arrays)
    df = with_once(df, **{f"__blocks_of_{name}": blocks(F.col(name)) for name in arrays})
    df = with_once(df, **{
        f"__ends_of_{name}": running(F.transform(f"__blocks_of_{name}", total), F.lit(0)) for name in arrays})
    df = with_once(df, **{name: joined(name) for name in arrays})
    return df.drop(*[f"__{part}_of_{name}" for name in arrays for part in ("blocks", "ends")])


def _marked(marks: Column, place: int) -> Column:
    return F.transform(marks, lambda x: F.struct(x.alias("at"), F.lit(place).alias("place"), F.lit(1).alias("mark")))


def _with_ranks(df: DataFrame, wanted: dict[str, tuple[Column, Column, bool]]) -> DataFrame:
    """Adds arrays: for each of the rising points how many marks lie below it (or at it,
    where the third is true). Both are sorted together and walked once."""
    none = F.array().cast("array<struct<at:int,place:int,mark:int>>")
    events, sums = {}, {}
    for name, (points, marks, at_too) in wanted.items():
        given = F.transform(points, lambda x: F.struct(x.alias("at"), F.lit(1).alias("place"), F.lit(0).alias("mark")))
        counted = _marked(marks, 0 if at_too else 2)
        both = F.sort_array(F.concat(given, counted))
        events[f"__events_{name}"] = F.when((F.size(points) > 0) & (F.size(marks) > 0), both).otherwise(none)
        sums[f"__sums_{name}"] = F.transform(f"__events_{name}", lambda e: e["mark"])
    df = with_running(with_once(df, **events), sums)

    def picked(name):
        return F.filter(f"__sums_{name}", lambda _, i: F.get(F.col(f"__events_{name}"), i)["mark"] == 0)

    return with_once(df, **{name: picked(name) for name in wanted}).drop(*events, *sums)


def _scanned(df: DataFrame, text: str, patterns: dict[str, str], name: str, possible: dict[str, Column]) -> DataFrame:
    """Adds an array of (start, end, value, before, after) per kind: matches with their code
    point positions, the text in front of each and the character behind it."""
    none = F.array().cast("array<string>")
    parts = {}
    for kind, pattern in patterns.items():
        parts[f"__gaps_{kind}"] = F.when(possible[kind], F.split(text, pattern, -1)).otherwise(none)
        parts[f"__found_{kind}"] = F.when(
            possible[kind], F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    df = with_once(df, **parts)


    def step(kind):
        gaps = F.col(f"__gaps_{kind}")
        return F.transform(f"__found_{kind}", lambda m, i: F.length(m) + F.length(F.get(gaps, i)))

    steps = {f"__ends_{kind}": step(kind) for kind in patterns}
    df = with_running(df, steps)

    def span(kind):
        gap = lambda i: F.get(F.col(f"__gaps_{kind}"), i)
        end = lambda i: F.get(F.col(f"__ends_{kind}"), i)
        return F.transform(f"__found_{kind}", lambda m, i: F.struct(
            (end(i) - F.length(m)).alias("start"), end(i).alias("end"), m.alias("value"),
            F.right(gap(i), F.lit(24)).alias("before"), F.left(gap(i + 1), F.lit(1)).alias("after"),
        ))

    df = with_once(df, **{f"{name}_{kind}": span(kind) for kind in patterns})
    return df.drop(*parts, *steps)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", F.left(digits, F.lit(19)))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _evidence(kind: str, c: Column) -> Column:
    """1 for evidence that a candidate is personal data, -1 for evidence against it, 0 for neither."""
    value, cue = c["value"], c["before"].rlike(PHONE_CUES if kind == "phone" else CUES)
    digits = F.regexp_replace(value, "[^0-9]", "")
    card = F.length(digits).between(13, 19) & F.call_function("luhn_check", F.left(digits, F.lit(19)))
    issued = digits.rlike("^[3-6]")
    if kind == "email":
        found, against = value.rlike(HOST) | (cue & ~value.contains("@")), value.contains("@")
    elif kind == "ip":
        found, against = _valid(kind, value), F.lit(True)
    elif kind == "card":
        found, against = card & issued, ~card
    else:
        against = value.rlike(NO_PHONE) | (F.length(digits) > 15) | (card & issued & ~value.startswith("+"))
        found = cue & ~against & (F.length(digits) >= 8)
    return F.when(found, F.lit(1)).when(against, F.lit(-1)).otherwise(F.lit(0))


def _edge(c: Column) -> Column:
    return (
        F.when(c.rlike(r"^\s?$"), F.lit(0)).when(c.rlike(r"\p{L}"), F.lit(1))
        .when(c.rlike("[0-9]"), F.lit(2)).otherwise(F.lit(3))
    )


def _features(number: int, c: Column) -> list[Column]:
    value = c["value"]
    count = lambda pattern: F.length(value) - F.length(F.regexp_replace(value, pattern, ""))
    made = {
        "kind": F.lit(number),
        "digits": F.least(count("[0-9]"), F.lit(BINS["digits"] + 5)) - F.least(count("[0-9]"), F.lit(6)),
        "size": F.least(F.floor(F.length(value) / 4).cast("int"), F.lit(BINS["size"] - 1)),
        "marks": F.least(count(r"[\x20()-]"), F.lit(BINS["marks"] - 1)),
        "dots": F.least(count(r"\."), F.lit(BINS["dots"] - 1)),
        "plus": F.when(value.startswith("+"), 1).otherwise(0),
        "before": _edge(F.right(c["before"], F.lit(1))),
        "after": _edge(c["after"]),
        "cue": F.when(c["before"].rlike(CUES), 1).otherwise(0),
    }
    return [made[name].cast("int").alias(name) for name in BINS]


def candidates(df: DataFrame, text: str) -> DataFrame:
    """Adds __base (kind, start, end) and __candidates (with features, a label by evidence, and
    whether they overlap a span of their kind)."""
    digit = F.col(text).rlike("[0-9]")
    at = F.col(text).contains("@")
    loose = at | F.col(text).contains("at)") | F.col(text).contains("at]")
    sure = {"email": at, "ip": digit, "card": digit, "phone": F.col(text).contains("+")}
    df = _scanned(df, text, RULES, "__rule", sure)

    def certain(i, kind):
        valid = F.filter(f"__rule_{kind}", lambda s: _valid(kind, s["value"]))
        return F.transform(
            valid, lambda s: F.struct(F.lit(i).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    base = {f"__sure_{kind}": certain(i, kind) for i, kind in enumerate(KINDS)}
    df = with_once(df, **base).drop(*[f"__rule_{k}" for k in KINDS])
    df = _scanned(df, text, GENERATORS, "__may", {"email": loose, "ip": digit, "card": digit, "phone": digit})

    field = lambda array, name: F.transform(array, lambda s: s[name])
    ranks = {}
    for kind in KINDS:
        may, known = f"__may_{kind}", f"__sure_{kind}"
        ranks[f"__begun_{kind}"] = (field(may, "end"), field(known, "start"), False)
        ranks[f"__done_{kind}"] = (field(may, "start"), field(known, "end"), True)
    df = _with_ranks(df, ranks)

    def proposed(i, kind):
        begun, done = F.col(f"__begun_{kind}"), F.col(f"__done_{kind}")
        return F.transform(f"__may_{kind}", lambda c, at: F.struct(
            *_features(i, c), c["start"].alias("start"), c["end"].alias("end"),
            F.coalesce(F.get(begun, at) > F.get(done, at), F.lit(False)).alias("known"),
            _evidence(kind, c).alias("label"),
        ))

    df = with_once(
        df, __base=F.concat(*base), __candidates=F.concat(*[proposed(i, k) for i, k in enumerate(KINDS)]))
    return df.drop(*base, *ranks, *[f"__may_{k}" for k in KINDS])


class Trees:
    """Boosted trees of two levels over small integers, for the log odds of a label."""

    def __init__(self, x: np.ndarray, n: np.ndarray, positive: np.ndarray, bins: list[int]):
        rate = (positive.sum() + 0.5) / (n.sum() + 1)
        self.start = math.log(rate / (1 - rate))
        self.trees: list[tuple] = []
        score = np.full(len(n), self.start)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-score))
            grad, hess = positive - n * p, n * p * (1 - p)
            top = self._split(x, grad, hess, bins, np.ones(len(n), bool))
            if top is None:
                break
            low = x[:, top[0]] <= top[1]
            tree = (top, *(self._side(x, grad, hess, bins, part) for part in (low, ~low)))
            self.trees.append(tree)
            score = score + self._value(tree, x)

    @staticmethod
    def _split(x, grad, hess, bins, part):
        best, found = 1e-6, None
        whole = grad[part].sum() ** 2 / (hess[part].sum() + 1)
        for f, size in enumerate(bins):
            g = np.cumsum(np.bincount(x[part, f], grad[part], size))
            h = np.cumsum(np.bincount(x[part, f], hess[part], size))
            gain = g**2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - whole
            at = int(np.argmax(gain[:-1])) if size > 1 else 0
            if gain[at] > best:
                best, found = gain[at], (f, at)
        return found

    def _side(self, x, grad, hess, bins, part):
        leaf = lambda rows: float(LEARNING_RATE * grad[rows].sum() / (hess[rows].sum() + 1))
        split = self._split(x, grad, hess, bins, part) if part.any() else None
        if split is None:
            return None, leaf(part), leaf(part)
        low = x[:, split[0]] <= split[1]
        return split, leaf(part & low), leaf(part & ~low)

    @staticmethod
    def _value(tree, x):
        (f, at), *sides = tree
        values = [np.where(x[:, s[0]] <= s[1], a, b) if s else np.full(len(x), a) for s, a, b in sides]
        return np.where(x[:, f] <= at, *values)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sum((self._value(t, x) for t in self.trees), np.full(len(x), self.start))

    def column(self, c: Column) -> Column:
        """The score as an expression over a struct with the features."""
        names = list(BINS)
        side = lambda s, a, b: F.when(c[names[s[0]]] <= s[1], F.lit(a)).otherwise(F.lit(b)) if s else F.lit(a)
        score = F.lit(self.start)
        for (f, at), low, high in self.trees:
            score = score + F.when(c[names[f]] <= at, side(*low)).otherwise(side(*high))
        return score


def fit(rows: DataFrame) -> tuple[Trees, list[float]]:
    """Trees and one threshold per kind, from the counts of all candidates.

    Trees are fitted with those without a label as negatives of weight ``UNLABELLED``; the
    thresholds ask only what share of the labelled candidates above them is right.
    """
    part = F.pmod(F.xxhash64("c.start", "c.end", *[f"c.{b}" for b in BINS]), F.lit(3)) == 0
    cells = (
        rows.select(F.explode("__candidates").alias("c"))
        .groupBy(part.alias("calibrate"), *[F.col(f"c.{b}").alias(b) for b in BINS])
        .agg(
            F.count(F.when(F.col("c.label") == 0, 1)).alias("open"),
            F.count(F.when(F.col("c.label") != 0, 1)).alias("n"),
            F.count(F.when(F.col("c.label") == 1, 1)).alias("positive"),
        )
        .collect()
    )
    cells.sort()
    table = np.array([[int(v) for v in row] for row in cells], np.int64).reshape(len(cells), len(BINS) + 4)
    held, x, (unknown, n, positive) = table[:, 0] == 1, table[:, 1:-3], table[:, -3:].T.astype(float)
    weight = n + UNLABELLED * unknown
    trees = Trees(x[~held], weight[~held], positive[~held], list(BINS.values()))
    return trees, [threshold(trees.predict(x), n, positive, held & (x[:, 0] == k)) for k in range(len(KINDS))]


def threshold(score: np.ndarray, n: np.ndarray, positive: np.ndarray, part: np.ndarray) -> float:
    """The lowest score above which enough candidates are right; infinite if there is none."""
    best = math.inf
    for s in np.unique(score[part & (n > 0)])[::-1]:
        above = part & (score >= s - 1e-9)
        if positive[above].sum() / (n[above].sum() + 2) >= PRECISION:
            best = float(s) - 1e-6
    return best


def _written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _found(docs: DataFrame, text_col: str, given: dict[str, Column]) -> DataFrame:
    """The given columns, __base, and __spans: base and added spans as sorted (kind, start, end)."""
    columns = [c.alias(name) for name, c in given.items()]
    rows = docs.select(*columns, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = materialize(candidates(rows, "__text").drop("__text"), "personal-candidates")
    trees, limits = fit(rows)
    limit = F.array(*[F.lit(x) for x in limits])
    right = lambda c: ~c["known"] & (trees.column(c) >= F.get(limit, c["kind"]))
    added = F.transform(
        F.filter("__candidates", right),
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")),
    )
    return with_once(rows, __spans=F.sort_array(F.concat("__base", added))).drop("__candidates")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the rules' spans), spans (all) and
    span_list (the same as sorted structs of kind number, start and end), one row per row.

    Spans count code points, the end exclusive, ordered by kind and start. The trees only
    add spans; a candidate that overlaps a span of its kind, or whose score is below the
    threshold of its kind, adds nothing. A null or empty
    text has no spans. Without candidates, or where a kind has too few right ones, nothing
    is added. Ids may be null or repeated; every row is answered. Other columns are not read.
    """
    rows = _found(docs, text_col, {"doc_id": F.col(id_col).cast("long")})
    count = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        sha256_hex(_written(F.col("__base"))).alias("base_sha256"),
        _written(F.col("__spans")).alias("spans"), F.col("__spans").alias("span_list"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns and redacted_text: every span is replaced by a mark with its kind in
    capitals, spans that overlap by the mark of the first. A null text stays null; a text
    without spans stays as it is."""
    names = {f"__c{i}": c for i, c in enumerate(docs.columns)}  # no clash with other names
    text = F.col(f"__c{docs.columns.index(text_col)}")
    found = _found(docs, text_col, {new: F.col(f"`{c}`") for new, c in names.items()})
    ordered = F.transform("__spans", lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("k")))
    rows = with_once(found.drop("__base"), __at=F.sort_array(ordered)).drop("__spans")
    mark = lambda k: F.get(F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS]), k)
    rows = with_running(rows, {"__max": F.transform("__at", lambda x: x["e"])}, _larger)
    n = F.size("__at")
    before = lambda i: F.coalesce(F.get("__max", i - 1), F.lit(0))
    # a piece is cut from the part of the text that its block of spans covers
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int"))
    part = lambda b: F.substring(
        text, before(b * _BLOCK) + 1, F.get("__max", F.least((b + 1) * _BLOCK, n) - 1) - before(b * _BLOCK))
    none = F.array().cast("array<string>")
    rows = with_once(rows, __parts=F.when(n > 0, F.transform(blocks, part)).otherwise(none))

    def piece(x, i):
        block = F.floor(i / _BLOCK).cast("int")
        start = before(i) - before(block * _BLOCK)
        kept = F.substring(F.get("__parts", block), start + 1, x["s"] - before(i))
        return F.when(x["s"] >= before(i), F.concat(kept, mark(x["k"]))).otherwise(F.lit(""))

    rest = F.substring(text, before(n) + 1, F.length(text))
    new = F.concat(F.array_join(F.transform("__at", piece), ""), rest)
    return rows.select(
        *[F.col(new_name).alias(c) for new_name, c in names.items()],
        F.when(F.size("__at") > 0, new).otherwise(text).alias("redacted_text"),
    )
