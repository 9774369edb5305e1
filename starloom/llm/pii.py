"""Personal data (operator 5): candidate gradient boosting, in DataFrame functions only.

Base rules find e-mail addresses, IP addresses, card and phone numbers.  High-recall generators propose
further spans, which may overlap: anything around an ``@``, long runs of digits with any separators, long
tokens.  Each generator labels its own candidates (``_label``): some are confirmed, by a base rule or, for
tokens, by a word such as ``key`` right before; some are refuted, as a word, a date or a failed check sum is;
the rest is undecided.  Boosted trees score each candidate by features of its format and context, without those
that decide whether it is confirmed (``HIDDEN``), so an undecided candidate can score as high as a confirmed
one.  They take undecided candidates as unlabelled.  Thresholds, one for each generator and taken on the
held-out fold, decide which are redacted beside the base spans: above them confirmed candidates are
``PRECISION`` of the decided ones and at least as many as the undecided.  Base spans always stay.

Features are small integers, so all candidates of the corpus shrink to one count for each combination
of features: a partial aggregate with few rows, of which the trees are grown.  Scoring is a
sum of CASE expressions.  Patterns are written so that matching is linear in the text: possessive
loops, and a start only where no earlier one would match as well.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import held_out

KINDS = ("email", "ip", "card", "phone")
GENERATORS = ("mail", "number", "token")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "mail": r"[^\s@<>\x22]{1,64}+@[^\s@<>\x22]{1,255}+",
    "number": r"(?<![0-9])\(?\+?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,}+",
    "token": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "mail": "@", "phone": r"\+[0-9]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "number": "[0-9]", "token": None}
CONTEXT = r"(?i)(?:mail|tel|phone|call|card|addr|host|token|key|secret|passw)"
#: What confirms a token: a word for a secret right before it.
NAMED = r"(?i)(?:token|key|secret|passw[a-z]*|pwd|bearer|auth)[\x22'\s]*[:=]?[\s\x22']*$"
DATE = r"^\(?(?:(?:19|20)[0-9]{2}([-/. ]?)[01]?[0-9]\1[0-3]?[0-9]|[0-3]?[0-9]([-/. ])[0-3]?[0-9]\2(?:19|20)[0-9]{2})(?![0-9])"
FEATURES = ("gen", "digits", "letters", "seps", "plus", "dots", "at", "luhn", "parts", "context", "before", "after", "turns")
#: Features that decide a label, kept from the trees.
HIDDEN = {"mail": ("at",), "number": ("plus", "luhn"), "token": ("context",)}
CONFIRMED, REFUTED, UNDECIDED = 1, 0, 2
ROUNDS, RATE = 24, 0.4
PRECISION = 0.995
RESULT = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def _spans(text: Column, name: str) -> tuple[Column, Column]:
    """Matches of a pattern, and the column function that gives them places: (s, e, m), code points, end exclusive."""
    pattern = PATTERNS[name]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    need = NEEDS[name]
    none = F.array().cast("array<string>")
    if need:
        tried = F.contains(text, F.lit(need)) if need == "@" else text.rlike(need)
        hits = F.when(tried, hits).otherwise(none)
    return hits, pattern


def _placed(text: Column, hits: Column, pattern: str) -> Column:
    kind = "array<struct<s:int,e:int,m:string>>"
    between = F.split(text, pattern, -1)
    steps = F.arrays_zip(between.alias("gap"), hits.alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(begin.alias("s"), end.alias("e"), x["hit"].alias("m"))
        return F.struct(end.alias("at"), F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    return F.when(F.size(hits) == 0, F.array().cast(kind)).otherwise(F.aggregate(steps, start, step, lambda a: a["out"]))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of 12 to 19 digits passes the check; false for other lengths."""
    n = F.length(digits)
    places = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(places, F.lit(0), lambda acc, i: acc + value(i))
    return F.when((n >= 12) & (n <= 19), total % 10 == 0).otherwise(F.lit(False))


_PARTS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?(?:\.|$)){4}$"


def _valid(name: str, m: Column) -> Column:
    if name == "ip":
        return m.rlike(_PARTS)
    if name == "card":
        return _luhn(_digits(m))
    if name == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _bin(value: Column, *edges: int) -> Column:
    """Number of edges that are at most ``value``."""
    out = F.lit(0)
    for edge in edges:
        out = out + F.when(value >= edge, 1).otherwise(0)
    return out


def _side(c: Column) -> Column:
    return F.when((c == "") | c.rlike(r"^\s"), 0).when(c.rlike("^[0-9]"), 1).when(c.rlike(r"^\p{L}"), 2).otherwise(3)


def _before(text: Column, x: Column) -> Column:
    return F.substring(text, F.greatest(x["s"] - 19, F.lit(1)), F.least(x["s"], F.lit(20)))


def _turns(m: Column) -> Column:
    """How often letters and digits take turns: many times in a secret, hardly in words, dates and numbers."""
    return F.size(F.regexp_extract_all(m, F.lit(r"(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"), F.lit(0)))


def _label(text: Column, name: str, x: Column, hit: Column) -> Column:
    """Whether a candidate is confirmed, refuted or undecided; ``hit`` is whether it meets a base span."""
    m = x["m"]
    if name == "token":
        confirmed, refuted = _before(text, x).rlike(NAMED), _turns(m) < 4
        return F.when(refuted, REFUTED).when(confirmed, CONFIRMED).otherwise(UNDECIDED)
    if name == "mail":
        refuted = ~m.rlike(r"[\p{L}\p{N}]@[\p{L}\p{N}][^@]*\.\p{L}")
    else:
        n = F.length(_digits(m))
        around = F.substring(text, x["s"], F.when(x["s"] > 0, 1).otherwise(0)), F.substring(text, x["e"] + 1, F.lit(1))
        refuted = around[0].rlike(r"[\p{L}_]") | around[1].rlike(r"[\p{L}_]") | m.rlike(DATE) | (n > 19) | ((n >= 12) & ~_luhn(_digits(m)))
    return F.when(hit, CONFIRMED).when(refuted, REFUTED).otherwise(UNDECIDED)


def _features(text: Column, name: str, x: Column) -> list[Column]:
    m, d = x["m"], _digits(x["m"])
    before = _before(text, x)
    marks = r"[\p{L}0-9+]" if "plus" in HIDDEN[name] else r"[\p{L}0-9]"
    values = {
        "gen": F.lit(GENERATORS.index(name)), "digits": _bin(F.length(d), 1, 7, 9, 12, 16, 17, 20),
        "letters": _bin(F.length(F.regexp_replace(m, r"[^\p{L}]", "")), 1, 5, 16),
        "seps": _bin(F.length(F.regexp_replace(m, marks, "")), 1, 3, 5), "plus": F.when(F.instr(m, "+") > 0, 1).otherwise(0),
        "dots": F.least(F.length(F.regexp_replace(m, r"[^.]", "")), F.lit(4)), "at": F.when(m.rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z0-9]"), 1).otherwise(0),
        "luhn": F.when(_luhn(d), 1).otherwise(0), "parts": F.when(m.rlike(_PARTS), 1).otherwise(0),
        "context": F.when(before.rlike(CONTEXT), 1).otherwise(0), "before": _side(F.substring(text, x["s"], F.when(x["s"] > 0, 1).otherwise(0))),
        "after": _side(F.substring(text, x["e"] + 1, F.lit(1))),
        "turns": _bin(_turns(m), 1, 4, 8) if name == "token" else F.lit(0),
    } | {f: F.lit(0) for f in HIDDEN[name]}
    return [values[f].cast("int").alias(f) for f in FEATURES]


def _checked(name: str):
    return lambda x: _valid(name, x["m"])


def _of_kind(i: int):
    return lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e"))


def _described(text: Column, name: str):
    def span(x: Column) -> Column:
        if name == "token":  # one that only holds a base span, as a secret can hold a card number, is more than it
            hit = F.exists("_base", lambda b: (b["s"] <= x["s"]) & (x["e"] <= b["e"]))
        else:
            hit = F.exists("_base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
        label = _label(text, name, x, hit)
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), hit.alias("hit"), label.alias("label"), *_features(text, name, x))

    return span


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text``, ``_base`` (s, k, e) of the base rules in order and ``_cand`` of the generators with features."""
    text = F.col("_text")
    out = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    patterns = {}
    hits = {}
    for name in PATTERNS:
        hits[f"_hit_{name}"], patterns[name] = _spans(text, name)
    out = out.withColumns(hits)
    out = out.withColumns({f"_at_{n}": _placed(text, F.col(f"_hit_{n}"), p) for n, p in patterns.items()})
    found = {}
    for i, name in enumerate(KINDS):
        found[f"_is_{name}"] = F.transform(F.filter(f"_at_{name}", _checked(name)), _of_kind(i))
    out = out.withColumns(found)
    out = out.withColumn("_base", F.array_sort(F.concat(*[F.col(f"_is_{n}") for n in KINDS])))
    proposed = [F.transform(f"_at_{n}", _described(text, n)) for n in GENERATORS]
    return out.withColumn("_cand", F.concat(*proposed)).drop(*hits, *[f"_at_{n}" for n in PATTERNS], *[c for c in found])


@dataclass
class Model:
    """Trees as (feature, edge, left, right) or leaf values, and a threshold for each generator."""

    trees: list
    thresholds: list[float]


def _value(tree, row: dict) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def _grow(rows: list[tuple[dict, float, float]], depth: int):
    """Tree over (features, gradient, weight) that lowers the logistic loss most; leaves are Newton steps."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    leaf = RATE * g / (h + 1.0)
    if depth == 0 or len(rows) < 2:
        return leaf
    best, least = None, 1e-6
    for f in FEATURES:
        by: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
        for row, a, b in rows:
            by[row[f]][0] += a
            by[row[f]][1] += b
        ga = ha = 0.0
        for edge in sorted(by)[:-1]:
            ga, ha = ga + by[edge][0], ha + by[edge][1]
            gain = ga * ga / (ha + 1) + (g - ga) ** 2 / (h - ha + 1) - g * g / (h + 1)
            if gain > least:
                best, least = (f, edge), gain
    if best is None:
        return leaf
    f, edge = best
    return (f, edge, _grow([r for r in rows if r[0][f] <= edge], depth - 1), _grow([r for r in rows if r[0][f] > edge], depth - 1))


def _sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _counted(found: DataFrame) -> DataFrame:
    """Candidates by fold, label and features, with their number."""
    # explode_outer: for a plain one Spark infers a filter on the array's size, and with it evaluates the whole extraction twice
    each = found.select(held_out().alias("held"), F.explode_outer("_cand").alias("c")).select("held", "c.label", *[f"c.{f}" for f in FEATURES])
    each = each.where(F.col("label").isNotNull())
    return each.groupBy("held", "label", *FEATURES).agg(F.count("*").alias("n"))


def train(found: DataFrame) -> Model:
    """Trees and thresholds from the candidates of all documents; see :func:`candidates`."""
    table = _counted(found).collect()
    counts: dict[tuple, list[float]] = defaultdict(lambda: [0] * 6)  # refuted, confirmed, undecided, in the fold and held out
    for r in sorted(table, key=tuple):
        counts[tuple(r[f] for f in FEATURES)][3 * r["held"] + r["label"]] += r["n"]
    rows = [(dict(zip(FEATURES, key)), c) for key, c in sorted(counts.items())]
    scores, trees = [0.0] * len(rows), []
    for _ in range(ROUNDS if rows else 0):
        grown = []
        for (row, c), z in zip(rows, scores):
            p = _sigmoid(z)
            n = c[REFUTED] + c[CONFIRMED] + c[UNDECIDED]
            grown.append((row, c[CONFIRMED] - n * p, max(n * p * (1 - p), 1e-9)))
        trees.append(_grow(grown, 3))
        scores = [z + _value(trees[-1], row) for (row, _), z in zip(rows, scores)]
    thresholds = []
    for gen in range(len(GENERATORS)):
        best, hits, misses, unknown = math.inf, 0, 0, 0
        own = sorted(((z, *c[3:]) for (row, c), z in zip(rows, scores) if row["gen"] == gen), reverse=True)
        for i, (z, miss, hit, open_) in enumerate(own):
            hits, misses, unknown = hits + hit, misses + miss, unknown + open_
            last = i + 1 == len(own) or own[i + 1][0] < z
            if last and hits and hits >= PRECISION * (hits + misses) and unknown <= hits:
                best = z
        thresholds.append(best)
    return Model(trees, thresholds)


def _expression(tree, x: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(x[tree[0]] <= tree[1], _expression(tree[2], x)).otherwise(_expression(tree[3], x))


def _chosen(model: Model, x: Column) -> Column:
    score = F.lit(0.0)
    for tree in model.trees:
        score = score + _expression(tree, x)
    edge = F.lit(math.inf)
    for gen, value in enumerate(model.thresholds):
        edge = F.when(x["gen"] == gen, F.lit(value)).otherwise(edge)
    return score >= edge - 1e-9


def _all_spans(found: DataFrame, model: Model) -> DataFrame:
    """``found`` with ``_all``: base spans, and chosen candidates that none of them confirms or, for tokens, covers."""
    extra = F.transform(
        F.filter("_cand", lambda x: ~x["hit"] & (x["label"] != REFUTED) & _chosen(model, x)),
        lambda x: F.struct(x["s"].alias("s"), (x["gen"] + len(KINDS)).alias("k"), x["e"].alias("e")),
    )
    return found.withColumn("_all", F.array_sort(F.concat("_base", extra)))


def _is_kind(i: int):
    return lambda x: x["k"] == i


def _names() -> Column:
    return F.array(*[F.lit(n) for n in (*KINDS, *GENERATORS)])


def _joined(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(_names(), x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def find(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with counts of the base rules, ``base_sha256`` and ``spans``.

    A null text is empty.  Spans are ``kind:start:end`` by start, then kind.  Without candidates, or if none is
    ever confirmed, only base spans are given.  Repeated rows get the same answer; columns with the
    names of results are replaced.
    """
    rows = docs.drop(*[c for c in docs.columns if c.lower() in RESULT])
    model = train(candidates(rows.select("doc_id", "text")))
    found = _all_spans(candidates(rows), model)
    counts = {f"n_{n}": F.size(F.filter("_base", _is_kind(i))).cast("long") for i, n in enumerate(KINDS)}
    out = found.withColumns(counts | {"base_sha256": F.sha2(_joined("_base"), 256), "spans": _joined("_all")})
    return out.drop("_text", "_base", "_cand", "_all")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of personal data in ``text`` replaced by its kind, as ``<EMAIL>``; overlapping spans are one.

    A null text stays null and a text without spans stays as it is.
    """
    model = train(candidates(docs.select("doc_id", "text")))
    found = _all_spans(candidates(docs), model)
    text = F.col("_text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        mark = F.concat(F.lit("<"), F.upper(F.element_at(_names(), x["k"] + 1)), F.lit(">"))
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), mark)
        return F.struct(F.when(x["s"] < acc["at"], acc["out"]).otherwise(fresh).alias("out"), F.greatest(acc["at"], x["e"]).alias("at"))

    whole = F.aggregate("_all", start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    clean = F.when(F.size("_all") == 0, F.col("text")).otherwise(whole)
    return found.withColumn("text", clean).select(docs.columns)
