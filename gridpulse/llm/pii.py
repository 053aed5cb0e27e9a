"""Personal data by boosted candidate classification, in DataFrame functions.

Base spans follow fixed rules (pattern and check per kind).  On top, high-recall
generators propose further, overlapping candidates: spelled-out e-mail addresses,
spelled-out hosts, any grouping of digits, and four groups of four digits within a
longer run of digits; a candidate must pass the check of its kind.  Each candidate gets format features (digits,
separators, checks) and context features (the word before it), and a gradient
boosted ensemble of depth-2 trees scores it.  Candidates over the calibrated
threshold that overlap no base span are added; base spans always stay.

The trees are trained on the driver from at most ``TRAIN_DOCS`` documents (smallest
id hashes, whatever the table's size).  Positives are the base spans of the sample,
rewritten as the base patterns do not know them: addresses spelled out, phone
numbers without ``+``, spaced hosts and cards.  Negatives are, in the contexts of the
same spans, random digit runs, dates, decimals, grouped digits and words around a
spaced ``@``, and candidates over base spans of another kind.  Other candidates have
no label and take no part, so unknown forms in a table do not raise the bar.  Half
of the sample (by id hash) fits the trees, the other half sets, per kind, the
lowest threshold at which at least ``PRECISION`` of the accepted candidates are
positive.  The ensemble then becomes one SQL expression; all work on the table is
built-in functions, and no row is shuffled.

Patterns are written so that the JVM matcher neither recurses nor backtracks:
possessive repeats, and starts tied to the start of a run (or the end of the
last match), which leaves the leftmost matches unchanged.

Defined cases: null text is empty and has no spans; offsets count code points;
ties in start cannot occur within a kind except for an added span, which comes
after the base one.  Every row gives one row; null or repeated ids and further
columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 3000
MAX_CANDIDATES = 20_000
TREES = 12
RATE = 0.4
PRECISION = 0.995
#: Accepted candidates that the calibration of a threshold needs at least.
MIN_ACCEPTED = 20

# The base patterns.
_MAIL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A character that every match of the kind holds.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}

#: Generators of further candidates: what they look for, by the kind they report.
GENERATORS = {
    "email": (
        rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    ),
    "ip": (r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\.|\(dot\)|\[dot\]|\[\.\]) ?[0-9]{1,3}){3}+(?![0-9.])",),
    "card": (
        r"(?<![0-9])[0-9](?:[ -]{0,3}[0-9]){15,18}+(?![0-9])",
        r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}+(?![0-9])",
    ),
    "phone": (r"(?:\+|\()?(?<![0-9])[0-9](?:[ ().-]{0,2}[0-9]){6,18}+(?![0-9])",),
}
_CONTEXT = 16
# Words that announce a kind.
_HINT = r"(?i)(?:tel|phone|call|fax|mobile|contact|mail|e-mail|ip|host|card|visa|iban|account)[^A-Za-z0-9]*$"

_SPAN = "array<struct<start:int,stop:int,text:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches: ``array<struct<start, stop, text>>``, code points."""
    return _positions(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), F.split(text, pattern, -1))


def _positions(found: Column, gaps: Column) -> Column:
    """Places of matches from the lengths of what lies between them."""

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        stop = start + F.length(pair["text"])
        return F.struct(
            stop.alias("at"),
            F.concat(state["spans"], F.array(F.struct(start.alias("start"), stop.alias("stop"), pair["text"].alias("text")))).alias("spans"),
        )

    pairs = F.transform(found, lambda m, i: F.struct(F.get(gaps, i).alias("gap"), m.alias("text")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))
    return F.aggregate(pairs, start, step, lambda s: s["spans"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(kind: str, text: Column) -> Column:
    """The check that a match of a base pattern has to pass."""
    digits = _digits(text)
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
            F.split(text, r"\."), lambda p: F.coalesce(F.right(p, F.lit(9)).cast("int") <= 255, F.lit(False))
        )
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The base spans of one kind; texts without the kind's character are not searched."""
    needed = text.contains(_NEEDS[kind]) if kind in _NEEDS else F.lit(True)
    if kind in ("ip", "card"):
        needed = needed & text.rlike("[0-9][0-9. -]{6}")
    found = F.filter(matches(text, BASE[kind]), lambda s: valid(kind, s["text"]))
    return F.when(needed, found).otherwise(F.array().cast(_SPAN))


def _plain(text: Column, kind: str) -> Column:
    return F.regexp_replace(text, r" ?(?:\(dot\)|\[dot\]|\[\.\]|\.) ?", ".") if kind == "ip" else text


def generated(text: Column, kind: str) -> Column:
    """Candidates of one kind's generators, with the context before each."""
    needs = {"email": r"@|\(at\)|\[at\]", "ip": r"[0-9] ?(?:\.|\(dot\)|\[dot\]|\[\.\]) ?[0-9]"}
    needed = text.rlike(needs.get(kind, "[0-9][0-9 ().-]{5}"))
    met = [matches(text, pattern) for pattern in GENERATORS[kind]]
    found = F.transform(
        F.filter(F.array_union(*met) if len(met) > 1 else met[0], lambda s: valid(kind, _plain(s["text"], kind))),
        lambda s: s.withField(
            "before", F.substring(text, F.greatest(s["start"] - _CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(_CONTEXT)))
        ),
    )
    return F.when(needed, found).otherwise(F.array().cast("array<struct<start:int,stop:int,text:string,before:string>>"))


FEATURES: dict[str, Callable[[Column], Column]] = {
    "digits": lambda c: F.length(_digits(c["text"])),
    "length": lambda c: F.length(c["text"]),
    "letters": lambda c: F.length(F.regexp_replace(c["text"], "[^A-Za-z]", "")),
    "dots": lambda c: F.length(F.regexp_replace(c["text"], r"[^.]", "")),
    "hyphens": lambda c: F.length(F.regexp_replace(c["text"], "[^-]", "")),
    "spaces": lambda c: F.length(F.regexp_replace(c["text"], "[^ ]", "")),
    "brackets": lambda c: F.length(F.regexp_replace(c["text"], r"[^()\[\]]", "")),
    "luhn": lambda c: F.when(F.length(_digits(c["text"])).between(13, 19), luhn(_digits(c["text"])).cast("int")).otherwise(0),
    "groups": lambda c: F.size(F.split(c["text"], "[^0-9]+")),
    "hint": lambda c: c["before"].rlike(_HINT).cast("int"),
    "joined": lambda c: c["before"].rlike("[A-Za-z0-9.]$").cast("int"),
}


@dataclass(frozen=True)
class Ensemble:
    """Boosted depth-2 trees over ``FEATURES``: each ((feature, cut), left, right), where
    a side is ((feature, cut), low value, high value); and the threshold per kind."""

    bias: float
    trees: tuple
    thresholds: dict[str, float | None]

    def margin(self, row: dict[str, float]) -> float:
        total = self.bias
        for (f, cut), left, right in self.trees:
            (g, c), low, high = left if row[f] <= cut else right
            total += low if row[g] <= c else high
        return total

    def expression(self, candidate: Column) -> Column:
        total = F.lit(self.bias)
        values = {name: make(candidate) for name, make in FEATURES.items()}
        for (f, cut), left, right in self.trees:
            sides = [F.when(values[g] <= c, low).otherwise(high) for (g, c), low, high in (left, right)]
            total = total + F.when(values[f] <= cut, sides[0]).otherwise(sides[1])
        return total


def _best_split(rows: list[dict], slope: list[float], curve: list[float], at: list[int]) -> tuple[tuple[str, float], list[int], list[int]]:
    """The feature and cut with the highest second-order gain over the rows ``at``."""
    best, choice = -1.0, None
    total_g, total_h = sum(slope[i] for i in at), sum(curve[i] for i in at)
    for f in FEATURES:
        sums: dict[float, list[float]] = {}
        for i in at:
            s = sums.setdefault(rows[i][f], [0.0, 0.0])
            s[0] += slope[i]
            s[1] += curve[i]
        g = h = 0.0
        for v in sorted(sums)[:-1]:
            g += sums[v][0]
            h += sums[v][1]
            gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1)
            if gain > best + 1e-12:
                best, choice = gain, (f, v)
    if choice is None:
        return ("digits", math.inf), at, []
    f, cut = choice
    return choice, [i for i in at if rows[i][f] <= cut], [i for i in at if rows[i][f] > cut]


def boost(rows: list[dict], labels: list[int], trees: int = TREES, rate: float = RATE) -> Ensemble:
    """Logistic gradient boosting; thresholds stay unset."""
    share = (sum(labels) + 1) / (len(labels) + 2)
    bias = math.log(share / (1 - share))
    margins, grown = [bias] * len(rows), []

    def leaf(at: list[int], slope: list[float], curve: list[float]) -> float:
        return round(rate * sum(slope[i] for i in at) / (sum(curve[i] for i in at) + 1), 6)

    for _ in range(trees if rows else 0):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        slope = [y - q for y, q in zip(labels, p)]
        curve = [q * (1 - q) for q in p]
        cut, low, high = _best_split(rows, slope, curve, list(range(len(rows))))
        sides = []
        for part in (low, high):
            inner, a, b = _best_split(rows, slope, curve, part)
            values = (leaf(a, slope, curve), leaf(b, slope, curve))
            sides.append((inner, *values))
            for at, value in ((a, values[0]), (b, values[1])):
                for i in at:
                    margins[i] += value
        grown.append((cut, sides[0], sides[1]))
    return Ensemble(round(bias, 6), tuple(grown), {})


def calibrated(model: Ensemble, rows: list[dict], labels: list[int], kinds: list[str]) -> Ensemble:
    """Set per kind the lowest margin with enough precision (None: add nothing)."""
    thresholds: dict[str, float | None] = {}
    for kind in GENERATORS:
        scored = sorted(((model.margin(r), y) for r, y, k in zip(rows, labels, kinds) if k == kind), reverse=True)
        hits, best = 0, None
        for n, (margin, y) in enumerate(scored, 1):
            hits += y
            last = n == len(scored) or scored[n][0] < margin
            if last and n >= MIN_ACCEPTED and hits >= PRECISION * n:
                best = margin
        thresholds[kind] = best
    return Ensemble(model.bias, model.trees, thresholds)


def _base_structs(text: Column) -> Column:
    return F.struct(*[base_spans(text, k).alias(k) for k in KINDS])


def _overlaps(candidate: Column, base: Column) -> Column:
    hit = F.lit(False)
    for kind in KINDS:
        hit = hit | F.exists(base[kind], lambda s: (s["start"] < candidate["stop"]) & (candidate["start"] < s["stop"]))
    return hit


def _rewritten(text: Column, kind: str) -> list[Column]:
    """A base span's text in forms that its base pattern does not match."""
    if kind == "email":
        at = [F.replace(F.replace(text, F.lit("."), F.lit(dot)), F.lit("@"), F.lit(sign)) for sign, dot in ((" (at) ", " (dot) "), ("[at]", "[dot]"))]
        return [*at, F.replace(text, F.lit("@"), F.lit(" (at) "))]
    if kind == "ip":
        return [F.replace(text, F.lit("."), F.lit(dot)) for dot in ("[.]", " (dot) ", " . ")]
    if kind == "card":
        return [F.regexp_replace(_digits(text), "([0-9]{4})(?=[0-9])", f"$1{gap}") for gap in ("  ", " - ", " ")]
    bare = F.substr(text, F.lit(2))
    return [bare, F.regexp_replace(bare, "[ ().-]+", " "), F.regexp_replace(bare, "[ ().-]+", "-")]


def _random(text: Column, salt: Column, kind: str) -> list[Column]:
    """What a span of the kind could be taken for, drawn by the hash ``salt``."""
    digits = F.concat(*[F.lpad(F.pmod(F.xxhash64(salt, F.lit(k)), F.lit(10**9)).cast("string"), 9, "0") for k in range(3)])
    if kind == "email":
        word = F.translate(digits, "0123456789", "aeioutnsrl")
        return [F.concat(F.substring(word, 1, 4), F.lit(" @ "), F.substring(word, 9, 5), F.lit(dot), F.substring(word, 15, 3)) for dot in (". ", " . ")]
    run = F.substr(digits, F.lit(1), (F.pmod(salt, F.lit(13)) + 7).cast("int"))
    day = F.concat(F.lit("20"), F.substring(digits, 1, 2), F.lit("-0"), F.substring(digits, 3, 1), F.lit("-1"), F.substring(digits, 4, 1))
    return [
        run,
        F.concat(day, F.lit(" 1"), F.substring(digits, 5, 1)),
        F.concat(F.substring(digits, 1, 3), F.lit("."), F.substring(digits, 4, 7)),
        F.regexp_replace(run, "([0-9]{3})(?=[0-9])", "$1 "),
    ]


def _examples(found: DataFrame, kind: str) -> DataFrame:
    """``id, c, label`` of one kind, from the sample with its base spans."""
    text, none = F.col("text"), F.lit("")
    spans = found.select("id", "text", F.explode(F.col("base")[kind]).alias("s"))
    start = F.col("s.start")
    before = F.substring(text, F.greatest(start - _CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(_CONTEXT)))
    # a negative stands where the text has another word, two contexts earlier
    away = F.substring(text, F.greatest(start - 3 * _CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(_CONTEXT)))

    def made(forms: list[Column], context: Column, label: int) -> DataFrame:
        c = F.struct(start.alias("start"), F.col("form").alias("text"), F.coalesce(context, none).alias("before"))
        rows = spans.select("id", "text", "s", F.explode(F.array(*forms)).alias("form"))
        return rows.select("id", c.alias("c"), F.lit(label).alias("label"))

    salt = F.xxhash64("id", start)
    yes = made(_rewritten(F.col("s.text"), kind), before, 1)
    no = made(_random(F.col("s.text"), salt, kind), away, 0)
    # candidates over spans of other kinds are known not to be of this one
    other = found.select("id", "base", F.explode(generated(text, kind)).alias("c")).where(
        _overlaps(F.col("c"), F.col("base")) & ~F.exists(F.col("base")[kind], lambda s: (s["start"] < F.col("c.stop")) & (F.col("c.start") < s["stop"]))
    )
    other = other.select("id", F.struct("c.start", "c.text", "c.before").alias("c"), F.lit(0).alias("label"))
    return yes.union(no).union(other).where(valid(kind, _plain(F.col("c.text"), kind)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = TRAIN_DOCS) -> Ensemble:
    """Train on the candidates of at most ``max_docs`` documents."""
    keyed = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = keyed.select(F.col("id").alias("chosen")).where("chosen is not null").orderBy(F.xxhash64("chosen"), "chosen").limit(max_docs)
    # at most max_docs ids: broadcast, so that only the sample's texts leave the scan
    sample = staged(keyed.join(F.broadcast(ids.distinct()), F.col("id") == F.col("chosen")).drop("chosen"), "pii-sample")
    found = sample.withColumn("base", _base_structs(F.col("text")))
    candidates = None
    for kind in GENERATORS:
        one = _examples(found, kind).withColumn("kind", F.lit(kind))
        candidates = one if candidates is None else candidates.unionByName(one)
    features = [make(F.col("c")).cast("int").alias(name) for name, make in FEATURES.items()]
    order = F.xxhash64("id").alias("order")
    rows = (
        candidates.select("id", order, "kind", F.col("c.start").alias("start"), "label", *features)
        .orderBy("order", "id", "kind", "start", "label", *FEATURES)
        .limit(MAX_CANDIDATES)
        .collect()  # at most MAX_CANDIDATES rows of numbers
    )
    values = [{f: r[f] for f in FEATURES} for r in rows]
    fold = [r["order"] % 2 for r in rows]

    def part(side: int, items: list) -> list:
        return [x for x, f in zip(items, fold) if f == side]

    labels, kinds = [r["label"] for r in rows], [r["kind"] for r in rows]
    return calibrated(boost(part(0, values), part(0, labels)), part(1, values), part(1, labels), part(1, kinds))


def spans(docs: DataFrame, model: Ensemble, text_col: str = "text") -> DataFrame:
    """``docs`` with two columns: ``pii_base`` (struct of span arrays per kind) and
    ``pii_spans`` (array of kind, start, stop in order of kind and start)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("pii_base", _base_structs(text))
    base = F.col("pii_base")

    def as_span(order: int):
        return lambda s: F.struct(F.lit(order).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))

    per_kind = []
    for order, kind in enumerate(KINDS):
        per_kind.append(F.transform(base[kind], as_span(order)))
        bar = model.thresholds.get(kind) if kind in GENERATORS else None
        if bar is not None:
            added = F.filter(generated(text, kind), lambda c: ~_overlaps(c, base) & (model.expression(c) >= bar))
            per_kind.append(F.transform(added, as_span(order)))
    return out.withColumn("pii_spans", F.array_sort(F.concat(*per_kind)))


def span_text(spans_col: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans_col, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def base_span_text(base: Column) -> Column:
    def named(kind: str) -> Column:
        return F.transform(base[kind], lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string")))

    return F.array_join(F.concat(*map(named, KINDS)), ",")


def redact(text: Column, spans_col: Column) -> Column:
    """The text with every span replaced by ``[KIND]``; overlapping spans give one mark."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform(spans_col, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.when(
            s["start"] >= state["at"],
            F.struct(s["stop"].alias("at"), F.concat(state["out"], F.array(gap, F.get(names, s["kind"]))).alias("out")),
        ).otherwise(F.struct(F.greatest(state["at"], s["stop"]).alias("at"), state["out"].alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(by_start, start, step, lambda s: F.array_join(F.concat(s["out"], F.array(F.substring(text, s["at"] + 1, F.length(text)))), ""))
    return F.when(F.size(spans_col) > 0, done).otherwise(text)
