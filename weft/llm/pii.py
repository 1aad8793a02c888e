"""Personal data: candidate spans, boosted trees, calibrated selection.

Everything that touches the texts is a DataFrame expression; Python only plans
and fits the small model on a bounded sample of candidate features.

1. Base spans: leftmost non-overlapping matches per kind (email, ip, card,
   phone) that pass the kind's check. They always stay.
2. High-recall generators propose further spans, overlapping the matches that
   failed their check: card numbers inside a digit run that swallowed a
   neighbouring number, of a phone run that went on into the next number the
   beginnings of 8 to 15 digits that end with a group (of its first 15 groups),
   phone numbers in national form (3-3-4 digits, or with a leading 0 and 9 to 12
   digits) and emails written with (at) and (dot).
3. Features of a candidate are its format (kind; a card's digits, groups and
   separators) and its context (adjoining letters and digits, quotes and equals
   signs, cue words, whether the number goes on). Checksums, octets and the digit
   counts of phones, which make the labels, are no features, nor is the layout of
   a phone, which tells its country.
4. Trees are boosted on matches that pass their kind's check against look-alikes
   that fail it, at most ``SAMPLE_SPANS`` of both: first on the context alone,
   whatever the kind, so that what the checksums teach about a context holds for
   kinds without one; then on format and context. They are calibrated on a third
   of the sample held out from the trees. A proposed span that passes the check
   is selected where the calibrated probability reaches ``THRESHOLD``; for cards
   after allowing for the look-alikes that pass by chance. Without matches of
   both sorts in both parts the check alone decides.

Positions count code points, ends are exclusive. The patterns are the contract's
written with possessive quantifiers and guards for where a run begins, so that
matching takes time linear in the text and no stack on long runs.

Edge cases: a null or empty text has no spans; overlapping proposals of a kind
keep the first; repeated rows give repeated results; a null doc_id is kept; an
empty table gives an empty result; other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.boosting import Trees, fit_isotonic, fit_trees
from weft.llm.common import hash_sample
from weft.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
SAMPLE_SPANS = 20_000
THRESHOLD = 0.5
#: Characters of context kept on either side of a span.
CONTEXT = 24

# Patterns of the base spans. A run can only begin where the one before it ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

# Generators inside failed matches, and over the text.
CARD_INSIDE = r"(?<![0-9])(?:[0-9]{16,19}|[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}|[0-9]{13,15})(?![0-9])"
PHONE_LAYOUT = r"^\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}$"
NUMBER_AFTER = r"^\x20(?:\(|(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])|[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{2,4}(?![0-9])|[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])|[0-9]{13}|(?:[0-9]{4}[\x20-]){3}[0-9]{4}(?![0-9]))"
PHONE_NATIONAL = r"(?<![0-9+.-])(?<!\+[0-9]{1,3}[\x20.-]?)(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])"
PHONE_TRUNK = r"(?<![0-9+.-])(?<![0-9][\x20().-]{1,4})(?:\(0[1-9][0-9]{1,4}\)\x20?[0-9]{3,8}(?:[\x20-][0-9]{2,8}){0,3}|0[1-9][0-9]{1,4}(?:[\x20-][0-9]{2,8}){1,4}|0[1-9](?:[\x20.][0-9]{2}){4})(?![0-9])(?![\x20.-][0-9])"
EMAIL_SPELLED = r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}+\x20?[\(\[{]\x20?at\x20?[\)\]}]\x20?[A-Z0-9-]{1,63}+(?:(?:\.|\x20?[\(\[{]\x20?dot\x20?[\)\]}]\x20?)[A-Z0-9-]{1,63}+)++"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
CUES = r"(?i)(?:tel|phone|fon|call|mobile|card|visa|credit|mail|contact|ip|host|addr\w*)\W*$"
CODES = r"(?i)(?:token|key|hash|id|no|nr|sku|isbn|version|v)\W*$"

FORMAT = ("kind", "digits", "groups", "separators")
FEATURES = (*FORMAT, "joined_left", "joined_right", "quoted", "cue", "code", "goes_on")
#: Equal spans in equal surroundings that the sample may hold.
COPIES = 64
#: Rank of a span's end from which its number goes on.
GOES_ON = 3.0
#: Digits of the longest number of a kind.
LONGEST = {"card": 19, "phone": 15}
#: Share of look-alikes that pass a kind's check by chance.
CHANCE = {"card": 0.1}


# ---------------------------------------------------------------------------
# expressions
# ---------------------------------------------------------------------------


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums(numbers: Column) -> Column:
    """struct(total, running sums) of a short array."""
    start = F.struct(F.lit(0).cast("long").alias("t"), F.array().cast("array<bigint>").alias("a"))
    return F.aggregate(numbers, start, lambda s, x: F.struct((s["t"] + x).alias("t"), F.concat(s["a"], F.array(s["t"] + x)).alias("a")))


def running(numbers: Column, part: int = 512) -> Column:
    """Running sums of a long array, part by part: appending to one long array
    would copy it at every step."""

    def parts(a: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / part).cast("int")), lambda i: _sums(F.slice(a, i * part + 1, F.lit(part))))
        return let(cut, joined)

    def joined(p: Column) -> Column:
        before = let(_sums(F.transform(p, lambda s: s["t"])), lambda s: s["a"])
        return F.flatten(F.zip_with(p, before, lambda s, b: F.transform(s["a"], lambda x: x + b - s["t"])))

    return F.when(F.size(numbers) == 0, F.array().cast("array<bigint>")).otherwise(let(numbers, parts))


SPAN = "array<struct<s:bigint,e:bigint,m:string,l:string,r:string,g:double>>"


def matches(text: Column, pattern: str) -> Column:
    """All matches with their places and contexts; ``g`` is the rank of their
    end, 0 but for ``_prefixes``."""

    def placed(pieces: Column, found: Column) -> Column:
        steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: (F.length(p) + F.length(m)).cast("long"))
        rows = F.arrays_zip(running(steps).alias("e"), found.alias("m"), F.slice(pieces, F.lit(1), F.size(found)).alias("l"), F.slice(pieces, F.lit(2), F.size(found)).alias("r"))
        return F.transform(rows, lambda z: F.struct((z["e"] - F.length(z["m"])).alias("s"), z["e"].alias("e"), z["m"].alias("m"), F.substring(z["l"], -CONTEXT, CONTEXT).alias("l"), F.substring(z["r"], 1, CONTEXT).alias("r"), F.lit(0.0).alias("g")))

    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return F.when(text.rlike(pattern), let(both, lambda b: let(b["m"], lambda m: let(b["p"], lambda p: placed(p, m))))).otherwise(F.array().cast(SPAN))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Whether the digits of ``m`` (few) pass the Luhn check."""

    def total(d: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            x = F.substr(d, F.length(d) - i + 1, F.lit(1)).cast("int")
            doubled = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
            return s + F.when(i % 2 == 0, doubled).otherwise(x)

        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), step) % 10 == 0

    return let(_digits(m), total)


def valid(kind: str, m: Column) -> Column:
    """The check of a base match."""
    n = F.length(_digits(m))
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), _luhn(m)).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 8) & (n <= 15)
    return m.rlike(OCTETS) if kind == "ip" else F.lit(True)


def checked(kind: str, m: Column) -> Column:
    """The check of a candidate, which also labels the training spans: as of a
    base match, but cards of 13 to 15 digits count, and an email's domain ends
    in letters."""
    n = F.length(_digits(m))
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), _luhn(m)).otherwise(F.lit(False))
    return m.rlike(r"[A-Za-z]{2}$") if kind == "email" else valid(kind, m)


def _features(kind: str, c: Column) -> Column:
    """array<double> in the order of ``FEATURES``."""
    m, left, right = c["m"], c["l"], c["r"]
    n = F.length(_digits(m))
    flag = lambda b: F.when(b, 1.0).otherwise(0.0)
    layout = [x.cast("double") if kind == "card" else F.lit(0.0) for x in (n, F.size(F.split(m, "[^0-9]++")), F.length(m) - n)]
    return F.array(
        F.lit(float(KINDS.index(kind))), *layout,
        flag(left.rlike(r"[\p{L}0-9]$")), flag(right.rlike(r"^[\p{L}0-9]")), flag(left.rlike("[\"'=]$") | right.rlike("^[\"']")), flag(left.rlike(CUES)), flag(left.rlike(CODES)), flag(c["g"] >= GOES_ON),
    )


def _inside(failed: Column, pattern: str) -> Column:
    """Proposals inside failed matches, at their places in the text."""

    def of(c: Column) -> Column:
        return F.transform(
            matches(c["m"], pattern),
            lambda x: F.struct((c["s"] + x["s"]).alias("s"), (c["s"] + x["e"]).alias("e"), x["m"].alias("m"), F.concat(c["l"], x["l"]).alias("l"), F.concat(x["r"], c["r"]).alias("r"), x["g"].alias("g")),
        )

    return F.flatten(F.transform(failed, of))


def _prefixes(spans: Column, low: int, high: int) -> Column:
    """The beginnings of phone runs that end with a group of digits, ``low`` to
    ``high`` digits each. ``g`` ranks their ends: 0 where another number begins
    after them, 1 a number of a common layout, 2 the last that can be one number
    (15 digits), 3 the number goes on."""

    def of(c: Column) -> Column:
        head = F.regexp_extract(c["m"], r"^\+(?:[0-9]++[^0-9]*+){1,15}", 0)
        return F.transform(matches(head, "[0-9]++"), lambda x: let(F.substr(c["m"], F.lit(1), x["e"].cast("int")), lambda m: cut(c, x["e"], m)))

    def cut(c: Column, e: Column, m: Column) -> Column:
        after = F.concat(F.substr(c["m"], (e + 1).cast("int"), F.lit(CONTEXT)), c["r"])
        return let(after, lambda r: F.struct(c["s"].alias("s"), (c["s"] + e).alias("e"), m.alias("m"), c["l"].alias("l"), r.alias("r"), rank(m, r).alias("g")))

    def rank(m: Column, r: Column) -> Column:
        full = F.length(_digits(m)) + F.length(F.regexp_extract(r, r"^\x20+([0-9]+)", 1)) > 15
        return F.when(r.rlike(NUMBER_AFTER), 0.0).when(m.rlike(PHONE_LAYOUT) & ~r.rlike("^[.-]"), 1.0).when(full, 2.0).otherwise(3.0)

    n = lambda c: F.length(_digits(c["m"]))
    return F.filter(F.flatten(F.transform(spans, of)), lambda c: (n(c) >= low) & (n(c) <= high))


def with_matches(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``failed`` matches and ``proposed`` spans, each a
    struct of one array per kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.withColumn("_found", F.struct(*[F.when(text.rlike("[0-9@]"), matches(text, BASE[k])).otherwise(F.array().cast(SPAN)).alias(k) for k in KINDS]))

    def ok(kind: str, want: bool) -> Column:
        return F.filter(F.col(f"_found.{kind}"), lambda c: valid(kind, c["m"]) if want else ~valid(kind, c["m"]))

    split = found.withColumn("base", F.struct(*[ok(k, True).alias(k) for k in KINDS])).withColumn("failed", F.struct(*[ok(k, False).alias(k) for k in KINDS]))
    proposed = F.struct(
        F.when(text.rlike(r"(?i)[\(\[{]\x20?at\x20?[\)\]}]"), matches(text, EMAIL_SPELLED)).otherwise(F.array().cast(SPAN)).alias("email"),
        F.array().cast(SPAN).alias("ip"),
        _inside(F.col("failed.card"), CARD_INSIDE).alias("card"),
        F.concat(
            _prefixes(F.col("failed.phone"), 8, 15),
            F.when(text.rlike("[0-9][.-][0-9]{4}"), matches(text, PHONE_NATIONAL)).otherwise(F.array().cast(SPAN)),
            F.when(text.rlike(r"0[1-9][0-9]{0,4}\)?[\x20.-]?[0-9]{2}"), F.filter(matches(text, PHONE_TRUNK), lambda c: F.length(_digits(c["m"])).between(9, 12))).otherwise(F.array().cast(SPAN)),
        ).alias("phone"),
    )
    return split.withColumn("proposed", proposed).drop("_found")


# ---------------------------------------------------------------------------
# the model
# ---------------------------------------------------------------------------


class Model:
    """Trees and, per kind, the margin from which the calibrated probability
    suffices."""

    def __init__(self, trees: list[Trees], margins: dict[str, float]):
        self.trees, self.margins = trees, margins

    def accepts(self, kind: str, c: Column) -> Column:
        def likely(x: Column) -> Column:
            return self._margin(x) >= F.lit(self.margins[kind])

        fits = checked(kind, c["m"])
        return fits & let(_features(kind, c), likely) if self.trees else fits & (c["g"] < GOES_ON)

    def _margin(self, x: Column) -> Column:
        def node(t: Trees, k: int, i: int) -> Column:
            inner = t.features.shape[1]
            if i >= inner:
                return F.lit(float(t.leaves[k, i - inner]))
            if not np.isfinite(t.thresholds[k, i]):
                return node(t, k, 2 * i + 1)
            return F.when(F.element_at(x, int(t.features[k, i]) + 1) <= F.lit(float(t.thresholds[k, i])), node(t, k, 2 * i + 1)).otherwise(node(t, k, 2 * i + 2))

        total = F.lit(sum(t.base for t in self.trees))
        for t in self.trees:
            for k in range(len(t.features)):
                total = total + node(t, k, 0)
        return total


def train(found: DataFrame, sample_spans: int = SAMPLE_SPANS, threshold: float = THRESHOLD) -> Model:
    """Fit on the checked matches of ``with_matches`` rows against look-alikes.
    Card and phone runs too long for one number have no label and stay out."""

    def labelled(kind: str, spans: Column, y: Column | None = None) -> Column:
        label = lambda c: F.when(checked(kind, c["m"]) if y is None else y, 1).otherwise(0)
        return F.transform(spans, lambda c: F.struct(_features(kind, c).alias("x"), label(c).alias("y"), F.xxhash64(c["m"], c["l"], c["r"]).alias("h")))

    def short(kind: str) -> Column:
        spans = F.concat(F.col(f"base.{kind}"), F.col(f"failed.{kind}"))
        return F.filter(spans, lambda c: F.length(_digits(c["m"])) <= LONGEST[kind]) if kind in LONGEST else spans

    rows = [labelled(k, short(k)) for k in KINDS]
    whole = lambda c: F.length(F.regexp_extract(c["r"], r"^[\x20().-]*[0-9]", 0)) == 0
    rows.append(labelled("phone", F.filter(_prefixes(F.col("base.phone"), 4, 14), lambda c: ~whole(c)), F.lit(False)))
    # written once, so that it is counted before it is sampled; equal spans in equal
    # surroundings are aggregated first and count COPIES times at most, as copies of
    # a document would else fill the sample
    spans = found.select(F.explode(F.concat(*rows)).alias("c")).select("c.*").groupBy("x", "y", "h").agg(F.count(F.lit(1)).alias("n"))
    spans = cut_lineage(spans.select("x", "y", "h", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(COPIES)).cast("int"))).alias("copy")), "spans")
    sample = hash_sample(spans, ["h", "y", "copy"], sample_spans).collect()
    x, y = np.array([r["x"] for r in sample], float).reshape(len(sample), len(FEATURES)), np.array([r["y"] for r in sample], float)
    held = np.array([r["h"] % 3 == 0 for r in sample], bool)
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        return Model([], {})
    order = np.lexsort((*x.T, y, held))
    x, y, held = x[order], y[order], held[order]
    context = x.copy()
    context[:, : len(FORMAT)] = 0
    trees = [fit_trees(context[~held], y[~held], rounds=12, depth=3)]
    trees.append(fit_trees(x[~held], y[~held], rounds=12, depth=3, start=trees[0].margin(x[~held])))
    margins, odds = fit_isotonic(sum(t.margin(x[held]) for t in trees), y[held])

    def least(kind: str) -> float:
        # of spans that pass, those that do by chance: p = q + chance * (1 - q)
        chance = CHANCE.get(kind, 0.0)
        enough = chance / (1 - (1 - chance) * threshold) if chance else threshold
        if odds[-1] < enough:
            return float("inf")
        at = int(np.argmax(odds >= enough))
        return float(np.interp(enough, odds[at - 1 : at + 1], margins[at - 1 : at + 1]) if at else margins[0]) - 1e-9

    return Model(trees, {k: least(k) for k in KINDS})


def _disjoint(spans: Column) -> Column:
    """Spans ordered by place, without those that begin inside an earlier one; of
    those that begin together, the one with the best and then farthest end."""
    ordered = F.transform(F.array_sort(F.transform(spans, lambda c: F.struct(c["s"].alias("s"), c["g"].alias("g"), (-c["e"]).alias("e")))), lambda c: F.struct(c["s"].alias("s"), (-c["e"]).alias("e")))
    start = F.struct(F.lit(0).cast("long").alias("t"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("a"))
    return F.aggregate(ordered, start, lambda a, c: F.when(c["s"] < a["t"], a).otherwise(F.struct(c["e"].alias("t"), F.concat(a["a"], F.array(c)).alias("a"))), lambda a: a["a"])


def find(docs: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``docs`` with ``base_spans`` and ``all_spans``: per kind an array of
    (s, e), in order; columns of those names are replaced. ``all_spans`` holds the base spans and the selected ones."""
    # the row is kept as one value, so that no column of it meets one made here
    kept = docs.drop("base_spans", "all_spans")
    found = with_matches(docs.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_row"), F.col(text_col).alias("_text")), "_text")
    model = model or train(found)
    plain = lambda spans: F.transform(spans, lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e")))
    base = F.struct(*[plain(F.col(f"base.{k}")).alias(k) for k in KINDS])

    def selected(kind: str) -> Column:
        return _disjoint(F.filter(F.col(f"proposed.{kind}"), lambda c: model.accepts(kind, c)))

    every = F.struct(*[F.when(F.size(f"proposed.{k}") > 0, F.array_sort(F.array_union(plain(F.col(f"base.{k}")), selected(k)))).otherwise(plain(F.col(f"base.{k}"))).alias(k) for k in KINDS])
    return found.select("_row.*", base.alias("base_spans"), every.alias("all_spans"))


def spelled(spans: str) -> Column:
    """``kind:start:end`` of a struct column of spans, joined by commas."""

    def of(kind: str) -> Column:
        return F.transform(F.col(f"{spans}.{kind}"), lambda c: F.concat(F.lit(f"{kind}:"), c["s"].cast("string"), F.lit(":"), c["e"].cast("string")))

    return F.concat_ws(",", *[of(k) for k in KINDS])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets (where
    spans of different kinds overlap, all they cover by the kind of the earliest) and, in changed rows,
    ``length_col`` set to the new text's code points."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text"))
    found = find(whole)

    def tag(kind: str) -> Column:
        return F.transform(F.col(f"all_spans.{kind}"), lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.lit(f"<{kind}>").alias("k")))

    start = F.struct(F.lit(0).cast("long").alias("t"), F.array().cast("array<string>").alias("a"))

    def cut(text: Column) -> Column:
        def step(a: Column, c: Column) -> Column:
            between = F.substr(text, (a["t"] + 1).cast("int"), (c["s"] - a["t"]).cast("int"))
            return F.when(c["s"] < a["t"], F.struct(F.greatest(a["t"], c["e"]).alias("t"), a["a"].alias("a"))).otherwise(F.struct(c["e"].alias("t"), F.concat(a["a"], F.array(between, c["k"])).alias("a")))

        rest = lambda a: F.concat(F.array_join(a["a"], ""), F.substr(text, (a["t"] + 1).cast("int")))
        return F.aggregate(F.array_sort(F.concat(*[tag(k) for k in KINDS])), start, step, rest)

    any_span = sum((F.size(f"all_spans.{k}") for k in KINDS), F.lit(0)) > 0
    marked = found.select("row", any_span.alias("hit"), F.when(any_span, cut(F.col("text"))).otherwise(F.col("text")).alias("new"))

    def column(c: str) -> Column:
        old = F.col("row").getField(c)
        if c == text_col:
            return F.col("new").alias(c)
        return (F.when(F.col("hit"), F.length("new").cast(docs.schema[c].dataType)).otherwise(old) if c == length_col else old).alias(c)

    return marked.select(*[column(c) for c in docs.columns])
