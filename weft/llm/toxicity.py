"""Toxicity scores: gradient-boosted trees over dense features, isotonic calibration.

Training looks at a bounded sample of labelled rows (``SAMPLE_ROWS``, those
with the smallest hash of their id) of the folds that are not held out:

1. A lexicon is learned: words and word beginnings of ``STEMS`` letters that
   stand in toxic rows far more often than chance allows. Support is counted in
   distinct contexts (neighbouring words), so copies of a row count once.
2. Dense features of a text are computed: lexicon densities and weights, how
   near hits stand to a second-person pronoun, capitals, punctuation, spelling
   tricks (letters replaced, spaced or repeated) and length.
3. Trees are boosted on the features and their margins calibrated by isotonic
   regression on a fold that the lexicon has not seen.

Scores use the text alone. The fold of a row is ``crc32(doc_id as text) mod 4``:
2 is held out, 0 and 1 teach the lexicon, all but 2 the trees. Margins of fold 3 are
calibrated, each half's by trees fitted without it.

Edge cases: a null text is empty and gets a score like any other; a label that
is null or whose document is missing is not used; a document labelled twice
counts as toxic if either label says so, a labelled doc_id on several rows teaches
by one of their texts; without labels of both kinds every
score is the share of toxic labels (0 without labels); repeated rows get equal
scores; a null doc_id is scored and not held out; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm.boosting import fit_isotonic, fit_trees
from weft.llm.common import frugal, hash_sample, text_slices, texts
from weft.session import cut_lineage, ship_package

SAMPLE_ROWS = 20_000
STEMS = (4, 5, 6)
THRESHOLD = 0.3
#: Entries of a worker's dictionary of words already looked at.
CACHE_ENTRIES = 150_000

# Second-person pronouns of the languages served.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner deinen ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
# Characters commonly put in place of letters.
_LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "€": "e"})
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„’‘…¡¿"
_REPEATS = re.compile(r"(.)\1{2,}")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
NEAR = 4

FEATURES = (
    "log_words", "word_density", "stem_density", "log_hits", "log_distinct", "weight_sum", "weight_top", "weight_density",
    "near_second_person", "second_person_density", "hidden_hits", "hidden_density", "capitals", "all_capitals", "punctuation", "exclamation", "digits",
)


def clean_word(chunk: str) -> str:
    return chunk.strip(_EDGES).lower()


def plain_word(chunk: str) -> str:
    """The word with look-alikes, separators inside and long repeats undone."""
    word = _NOT_LETTERS.sub("", chunk.strip(".,;:!?\"'()").lower().translate(_LOOKALIKES))
    return _REPEATS.sub(r"\1", word)


def terms(word: str) -> list[str]:
    """The word itself and its beginnings, marked with a star."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)] if len(word) > 2 else []


# ---------------------------------------------------------------------------
# the lexicon
# ---------------------------------------------------------------------------


def _contexts(sample: DataFrame, only=None) -> DataFrame:
    """(term, n): distinct contexts of each term (of those in ``only``)."""

    def task(batches):
        from xxhash import xxh3_64_intdigest

        wanted = only.value if only is not None else None
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                found = set()
                for text in texts(part.column("text")):
                    words = [w for w in map(clean_word, text.split()) if w]
                    for left, word, right in zip(["", *words], words, [*words[1:], ""]):
                        if own := [t for t in terms(word) if wanted is None or t in wanted]:
                            at = xxh3_64_intdigest(f"{left} {word} {right}") >> 1
                            found.update((t, at) for t in own)
                if found:
                    names, places = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(places, pa.int64())], names=["term", "at"])

    return sample.select("text").mapInArrow(frugal(task), "term string, at long").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Term -> log odds. ``sample``: (text, toxic 0/1), a bounded table."""
    spark = sample.sparkSession
    toxic = {r["term"]: r["n"] for r in _contexts(sample.where("toxic = 1")).where("n >= 3").toLocalIterator()}
    if not toxic:
        return {}
    clean = {r["term"]: r["n"] for r in _contexts(sample.where("toxic = 0"), spark.sparkContext.broadcast(frozenset(toxic))).toLocalIterator()}
    words = {r["toxic"]: r["n"] or 0 for r in sample.groupBy("toxic").agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).collect()}
    p0 = min(0.5, max(1e-3, words.get(1, 0) / max(1, sum(words.values()))))
    chance = math.log(len(toxic) + 1)
    out = {}
    for term, a in toxic.items():
        b = clean.get(term, 0)
        rate = a / (a + b)
        if rate >= 0.5 and a * math.log(rate / p0) + (b * math.log((1 - rate) / (1 - p0)) if b else 0.0) >= chance:
            out[term] = math.log((a + 0.5) / (b + 0.5)) - math.log(p0 / (1 - p0))
    return out


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------

_HIT, _STEM, _HIDDEN, _YOU, _CAPS = 1, 2, 4, 8, 16


class _Words(dict):
    """Chunk of text -> flags in the low byte, number of its lexicon term above."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.number = {t: i + 1 for i, t in enumerate(sorted(lexicon))}
        self.weights = np.array([0.0, *(lexicon[t] for t in sorted(lexicon))])

    def _term(self, word: str) -> str | None:
        known = [t for t in terms(word) if t in self.lexicon]
        return max(known, key=lambda t: (t[-1] != "*", self.lexicon[t])) if known else None

    def __missing__(self, chunk: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        word = clean_word(chunk)
        term = self._term(word)
        flags = 0 if term is None else _STEM if term[-1] == "*" else _HIT
        if term is None and not word.isalpha() or _REPEATS.search(word):
            plain = plain_word(chunk)
            if plain != word and (term := self._term(plain) or term) and not flags:
                flags = _HIDDEN
        flags |= _YOU * (word in SECOND_PERSON) | _CAPS * (len(word) > 2 and chunk.isupper())
        value = flags | (self.number[term] << 8 if term and flags & 7 else 0)
        if len(chunk) < 64:
            self[chunk] = value
        return value


def features(text: str, words: _Words) -> list[float]:
    chunks = text.split()
    n = len(chunks)
    codes = np.fromiter(map(words.__getitem__, chunks), np.int64, n)
    flags = codes & 255
    at = np.nonzero(flags & 7)[0]
    numbers = codes[at] >> 8
    weights = words.weights[numbers]
    you = np.nonzero(flags & _YOU)[0]
    near = 0
    if len(at) and len(you):
        k = np.searchsorted(you, at)
        gap = np.minimum(np.abs(at - you[np.minimum(k, len(you) - 1)]), np.abs(at - you[np.maximum(k - 1, 0)]))
        near = int((gap <= NEAR).sum())
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    letters = int(raw[65:91].sum() + raw[97:123].sum()) + 1
    size = len(text) + 1
    punctuation = int(raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum())
    hits, hidden = len(at), int((flags & _HIDDEN > 0).sum())
    return [
        math.log1p(n), int((flags & _HIT > 0).sum()) / (n + 1), int((flags & _STEM > 0).sum()) / (n + 1), math.log1p(hits), math.log1p(len(np.unique(numbers))), float(weights.sum()), float(weights.max(initial=0.0)), float(weights.sum()) / (n + 1),
        near, len(you) / (n + 1), hidden, hidden / (n + 1), int(raw[65:91].sum()) / letters, int((flags & _CAPS > 0).sum()) / (n + 1), punctuation / size, int(raw[33]) / size, int(raw[48:58].sum()) / size,
    ]


# ---------------------------------------------------------------------------
# model
# ---------------------------------------------------------------------------


class Model:
    """Lexicon, trees (None: a constant score) and calibration."""

    def __init__(self, lexicon, trees, calibration, constant=0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.constant)
        return np.interp(self.trees.margin(x), *self.calibration)


def fold(doc_id: str, folds: int = 4) -> Column:
    return F.pmod(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")), F.lit(folds)).cast("int")


def _feature_rows(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def task(batches):
        words = _Words(shared.value)
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = np.array([features(t, words) for t in texts(part.column("text"))], float).reshape(part.num_rows, len(FEATURES))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("fold", "toxic")] + [pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))], names=["fold", "toxic", "x"])

    return docs.select("fold", "toxic", "text").mapInArrow(frugal(task), "fold int, toxic int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled documents of the folds 0, 1, 3."""
    spark = docs.sparkSession
    ship_package(spark)
    own = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic").cast("int") > 0).cast("int").alias("toxic"))
    # the second half of fold 3 by the checksum's next bit is part 4
    own = own.withColumn("fold", F.when((fold("doc_id") == 3) & (fold("doc_id", 8) > 3), 4).otherwise(fold("doc_id"))).where("fold <> 2").groupBy("doc_id", "fold").agg(F.max("toxic").alias("toxic"))
    picked = hash_sample(cut_lineage(own, "labels"), ["doc_id"], sample_rows)  # at most sample_rows rows: safe to broadcast
    texts_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts_.join(F.broadcast(picked), "doc_id")
    # one text per labelled id, however often its row is repeated
    sample = cut_lineage(found.groupBy("doc_id", "fold", "toxic").agg(F.min("text").alias("text")).select("fold", "toxic", "text"), "labelled")
    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model({}, None, None, float(counts.get(1, 0) > 0))
    lexicon = learn_lexicon(sample.where("fold < 2"))
    rows = _feature_rows(sample, lexicon).collect()
    x = np.array([r["x"] for r in rows], float)
    y = np.array([r["toxic"] for r in rows], float)
    of = np.array([r["fold"] for r in rows])
    order = np.lexsort((of, *x.T, y))  # the same model however the rows arrive
    x, y, seen = x[order], y[order], of[order]
    trees = fit_trees(x, y)
    margins, known = [], []
    for part in (3, 4):
        # margins of rows by trees that have not seen them
        held = seen == part
        if held.any() and len(set(y[~held].tolist())) == 2:
            margins.append(fit_trees(x[~held], y[~held]).margin(x[held]))
            known.append(y[held])
    if len(set(np.concatenate([*known, []]).tolist())) < 2:  # too few labels for that
        margins, known = [trees.margin(x)], [y]
    return Model(lexicon, trees, fit_isotonic(np.concatenate(margins), np.concatenate(known)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on);
    columns of those names are replaced."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted")
    kept = list(docs.columns)

    def task(batches):
        words = _Words(shared.value.lexicon)
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = _scores(part, shared.value, words)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=[*kept, "score", "predicted"])

    return docs.mapInArrow(frugal(task), T.StructType([*docs.schema, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored ``threshold`` or more; any columns."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def task(batches):
        words = _Words(shared.value.lexicon)
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield part.filter(pa.array(_scores(part, shared.value, words) < threshold))

    return docs.mapInArrow(frugal(task), docs.schema)


def _scores(batch: pa.RecordBatch, model: Model, words: _Words) -> np.ndarray:
    x = np.array([features(t, words) for t in texts(batch.column("text"))], float)
    return model.score(x.reshape(batch.num_rows, len(FEATURES)))
