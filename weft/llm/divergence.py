"""Audit of how far the vocabularies of sources diverge, language by language.

Terms are the runs of ASCII letters and characters from U+0080 on, with only A-Z
lower-cased. Each language keeps the terms found in at least ``min_docs`` of its
documents. A group is a (lang, source) that occurs. For a kept term with
``count`` occurrences in a group, ``N`` the sum of the group's counts of kept
terms and ``V`` the number of kept terms,

    p = 1 + floor(10^9 * (count + 2) / (N + 2 V))
    f(p, q) = floor((p - q)^2 / (p + q))

in exact integer arithmetic. Part ``pair`` compares each group with every other
source of its language: the sum of f over all kept terms. Part ``term`` compares
it with its language as a whole: the ``top`` terms it holds more often.

1. Tasks over the documents run an Arrow compute pipeline: ``ascii_lower``,
   ``split_pattern_regex``, ``dictionary_encode`` and two hash ``group_by`` give
   partial (lang, source, term) counts of occurrences and documents. Partial
   tables are merged inside the task whenever they outgrow a bound, so a source
   that holds a third of all rows leaves a task as one row per term.
2. One shuffle by (lang, term) puts all counts of a term together; kept terms are
   written as columnar shards: per term the list of sources and counts.
3. Tasks over the shards lay blocks of terms out as a terms x sources matrix and
   sum f for every pair of columns. Partial sums and each block's best terms are
   merged by Spark. Sizes of groups come from a written side table.

Edge cases: null text, lang and source count as ''; each row is a document, a
repeated doc_id too; a group without terms has rows as any other; a language
without kept terms gives pairs of value 0 and no terms; a language of a single
source has no pairs; an empty table gives an empty result; doc_id and extra
columns are ignored. Exact while a language holds less than 9 * 10^15 terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import frugal, open_folder, text_slices
from weft.operators.side import write_side
from weft.session import cut_lineage, ship_package

MIN_DOCS, TOP = 10, 10
#: What separates terms.
GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE_STEPS = 3  # 10^9 as three factors of 1000
#: Rows of merged partial counts a task holds before it passes them on.
HELD_ROWS = 600_000
#: Cells of a terms x sources block, and most cells of a task's table of pair sums.
BLOCK_CELLS, SUM_CELLS = 2_000_000, 1_000_000
#: Sums and languages that a task holds before it passes them all on.
OPEN_CELLS, OPEN_LANGUAGES = 8_000_000, 256

COUNTS_SCHEMA = "lang string, source string, term string, n long, docs long"


# ---------------------------------------------------------------------------
# partial counts
# ---------------------------------------------------------------------------


def slice_counts(part: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of a slice; the empty term stands for the group."""
    lang, source = (pc.fill_null(part.column(c), "") for c in ("lang", "source"))
    pieces = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(part.column("text"), "")), GAP)
    row, term = pc.list_parent_indices(pieces), pc.list_flatten(pieces).dictionary_encode()
    tokens = pa.table({"row": row, "code": term.indices})
    per_doc = tokens.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    # the empty pieces beside separators are no terms
    blank = pc.index(term.dictionary, "").as_py()
    if blank >= 0:
        per_doc = per_doc.filter(pc.not_equal(per_doc["code"], blank))
    of_row = _group_numbers(lang, source)
    per_doc = per_doc.append_column("group", pa.array(of_row[per_doc["row"].to_numpy()], pa.int32()))
    counts = per_doc.group_by(["group", "code"], use_threads=False).aggregate([("count_all", "sum"), ("count_all", "count")])
    group = counts["group"].to_numpy()
    first = np.unique(of_row, return_index=True)[1]
    own_lang, own_source = lang.take(pa.array(first)), source.take(pa.array(first))
    found = pa.table({
        "lang": own_lang.take(pa.array(group)), "source": own_source.take(pa.array(group)),
        "term": term.dictionary.take(counts["code"].combine_chunks()), "n": counts["count_all_sum"], "docs": counts["count_all_count"],
    })
    n = len(first)
    marks = pa.table({"lang": own_lang, "source": own_source, "term": pa.array([""] * n), "n": pa.array([0] * n, pa.int64()), "docs": pa.array([0] * n, pa.int64())})
    return pa.concat_tables([found, marks])


def _group_numbers(lang: pa.Array, source: pa.Array) -> np.ndarray:
    """A dense number per distinct (lang, source) for each row."""
    a, b = (c.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (lang, source))
    return np.unique(a * (b.max() + 1) + b, return_inverse=True)[1]


def merge_counts(tables: list[pa.Table]) -> pa.Table:
    """Partial counts with one row per (lang, source, term)."""
    keys = ["lang", "source", "term"]
    out = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def partial_counts(docs: DataFrame, held_rows: int = HELD_ROWS) -> DataFrame:
    """(lang, source, term, n, docs), several rows per term; the empty term marks a group."""
    ship_package(docs.sparkSession)

    def task(batches):
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                held.append(slice_counts(part))
                rows += held[-1].num_rows
                if rows > held_rows:
                    held = [merge_counts(held)]
                    rows = held[0].num_rows
                    if rows > held_rows // 2:
                        yield from held[0].combine_chunks().to_batches(max_chunksize=65_536)
                        held, rows = [], 0
        if held:
            yield from merge_counts(held).combine_chunks().to_batches(max_chunksize=65_536)

    plain = docs.select(*(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")))
    return plain.mapInArrow(frugal(task), COUNTS_SCHEMA)


def count_shards(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Written (lang, term, sources, counts): each kept term of a language with the
    sources that hold it, and under the empty term all sources of the language."""
    # tasks have merged their counts already: one shuffle serves both groupings
    parts = partial_counts(docs).repartition("lang", "term")
    sums = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    lists = sums.groupBy("lang", "term").agg(F.sum("docs").alias("df"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("held"))
    kept = lists.where((F.col("df") >= min_docs) | (F.col("term") == ""))
    return cut_lineage(kept.select("lang", "term", F.col("held.source").alias("sources"), F.col("held.n").alias("counts")).sortWithinPartitions("lang", "term"), "terms")


# ---------------------------------------------------------------------------
# divergences
# ---------------------------------------------------------------------------


def shares(counts: np.ndarray, total, vocabulary: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 vocabulary)), by long division in
    three steps so that no product leaves 64 bits."""
    rest = counts.astype(np.int64) + 2
    below = np.asarray(total, np.int64) + 2 * vocabulary
    out = np.zeros(rest.shape, np.int64)
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        digit = rest // below
        out = out * 1000 + digit
        rest -= digit * below
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); both are at most 10^9 + 1."""
    return (p - q) ** 2 // (p + q)


class _Language:
    """Sums of f over the pairs of sources of one language, and its best terms."""

    def __init__(self, name: str, sources: pa.Array, totals: np.ndarray, terms: int, top: int):
        self.name, self.sources, self.totals, self.terms, self.top = name, sources, totals, terms, top
        n = len(sources)
        self.rows = max(1, BLOCK_CELLS // n)
        self.sums = np.zeros((n, n), np.int64) if n * n <= SUM_CELLS else None
        self.held: list[pa.RecordBatch] = []
        self.count = 0

    def add(self, part: pa.RecordBatch):
        """Rows (term, sources, counts), passed on block by block. The empty term
        lists the sources: it is no term, but their pairs exist."""
        marks = int(pc.sum(pc.equal(part.column("term"), "")).as_py() or 0)
        if marks and self.sums is None:
            for a in range(len(self.sources) - 1):
                yield from self.pair_rows(a, np.zeros(len(self.sources) - a - 1, np.int64))
        if marks:
            part = part.filter(pc.not_equal(part.column("term"), ""))
        for lo in range(0, part.num_rows, self.rows):
            some = part.slice(lo, self.rows)
            if self.count + some.num_rows > self.rows:
                yield from self.flush()
            self.held.append(some)
            self.count += some.num_rows

    def flush(self):
        if self.count:
            block = pa.Table.from_batches(self.held).combine_chunks()
            self.held, self.count = [], 0
            yield from self.block(*(block.column(c).combine_chunks() for c in ("term", "sources", "counts")))

    def pair_rows(self, first: int, sums: np.ndarray):
        """Rows of the pairs (first, later sources)."""
        later = np.arange(first + 1, len(self.sources))
        if len(later):
            names = [pa.array([self.name] * len(later)), pa.array([self.sources[first].as_py()] * len(later)), self.sources.take(pa.array(later))]
            yield _found("pair", *names, pa.array(sums))

    def block(self, terms: pa.Array, held: pa.ListArray, counts: pa.ListArray):
        """One block of distinct terms."""
        at = np.repeat(np.arange(len(terms)), np.diff(np.asarray(held.offsets)))
        column = pc.index_in(held.flatten(), self.sources).to_numpy(zero_copy_only=False)
        own = np.zeros((len(terms), len(self.sources)), np.int64)
        own[at, column] = counts.flatten().to_numpy()
        p = shares(own, self.totals[None, :], self.terms)
        for a in range(len(self.sources) - 1):
            sums = divergence(p[:, a + 1 :], p[:, a : a + 1]).sum(axis=0)
            if self.sums is None:
                yield from self.pair_rows(a, sums)
            else:
                self.sums[a, a + 1 :] += sums
        q = shares(own.sum(axis=1), self.totals.sum(), self.terms)
        rank = np.empty(len(terms), np.int64)
        rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
        for a in range(len(self.sources)):
            more = np.nonzero((own[:, a] > 0) & (p[:, a] > q))[0]
            f = divergence(p[more, a], q[more])
            best = np.lexsort((rank[more], -f))[: self.top]
            if len(best):
                names = [pa.array([self.name] * len(best)), pa.array([self.sources[a].as_py()] * len(best)), terms.take(pa.array(more[best]))]
                yield _found("term", *names, pa.array(f[best]))

    def end(self):
        yield from self.flush()
        if self.sums is not None:
            for a in range(len(self.sources) - 1):
                yield from self.pair_rows(a, self.sums[a, a + 1 :])


def _found(part: str, lang, source, item, value) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, source, pa.array([part] * len(item)), item.cast(pa.string()), value.cast(pa.int64())], names=["lang", "source", "part", "item", "value"])


def shard_divergences(shards: DataFrame, groups_path: str, top: int) -> DataFrame:
    """(lang, source, part, item, value): partial sums per pair of sources (the
    smaller one first) and each block's best terms."""

    def task(batches):
        import pyarrow.dataset as ds

        system, folder = open_folder(groups_path)
        source = ds.dataset(folder, filesystem=system, format="parquet", exclude_invalid_files=True)
        # a task sums over all its files: one row per pair leaves it, however many they are
        open_: dict[str, _Language] = {}
        cells = 0
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, name in enumerate(langs.dictionary.to_pylist()):
                if name not in open_:
                    own = source.to_table(filter=ds.field("lang") == name).sort_by("source")
                    new = _Language(name, own["source"].combine_chunks(), own["total"].to_numpy(), own["terms"][0].as_py(), top)
                    cells += new.sums.size if new.sums is not None else 0
                    open_[name] = new
                yield from open_[name].add(batch.filter(pc.equal(langs.indices, code)).select(["term", "sources", "counts"]))
            if cells > OPEN_CELLS or len(open_) > OPEN_LANGUAGES:
                for language in open_.values():
                    yield from language.end()
                open_, cells = {}, 0
        for language in open_.values():
            yield from language.end()

    return shards.mapInArrow(frugal(task), "lang string, source string, part string, item string, value long")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of the module's two parts; ranks
    count from 1 per group and part by falling value, then item."""
    shards = count_shards(docs, min_docs)
    listed = shards.where("term <> ''").select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("h"))
    totals = listed.groupBy("lang", F.col("h.sources").alias("source")).agg(F.sum("h.counts").alias("total"))
    terms = shards.where("term <> ''").groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = shards.where("term = ''").select("lang", F.explode("sources").alias("source"))
    groups = groups.join(totals, ["lang", "source"], "left").join(terms, "lang", "left").fillna(0, ["total", "terms"])
    parts = cut_lineage(shard_divergences(shards, write_side(groups, "groups"), top), "divergences")
    sums = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    mirrored = sums.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = sums.unionByName(mirrored).withColumn("rank", F.row_number().over(order))
    best = parts.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
