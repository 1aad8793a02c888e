"""Grouping of spelling variants by a frequency-vector trie.

Words are the lower-cased runs of letters (A-Z only are lower-cased; a given
share of runs, chosen by a checksum of document and run, loses one letter, which
plants variants). Words of at least ``MIN_LENGTH`` letters and ``MIN_COUNT``
occurrences form the vocabulary. Two words are near if they differ by exactly one
inserted, deleted or replaced letter.

1. Spark counts words with native expressions: partial counts leave each task.
2. A word is the vector of its counts of the letter groups ``GROUPS``. One edit
   adds at most one to one group (a surplus) and takes at most one from another
   (a deficit). The vocabulary is arranged as a trie whose levels are the
   successive group counts. The first ``TOP_LEVELS`` levels name a subtrie, the
   key of the shuffle: a word is at home in its own subtrie and visits those that
   the budget of one surplus and one deficit reaches. To meet each pair once, it
   visits only subtries that come after its own.
3. A task builds a subtrie over its home words and searches it depth first with
   all visitors: at each node the visitors whose budget is spent drop out.
   At a leaf the words left are verified letter by letter.
4. Near pairs give each word its number of near words and its form, the near
   word with the most occurrences if those are at least ``RATIO`` times its own;
   roots follow forms by pointer doubling, each round a written table.

No part of the vocabulary is collected; a subtrie's home words are held by one
task, its visitors pass through in batches. A frequent word is counted by partial
sums. The number of near words of a word is bounded by its length and the
alphabet.

Edge cases: a null text has no words; a null doc_id counts as the empty string
in the checksum; repeated rows count each; ties of occurrences go to the word
first in code-point order; an empty table gives an empty result; a run of any
length is a word (its group counts are whole numbers); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import frugal
from weft.session import cut_lineage, ship_package, spread

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: A run loses a letter if this divides its checksum.
DROP_EVERY = 199
#: Letter groups, in the order of the trie's levels; other letters go by code point.
GROUPS = ("e", "a", "i", "n", "t", "r", "s", "o", "lu", "dc", "mhp", "bfgjkqvwxyz")
TOP_LEVELS = 6
#: Visitors that search a subtrie at once.
VISITORS = 16_384

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---------------------------------------------------------------------------
# words
# ---------------------------------------------------------------------------


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """Written (word, n)."""
    plain = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.translate(F.col("text").cast("string"), _UPPER, _LOWER).alias("text"))
    # a run one letter short of the least length cannot become a word
    runs = plain.select("doc", F.explode(F.regexp_extract_all("text", F.lit(f"([a-zÀ-ÿ]{{{min_length},}})"), 1)).alias("run"))
    check = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = (check % F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = runs.select(F.when(check % drop_every == 0, shorter).otherwise(F.col("run")).alias("word")).where(F.length("word") >= min_length)
    return cut_lineage(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count), "words")


def group_table(groups: tuple[str, ...]) -> np.ndarray:
    """Group of each code point below 256, for any alphabet of such letters."""
    table = np.arange(256, dtype=np.int64) % len(groups)
    for g, letters in enumerate(groups):
        for c in letters:
            table[ord(c)] = g
    return table


def vectors(words: list[str], table: np.ndarray, size: int) -> np.ndarray:
    """Counts (words x groups) of the letter groups."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    group = table[np.minimum(letters, 255)]
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(row * size + group, minlength=len(words) * size).reshape(-1, size).astype(np.int32)


def one_edit(a: str, b: str) -> bool:
    """Do the words differ by exactly one inserted, deleted or replaced letter?"""
    if len(a) > len(b):
        a, b = b, a
    i = 0
    for x, y in zip(a, b):
        if x != y:
            break
        i += 1
    if len(a) == len(b):
        return i < len(a) and a[i + 1 :] == b[i + 1 :]
    return len(a) + 1 == len(b) and a[i:] == b[i + 1 :]


# ---------------------------------------------------------------------------
# the trie
# ---------------------------------------------------------------------------


def moves(levels: int) -> np.ndarray:
    """What one edit can do to the counts of the first levels: nothing, one more,
    one less, or one of each."""
    out = [np.zeros(levels, np.int32)]
    for i in range(levels):
        for s in (1, -1):
            v = np.zeros(levels, np.int32)
            v[i] = s
            out.append(v)
        for j in range(levels):
            if i != j:
                v = np.zeros(levels, np.int32)
                v[i], v[j] = 1, -1
                out.append(v)
    return np.array(out)


class Trie:
    """Words sorted by their vectors: a node is a range of rows that agree on the
    first levels, its children are the ranges of equal counts on the next one."""

    def __init__(self, words: list[str], counts: np.ndarray, levels: np.ndarray, first: int):
        order = np.lexsort(levels[:, ::-1].T)
        self.words = [words[i] for i in order.tolist()]
        self.counts, self.levels, self.first = counts[order], levels[order], first

    def search(self, levels: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Leaves (row range) with the visitors (rows of ``levels``) whose budget
        lasts to them. A surplus is a count that the trie's word has more."""
        depth = self.levels.shape[1]
        stack = [(0, len(self.words), self.first, np.arange(len(levels)), surplus, deficit)]
        while stack:
            lo, hi, level, who, more, less = stack.pop()
            if level == depth:
                yield lo, hi, who
                continue
            own = self.levels[lo:hi, level]
            cuts = np.concatenate(([0], np.nonzero(np.diff(own))[0] + 1, [hi - lo]))
            asked = levels[who, level]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                gap = own[a] - asked
                left_more, left_less = more - np.maximum(gap, 0), less - np.maximum(-gap, 0)
                alive = (left_more >= 0) & (left_less >= 0)
                if alive.any():
                    stack.append((lo + a, lo + b, level + 1, who[alive], left_more[alive], left_less[alive]))


def placed(words: DataFrame, groups: tuple[str, ...] = GROUPS, top: int = TOP_LEVELS) -> DataFrame:
    """(subtrie, visitor, word, n): each word at home and on its visits."""
    table, steps = group_table(groups), moves(top)

    def task(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                own = vectors(part.column("word").to_pylist(), table, len(groups))[:, :top]
                to = own[:, None, :] + steps[None, :, :]
                # later in the order of the subtries: the first change is an increase
                changed = steps[np.arange(len(steps)), np.argmax(steps != 0, axis=1)] >= 0
                row, step = np.nonzero(changed[None, :] & (to >= 0).all(axis=2))
                names = [",".join(map(str, v)) for v in to[row, step].tolist()]
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(step > 0), part.column("word").take(at), part.column("n").take(at)], names=["subtrie", "visitor", "word", "n"])

    return spread(words).mapInArrow(frugal(task), "subtrie string, visitor boolean, word string, n long")


def near_pairs(words: DataFrame, groups: tuple[str, ...] = GROUPS, top: int = TOP_LEVELS, visitors: int = VISITORS) -> DataFrame:
    """(a, n_a, b, n_b): every unordered pair of near words once."""
    ship_package(words.sparkSession)
    table = group_table(groups)

    def meet(trie: Trie, own: list[str], n: np.ndarray, at_home: bool):
        """Verified pairs of a batch of visitors (or of home words) with a subtrie."""
        levels = vectors(own, table, len(groups))
        gap = trie.levels[0, :top] - levels[:, :top]
        out = []
        for lo, hi, who in trie.search(levels, 1 - np.maximum(gap, 0).sum(axis=1), 1 - np.maximum(-gap, 0).sum(axis=1)):
            for r in range(lo, hi):
                b = trie.words[r]
                for v in who.tolist():
                    a = own[v]
                    if (a < b or not at_home) and one_edit(a, b):
                        out.append((a, int(n[v]), b, int(trie.counts[r])))
        if out:
            a, na, b, nb = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(na, pa.int64()), pa.array(b, pa.string()), pa.array(nb, pa.int64())], names=["a", "n_a", "b", "n_b"])

    def task(batches):
        name, trie = None, None
        home: list[pa.RecordBatch] = []

        def build():
            rows = pa.Table.from_batches(home)
            own, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
            return Trie(own, n, vectors(own, table, len(groups)), top), own, n

        def close():
            """Home words among themselves, where no visitor came to make the trie."""
            nonlocal trie
            if home and trie is None:
                trie, own, n = build()
                for lo in range(0, len(own), visitors):
                    yield from meet(trie, own[lo : lo + visitors], n[lo : lo + visitors], True)

        for batch in batches:
            key = batch.column("subtrie").dictionary_encode()
            role = np.asarray(batch.column("visitor").to_numpy(zero_copy_only=False))
            code = key.indices.to_numpy(zero_copy_only=False) * 2 + role
            cuts = [0, *(np.nonzero(np.diff(code))[0] + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                own_name = key[lo].as_py()
                if own_name != name:
                    yield from close()
                    name, trie, home = own_name, None, []
                part = batch.slice(lo, hi - lo)
                if not role[lo]:
                    home.append(part)
                    continue
                if not home:
                    continue  # nobody lives here
                yield from close()
                for k in range(0, part.num_rows, visitors):
                    some = part.slice(k, visitors)
                    yield from meet(trie, some.column("word").to_pylist(), some.column("n").to_numpy(), False)
        yield from close()

    dealt = placed(words, groups, top).repartition("subtrie").sortWithinPartitions("subtrie", "visitor")
    return dealt.mapInArrow(frugal(task), "a string, n_a long, b string, n_b long")


# ---------------------------------------------------------------------------
# forms
# ---------------------------------------------------------------------------


def follow(forms: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(word, root) of each row of ``forms`` (word, form): the last word reached.
    Forms grow more frequent at each step, so there are no rings."""
    current = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = current.join(onward, "root", "left")
        state = cut_lineage(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("_moved")), "roots")
        current = state.select("word", "root")
        if state.where("_moved").isEmpty():
            return current
    raise RuntimeError(f"forms did not settle in {max_rounds} rounds")


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, drop_every: int = DROP_EVERY) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of the vocabulary."""
    words = vocabulary(docs, min_length, min_count, drop_every)
    pairs = cut_lineage(near_pairs(words), "near")
    back = pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    best = pairs.unionByName(back).groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b"))).alias("best"))
    near = best.select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("form"), (-F.col("best.less")).alias("form_n"))
    found = words.join(near, "word", "left")
    fits = F.col("form_n") >= F.col("n") * ratio
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n"))
    found = cut_lineage(found, "forms")
    return found.join(follow(found.where("form IS NOT NULL")), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
