"""SimHash, substring dedup, decontamination."""

import hashlib
import random
import re

import pytest
from llm_cases import ODD, SF, make  # noqa: F401
from xxhash import xxh64_intdigest

from weft.llm import components, decontam, queries, simhash, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode("utf-8", "surrogatepass"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """[(doc, fingerprint)] -> smallest doc reachable over links of at most 2 bits."""
    parent = {f: f for _, f in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    own = list(parent)
    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    least = {}
    for doc, f in prints:
        if doc is not None:
            least[root(f)] = min(doc, least.get(root(f), doc))
    return [(doc, f, least.get(root(f))) for doc, f in prints]


def as_rows(df):
    return sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in df.collect()), key=str)


def test_fingerprints_and_components_on_odd_rows(make):
    rows = [*ODD, *((20 + i, f"alpha beta gamma delta epsilon zeta {'eta ' * i}") for i in range(6))]
    expected = brute_components([(d, brute_print(t)) for d, t in rows])
    assert as_rows(simhash.near_duplicates(make(rows))) == sorted(expected, key=str)


@pytest.mark.parametrize("dense", [64, 2, 1])
def test_links_on_crowded_fingerprints(spark, dense):
    """Chains and clusters of close fingerprints; a low ``dense`` sends all keys
    through the neighbour lists instead of the join."""
    rnd = random.Random(4)
    prints = set()
    for _ in range(12):
        f = rnd.getrandbits(64)
        for _ in range(25):
            prints.add(f)
            for b in rnd.sample(range(64), rnd.choice((1, 1, 2, 2, 3, 4))):
                f ^= 1 << b
    rows = list(enumerate(sorted(prints)))
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in rows], "node long, fp long")
    links = simhash.close_pairs(nodes, dense=dense)
    by = dict(rows)
    assert all((by[r["u"]] ^ by[r["v"]]).bit_count() <= 2 for r in links.collect())
    found = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert [found.get(i, i) for i, _ in rows] == [c for _, _, c in brute_components(rows)]


def test_components_of_a_chain_a_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_simhash_of_an_empty_table(make):
    assert simhash.near_duplicates(make([])).count() == 0
    assert simhash.keep_one(make([])).count() == 0


def test_keep_one_of_each_group(make):
    docs = make(ODD)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # 5, 6, 7 are blank alike; 1 (twice) and 2 are copies; a null id stays
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([5, 1, None, 9, 10, 11, 12], key=str)


def test_op4_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = [(d, f"{f:016x}", c) for d, f, c in brute_components([(d, brute_print(t)) for d, t in rows])]
    assert sorted(tuple(r) for r in queries.QUERIES["op4_simhash_blocks"](spark, SF).collect()) == sorted(expected)


def brute_windows(rows, n=20):
    """Judged over rows in id order; rows of one id are versions of it."""
    seen, removed, words = {}, {}, {}
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    for doc, text in order:
        w = WORD.findall(text or "")
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            seen[key] = min(seen.get(key, (doc, i)), (doc, i))
    for doc, text in order:
        w = WORD.findall(text or "")
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] < (doc, i):
                removed.setdefault(doc, set()).update(range(i, i + n))
    out = []
    for doc, text in rows:
        w = WORD.findall(text or "")
        gone = removed.get(doc, ()) if doc is not None else ()
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode("utf-8", "surrogatepass")).hexdigest()))
    words.clear()
    return sorted(out, key=str)


@pytest.mark.parametrize("cells", [None, substring.CHUNK_BITS, 64])
def test_windows_against_brute_force(spark, make, cells):
    rnd = random.Random(2)
    phrase = [f"w{i}" for i in range(60)]
    rows = list(ODD)
    for d in range(40, 80):
        text = [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 50))]
        a = rnd.randint(0, 40)
        text[rnd.randint(0, len(text)) :] = phrase[a : a + rnd.randint(5, 60)] + text[:20]
        rows.append((d, rnd.choice((" ", "\n", "\t ")).join(text)))
    rows += [(90, " ".join(phrase)), (3, " ".join(phrase)), (91, "same " * 50)]
    got = substring.remove_repeats(make(rows).repartition(5), cells=cells)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()), key=str) == brute_windows(rows)


@pytest.mark.parametrize("gib", [0.01, 30])
def test_sketch_of_any_size_lets_few_unrepeated_windows_pass(spark, make, gib):
    """The load of a row of cells does not grow with the text: at that of ``gib`` GiB,
    unrepeated windows are hardly ever grouped."""
    anchors = int(gib * 2**30) / substring.CHARS_PER_WORD * 2 / 14
    load = anchors / substring.sketch_cells(int(gib * 2**30))
    rnd = random.Random(7)
    rows = [(d, " ".join(str(rnd.random()) for _ in range(400))) for d in range(60)]
    docs = make(rows, extra=False)
    found = [substring.Windows(b, 20) for b in docs.toArrow().combine_chunks().to_batches()]
    own = sum(len(w.g1) for w in found)
    cells = int(own / load)
    task = substring.candidates(substring.build_sketch(docs, 20, cells), cells, 20)
    grouped = docs.mapInArrow(task, "h1 long, h2 long, doc_id long, start long, n long").count()
    assert grouped <= 0.1 * sum(w.size for w in found)
    assert own < 0.2 * sum(w.size for w in found)


def test_windows_in_small_pieces(spark, make, monkeypatch):
    """Short windows under a crowded sketch; gathered pieces of a few words, a sketch
    read again for each, and chunks of few cells."""
    rnd = random.Random(3)
    rows = [(d, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60)))) for d in range(40)]
    docs = make(rows, extra=False)
    got = substring.remove_repeats(docs, window=4, cells=1000)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()), key=str) == brute_windows(rows, 4)
    sketch, batches = substring.build_sketch(docs, 4, 1000), docs.toArrow().combine_chunks().to_batches()

    def heads():
        out = [b for b in substring.candidates(sketch, 1000, 4)(iter(batches))]
        return {(r["h1"], r["h2"]) for b in out for r in b.to_pylist() if not r["n"]}

    whole = heads()
    for name, value in (("SLICE_CHARS", 50), ("GATHER_CHARS", 120), ("KEPT_BYTES", 0)):
        monkeypatch.setattr(substring, name, value)
    substring._SKETCHES.clear()
    assert heads() == whole and not substring._SKETCHES


def test_sparse_lists_count_as_counters_do(monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BITS", 64)
    rnd = random.Random(5)
    hashes = [rnd.randrange(1000) for _ in range(400)]
    chunks = {}
    for lo in range(0, 400, 37):
        for b in substring.cell_lists([substring.np.array(hashes[lo : lo + 37], substring.np.uint64)], 0, 1000):
            for row in b.to_pylist():
                chunks.setdefault(row["k"], substring.Chunk()).add(row["once"], row["twice"])
    twice = {k * 64 + int(i) for k, c in chunks.items() for i in c.twice.nonzero()[0]}
    assert twice == {h for h in hashes if hashes.count(h) > 1}


def test_windows_of_an_empty_table(make):
    assert substring.remove_repeats(make([])).count() == 0


def test_op7_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.QUERIES["op7_window_dedup"](spark, SF).collect()), key=str) == brute_windows(rows)


def brute_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    rnd = random.Random(3)
    for _ in range(1500):
        p = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 90 if rnd.random() < 0.1 else 12)))
        t = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 30)))
        d = brute_distance(p, t)
        assert decontam.myers(p, t, 99) == d and decontam.myers(p, t, d - 1) is None


def edited(text, k, rnd):
    s = list(text)
    for _ in range(k):
        i = rnd.randrange(len(s))
        rnd.choice((lambda: s.__setitem__(i, "q"), lambda: s.insert(i, "z"), lambda: s.pop(i)))()
    return "".join(s)


@pytest.mark.parametrize("block_rows", [decontam.BLOCK_ROWS, 2])
def test_contamination_against_brute_force(spark, make, block_rows):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(3, 14)))) for i in range(12)]
    rows = []
    for d in range(30, 110):
        item, text = rnd.choice(items)
        rows.append((d, " ".join(word() for _ in range(5)) + " " + edited(text, rnd.randint(0, 6), rnd) + ". " + " ".join(word() for _ in range(4))))
    rows += [*ODD, (200, items[0][1].upper().replace(" ", "%%% ")), (201, items[3][1])]
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (52, "..."), (None, "one two"), (53, items[3][1])], "item_id long, text string")
    expected = set()
    for d, text in rows:
        for i, item in [*items, (53, items[3][1])]:
            p, t = decontam.normal_form(item), decontam.normal_form(text or "")
            if (e := brute_distance(p, t[:3000])) <= int(decontam.ERROR_RATE * len(p)):
                expected.add((d, i, e))
    got = decontam.contaminated(make(rows), bench, block_rows=block_rows, gather_chars=200)
    assert {tuple(r) for r in got.collect()} == expected
    clean = decontam.drop_contaminated(make(rows), bench)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - {d for d, _, _ in expected}


def test_long_items_are_tested_by_passages(spark, make):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(6)) for _ in range(600)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    part = decontam.passages(decontam.normal_form(" ".join(words)))
    assert " ".join(part) == " ".join(words) and max(map(len, part)) < 1100
    got = decontam.contaminated(make([(1, part[2]), (2, "nothing of it")]), bench).collect()
    assert [tuple(r) for r in got] == [(1, 1, 0)]


def test_contamination_of_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(make(ODD), none).count() == 0
    assert decontam.contaminated(make([]), spark.createDataFrame([(1, "some item text")], "item_id long, text string")).count() == 0


def test_op6_finds_every_exact_passage(spark):
    items = [(r["item_id"], decontam.normal_form(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], decontam.normal_form(r["text"] or "")) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    exact = {(d, i, 0) for d, t in docs for i, p in items if p in t}
    got = {tuple(r) for r in queries.QUERIES["op6_edit_decontam"](spark, SF).collect()}
    assert exact <= got
    text = dict(docs)
    for d, i, e in got:
        assert decontam.myers(dict(items)[i], text[d], e) == e
