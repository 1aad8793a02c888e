"""Source divergence, lattice near-duplicates, spelling variants."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD, make  # noqa: F401

from weft.llm import divergence, lattice, spelling

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# ---------------------------------------------------------------------------
# source divergence
# ---------------------------------------------------------------------------


def brute_audit(rows, min_docs, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        own = TERM.findall(lower(text))
        counts[lang or "", source or ""].update(own)
        docs[lang or ""].update(set(own))
    out = []
    for lang, source in list(counts):
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for g, s in counts if g == lang]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        below = 2 * len(kept)

        def share(s, t):
            return 1 + 10**9 * (counts[lang, s][t] + 2) // (total[s] + below)

        def whole(t):
            return 1 + 10**9 * (sum(counts[lang, s][t] for s in sources) + 2) // (sum(total.values()) + below)

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        pair = [(sum(f(share(source, t), share(s, t)) for t in kept), s) for s in sources if s != source]
        term = [(f(share(source, t), whole(t)), t) for t in kept if counts[lang, source][t] and share(source, t) > whole(t)]
        for part, found, limit in (("pair", pair, None), ("term", term, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, r + 1) for r, (value, item) in enumerate(found[:limit])]
    return sorted(out)


def audit_rows(spark, rows, min_docs, top):
    df = spark.createDataFrame([(i, t, a, b, 7, "x") for i, (t, a, b) in enumerate(rows)], "doc_id long, text string, lang string, source string, n long, term string")
    return sorted(tuple(r) for r in divergence.audit(df, min_docs, top).collect())


def test_audit_against_brute_force(spark):
    rnd = random.Random(3)
    words = ["Alpha", "beta", "Straße", "ÀÉ", "日本", "x", "don't", "a1b", "tie", "eit", "\U0001f600"]
    rows = [(" ".join(rnd.choices(words, k=rnd.randrange(0, 30))), rnd.choice(["en", "de", None, ""]), rnd.choice(["s1", "s2", "é", None, "s\x00"])) for _ in range(300)]
    rows += [(None, "zz", "only"), ("", "yy", "a"), ("12 34", "yy", "b"), ("word " * 40_000, "en", "s1"), ("q" * 50_000, "en", "s2")] + [("same text", "en", "s1")] * 15
    assert audit_rows(spark, rows, 10, 3) == brute_audit(rows, 10, 3)
    # partial counts that leave their task early
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = divergence.partial_counts(df, held_rows=5).where("term <> ''").groupBy("lang", "source", "term").sum("n").collect()
    counts = defaultdict(Counter)
    for text, lang, source in rows:
        counts[lang or "", source or ""].update(TERM.findall(lower(text)))
    assert {(r[0], r[1], r[2]): r[3] for r in got} == {(*g, t): n for g, c in counts.items() for t, n in c.items()}


def test_shares_of_huge_counts():
    n = 9 * 10**14
    got = divergence.shares(np.array([5, n]), n, 4).tolist()
    assert got == [1 + 10**9 * 7 // (n + 8), 1 + 10**9 * (n + 2) // (n + 8)]


def test_blocks_and_pair_sums_of_any_size():
    """One language: blocks of one term and unsummed pairs give what one block gives."""
    rnd = np.random.default_rng(5)
    sources, terms = pa.array([f"s{i}" for i in range(7)]), pa.array([f"t{i:02d}" for i in range(40)])
    counts = rnd.integers(0, 4, (40, 7))
    counts[:, 0] += 1
    held = pa.array([[f"s{j}" for j in range(7) if c[j]] for c in counts.tolist()])
    ns = pa.array([[x for x in c if x] for c in counts.tolist()])

    def run(rows, summed):
        language = divergence._Language("en", sources, counts.sum(axis=0), 40, 3)
        language.sums = np.zeros((7, 7), np.int64) if summed else None
        language.rows = rows
        part = pa.RecordBatch.from_arrays([terms, held, ns], names=["term", "sources", "counts"])
        out = [*language.add(part.slice(0, 13)), *language.add(part.slice(13)), *language.end()]
        pairs, best = Counter(), defaultdict(list)
        for b in out:
            for r in b.to_pylist():
                if r["part"] == "pair":
                    pairs[r["source"], r["item"]] += r["value"]
                else:
                    best[r["source"]].append((-r["value"], r["item"]))
        return pairs, {s: sorted(v)[:3] for s, v in best.items()}

    assert run(40, True) == run(40, False) == run(1, True) == run(7, False)


def test_audit_of_empty_table(spark):
    assert audit_rows(spark, [], 10, 10) == []


# ---------------------------------------------------------------------------
# lattice near-duplicates
# ---------------------------------------------------------------------------


def test_nearest_lattice_point():
    """No point at a shortest vector's distance is nearer, and decoded points are lattice points."""
    y = np.random.default_rng(1).normal(size=(500, 8)) * 3
    p = lattice.nearest_e8(y)
    roots = lattice.shortest_vectors()
    assert len(roots) == 240 and np.allclose((roots**2).sum(axis=1), 2)
    twice = 2 * p
    assert np.allclose(twice, np.rint(twice)) and ((np.rint(twice) % 2).min(axis=1) == (np.rint(twice) % 2).max(axis=1)).all()
    assert (np.rint(p.sum(axis=1)) % 2 == 0).all()
    own = ((y - p) ** 2).sum(axis=1)
    assert (own[:, None] <= ((y[:, None, :] - p[:, None, :] - roots[None]) ** 2).sum(axis=2) + 1e-9).all()
    assert own.max() <= 1 + 1e-9  # the covering radius


@pytest.mark.parametrize("n", [5_000, 10_000_000])
def test_near_vectors_share_a_cell(n):
    """Recall at a cosine of exactly 0.98, with two and with three parts."""
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rnd.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * z
    hashing = lattice.Hashing(n)
    met, strange = np.zeros(len(x), bool), 0
    for t in range(hashing.tables):
        a, b = hashing.cells(x, t), hashing.cells(y, t)
        met |= (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
        strange += (a[:, :, None] == np.roll(b, 1, axis=0)[:, None, :]).any(axis=(1, 2)).sum()
    assert met.mean() > 0.997
    assert strange / len(x) * n / hashing.tables < 20 * lattice.STRANGERS * n / len(x)


def brute_links(rows, threshold=0.98):
    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64)
        v = v / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    units = [unit(v) for _, v, _ in rows]
    usable = [i is not None and l is not None and u is not None for (i, _, l), u in zip(rows, units)]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and float((units[i] * units[j]).sum()) >= threshold:
                n[i] += 1
                n[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[root(i)] = min(vec_id, least.get(root(i), vec_id))
    return sorted(((r[0], n[i], least.get(root(i)), r[0] is not None and least[root(i)] == r[0]) for i, r in enumerate(rows)), key=str)


def lattice_rows(spark, rows, **options):
    df = spark.createDataFrame([(i, v, l, 1, 2, 3) for i, v, l in rows], "vec_id long, embedding array<float>, label int, node long, cell long, copies long")
    return sorted((tuple(r) for r in lattice.near_duplicates(df, **options).collect()), key=str)


def clusters(seed, groups, size, spread=0.02, dim=64):
    rnd = np.random.default_rng(seed)
    rows, i = [], 0
    for g in range(groups):
        centre = rnd.normal(size=dim) / np.sqrt(dim)
        for _ in range(size):
            rows.append((i, [float(np.float32(x)) for x in centre + rnd.normal(size=dim) * spread], g % 3))
            i += 7
    return rows


def test_links_against_brute_force(spark):
    nan, inf = float("nan"), float("inf")
    rows = clusters(1, 12, 14) + clusters(2, 60, 1, 0.2)
    base = rows[0][1]
    rows += [(9000 + i, base, 0) for i in range(40)] + [(9100, base, 1), (9101, base, None), (None, base, 0)]
    rows += [(9200, None, 0), (9201, [0.0] * 64, 0), (9202, [nan] * 64, 0), (9203, [inf] + [0.0] * 63, 0), (9204, [], 0), (9205, [None] + base[1:], 0)]
    rows += [(9300, [1.0, 2.0], 0), (9301, [2.0, 4.0], 0), (9302, [-1.0, -2.0], 0), (9303, [1e-40, 2e-40], 0), (9304, [1e38, 2e38], 0)]
    rows += [(3, base, 2), (3, base, 2), (9301, [5.0, 1.0], 0)]
    assert lattice_rows(spark, rows) == brute_links(rows)


def test_crowded_cells_and_components_in_chunks(spark):
    """Chunks of a few members: every cell and component is dealt as pairs of chunks."""
    rows = clusters(3, 2, 60, 0.012) + clusters(4, 1, 50, 0.016)
    assert lattice_rows(spark, rows, chunk=5) == brute_links(rows)


def test_no_vectors(spark):
    assert lattice_rows(spark, []) == []
    assert lattice_rows(spark, [(1, None, 1)]) == [(1, 0, 1, True)]


# ---------------------------------------------------------------------------
# spelling variants
# ---------------------------------------------------------------------------


def distance_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, min_length, min_count, ratio=5, drop_every=199):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}
    out, forms = [], {}
    for w in n:
        near = [v for v in n if distance_one(w, v)]
        best = min(near, key=lambda v: (-n[v], v)) if near else None
        if best is not None and n[best] >= ratio * n[w]:
            forms[w] = best
        out.append((w, n[w], len(near)))
    rows = []
    for w, c, near in out:
        root = w
        while root in forms:
            root = forms[root]
        rows.append((w, c, near, forms.get(w), n[forms[w]] if w in forms else None, root))
    return sorted(rows)


def variant_rows(make, rows, *options):
    return sorted(tuple(r) for r in spelling.group_variants(make(rows), *options).collect())


def random_texts(seed, n):
    rnd = random.Random(seed)
    letters = "abeilnorstuzÀàéßÿ×"
    stems = ["".join(rnd.choices(letters, k=rnd.randrange(3, 9))) for _ in range(30)]

    def word():
        w = rnd.choice(stems)
        for _ in range(rnd.choice((0, 0, 0, 1, 1, 2))):
            i = rnd.randrange(len(w) + 1)
            w = rnd.choice((w[:i] + rnd.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rnd.choice(letters) + w[i + 1 :]))
        return rnd.choice((w, w, w.upper()))

    return [(i, rnd.choice((" ", ", ", "1", "\n")).join(word() for _ in range(rnd.randrange(60)))) for i in range(n)]


def test_variants_against_brute_force(make):
    rows = random_texts(1, 120) + ODD + [(500, "längstes " * 30 + "langstes " * 3), (501, "y" * 30_000)]
    expected = brute_variants(rows, 3, 2, drop_every=5)
    assert sum(r[3] is not None for r in expected) > 20 and max(r[2] for r in expected) > 3
    assert variant_rows(make, rows, 3, 2, 5, 5) == expected
    assert variant_rows(make, rows) == brute_variants(rows, 6, 5)


@pytest.mark.parametrize("top,visitors", [(6, 2), (1, 100), (12, 7)])
def test_pairs_with_any_number_of_shuffled_levels(spark, top, visitors):
    words = sorted({w for _, t in random_texts(2, 60) for w in lower(t).split() if w.isalpha()})
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = sorted(tuple(sorted((r["a"], r["b"]))) for r in spelling.near_pairs(df, top=top, visitors=visitors).collect())
    assert got == sorted((a, b) for i, a in enumerate(words) for b in words[i + 1 :] if distance_one(a, b))


def test_chain_of_forms(spark):
    df = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("v", "w3")], "word string, form string")
    assert {r["word"]: r["root"] for r in spelling.follow(df).collect()} == {**{f"w{i}": "w9" for i in range(9)}, "v": "w9"}


def test_no_words(make):
    assert variant_rows(make, []) == []
    assert variant_rows(make, [(1, None), (2, "ab cd")]) == []
