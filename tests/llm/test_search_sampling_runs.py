"""Exact search, resampling and periodic runs against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF001

# ---- exact top-k ------------------------------------------------------------------------------------------


def brute_top_k(rows, k=5, step=50):
    """rows: (id, vector); equal rows count once."""
    known = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            c = tuple(math.floor(256 * x) for x in v)
            if sum(x * x for x in c) < 2 ** 62:
                known[(i, c)] = None
    out = []
    for i, c in known:
        if i % step == 0:
            others = sorted((-sum(a * b for a, b in zip(c, w)), j) for j, w in known if len(w) == len(c) and (j, w) != (i, c))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(others[:k])]
    return sorted(out)


def vector_rows(seed, n, dim=6):
    r = random.Random(seed)
    pool = [[r.gauss(0, .3) for _ in range(dim)] for _ in range(n // 3)]
    rows = []
    for i in range(n):
        kind = r.random()
        v = list(r.choice(pool)) if kind < .4 else [r.gauss(0, .3) for _ in range(dim)]
        if kind < .2:
            v = list(pool[0])                                     # a fifth of all rows are one vector
        rows.append((i, v))
    near = [x + 1e-3 for x in pool[0]]
    rows += [(n + i, [x + r.gauss(0, 1e-3) for x in near]) for i in range(n // 4)]      # bounds do not tell these apart
    return rows


def test_top_k_of_ties_copies_and_dirty_vectors(spark, monkeypatch):
    from shopcube.llm import topk
    from shopcube.llm.ship import ship_package
    ship_package(spark)
    rows = vector_rows(3, 900)
    rows += [(50, [.1] * 6), (100, rows[100][1]), (2000, None), (2050, []), (2100, [.1, None, .2, .3, .4, .5]),
             (2150, [float("nan")] * 6), (2200, [float("inf")] * 6), (None, [.1] * 6), (2250, [0.0] * 6), (2300, [1e30] * 6),
             (2350, [.5, .5]), (2351, [.25, -.5]), (2400, [1.0, 2.0, 3.0]), (2450, [3e6] * 6), (2451, [-7e5] * 6)]
    df = spark.createDataFrame([(i, v, "x", 1.0, i) for i, v in rows],
                               "vec_id long, embedding array<double>, cells string, least double, c long").repartition(5)
    want = brute_top_k(rows)
    assert sorted(map(tuple, topk.top_k(df).collect())) == want
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)                   # many blocks on both sides
    monkeypatch.setattr(topk, "CELL_BLOCK", 100)
    assert sorted(map(tuple, topk.top_k(df).collect())) == want
    assert topk.top_k(df.where("false")).count() == 0


def test_top_k_on_the_table(spark):
    from shopcube.llm.registry import QUERIES
    e = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    got = sorted(map(tuple, QUERIES["op11_exact_topk"](spark, SF001).collect()))
    assert got == brute_top_k([(r.vec_id, r.embedding) for r in e])


def test_cells_hold_their_numbers():
    from shopcube.llm.topk import HALF, MIDDLE, Bounds, cells_of
    x = np.concatenate([np.arange(-3000, 3000), np.random.default_rng(1).integers(-2 ** 31 + 1, 2 ** 31, 5000)])
    c = cells_of(x)
    assert (np.abs(MIDDLE[c] - x) <= HALF[c]).all() and (HALF[cells_of(np.arange(-7, 8))] == 0).all()
    q, v = x[:64].reshape(4, 16), np.random.default_rng(2).permutation(x)[:1600].reshape(100, 16)
    low, high = Bounds(q).of(cells_of(v))
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(i, j)) for j in v] for i in q], float)
    assert (low <= exact).all() and (exact <= high).all()


# ---- resampling -------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(t):
    w = WORD.findall((t or "").translate(LOWER))
    return w, [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]


def bucket(f):
    return zlib.crc32(f.encode()) % 10000


def brute_resample(docs, target):
    """docs: (id, text) rows; -> rows (id, n_features, weight, score, rank), ranks of equal rows in any order."""
    made = [(k, *features(t)) for k, t in docs]
    source, wanted = Counter(), Counter()
    for _, _, f in made:
        source.update(map(bucket, f))
    for t in target:
        wanted.update(map(bucket, features(t)[1]))
    s, t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[i] + 1) * (s + 10000) / ((source[i] + 1) * (t + 10000)))) for i in range(10000)]
    rows = []
    for k, w, f in made:
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append([k, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))), None, len(w)])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], 2 ** 63 if r[0] is None else r[0]))
    for i, r in enumerate(able[:25 * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_resample_on_edges(spark, edge_docs, no_docs):
    from shopcube.llm.resample import resample
    more = spark.createDataFrame([(100 + i, " ".join(random.Random(i).choices("ab cd éf Zz 9x ß mn".split(), k=15 + i % 30)))
                                  for i in range(400)], "doc_id long, text string")
    docs = edge_docs.unionByName(more, allowMissingColumns=True)
    target = ["ab cd Zz", None, "", "x" * 200 + " 9x " + "y" * 70, "mn mn"]
    bench = spark.createDataFrame([(i, t, 0) for i, t in enumerate(target)], "item_id long, text string, weight long")
    cols = ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted((tuple(r) for r in resample(docs, bench).select(cols).collect()), key=str)
    assert got == brute_resample([(r.doc_id, r.text) for r in docs.collect()], target)
    alone = sorted((tuple(r) for r in resample(docs, bench.where("false")).select(cols).collect()), key=str)
    assert alone == brute_resample([(r.doc_id, r.text) for r in docs.collect()], [])
    assert resample(no_docs, bench).count() == 0


def test_resample_on_the_tables(spark):
    from shopcube.llm.registry import QUERIES
    got = sorted((tuple(r) for r in QUERIES["op12_target_resampling"](spark, SF001).collect()), key=str)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet").collect()
    assert got == brute_resample([(r.doc_id, r.text) for r in docs], [r.text for r in bench])


def test_crc_of_pairs_equals_zlib():
    from shopcube.llm.feature_hash import Features
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("aB9é中", k=r.choice([1, 2, 5, 40, 63, 64, 65, 300]))) for _ in range(r.randrange(12)))
             for _ in range(200)]
    f = Features(pa.array([None, "", *texts, "--", "é"]))
    want = [x for t in [None, "", *texts, "--", "é"] for x in features(t)[0]]
    assert f.crc.tolist() == [zlib.crc32(w.encode()) for w in want]
    pairs = [x for t in texts for x in features(t)[1][len(features(t)[0]):]]
    assert f.pair[f.paired].tolist() == [zlib.crc32(p.encode()) for p in pairs]


@pytest.mark.parametrize("limit", [0, 1, 777, 5000, 9000])
def test_ranks_by_regular_sampling(spark, monkeypatch, limit):
    from shopcube.llm import sample_sort
    from shopcube.llm.ship import ship_package
    ship_package(spark)
    monkeypatch.setattr(sample_sort, "SEGMENT", 300)              # many segments, a third of the rows in one tie
    r = random.Random(1)
    rows = [(7 if r.random() < .35 else r.randrange(10 ** 6), r.randrange(500), i, str(i)) for i in range(5000)]
    df = spark.createDataFrame(rows, "a long, b long, row long, rest string").repartition(7)
    got = {x.row: (x["rank"], x.rest) for x in sample_sort.ranked(df, ["a", "b", "row"], limit).collect()}
    for i, x in enumerate(sorted(rows)):
        assert got[x[2]] == (i + 1 if i < limit else None, x[3])


# ---- periodic runs ----------------------------------------------------------------------------------------

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def planted(words, key):
    n = len(words)
    h = zlib.crc32(str(key).encode())
    g = h // 10
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_digests(key, text):
    w = planted(BLANK.findall(text or ""), key)
    runs = brute_runs(w)
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (key, len(runs), *best, runs and 1000 * best[1] // best[2] or None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def repeated_text(r):
    letters, words, n = "abcde"[:r.choice([1, 2, 2, 3, 5])], [], r.randrange(0, 150)
    while len(words) < n:
        period = r.choices(letters, k=r.randrange(1, 14))
        words += (period * r.randrange(2, 9))[:r.randrange(1, 90)] if r.random() < .6 else period[:7]
    return r.choice([" ", "\n", " \t"]).join(words)


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    from shopcube.llm.runs import runs_of_texts
    r = random.Random(seed)
    for _ in range(40):
        texts = [None if r.random() < .05 else repeated_text(r) for _ in range(r.randrange(1, 20))]
        got = runs_of_texts(pa.array(texts, pa.string()), None)
        for t, runs in zip(texts, got["runs"].to_pylist()):
            assert [(x["start"], x["length"], x["period"]) for x in runs] == brute_runs(BLANK.findall(t or ""))


def test_run_digests_on_edges(spark, edge_docs, no_docs):
    from shopcube.llm.runs import periodic_runs, run_digests
    r = random.Random(9)
    more = spark.createDataFrame([(100 + i, repeated_text(r)) for i in range(300)], "doc_id long, text string")
    long_ = spark.createDataFrame([(1, "x y z " * 30000 + "q " * 9 + "a b " * 40000)], "doc_id long, text string")
    docs = edge_docs.unionByName(more, allowMissingColumns=True)
    short = docs.where("length(text) < 50000 OR text IS NULL")
    got = sorted((tuple(x) for x in run_digests(periodic_runs(short, planted=True)).collect()), key=str)
    assert got == sorted((brute_digests(x.doc_id, x.text) for x in short.collect()), key=str)
    assert periodic_runs(docs).count() == docs.count()
    runs = periodic_runs(long_).collect()[0]
    assert [(x.start, x.length, x.period) for x in runs.runs] == [(0, 90000, 3), (90000, 9, 1), (90009, 80000, 2)]
    assert runs.collapsed == "x y z q a b"
    assert run_digests(periodic_runs(no_docs)).count() == 0


def test_wavelet_matrix_against_lists():
    from shopcube.llm.wavelet import WaveletMatrix
    rng = np.random.default_rng(3)
    for n in (1, 2, 63, 64, 65, 1000):
        v = rng.integers(0, max(2, n // 2), n)
        left = rng.integers(0, n, 300)
        right = left + rng.integers(0, n - left + 1)
        x = rng.integers(0, n + 2, 300)
        got = WaveletMatrix(v).successor(left, right, x)
        assert got.tolist() == [min((y for y in v[a:b].tolist() if y >= c), default=-1) for a, b, c in zip(left, right, x.tolist())]
