"""Near duplicates, repeated strings and near vectors against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def groups(keys, linked):
    root = {k: k for k in keys}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def near_brute(texts, width, least=80):
    sets = {k: shingles(t, width) for k, t in texts.items()}
    keys = [k for k in sets if sets[k]]
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]
             if 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])]
    return sets, groups(texts, links)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_on_edges(edge_docs, no_docs, width):
    from shopcube.llm.minhash import near_duplicates
    rows = edge_docs.collect()
    sets, root = near_brute({r.doc_id: r.text for r in rows if r.doc_id is not None}, width)
    got = near_duplicates(edge_docs, width).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)
    assert near_duplicates(no_docs, width).count() == 0


@pytest.mark.parametrize("block", [256, 7])
def test_near_duplicates_in_groups_with_unlinked_members(spark, monkeypatch, block):
    """Copies with a growing share of changed words: many pairs just above and just below the threshold."""
    from shopcube.llm import minhash
    monkeypatch.setattr(minhash, "BLOCK", block)
    r, texts = random.Random(3), {}
    for g in range(3):
        base = sentence(100 + g, 80).split()
        for i in range(40):
            w = list(base)
            for _ in range(r.randrange(9)):
                w[r.randrange(len(w))] = f"new{r.randrange(10 ** 6)}"
            texts[1000 * g + i] = " ".join(w)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets, root = near_brute(texts, 2)
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs, 2).collect()}
    assert got == root
    assert 3 < len(set(root.values())) < len(texts)


def test_near_duplicates_on_documents(spark):
    from shopcube.llm.registry import QUERIES
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    sets, root = near_brute(texts, 2)
    for r in QUERIES["op8_minhash_dedup"](spark, SF001).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)


def test_near_duplicates_of_one_id_with_other_texts(spark):
    """Rows of one id with different texts are documents of their own, in the operator and in the stage."""
    import corpus_pipeline
    from shopcube.llm.minhash import near_duplicates
    a, b, c = (sentence(i, 120) for i in (31, 32, 33))
    rows = [(1, a), (1, b), (2, a + " word"), (3, b + " word"), (4, c), (4, c), (4, c + " more"), (5, c + " x"), (6, ""), (6, ""), (6, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs, 5).collect())
    assert got == Counter([(1, 1, True)] * 2 + [(2, 1, False), (3, 1, False), (5, 4, False)] + [(4, 4, True)] * 3 + [(6, 6, True)] * 3)
    left = Counter(tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect())
    four = [k for k in left if k[0] == 4]
    assert len(four) == 1 and left[four[0]] == 1 and four[0][1] in (c, c + " more")
    del left[four[0]]
    assert left == Counter([(1, a), (1, b), (6, ""), (6, " ")])


def test_sketches_estimate_similarity():
    from shopcube.llm.shingles import sketch
    rng = np.random.default_rng(4)
    for n in (1, 3, 50, 2000):
        both = rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64)
        sets = np.concatenate([both[:2 * n], both[n:]])
        s = sketch(sets, np.array([0, 2 * n, 4 * n]), 160)
        assert (s != np.uint64(2 ** 64 - 1)).all()          # every coordinate fills
        assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.2
        again = sketch(sets[:2 * n], np.array([0, 2 * n]), 160)
        assert (again[0] == s[0]).all()                     # whatever else is in the batch


def test_components_of_paths_and_stars(spark):
    from shopcube.llm.components import components
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 240)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(200, 240)}, 7: 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats_brute(rows):
    raw = [(r.doc_id, (r.text or "").encode()) for r in rows]
    seen = Counter(t[i:i + 200] for _, t in raw for i in range(len(t) - 199))
    out = Counter()
    for k, t in raw:
        gone, last = bytearray(len(t)), 0
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[max(i, last):i + 200] = b"\1" * (i + 200 - max(i, last))
                last = i + 200
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i in range(len(t)) if gone[i] and (not i or not gone[i - 1]))
        out[k, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("large", [512, 0])
def test_repeats_on_edges(edge_docs, no_docs, monkeypatch, large):
    from shopcube.llm import repeats
    monkeypatch.setattr(repeats, "FIT", large)
    docs = edge_docs.where("doc_id IS NULL OR doc_id <> 8")
    got = repeats.remove_repeats(docs, texts=False)
    assert Counter(map(tuple, got.collect())) == repeats_brute(docs.collect())
    assert repeats.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("large", [512, 2, 0])
def test_repeats_of_random_passages(spark, monkeypatch, large):
    """Passages that overlap, repeat inside a text, and are shared by many texts with other surroundings."""
    from shopcube.llm import repeats
    monkeypatch.setattr(repeats, "FIT", large)
    r = random.Random(9)
    passages = [sentence(300 + i, r.randrange(20, 120)) for i in range(12)] + ["é中" * 70, "xyz" * 90]
    rows = []
    for k in range(120):
        parts = [sentence(1000 * k + j, r.randrange(1, 30)) for j in range(r.randrange(1, 4))]
        for _ in range(r.randrange(3)):
            p = r.choice(passages)
            a = r.randrange(len(p) // 2)
            parts.insert(r.randrange(len(parts) + 1), p[a:a + r.randrange(100, 700)])
        rows.append((k, " ".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.remove_repeats(docs)
    assert Counter(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())) == \
        repeats_brute(docs.collect())
    for x in got.collect():
        raw = dict(rows)[x.doc_id].encode()
        left, at = b"", 0
        for s in x.spans:
            left, at = left + raw[at:s.start], s.end
        assert bytes(x.kept) == left + raw[at:] and x.kept_text == bytes(x.kept).decode("utf-8", "ignore")


def test_repeats_of_one_line_in_most_texts(spark, monkeypatch):
    """A line and a passage that most texts hold: no step makes more than two rows of a block."""
    from shopcube.llm import repeats
    monkeypatch.setattr(repeats, "FIT", 16)
    made = []
    halves = repeats.halves
    monkeypatch.setattr(repeats, "halves",
                        lambda live, size: made.append((live.count(), halves(live, size).count())) or halves(live, size))
    r = random.Random(2)
    line, passage = sentence(1, 16)[:120], sentence(2, 60)
    rows = [(k % 90, f"{sentence(50 + k, 30)} {line} {sentence(500 + k, 9)} {passage if k % 3 else ''} {sentence(900 + k, 30)}"
             + (f"{passage[r.randrange(80):]}" if k % 5 == 0 else "")) for k in range(100)] + [(None, passage), (None, line * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeats.remove_repeats(docs, texts=False)
    assert Counter(map(tuple, got.collect())) == repeats_brute(docs.collect())
    assert made and all(out <= 2 * n for n, out in made)


def test_repeats_in_texts_of_many_pieces(spark, monkeypatch):
    """A passage across the border of two pieces, and a text of 2.7 MB that holds another text's passage."""
    from shopcube.llm import repeats
    passage = sentence(77, 120)
    long_ = sentence(5, 400000)
    at = repeats.PIECE - 300
    texts = [long_[:at] + passage + long_[at:], "short " + passage + " text", long_[5000:5400]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in repeats.remove_repeats(docs, texts=False).collect()}
    n = len(passage)
    assert len(texts[0]) > 2.5e6 and got[0].n_spans == 2 and n + 400 <= got[0].n_removed <= n + 404
    assert (got[2].n_removed, got[2].n_spans) == (400, 1) and n <= got[1].n_removed <= n + 2
    monkeypatch.setattr(repeats, "PIECE", 700)
    docs = docs.where("doc_id > 0")
    assert Counter(map(tuple, repeats.remove_repeats(docs, texts=False).collect())) == repeats_brute(docs.collect())


@pytest.mark.parametrize("seed", range(3))
def test_bucket_pointer_refinement(seed):
    from shopcube.llm.repeats import refine
    r = random.Random(seed)
    base = bytes(r.choices(b"ab", k=400))
    rows = [base[a:a + r.randrange(200, 330)] for a in (r.randrange(70) for _ in range(30))] + [bytes(r.choices(b"ab", k=250)) for _ in range(5)]
    once = np.array([r.random() < .7 for _ in rows])
    at = np.cumsum([0, *map(len, rows)])
    n = np.array([len(x) - 199 for x in rows])
    seen = Counter(x[i:i + 200] for x in rows for i in range(len(x) - 199))
    got = refine(np.frombuffer(b"".join(rows), np.uint8), at, n, once)
    assert sorted(zip(got[0].tolist(), got[1].tolist())) == [
        (k, i) for k, x in enumerate(rows) if once[k] for i in range(len(x) - 199) if seen[x[i:i + 200]] > 1]


def vectors_brute(rows):
    ok, out = [], {}
    for i, r in enumerate(rows):
        v = r.embedding
        if v and r.label is not None and r.vec_id is not None and all(e is not None and np.isfinite(e) for e in v) and any(v):
            ok.append((i, r, np.array(v, float)))
    links, pairs = Counter(), []
    for n, (i, a, x) in enumerate(ok):
        for j, b, y in ok[n + 1:]:
            if a.label == b.label and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[i] += 1
                links[j] += 1
                pairs.append((a.vec_id, b.vec_id))
    root = groups([r.vec_id for r in rows if r.vec_id is not None], pairs)
    return Counter((r.vec_id, links[i], root.get(r.vec_id), r.vec_id is None or root[r.vec_id] == r.vec_id)
                   for i, r in enumerate(rows))


@pytest.mark.parametrize("chunk", [1024, 5])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors(spark, monkeypatch, chunk, kind):
    from shopcube.llm import embed_dedup
    from shopcube.llm.ship import ship_package
    ship_package(spark)
    monkeypatch.setattr(embed_dedup, "CHUNK", chunk)
    rng = np.random.default_rng(8)
    rows = []
    for g in range(8):
        base = rng.standard_normal(16)
        for i in range(12):
            rows.append((100 * g + i, [float(np.float32(e)) for e in base + rng.standard_normal(16) * 0.03 * i], g % 3, "x"))
    rows += [(900, rows[0][1], 0, "copy"), (901, rows[0][1], 1, "other label"), (902, [2 * e for e in rows[0][1]], 0, "scaled"),
             (903, None, 0, ""), (904, [0.0] * 16, 0, ""), (905, [None] + rows[0][1][1:], 0, ""), (906, [], 0, ""),
             (907, [float("nan")] + rows[0][1][1:], 0, ""), (908, [float("inf")] + rows[0][1][1:], 0, ""),
             (909, rows[0][1], None, ""), (None, rows[0][1], 0, ""), (910, rows[0][1][:8], 0, "shorter"), rows[5]]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, id string")
    got = Counter(map(tuple, embed_dedup.near_vectors(table).collect()))
    assert got == vectors_brute(table.collect())
    assert embed_dedup.near_vectors(table.where("false")).count() == 0


def test_tables_keep_the_recall():
    import math
    from shopcube.llm.embed_dedup import MISSED, tables_for
    for n in (0, 1, 500, 50_000, 10 ** 9):
        bits, tables = tables_for(n)
        assert (1 - (1 - math.acos(0.93) / math.pi) ** bits) ** tables <= MISSED * 1.0001
