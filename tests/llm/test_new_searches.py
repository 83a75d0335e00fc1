"""Nearest neighbours, spelling variants and periodic runs against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobmart.llm import nearest, periodic, variants
from jobmart.llm.queries import QUERIES
from jobmart.llm.words import words_of
from tests.llm.samples import documents, frame, lower, prose, words

# --- nearest neighbours ---------------------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_nearest(rows, k, every=20):
    rows = list({(i, tuple(np.float32(x) for x in v)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = set()
    for i, v in rows:
        if i % every == 0:
            near = sorted((-sum(float(a) * float(b) for a, b in zip(v, w)), j) for j, w in rows if j != i)[:k]
            out |= {(i, r + 1, j, round(-s, 9)) for r, (s, j) in enumerate(near)}
    return out


def clustered(rng, n, d=16, groups=12):
    centres = rng.normal(size=(groups, d))
    return (centres[rng.integers(0, groups, n)] + 0.2 * rng.normal(size=(n, d))).astype(np.float32)


def test_small_tables_are_searched_exactly(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist(), None) for i, v in enumerate(clustered(rng, 300, 5))]
    rows += [(400 + i, rows[7][1], 1) for i in range(45)]  # equal vectors: more than a result has
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 5, 1), (520, [float("nan")] + [1.0] * 4, 1), (540, [None] + [1.0] * 4, 1),
             (560, [float("inf")] + [1.0] * 4, 1), rows[20], rows[20], (None, rows[3][1], 1), (-20, [-0.0, 1.0, 0.0, 0.0, 0.0], 2)]
    got = nearest.search(vectors(spark, rows).repartition(6).withColumns({c: F.lit(1) for c in ("entry", "cell", "vector", "id", "asks")}), F.col("vec_id") % 20 == 0)
    assert {(r[0], r[1], r[2], round(r[3], 9)) for r in got.collect()} == brute_nearest(rows, 20)
    assert got.count() == len(brute_nearest(rows, 20))


def test_vectors_of_another_length_take_no_part(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 0.5], 1), (2, [1.0], 1), (3, [0.1, 0.2], 1)]
    got = nearest.search(vectors(spark, rows), F.col("vec_id") % 20 == 0)
    assert [r[:3] for r in map(tuple, got.orderBy("rank").collect())] == [(0, 1, 1), (0, 2, 3)]


@pytest.mark.parametrize("rows", [[], [(0, None, 1)], [(7, [1.0], 1), (9, [2.0], 1)], [(0, [1.0], 1)]])
def test_no_queries_or_candidates(spark, rows):
    got = nearest.search(vectors(spark, rows), F.col("vec_id") % 20 == 0)
    assert got.collect() == [] and got.columns == ["query_id", "rank", "vec_id", "score"]


def test_recall_of_the_index(spark):
    rng = np.random.default_rng(5)
    data = np.concatenate((clustered(rng, 2500), rng.normal(size=(1000, 16)).astype(np.float32), np.float32(3) + 1e-3 * rng.normal(size=(1500, 16)).astype(np.float32)))
    rows = [(i, v.tolist(), None) for i, v in enumerate(data)]
    got = nearest.search(vectors(spark, rows).repartition(6), F.col("vec_id") % 20 == 0, first=200).toPandas()
    exact = data.astype(np.float64) @ data.astype(np.float64).T
    hits = 0
    for q, own in got.groupby("query_id"):
        assert sorted(own["rank"]) == list(range(1, 21)) and q not in set(own.vec_id)
        scores = exact[q].copy()
        scores[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(len(data)), -scores))[:20].tolist()) & set(own.vec_id))
        assert np.allclose(own.score, exact[q][own.vec_id], rtol=0, atol=1e-9)
    assert set(got.query_id) == set(range(0, len(data), 20))
    assert hits / len(got) >= 0.9


def test_cells_come_in_falling_order():
    rng = np.random.default_rng(6)
    left, right, counts = rng.normal(size=7), rng.normal(size=5), rng.integers(0, 3, 35)
    sums = (left[:, None] + right[None, :]).ravel()
    want = [c for c in np.argsort(-sums, kind="stable").tolist() if counts[c]]
    assert nearest.best_cells(left, right, counts, 10**9) == want
    some = nearest.best_cells(left, right, counts, 9)
    assert some == want[:len(some)] and counts[some[:-1]].sum() < 9 <= counts[some].sum()


# --- spelling variants ----------------------------------------------------------------------------------------------


def brute_words(rows, drop, shortest=5, fewest=3):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= fewest}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_forms(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def letters(seed, n):
    """Texts of few letters, so that many words are near each other."""
    rng = random.Random(seed)
    def word():
        return "".join(rng.choice("abÀéÿB") for _ in range(rng.randrange(3, 8)))
    rows = [(i, " ".join(word() for _ in range(120)) + "-", None, None, None) for i in range(n)]
    chains = " ".join(" ".join([c * 5] * 13 + [c * 5 + "b"] * 6 + [c * 5 + "bb"] * 3) for c in "klmnopqrstuvw")
    return [*rows, rows[0], (n + 3, chains, None, None, None), (None, rows[1][1], None, None, None), (n, None, None, None, None), (n + 1, "", None, None, None),
            (n + 2, "aaaaa aaaaaa aaaaa aaaaaaa aaaaa aaaaaa aaaaaa aaaaaaa aaaaaaa " + ("x" * 3000 + " ") * 3 + ("x" * 2999 + "× ") * 7, None, None, None)]


@pytest.mark.parametrize("drop", [None, 7])
def test_vocabulary(spark, drop):
    rows = letters(1, 12) + documents()
    got = variants.vocabulary(frame(spark, rows, clashes=True), drop=drop, shortest=2)
    assert {r[0]: r[1] for r in got.collect()} == brute_words(rows, drop, shortest=2) and got.count() == len(brute_words(rows, drop, shortest=2))


@pytest.mark.parametrize("ranges", [1, 64])
def test_forms(spark, ranges, monkeypatch):
    monkeypatch.setattr(variants, "LEAST_RANGES", ranges)
    rows = letters(2, 16)
    got = variants.forms(variants.vocabulary(frame(spark, rows), drop=7)).collect()
    want = brute_forms(brute_words(rows, 7))
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(w[5] for w in want) and any(w[1] and w[1] != w[2] for w in want)


def test_forms_of_nothing(spark):
    assert variants.forms(spark.createDataFrame([], "word string, n long")).collect() == []
    assert [tuple(r) for r in variants.forms(spark.createDataFrame([("", 3), ("a", 7)], "word string, n long")).orderBy("word").collect()] == [
        ("", "a", "a", 3, 1, 7), ("a", None, "a", 7, 1, None)]


def test_trie_numbers_are_the_same_for_the_same_beginning(spark, monkeypatch):
    monkeypatch.setattr(variants, "RANGE_WORDS", 20)
    rng = random.Random(9)
    own = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(400)})
    df = spark.createDataFrame(list(enumerate(own)), "id long, word string").repartition(7)
    number = {}
    for i, path in variants.trie_paths(df, len(own)).collect():
        assert len(path) == len(own[i]) + 1
        for k, node in enumerate(path):
            assert number.setdefault(own[i][:k], node) == node
    assert len(set(number.values())) == len(number)


def test_crc_of_slices():
    data = np.frombuffer(b"abcdefgh" * 40, dtype=np.uint8)
    start, end = np.array([0, 3, 5, 0]), np.array([4, 3, 17, 300])
    state = np.array([zlib.crc32(b"12:"), 0, zlib.crc32(b"x"), zlib.crc32(b"-7:")], dtype=np.uint32)
    assert variants.crc_after(state, data, start, end).tolist() == [zlib.crc32(data[a:b].tobytes(), int(s)) for s, a, b in zip(state, start, end)]


# --- periodic runs --------------------------------------------------------------------------------------------------


def brute_runs(w, least=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(least, times * q) and not any(w[start + p:start + length] == w[start:start + length - p] for p in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating(seed, n=120):
    rng = random.Random(seed)
    texts = []
    for k in range(n):
        some = lambda m, letters="abc": [rng.choice(letters) for _ in range(m)]
        block = some(rng.randrange(1, 20), "abcd")
        own = [some(rng.randrange(0, 120), "ab"), some(rng.randrange(0, 40)) + block * rng.randrange(1, 9) + block[:3] + some(20), ["x"] * rng.randrange(0, 80),
               (some(rng.randrange(1, 6), "ab") * 4 + ["z"]) * rng.randrange(1, 6), [str(rng.randrange(500)) for _ in range(rng.randrange(0, 100))] * 3][k % 5]
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize(("least", "times"), [(24, 3), (1, 3), (10, 3), (6, 4), (30, 5)])
def test_runs(least, times):
    texts = repeating(least)
    w = words_of(pa.array(texts))
    got = defaultdict(list)
    for doc, *run in periodic.find(w.hashes(), w.first, least, times).tolist():
        got[doc].append(tuple(run))
    for i, t in enumerate(texts):
        assert got[i] == brute_runs(t.split(), least, times), t


def brute_collapse(w, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_of_documents(spark):
    rows = documents() + [(900 + i, t.replace(" ", "\t\n ", 1), None, None, None) for i, t in enumerate(repeating(3, 40))]
    rows += [(990, " ".join(["a", "b"] * 20_000 + ["c"] + [f"w{i % 3001}" for i in range(9200)]), None, None, None)]
    got = Counter((r[0], r[1], tuple(map(tuple, r[2])), r[3]) for r in periodic.periodic_runs(frame(spark, rows, clashes=True)).collect())
    want = Counter()
    for i, t, *_ in rows:
        w = words(t)
        runs = brute_runs(w) if len(w) < 1000 else [(0, 40_000, 2), (40_001, 9_200, 3001)] if i == 990 else []
        want[i, len(w), tuple(runs), brute_collapse(w, runs)] += 1
    assert got == want
    assert periodic.periodic_runs(frame(spark, []).limit(0)).collect() == []


def test_query_of_runs(spark, tmp_path):
    rows = [r for r in documents() if r[0] is not None and len(r[1] or "") < 3000] + [(1000 + i, prose(random.Random(i), 90), None, None, None) for i in range(60)]
    rows += [(2000 + i, t, None, None, None) for i, t in enumerate(repeating(8, 60))]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for i, t, *_ in rows:
        w, h = words(t), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a, own = g % n, w
            p = 1 + (n - a) // (3 + g % 8)
            w = [own[k] if k < a else own[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        told = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
        want[(i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
              hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(brute_collapse(w, runs).encode()).hexdigest())] += 1
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes[1:6]] == ["bigint"] * 5
    assert Counter(map(tuple, got.collect())) == want
    assert sum(1 for w in want if w[1]) > 5
