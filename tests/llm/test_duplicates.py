"""Exact copies, repeated passages and the n-gram join against brute force."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from jobmart.llm import exact_dedup, ngram_join, substring_dedup
from jobmart.llm.components import components
from tests.llm.samples import SCHEMA, documents, frame, lower, words


@pytest.mark.parametrize("capacity", [1, 4, 1024])
def test_exact(spark, capacity):
    rows = documents()
    got = exact_dedup.exact_duplicates(frame(spark, clashes=True), capacity=capacity).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[hashlib.sha256((r[1] or "").encode()).hexdigest()].append(r[0])
    assert Counter(r["text_sha256"] for r in got) == {k: len(v) for k, v in groups.items()}
    for r in got:
        own = groups[r["text_sha256"]]
        assert r["group_size"] == len(own) and r["keep_id"] == max((i for i in own if i is not None), default=None)
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == dict.fromkeys(groups, 1)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_frequent_digests_are_found_within_the_bound(spark):
    df = spark.range(4000).select(F.unhex(F.sha2(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")), 256)).alias("digest"))
    found = [bytes(r[0]) for r in exact_dedup.frequent(df.repartition(7), 10).collect()]
    assert hashlib.sha256(b"hot").digest() in found and len(found) <= 10


def brute_passages(rows, width):
    texts = [words(r[1]) for r in rows]
    counts = Counter(tuple(t[i:i + width]) for t in texts for i in range(len(t) - width + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = {j for i in range(len(t) - width + 1) if counts[tuple(t[i:i + width])] > 1 for j in range(i, i + width)}
        out.append((r[0], len(t), len(gone), " ".join(x for j, x in enumerate(t) if j not in gone)))
    return Counter(out)


@pytest.mark.parametrize(("width", "minimiser", "hot", "area"), [(35, 16, 1024, 256), (35, 16, 2, 8), (5, 3, 4, 4), (4, 1, 1024, 256), (3, 2, 2, 16)])
def test_passages(spark, width, minimiser, hot, area):
    got = substring_dedup.remove_repeats(frame(spark, clashes=True), width, minimiser, hot, area)
    assert Counter(map(tuple, got.collect())) == brute_passages(documents(), width)


def test_passage_within_one_document(spark):
    unit = " ".join(f"x{i}" for i in range(40))
    rows = [(1, f"{unit} y {unit} z", None, None, None), (2, "short text", None, None, None)]
    got = substring_dedup.remove_repeats(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == [(1, 82, 80, "y z"), (2, 2, 0, "short text")]


def brute_components(rows, shingle, percent):
    sets = []
    for r in rows:
        w = words(lower(r[1]))
        sets.append({tuple(w[i:i + shingle]) for i in range(max(len(w) - shingle + 1, 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    out = []
    for i, r in enumerate(rows):
        ids = [x for x in least[find(i)] if x is not None] if sets[i] else [r[0]]
        out.append((r[0], len(sets[i]), min(ids) if ids else None))
    return Counter(out)


@pytest.mark.parametrize(("shingle", "percent"), [(3, 90), (5, 80), (1, 50), (2, 20)])
def test_join(spark, shingle, percent):
    got = ngram_join.ngram_components(frame(spark, clashes=True), shingle, percent)
    assert Counter(map(tuple, got.collect())) == brute_components(documents(), shingle, percent)


def near_group(n):
    """A base text and variants: some close to the base, some only close to other variants."""
    import random

    rng = random.Random(2)
    base, out = [f"b{i}" for i in range(60)], []
    for i in range(n):
        own = list(out[rng.randrange(len(out))] if out and rng.random() < 0.5 else base)
        own[rng.randrange(60)] = f"n{i}"
        out.append(own)
    return [(i, " ".join(t), None, None, None) for i, t in enumerate(out)]


def test_long_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rows = near_group(120)
    got = ngram_join.ngram_components(frame(spark, rows), 1, 90)
    assert Counter(map(tuple, got.collect())) == brute_components(rows, 1, 90)


NEAR = " ".join(f"n{i}" for i in range(60))


def brute_links(rows, shingle, percent):
    """Pairs of linked sets, and (id, set, number of links) of each row."""
    sets = []
    for r in rows:
        w = words(lower(r[1]))
        sets.append(frozenset(tuple(w[i:i + shingle]) for i in range(max(len(w) - shingle + 1, 1))) if w else frozenset())
    classes = Counter(s for s in sets if s)
    pairs = {frozenset((x, y)) for x in classes for y in classes if x != y and 100 * len(x & y) >= percent * len(x | y)}
    n_links = {x: n - 1 + sum(classes[y] for p in pairs if x in p for y in p - {x}) for x, n in classes.items()}
    return pairs, Counter((r[0], s, n_links.get(s, 0)) for r, s in zip(rows, sets, strict=True))


@pytest.mark.parametrize(("block", "shingle", "percent"), [(256, 3, 90), (8, 1, 90), (4, 2, 50)])
def test_links(spark, monkeypatch, block, shingle, percent):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = documents() + [(1000 + i, t, None, None, None) for i, t in enumerate([f"{NEAR} {'x ' * (i % 5)}y{i}" for i in range(40)])]
    pairs, members = (x.collect() for x in ngram_join.links(frame(spark, rows, clashes=True), shingle, percent))
    expected_pairs, expected = brute_links(rows, shingle, percent)
    sets = defaultdict(set)
    for i, s, _ in expected:
        sets[i].add(s)
    by_class = {m["class_id"]: next(iter(sets[m["doc_id"]])) for m in members if m["class_id"] is not None and len(sets[m["doc_id"]]) == 1}
    assert len(pairs) == len({tuple(p) for p in pairs}) and all(p["a"] < p["b"] for p in pairs)
    assert {frozenset((by_class[p["a"]], by_class[p["b"]])) for p in pairs} == expected_pairs and len(pairs) == len(expected_pairs)
    by_count = Counter()
    for (i, _, n), rows_of in expected.items():
        by_count[i, n] += rows_of
    assert Counter((m["doc_id"], m["n_links"]) for m in members) == by_count


def test_keep_one(spark):
    rows = documents()
    expected = {}
    for (doc_id, n, component), times in brute_components(rows, 5, 80).items():
        if n:
            expected[component] = 1
    got = ngram_join.keep_one(frame(spark, clashes=True))
    assert got.columns == frame(spark, clashes=True).columns
    kept = got.collect()
    full = [r["doc_id"] for r in kept if words(r["text"])]
    assert Counter(full) == expected
    assert len(kept) - len(full) == sum(not words(r[1]) for r in rows)
    assert {r["label"] for r in kept} == {"other"}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_duplicates(none).collect() == []
    assert substring_dedup.remove_repeats(none).collect() == []
    assert ngram_join.ngram_components(none).collect() == []
    assert ngram_join.keep_one(none).collect() == []
    assert [x.collect() for x in ngram_join.links(none)] == [[], []]
