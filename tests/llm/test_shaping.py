"""Sharding, chat formatting, decontamination, mixing and the pipeline."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobmart.llm import chat, decontaminate, mixing, sharding
from tests.llm.samples import SCHEMA, documents, frame, lower, words

# ---- sharding ---------------------------------------------------------------------------


def test_table_is_even_and_stable():
    names = sharding.shard_names(7)
    table = sharding.fill_table(names, 701)
    counts = Counter(table)
    assert len(table) == 701 and set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill_table(names[:-1], 701)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 0.15 * 701


def test_prime_from():
    assert [sharding.prime_from(n) for n in (0, 2, 8, 100, 1600)] == [2, 2, 11, 101, 1601]


def test_shards_of_awkward_rows(spark):
    names = sharding.shard_names(4)
    slots = sharding.prime_from(400)
    table = sharding.fill_table(names, slots)
    rows = sharding.assign_shards(frame(spark, clashes=True), names).collect()
    assert len(rows) == len(documents())
    for r in rows:
        by = str(r["doc_id"]) if r["doc_id"] is not None else hashlib.sha256(r["text"].encode()).hexdigest() if r["text"] is not None else ""
        assert r["slot"] == int(hashlib.md5(by.encode()).hexdigest()[:13], 16) % slots
        assert (r["shard"], r["shard_name"]) == (table[r["slot"]], names[table[r["slot"]]])
    assert sharding.assign_shards(spark.createDataFrame([], SCHEMA), names).collect() == []
    with pytest.raises(ValueError):
        sharding.assign_shards(frame(spark), ["a", "a"])


# ---- chat -------------------------------------------------------------------------------


def test_snapshots_collapse(spark):
    turns = [
        (1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yes?"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes?"), (3, 2, "user", "bye"),
        (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (5, 0, "user", "hi"), (5, 1, "assistant", "no"), (5, 1, "assistant", "no"),
        (6, 0, None, None), (6, 1, "", ""), (7, 0, None, None), (8, None, "user", "x"), (None, 0, "user", "hi"), (None, 3, "tool", "alone"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("whole", F.lit(2))
    got = {(r["conv_id"], r["n_turns"], r["n_equal"]): r["text"] for r in chat.format_chats(df).collect()}
    assert set(got) == {(3, 3, 1), (4, 2, 2), (6, 2, 1), (8, 1, 1), (None, 1, 1)}
    assert got[3, 3, 1] == "<|user|>\nhi<|end|>\n<|assistant|>\nyes?<|end|>\n<|user|>\nbye<|end|>\n"
    assert got[6, 2, 1] == "<|unknown|>\n<|end|>\n<|>\n<|end|>\n".replace("<|>", "<||>")
    assert chat.format_chats(df.limit(0)).collect() == []


def test_missing_and_empty_turns_differ(spark):
    rows = [(1, 0, "user", None), (2, 0, "user", ""), (2, 1, "user", "b"), (3, 0, "user", "a|b"), (4, 0, "user|a", "b")]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(r["conv_id"] for r in got) == [1, 2, 3, 4]


# ---- decontamination --------------------------------------------------------------------

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_marks(rows, items, width):
    windows = defaultdict(set)
    for i, t in items:
        w = words(lower(t), PATTERN)
        k = min(width, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[j:j + k])].add("" if i is None else str(i))
    out = Counter()
    for r in rows:
        w, hit, found = words(lower(r[1]), PATTERN), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in windows:
                    hit.update(range(j, j + k))
                    found |= windows[tuple(w[j:j + k])]
        out[r[0], len(w), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    return out


ITEMS = [(1, "W1é w2"), (2, None), (3, ""), (10, "one two"), (None, "Aa-bB.cC"), (5, documents()[8][1]), (6, documents()[8][1]), (7, documents()[0][1])]


@pytest.mark.parametrize(("width", "block"), [(13, 1 << 17), (3, 1 << 17), (13, 20), (2, 7)])
def test_marks(spark, width, block):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    marked = decontaminate.mark_items(frame(spark, clashes=True), benchmark, width, block)
    plan = decontaminate.mark(frame(spark), benchmark, width, block)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan[:plan.index("MapInArrow")]  # one pass, however many blocks
    got = marked.select("doc_id", "_n", decontaminate.n_hit(), F.array_join("_items", ","), decontaminate.contaminated())
    assert Counter(map(tuple, got.collect())) == brute_marks(documents(), ITEMS, width)


def test_documents_and_spans_are_removed(spark):
    docs = frame(spark, [(1, "Ah, THE quick-brown fox! x", None, None, None), (2, "the quick", None, None, None), (3, None, None, None, None)], clashes=True)
    benchmark = spark.createDataFrame([(1, "the quick brown fox")], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, benchmark, remove="spans").collect()}
    assert cut == {1: "Ah,  -  ! x".replace(" -  !", " - !"), 2: "the quick", 3: None}
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).count() == 3
    assert decontaminate.decontaminate(docs.limit(0), benchmark).collect() == []


# ---- mixing -----------------------------------------------------------------------------


def reshare(sizes, weights, most=3):
    """Targets by sharing again and again, as the description has it."""
    target, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / total for s in open_}
        left = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 1, None: 50}, {"a": 5}, {"a": 0, "b": 7}, {"a": 1, "b": 1, "c": 1, "d": 1000, "e": 3}, {"a": 0}])
def test_targets(spark, sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: i % 3 + 1 for i, s in enumerate(names)}
    df = mixing.cycling_weights(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long"))
    got = {r["source"]: r for r in mixing.targets(df).collect()}
    assert {s: r["weight"] for s, r in got.items()} == weights
    expected = reshare(sizes, weights)
    assert all(r["target"] == pytest.approx(expected[s]) for s, r in got.items())


def test_mix(spark):
    rows = documents(n=300)
    quality = spark.createDataFrame([(1, 2.0), (1, 1.0), (2, -1.0), (None, 5.0)], "doc_id long, quality double")
    docs = frame(spark, rows, clashes=True)
    docs = docs.withColumns({c: F.lit("own") for c in ("copy", "target", "picked", "id", "d_0", "passes")})
    mixed = mixing.mix(docs, quality)
    assert mixed.columns == [c for c in docs.columns if c not in ("size", "source_size", "target", "picked")] + ["size", "source_size", "target", "epochs", "picked", "taken"]
    got = mixed.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(r[:2] for r in rows)
    taken, size = Counter(), Counter()
    for r in got:
        assert r["size"] == len(words(r["text"])) and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
    for r in got:
        assert r["source_size"] == size[r["source"]] and 0 <= r["target"] - taken[r["source"]] <= max(0.02 * r["target"], 6)
        assert r["copy"] == "own"
    again = mixing.mix(docs.repartition(2), quality, whole_rows=False).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in again) == Counter((r["doc_id"], r["size"], r["taken"]) for r in got)
    copies = mixing.mixed(docs, quality)
    assert copies.columns == docs.columns
    assert Counter((r["doc_id"], r["text"], r["size"], r["copy"], r["target"]) for r in copies.collect()) == _times(got)
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def _times(rows):
    out = Counter()
    for r in rows:
        if r["size"]:
            out[r["doc_id"], r["text"], "other", "own", "own"] += r["taken"] // r["size"]
    return +out


def first_fit(sizes, gap, seed="mix"):
    """Ids taken one after the other in key order, if they still fit."""
    key = lambda i: -math.log((int(hashlib.md5(f"{seed}{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52)
    taken = set()
    for i in sorted(sizes, key=key):
        if 0 < sizes[i] <= gap:
            taken.add(i)
            gap -= sizes[i]
    return taken


@pytest.mark.parametrize("sizes", [
    [1000 - 37 * i for i in range(27)], [2**i for i in range(11)] * 3, [5] * 40, [900, 1, 800, 2, 700, 3, 600, 4, 500, 5] * 4, [0, 0, 3], [10_000] + [7] * 50])
def test_every_document_that_fits_is_taken(spark, sizes):
    docs = spark.createDataFrame([(i, "w " * n, "a") for i, n in enumerate(sizes)] + [(1000 + i, "v " * 9, None) for i in range(30)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 1.0), (None, 3.7)], "source string, weight double")
    got = mixing.mix(docs.repartition(4), None, weights, whole_rows=False).collect()
    for own in ([r for r in got if r["doc_id"] < 1000], [r for r in got if r["doc_id"] >= 1000]):
        own_sizes = {r["doc_id"]: r["size"] for r in own}
        gap = own[0]["target"] - own[0]["epochs"] * sum(own_sizes.values())
        assert {r["doc_id"] for r in own if r["picked"]} == first_fit(own_sizes, gap)


def test_higher_quality_is_taken_more_often(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i % 3 else "b") for i in range(3000)], "doc_id long, text string, source string")
    quality = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0).alias("quality"))
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "source string, weight double")
    picked = mixing.mix(docs, quality, weights, whole_rows=False).filter("source_size = 20000 and picked").collect()
    assert sum(r["doc_id"] % 2 == 0 for r in picked) > 1.5 * sum(r["doc_id"] % 2 for r in picked)


# ---- pipeline ---------------------------------------------------------------------------


def test_pipeline_stages(spark, folder, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_join", "decontaminate", "mixing", "sharding"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tables, columns = [docs], docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], folder).write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
    assert all(t.columns == columns for t in tables[:-1])
    ids = [Counter(r["doc_id"] for r in t.select("doc_id").collect()) for t in tables]
    from jobmart.llm import toxicity
    from jobmart.llm.queries import QUERIES
    from tests.llm.test_duplicates import brute_components

    toxic = {r["doc_id"] for r in QUERIES["op1_toxicity"](spark, folder).filter("predicted = 1").collect()}
    assert set(ids[1]) == set(ids[0]) - toxic and toxicity.SAMPLE > 0
    rows = [tuple(r) for r in tables[1].collect()]
    assert set(ids[2]) == {c for _, _, c in brute_components(rows, 5, 80)}
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    marks = brute_marks([tuple(r) for r in tables[2].collect()], items, 13)
    assert set(ids[3]) == {m[0] for m in marks if not m[4]}
    assert set(ids[4]) <= set(ids[3]) and max(ids[4].values()) <= 3 and ids[5] == ids[4]
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, tables[-1].collect()), key=str)
