import random

import numpy as np
import pyarrow as pa
import pytest

from jobmart.llm.common import small_batches
from jobmart.llm.words import ALNUM, SPACED, rolling, sliding_min, words_of
from tests.llm.samples import WORD, lower, words


@pytest.mark.parametrize(("kind", "pattern"), [(SPACED, WORD), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_and_hashes(kind, pattern):
    rng = random.Random(5)
    texts = [None if rng.random() < 0.1 else "".join(rng.choice(" \tab\nZé x1-") for _ in range(rng.randrange(30))) for _ in range(800)]
    w = words_of(pa.array(texts).slice(7), kind, lower=True)
    expected = [words(lower(t), pattern) for t in texts[7:]]
    assert [[w.text(i).decode() for i in range(a, b)] for a, b in zip(w.first, w.first[1:])] == expected
    flat = [x for e in expected for x in e]
    for k in (1, 2, 3, 13, 35):
        r = rolling(w.hashes(), k)
        runs = [tuple(flat[i:i + k]) for i in range(len(r))]
        assert len(set(zip(runs, r.tolist()))) == len(set(runs)) == len(set(r.tolist()))
    h = w.hashes()
    assert sliding_min(h, 7).tolist() == [min(h[i:i + 7]) for i in range(len(h) - 6)]


def test_no_rows_and_no_words():
    assert words_of(pa.array([], pa.string())).n_docs == 0
    w = words_of(pa.array([None, "", " \t"]))
    assert w.counts().tolist() == [0, 0, 0] and len(w.hashes()) == 0 and len(rolling(w.hashes(), 3)) == 0


def test_small_batches_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 50, None, "b" * 500, "", "c"]})
    parts = list(small_batches([batch], "text", 100))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert np.concatenate([p.column(0).to_pylist() for p in parts]).tolist() == batch.column(0).to_pylist()
