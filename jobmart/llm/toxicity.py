"""Toxicity by a weighted finite-state grammar over clauses.

Words are mapped to classes (insult, threat, target, negation, report verb, other).  Four small transducers
read the class sequence of a clause: negation weakens what stands in its scope, reported speech weakens what
follows a report verb, a target strengthens an insult or threat near it, before or after.  Their composition
is one deterministic machine; it gives the weight of every match, and the matches of a clause add up.

The lexicon holds fixed words and words or word beginnings learned from labelled documents: those that occur
in toxic ones too often for chance (binomial tail, corrected for the number of candidates), each with its log
odds as weight.  Near copies in the sample count once.  A logistic curve over the strongest clause and the
sum of all clauses, fitted on the same sample with weights that are not negative, turns weights into a score: a
further matched clause, or a stronger one, never lowers it.

The sample is at most ``SAMPLE`` labelled documents, chosen by a hash of their id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import documents, small_batches
from jobmart.llm.words import ALNUM, Words, rolling, words_of
from jobmart.scratch import materialise

SAMPLE = 20_000
LENGTHS = (None, 4, 5, 6, 7)  # bytes of a word that count; None: all
CHANCE = 0.01
SEED_WEIGHT = 4.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# A small multilingual lexicon.
INSULTS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "imbecile", "idiota", "dummkopf", "connard"]
THREATS = ["kill", "hurt", "destroy", "murder", "beat", "shoot", "töten", "tuer", "matar"]
TARGETS = ["you", "your", "he", "she", "they", "him", "her", "them", "du", "dich", "ihr", "sie", "tu", "toi", "vous", "tú", "usted"]
NEGATIONS = ["not", "never", "no", "nobody", "isn", "aren", "nicht", "kein", "nie", "pas", "jamais", "nunca", "sin"]
REPORTS = ["said", "says", "wrote", "quoted", "called", "claimed", "reported", "sagte", "schrieb", "dit", "écrit", "dijo", "escribió"]


@dataclass
class Transducer:
    """Deterministic: ``arcs[state, symbol]`` is (next state, output symbol, weight).  A missing arc copies the
    symbol and follows ``fall[state]``."""

    arcs: dict = field(default_factory=dict)
    fall: dict = field(default_factory=dict)

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or (self.fall.get(state, state), symbol, 1.0)


def scope(opens: int, length: int, weights: dict[int, float], outside: dict[int, float] | None = None) -> Transducer:
    """``opens`` starts a scope of ``length`` words in which matches weigh ``weights`` times as much."""
    t = Transducer()
    for state in range(length + 1):
        t.fall[state] = max(0, state - 1)
        t.arcs[state, opens] = (length, opens, 1.0)
        for symbol, weight in (weights if state else outside or {}).items():
            t.arcs[state, symbol] = (max(0, state - 1), symbol, weight)
    return t


def look_back(after: Iterable[int], closes: int, length: int, weight: float) -> Transducer:
    """A ``closes`` word within ``length`` words after a match counts as another match of that weight."""
    t = Transducer()
    for state in range(length + 1):
        t.fall[state] = max(0, state - 1)
        for symbol in after:
            t.arcs[state, symbol] = (length, symbol, 1.0)
        if state:
            t.arcs[state, closes] = (0, INSULT, weight)
    return t


def compose(parts: list[Transducer], symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables next[state, symbol], output[state, symbol], weight[state, symbol] of the transducers in a row."""
    states, rows, queue = {(0,) * len(parts): 0}, [], [(0,) * len(parts)]
    while queue:
        state, row = queue.pop(0), []
        for symbol in range(symbols):
            out, weight, target = symbol, 1.0, []
            for part, own in zip(parts, state, strict=True):
                own, out, times = part.step(own, out)
                weight *= times
                target.append(own)
            target = tuple(target)
            if target not in states:
                states[target] = len(states)
                queue.append(target)
            row.append((states[target], out, weight))
        rows.append(row)
    return tuple(np.array([[arc[i] for arc in row] for row in rows]) for i in range(3))


def grammar() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The composed machine.  Each transducer reads what the one before it wrote."""
    both = (INSULT, THREAT)
    negation = scope(NEGATION, 3, dict.fromkeys(both, 0.25))
    reported = scope(REPORT, 12, dict.fromkeys(both, 0.5))
    threat = scope(TARGET, 4, {THREAT: 1.0}, {THREAT: 0.5})  # a threat needs someone to be threatened
    target = scope(TARGET, 4, dict.fromkeys(both, 1.5))
    insult = look_back(both, TARGET, 3, 0.5)  # "idiot, you": the target may come after
    return compose([negation, reported, threat, target, insult], 6)


Lexicon = list[tuple[int | None, int, int, float]]


def fixed_lexicon() -> Lexicon:
    """(length, hash, class, weight) of the fixed words."""
    out: Lexicon = []
    for kind, words, weight in ((INSULT, INSULTS, SEED_WEIGHT), (THREAT, THREATS, SEED_WEIGHT), (TARGET, TARGETS, 0), (NEGATION, NEGATIONS, 0), (REPORT, REPORTS, 0)):
        h = words_of(pa.array(words), ALNUM, lower=True).hashes()
        out += [(None, int(x), kind, weight) for x in h]
    return out


class _Lookup:
    """Class and weight of words: a learned entry outdoes a fixed one, and the largest weight counts."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.by_length = {}
        for length in {x[0] for x in lexicon}:
            best = {}
            for _, h, kind, weight in (x for x in lexicon if x[0] == length):
                if h not in best or weight > best[h][1]:
                    best[h] = (kind, weight)
            hashes = np.array(sorted(best), dtype=np.uint64)
            seen = np.zeros(1 << 16, dtype=bool)
            seen[hashes >> np.uint64(48)] = True
            self.by_length[length] = (
                hashes, seen, np.array([best[int(h)][0] for h in hashes], np.int8), np.array([best[int(h)][1] for h in hashes]))

    def __call__(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        kinds, weights = np.zeros(len(w.start), np.int8), np.zeros(len(w.start))
        for length, (hashes, seen, kind, weight) in self.by_length.items():
            h = w.hashes(upto=length)
            at = np.flatnonzero(seen[h >> np.uint64(48)] & (True if length is None else w.end - w.start >= length))
            place = np.minimum(np.searchsorted(hashes, h[at]), len(hashes) - 1)
            found = hashes[place] == h[at]
            at, place = at[found], place[found]
            better = (weight[place] > weights[at]) | (kinds[at] == OTHER)
            kinds[at[better]], weights[at[better]] = kind[place[better]], weight[place[better]]
        return kinds, weights


_BREAK = np.isin(np.arange(256), np.frombuffer(b".!?;\n", np.uint8))


def clause_weights(w: Words, lookup: _Lookup, tables: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Weight of the strongest clause and of all clauses of each document."""
    most, total = np.zeros(w.n_docs), np.zeros(w.n_docs)
    if not len(w.start):
        return most, total
    kinds, weights = lookup(w)
    breaks = np.cumsum(_BREAK[w.data])[w.start]
    doc = w.doc()
    new = np.concatenate(([True], (breaks[1:] != breaks[:-1]) | (doc[1:] != doc[:-1])))
    heads = np.append(np.flatnonzero(new), len(new))
    clause = np.cumsum(new) - 1
    follow, output, factor = (t.tolist() for t in tables)
    for c in np.unique(clause[(kinds == INSULT) | (kinds == THREAT)]).tolist():
        a, b = heads[c], heads[c + 1]
        state = score = last = 0
        for kind, weight in zip(kinds[a:b].tolist(), weights[a:b].tolist(), strict=True):
            if output[state][kind] in (INSULT, THREAT):
                last = weight if kind in (INSULT, THREAT) else last
                score += factor[state][kind] * last
            state = follow[state][kind]
        d = doc[a]
        most[d], total[d] = max(most[d], score), total[d] + score
    return most, total


def _weigh(lexicon: Lexicon, text: str = "text", keep_text: bool = False) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, tables = _Lookup(lexicon), grammar()
        for batch in small_batches(batches, text):
            most, total = clause_weights(words_of(batch.column(text), ALNUM, lower=True), lookup, tables)
            kept = [n for n in batch.schema.names if n != text or keep_text]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(most), pa.array(total)], [*kept, "most", "total"])
    return run


def _near_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The two least 3-gram hashes of each text: copies with a few changes share them."""
    for batch in small_batches(batches, "text"):
        w = words_of(batch.column("text"), ALNUM, lower=True)
        h, keys = w.hashes(), []
        for a, b in zip(w.first, w.first[1:], strict=False):
            grams = np.sort(rolling(h[a:b], min(3, b - a)))[:2] if b > a else []
            keys.append(",".join(str(g) for g in grams))
        yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("label"), pa.array(keys, pa.string())], ["text", "label", "near"])


_FEATURES = "length int, hash long, pos long, neg long"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and word beginnings with their numbers of toxic and other documents."""
    for batch in small_batches(batches, "text", 16 << 20):
        w = words_of(batch.column("text"), ALNUM, lower=True)
        label, doc = np.array(batch.column("label").to_pylist(), np.int64), w.doc()
        for length in LENGTHS:
            long = np.flatnonzero(w.end - w.start >= (length or 3))
            if not len(long):
                continue
            h, d = w.hashes(upto=length)[long], doc[long]
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))
            h, toxic = h[new], label[d[new]]
            heads = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            pos = np.add.reduceat(toxic, heads)
            both = np.diff(np.append(heads, len(h)))
            n = len(heads)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, length or 0, np.int32)), pa.array(h[heads].view(np.int64)), pa.array(pos), pa.array(both - pos)],
                ["length", "hash", "pos", "neg"])


@dataclass(frozen=True)
class Model:
    lexicon: tuple
    curve: tuple[float, float, float]


DEFAULT = Model(tuple(fixed_lexicon()), (-4.0, 1.0, 1.0))


def _tail(hits: int, n: int, p: float) -> float:
    """log10 of the chance of ``hits`` or more of ``n`` (bound of Chernoff and Hoeffding)."""
    share = hits / n
    if share <= p:
        return 0.0
    rest = (1 - share) * math.log((1 - share) / (1 - p)) if share < 1 else 0.0
    return -n * (share * math.log(share / p) + rest) / math.log(10)


def _newton(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps: the constant, then a weight for each column."""
    x = np.column_stack((np.ones(len(x)), x))
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        beta += np.clip(np.linalg.solve(hess, x.T @ (y - p) - ridge * beta), -5, 5)
    return beta


def _loss(x: np.ndarray, y: np.ndarray, curve: tuple[float, float, float]) -> float:
    z = curve[0] + x @ np.array(curve[1:])
    return float(np.sum(np.logaddexp(0, z) - y * z))


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """The best curve that never falls: both weights free if neither is negative, else one of them is 0.

    The two measures nearly say the same, so a small sample can give one of them a negative weight, and then
    more insults would lower a score.  If every single weight is negative too, the default curve holds.
    """
    free = tuple(float(b) for b in _newton(x, y))
    if min(free[1:]) >= 0:
        return free
    a, b = _newton(x[:, :1], y), _newton(x[:, 1:], y)
    able = [c for c in ((float(a[0]), float(a[1]), 0.0), (float(b[0]), 0.0, float(b[1]))) if max(c[1:]) > 0]
    return min(able, key=lambda c: _loss(x, y, c), default=DEFAULT.curve)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), of which at most ``sample`` are used.

    Of several labels of a document the highest counts; null labels and ids are left out.  Without toxic and
    other labels, the fixed lexicon and curve are returned.
    """
    ids = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
        .orderBy(F.md5(F.col("doc_id").cast("string"))).limit(sample)
    )
    rows = materialise(
        docs.join(F.broadcast(ids), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int")))
    rows = rows.mapInArrow(_near_key, "text string, label int, near string")
    rows = rows.groupBy("near", "label").agg(F.min_by("text", F.md5("text")).alias("text"))  # the same one in every run
    rows = materialise(rows.select("text", "label"))
    counts = {r["label"] > 0: r["count"] for r in rows.groupBy("label").count().collect()}
    pos, neg = counts.get(True, 0), counts.get(False, 0)
    if not pos or not neg:
        return DEFAULT
    found = materialise(rows.mapInArrow(_features, _FEATURES).groupBy("length", "hash").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    tests, prior = found.filter("pos >= 2").count(), pos / (pos + neg)
    rare = math.log10(CHANCE / max(tests, 1))
    often = found.filter(F.col("pos") * neg > 5 * F.col("neg") * pos).filter("pos >= 3").collect()  # within the bounded sample
    learned = [
        (r["length"] or None, r["hash"] % 2**64, INSULT, math.log((r["pos"] + 0.5) / (pos + 1) / ((r["neg"] + 0.5) / (neg + 1))))
        for r in often if _tail(r["pos"], r["pos"] + r["neg"], prior) <= rare
    ]
    lexicon = fixed_lexicon() + learned
    weighed = rows.mapInArrow(_weigh(lexicon), "label int, most double, total double").collect()
    x = np.array([(r["most"], math.log1p(r["total"])) for r in weighed])
    return Model(tuple(lexicon), _fit(x, np.array([float(r["label"] > 0) for r in weighed])))


def score(docs: DataFrame, model: Model = DEFAULT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, strongest, total``: a row for each row of ``docs``, repeated ones too.

    ``score`` is between 0 and 1; a null or empty text has no match and gets the score of such texts.
    ``strongest`` and ``total`` are the clause weights behind it.  Other columns are ignored.
    """
    rows = documents(docs, key, text)
    kind = dict(rows.dtypes)["doc_id"]
    weighed = rows.mapInArrow(_weigh(list(model.lexicon)), f"doc_id {kind}, most double, total double")
    return weighed.select("doc_id", curve(model).alias("score"), F.col("most").alias("strongest"), "total")


def curve(model: Model) -> Column:
    a, b, c = model.curve
    return 1 / (1 + F.exp(-(F.lit(a) + b * F.col("most") + c * F.log1p("total"))))


def reject(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; columns unchanged."""
    columns = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(columns)])
    fields = ", ".join(f"d_{i} {kind}" for i, (_, kind) in enumerate(docs.dtypes))
    weighed = rows.mapInArrow(_weigh(list(model.lexicon), f"d_{columns.index('text')}", keep_text=True), f"{fields}, most double, total double")
    return weighed.filter(curve(model) < threshold).select(*[F.col(f"d_{i}").alias(c) for i, c in enumerate(columns)])
