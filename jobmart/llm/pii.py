"""Personal data: base patterns, and contextual extraction that is bootstrapped from them.

Base spans (e-mail, IP address, card, phone) are the seeds.  The words next to them, and the key in front of a
value (``key=value``, ``key:value``, ``key = "value"``, ``"key" : value``), are lexical patterns.  All other tokens
are candidates, whatever their characters; of a token that begins with a quotation mark, the value is what stands
before the closing one.  A candidate behind a key that looks made by a machine (twenty characters or more of
letters, digits and ``+/_-``, with a letter and a digit) is a presumed secret: it supports patterns like a seed,
but becomes a span only if the patterns vouch for it.  Those that look like identifiers (five characters or more, with a digit) have patterns from the
start; of the others, those are fetched from the texts that stand at a pattern of worth.  Spark scores the graph of values and patterns in rounds:

* a pattern is worth the share of its occurrences in the whole corpus that stand next to trusted values, so a
  word that mostly stands next to plain text is worth nothing; it needs several different trusted values, which
  are the seeds at first and later whatever has become trusted, so every round can bring new patterns;
* a candidate that looks like an identifier is trusted by all its different patterns together (noisy or) once
  they reach the threshold;
* any other candidate may be a common word that stands everywhere, so its own occurrences have to agree: its trust
  is the mean of the noisy or over all its occurrences in the corpus, where one counts 0 if none of its patterns
  is strong.  Three patterns below ``strong`` cannot reach the threshold together, so no trusted value is missed;
* what is trusted counts like a seed in the next round, with all its occurrences.

Trust is never taken back, so the rounds end by themselves: with the first one that adds no value.  Trusted
candidates become spans of the kind ``id``.  Each step runs on tables of values and patterns in the shared
folder.  Texts are read twice, to find spans and to count words, and again in rounds that have new strong patterns
or new trusted values of the second sort, by blocks of at most about ``BLOCK`` hashes.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.chunks import arrow_table, part_of, slices
from jobmart.llm.common import documents, small_batches
from jobmart.llm.words import SPACED, Words, words_of
from jobmart.scratch import materialise

KINDS = ["email", "ip", "card", "phone", "id"]
THRESHOLD = 0.8
SUPPORT = 3
SMOOTHING = 2.0
LEAST_LENGTH = 5
FLUSH = 1 << 21
BLOCK = 1 << 17
PART_BYTES = 16 << 20
LEAST_PARTS = 16

# Fixed patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]++")
_KEY = re.compile(r"([A-Za-z_][A-Za-z0-9_-]*)[=:]+(?=.)")
_KEY_BYTES = re.compile(_KEY.pattern.encode())
_SIGNS = re.compile(r"[=:]+")
_SPACED_KEY = re.compile(r"[a-z_][a-z0-9_-]*")
_SECRET = re.compile(r"(?=.*[A-Za-z])(?=.*[0-9])[A-Za-z0-9+/_-]{20,}")
_QUOTES = "\"'`"
_EDGE = "\"'`.,;:!?()[]{}<>|"
PRESUMED = "?"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match has one ``@``: the run before it and the domain after it, so no start is tried twice."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        floor = domain.end() if domain else at + 1
        if domain:
            yield start, floor
        at = text.find("@", floor)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by dots, taken in order from each chain of numbers."""
    for chain in _NUMBERS.finditer(text):
        parts, at = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - len(parts) % 4, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), sorted."""
    return sorted((a, k, b) for k, find in enumerate((emails, addresses, cards, phones)) for a, b in find(text))


def _word(text: str) -> str:
    return text.strip(_EDGE).lower()


def _shaped(core: str) -> bool:
    return len(core) >= LEAST_LENGTH and any("0" <= c <= "9" for c in core)


def _spaced_key(text: str, tokens: list[tuple[int, int]], i: int) -> str | None:
    """The key of the value in token ``i`` if a token of signs stands between them."""
    if i < 2 or not _SIGNS.fullmatch(text, *tokens[i - 1]) or _SIGNS.fullmatch(text, *tokens[i]):
        return None
    key = _SPACED_KEY.fullmatch(text[slice(*tokens[i - 2])].lower().strip(_EDGE))
    return key[0] if key else None


def _core(text: str, tokens: list[tuple[int, int]], i: int) -> tuple[int, str, str | None]:
    """Start and text of the value in token ``i``, and the key in front of it."""
    a, b = tokens[i]
    key = _KEY.match(text, a, b)
    begin = key.end() if key else a
    close = text.find(text[begin], begin + 1, b) if text[begin] in _QUOTES else -1
    if close >= 0:
        begin, b = begin + 1, close
    core = text[begin:b].strip(_EDGE)
    return text.index(core, begin), core, key[1].lower() if key else _spaced_key(text, tokens, i)


def _patterns(text: str, tokens: list[tuple[int, int]], before: int, after: int, key: str | None) -> list[str]:
    patterns = [f"K {key}"] if key else []
    for name, i in (("L", before), ("R", after)):
        if 0 <= i < len(tokens) and (word := text[slice(*tokens[i])].lower()):
            patterns.append(f"{name} {word}")
    return patterns


def instances(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and candidates that look like identifiers, with their patterns: word to the left, word to the right, key."""
    out, tokens = [], [m.span() for m in _TOKEN.finditer(text)]
    starts = np.array([a for a, _ in tokens])

    def add(a: int, b: int, kind: str, key: str | None) -> None:
        first, last = int(np.searchsorted(starts, a, "right")) - 1, int(np.searchsorted(starts, b - 1, "right")) - 1
        out.append({"start": a, "end": b, "kind": kind, "value": text[a:b].lower(), "patterns": _patterns(text, tokens, first - 1, last + 1, key)})

    taken, reach = [], 0
    for a, _, b in spans:
        taken.append((a, b))
    for a, k, b in spans:
        i = int(np.searchsorted(starts, a, "right")) - 1
        key = _KEY.match(text, *tokens[i])
        spaced = None if key else _spaced_key(text, tokens, i)
        add(a, b, KINDS[k], key[1].lower() if key and key.end() <= a else spaced)
    for i, (a, b) in enumerate(tokens):
        piece = text[a:b]
        if b - a < LEAST_LENGTH or not any("0" <= c <= "9" for c in piece):
            continue
        while reach < len(taken) and taken[reach][1] <= a:
            reach += 1
        if any(x < b and a < y for x, y in taken[reach:reach + 8]):
            continue
        begin, core, key = _core(text, tokens, i)
        if _shaped(core):
            add(begin, begin + len(core), PRESUMED if key and _SECRET.fullmatch(core) else "", key)
    return out


def plain_instances(text: str, which: list[int]) -> list[tuple[int, int, str, list[str]]]:
    """Start, end, value and patterns of those of the numbered tokens that are no part of a base span and do not look like identifiers."""
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    starts, ends = [], []
    for a, _, b in base_spans(text):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    out = []
    for i in which:
        a, b = tokens[i]
        near = bisect_right(ends, a)
        if near < len(starts) and starts[near] < b:
            continue
        begin, core, key = _core(text, tokens, i)
        if core and not _shaped(core):
            out.append((begin, begin + len(core), core.lower(), _patterns(text, tokens, i - 1, i + 1, key)))
    return out


_INSTANCE = "struct<start: int, end: int, kind: string, value: string, patterns: array<string>>"
_FOUND = f"n_email long, n_ip long, n_card long, n_phone long, base array<string>, instances array<{_INSTANCE}>, digest binary"  # and the size of the text
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]))
_MAY = np.isin(np.arange(256), np.frombuffer(b"0123456789@", np.uint8))


def _digest(text: bytes | pa.Buffer) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        texts = batch.column("text")
        counts, base, found, digests = np.zeros((len(texts), 4), np.int64), [], [], []
        offsets = np.concatenate(([0], np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in texts])))
        raw = np.frombuffer(b"".join(t.as_buffer().to_pybytes() for t in texts if t.is_valid), np.uint8)
        marks = np.concatenate(([0], np.cumsum(_MAY[raw])))
        may = marks[offsets[1:]] > marks[offsets[:-1]]  # every kind of span has a digit or an @
        for d in range(len(texts)):
            spans = base_spans(text := texts[d].as_py()) if may[d] else []
            for _, k, _ in spans:
                counts[d, k] += 1
            base.append([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])
            found.append(instances(text, spans) if may[d] else [])
            digests.append(_digest(texts[d].as_buffer() if texts[d].is_valid else b""))
        kept = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in kept], *[pa.array(counts[:, k]) for k in range(4)], pa.array(base, pa.list_(pa.string())), pa.array(found, _ARROW),
             pa.array(digests, pa.binary()), pa.array(np.diff(offsets))],
            [*kept, "n_email", "n_ip", "n_card", "n_phone", "base", "instances", "digest", "bytes"])


_COUNTS = "part int, hashes binary, counts binary"
_BYTES = np.arange(256)
_TRIMMED = np.isin(_BYTES, np.frombuffer(_EDGE.encode(), np.uint8))
_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_KEY_START = np.frombuffer(b"_abcdefghijklmnopqrstuvwxyz", np.uint8)
_QUOTE = np.frombuffer(_QUOTES.encode(), np.uint8)
_SPACED_BYTES = re.compile(_SPACED_KEY.pattern.encode())


def _lowered(column: pa.Array) -> Words:
    """Words in lower case, also beyond ASCII."""
    if pc.all(pc.string_is_ascii(column)).as_py() is False:
        column = pa.array([t if t is None or t.isascii() else t.lower() for t in column.to_pylist()], pa.large_string())
    return words_of(column, SPACED, lower=True)


def _cores(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the value in each word, the numbers of words with a key, and hashes of the keys."""
    start, end = w.start.copy(), w.end.copy()
    signs = np.flatnonzero((w.data == 0x3D) | (w.data == 0x3A))
    at, n = np.unique(np.searchsorted(w.start, signs, "right") - 1, return_counts=True)
    alone = at[n == end[at] - start[at]]
    at = at[np.isin(w.data[start[at]], _KEY_START)]
    raw, keyed, keys, edge = w.data.tobytes(), [], [], _EDGE.encode()
    for i in at.tolist():
        if m := _KEY_BYTES.match(raw, int(start[i]), int(end[i])):
            start[i] = m.end()
            keyed.append(i)
            keys.append("\0" + m[1].decode())  # no word of a text starts so
    doc = w.doc()
    alone = alone[(alone > 0) & (alone < len(start) - 1) & ~np.isin(alone + 1, [*keyed, *alone.tolist()])]
    alone = alone[(doc[alone - 1] == doc[alone]) & (doc[alone + 1] == doc[alone])]
    for i in alone.tolist():
        if m := _SPACED_BYTES.fullmatch(raw[w.start[i - 1]:w.end[i - 1]].strip(edge)):
            keyed.append(i + 1)
            keys.append("\0" + m[0].decode())
    for i in np.flatnonzero(np.isin(w.data[np.minimum(start, len(w.data) - 1)], _QUOTE)).tolist() if len(start) else []:
        if (close := raw.find(raw[start[i]:start[i] + 1], int(start[i]) + 1, int(end[i]))) >= 0:
            start[i], end[i] = start[i] + 1, close
    live = np.arange(len(start))
    while len(live := live[start[live] < end[live]]) and len(live := live[_TRIMMED[w.data[start[live]]]]):
        start[live] += 1
    live = np.arange(len(start))
    while len(live := live[start[live] < end[live]]) and len(live := live[_TRIMMED[w.data[end[live] - 1]]]):
        end[live] -= 1
    return start, end, np.array(keyed, np.int64), words_of(pa.array(keys, pa.large_string())).hashes()


def _core_hashes(w: Words, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words whose values are not empty and do not look like identifiers, and the hashes of those values."""
    digits = np.concatenate(([0], np.cumsum(_DIGIT[w.data])))
    points = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80)))
    shaped = (points[end] - points[start] >= LEAST_LENGTH) & (digits[end] > digits[start])
    which = np.flatnonzero((end > start) & ~shaped)
    return which, Words(w.data, start[which], end[which], w.first).hashes(lane=1)


def _count_words(parts: int) -> Callable:
    """Counts of words, keys and values of a task, packed by hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> list[pa.RecordBatch]:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            rows = [(p, values[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes()) for p, a, b in slices(part_of(values, parts))]
            return arrow_table(_COUNTS, rows).to_batches()

        for batch in small_batches(batches, 0):
            w = _lowered(batch.column(0))
            start, end, _, keys = _cores(w)
            end = np.where((start == w.start) & (end == w.end), start, end)  # values that are whole words are counted as words
            held.append(np.concatenate((w.hashes(), keys, _core_hashes(w, start, end)[1])))
            size += len(held[-1])
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()
    return run


_TOTALS = "pattern string, total long"


def _look_up(_: tuple, wanted: pa.Table, counted: pa.Table) -> pa.Table:
    """Number of occurrences of the wanted words."""
    hashes = wanted["hash"].to_numpy().view(np.uint64)
    distinct, which = np.unique(hashes, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    for values, counts in zip(counted["hashes"].to_pylist(), counted["counts"].to_pylist(), strict=True):
        values = np.frombuffer(values, np.uint64)
        place = np.minimum(np.searchsorted(values, distinct), len(values) - 1)
        total += np.where(values[place] == distinct, np.frombuffer(counts, np.uint32)[place], 0)
    return pa.Table.from_arrays([wanted["pattern"], pa.array(total[which])], ["pattern", "total"])


def _hash_words(parts: int, lane: int = 0) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = words_of(batch.column("word"), SPACED)
            h = w.hashes(lane)[w.first[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pattern"), pa.array(h.view(np.int64)), pa.array(part_of(h, parts).astype(np.int32))], ["pattern", "hash", "part"])
    return run


_WANTED = "pattern string, hash long, part int"
_PLAIN = "digest binary, start int, end int, value string, patterns array<string>"


def _stand_at(before: np.ndarray, after: np.ndarray, keys: np.ndarray, values: np.ndarray) -> Callable:
    """Plain candidates with one of the words before or after them, one of the keys, or one of the values; all sorted hashes."""
    def among(h: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(wanted):
            return np.zeros(len(h), bool)
        return wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            w = _lowered(batch.column("text"))
            h, doc = w.hashes(), w.doc()
            start, end, keyed, key = _cores(w)
            hit, same = np.zeros(len(h), bool), doc[1:] == doc[:-1]
            hit[1:] |= among(h[:-1], before) & same
            hit[:-1] |= among(h[1:], after) & same
            hit[keyed[among(key, keys)]] = True
            if len(values):
                which, core = _core_hashes(w, start, end)
                hit[which[among(core, values)]] = True
            rows, columns = [], [[], [], [], [], []]
            for d in np.unique(doc[hit]).tolist():
                text = batch.column("text")[d].as_py()
                digest, first = _digest(text.encode()), w.first[d]
                for found in plain_instances(text, np.flatnonzero(hit[first:w.first[d + 1]]).tolist()):
                    rows.append(d)
                    for column, x in zip(columns, (digest, *found), strict=True):
                        column.append(x)
            kinds = (pa.binary(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                ["doc_id", "digest", "start", "end", "value", "patterns"])
    return run


def _fetch(rows: DataFrame, wanted: DataFrame) -> list[DataFrame]:
    """Plain candidates at wanted patterns, or with wanted values (``kind``, ``hash``), with the number of equal rows that have them.

    The driver holds one block of hashes at a time.
    """
    schema, out = f"doc_id {dict(rows.dtypes)['doc_id']}, {_PLAIN}", []
    blocks = wanted.count() // BLOCK + 1
    for block in range(blocks):
        held = wanted.filter(F.pmod(F.hash("hash"), F.lit(blocks)) == block).collect()
        sets = [np.unique(np.array([r["hash"] for r in held if r["kind"] == kind], np.int64).view(np.uint64)) for kind in "LRKV"]
        found = rows.mapInArrow(_stand_at(*sets), schema)
        out.append(found.groupBy(*found.columns).agg(F.count("*").alias("n")))
    return out


def _together(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _unknown(names: DataFrame, known: list[DataFrame]) -> DataFrame:
    return names.join(_together(known), names.columns, "left_anti") if known else names


_NONE = 1e-9  # below any difference that counts, so rounding loses no strong pattern


def trusted_values(
    found: DataFrame, rows: DataFrame, rounds: int | None, threshold: float, support: int,
) -> tuple[DataFrame, DataFrame | None]:
    """Candidate values that the patterns of the seeds, and of the values trusted so far, vouch for.

    Also the plain candidates that were fetched from the texts, if any: all occurrences of trusted ones are there.
    """
    one = found.select(F.explode("instances").alias("i"))
    edges = one.select(
        "i.value", (F.col("i.kind") != "").alias("seed"), (F.col("i.kind") == PRESUMED).alias("presumed"), F.explode("i.patterns").alias("pattern"))
    edges = materialise(edges.groupBy("value", "pattern").agg(
        F.max("seed").alias("seed"), F.max("presumed").alias("presumed"), F.count("*").alias("n")))
    presumed = edges.filter("presumed").select("value").distinct()
    parts = (found.agg(F.sum("bytes")).first()[0] or 0) // PART_BYTES + LEAST_PARTS
    counted = materialise(rows.select("text").mapInArrow(_count_words(parts), _COUNTS))
    strong = 1 - (1 - threshold) ** (1 / 3) - _NONE

    def look_up(wanted: DataFrame) -> DataFrame:
        return wanted.groupBy("part").cogroup(counted.groupBy("part")).applyInArrow(_look_up, _TOTALS)

    def fetched(wanted: DataFrame) -> DataFrame:
        tables = _fetch(rows, wanted) + ([plain] if plain is not None else [])
        same = ["doc_id", "digest", "start", "end", "value", "patterns"]
        return materialise(_together(tables).groupBy(*same).agg(F.max("n").alias("n")))

    def pattern_hashes(patterns: DataFrame) -> DataFrame:
        word = F.substr("pattern", F.lit(3))
        word = F.when(F.col("pattern").startswith("K "), F.concat(F.lit("\0"), word)).otherwise(word)
        return patterns.select("pattern", word.alias("word")).mapInArrow(_hash_words(parts), _WANTED)

    def value_hashes(values: DataFrame) -> DataFrame:
        return values.select(F.col("value").alias("pattern"), F.col("value").alias("word")).mapInArrow(_hash_words(parts, 1), _WANTED)

    def value_totals(values: DataFrame) -> DataFrame:
        whole = values.filter(~F.col("value").rlike(f"^{_KEY.pattern}"))  # a word that starts with a key is not its own value
        words = whole.select(F.col("value").alias("pattern"), F.col("value").alias("word")).mapInArrow(_hash_words(parts), _WANTED)
        return look_up(value_hashes(values).unionByName(words)).groupBy(F.col("pattern").alias("value")).agg(F.sum("total").alias("total"))

    trusted = [edges.filter("seed").select("value").distinct()]
    vouched, totals, sizes, scanned, plain = presumed.limit(0), [], [], [], None
    while rounds is None or len(trusted) <= rounds:
        sure = _together(trusted)
        links = edges.select("value", "pattern", "n")
        if plain is not None:
            links = links.unionByName(plain.select("value", F.explode("patterns").alias("pattern"), "n").groupBy("value", "pattern").agg(F.sum("n").alias("n")))
        able = materialise(links.join(sure, "value").groupBy("pattern").agg(
            F.count("*").alias("values"), F.sum("n").alias("hits")).filter(F.col("values") >= support))
        fresh = _unknown(able.select("pattern"), totals)
        own = edges.join(fresh, "pattern", "left_semi").groupBy("pattern").agg(F.sum("n").alias("own"))
        totals.append(materialise(look_up(pattern_hashes(fresh)).join(own, "pattern", "left").select(
            "pattern", F.greatest("total", F.coalesce("own", F.lit(0))).alias("total"))))
        worth = materialise(able.join(_together(totals), "pattern").select(
            "pattern", (F.col("hits") / (F.greatest("hits", "total") + SMOOTHING)).alias("worth")))
        doubts = F.sum(F.log1p(-F.least("worth", F.lit(0.999)))).alias("doubt")
        doubt = edges.join(worth, "pattern").groupBy("value").agg(doubts)
        vouched = materialise(doubt.filter(1 - F.exp("doubt") >= threshold).select("value"))
        newly = materialise(vouched.join(sure, "value", "left_anti"))

        wanted = materialise(_unknown(worth.filter(F.col("worth") >= strong).select("pattern"), scanned))
        scanned.append(wanted)
        if not wanted.isEmpty():
            plain = fetched(pattern_hashes(wanted).select(F.substr("pattern", F.lit(1), F.lit(1)).alias("kind"), "hash"))
        more = None
        if plain is not None:
            place = ["doc_id", "digest", "start", "value", "n"]
            at = plain.select(*place, F.explode("patterns").alias("pattern")).join(worth, "pattern").groupBy(*place).agg(doubts, F.max("worth").alias("best"))
            at = at.filter(F.col("best") >= strong).withColumn("trust", 1 - F.exp("doubt"))
            mass = at.groupBy("value").agg(F.max("trust").alias("most"), F.sum("n").alias("own"), F.sum(F.col("n") * F.col("trust")).alias("mass"))
            mass = materialise(mass.filter(F.col("most") >= threshold).join(sure, "value", "left_anti"))  # a mean is not above the most
            sizes.append(materialise(value_totals(_unknown(mass.select("value"), sizes))))
            more = materialise(mass.join(_together(sizes), "value").filter(
                F.col("mass") / F.greatest("own", "total") >= threshold).select("value"))
            if more.isEmpty():
                more = None
            else:
                plain = fetched(value_hashes(more).select(F.lit("V").alias("kind"), "hash"))
        if more is None and newly.isEmpty():
            break
        trusted.append(newly if more is None else newly.unionByName(more))
    return _together([vouched.join(presumed, "value", "left_semi"), *trusted[1:]]), plain


def find_pii(
    docs: DataFrame, rounds: int | None = None, threshold: float = THRESHOLD, support: int = SUPPORT, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans``: a row for each row of ``docs``.

    ``base`` and ``spans`` are arrays of ``kind:start:end`` in code points, end exclusive, sorted by start and
    kind; ``spans`` also has what the patterns found, as kind ``id``, never overlapping a base span.  The
    counts are those of base spans.  A null or empty text has none.  Repeated rows count for the patterns as
    often as they occur, but values count once as support.  ``rounds`` can end the search early; without it, it
    ends when no value is newly trusted.  Other columns are ignored; no rows give no rows.
    """
    rows = documents(docs, key, text)
    kind = dict(rows.dtypes)["doc_id"]
    found = materialise(
        rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_find, f"doc_id {kind}, row long, {_FOUND}, bytes long"))
    values, plain = trusted_values(found, rows, rounds, threshold, support)
    span = F.collect_set(F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end"))
    candidates = found.select("row", F.explode("instances").alias("i")).filter(F.col("i.kind").isin("", PRESUMED)).select("row", "i.start", "i.end", "i.value")
    more = candidates.join(values, "value", "left_semi").groupBy("row").agg(span.alias("more"))
    all_rows = found.drop("instances").join(more, "row", "left")
    if plain is None:
        all_rows = all_rows.withColumn("plain", F.lit(None).cast(dict(all_rows.dtypes)["more"]))
    else:  # by id and text: equal rows have equal spans
        fetched = plain.join(values, "value", "left_semi").groupBy(F.col("doc_id").alias("id"), F.col("digest").alias("text")).agg(span.alias("plain"))
        all_rows = all_rows.join(fetched, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("text")), "left")
    parts = F.transform("base", lambda s: F.split(s, ":"))
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    base = F.transform(parts, lambda p: F.struct(p[1].cast("int").alias("start"), rank[p[0]].alias("kind"), p[2].cast("int").alias("end")))
    every = F.sort_array(F.concat(base, *[F.coalesce(c, F.slice(base, 1, 0)) for c in ("more", "plain")]))
    names = F.array(*[F.lit(k) for k in KINDS])
    return all_rows.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base",
        F.transform(every, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])).alias("spans"))
