"""Toxicity, language model and personal data."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from jobmart.llm import language_model, pii, toxicity
from jobmart.llm.queries import QUERIES
from jobmart.llm.words import ALNUM, words_of
from tests.llm.samples import SCHEMA, documents, frame, lower, words

# ---- toxicity ---------------------------------------------------------------------------


def weight(text, model=toxicity.DEFAULT):
    w = words_of(pa.array([text]), ALNUM, lower=True)
    return [float(x[0]) for x in toxicity.clause_weights(w, toxicity._Lookup(list(model.lexicon)), toxicity.grammar())]


@pytest.mark.parametrize(("text", "expected"), [
    ("a fine day", 0), ("an IDIOT here", 4), ("you total idiot", 6), ("idiot you", 4 + 2), ("not an idiot", 1),
    ("she said he is an idiot", 3), ("I kill time", 2), ("I kill you", 2 + 2), ("not a b c idiot", 4),
    ("you are no idiot", 1.5), ("", 0), (None, 0),
])
def test_clause_grammar(text, expected):
    assert weight(text)[0] == pytest.approx(expected)


def test_clauses_are_scored_apart():
    assert weight("never. idiot. scum moron!") == [8, 12]


def test_composition_equals_one_after_the_other():
    parts = [toxicity.scope(4, 3, {1: 0.25, 2: 0.25}), toxicity.scope(3, 4, {1: 1.5}, {2: 0.5}), toxicity.look_back((1, 2), 3, 3, 0.5)]
    follow, output, factor = toxicity.compose(parts, 6)
    rng = random.Random(4)
    for _ in range(200):
        state, own = 0, [0] * 3
        for symbol in [rng.randrange(6) for _ in range(20)]:
            out, times = symbol, 1.0
            for i, part in enumerate(parts):
                own[i], out, w = part.step(own[i], out)
                times *= w
            assert (out, times) == (output[int(state)][symbol], factor[int(state)][symbol])
            state = follow[int(state)][symbol]


def labelled(spark, n=400, seed=3):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        own = [f"v{rng.randrange(3000)}" for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            own[rng.randrange(40)] = "grumblefrotz" + rng.choice(["er", "en", ""])
        docs.append((i, " ".join(own), None, None, None))
        labels.append((i, int(bad)))
    return frame(spark, docs), spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")


def test_learned_words_carry_to_unseen_documents(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs.select("doc_id", "text"), labels.filter("doc_id % 5 != 0"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(0, 400, 5))
    assert toxicity.reject(docs, model, 0.5).count() == 300


GROWING = ["", "you idiot", "you idiot and moron", "you idiot and moron, worthless loser", "you idiot and moron, worthless loser. I will kill you, scum",
           "you idiot and moron, worthless loser. I will kill you, scum. " * 30]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_a_further_match_never_lowers_a_score(spark, sf):
    from jobmart.llm.queries import toxicity_model

    model = toxicity_model(spark, f"/root/testdata/{sf}")
    rows = spark.createDataFrame(list(enumerate(GROWING)), "doc_id int, text string")
    scores = [r["score"] for r in toxicity.score(rows, model).orderBy("doc_id").collect()]
    assert scores == sorted(scores) and scores[1] < scores[4] and min(model.curve[1:]) >= 0


def test_the_curve_never_falls():
    rng = np.random.default_rng(2)
    for _ in range(200):
        most = rng.exponential(2, 40) * (rng.random(40) < 0.5)
        x = np.stack((most, np.log1p(most * rng.uniform(1, 3, 40))), axis=1)
        y = (rng.random(40) < 1 / (1 + np.exp(2 - rng.normal() * x[:, 0]))).astype(float)
        a, b, c = toxicity._fit(x, y)
        assert b >= 0 and c >= 0
        if (a, b, c) != toxicity.DEFAULT.curve:  # no curve nearby with such weights fits better
            near = [(a + d, max(b + e, 0), max(c + f, 0)) for d in (-.05, 0, .05) for e in (-.05, 0, .05) for f in (-.05, 0, .05)]
            assert toxicity._loss(x, y, (a, b, c)) <= min(toxicity._loss(x, y, n) for n in near) + 0.05
    assert toxicity._fit(np.array([[0.0, 0.0], [1.0, 1.0]]), np.array([1.0, 0.0])) == toxicity.DEFAULT.curve


def test_learned_words_against_brute_force(spark):
    """Words of toxic documents beyond chance, counted by hand; repeated and partly changed copies count once."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(300):
        own = [f"w{rng.integers(0, 900)}x" for _ in range(40)]
        if i % 3 == 0:
            own[5:5] = ["zorgling", "w1x"]
        rows.append((i, " ".join(own)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(1000 + i, rows[1][1]) for i in range(50)]
    labels += [(1000 + i, 1) for i in range(50)]  # one text, fifty times: no word of it is learned
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    learned = {(n, h): w for n, h, kind, w in model.lexicon if kind == toxicity.INSULT} | {}
    fixed = {(n, h) for n, h, _, _ in toxicity.fixed_lexicon()}
    texts = {rows[i][1]: labels[i][1] for i in range(300)}
    both = [(set(t.split()), y) for t, y in texts.items()] + [(set(rows[1][1].split()), 1)]
    pos, neg = sum(y for _, y in both), sum(1 - y for _, y in both)
    want = {}
    for word in ("zorgling", "w1x", rows[1][1].split()[0]):
        p, n = sum(word in s for s, y in both if y), sum(word in s for s, y in both if not y)
        h = words_of(pa.array([word]), ALNUM, lower=True).hashes()[0]
        want[word] = (None, int(h)), np.log((p + 0.5) / (pos + 1) / ((n + 0.5) / (neg + 1)))
    assert learned[want["zorgling"][0]] == pytest.approx(want["zorgling"][1])
    assert want[rows[1][1].split()[0]][0] not in set(learned) - fixed
    again = toxicity.train(docs.repartition(2), spark.createDataFrame(labels, "doc_id long, toxic int").repartition(3))
    assert again == model


def test_toxicity_of_awkward_rows(spark):
    got = toxicity.score(frame(spark, clashes=True)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in documents())
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = toxicity.reject(frame(spark, clashes=True), toxicity.DEFAULT)
    assert kept.columns == frame(spark, clashes=True).columns and kept.count() == len(documents())
    none = spark.createDataFrame([], SCHEMA)
    assert toxicity.score(none).collect() == [] == toxicity.reject(none, toxicity.DEFAULT).collect()
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(frame(spark).select("doc_id", "text"), no_labels) == toxicity.DEFAULT


def test_toxicity_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").max("toxic").toDF("doc_id", "toxic")
    rows = QUERIES["op1_toxicity"](spark, folder).filter("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) >= 0.95
    assert not any(r["predicted"] for r in rows if not r["toxic"])


# ---- language model ---------------------------------------------------------------------


def brute_model(texts):
    seqs = [[*words(lower(t)), "</s>"] for t in texts]
    count, pair = Counter(x for s in seqs for x in s), Counter(p for s in seqs for p in zip(["<s>", *s], s))
    context, follow, before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (a, b), n in pair.items():
        context[a] += n
        follow[a][min(n, 3) - 1] += 1
        before[b] += 1
    d, e = ((0, *language_model.discounts(*[sum(n == k for n in c.values()) for k in (1, 2, 3, 4)])) for c in (pair, before))

    def p(a, b):
        spare = sum(e[min(n, 3)] for n in before.values())
        q = (max(before[b] - e[min(before[b], 3)], 0) + spare / (len(count) + 1)) / len(pair) if pair else 1 / (len(count) + 1)
        if context[a]:
            q = (max(pair[a, b] - d[min(pair[a, b], 3)], 0) + sum(x * y for x, y in zip(d[1:], follow[a])) * q) / context[a]
        return q
    return count, p


@pytest.mark.parametrize("flush", [1 << 21, 50])
def test_language_model(spark, flush, monkeypatch):
    monkeypatch.setattr(language_model, "FLUSH", flush)
    rows = documents()
    model = language_model.train(frame(spark, clashes=True).filter("doc_id % 3 > 0"))
    count, p = brute_model([r[1] for r in rows if r[0] is not None and r[0] % 3 > 0])
    total, types = sum(count.values()), len(count)
    assert (model.tokens, model.types) == (total, types)
    assert sum(p("w1", x) for x in [*count, "unseen"]) == pytest.approx(1)
    expected = Counter()
    for r in rows:
        s = [*words(lower(r[1])), "</s>"]
        base, own = sum(math.log10((count[x] + 1) / (total + types + 1)) for x in s), sum(math.log10(p(a, b)) for a, b in zip(["<s>", *s], s))
        expected[r[0], len(s), sum(count[x] > 0 for x in s), round(base, 6), round(own, 6)] += 1
    got = language_model.score(frame(spark, clashes=True), model).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in got) == expected


def test_counts_beyond_a_byte(spark):
    rows = [(i, "a b a b a", None, None, None) for i in range(400)]
    count, p = brute_model([r[1] for r in rows])
    got = language_model.score(frame(spark, rows[:1]), language_model.train(frame(spark, rows))).first()
    s = ["a", "b", "a", "b", "a", "</s>"]
    assert got["score"] == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(["<s>", *s], s)))


def test_language_model_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = language_model.train(none)
    assert language_model.score(none, model).collect() == []
    got = language_model.score(frame(spark, [(1, "a b", None, None, None)]), model).first()
    assert (got["n_tokens"], got["n_known"], got["score"]) == (3, 0, 0.0)


# ---- personal data ----------------------------------------------------------------------

# Fixed patterns of the contract.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = [int(c) for c in text if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        doubled = [x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute_spans(text):
    return sorted((m.start(), k, m.end()) for k, kind in enumerate(PATTERNS) for m in re.finditer(PATTERNS[kind], text or "") if valid(kind, m[0]))


def test_base_spans():
    rng, found = random.Random(1), 0
    for letters in ("a@.-1", "1234. ", "01 -+()", "+12 .-3()", "ab@c.d1_ é|", "0123456789 -"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(45)))
            assert pii.base_spans(text) == brute_spans(text), text
            found += len(brute_spans(text))
    assert found > 1000


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 50_000, "x" * 100_000 + " 1 2-" * 20_000])
def test_long_runs_take_linear_time(text):
    pii.instances(text, pii.base_spans(text))


def test_personal_data_of_awkward_rows(spark):
    rows = [*documents(), (900, "é mail a.b@c.example.com, +1 (555) 123-4567", None, None, None)]
    got = pii.find_pii(frame(spark, rows, clashes=True)).collect()
    name = list(PATTERNS)
    expected = Counter((r[0], ",".join(f"{name[k]}:{a}:{b}" for a, k, b in brute_spans(r[1]))) for r in rows)
    assert Counter((r["doc_id"], ",".join(r["base"])) for r in got) == expected
    assert pii.find_pii(spark.createDataFrame([], SCHEMA)).collect() == []


def test_patterns_discover_unseen_identifiers(spark):
    docs = [(i, f"my contact: user{i}@mail.example.com and more text of day {i}") for i in range(8)]
    docs += [(20, "my contact: qx77-81z and more text"), (21, "we like 12345 apples"), (22, "id=ab-4711 and 99999 text")]
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[20]["spans"] == ["id:12:20"] and got[20]["base"] == []
    assert got[21]["spans"] == [] and got[22]["spans"] == []
    assert all(got[i]["spans"] == got[i]["base"] for i in range(8))


def brute_trusted(texts, threshold=pii.THRESHOLD, support=pii.SUPPORT):
    """Values that become trusted, by the definition, from all words of all texts."""
    tokens = [t.lower().split() for t in texts]
    words, edges, trusted = Counter(w for t in tokens for w in t), Counter(), set()
    for t in tokens:
        for i, w in enumerate(t):
            if any(c.isdigit() for c in w) and len(w) >= pii.LEAST_LENGTH:
                edges.update((w, p) for p in [*[("L", x) for x in t[i - 1:i]], *[("R", x) for x in t[i + 1:i + 2]]])
                if "@" in w:
                    trusted.add(w)
    seeds = set(trusted)
    while True:
        worth = {}
        for p in {p for _, p in edges}:
            at = [(w, n) for (w, q), n in edges.items() if p == q and w in trusted]
            if len(at) >= support:
                worth[p] = sum(n for _, n in at) / (words[p[1]] + pii.SMOOTHING)
        apart = defaultdict(lambda: 1.0)
        for w, p in edges:
            apart[w] *= 1 - min(worth.get(p, 0), 0.999)
        new = {w for w, x in apart.items() if 1 - x >= threshold} - trusted
        if not new:
            return trusted - seeds
        trusted |= new


def test_trusted_values_bring_new_patterns(spark):
    texts = [f"{word} user{i}@mail.example.com" for i in range(40) for word in ("badge:", "step0")]
    texts += [f"badge: emp-{100 + i}" for i in range(5)] + [f"staff emp-{100 + i}" for i in range(5) for _ in range(10)]
    texts += ["staff zx-99812", "shelf zx-99812", "shelf zx-99813", *[f"we like {i}12345 apples" for i in range(12)]]
    for hop in range(7):  # each step is only reached from the one before
        texts += [f"step{hop} n{hop}-{i:04}" for i in range(5) for _ in range(10) if hop]
        texts += [f"step{hop} n{hop + 1}-{i:04}" for i in range(5)]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = {texts[i][int(a):int(b)] for i, r in got.items() for kind, a, b in (x.split(":") for x in r["spans"]) if kind == "id"}
    assert found == brute_trusted(texts)
    assert {"zx-99812", "n7-0004"} <= found and "zx-99813" not in found


def brute_values(texts, threshold=pii.THRESHOLD, support=pii.SUPPORT):
    """Trusted values of any characters: every occurrence of every value with its patterns, in one list."""
    found, words, keys, sizes, seeds = [], Counter(), Counter(), Counter(), set()
    for text in texts:
        tokens = text.lower().split()
        words.update(tokens)
        for i, token in enumerate(tokens):
            key = re.match(r"([a-z_][a-z0-9_-]*)[=:]+(?=.)", token)
            value = (token[key.end():] if key else token).strip(pii._EDGE)
            keys.update([key[1]] if key else [])
            if value:
                patterns = [("K", key[1])] if key else []
                found.append((value, patterns + [("L", x) for x in tokens[i - 1:i]] + [("R", x) for x in tokens[i + 1:i + 2]]))
                sizes[value] += 1
                if "@" in value:
                    seeds.add(value)
    trusted, strong = set(seeds), 1 - (1 - threshold) ** (1 / 3)
    while True:
        at = defaultdict(list)
        for value, patterns in found:
            for p in patterns if value in trusted else []:
                at[p].append(value)
        worth = {p: len(v) / ((keys if p[0] == "K" else words)[p[1]] + pii.SMOOTHING) for p, v in at.items() if len(set(v)) >= support}
        shaped, mass = defaultdict(set), Counter()
        for value, patterns in found:
            shaped[value].update(patterns)
            if max([worth.get(p, 0) for p in patterns], default=0) >= strong:
                mass[value] += 1 - math.prod(1 - min(worth.get(p, 0), 0.999) for p in patterns)
        trust = {v: 1 - math.prod(1 - min(worth.get(p, 0), 0.999) for p in ps) if len(v) >= pii.LEAST_LENGTH and re.search("[0-9]", v) else mass[v] / sizes[v]
                 for v, ps in shaped.items()}
        new = {v for v, x in trust.items() if x >= threshold} - trusted
        if not new:
            return trusted - seeds
        trusted |= new


def test_any_characters_can_be_found(spark, monkeypatch):
    monkeypatch.setattr(pii, "BLOCK", 3)
    texts = [text.format(f"u{i}@mail.example.com") for i in range(600) for text in ("my contact: {}", "the day user={}", "LOGIN: {} signed")]
    texts += ["my contact: maria.k(at)example.com", "my contact: (A17)", "login: 7", "Étage 5", "no name here", ""]
    texts += ["login: the", "my contact: the", "we have 7 of the 12345 apples and the pears of the day"] * 2  # common words are no names
    names = ["kowalski", "Émilie", *("nowak" + c for c in "abcdefgh")]
    texts += [f"Login: {name}, signed" for name in names for _ in range(20)] + ["the day user=kowalski"]
    texts += [f"seat {name}" for name in ("ÉMILIE" if n == "Émilie" else n for n in names) for _ in range(3)] + ["seat 12-345"]
    rows = [*enumerate(texts), (None, "seat lee"), (None, "seat lee"), (None, None), (0, texts[0])]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = brute_values([t for _, t in rows if t])
    assert {"maria.k(at)example.com", "a17", "kowalski", "nowaka", "émilie", "lee", "12-345"} <= expected and not {"the", "7", "of"} & expected
    assert len(got) == len(rows)
    by_id = defaultdict(list)
    for i, t in rows:
        by_id[i].append(t)
    spans = Counter()
    for r in got:
        text = by_id[r["doc_id"]][0] if r["doc_id"] is not None else "seat lee"
        cut = [text[int(a):int(b)].lower() for kind, a, b in (x.split(":") for x in r["spans"]) if kind == "id"]
        spans.update(cut)
        assert len(cut) == len(r["spans"]) - len(r["base"])
    values = Counter(v for _, t in rows for x in (t or "").split() if "@" not in x for v in [re.sub("^user=", "", x.lower()).strip(pii._EDGE)])
    assert spans == Counter({v: values[v] for v in expected})


def test_keys_and_values_of_words_are_those_of_tokens():
    rng, pieces = random.Random(9), ["key", '"Key"', "=", ":", "==", "a=b", 'a="b c"', '"x1"###', "'", "''", '""', '"=', "é", "K:", "user=", "x", "(y_2)", ": =", '`q`.', "-"]
    texts = [rng.choice(["", " "]).join(rng.choices([*pieces, " ", "  "], k=rng.randrange(12))) for _ in range(3000)] + [""]
    w = pii._lowered(pa.array(texts, pa.large_string()))
    start, end, keyed, keys = pii._cores(w)
    got = defaultdict(list)
    for i, k in zip(keyed.tolist(), keys.tolist(), strict=True):
        got[i].append(k)
    i = 0
    for text in (t.lower() for t in texts):
        tokens = [m.span() for m in pii._TOKEN.finditer(text)]
        for t in range(len(tokens)):
            _, core, key = pii._core(text, tokens, t)
            assert w.data[start[i]:end[i]].tobytes().decode() == core, (text, t)
            expected = [] if key is None else words_of(pa.array(["\0" + key], pa.large_string())).hashes().tolist()
            assert got[i] == expected, (text, t)
            i += 1
    assert i == len(start)


def planted(texts, seed=12):
    """The texts with identifiers behind keys that repeat, no value twice, and (row, start, end) of those that no base pattern matches."""
    rng, out, places = random.Random(seed), [], set()
    for d, text in enumerate(texts):
        words = (text or "").split(" ")
        if d % 3 == 0:
            letters = "".join(rng.choices("abcdefghijklm", k=9))
            left, value, right = [
                ('contact = "', f"{letters}@mail.example.com", '"'), ("Contact : ", f"{letters}(at)example", ""), ('"contact" : "', f"{letters[:3]}-{d:05}", '",'),
                ("api_key = '", f"{rng.getrandbits(160):040x}", "'"), ('api_key = "', f"k{d:05}", '"'), ('secret="', f"{rng.getrandbits(128):032x}", '"###')][
                    rng.choices(range(6), [8, 1, 1, 8, 1, 4])[0]]
            at = rng.randrange(len(words) + 1)
            before = " ".join(words[:at])
            start = len(before) + (at > 0) + len(left)
            if "@" not in value:
                places.add((d, start, start + len(value)))
            words.insert(at, left + value + right)
        out.append(" ".join(words))
    return out, places


def test_planted_identifiers_are_found(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    texts, places = planted([r["text"] for r in rows])
    got = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {(r["doc_id"], int(a), int(b)) for r in got for kind, a, b in (x.split(":") for x in r["spans"]) if kind == "id"}
    others = {texts[d][a:b] for d, a, b in found - places}  # the table has secrets of its own
    assert len(places) > 150 and len(found & places) >= 0.9 * len(places)
    assert all(re.fullmatch("[0-9a-f]{40}", x) for x in others)


def test_presumed_secrets_need_a_context(spark):
    secrets = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(23)]
    texts = [f'{i:02} token = "{s}" y{i}' for i, s in enumerate(secrets[:20])] + ["z token : short-7 z"]
    texts += [f"seen once {secrets[20]}", f"note = {secrets[21]} once", f"note = {secrets[22]} twice", *["note = nothing of this kind"] * 40]
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [len(got[i]["spans"]) for i in range(len(texts))] == [1] * 21 + [0] * (len(texts) - 21)
    assert got[0]["spans"] == ["id:12:52"] and got[20]["spans"] == ["id:10:17"]


def test_personal_data_query(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    name = list(PATTERNS)
    for r in QUERIES["op10_pii"](spark, folder).collect():
        spans = brute_spans(texts[r["doc_id"]])
        base = ",".join(f"{name[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == np.bincount([k for _, k, _ in spans], minlength=4).tolist()
