"""Jaccard self-join of documents on word n-grams by vertical partitioning.

The n-grams have one global order (by hash), which is cut into fragments at fixed hashes.

1. Documents with equal sets form a class; one row of each class goes on.
2. Document frequencies: every chunk sends its distinct n-grams, packed, to the fragment they belong to; each
   fragment adds up and answers, with one bit for each n-gram, which occur in more than one document and how
   often.  An n-gram of one document adds nothing to any overlap and goes no further.
3. Prefixes: documents that reach the threshold share one of their first ``size - ceil(threshold * size) + 1``
   n-grams, rarest first.  So candidates are lists of documents with a common rare n-gram; lists with the same
   members are kept once.
4. Overlaps: lists are cut into blocks of about ``BLOCK`` documents.  In every fragment on its own, the partial
   overlaps of the pairs in a block are counted; they travel as one packed row and are summed per pair.  Pairs
   that reach the threshold are links, of which a block reports a spanning forest.
5. Long lists: first every document meets two random blocks of its list, which joins nearly all of a group of
   near copies.  Then only what may still be missing is compared: members outside the list's largest
   component against each other and against that component, block by block.  No list is cut short, and the
   components are those of all links.

``links`` returns the links themselves instead of components: there every pair of a list meets in a block, so a list
of m classes costs about m * m comparisons, as many as it may have links.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.chunks import arrow_table, chunk_of, count_chunks, dealt, in_order, joined, slices
from jobmart.llm.common import documents
from jobmart.llm.components import components
from jobmart.llm.words import SPACED, mix, rolling, words_of
from jobmart.scratch import materialise

SHINGLE, PERCENT = 5, 80
BLOCK = 256
FRAGMENTS = 4
MEMBERS_PER_TASK_GROUP = 2048
SALTS = 16

_SIGNED = "chunk int, place int, size int, one long, two long"
_SENT = "part int, chunk int, grams binary, counts binary"
_ANSWER = "chunk int, part int, shared binary, freqs binary, place int"
_CANDIDATE = "node long, size int, prefix array<long>, segments array<binary>"
_PARTIAL = "group int, block long, nodes binary, sizes binary, counts binary"
_LINKS = "a long, b long"


def _sets(texts: pa.ChunkedArray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each document, one after the other, and where each begins."""
    w = words_of(texts, SPACED, lower=True)
    h, n = w.hashes(), w.counts()
    doc, at = w.doc(), np.arange(len(h))
    grams, owners = [], []
    for k in range(1, shingle + 1):  # shorter texts are one n-gram as a whole
        own = (at + k <= w.first[1:][doc]) & (n[doc] >= shingle if k == shingle else (n[doc] == k) & (at == w.first[:-1][doc]))
        own = np.flatnonzero(own)
        if len(own):
            grams.append(rolling(h, k)[own])
            owners.append(doc[own])
    if not grams:
        return np.empty(0, np.uint64), np.zeros(w.n_docs + 1, np.int64)
    order = np.argsort(np.concatenate(owners), kind="stable")
    values, owner = np.concatenate(grams)[order], np.concatenate(owners)[order]
    edges = np.searchsorted(owner, np.arange(w.n_docs + 1))
    for a, b in zip(edges, edges[1:], strict=False):
        values[a:b].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.searchsorted(owner[new], np.arange(w.n_docs + 1))


def _sign(shingle: int) -> Callable:
    """Size and digest of every document's set."""
    def run(key: tuple, chunk: pa.Table) -> pa.Table:
        rows = in_order(chunk)
        values, first = _sets(rows["text"], shingle)
        sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(salt)), dtype=np.uint64))) for salt in (0x51ED2701, 0x2545F491)]
        one, two = ((s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums)
        n = rows.num_rows
        return pa.Table.from_arrays(
            [rows["doc_id"], pa.array(np.full(n, key[0].as_py(), np.int32)), pa.array(np.arange(n, dtype=np.int32)),
             pa.array(np.diff(first).astype(np.int32)), pa.array(one), pa.array(two)],
            ["doc_id", "chunk", "place", "size", "one", "two"])
    return run


def _chosen(chunk: pa.Table, places: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, n-grams and offsets of the documents that stand for their class."""
    places = np.sort(places)
    values, first = _sets(in_order(chunk)["text"].take(pa.array(places)), shingle)
    return places, values, first


def _send(shingle: int, bits: int) -> Callable:
    """Distinct n-grams of the chunk with their number of documents, by fragment: 48 bits of the hash."""
    def run(key: tuple, chunk: pa.Table, chosen: pa.Table) -> pa.Table:
        if not chosen.num_rows:
            return arrow_table(_SENT, [])
        _, values, _ = _chosen(chunk, chosen["place"].to_numpy(), shingle)
        grams, counts = np.unique(values >> np.uint64(16), return_counts=True)
        counts = np.minimum(counts, 65535).astype(np.uint16)
        rest = (grams & np.uint64((1 << (48 - bits)) - 1)).view(np.uint8).reshape(-1, 8)[:, :5]
        return arrow_table(_SENT, [
            (p, key[0].as_py(), rest[a:b].tobytes(), counts[a:b].tobytes()) for p, a, b in slices((grams >> np.uint64(48 - bits)).astype(np.int64))])
    return run


def _add_up(key: tuple, rows: pa.Table) -> pa.Table:
    raw, sizes = joined(rows["grams"], "u1")
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = raw.reshape(-1, 5)
    counts = joined(rows["counts"], "u2")[0]
    distinct, which = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
    total = np.minimum(np.bincount(which, weights=counts, minlength=len(distinct)), 2**32 - 1).astype(np.uint32)[which]
    ends, out = np.cumsum(sizes // 5), []
    for chunk, n, end in zip(rows["chunk"].to_pylist(), sizes // 5, ends, strict=True):
        own = total[end - n:end]
        shared = own >= 2
        out.append((chunk, key[0].as_py(), np.packbits(shared).tobytes(), own[shared].tobytes(), None))
    return arrow_table(_ANSWER, out)


def _candidates(shingle: int, percent: int, bits: int) -> Callable:
    """Of each document with a shared n-gram in its prefix: that part of the prefix, and all shared n-grams by fragment."""
    def run(key: tuple, chunk: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.to_pydict()
        places = np.array([p for p in answers["place"] if p is not None], dtype=np.int64)
        if not len(places):
            return arrow_table(_CANDIDATE, [])
        places, values, first = _chosen(chunk, places, shingle)
        short = values >> np.uint64(16)
        grams, where = np.unique(short, return_inverse=True)
        freq = np.ones(len(grams), np.int64)
        by_part = {p: (s, f) for p, s, f in zip(answers["part"], answers["shared"], answers["freqs"], strict=True) if p is not None}
        for p, a, b in slices((grams >> np.uint64(48 - bits)).astype(np.int64)):
            shared = np.unpackbits(np.frombuffer(by_part[p][0], np.uint8))[:b - a].astype(bool)
            freq[a:b][shared] = np.frombuffer(by_part[p][1], np.uint32)
        freq, size = freq[where], np.diff(first)
        doc = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((values, freq, doc))  # stays within each document
        rank = np.arange(len(values)) - first[:-1][doc]
        ahead = size - (size * percent + 99) // 100 + 1
        in_prefix = order[(rank < ahead[doc]) & (freq[order] >= 2)]
        shared, out = freq >= 2, []
        cuts = np.arange(1, FRAGMENTS, dtype=np.uint64) << np.uint64(64 - FRAGMENTS.bit_length() + 1)
        for d, a, b in slices(doc[in_prefix]):
            own = values[first[d]:first[d + 1]][shared[first[d]:first[d + 1]]]
            ends = [0, *np.searchsorted(own, cuts).tolist(), len(own)]
            out.append((
                (key[0].as_py() << 32) + int(places[d]), int(size[d]), values[in_prefix[a:b]].view(np.int64).tolist(),
                [own[i:j].tobytes() for i, j in zip(ends, ends[1:], strict=False)]))
        return arrow_table(_CANDIDATE, out)
    return run


def _partial(key: tuple, rows: pa.Table) -> pa.Table:
    """Overlaps within one fragment for all pairs of each block, packed."""
    rows, out = rows.sort_by([("block", "ascending"), ("node", "ascending")]), []
    blocks, nodes, sizes = (rows[c].to_numpy() for c in ("block", "node", "size"))
    grams, lengths = joined(rows["segment"], "u8")
    ends = np.cumsum(lengths)
    for block, a, b in slices(blocks):
        own = grams[ends[a] - lengths[a]:ends[b - 1]]
        distinct, which = np.unique(own, return_inverse=True)
        has = np.zeros((b - a, len(distinct)), np.float32)
        has[np.repeat(np.arange(b - a), lengths[a:b]), which] = 1
        out.append((key[0].as_py(), block, nodes[a:b].tobytes(), sizes[a:b].tobytes(), (has @ has.T).astype(np.uint32).tobytes()))
    return arrow_table(_PARTIAL, out)


def _sum_up(percent: int, every: bool) -> Callable:
    """Adds the fragments' overlaps per pair; every link of each block, or a spanning forest of them."""
    def run(_: tuple, rows: pa.Table) -> pa.Table:
        rows, links, ends = rows.sort_by("block"), [], [np.empty((2, 0), np.int64)]
        counts = rows["counts"].to_pylist()
        for _, a, b in slices(rows["block"].to_numpy()):
            nodes = np.frombuffer(rows["nodes"][a].as_py(), np.int64)
            sizes = np.frombuffer(rows["sizes"][a].as_py(), np.int32).astype(np.int64)
            both = sum(np.frombuffer(c, np.uint32).astype(np.int64) for c in counts[a:b]).reshape(len(nodes), -1)
            linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
            if every:
                ends.append(nodes[np.stack(np.nonzero(np.triu(linked, 1)))])
                continue
            left = np.ones(len(nodes), dtype=bool)
            for root in range(len(nodes)):
                if left[root]:
                    left[root], front = False, [root]
                    while front:
                        met = np.flatnonzero(linked[front].any(axis=0) & left)
                        left[met], front = False, met.tolist()
                        links += [(int(nodes[root]), int(nodes[i])) for i in met]
        return pa.Table.from_arrays([pa.array(x) for x in np.concatenate(ends, axis=1)], ["a", "b"]) if every else arrow_table(_LINKS, links)
    return run


def _links(members: DataFrame, candidates: DataFrame, percent: int, every: bool = False) -> DataFrame:
    """Links found in blocks; ``members``: block (a 64-bit number) and node."""
    members = materialise(members)
    groups = members.count() // MEMBERS_PER_TASK_GROUP + 16
    segments = candidates.select("node", "size", F.posexplode("segments").alias("fragment", "segment"))
    rows = members.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")).join(segments, "node")
    partial = rows.groupBy("group", "fragment").applyInArrow(_partial, _PARTIAL)
    return materialise(partial.groupBy("group").applyInArrow(_sum_up(percent, every), _LINKS).distinct())


def _block(*parts: Column | str) -> Column:
    return F.xxhash64(*parts).alias("block")


def _near(lists: DataFrame) -> DataFrame:
    """Short lists as one block; in long lists every document is in two blocks."""
    blocks = F.ceil(F.col("members") / BLOCK)
    one = lists.filter(F.col("members") <= BLOCK).select(_block("gram"), "node")
    some = lists.filter(F.col("members") > BLOCK)
    for side in (1, 2):
        one = one.unionByName(some.select(_block("gram", F.lit(side), F.pmod(F.xxhash64("node", F.lit(side)), blocks)), "node"))
    return one


def _whole(lists: DataFrame) -> DataFrame:
    """Blocks in which every pair of a list meets: a long list is cut into parts, and each two parts are a block."""
    one = lists.filter(F.col("members") <= BLOCK).select(_block("gram"), "node")
    some = lists.filter(F.col("members") > BLOCK).withColumn("cuts", F.ceil(F.col("members") * 2 / BLOCK))
    some = some.repartition("gram", F.pmod(F.xxhash64("node"), F.lit(SALTS)))  # a long list is dealt to several tasks
    at = some.select("gram", "node", F.pmod(F.xxhash64("node", F.lit(3)), "cuts").alias("at"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("other"))
    return one.unionByName(at.select(_block("gram", F.lit(5), F.least("at", "other"), F.greatest("at", "other")), "node"))


def _missing(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Blocks of the pairs of long lists that are in different components, given those found so far."""
    some = lists.filter(F.col("members") > BLOCK).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = some.groupBy("gram", "root").count()
    largest = sizes.groupBy("gram").agg(
        F.max(F.struct("count", "root")).alias("top"), F.sum("count").alias("all")
    ).filter(F.col("top.count") < F.col("all")).select(
        "gram", F.col("top.root").alias("top"), F.ceil(F.col("top.count") * 2 / BLOCK).alias("inner"),
        F.ceil((F.col("all") - F.col("top.count")) * 2 / BLOCK).alias("outer"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    salted = some.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))  # a long list is dealt to several tasks
    rows = salted.join(largest, ["gram", "salt"]).withColumn("inside", F.col("root") == F.col("top"))
    at = lambda n: F.pmod(F.xxhash64("node", F.lit(3)), F.col(n)).alias("at")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias("other")
    inner = rows.filter("inside").select("gram", "node", at("inner"), upto("outer"))
    outer = rows.filter("not inside").select("gram", "node", "inner", "outer", at("outer"))
    across = inner.select(_block("gram", F.lit(4), "at", "other"), "node").unionByName(
        outer.select("gram", "node", "at", upto("inner")).select(_block("gram", F.lit(4), "other", "at"), "node"))
    return across.unionByName(
        outer.select("gram", "node", "at", upto("outer")).select(_block("gram", F.lit(5), F.least("at", "other"), F.greatest("at", "other")), "node"))


def _least() -> Column:
    """The row with the least id; a null id comes last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "chunk", "place"))


def _prepared(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, int]:
    """All rows with their class (``doc_id, chunk, place, size, one, two``); the classes with the node that
    stands for each; the candidates; their lists; the number of chunks."""
    chunks = count_chunks(docs)
    bits = max(8, (chunks - 1).bit_length())
    texts = dealt(docs, chunks)
    kind = dict(docs.dtypes)["doc_id"]
    signed = materialise(texts.groupBy("chunk").applyInArrow(_sign(shingle), f"doc_id {kind}, {_SIGNED}"))
    classes = materialise(
        signed.filter("size > 0").groupBy("size", "one", "two").agg(_least().alias("stands"))
        .select("size", "one", "two", "stands.doc_id", "stands.chunk", "stands.place"))
    chosen = classes.select("chunk", "place")
    sent = texts.groupBy("chunk").cogroup(chosen.groupBy("chunk")).applyInArrow(_send(shingle, bits), _SENT)
    answers = sent.groupBy("part").applyInArrow(_add_up, _ANSWER)
    whole = answers.unionByName(chosen, allowMissingColumns=True)
    candidates = materialise(
        texts.groupBy("chunk").cogroup(whole.groupBy("chunk")).applyInArrow(_candidates(shingle, percent, bits), _CANDIDATE))
    postings = candidates.select("node", F.explode("prefix").alias("gram"))
    distinct = (
        postings.groupBy("gram").agg(F.count("*").alias("members"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who")).filter("members > 1")
        .groupBy("members", "who").agg(F.min("gram").alias("gram")).select("gram", "members"))
    lists = materialise(postings.join(distinct, "gram"))
    node = F.shiftleft(F.col("chunk").cast("long"), 32) + F.col("place")
    return signed, classes.withColumn("node", node), candidates, lists, chunks


def _classes(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame, int]:
    """All rows with their class; the classes with their node and its component (``root``); the number of chunks."""
    signed, classes, candidates, lists, chunks = _prepared(docs, shingle, percent)
    links = _links(_near(lists), candidates, percent)
    roots = components(links)
    more = _links(_missing(lists, roots), candidates, percent)
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return signed, classes, chunks


def ngram_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: the least id that a document reaches by links, its own included.

    Two documents link if ``100 * intersection >= percent * union`` of their sets of lower-cased (A-Z) word
    n-grams.  A text with fewer words is one n-gram as a whole.  A null text or one without words has no
    n-gram and links with nothing.  Repeated rows and copies are one class, and their rows all come back; a
    null id is never the least.  An empty table gives no rows; other columns are ignored.

    Sets are compared by 64-bit hashes, classes by 128 bits.
    """
    signed, classes, _ = _classes(documents(docs, key, text), shingle, percent)
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = classes.select("size", "one", "two", "root").join(least, "root").drop("root")
    found = signed.join(known, ["size", "one", "two"], "left")
    return found.select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def links(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Every link, between classes of equal sets: ``a, b`` (class numbers, a < b, each pair once), and the rows'
    membership: ``doc_id, class_id, n_links``.

    ``n_links`` counts the other rows that a row links with, those of its own class included; copies are not
    expanded into pairs.  A row without words has a null class and no link.  Links and the treatment of nulls,
    repeated rows, empty tables and other columns are those of ``ngram_components``.  The numbers of the
    classes hold within one result.
    """
    signed, classes, candidates, lists, _ = _prepared(documents(docs, key, text), shingle, percent)
    pairs = _links(_whole(lists), candidates, percent, every=True)
    same = ["size", "one", "two"]
    sizes = signed.filter("size > 0").groupBy(*same).agg(F.count("*").alias("n"))
    sized = materialise(classes.select(*same, "node").join(sizes, same))
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = ends.join(sized.select(F.col("node").alias("b"), "n"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    known = sized.join(counted, "node", "left").select(
        *same, F.col("node").alias("class_id"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    members = signed.join(known, same, "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return pairs, members


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the least id.  Columns stay as they are."""
    signed, classes, chunks = _classes(documents(docs), shingle, percent)
    stay = classes.groupBy("root").agg(_least().alias("s")).select("s.chunk", "s.place")
    stay = stay.unionByName(signed.filter("size = 0").select("chunk", "place"))
    own = ("doc_id", "text")
    names = [c if c in own else f"d_{i}" for i, c in enumerate(docs.columns)]
    whole = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])

    def pick(_: tuple, rows: pa.Table, places: pa.Table) -> pa.Table:
        return in_order(rows).drop_columns(["chunk"]).take(places["place"].combine_chunks())

    kept = whole.withColumn("chunk", chunk_of(chunks)).groupBy("chunk").cogroup(stay.groupBy("chunk")).applyInArrow(pick, whole.schema)
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
