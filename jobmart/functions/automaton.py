"""All keywords of a list in a text at once: an Aho-Corasick automaton in arrays.

The keywords make a trie; each node's fall-back is the node of its longest proper ending that is in the trie,
and filling the missing arcs with those of the fall-back gives one table ``next[state, class]``.  Characters that
no keyword has share a class that leads back to the start.

Texts are scanned side by side: a batch is one array of code points, cut into segments that overlap by
the longest keyword, and each step moves all segments by one character.  The work per character does
not depend on the number of keywords.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Send the Python functions of this module to executors by value: they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT = 256
#: Characters that are scanned at the same time, unless one text has more.
SCANNED_AT_ONCE = 1 << 20
#: Entries of the table ``next`` that one automaton may have (four bytes each).
MOST_ENTRIES = 1 << 24

ANY, NO_WORD, A_WORD = 0, 1, 2  # what must stand next to a keyword


def is_word(ch: str) -> bool:
    """Letters, marks and digits of any script, and the underscore."""
    return ch == "_" or unicodedata.category(ch)[0] in "LMN"


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, a 0 before and after each, and where each text begins."""
    joined = "\0" + "\0".join(texts) + "\0"
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), np.concatenate(([0], np.cumsum(lengths)))[:-1] + 1


@dataclass(frozen=True)
class Automaton:
    classes: np.ndarray  # of each code point up to the largest in a keyword; 0 beyond
    width: int
    follow: np.ndarray  # next state times width, by state times width plus class
    first: np.ndarray  # where each state's keywords begin in ``ending``, and the end
    ending: np.ndarray
    lengths: np.ndarray
    before: np.ndarray
    after: np.ndarray

    def occurrences(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, keyword) of every occurrence, also of those inside others."""
        overlap = max(int(self.lengths.max(initial=1)) - 1, 0)
        kinds = self.classes[np.minimum(codes, np.uint32(len(self.classes) - 1))]
        segments = -(-len(kinds) // SEGMENT)
        padded = np.zeros(overlap + segments * SEGMENT, dtype=kinds.dtype)
        padded[overlap:overlap + len(kinds)] = kinds
        size = padded.itemsize
        steps = np.lib.stride_tricks.as_strided(padded, (overlap + SEGMENT, segments), (size, SEGMENT * size))
        state, has = np.zeros(segments, dtype=np.int32), np.zeros(len(self.follow), dtype=bool)
        has[::self.width] = np.diff(self.first) > 0
        ends, found = [], []
        for i in range(overlap + SEGMENT):
            np.add(state, steps[i], out=state)
            state = self.follow.take(state)
            if i >= overlap and len(hit := np.flatnonzero(has.take(state))):
                ends.append(hit * SEGMENT + (i - overlap))
                found.append(state[hit])
        states = np.concatenate([np.empty(0, np.int32), *found]) // self.width
        end = np.concatenate([np.empty(0, np.int64), *ends])
        counts = self.first[states + 1] - self.first[states]
        ahead = np.repeat(np.cumsum(counts) - counts, counts)
        keyword = self.ending[np.repeat(self.first[states], counts) + np.arange(len(ahead)) - ahead]
        return np.repeat(end, counts) - self.lengths[keyword] + 1, keyword

    def find(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, keyword, place in the text) of the occurrences with the right neighbours, by text and place."""
        none = (np.empty(0, np.int64),) * 3
        return tuple(map(np.concatenate, zip(none, *self.find_by_blocks(texts))))

    def find_by_blocks(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same for some texts after the other: a scan takes many times their size in memory."""
        start = size = 0
        for i, text in enumerate(texts):
            if size and size + len(text) > SCANNED_AT_ONCE:
                of, keyword, at = self._find(texts[start:i])
                yield of + start, keyword, at
                start, size = i, 0
            size += len(text) + 1
        if size:
            of, keyword, at = self._find(texts[start:])
            yield of + start, keyword, at

    def _find(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, begin = code_points(texts)
        at, keyword = self.occurrences(codes)
        ok = np.ones(len(at), dtype=bool)
        for need, beside in ((self.before, codes[at - 1]), (self.after, codes[at + self.lengths[keyword]])):
            letters, where = np.unique(beside, return_inverse=True)
            word = np.array([is_word(chr(c)) for c in letters.tolist()], dtype=bool)[where] if len(letters) else np.empty(0, bool)
            ok &= (need[keyword] == ANY) | ((need[keyword] == A_WORD) == word)
        at, keyword = at[ok], keyword[ok]
        text = np.searchsorted(begin, at, side="right") - 1
        order = np.lexsort((keyword, at))
        return text[order], keyword[order], (at - begin[text])[order]


def build(keywords: Sequence[str], before: Sequence[int] | None = None, after: Sequence[int] | None = None) -> Automaton:
    """The automaton of ``keywords`` (not empty), and what must stand before and after each (default: anything)."""
    if any(not k for k in keywords):
        raise ValueError("keywords must not be empty")
    alphabet = sorted({ord(c) for k in keywords for c in k})
    classes = np.zeros((alphabet[-1] if alphabet else 0) + 2, dtype=np.uint8 if len(alphabet) < 256 else np.int32)
    classes[alphabet] = np.arange(1, len(alphabet) + 1)
    children: list[dict[int, int]] = [{}]
    own: list[list[int]] = [[]]
    for i, word in enumerate(keywords):
        node = 0
        for c in word:
            kind = int(classes[ord(c)])
            if kind not in children[node]:
                children[node][kind] = len(children)
                children.append({})
                own.append([])
            node = children[node][kind]
        own[node].append(i)
    width = len(alphabet) + 1
    follow = np.zeros((len(children), width), dtype=np.int32)
    fall, queue = [0] * len(children), deque()
    for kind, child in children[0].items():
        follow[0, kind] = child
        queue.append(child)
    while queue:  # in order of depth: a fall-back is complete before it is needed
        node = queue.popleft()
        own[node] = own[node] + own[fall[node]]
        follow[node] = follow[fall[node]]
        for kind, child in children[node].items():
            fall[child] = int(follow[fall[node], kind])
            follow[node, kind] = child
            queue.append(child)
    some = lambda needs: np.array([ANY] * len(keywords) if needs is None else list(needs), dtype=np.int8)
    return Automaton(
        classes, width, (follow * width).ravel(), np.concatenate(([0], np.cumsum([len(x) for x in own]))),
        np.array([k for x in own for k in x], dtype=np.int64), np.array([len(k) for k in keywords], dtype=np.int64), some(before), some(after))


def keyword_list(text: Column, keywords: Sequence[str], before: Sequence[int], after: Sequence[int]) -> Column:
    """The keywords that the lower-cased ``text`` has, as given and in the order of the list."""
    lowered = [k.lower() for k in keywords]

    @F.pandas_udf("array<string>")
    def listed(values: pd.Series) -> pd.Series:
        found = build(lowered, before, after)
        out: list[list[str]] = [[] for _ in range(len(values))]
        for text, keyword, _ in found.find_by_blocks(values.fillna("").tolist()):
            for pair in np.unique(text * len(lowered) + keyword).tolist():
                out[pair // len(lowered)].append(keywords[pair % len(lowered)])
        return pd.Series(out, index=values.index, dtype=object)

    return listed(text)
