"""Periodic runs of words, by all tandem repeats of a text (Gusfield and Stoye's method).

A run is a stretch of words with smallest period q, of at least LEAST words and TIMES
periods, that no neighbour extends. Of every text:

1. Words of a run begin a stretch of GRAM words that the text has more than once, as it
   stands a period further on or back. Parts of the text without such stretches hold no
   run; each maximal part made of them is searched on its own, which changes nothing.
2. Stretches of 1, 2, 4, 8 ... words get numbers by doubling. They sort the suffixes, and
   tell how far two places agree, forwards and backwards, in a logarithm of steps.
3. The Lempel-Ziv blocks of the part give squares (words twice in a row) that cover the leftmost occurrence
   of every kind of square: one comparison forwards and one backwards for each block and period. Squares of squares are left out.
4. In the suffix tree each is marked, and walks over suffix links turn it by one word at a time, as long as
   the tree has the turned one and it is new. Then all kinds of squares are marked.
5. The leaves below a mark are a square's occurrences; those of one period at consecutive
   places are a run.

Texts don't move: one pass over the scan. A text takes time and memory by its own length
only (some hundreds of bytes for each word of a part searched; other words some tens).

Nulls and odd input: a null or empty text has no words and no runs, and its collapsed text is empty. A null doc_id stays null.
Repeated rows are rows of their own. An empty table gives no rows. Extra columns are dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_batches, table

#: A run's words and periods at least. GRAM: max(LEAST, TIMES * q) - 2 * q + 1 is never less, so a run's stretches of as many words come twice.
LEAST, TIMES, GRAM = 24, 3, 9
_A = np.uint64(0x9E3779B97F4A7C15)


def parts(words: list[bytes]) -> list[tuple[int, int]]:
    """Stretches of the text, from and to, that hold all runs: those whose stretches of GRAM words all come more than once."""
    n = len(words)
    if n < LEAST:
        return []
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    gram = h[: n - GRAM + 1].copy()
    for i in range(1, GRAM):
        gram = (gram ^ (gram >> np.uint64(29))) * _A + h[i : n - GRAM + 1 + i]
    order = np.argsort(gram)
    equal = gram[order[1:]] == gram[order[:-1]]
    if not equal.any():
        return []
    again = np.zeros(len(gram) + 2, np.int8)
    again[order[1:][equal] + 1] = 1
    again[order[:-1][equal] + 1] = 1
    edges = np.flatnonzero(np.diff(again)).reshape(-1, 2)
    return [(a, b + GRAM - 1) for a, b in edges.tolist() if b - a + GRAM - 1 >= LEAST]


class Numbers:
    """Numbers of a text's stretches of 1, 2, 4, 8 ... words, equal where the stretches are; the last ones are the suffixes' order."""

    def __init__(self, text: np.ndarray):
        n, width = len(text), 1
        number = np.unique(text, return_inverse=True)[1].astype(np.int64)
        self.levels = [np.append(number, -1).astype(np.int32)]
        while int(number.max()) < n - 1:
            # What reaches over the end is shorter than all others and equals none.
            after = np.zeros(n, np.int64)
            after[: n - width] = number[width:] + 1
            number = np.unique(number * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
            self.levels.append(np.append(number, -1).astype(np.int32))
            width *= 2
        self.place = number
        self.suffixes = np.argsort(number)

    def forwards(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on (a and b differ)."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            length += (level[a + length] == level[b + length]).astype(np.int64) << k
        return length

    def backwards(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words up to before a equal those up to before b (a < b)."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, width = self.levels[k], 1 << k
            room = a - length - width >= 0
            at = np.where(room, a - length - width, 0)
            length += (room & (level[at] == level[at + (b - a)])).astype(np.int64) << k
        return length


def blocks(numbers: Numbers) -> np.ndarray:
    """Begins of the Lempel-Ziv blocks, and the end: each is the longest stretch that also begins further left, or one new word."""
    suffixes, n = numbers.suffixes.tolist(), len(numbers.suffixes)
    before, after = [-1] * (n + 1), [-1] * (n + 1)
    for a, b in zip(suffixes[:-1], suffixes[1:], strict=True):
        after[a], before[b] = b, a
    left, right = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):  # neighbours in the suffixes' order among those further left
        a, b = before[i], after[i]
        left[i], right[i] = a, b
        after[a], before[b] = b, a  # the last entry takes those of no neighbour
    here = np.arange(n)
    longest = np.zeros(n, np.int64)
    for other in (np.array(left), np.array(right)):
        there = other >= 0
        longest[there] = np.maximum(longest[there], numbers.forwards(here[there], other[there]))
    begins, at, longest = [], 0, longest.tolist()
    while at < n:
        begins.append(at)
        at += longest[at] or 1
    return np.array([*begins, n])


@lru_cache(maxsize=2)
def _least_factors(bits: int) -> np.ndarray:
    """The least prime factor of each number below 2 ** bits."""
    least = np.arange(1 << bits)
    for p in range(2, 1 << (bits // 2 + 1)):
        if least[p] == p:
            multiples = least[p * p :: p]
            multiples[multiples == np.arange(p * p, 1 << bits, p)] = p
    return least


def covering_squares(numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of primitive squares that cover the leftmost occurrence of each kind."""
    n, edges = len(numbers.suffixes), blocks(numbers)
    begin, end = edges[:-1], edges[1:]
    following = np.append(edges[2:], n)
    own, both = end - begin, following - begin

    def each(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block = np.repeat(np.arange(len(sizes)), sizes)
        return block, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1

    found = []
    # Squares over the block's end, whose second half begins in it; then those over its begin, whose first half ends in it.
    block, period = each(own)
    for pivot, other, block, period in ((end[block], end[block] - period, block, period), *((begin[b], begin[b] + k, b, k) for b, k in (each(both),))):
        fits = (np.maximum(pivot, other) < n) & (np.minimum(pivot, other) >= 0)
        pivot, other, block, period = pivot[fits], other[fits], block[fits], period[fits]
        low, high = np.minimum(pivot, other), np.maximum(pivot, other)
        ahead, back = numbers.forwards(low, high), numbers.backwards(low, high)
        start = np.maximum(low - back, low - period + 1)
        good = (ahead + back >= period) & (ahead > 0) & (start + period <= end[block])
        found.append(np.stack([start[good], period[good]]))
    start, period = np.unique(np.concatenate(found, axis=1), axis=1)
    if len(start):
        least, rest, whole = _least_factors(int(period.max()).bit_length()), period.copy(), np.ones(len(start), bool)
        while (rest > 1).any():  # a square is no square of squares if no period / prime is a period of it
            factor = least[rest]
            shorter = period // factor
            more = factor > 1
            whole[more] &= numbers.forwards(start[more], start[more] + shorter[more]) < 2 * period[more] - shorter[more]
            rest //= factor
        start, period = start[whole], period[whole]
    return start, period


class SuffixTree:
    """Nodes 0 (the root) to the last inner one, then the leaves in the suffixes' order."""

    def __init__(self, text: list, numbers: Numbers):
        suffixes, n = numbers.suffixes, len(numbers.suffixes)
        shared = [0, *numbers.forwards(suffixes[:-1], suffixes[1:]).tolist(), 0]
        self.text, self.suffixes, self.place = text, suffixes.tolist(), numbers.place.tolist()
        depth, left, right, parent, stack, upper = [0], [0], [n - 1], [-1], [0], [0] * n
        for i in range(1, n + 1):
            low, begin, last = shared[i], i - 1, -1
            # The suffix before hangs on the deeper of its two neighbours' common beginnings.
            if shared[i - 1] >= low:
                upper[i - 1] = stack[-1]
            while depth[stack[-1]] > low:
                v = stack.pop()
                right[v], begin, last = i - 1, left[v], v
                if depth[stack[-1]] >= low:
                    parent[v], last = stack[-1], -1
            if depth[stack[-1]] < low:
                depth.append(low)
                left.append(begin)
                right.append(-1)
                parent.append(-1)
                stack.append(len(depth) - 1)
                if last >= 0:
                    parent[last] = stack[-1]
            if shared[i - 1] < low:
                upper[i - 1] = stack[-1]
        self.leaf = len(depth)
        self.depth = depth + [n - s for s in self.suffixes]
        self.left, self.right = left + list(range(n)), right + list(range(n))
        self.parent = parent + upper
        self.child: dict[tuple, int] = {}
        for v in range(1, len(self.depth)):
            at = self.suffixes[self.left[v]] + self.depth[self.parent[v]]
            if at < n:
                self.child[self.parent[v], text[at]] = v

    def locus(self, at: int, length: int) -> int:
        """The node at or below the end of the stretch."""
        v = self.leaf + self.place[at]
        while self.depth[self.parent[v]] >= length:
            v = self.parent[v]
        return v

    def turned(self, v: int, at: int, length: int, links: dict[int, int]) -> int | None:
        """The node of the stretch without its first word and with that at its end, None if the text hasn't that."""
        text, depth, suffixes, child = self.text, self.depth, self.suffixes, self.child
        u = self.parent[v]
        if u == 0:
            x = 0
        elif u in links:
            x = links[u]
        else:
            x = links[u] = self.locus(suffixes[self.left[u]] + 1, depth[u] - 1) if depth[u] > 1 else 0
        while depth[x] < length - 1:
            x = child[x, text[at + 1 + depth[x]]]
        if depth[x] == length - 1:
            return child.get((x, text[at])) if x < self.leaf else None
        return x if text[suffixes[self.left[x]] + length - 1] == text[at] else None


def squares(text: list, numbers: Numbers) -> tuple[list[tuple[int, int]], SuffixTree | None]:
    """Every kind of primitive square of the text, its node in the tree and its period, and the tree."""
    start, period = covering_squares(numbers)
    if not len(start):
        return [], None
    tree, links, marks = SuffixTree(text, numbers), {}, set()
    for at, k in zip(start.tolist(), period.tolist(), strict=True):
        v = tree.locus(at, 2 * k)
        while v is not None and (v, k) not in marks:
            marks.add((v, k))
            v = tree.turned(v, tree.suffixes[tree.left[v]], 2 * k, links)
    return list(marks), tree


def runs_of(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """start, length and period of all runs of words, of at least `least` words and `times` (2 or more) periods, in order."""
    known: dict[bytes, int] = {}
    text = [known.setdefault(w, len(known)) for w in words]
    if len(text) < 2:
        return []
    numbers = Numbers(np.array(text))
    marks, tree = squares(text, numbers)
    if not marks:
        return []
    nodes, periods = np.array([v for v, _ in marks]), np.array([k for _, k in marks])
    left, right = np.array(tree.left)[nodes], np.array(tree.right)[nodes]
    sizes = right - left + 1
    at = np.repeat(left - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    key = np.unique(np.repeat(periods, sizes) * len(text) + numbers.suffixes[at])
    first = np.flatnonzero(np.concatenate(([True], np.diff(key) != 1)) | (key % len(text) == 0))
    last = np.append(first[1:], len(key)) - 1
    period, start = key[first] // len(text), key[first] % len(text)
    length = key[last] - key[first] + 2 * period
    keep = (length >= least) & (length >= times * period)
    return sorted(zip(start[keep].tolist(), length[keep].tolist(), period[keep].tolist(), strict=True), key=lambda r: (r[0], r[2]))


def runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs of a text's words, by start, then period."""
    return [(a + start, length, period) for a, b in parts(words) for start, length, period in runs_of(words[a:b])]


def kept(words: list[bytes], found: Iterable[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run has after its first period."""
    gone = np.zeros(len(words) + 1, np.int32)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g]


Words = Callable[[int | None, list[bytes]], list[bytes]]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def periodic(docs: DataFrame, change: Words | None = None) -> DataFrame:
    """docs: doc_id, text. doc_id, runs (by start, then period) and the collapsed text of every row; `change` may give other words for a row's."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                words = change(doc_id, words) if change else words
                found = runs(words)
                text = b" ".join(kept(words, found) if found else words).decode("utf-8", "surrogatepass")
                yield doc_id, [{"start": s, "length": n, "period": q} for s, n, q in found], text

    schema = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(lambda batches: in_batches(rows(batches), _OUT), schema)


def _planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's words: of every tenth document (by a hash of its id) the words from some place on are made periodic."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic(table(spark, sf_dir, "documents"), _planted)
    # Runs come by start and period, so of equal exponents the first stays.
    longer = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), longer)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return out.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(F.expr("1000 * best.length div best.period")).alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
