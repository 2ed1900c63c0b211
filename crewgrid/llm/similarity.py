"""N-gram Jaccard join, exact, by a token-group matrix.

A document's tokens are its distinct shingles of five words (64-bit hashes).
Documents with equal sets (by 128-bit hashes) are one class from the start. For a link, two sets
of sizes a <= b share at least 0.8 * b and at least 8/9 * a tokens, so, in any common
order, one of the first a - ceil(8/9 a) + 1 tokens of the smaller (it is found by
them) is among the first b - ceil(0.8 b) + 1 of the larger (it asks with them). The
order puts tokens that many documents have (shared passages) last, so such tokens
are seldom among the first; only the cost depends on it.

1. Classes, with the tokens that documents of one batch of the scan share.
2. First tokens meet in their token's list, in order of size; sets that can
   link by size are tied to the first of their run. Nothing of a list is held; of
   long lists a map task ties runs itself and sends one entry a run.
3. Ties make closed neighbourhoods: any link lies within one. Texts are read
   again for their sets only (a bitmap of fixed size tells which).
4. Every neighbourhood is searched with a token-group matrix: similar sets (by least
   token) form groups of `GROUP`; of a group the union of its tokens is kept, and
   a query opens a group only if it shares at least 0.8 * max(its size, the group's
   smallest size) tokens with the union. Connected sets are not compared again.
5. A neighbourhood of up to `BLOCK` sets (fewer, if they are long) is one piece of work and gives its components.
   A larger one is dealt into blocks of similar sets, bounded in tokens, in five steps:
   each block is searched; the blocks' stars are connected through one set each; sets
   outside of the neighbourhood's largest star meet the blocks by token (a join on the first tokens
   of either side, with bounds by size); they visit the blocks met; there the token-group matrix of the
   block's sets is asked. So a set goes only to blocks with whose sets it shares a first token,
   and a group of near copies is mostly one star before.

No pairs within a group are emitted but those that connect it; no list, group or
component is collected on the driver, and no task holds more than some blocks.

Nulls and odd input: a null, empty or blank text has no shingles and links
with nothing; under five words the whole sequence is the one shingle. Rows
with a null doc_id are kept and link, but name no component: its id is
the least non-null one, null if there is none. Repeated rows are linked as equal texts. An
empty table gives no rows. Extra columns are ignored, or kept by `representatives`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import LOWER, bitmap, discard, in_batches, in_bitmap, shuffles, table, unused, written
from .components import components

SHINGLE, SAME, OF = 5, 80, 100
#: Shared tokens: those of IN_BATCH documents of one batch of the scan. What tells them is a bitmap over their hashes' first SHARED_BITS
#: bits (16 MB, sent to every task); it is kept at most half full by asking for more batches.
IN_BATCH, SHARED_BITS = 2, 27
#: Entries of one token's list that a map task sends one by one, sets in a block, sets in a group.
HELD, BLOCK, GROUP = 64, 500, 16
#: Bits of a set's hash that are its id (other bits tell ids of more than one set apart), tokens that a set counts for at least in a block.
SET_BITS, WEIGHT = 64, 4000
#: Up to so many large neighbourhoods are broadcast (16 bytes each).
NEARS = 200_000
_PART = 32768
_A = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = (text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")).translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = h[: len(h) - size + 1].copy()
    for i in range(1, size):
        out = (out ^ (out >> np.uint64(29))) * _A + h[i : len(h) - size + 1 + i]
    out = (out ^ (out >> np.uint64(32))) * _A
    return np.unique(out)


class SetIds:
    """A set's id: 64 bits of a 128-bit hash, or its other 64 where the first are known to be those of more sets than one."""

    def __init__(self, twice: frozenset[int] = frozenset(), bits: int = 64):
        self.twice, self.bits = twice, bits

    def halves(self, tokens: np.ndarray) -> tuple[int, int]:
        x = xxhash.xxh3_128_intdigest(tokens.tobytes())
        low, high = x & ((1 << self.bits) - 1), x >> 64
        return low - (low >> 63 << 64), high - (high >> 63 << 64)

    def __call__(self, tokens: np.ndarray) -> int:
        low, high = self.halves(tokens)
        return high if low in self.twice else low


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) * OF < SAME * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum()) if len(b) else 0
    return OF * common >= SAME * (len(a) + len(b) - common)


def first_tokens(tokens: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """So many of the first tokens that two linked sets share one; shared ones come last."""
    n = len(tokens)
    take = n - -(-n * SAME // OF) + 1
    slots = (tokens >> np.uint64(64 - SHARED_BITS)).astype(np.int64)
    common = (shared[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
    return np.concatenate((tokens[~common], tokens[common]))[:take]


def classes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, n, set and other (the halves of the set's hash) and mark (the least token), null without shingles; `shared`, on the first row of each batch, has the slots of the batch's shared tokens."""
    halves = SetIds(bits=bits).halves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, ids, marks, seen = [], [], [], {}
            for text in b.column("text"):
                tokens = shingles(text.as_py())
                sizes.append(len(tokens))
                ids.append(halves(tokens) if len(tokens) else (None, None))
                marks.append(int(tokens[0].view(np.int64)) if len(tokens) else None)
                if len(tokens):
                    seen[ids[-1]] = tokens
            tokens, counts = np.unique(np.concatenate(list(seen.values())), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0))
            slots = np.unique(tokens[counts >= IN_BATCH] >> np.uint64(64 - SHARED_BITS)).astype(np.int32)
            shared = [slots, *[None] * (b.num_rows - 1)][: b.num_rows]
            columns = [pa.array(x, pa.int64()) for x in (sizes, [x for x, _ in ids], [x for _, x in ids], marks)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns, pa.array(shared, pa.list_(pa.int32()))], ["doc_id", "n", "set", "other", "mark", "shared"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n long, set long, other long, mark long, shared array<int>")


def _shared(known: DataFrame) -> np.ndarray:
    """The bitmap of shared tokens' slots."""
    counts = written(known.where("shared is not null").select(F.explode("shared").alias("slot")).groupBy("slot").agg(F.count("*").alias("batches")), "slots")
    # From most batches to least, as many as fill half of the bitmap.
    sizes = counts.groupBy(F.least("batches", F.lit(1000)).alias("batches")).count().orderBy(F.desc("batches")).collect()
    filled, least = 0, 1001
    for r in sizes:
        filled += r["count"]
        if filled > 1 << (SHARED_BITS - 1):
            break
        least = r.batches
    parts = counts.where(F.col("batches") >= least).groupBy((F.col("slot") / _PART).cast("int").alias("part")).agg(F.expr(f"bitmap_construct_agg(pmod(cast(slot as long), {_PART}))").alias("bits"))
    bits = np.zeros((1 << SHARED_BITS) // 8, np.uint8)
    for r in parts.toLocalIterator():
        bits[r.part * _PART // 8 : (r.part + 1) * _PART // 8] = np.frombuffer(r.bits, np.uint8)
    discard(counts)
    return bits


def _runs(tokens: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries in the order of token and lo (twice the size, one more if the set only asks): which are tied, which are lone askers, and where each run begins.

    An entry is tied to its run if a set that is found by the token, no larger than it and of at least 0.8 of its size, came before it."""
    found, n = lo & 1 == 0, lo >> 1
    part = np.cumsum(np.concatenate(([0], tokens[1:] != tokens[:-1])))
    reach = np.maximum.accumulate((part << 32) + np.where(found, hi, 0))
    before = np.concatenate(([0], reach[:-1]))
    before = np.where(before >> 32 == part, before & 0xFFFFFFFF, 0)
    tied = before * OF >= n * SAME
    begin = np.maximum.accumulate(np.where(found & ~tied, np.arange(len(lo)), 0))
    return tied, ~found & ~tied, begin


_LISTED = "token long, leader long, reach long"


def _listed(token: np.ndarray, leader: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """lo in the first half of reach, how far hi goes beyond the size in the second (mostly 0, which packs well)."""
    reach = lo.astype(np.int64) << 32 | np.where(lo < 0, 0, hi - (lo >> 1)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, np.int64)) for c in (token, leader, reach)], ["token", "leader", "reach"])


def _ties(docs: DataFrame, common: Broadcast, set_id: SetIds) -> DataFrame:
    """set, leader: of each run of a token's list, each set and the run's leader."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries by token; ties that are known already have a set for a token and lo = -1."""
        for b in batches:
            sets: dict[int, np.ndarray] = {}
            for text in b.column("text"):
                tokens = shingles(text.as_py())
                if len(tokens):
                    sets[set_id(tokens)] = tokens
            if not sets:
                continue
            firsts = [first_tokens(t, common.value) for t in sets.values()]
            sizes = np.fromiter(map(len, firsts), np.int64, len(firsts))
            n = np.fromiter(map(len, sets.values()), np.int64, len(sets))
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            asks = place >= np.repeat(n - -(-n * 2 * SAME // (OF + SAME)) + 1, sizes)
            own, lo, hi = np.repeat(np.fromiter(sets, np.int64, len(sets)), sizes), np.repeat(2 * n, sizes) + asks, np.repeat(n, sizes)
            tokens = np.concatenate(firsts).view(np.int64)
            order = np.lexsort((lo, tokens))
            tokens, own, lo, hi = tokens[order], own[order], lo[order], hi[order]
            begins = np.concatenate(([0], np.flatnonzero(tokens[1:] != tokens[:-1]) + 1))
            lengths = np.diff(np.append(begins, len(tokens)))
            long = np.repeat(lengths > HELD, lengths)
            singly = ~long
            if long.any():
                tied, lone, begin = _runs(tokens, lo, hi)
                known = tied & long
                yield _listed(own[known], own[begin[known]], np.full(known.sum(), -1), np.zeros(known.sum()))
                # A run's one entry reaches as far as its largest set.
                np.maximum.at(hi, begin[known], hi[known])
                singly |= long & ~tied
            for i in range(0, len(tokens), 500_000):
                at = np.flatnonzero(singly[i : i + 500_000]) + i
                yield _listed(tokens[at], own[at], lo[at], hi[at])

    def ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # of the list that the last batch ended with: token, run's leader, how far it reaches
        for b in batches:
            tokens, own, reach = (c.to_numpy() for c in b.columns)
            lo = reach >> 32
            hi = (lo >> 1) + (reach & 0xFFFFFFFF)
            out = [np.stack([tokens[lo < 0], own[lo < 0]], 1)]
            tokens, own, lo, hi = (c[lo >= 0].astype(np.int64) for c in (tokens, own, lo, hi))
            if last is not None and len(tokens) and tokens[0] == last[0]:
                # The run goes on: its leader stands first once more, with the reach it has.
                tokens, own, lo, hi = (np.concatenate(([x], c)) for x, c in zip((last[0], last[1], 0, last[2]), (tokens, own, lo, hi), strict=True))
            if len(tokens):
                tied, _, begin = _runs(tokens, lo, hi)
                out.append(np.stack([own[tied], own[begin[tied]]], 1))
                at = np.flatnonzero((tokens == tokens[-1]) & (lo & 1 == 0))
                last = (tokens[-1], own[begin[at[-1]]], hi[at].max()) if len(at) else None
            pairs = np.unique(np.concatenate(out), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["set", "leader"])

    n = shuffles(docs.sparkSession)
    dealt = docs.select("text").mapInArrow(lists, _LISTED).repartition(n, "token").sortWithinPartitions("token", "reach")
    return dealt.mapInArrow(ties, "set long, leader long").distinct()


def _texts(docs: DataFrame, wanted: DataFrame, set_id: SetIds) -> DataFrame:
    """wanted (doc_id, set and more) with a text of each set, packed. A bitmap tells the scan which documents to hash anew; a set may come more than once."""
    slot = F.coalesce(F.xxhash64("doc_id"), F.lit(0))
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(slot.alias("slot"))))
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text").withColumn("slot", slot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstd.ZstdCompressor(level=3).compress
        for b in batches:
            b = b.filter(pa.array(in_bitmap(bits.value, b.column("slot").to_numpy())))
            sets = {}
            for text in b.column("text"):
                tokens = shingles(text.as_py())
                if len(tokens):
                    name = set_id(tokens)
                    if name not in sets:
                        sets[name] = pack(text.as_py().encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array(list(sets.values()), pa.binary())], ["set", "text"])

    return docs.mapInArrow(run, "set long, text binary").join(wanted.drop("doc_id"), "set")


class TokenGroups:
    """The token-group matrix of some sets, by rows of tokens: which groups' unions have each."""

    def __init__(self, sets: list[np.ndarray], order: list[int]):
        self.sets = sets
        self.groups = [order[i : i + GROUP] for i in range(0, len(order), GROUP)]
        unions = [np.unique(np.concatenate([sets[m] for m in g])) for g in self.groups]
        tokens = np.concatenate(unions)
        owners = np.repeat(np.arange(len(unions)), [len(u) for u in unions])
        at = np.argsort(tokens, kind="stable")
        self.tokens, self.begins = np.unique(tokens[at], return_index=True)
        self.ends = np.append(self.begins[1:], len(tokens))
        self.owners = owners[at]
        self.least = np.array([min(len(sets[m]) for m in g) for g in self.groups])
        self.most = np.array([max(len(sets[m]) for m in g) for g in self.groups])

    def qualifying(self, query: np.ndarray) -> list[int]:
        """Groups that may hold a set linked with the query: the overlap with the union bounds that with every member."""
        at = np.searchsorted(self.tokens, query)
        at[at == len(self.tokens)] = 0
        at = at[self.tokens[at] == query]
        sizes = self.ends[at] - self.begins[at]
        if not len(at):
            return []
        places = np.repeat(self.begins[at] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        overlap = np.bincount(self.owners[places], minlength=len(self.groups))
        n = len(query)
        fits = (overlap * OF >= SAME * np.maximum(n, self.least)) & (self.least * SAME <= n * OF) & (self.most * OF >= n * SAME)
        return np.flatnonzero(fits).tolist()


def in_order(sets: list[np.ndarray], stars: list[int], members: list[int]) -> list[int]:
    """Similar sets side by side: by star and least token."""
    return sorted(members, key=lambda m: (stars[m], int(sets[m][0])))


def search(stars: list[int], sets: list[np.ndarray], queries: list[int], others: list[int]) -> list[tuple[int, int]]:
    """Links (positions) that connect different stars, of queries with others; connected sets are not compared."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    matrix = TokenGroups(sets, in_order(sets, stars, others))
    out = []
    for q in queries:
        for g in matrix.qualifying(sets[q]):
            for m in matrix.groups[g]:
                a, b = find(stars[q]), find(stars[m])
                if a != b and linked(sets[q], sets[m]):
                    parent[max(a, b)] = min(a, b)
                    out.append((q, m))
    return out


def _roots(found: list[tuple[int, int]], ids: list[int]) -> dict[int, int]:
    """position: least id of its component, for the links' positions."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for a, b in found:
        a, b = find(a), find(b)
        if a != b:
            low, high = (a, b) if ids[a] < ids[b] else (b, a)
            parent[high] = low
    return {x: ids[find(x)] for x in list(parent)}


def _by_key(rows: DataFrame, keys: list[str], columns: list[str], work: Callable[[tuple, list[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """work(key, rows) for the rows of each key, dealt and sorted by the keys; only one key's rows are held. Text is held as its tokens, once a set."""
    arrow = {"bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64())}
    out = pa.schema([(f.name, arrow[f.dataType.simpleString()]) for f in rows.sparkSession.createDataFrame([], schema).schema])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, held, done, unpack = None, [], set(), zstd.ZstdDecompressor().decompress
        for b in batches:
            at = list(zip(*(b.column(k).to_pylist() for k in keys), strict=True))
            rest = [b.column(c) if c == "text" else b.column(c).to_pylist() for c in columns]
            for i, key in enumerate(at):
                if key != now:
                    if held:
                        yield from work(now, held)
                    now, held, done = key, [], set()
                row = [c[i] for c in rest]
                if "text" in columns:
                    own = tuple(x for x, c in zip(row, columns, strict=True) if c != "text")
                    if own in done:
                        continue
                    done.add(own)
                    place = columns.index("text")
                    row[place] = shingles(unpack(row[place].as_py()))
                held.append(tuple(row))
        if held:
            yield from work(now, held)

    n = shuffles(rows.sparkSession)
    dealt = rows.select(*keys, *columns).repartition(n, *keys).sortWithinPartitions(*keys, *(c for c in columns if c != "text"))
    return dealt.mapInArrow(lambda batches: in_batches(found(batches), out), schema)


def _whole(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """set, root of the sets of one neighbourhood, or of some blocks' heads, that link with another of them."""
    ids, sets = [r[0] for r in rows], [r[1] for r in rows]
    every = list(range(len(ids)))
    roots = _roots(search(every, sets, every, every) if len(ids) > 1 else [], ids)
    yield from ((ids[m], root) for m, root in roots.items())


_BLOCKED = "near long, block long, set long, star long, n long, tokens array<long>"


def _in_block(common: Broadcast) -> Callable[[tuple, list[tuple]], Iterator[tuple]]:
    """One block: of each set its star, its size and its first tokens, in their order."""

    def work(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
        ids, sets = [r[0] for r in rows], [r[1] for r in rows]
        every = list(range(len(ids)))
        roots = _roots(search(every, sets, every, every) if len(ids) > 1 else [], ids)
        for m in every:
            yield *key, ids[m], roots.get(m, ids[m]), len(sets[m]), first_tokens(sets[m], common.value).view(np.int64)

    return work


def _visited(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """u, v: stars that links between a block's sets and its visitors connect. rows: kind (0 resident, 1 visitor), set, star, tokens."""
    stars, sets = [r[2] for r in rows], [r[3] for r in rows]
    residents, visitors = ([i for i, r in enumerate(rows) if r[0] == kind] for kind in (0, 1))
    if residents and visitors:
        yield from ((stars[a], stars[b]) for a, b in search(stars, sets, visitors, residents))


def _weight() -> Column:
    """What a set of n tokens takes of a block's room: BLOCK * WEIGHT tokens."""
    return F.greatest("n", F.lit(WEIGHT))


def _slices(load) -> Column:
    return F.ceil(load / F.lit(BLOCK * WEIGHT)).cast("long")


def _dealt(large: DataFrame) -> DataFrame:
    """large: set, near, load, mark, n and more. Adds the set's block; sets with one least token are together, a block's worth at a time."""
    marks = large.groupBy("near", "mark").agg(F.sum(_weight()).alias("alike"))
    salt = F.pmod(F.xxhash64("set"), _slices(F.col("alike")))
    slot = F.pmod(F.xxhash64("mark"), _slices(F.col("load")))
    return large.join(marks, ["near", "mark"]).withColumn("block", F.when(_slices(F.col("alike")) > 1, F.xxhash64("mark", salt)).otherwise(slot)).drop("alike")


def _meetings(starred: DataFrame) -> DataFrame:
    """near, block, set: of the sets outside of their neighbourhood's largest star, the blocks they visit: those with a set that may be linked by its
    size and has a first token of theirs, by which one of the two is found."""
    sizes = starred.groupBy("near", "joint").agg(F.count("*").alias("k"))
    main = sizes.groupBy("near").agg(F.max_by("joint", F.struct("k", "joint")).alias("main"), F.count("*").alias("stars")).where("stars > 1").drop("stars")
    # One row a large neighbourhood: sent to all tasks if their count says so, else the sets of the largest are one task's.
    split = starred.join(F.broadcast(main) if main.limit(NEARS + 1).count() <= NEARS else main, "near")
    found = F.col("place") < F.col("n") - F.ceil(F.col("n") * 2 * SAME / F.lit(OF + SAME)) + 1
    each = split.select("near", "block", "set", "n", "joint", "main", F.posexplode("tokens").alias("place", "token")).withColumn("found", found)
    asked = each.where("joint <> main").select("near", "token", "set", "n", F.col("block").alias("own"), F.col("found").alias("mine"))
    there = each.groupBy("near", "token", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("found").alias("found"))
    fits = (F.col("least") * SAME <= F.col("n") * OF) & (F.col("most") * OF >= F.col("n") * SAME)
    return asked.join(there, ["near", "token"]).where((F.col("own") != F.col("block")) & (F.col("mine") | F.col("found")) & fits).select("near", "block", "set", "n").distinct()


def _stars_of_large(docs: DataFrame, large: DataFrame, common: Broadcast, set_id: SetIds) -> DataFrame:
    """large: set, near, load, mark, n, doc_id of the neighbourhoods that are more than a block. set, root of their components."""
    texts = written(_texts(docs, _dealt(large).drop("load", "mark", "n"), set_id), "texts")
    blocks = written(_by_key(texts, ["near", "block"], ["set", "text"], _in_block(common), _BLOCKED), "blocks")
    # Blocks' stars, through their heads, as many blocks' at a time as fit: what this misses is found below.
    heads = blocks.where("set = star").select("near", "set", "n")
    heads = heads.join(heads.groupBy("near").agg(F.sum(_weight()).alias("load")), "near").withColumn("some", F.pmod(F.xxhash64("set"), _slices(F.col("load"))))
    first = written(_by_key(texts.select("set", "text").join(heads.drop("load", "n"), "set"), ["near", "some"], ["set", "text"], _whole, "u long, v long"), "heads")
    joined = components(first).select(F.col("node").alias("star"), F.col("root").alias("joint"))
    starred = written(blocks.join(joined, "star", "left").withColumn("joint", F.coalesce("joint", "star")), "starred")
    visits = written(_meetings(starred), "visits")
    # Visitors meet a block's sets, as many at a time as a block has.
    counts = visits.groupBy("near", "block").agg(_slices(F.sum(_weight())).alias("slices"))
    there = texts.join(counts, ["near", "block"]).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    there = there.select("near", "block", "slice", F.lit(0).cast("long").alias("kind"), "set", "text")
    guests = visits.join(counts, ["near", "block"]).withColumn("slice", F.pmod(F.xxhash64("set"), F.col("slices")))
    guests = guests.join(texts.select("set", "text"), "set").select("near", "block", "slice", F.lit(1).cast("long").alias("kind"), "set", "text")
    meeting = there.unionByName(guests).join(starred.select("set", F.col("joint").alias("star")), "set")
    links = _by_key(meeting, ["near", "block", "slice"], ["kind", "set", "star", "text"], _visited, "u long, v long")
    links = written(links.unionByName(first), "links")
    roots = components(links).select(F.col("node").alias("star"), F.col("root").alias("joint"))
    out = written(blocks.join(roots, "star", "left").select("set", F.coalesce("joint", "star").alias("root")).distinct(), "large")
    discard(texts, blocks, first, starred, visits, links, roots, joined)
    return out


def _named(docs: DataFrame) -> tuple[DataFrame, DataFrame, SetIds]:
    """The rows' classes, of each class its root and component_id, and how sets are named."""
    bits = SET_BITS
    known = written(classes(docs, bits), "classes")
    of_set = [F.min("doc_id").alias("first"), F.min("mark").alias("mark"), F.max("n").alias("n"), F.min("other").alias("low"), F.max("other").alias("high")]
    sets = written(known.where("set is not null").groupBy("set").agg(*of_set), "sets")
    # About (sets ** 2) / 2 ** 65 hashes: a handful in 1e10 sets.
    twice = frozenset(r.set for r in sets.where("low <> high").select("set").collect())
    if twice:
        known = known.withColumn("set", F.when(F.col("set").isin(*twice), F.col("other")).otherwise(F.col("set")))
        sets = written(known.where("set is not null").groupBy("set").agg(*of_set), "sets")
    firsts, set_id = sets.drop("low", "high"), SetIds(twice, bits)
    common = docs.sparkSession.sparkContext.broadcast(_shared(known))
    ties = written(_ties(docs, common, set_id).select(F.col("set").alias("u"), F.col("leader").alias("v")), "ties")
    near = components(ties)
    members = near.select(F.col("node").alias("set"), F.col("root").alias("near")).unionByName(near.select(F.col("root").alias("set"), F.col("root").alias("near")).distinct())
    members = written(members.join(firsts.withColumnRenamed("first", "doc_id"), "set"), "members")
    members = members.join(members.groupBy("near").agg(F.sum(_weight()).alias("load")), "near")
    small, large = members.where(_slices(F.col("load")) <= 1), members.where(_slices(F.col("load")) > 1)
    roots = written(_by_key(_texts(docs, small.select("doc_id", "set", "near"), set_id), ["near"], ["set", "text"], _whole, "set long, root long"), "roots")
    more = [_stars_of_large(docs, large, common, set_id)] if large.limit(1).count() else []
    for m in more:
        roots = roots.unionByName(m)
    least = roots.join(firsts, "set").groupBy("root").agg(F.min("first").alias("component_id"))
    connected = written(roots.join(least, "root").select("set", "root", "component_id"), "connected")
    discard(ties, near, roots, *more)
    named = firsts.join(connected, "set", "left")
    named = named.select("set", F.coalesce("root", "set").alias("root"), F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id"))
    return known, named, set_id


def similar(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. doc_id, n_shingles, component_id of every row."""
    known, named, _ = _named(docs.select("doc_id", "text"))
    component = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return known.join(named.drop("root"), "set", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns: of the rows with the component's id (of null ids where there is no other), that of the
    least class and then the least text. Rows without shingles all stay."""
    known, named, set_id = _named(docs.select("doc_id", "text"))
    own = known.where("set is not null").join(named, "set").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    mark, place, one, its_id = unused(docs, "set", "row", "one", "id")
    kept = own.groupBy("root").agg(F.min("set").alias(one), F.min("component_id").alias(its_id)).select(one, its_id)
    names = [*docs.columns, mark]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = [shingles(t.as_py()) for t in b.column(names.index("text"))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([set_id(t) if len(t) else None for t in tokens], pa.int64())], names)

    rows = docs.mapInArrow(run, docs.withColumn(mark, F.lit(None).cast("long")).schema)
    blank = rows.where(F.col(mark).isNull()).drop(mark)
    rows = rows.where(F.col(mark).isNotNull()).join(kept, (F.col(mark) == F.col(one)) & F.col("doc_id").cast("long").eqNullSafe(F.col(its_id)), "left_semi")
    rows = rows.withColumn(place, F.row_number().over(W.partitionBy(mark, "doc_id").orderBy("text"))).where(F.col(place) == 1)
    return rows.select(docs.columns).unionByName(blank)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                      ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a WHERE r.root < e.b),
m AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.node = d.doc_id"""
