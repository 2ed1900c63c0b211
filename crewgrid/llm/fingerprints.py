"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes runs along the whole text; where its value
hits a pattern of log2(block) bits a piece ends. A piece's hash gives one of 64 letters;
the letters at block size b and at 2b, with b, are the fingerprint
`b:letters:letters`. b is the smallest power of two, from 4 on, that is over
a 64th of the bytes and gives at most 64 letters, so a fingerprint is short
without leaving out any byte. Fingerprints of equal or neighbouring block
sizes are compared by edit distance (insertions and deletions) over their
lengths; without a common run of four letters they count as unlike.

A text is hashed some bytes at a time, so that a long one takes little more memory than itself.

Next documents: rows are dealt to ranges of doc_id, several to a task; the smallest document
of each range also goes to the range before it (the first of all to the last
range), so every row meets its next document in its own range. A range is
sorted downwards and streamed: the next document is always the one just
seen, and only that one is held.

Nulls and odd input: a null text is empty; a null doc_id sorts first. Rows
with the same doc_id share the next larger doc_id's document (of several
rows of one id, the smallest text), so repeated rows give equal rows. With
one doc_id only, the next document is its own. An empty table gives no rows.
Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffles, table

LETTERS, LEAST_BLOCK, ROLL, RUN = 64, 4, 7, 4
#: Bytes hashed at a time, about 30 bytes of memory each; ranges of ids for each partition.
PIECE, RANGES = 1 << 20, 4
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_STEP = np.uint32(0x01000193)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _rolled(data: bytes, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte from begin to end the hash of the ROLL bytes up to it, and the bits of it that trigger."""
    back = min(begin, ROLL - 1)
    h = np.frombuffer(data, np.uint8, end - begin + back, begin - back).astype(np.uint32) + np.uint32(1)
    rolled = h.copy()
    factor = _STEP
    for k in range(1, min(ROLL, len(h))):
        rolled[k:] += h[:-k] * factor
        factor = np.uint32(int(factor) * int(_STEP) & 0xFFFFFFFF)
    values = rolled[back:].astype(np.uint64) * _MIX
    return values, (values >> np.uint64(32)).astype(np.uint32)


def fingerprint(data: bytes, piece: int = PIECE) -> str:
    """Two passes over the bytes, `piece` of them at a time: one counts triggers for the block size, one makes the letters."""
    n = len(data)
    block = LEAST_BLOCK
    while block * LETTERS < n:
        block *= 2
    if not n:
        return f"{block}::"
    cuts = [*range(0, n, piece), n]
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    whole = _rolled(data, 0, n) if len(spans) == 1 else None
    # Triggers before the last byte, by block size: a piece ends where the lowest log2(block) bits are all set.
    triggers: dict[int, int] = {}
    for begin, end in spans:
        low = (whole or _rolled(data, begin, end))[1]
        low, b = low[:-1] if end == n else low, block
        while len(low):
            low = low[(low & np.uint32(b - 1)) == b - 1]
            triggers[b] = triggers.get(b, 0) + len(low)
            b *= 2
            if b > 1 << 31:
                break
    while triggers.get(block, 0) >= LETTERS:
        block *= 2
    out = []
    for b in (block, 2 * block):
        sums, rest = [], np.uint64(0)
        for begin, end in spans:
            values, low = whole or _rolled(data, begin, end)
            ends = np.flatnonzero((low & np.uint32(b - 1)) == b - 1) + 1
            ends = ends[ends < len(values)]
            each = np.add.reduceat(values, np.concatenate(([0], ends)))
            each[:1] += rest
            # The last sum goes on in the next span unless a piece ends with this one.
            done = end == n or int(low[-1]) & (b - 1) == b - 1
            sums.append(each if done else each[:-1])
            rest = np.uint64(0) if done else each[-1]
        letters = np.concatenate(sums) * _MIX
        out.append(_ALPHABET[(letters >> np.uint64(58)).astype(np.intp)].tobytes().decode())
    return f"{block}:{out[0]}:{out[1]}"


def _likeness(a: str, b: str) -> float:
    """1 less the insertions and deletions that turn a into b, over both lengths; the longest common subsequence runs in the bits of one integer."""
    if a == b:
        return 1.0
    run = min(RUN, len(a), len(b))
    if not run or not {a[i : i + run] for i in range(len(a) - run + 1)} & {b[i : i + run] for i in range(len(b) - run + 1)}:
        return 0.0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = (v + u | v - u) & full
    common = len(a) - v.bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(one: str, two: str) -> float:
    """0 to 1 of two fingerprints; 0 where their block sizes don't fit."""
    if one == two:
        return 1.0
    (b, b1, b2), (c, c1, c2) = one.split(":"), two.split(":")
    b, c = int(b), int(c)
    if not b1 or not c1:
        return 0.0
    if b == c:
        return max(_likeness(b1, c1), _likeness(b2, c2))
    return _likeness(b2, c1) if 2 * b == c else _likeness(b1, c2) if b == 2 * c else 0.0


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows range by range, heads first, then by falling doc_id and text."""
    range_now = group = following = None  # following: text and fingerprint of the next document
    seen = None  # the smallest text of the group so far
    for batch in batches:
        rows = []
        for values in zip(*(batch.column(c) for c in ("range", "head", "doc_id", "text")), strict=True):
            at, head, doc_id, text = (v.as_py() for v in values)
            data = text.encode("utf-8", "surrogatepass")
            mark = fingerprint(data)
            if at != range_now:
                range_now, group, seen = at, None, None
            if head:
                seen, group = (text, mark), ("head",)
                continue
            if (doc_id,) != group:
                group, following = (doc_id,), seen
            seen = (text, mark)
            half = len(text) // 2
            edited = (text[: len(text) - half] + following[0][:half]).encode("utf-8", "surrogatepass")
            changed = fingerprint(edited)
            rows.append((doc_id, len(text), hashlib.sha256(edited).hexdigest(), mark, changed, likeness(mark, changed), likeness(mark, following[1])))
        columns = zip(*rows, strict=True) if rows else [[] for _ in _KINDS]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. One row a document."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = shuffles(spark)
    ranges = RANGES * n
    cuts = sorted(set(docs.select("doc_id").approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))))
    edges = np.array(cuts, np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            at = np.searchsorted(edges, ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), *b.columns], ["range", *b.schema.names])

    heads = docs.select("doc_id").mapInArrow(place, "range int, doc_id long").groupBy("range").agg(F.min("doc_id").alias("least"), F.count_if(F.isnull("doc_id")).alias("nulls")).collect()
    if not heads:
        return spark.createDataFrame([], SCHEMA)
    order = sorted((r.range, None if r.nulls else r.least) for r in heads)
    before = [(order[i - 1][0], doc_id) for i, (_, doc_id) in enumerate(order)]
    # One row for each range: the text of its smallest document goes to the range before.
    sent = spark.createDataFrame(before, "range int, least long")
    first = docs.join(F.broadcast(sent), F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("range", "doc_id").agg(F.min("text").alias("text"))
    rows = docs.mapInArrow(place, "range int, doc_id long, text string").withColumn("head", F.lit(False))
    rows = rows.unionByName(first.withColumn("head", F.lit(True)))
    dealt = rows.repartition(n, "range").sortWithinPartitions("range", F.desc("head"), F.col("doc_id").desc_nulls_last(), F.desc("text"))
    return dealt.select("range", "head", "doc_id", "text").mapInArrow(_streamed, SCHEMA)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
