"""Substring dedup: super-k-mers of words, cut by minimisers, counted exactly in their buckets.

A window is `k` words in a row. Its minimiser is the least hash of its
stretches of MINIMISER words. Consecutive windows with one minimiser travel
as one packed string, their words joined by a space, to the minimiser's
bucket, so a word is sent about three times and not thirteen; equal windows
always meet, as equal words give equal minimisers. In its bucket, strings of
one minimiser are sorted out and windows compared as text, never by hash.

Frequent stretches (common words, a passage that many documents share) would
send many different strings to one bucket. So a first scan counts minimisers,
and those with over 1 / `HOT` of all places come last in the order: a window has one as its
minimiser only if all its stretches are frequent. The words around a shared
passage then go to the buckets of their own stretches; its inner windows, all of whose stretches are frequent,
are dealt one by one by a hash of their words.

Map tasks combine: of equal strings of some MB of words one goes out, with
where it stands in the smallest document among them; where it stands in the others it is a repeat, which is known
at once. So a string that many documents share is sent a few times with few places. All strings of one bucket go as one compressed
block, so that a bucket receives few rows, and a bucket takes all later
documents' windows of an equal string as repeats without opening it. Blocks
are sorted by bucket; a bucket's compressed blocks are held, and opened one by one
for so many of its minimisers at a time as `OPENED` bytes hold, or for a share of one minimiser's windows. Hashes choose buckets
and shares only; a clash costs time and changes nothing.

The repeats' places go back to their documents. A bitmap over hashed ids, sized by their number, tells the last scan which documents may have
any; only those texts are shuffled. A false hit costs time and changes nothing.

Nulls and odd input: a null or empty text has no words. A row with a null
doc_id keeps all its words and is no one's original. Rows of one doc_id are
not smaller than each other, so none removes another's words; each is judged by its own
text, equal ones by one list of spans. Texts under k words have no windows. An empty table gives no rows.
`deduplicated` keeps all columns, `removed` only its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, discard, in_bitmap, shuffles, table, unused, written

WINDOW, MINIMISER = 13, 3
#: Bytes of words whose strings a map task combines before it sends them on; buckets for each shuffle partition; bytes of a bucket's strings opened at once.
HELD, BUCKETS, OPENED = 3 << 20, 4, 8 << 20
#: A minimiser is frequent with over 1 / HOT of all places, and LEAST places at least: there are at most 4 / 3 HOT of them, 8 bytes each.
HOT, LEAST = 50_000, 200
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(32)
_FIRST = np.uint64(1 << 63)
_PLACE = np.dtype([("doc", "<i8"), ("text", "<u8"), ("start", "<i4")])


def words_of(text: str | None) -> tuple[list[bytes], int]:
    """The words, and a hash of the whole text that tells a doc_id's rows apart."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data.split(), xxhash.xxh3_64_intdigest(data)


def _late(least: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Hashes in an order in which frequent ones come last: the others lose their first bit, these have it."""
    at = np.searchsorted(hot, least)
    at[at == len(hot)] = 0
    return np.where(hot[at] == least, least | _FIRST, least & ~_FIRST) if len(hot) else least & ~_FIRST


def _stretches(words: list[bytes], k: int, hot: np.ndarray = np.zeros(0, np.uint64)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with k words or more: minimiser, first window and window after the last of stretches whose windows share a minimiser."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    least = h[: len(h) - MINIMISER + 1].copy()
    for i in range(1, MINIMISER):
        least = (least ^ (least >> _C)) * _A + h[i : len(h) - MINIMISER + 1 + i] * _B
    least ^= least >> _C
    least *= _A
    least = _late(least & ~_FIRST, hot)
    # The least of k - MINIMISER + 1 neighbours, by doubling.
    span, width = k - MINIMISER + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: width - span], least[span - width :])
    starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    return least[starts], starts, np.append(starts[1:], len(least))


def super_kmers(words: list[bytes], k: int = WINDOW, hot: np.ndarray = np.zeros(0, np.uint64)) -> Iterator[tuple[int, int, int, bytes]]:
    """(key, first window, windows, packed words) of stretches whose windows share a minimiser; a window whose minimiser is frequent is a stretch
    of its own, with a hash of its words for a key."""
    if len(words) < k:
        return
    keys, starts, ends = _stretches(words, k, hot)
    packed = b" ".join(words)
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
    for key, s, e, i, j in zip(keys.tolist(), starts.tolist(), ends.tolist(), at[starts].tolist(), at[ends + k - 1].tolist(), strict=True):
        if key >> 63:
            for w in range(s, e):
                own = packed[at[w] : at[w + k] - 1]
                yield xxhash.xxh3_64_intdigest(own), w, 1, own
        else:
            yield key, s, e - s, packed[i : j - 1]


def _block(keys: np.ndarray, strings: list[bytes], counts: np.ndarray, places: np.ndarray, compress) -> bytes:
    """Strings of one bucket with their minimisers' first half and their places, column by column."""
    sizes = np.fromiter(map(len, strings), "<u4", len(strings))
    head = np.array([len(strings), len(places)], "<u4")
    columns = [(keys >> _C).astype("<u4"), counts.astype("<u4"), sizes, *(np.ascontiguousarray(places[f]) for f in _PLACE.names)]
    return compress(head.tobytes() + b"".join(c.tobytes() for c in columns) + b"".join(strings))


def _opened(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """keys, counts, sizes, places, strings of a block."""
    n, m = np.frombuffer(block, "<u4", 2).tolist()
    keys, counts, sizes = (np.frombuffer(block, "<u4", n, 8 + 4 * n * i) for i in range(3))
    at, places = 8 + 12 * n, np.zeros(m, _PLACE)
    for f in _PLACE.names:
        places[f] = np.frombuffer(block, _PLACE[f], m, at)
        at += _PLACE[f].itemsize * m
    return keys, counts, sizes, places, block[at:]


def frequent(docs: DataFrame) -> np.ndarray:
    """Minimisers with over 1 / HOT of all places, sorted. Tasks report those with 1 / (4 HOT) of their batch's; what that leaves out is under a quarter of the bound."""

    per = 4 * HOT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_stretches(words, WINDOW)[0] for t in batch.column("text") if len(words := (t.as_py() or "").encode("utf-8", "surrogatepass").split()) >= WINDOW]
            keys, counts = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            total = int(counts.sum())
            said = counts > max(1, total // per)
            rows = [pa.array(np.append(keys[said].view(np.int64), -1)), pa.array(np.append(counts[said], total).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(rows, ["minimiser", "places"])

    # -1 has the batches' totals: no minimiser has its first bit here.
    found = written(docs.where("doc_id is not null").select("text").mapInArrow(run, "minimiser long, places long").groupBy("minimiser").agg(F.sum("places").alias("places")), "minimisers")
    total = found.where("minimiser = -1").agg(F.sum("places")).first()[0] or 0
    hot = found.where((F.col("minimiser") >= 0) & (F.col("places") > max(LEAST, 3 * total // per))).select("minimiser").collect()
    discard(found)
    return np.sort(np.array([r.minimiser for r in hot], np.int64)).view(np.uint64)


_OUT = pa.schema([("bucket", pa.int32()), ("block", pa.binary()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])


def _spans(out: list[tuple[np.ndarray, int, int]], k: int) -> list[np.ndarray]:
    """doc_id, mark, start, stop of windows (from, to) of the strings at places."""
    doc = np.concatenate([p["doc"] for p, _, _ in out])
    mark = np.concatenate([p["text"] for p, _, _ in out]).view(np.int64)
    start = np.concatenate([p["start"] + i for p, i, _ in out]).astype(np.int32)
    stop = np.concatenate([p["start"] + (j - 1 + k) for p, _, j in out]).astype(np.int32)
    return [doc, mark, start, stop]


def _packed(batches: Iterator[pa.RecordBatch], buckets: int, hot: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Of every `most` bytes of words, one block a bucket, with each string's places in its smallest document here; the others' places are repeats already, and go out as spans."""
    found: dict[bytes, list] = {}
    held = 0
    compress = zstd.ZstdCompressor(level=3).compress

    def rows() -> Iterator[pa.RecordBatch]:
        later = []
        for v in found.values():
            if len(v[2]) > 1:
                least = min(v[2])[0]
                # Repeated rows have the same places.
                each = set(v[2])
                v[2] = [p for p in each if p[0] == least]
                if len(each) > len(v[2]):
                    later += [(doc, mark, start, start + v[1] - 1 + WINDOW) for doc, mark, start in each if doc != least]
        if later:
            doc, mark, start, stop = (np.array(c, t) for c, t in zip(zip(*later, strict=True), ("<i8", "<u8", "<i4", "<i4"), strict=True))
            spread = ((doc.view(np.uint64) * _A >> _C) % np.uint64(buckets)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (spread, pa.nulls(len(doc), pa.binary()), doc, mark.view(np.int64), start, stop)], schema=_OUT)
        keys = np.fromiter((v[0] for v in found.values()), np.uint64, len(found))
        counts = np.fromiter((len(v[2]) for v in found.values()), np.int64, len(found))
        places = np.array([p for v in found.values() for p in v[2]], _PLACE)
        firsts = np.concatenate(([0], np.cumsum(counts)))
        strings = list(found)
        bucket = (keys % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        begins = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1))
        blocks = []
        for own in np.split(order, begins[1:]):
            take = np.repeat(firsts[own] - np.concatenate(([0], np.cumsum(counts[own])[:-1])), counts[own]) + np.arange(counts[own].sum())
            blocks.append(_block(keys[own], [strings[i] for i in own.tolist()], counts[own], places[take], compress))
        none = [pa.nulls(len(blocks), f.type) for f in _OUT][2:]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[order][begins]), pa.array(blocks, pa.binary()), *none], schema=_OUT)

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            if doc_id is None:
                continue
            words, mark = words_of(text.as_py())
            for key, start, windows, packed in super_kmers(words, WINDOW, hot):
                have = found.get(packed)
                if have is None:
                    found[packed] = [key, windows, [(doc_id, mark, start)]]
                else:
                    have[2].append((doc_id, mark, start))
            held += sum(map(len, words))
            if held >= most and found:
                yield from rows()
                found.clear()
                held = 0
    if found:
        yield from rows()


def _starts(packed: bytes, k: int) -> list[bytes]:
    """The windows of a packed string."""
    cut = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32).tolist()
    begins, ends = [0, *(c + 1 for c in cut)], [*cut, len(packed)]
    return [packed[begins[i] : ends[i + k - 1]] for i in range(len(begins) - k + 1)]


def _repeats(rows: list[tuple[bytes, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Of one bucket's strings: places, and which of their windows (from, to) stand in a smaller document too."""
    by: dict[bytes, list[np.ndarray]] = {}
    for packed, places in rows:
        by.setdefault(packed, []).append(places)
    groups = [(packed, np.concatenate(p) if len(p) > 1 else p[0]) for packed, p in by.items()]
    smallest = [int(p["doc"].min()) for _, p in groups]
    if len(groups) == 1:
        packed, places = groups[0]
        later = places[places["doc"] > smallest[0]]
        if len(later):
            yield later, 0, packed.count(b" ") + 2 - k
        return
    if min(smallest) == max(int(p["doc"].max()) for _, p in groups):
        return
    windows = [_starts(packed, k) for packed, _ in groups]
    first: dict[bytes, int] = {}
    for ws, doc in zip(windows, smallest, strict=True):
        for w in ws:
            if first.get(w, doc) >= doc:
                first[w] = doc
    for (_, places), ws, doc in zip(groups, windows, smallest, strict=True):
        later = places[places["doc"] > doc]
        if len(later):
            yield later, 0, len(ws)
        own = places[places["doc"] == doc]
        i = 0
        while i < len(ws):
            j = i
            while j < len(ws) and first[ws[j]] < doc:
                j += 1
            if j > i:
                yield own, i, j
            i = j + 1


def _of_blocks(blocks: list[bytes], most: int, k: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """The repeats of one bucket. Its minimisers that stand in more than one place are opened so many at a time as `most` bytes hold, the blocks
    one by one for each share; of a minimiser with more bytes than that, the windows are dealt to shares by hash."""
    opened = lambda: (_opened(zstd.ZstdDecompressor().decompress(b)) for b in blocks)
    keys, counts, sizes = (np.concatenate(c) for c in zip(*(o[:3] for o in opened()), strict=True))
    order = np.argsort(keys, kind="stable")
    begins = np.concatenate(([0], np.flatnonzero(np.diff(keys[order])) + 1))
    wanted, held = keys[order[begins]], np.add.reduceat(sizes[order].astype(np.int64) + _PLACE.itemsize * counts[order].astype(np.int64), begins)
    repeated = np.add.reduceat(counts[order], begins) > 1
    wanted, held = wanted[repeated], held[repeated]
    del keys, counts, sizes, order, repeated

    def strings_of(own: np.ndarray) -> Iterator[tuple[int, bytes, np.ndarray]]:
        for keys, counts, sizes, places, strings in opened():
            ends, last = np.cumsum(sizes, dtype=np.int64), np.cumsum(counts, dtype=np.int64)
            at = np.flatnonzero(own[np.minimum(np.searchsorted(own, keys), len(own) - 1)] == keys)
            for i, key in zip(at.tolist(), keys[at].tolist(), strict=True):
                yield key, strings[ends[i] - sizes[i] : ends[i]], places[last[i] - counts[i] : last[i]].copy()

    small = held <= most
    shares = max(1, -(-int(held[small].sum()) // most))
    for share in range(shares):
        own = wanted[small & (wanted % np.uint32(shares) == share)]
        if not len(own):
            continue
        by: dict[int, list[tuple[bytes, np.ndarray]]] = {}
        for key, packed, places in strings_of(own):
            by.setdefault(key, []).append((packed, places))
        for rows in by.values():
            yield from _repeats(rows, k)
    for key, size in zip(wanted[~small], held[~small].tolist(), strict=True):
        shares = -(-size // most)
        for share in range(shares):
            first: dict[bytes, int] = {}
            for _, packed, places in strings_of(np.array([key])):
                least = int(places["doc"].min())
                for w in _starts(packed, k):
                    if hash(w) % shares == share and first.get(w, least) >= least:
                        first[w] = least
            for _, packed, places in strings_of(np.array([key])):
                for i, w in enumerate(_starts(packed, k)):
                    if hash(w) % shares == share and len(later := places[places["doc"] > first[w]]):
                        yield later, i, i + 1


def _bucketed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by bucket to spans of removed words: doc_id, mark, start, stop. Spans pass through."""
    k = WINDOW
    bucket_now, held = None, []
    out: list[tuple[np.ndarray, int, int]] = []
    names = ["doc_id", "mark", "start", "stop"]

    def close() -> Iterator[pa.RecordBatch]:
        for found in _of_blocks(held, most, k) if held else ():
            out.append(found)
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _spans(out, k)], names)
                out.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _spans(out, k)], names)
            out.clear()

    for batch in batches:
        passing = batch.filter(batch.column("block").is_null())
        if passing.num_rows:
            yield pa.RecordBatch.from_arrays([passing.column(c) for c in names], names)
        for bucket, block in zip(batch.column("bucket").to_pylist(), batch.column("block"), strict=True):
            if not block.is_valid:
                continue
            if bucket != bucket_now:
                yield from close()
                bucket_now, held = bucket, []
            held.append(block.as_py())
    yield from close()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, mark, spans: the words of each document that repeat a smaller document's windows."""
    n, held, opened = shuffles(docs.sparkSession), HELD, OPENED
    hot = docs.sparkSession.sparkContext.broadcast(frequent(docs))
    packed = docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(lambda batches: _packed(batches, n * BUCKETS, hot.value, held), "bucket int, block binary, doc_id long, mark long, start int, stop int")
    dealt = packed.repartition(n, "bucket").sortWithinPartitions("bucket")
    spans = dealt.mapInArrow(lambda batches: _bucketed(batches, opened), "doc_id long, mark long, start int, stop int")
    return written(spans.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")


def _slot(doc_id: Column) -> Column:
    return F.coalesce(F.xxhash64(doc_id), F.lit(0))


def kept(words: list[bytes], spans) -> list[bytes]:
    gone = np.zeros(len(words) + 1, np.int32)
    for s in spans:
        gone[s["start"]] += 1
        gone[s["stop"]] -= 1
    stays = np.cumsum(gone[:-1]) == 0
    return [w for w, s in zip(words, stays.tolist(), strict=True) if s]


def _split(docs: DataFrame, spans: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """docs that surely have no spans, and the others with theirs in `column` (null where the bitmap was wrong)."""
    sc = docs.sparkSession.sparkContext
    bits = sc.broadcast(bitmap(spans.select(_slot(F.col("doc_id")).alias("slot"))))
    mark, slot, doc, m = unused(docs, "mark", "slot", "doc", "m")
    names = [*docs.columns, mark]

    def sorted_out(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hit = in_bitmap(bits.value, b.column(b.num_columns - 1).to_numpy()) == wanted
                b = b.filter(pa.array(hit))
                marks = [words_of(t.as_py())[1] for t in b.column(names.index("text"))] if wanted else [0] * b.num_rows
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.array(marks, np.uint64).view(np.int64))], names)

        schema = docs.withColumn(mark, F.lit(0).cast("long")).schema
        return docs.withColumn(slot, _slot(F.col("doc_id"))).mapInArrow(run, schema)

    some = sorted_out(True)
    s = spans.select(F.col("doc_id").alias(doc), F.col("mark").alias(m), F.col("spans").alias(column))
    some = some.join(s, (F.col("doc_id").cast("long") == F.col(doc)) & (F.col(mark) == F.col(m)), "left").select(*docs.columns, column)
    return sorted_out(False).drop(mark), some


def removed(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. doc_id, n_words, n_removed, kept_sha256 of every row."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    none, some = _split(docs, repeated_spans(docs), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, spans in zip(b.column("text"), b.column("spans").to_pylist(), strict=True):
                words = words_of(text.as_py())[0]
                left = kept(words, spans) if spans else words
                rows.append((len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True))], ["doc_id", "n_words", "n_removed", "kept_sha256"]
            )

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    empty = F.lit(None).cast("array<struct<start:int,stop:int>>")
    columns = ["doc_id", "text", "spans"]
    return none.withColumn("spans", empty).select(columns).mapInArrow(run, schema).unionByName(some.select(columns).mapInArrow(run, schema))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without the repeated words; all columns, n_chars (if there) counted anew. Texts that lose nothing stay as they are."""
    names, spans_of = docs.columns, unused(docs, "spans")[0]
    none, some = _split(docs, repeated_spans(docs), spans_of)
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for text, spans in zip(b.column(at), b.column(b.num_columns - 1).to_pylist(), strict=True):
                text = text.as_py()
                texts.append(b" ".join(kept(words_of(text)[0], spans)).decode("utf-8", "surrogatepass") if spans else text)
            columns = list(b.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    cut = some.select(*names, spans_of).mapInArrow(run, docs.schema)
    if "n_chars" in names:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return none.select(names).unionByName(cut)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))


#: Exact for any table whose doc_ids are unique and not null.
OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT win, min(doc_id) AS first_doc FROM s GROUP BY win),
g AS (SELECT doc_id, i FROM s JOIN f USING (win) WHERE first_doc < doc_id),
r AS (SELECT DISTINCT doc_id, i + j AS p FROM g, (SELECT unnest(range(0, 13)) AS j)),
k AS (
  SELECT d.doc_id, len(w) AS n, w, coalesce(ps, []) AS ps FROM d LEFT JOIN (SELECT doc_id, list(p) AS ps FROM r GROUP BY doc_id) USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, len(ps)::BIGINT AS n_removed,
       sha256(array_to_string([w[x] FOR x IN range(1, n + 1) IF NOT list_contains(ps, x)], ' ')) AS kept_sha256
FROM k"""
