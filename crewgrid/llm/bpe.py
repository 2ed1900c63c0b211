"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut at the strings of the vocabulary's added tokens, then into chunks where a
rolling hash of WINDOW bytes says so, so that passages which documents share fall into
equal chunks wherever they stand.

1. A scan counts chunks by hash; a bitmap, sized by their number, tells those that come more than once.
2. Documents without such a chunk are encoded where they are read. The others become
   rows: a chunk of their own is encoded at once, of a shared one its 128-bit digest
   goes out, and its text once a batch.
3. A shared chunk's texts meet by digest, and it is encoded once, with what repairing needs:
   the words at its ends and how many ids they gave.
4. A join gives every place of a chunk its ids. Chunks with over 1 / HOT of all places
   are dealt by salt. Rows of a document meet, in order, and joins of chunks are repaired.

Repair. Between a character that is no white space and white space a word ends in every
context, so what a chunk gives before its last such place and after its first one is
right wherever it stands. The text from one to the other, over the join, is encoded
anew: on either side of it the ids agree with those of the chunks. A chunk without such a
place goes into the window as a whole, which goes on to the next chunk that has one. So the result
is that of the whole text, exactly.

Decoding looks ids up in the vocabulary and joins their bytes; what is no UTF-8 becomes
replacement characters.

Nulls and odd input: a null text is empty and has no ids. A null doc_id stays null. Repeated
rows are encoded as often as they come. Texts of any length are taken whole; one without white space
between chunks is encoded as one window, in the memory of one text and its ids.
An empty table gives no rows. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, discard, in_batches, shuffles, table, written
from .packing import VOCABULARY, Ids, _byte_letters

#: Bytes that the rolling hash sees, bits of it that are zero at a cut (chunks of 2 KB on average), bytes of the longest chunk.
WINDOW, CUT_BITS, LONGEST = 16, 11, 1 << 15
#: A chunk with over 1 / HOT of all places is salted; there are at most HOT of them.
HOT = 2000
_A = np.uint64(0x9E3779B97F4A7C15)
#: What the hash of the left half is multiplied by, for halves of 1, 2, 4 and so on bytes.
_POWERS = [(1 << i, np.uint64(pow(0xC2B2AE3D27D4EB4F, 1 << i, 1 << 64))) for i in range(WINDOW.bit_length() - 1)]
_ENDS = regex.compile(r"(?<=\S)(?=\s)")
_LAST_END = regex.compile(r"(?r)(?<=\S)(?=\s)")


def cuts(data: bytes, cut_bits: int = CUT_BITS) -> list[int]:
    """Where the text's chunks begin and end: never within a character."""
    b = np.frombuffer(data, np.uint8)
    n = len(b)
    if n <= WINDOW:
        return [0, n] if n else [0]
    h = (b.astype(np.uint64) + np.uint64(1)) * _A
    h ^= h >> np.uint64(29)
    for width, power in _POWERS:
        h = h[:-width] * power + h[width:]
    at = np.flatnonzero(h >> np.uint64(64 - cut_bits) == 0) + WINDOW
    at = at[at < n]
    out = [0]
    for x in [*at[(b[at] & 0xC0) != 0x80].tolist(), n]:
        while x - out[-1] > LONGEST:
            y = out[-1] + LONGEST
            while b[y] & 0xC0 == 0x80:
                y -= 1
            out.append(y)
        out.append(x)
    return out


class Chunker:
    """Chunks of a text: (follows, bytes), where one that doesn't follow begins the text or comes after or is an added token."""

    def __init__(self, path: str, cut_bits: int = CUT_BITS):
        self.ids, self.cut_bits = Ids(path), cut_bits
        self.added = self.ids.added

    def __call__(self, text: str) -> Iterator[tuple[bool, bytes]]:
        for i, part in enumerate(self.added.split(text) if self.added and self.added.search(text) else [text]):
            data = part.encode("utf-8", "surrogatepass")
            if i % 2:
                yield False, data
            elif data:
                at = cuts(data, self.cut_bits)
                for a, b in zip(at[:-1], at[1:], strict=True):
                    yield a > 0, data[a:b]


def record(ids: Ids, chunk: bytes) -> bytes:
    """What a chunk gives anywhere: sizes of its words at the ends and their number of ids, both words, all its ids."""
    text = chunk.decode("utf-8", "surrogatepass")
    first = None if ids.added and ids.added.fullmatch(text) else _ENDS.search(text)
    every = ids(text)
    if first is None:
        head, tail, n_head, n_tail = chunk, b"", len(every) // 4, 0
    else:
        last = _LAST_END.search(text).start()
        begin, end = text[: first.start()], text[last:]
        head, tail, n_head, n_tail = begin.encode("utf-8", "surrogatepass"), end.encode("utf-8", "surrogatepass"), len(ids(begin)) // 4, len(ids(end)) // 4
    numbers = np.frombuffer(every, "<u4")
    small = not len(numbers) or int(numbers.max()) < 1 << 16
    sizes = np.array([first is not None, small, len(head), len(tail), n_head, n_tail], "<u4").tobytes()
    return sizes + head + tail + (numbers.astype("<u2") if small else numbers).tobytes()


def _read(rec: bytes) -> tuple[bool, str, str, int, int, bytes]:
    inner, small, head, tail, n_head, n_tail = np.frombuffer(rec, "<u4", 6).tolist()
    at = 24 + head + tail
    ids = np.frombuffer(rec, "<u2" if small else "<u4", offset=at).astype("<u4").tobytes()
    return bool(inner), rec[24 : 24 + head].decode("utf-8", "surrogatepass"), rec[24 + head : at].decode("utf-8", "surrogatepass"), n_head, n_tail, ids


def repaired(ids: Ids, chunks: Iterator[tuple[bool, bytes]]) -> bytes:
    """The whole text's ids from its chunks' records, in order."""
    out: list[bytes] = []
    window: list[str] = []  # the text since the last place where a word surely ends
    given: list[bytes] = []  # the ids that its chunk gave, right unless more text follows

    def close() -> None:
        out.extend([ids("".join(window))] if len(window) > 1 else given)
        window.clear()
        given.clear()

    for follows, rec in chunks:
        inner, head, tail, n_head, n_tail, own = _read(rec)
        if not follows:
            close()
        if not inner:
            window.append(head)
            given.append(own)
            continue
        window.append(head)
        given.append(own[: 4 * n_head])
        close()
        out.append(own[4 * n_head : len(own) - 4 * n_tail])
        window.append(tail)
        given.append(own[len(own) - 4 * n_tail :])
    close()
    return b"".join(out)


def decoder(path: str):
    """Ids, as little-endian unsigned 32-bit bytes, to their text."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    letters = _byte_letters()
    added = {t["id"]: t["content"].encode("utf-8", "surrogatepass") for t in file.get("added_tokens") or ()}
    words = {i: bytes(letters[c] for c in word) for word, i in file["model"]["vocab"].items() if i not in added} | added
    pieces = [words.get(i, b"") for i in range(max(words) + 1)]
    return lambda data: b"".join(map(pieces.__getitem__, np.frombuffer(data, "<u4").tolist())).decode("utf-8", "replace")


def _hash(chunk: bytes) -> int:
    return xxhash.xxh3_64_intdigest(chunk)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(hashes, np.uint64).view(np.int64))


def shared_chunks(docs: DataFrame, path: str, cut_bits: int) -> tuple[np.ndarray, dict[int, int]]:
    """The bitmap of chunks that come more than once, and the salts of those that come very often, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker = Chunker(path, cut_bits)
        for b in batches:
            hashes = np.array([_hash(c) for t in b.column("text") if t.is_valid for _, c in chunker(t.as_py())], np.uint64)
            found, counts = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(found), pa.array(counts.astype(np.int64))], ["chunk", "places"])

    counted = docs.select("text").mapInArrow(run, "chunk long, places long").groupBy("chunk").agg(F.sum("places").alias("places"))
    found = written(counted.where("places > 1"), "shared-chunks")
    places = found.agg(F.sum("places")).first()[0] or 0
    bits = bitmap(found.select("chunk"))
    hot = found.where(F.col("places") * HOT > F.lit(places)).select("chunk", "places").collect()
    discard(found)
    return bits, {r.chunk: -(-r.places * HOT // places) for r in hot}


class _Shared:
    def __init__(self, bits: np.ndarray, salts: dict[int, int]):
        self.bits, self.salts, self.mask = bits, salts, 8 * len(bits) - 1

    def __call__(self, h: int) -> bool:
        slot = h & self.mask
        return bool(self.bits[slot >> 3] >> (slot & 7) & 1)

    def salted(self, h: int) -> int:
        return self.salts.get(h - (h >> 63 << 64), 1)


_ROW = pa.schema([("row", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("follows", pa.bool_()), ("digest", pa.binary()), ("salt", pa.int32()), ("data", pa.binary())])
_ROWS = "row long, place int, doc_id long, follows boolean, digest binary, salt int, data binary"
_RECORD = pa.schema([("digest", pa.binary()), ("salt", pa.int32()), ("record", pa.binary())])
_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])


def _rows(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for b in batches:
        for row in zip(*(b.column(c) for c in columns), strict=True):
            yield tuple(x.as_py() for x in row)


def encoded(docs: DataFrame, path: str | None = None, cut_bits: int = CUT_BITS) -> DataFrame:
    """docs: doc_id, text. doc_id and ids (little-endian unsigned 32-bit) of every row."""
    path = path or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    shared = spark.sparkContext.broadcast(_Shared(*shared_chunks(docs, path, cut_bits)))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents without shared chunks."""
        chunker = Chunker(path, cut_bits)

        def rows() -> Iterator[tuple]:
            for doc_id, text in _rows(batches, "doc_id", "text"):
                if not any(shared.value(_hash(c)) for _, c in chunker(text or "")):
                    yield doc_id, chunker.ids(text or "")

        yield from in_batches(rows(), _IDS)

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The chunks of the others: records, and of shared chunks digest and salt, with the text where it is the batch's first."""
        from pyspark import TaskContext

        chunker, pack, first = Chunker(path, cut_bits), zstd.ZstdCompressor(level=3).compress, TaskContext.get().partitionId() << 40

        def rows() -> Iterator[tuple]:
            row = first
            for b in batches:
                said: set[bytes] = set()
                for doc_id, text in _rows([b], "doc_id", "text"):
                    row += 1
                    chunks = list(chunker(text or ""))
                    hashes = [_hash(c) for _, c in chunks]
                    if not any(map(shared.value, hashes)):
                        continue
                    for place, ((follows, c), h) in enumerate(zip(chunks, hashes, strict=True)):
                        if not shared.value(h):
                            yield row, place, doc_id, follows, None, None, pack(record(chunker.ids, c))
                            continue
                        digest = xxhash.xxh3_128_digest(c)
                        yield row, place, doc_id, follows, digest, row % shared.value.salted(h), None if digest in said else pack(c)
                        said.add(digest)

        yield from in_batches(rows(), _ROW)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by digest: each chunk's record, once a salt."""
        chunker, pack, unpack = Chunker(path, cut_bits), zstd.ZstdCompressor(level=3).compress, zstd.ZstdDecompressor().decompress

        def rows() -> Iterator[tuple]:
            last = None
            for digest, data in _rows(batches, "digest", "data"):
                if digest != last:
                    last, chunk = digest, unpack(data)
                    rec = pack(record(chunker.ids, chunk))
                    for salt in range(shared.value.salted(_hash(chunk))):
                        yield digest, salt, rec

        yield from in_batches(rows(), _RECORD)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by row and place: the documents' ids. Only one document's records are held."""
        ids, unpack = Ids(path), zstd.ZstdDecompressor().decompress

        def rows() -> Iterator[tuple]:
            for (_, doc_id), own in groupby(_rows(batches, "row", "doc_id", "follows", "record"), lambda r: r[:2]):
                yield doc_id, repaired(ids, ((follows, unpack(rec)) for _, _, follows, rec in own))

        yield from in_batches(rows(), _IDS)

    n = shuffles(spark)
    parts = written(docs.mapInArrow(chunked, _ROWS), "chunks")
    texts = parts.where("digest is not null and data is not null").select("digest", "data")
    records = written(texts.repartition(n, "digest").sortWithinPartitions("digest").mapInArrow(once, "digest binary, salt int, record binary"), "records")
    places = parts.where("digest is not null").drop("data").join(records, ["digest", "salt"])
    columns = ["row", "place", "doc_id", "follows", "record"]
    every = places.select(columns).unionByName(parts.where("digest is null").withColumnRenamed("data", "record").select(columns))
    joined = every.repartition(n, "row").sortWithinPartitions("row", "place").mapInArrow(whole, "doc_id long, ids binary")
    return docs.mapInArrow(alone, "doc_id long, ids binary").unionByName(joined)


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """ids: doc_id, ids. doc_id and text of every row."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = decoder(path)
        texts = ((doc_id, None if ids is None else text_of(ids)) for doc_id, ids in _rows(batches, "doc_id", "ids"))
        yield from in_batches(texts, pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op13_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = decoder(path)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        rows = ((doc_id, len(ids) // 4, sha(ids), sha(text_of(ids).encode("utf-8"))) for doc_id, ids in _rows(batches, "doc_id", "ids"))
        yield from in_batches(rows, pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]))

    return encoded(table(spark, sf_dir, "documents"), path).mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
