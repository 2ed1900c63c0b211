"""Best-fit packing with bound-certified repacking.

Documents become token ids and an end token; one longer than a sequence is
cut into full pieces, the first of which may be shorter. Full pieces are
sequences of their own. The others are dealt to partitions, each of which
packs best-fit decreasing and compares its sequences with a lower bound by
dual-feasible functions: partitions that meet the bound are certified and
done. Of the rest, the sequences that are filled to at least
`full_share` stay, while the gaps' documents are exchanged: they go to fewer
partitions with those of others and are packed anew, until none is left, or all that remain
have met in one partition, or partitions are as large as they may be and what is left hardly falls.

Only ids' checksums and lengths travel; texts and ids never leave the scan.

Tokens: the ids of the vocabulary file as the tokenizers library gives them with
add_special_tokens=False: where the string of one of the file's added tokens stands in a text,
that token's id. Between them, the file's own merges run in tiktoken's
engine, equal to what that library returns (tested), at four times the speed;
most words are looked up in a bounded table of words seen before.

Nulls and odd input: a null text is empty and becomes one piece, the end
token. A null doc_id stays null. Repeated rows are packed as often as they
come. An empty table gives no rows. Extra columns are dropped.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, table, written

ROOM, END = 1024, 2
VOCABULARY = "byte_bpe_50k.json"
#: Pieces in a packing partition, at most so many times that in later rounds, the fill from which an uncertified sequence stays, and words in a task's table.
PIECES, MOST, FULL_SHARE, WORDS = 25_000, 16, 0.98, 400_000
_ODD_SPACE = re.compile(r"  |[^\S ] | [^\S ]|^ | $")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones are themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoding(path: str) -> tuple[tiktoken.Encoding, re.Pattern | None, dict[str, bytes]]:
    """The file's vocabulary, whose ids are in the order of its merges, and what finds its added tokens, with their ids."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    added = {t["content"]: t for t in file.get("added_tokens") or ()}
    if odd := [c for c, t in added.items() if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]:
        raise ValueError(f"added tokens with rules of their own: {odd}")
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in word): i for word, i in file["model"]["vocab"].items() if word not in added}
    found = re.compile("(" + "|".join(re.escape(c) for c in sorted(added, key=lambda c: (-len(c), c))) + ")") if added else None
    ids = {c: np.array([t["id"]], "<u4").tobytes() for c, t in added.items()}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), found, ids


class Ids:
    """Token ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, words: int = WORDS):
        (self.engine, self.added, self.added_ids), self.words, self.known = encoding(path), words, {}

    def _plain(self, text: str) -> bytes:
        return np.asarray(self.engine.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """The added tokens' ids where their strings stand, of longer ones first, and those of the texts between."""
        if self.added is None or not self.added.search(text):
            return self._between(text)
        return b"".join(self.added_ids[x] if i % 2 else self._between(x) for i, x in enumerate(self.added.split(text)))

    def _between(self, text: str) -> bytes:
        """Where every blank stands alone between words, pieces of the pattern never reach over it, so words with their blank are looked up one by one."""
        if not text or _ODD_SPACE.search(text):
            return self._plain(text) if text else b""
        first, *rest = text.split(" ")
        known = self.known
        if len(known) > self.words:
            known.clear()
        out = [self._plain(first)]
        for w in rest:
            ids = known.get(w)
            if ids is None:
                ids = known[w] = self._plain(" " + w)
            out.append(ids)
        return b"".join(out)


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, room: int = ROOM, end: int = END) -> DataFrame:
    """The pieces of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(path)
        tail = np.array([end], "<u4").tobytes()
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id"), b.column("text"), strict=True):
                data = ids(text.as_py() or "") + tail
                n = len(data) // 4
                head = n % room or room
                for k, upto in enumerate(range(head, n + 1, room)):
                    start = 0 if k == 0 else upto - room
                    rows.append((doc_id.as_py(), k, start, upto - start, zlib.crc32(data[4 * start : 4 * upto])))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, PIECE)


def lower_bound(lengths: np.ndarray, room: int = ROOM) -> int:
    """The largest of the bounds by dual-feasible functions u_t: lengths over room - t count as full, under t as nothing, and by f_k: floor((k+1)x/room)/k."""
    counts = np.bincount(lengths, minlength=room + 1)[: room + 1].astype(np.int64)
    x = np.arange(room + 1, dtype=np.int64)
    mass = counts * x
    best = -(-int(mass.sum()) // room)
    upto, above = np.concatenate(([0], np.cumsum(mass))), np.concatenate((np.cumsum(counts[::-1])[::-1], [0]))
    for t in range(1, room // 2 + 1):
        best = max(best, int(above[room - t + 1]) + -(-int(upto[room - t + 1] - upto[t]) // room))
    for k in range(2, 13):
        scaled = (k + 1) * x
        f = np.where(scaled % room == 0, x * k, scaled // room * room)  # in units of 1 / (k * room)
        best = max(best, -(-int((counts * f).sum()) // (k * room)))
    return best


def best_fit(lengths: np.ndarray, room: int = ROOM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each length, and the fill of each bin. Bins wait on stacks by the room they have left."""
    order = np.argsort(-lengths, kind="stable")
    stacks: list[list[int]] = [[] for _ in range(room + 1)]
    free, left = 0, []  # free: bit r is set while a bin has room r
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, need in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = free >> need
        if fitting:
            r = need + (fitting & -fitting).bit_length() - 1
            b = stacks[r].pop()
            if not stacks[r]:
                free &= ~(1 << r)
        else:
            r, b = room, len(left)
            left.append(room)
        bins[i], offsets[i] = b, room - r
        r -= need
        left[b] = r
        if r:
            stacks[r].append(b)
            free |= 1 << r
    return bins, offsets, room - np.array(left, np.int64)


PACKED = PIECE + ", sequence_id long, offset long, placed boolean"


def _packer(round_no: int, last: bool, room: int, full_share: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True], kind="stable", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        bins, offsets, fill = best_fit(lengths, room)
        certified = len(fill) <= lower_bound(lengths, room)
        stays = np.ones(len(fill), bool) if certified or last else fill >= full_share * room
        part = int(key[0])
        return pdf[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(sequence_id=(round_no << 56 | part << 32) + bins, offset=offsets, placed=stays[bins])

    return run


def pack(docs: DataFrame, path: str | None = None, room: int = ROOM, end: int = END, per_partition: int = PIECES, full_share: float = FULL_SHARE) -> DataFrame:
    """One row a piece, with its sequence and its place there."""
    path = path or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    all_pieces = written(pieces(docs, path, room, end), "pieces")
    identity = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    full = all_pieces.where(F.col("length") == room).withColumns({"sequence_id": F.lit(1 << 62) + F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    done, waiting = [written(full, "full")], all_pieces.where(F.col("length") < room)
    round_no, parts, n = 1, None, waiting.count()
    while n:
        # A round has at most half as many partitions as the one before it, so a gap's documents meet those of others, but so many that none is too large.
        least = max(1, -(-n // (MOST * per_partition)))
        parts = max(least, min(max(1, -(-n // per_partition)), parts // 2 if parts else n))
        # Repeated rows have one identity; their place among the scan's rows spreads them.
        keyed = waiting.withColumn("__part", F.pmod(F.xxhash64(identity, F.monotonically_increasing_id() if round_no == 1 else F.lit(round_no)), F.lit(parts)).cast("int"))
        out = written(keyed.repartition(parts, "__part").groupBy("__part").applyInPandas(_packer(round_no, parts <= 1, room, full_share), PACKED), f"round{round_no}")
        before, n = n, out.where("not placed").count()
        if parts == least and n > before * 9 // 10:
            done.append(out.drop("placed"))
            break
        done.append(out.where("placed").drop("placed"))
        waiting = out.where("not placed").select("doc_id", "piece", "start", "length", "ids_crc32")
        round_no += 1
    discard(all_pieces)
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
