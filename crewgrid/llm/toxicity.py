"""Toxicity by compression distance.

Two zstandard dictionaries are trained, on ordinary and on toxic text. A
text is cut into windows of `window` words and every window is compressed
with both; a window is toxic as far as the toxic dictionary makes it shorter.
The sum of these gains, the gain a window and the best gain go through calibrated
thresholds: a monotone table each, from gain to the share of toxic documents, fitted on
training rows that the dictionaries did not see, at the base rate of the labels. The score is the
sum's share, but no more than the greater of the two others: a toxic text has a surely
toxic window or many that lean to it. So single bytes over many windows of a long text are not enough.

What makes the distance sharp: both dictionaries hold the same ordinary
part (trained by zstandard's COVER from windows of ordinary documents) and
differ only in a last part, taken from toxic text by contrast, which has
the runs of letters that surely more toxic than ordinary documents have (bounds of
`Z` standard errors on either share, one of `RATIOS` apart), the most frequent ones up to `TOXIC_BYTES` (1 KB); the other dictionary has filler there. Trained plainly on
whole documents the two dictionaries share nearly all their content and the
gain is noise (AUC 0.6 to 0.7).

Training reads at most `max_toxic` and `max_ordinary` labelled documents (a
bounded sample, in hash order), whole, in the executors; scoring reads every
text, whole. The ordinary part is trained on at most `max_windows` windows:
where there are more, each sampled document gives equally many, evenly spaced
over its text, or all it has if it has fewer.

Nulls and odd input: a null or empty text has no gain and gets the lowest
score. A null doc_id is never held out and never used to train. Labels that
are null are ignored; a document with two labels counts as toxic if one is.
Without toxic training rows the score is the base rate (0 without labels).
Equal texts have equal scores. Extra columns are dropped.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ALNUM, fold, table, written

WINDOW, GRAM = 4, 5
ORDINARY_BYTES, TOXIC_BYTES = 4096, 1024
MAX_TOXIC, MAX_ORDINARY, MAX_WINDOWS = 2500, 10_000, 40_000
THRESHOLD = 0.7
#: A run of letters is toxic if MIN_DOCS toxic documents have it and the lower bound of their share is a ratio's times the upper bound of the ordinary
#: ones'; of these ratios the one counts whose scores fit the calibrating rows best (the least log loss; of equal ones the first).
MIN_DOCS, Z, RATIOS = 3, 3.0, (20.0, 6.0, 3.0, 1.5)
#: Steps of the tables: bytes gained, and bytes gained a window.
LEVELS = (0.0, 1.0, 2.0, 3.0, 4.0, 6.0, 9.0, 14.0, 25.0)
RATES = (0.0, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.5, 0.8)


def windows(text: str | None, size: int) -> list[bytes]:
    """Words in lower case without punctuation, `size` at a time, a space on either side."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(ALNUM).split()
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def _grams(ws: list[bytes]) -> set[bytes]:
    out: set[bytes] = set()
    for word in {w for x in ws for w in x.split()}:
        p = b" " + word + b" "
        out.update(p[i : i + GRAM] for i in range(len(p) - GRAM + 1))
    return out


def _runs(ws: list[bytes], toxic: set[bytes]) -> Counter:
    """Longest stretches of words in which every gram is toxic."""
    out: Counter = Counter()
    for word in {w for x in ws for w in x.split()}:
        p, i = b" " + word + b" ", 0
        while i <= len(p) - GRAM:
            j = i
            while j <= len(p) - GRAM and p[j : j + GRAM] in toxic:
                j += 1
            if j > i:
                out[p[i : j - 1 + GRAM]] += 1
            i = j + 1
    return out


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    window: int
    #: Calibration: for a gain of at least gains[i], the share scores[i] by the sum and bests[i] by the best window; for rates[i] a window, densities[i].
    gains: tuple[float, ...]
    scores: tuple[float, ...]
    bests: tuple[float, ...]
    rates: tuple[float, ...] = (float("-inf"),)
    densities: tuple[float, ...] = (1.0,)

    def compressors(self) -> tuple[zstd.ZstdCompressor, zstd.ZstdCompressor]:
        return _compressor(self.ordinary + b"\1" * len(self.toxic)), _compressor(self.ordinary + self.toxic)

    def score(self, gain: tuple[float, float], n: int | None = None) -> float:
        """gain: of all windows and of the best one; n: how many windows there are, if that may count."""
        total, best = (int(np.searchsorted(self.gains, g, "right")) - 1 for g in gain)
        other = self.bests[best]
        if n is not None:
            other = max(other, self.densities[int(np.searchsorted(self.rates, gain[0] / max(1, n), "right")) - 1])
        return min(self.scores[total], other)


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    params = zstd.ZstdCompressionParameters(
        window_log=14, hash_log=12, chain_log=12, search_log=4, min_match=GRAM, target_length=32, strategy=zstd.STRATEGY_LAZY2,
        write_content_size=False, write_dict_id=False, write_checksum=False,
    )
    return zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=params)


def gains(ws: list[bytes], plain: zstd.ZstdCompressor, toxic: zstd.ZstdCompressor) -> tuple[float, float]:
    """The bytes that the toxic dictionary saves: over all windows where it saves any, and in the best one."""
    saved = [d for w in ws if (d := len(plain.compress(w)) - len(toxic.compress(w))) > 0]
    return float(sum(saved)), float(max(saved, default=0))


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary that zstandard trains; the end of the samples where they are too few for it."""
    try:
        return zstd.train_dictionary(size * 2, samples).as_bytes()[-size:]
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def _quota(sizes: Counter, n: int) -> int:
    """The most windows that each text may give so that texts of these numbers of windows give at most n (but one each)."""
    low, high = 1, max(sizes, default=1) + 1
    while high - low > 1:
        at = (low + high) // 2
        low, high = (at, high) if sum(min(k, at) * c for k, c in sizes.items()) <= n else (low, at)
    return low


def _spread(ws: list[bytes], most: int) -> list[bytes]:
    return ws if len(ws) <= most else [ws[i * len(ws) // most] for i in range(most)]


def _mark(ws: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b"".join(ws)) >> 1


class _Here:
    """Training texts in memory; the second of every four of a class calibrates, the others build the dictionaries."""

    def __init__(self, toxic: list[str], ordinary: list[str], window: int):
        self.cut = {y: [windows(x, window) for x in texts] for y, texts in ((1, toxic), (0, ordinary))}

    def _building(self, y: int) -> list[list[bytes]]:
        return [x for i, x in enumerate(self.cut[y]) if i % 4 != 1]

    def sizes(self) -> tuple[int, int, int, int]:
        """Texts that build, toxic and ordinary, and all of them."""
        return len(self._building(1)), len(self._building(0)), len(self.cut[1]), len(self.cut[0])

    def counts(self, y: int, found: Callable[[list[bytes]], Iterable[bytes]], least: float = 0) -> Counter:
        """What is found in the texts that build, with how often, where that is at least `least`."""
        out: Counter = Counter()
        for x in self._building(y):
            out.update(found(x))
        return Counter({k: n for k, n in out.items() if n >= least})

    def ordinary(self, n: int) -> list[bytes]:
        """Windows of all ordinary texts that build, in the order of a hash, at most n."""
        most = _quota(Counter(map(len, self._building(0))), n)
        return [w for x in sorted(self._building(0), key=_mark) for w in _spread(x, most)][:n]

    def gains(self, model: Model) -> list[tuple[int, float, float, int]]:
        """Class, gain, best gain and number of windows of each text that calibrates."""
        p, q = model.compressors()
        return [(y, *gains(x, p, q), len(x)) for y in (1, 0) for x in self.cut[y][1::4]]


class _Stored:
    """The same over rows (toxic, place in its class, text): executors read the texts, whole; counts and gains come to the driver."""

    def __init__(self, rows: DataFrame, window: int):
        self.building, self.held, self.window = rows.where("place % 4 <> 1"), rows.where("place % 4 = 1"), window

    def sizes(self) -> tuple[int, int, int, int]:
        n = {(r.toxic, part): r["count"] for part, rows in enumerate((self.building, self.held)) for r in rows.groupBy("toxic").count().collect()}
        t, o = n.get((1, 0), 0), n.get((0, 0), 0)
        return t, o, t + n.get((1, 1), 0), o + n.get((0, 1), 0)

    def counts(self, y: int, found: Callable[[list[bytes]], Iterable[bytes]], least: float = 0) -> Counter:
        window = self.window

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out: Counter = Counter()
                for text in b.column("text"):
                    out.update(found(windows(text.as_py(), window)))
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.int64())], ["part", "n"])

        rows = self.building.where(F.col("toxic") == y).select("text").mapInArrow(run, "part binary, n long").groupBy("part").agg(F.sum("n").alias("n"))
        return Counter({bytes(r.part): r.n for r in rows.where(F.col("n") >= float(least)).collect()})

    def ordinary(self, n: int) -> list[bytes]:
        window = self.window
        most = _quota(Counter({int(k): c for k, c in self.counts(0, lambda ws: [b"%d" % len(ws)]).items()}), n)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cut = [windows(t.as_py(), window) for t in b.column("text")]
                yield pa.RecordBatch.from_arrays([pa.array(map(_mark, cut), pa.int64()), pa.array([_spread(x, most) for x in cut], pa.list_(pa.binary()))], ["mark", "ws"])

        # Each text with windows gives one at least, so n rows hold all that is wanted.
        rows = self.building.where("toxic = 0").select("text").mapInArrow(run, "mark long, ws array<binary>").where("size(ws) > 0").orderBy("mark").limit(n).collect()
        return [bytes(w) for r in rows for w in r.ws][:n]

    def gains(self, model: Model) -> list[tuple[int, float, float, int]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p, q = model.compressors()
            for b in batches:
                cut = [windows(t.as_py(), model.window) for t in b.column("text")]
                g = [gains(x, p, q) for x in cut]
                columns = [pa.array([x[i] for x in g], pa.float64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([b.column("toxic"), *columns, pa.array(list(map(len, cut)), pa.int64())], ["toxic", "gain", "best", "n"])

        return [tuple(r) for r in self.held.select("toxic", "text").mapInArrow(run, "toxic int, gain double, best double, n long").collect()]


def _bound(k: int, n: int, z: float) -> float:
    """Wilson's bound of the share k / n, z standard errors off."""
    p = k / n
    return (p + z * z / (2 * n) + z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def train(toxic: list[str], ordinary: list[str], window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> Model:
    """Three quarters of each class build the dictionaries; the other quarter, which they did not see, calibrates. texts: in the order of any hash."""
    return _trained_on(_Here(toxic, ordinary, window), window, max_windows)


def _trained_on(texts: _Here | _Stored, window: int, max_windows: int) -> Model:
    n_t, n_o, all_t, all_o = texts.sizes()
    base = all_t / max(1, all_t + all_o)
    if not n_t or not n_o:
        return Model(b"", b"", window, (float("-inf"),), (base,), (base,))
    seen = texts.counts(1, _grams, MIN_DOCS)
    common = set(seen)
    plain = texts.counts(0, lambda ws: _grams(ws) & common)
    content = _trained(texts.ordinary(max_windows), ORDINARY_BYTES)
    best: tuple[float, Model] | None = None
    for ratio in RATIOS:
        chosen = {g for g in common if _bound(seen[g], n_t, -Z) >= ratio * _bound(plain[g], n_o, Z)}
        runs = texts.counts(1, lambda ws, chosen=chosen: _runs(ws, chosen))
        # The runs that most toxic documents have, up to a size; the most frequent come last, where they are cheapest to point at.
        part = b""
        for run, _ in sorted(runs.items(), key=lambda r: (-r[1], r[0])):
            if len(part) + len(run) >= TOXIC_BYTES:
                break
            part = run + b"\0" + part
        model = Model(content, part, window, (float("-inf"),), (base,), (base,))
        held = texts.gains(model)
        model = _calibrated(model, held, base)
        loss = 0.0
        for y, gain, top, n in sorted(held):
            p = min(max(model.score((gain, top), n), 1e-3), 1 - 1e-3)
            loss -= math.log(p if y else 1 - p)
        if best is None or loss < best[0]:
            best = loss, model
    return best[1]


def _calibrated(model: Model, held: list[tuple[int, float, float, int]], base: float) -> Model:
    """The model with its tables, from class, gain, best gain and number of windows of rows that the dictionaries did not see."""
    cuts, rates = (float("-inf"), *LEVELS[1:]), (float("-inf"), *RATES[1:])
    y, total, best, n = (np.array([x[i] for x in held], float) for i in range(4))

    def shares(g: np.ndarray, levels: tuple[float, ...], base: float) -> tuple[float, ...]:
        """Each gain's share of toxic rows where they are `base` of all, with half a row of either class more over all levels; made to rise."""
        n_1, n_0 = (y > 0).sum() + 0.5, (y == 0).sum() + 0.5
        out = []
        for low, high in zip([float("-inf"), *levels[1:]], [*levels[1:], float("inf")], strict=True):
            at, rest = (g >= low) & (g < high), 0.5 / len(levels)
            t, o = base * ((at & (y > 0)).sum() + rest) / n_1, (1 - base) * ((at & (y == 0)).sum() + rest) / n_0
            out.append(t / (t + o))
        return tuple(float(x) for x in np.maximum.accumulate(out))

    scores = shares(total, LEVELS, base)
    # No text scores less than one without gain.
    bests, densities = (tuple(max(scores[0], x) for x in t) for t in (shares(best, LEVELS, base), shares(total / np.maximum(n, 1), RATES, base)))
    return Model(model.ordinary, model.toxic, model.window, cuts, scores, bests, rates, densities)


def fit(docs: DataFrame, labels: DataFrame, usable, max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY, max_windows: int = MAX_WINDOWS) -> Model:
    """labels: doc_id, toxic; usable: a condition on doc_id. Samples are the first of each class in the order of a hash."""
    known = labels.where("doc_id is not null and toxic is not null").where(usable).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    wanted = known.where("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(known.where("toxic = 0").orderBy(*order).limit(max_ordinary))
    # At most max_toxic + max_ordinary ids, so they are sent to the scan.
    rows = docs.join(F.broadcast(wanted), "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    rows = written(rows.withColumn("mark", F.xxhash64("text")), "labelled")
    # Of rows that share an id one trains, so that the bound is one on rows.
    places = rows.groupBy("doc_id", "toxic").agg(F.min("mark").alias("mark")).withColumn("place", F.row_number().over(W.partitionBy("toxic").orderBy("doc_id", "mark")) - 1)
    sample = rows.dropDuplicates(["doc_id", "mark"]).join(places.drop("toxic"), ["doc_id", "mark"]).select("toxic", "place", "text")
    return _trained_on(_Stored(written(sample, "sample"), WINDOW), WINDOW, max_windows)


def toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs: doc_id, text. Adds score, predicted and gain to doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, toxic = model.compressors()
        for batch in batches:
            cut = [windows(t.as_py(), model.window) for t in batch.column("text")]
            g = [gains(x, plain, toxic) if model.toxic else (0.0, 0.0) for x in cut]
            s = [model.score(x, len(ws)) for x, ws in zip(g, cut, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32()), pa.array([x for x, _ in g], pa.float64())],
                ["doc_id", "score", "predicted", "gain"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, gain double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "gain")
