"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are cut into bins at quantiles. Boosting goes
round the features in turn: each step fits one shallow tree (up to four
leaves over the ordered bins) to the residuals of the logistic loss and adds
it to that feature's lookup table. Then pairs of features are ranked by how
much a table over their coarse bins would lower the loss, and the best get
tables of their own, boosted the same way. A score is the logistic of the
intercept and one table entry for each feature and pair: gathers and additions
over whole columns.

Training reads at most `max_rows` labelled documents (a bounded sample, in
hash order); features and scores are of every text, whole.

Nulls and odd input: a null or empty text has features of 0 and gets the
score of that bin. A null doc_id is never held out and never used to train.
Null labels are ignored; of a document's labels the smallest counts. Without both classes
in training the score is the rate of label 1 (1 without labels). Equal texts
have equal scores. Extra columns are dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, table, written

THRESHOLD, MAX_ROWS = 0.3, 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE = 32, 6, 8, 120, 40, 0.15

_LETTER = bytes(b for b in range(256) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_UPPER = bytes(range(65, 91))
_MARK = b"#$%&*+<=>@^_`|~{}[]\\/"
FEATURES = (
    "log_words", "word_length", "letters", "uppercase", "marks", "marked_words", "bars", "shouts", "digits",
    "distinct_words", "top_word", "adjacent_repeats", "longest_repeat", "distinct_lines", "words_a_line", "upper_words",
    "sentence_ends", "commas", "worst_line_marks", "worst_line_upper",
)


def _share(data: bytes, which: bytes) -> float:
    return (len(data) - len(data.translate(None, which))) / len(data) if data else 0.0


def features(text: str | None) -> list[float]:
    """Counts and shares of the whole text; nothing but the text goes in."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    repeats = longest = run = 0
    last = None
    for w in words:
        if w == last:
            repeats += 1
            run += 1
            longest = max(longest, run)
        else:
            run = 0
        last = w
    lines = [x for x in data.split(b"\n") if x.strip()]
    long_lines = [x for x in lines if len(x) >= 60] or [data]
    marked = sum(1 for w in words if w[-1] in _MARK)
    upper_words = sum(1 for w in words if len(w) > 2 and w[:3].isupper())
    letters = data.translate(None, bytes(b for b in range(256) if b not in _LETTER)) if n < 4 else None
    size = len(data)
    n_letters = len(letters) if letters is not None else size - len(data.translate(None, _LETTER))
    return [
        float(np.log1p(n)), (size - n + 1) / n, n_letters / size, (size - len(data.translate(None, _UPPER))) / max(1, n_letters), _share(data, _MARK), marked / n,
        data.count(b"|") / n, data.count(b"!!") / n, _share(data, b"0123456789"),
        len(counts) / n, max(counts.values()) / n, repeats / n, float(longest), len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), upper_words / n,
        data.count(b". ") / n, data.count(b",") / n, max(_share(x, _MARK) for x in long_lines), max(_share(x, _UPPER) for x in long_lines),
    ]


@dataclass
class Model:
    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """x: rows by features. Additions of table entries, a column at a time."""
        total = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            total += t[np.searchsorted(self.cuts[j], x[:, j], "right")]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.zeros(0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2, ridge: float = 1.0) -> np.ndarray:
    """Newton steps of a shallow tree over ordered bins with summed gradients g and hessians h."""
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = gl**2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge)
        k = int(np.argmax(gain)) + 1
        if gain[k - 1] > g.sum() ** 2 / (h.sum() + ridge) + 1e-9:
            return np.concatenate([_tree(g[:k], h[:k], depth - 1, ridge), _tree(g[k:], h[k:], depth - 1, ridge)])
    return np.full(len(g), g.sum() / (h.sum() + ridge))


def train(x: np.ndarray, y: np.ndarray) -> Model:
    rate = float(y.mean()) if len(y) else 1.0
    width = x.shape[1] if x.ndim == 2 else 0
    nothing = [np.zeros(0)] * width
    if not len(y) or rate in (0.0, 1.0):
        return Model(50.0 * (2 * rate - 1), nothing, [np.zeros(1)] * width, [], nothing, [])
    intercept = float(np.log(rate / (1 - rate)))
    cuts = [_cuts(x[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            size = len(tables[j])
            step = RATE * _tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size))
            tables[j] += step
            total += step[bins[j]]
    coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(width)]
    cells = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(coarse)]
    g, h = slopes()
    ranked = []
    for a in range(width):
        for b in range(a + 1, width):
            shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
            at = cells[a] * shape[1] + cells[b]
            gg, hh = np.bincount(at, g, shape[0] * shape[1]), np.bincount(at, h, shape[0] * shape[1])
            ranked.append((float((gg**2 / (hh + 1)).sum()), a, b))
    pairs = [(a, b) for _, a, b in sorted(ranked, reverse=True)[:PAIRS]]
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), t in zip(pairs, pair_tables, strict=True):
            g, h = slopes()
            at = cells[a] * t.shape[1] + cells[b]
            gg, hh = (np.bincount(at, v, t.size).reshape(t.shape) for v in (g, h))
            # A tree over the rows' bins, and within each of its leaves one over the columns' bins.
            rows = _tree(gg.sum(1), hh.sum(1), 1)
            step = np.empty(t.shape)
            for leaf in np.unique(rows):
                inside = rows == leaf
                step[inside] = _tree(gg[inside].sum(0), hh[inside].sum(0), 1)
            step *= RATE
            t += step
            total += step.ravel()[at]
    return Model(intercept, cuts, tables, pairs, coarse, pair_tables)


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and x, the features, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x, pa.list_(pa.float32()))], ["doc_id", "x"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, x array<float>")


def training_rows(labels: DataFrame, usable, max_rows: int = MAX_ROWS) -> DataFrame:
    """labels: doc_id, quality; usable: a condition on doc_id. At most max_rows of doc_id, quality."""
    known = labels.where("doc_id is not null and quality is not null").where(usable).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def fit(rows: DataFrame, wanted: DataFrame) -> Model:
    """rows: doc_id, x; wanted: the training rows, bounded and so sent to the scan. Of rows that share an id the one of least features trains."""
    one = rows.join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.min("quality").alias("quality"))
    got = sorted((r.doc_id, r.quality, tuple(r.x)) for r in one.collect())
    x = np.array([r[2] for r in got], np.float32).reshape(-1, len(FEATURES))
    return train(x, np.array([float(r[1]) for r in got]))


def _scores(column: pa.ListArray, model: Model) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return model.score(flat.reshape(-1, len(FEATURES)))


def scored(rows: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """rows: doc_id, x. doc_id, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = _scores(b.column("x"), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def good_only(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the model accepts, all columns as they were; in one pass, without a shuffle."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(names.index("text"))], np.float32).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    rows = written(featured(table(spark, sf_dir, "documents")), "quality")
    model = fit(rows, training_rows(table(spark, sf_dir, "labels"), ~held_out))
    return scored(rows, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
