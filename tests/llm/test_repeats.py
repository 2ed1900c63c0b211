"""Repeated passages: many copies of a row, a passage that most documents have, one minimiser's windows in shares."""

import hashlib
import time

import numpy as np
import pytest

from crewgrid.llm import repeats
from tests.llm.test_queries import words


def brute_removed(table, k=13):
    texts = [(d, (t or "").encode().split()) for d, t in table]
    first = {}
    for d, w in texts:
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in texts:
        gone = {j for i in range(len(w) - k + 1) if first[tuple(w[i : i + k])] < d for j in range(i, i + k)}
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return sorted(out)


def got(spark, table, parts=4):
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(parts)
    return sorted(tuple(r) for r in repeats.removed(df).collect())


def test_many_copies_of_a_row(spark):
    """Work and memory follow the rows: each copy has the spans of one."""
    original, text = (1, " ".join(words(1, 400, 5000))), " ".join(words(1, 400, 5000)[100:] + words(2, 100, 5000))
    began = time.time()
    out = got(spark, [original] + [(7, text)] * 5000 + [(9, text)])
    assert time.time() - began < 60
    want = brute_removed([original, (7, text), (9, text)])
    assert out == sorted([want[0]] + [want[1]] * 5000 + [want[2]])
    spans = repeats.repeated_spans(spark.createDataFrame([original] + [(7, text)] * 300, "doc_id long, text string").repartition(3)).collect()
    assert len(spans) == 1 and len(spans[0].spans) < 400


def test_a_passage_in_most_documents(spark):
    passage = words(3, 60, 5000)
    r = np.random.default_rng(5)
    unique = lambda n: [f"u{x}" for x in r.integers(0, 1 << 40, n)]
    table = [(i, " ".join(unique(8) + passage[i % 3 :] + unique(8))) for i in range(20_000)]
    out = got(spark, table, 16)
    assert out == brute_removed(table)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("most", [1, 300, 5000, 1 << 30])
def test_shares_of_a_bucket_give_the_same(most, hot):
    """One bucket with the strings of many minimisers, opened whole, by minimiser and by window; frequent minimisers too."""
    import pyarrow as pa

    r = np.random.default_rng(2)
    passages = [[f"p{i}w{x}" for x in r.integers(0, 300, 30)] for i in range(3)] + [["a", "b"] * 20, ["c"] * 30]
    table = [(int(d), " ".join(x for i in r.integers(0, 5, 3) for x in passages[i][r.integers(0, 10) :])) for d in r.integers(0, 12, 25)]
    late = np.unique(repeats._stretches(" ".join(x for p in passages for x in p).encode().split(), 13)[0]) if hot else np.zeros(0, np.uint64)
    batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in part], pa.int64()), "text": [t for _, t in part]}) for part in (table[:9], table[9:])]
    spans = {}
    for b in repeats._bucketed([x for b in batches for x in repeats._packed([b], 1, late, 500)], most):
        for d, m, s, e in zip(*(c.to_pylist() for c in b.columns), strict=True):
            spans.setdefault((d, m), set()).add((s, e))
    for (d, t), want in zip(sorted(table), brute_removed(table), strict=True):
        w, mark = repeats.words_of(t)
        mine = spans.get((d, int(np.uint64(mark).view(np.int64))), ())
        left = repeats.kept(w, [{"start": s, "stop": e} for s, e in mine])
        assert hashlib.sha256(b" ".join(left)).hexdigest() in {x[3] for x in brute_removed(table) if x[0] == d and x[1] == len(w)}
        assert want[0] == d
