"""Every stage of the pipeline on a whole small table, each held against brute force on its own input."""

import os
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from crewgrid.llm import catalogue, mixing, packing
from crewgrid.llm.common import written
from tests.conftest import rows
from tests.llm.test_queries import brute_components, brute_pieces, brute_repeats, brute_reps, check_packing, shingle_set, words

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, SF), f"test{i}")
        out.append(docs)
    return out


def plain(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(outputs):
    assert len(corpus_pipeline.STAGES) == 5
    for df in outputs[1:5]:
        assert df.columns == outputs[0].columns


def test_quality_keeps_good_documents(spark, outputs):
    kept = {d for d, _ in plain(outputs[1])}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = sum((d in kept) == (q == 1) for d, q in labels.items())
    assert right >= 0.95 * len(labels) and set(plain(outputs[1])) <= set(plain(outputs[0]))


def test_one_document_of_each_group(outputs):
    before, after = plain(outputs[1]), plain(outputs[2])
    heads = {c for _, n, c in brute_components(before) if n} | {d for d, t in before if not shingle_set(t)}
    assert {d for d, _ in after} == heads and len(after) == len(heads) and set(after) <= set(before)


def test_repeated_passages_go(outputs):
    before = plain(outputs[2])
    want = Counter((d, t if not g else b" ".join(k).decode()) for (_, t), (d, _, g, k) in zip(before, brute_repeats(before), strict=True))
    assert Counter(plain(outputs[3])) == want
    assert all(r.n_chars == len(r.text) for r in outputs[3].collect())


def test_mixture(outputs):
    copies = Counter(plain(outputs[4]))
    want = {r.doc_id: (r.size, r.taken) for r in mixing.mix(outputs[3]).collect()}
    taken = defaultdict(int)
    for (d, t), n in copies.items():
        assert n <= 3
        taken[d] += n * len(t.encode().split())
    assert all(taken[d] == n for d, (_, n) in want.items())


def test_sequences(outputs):
    got = outputs[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(brute_pieces(plain(outputs[4])))
    assert check_packing(got, 1024) <= packing.lower_bound(np.array([r.length for r in got])) + 1


def test_run_is_the_stages(spark, outputs):
    key = lambda df: rows(df.select("doc_id", "piece", "start", "length", "ids_crc32"))
    assert key(corpus_pipeline.run(spark, SF)) == key(outputs[5])


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, near copies, columns with working names."""
    base = words(7, 150, 3000)
    texts = [" ".join(base), " ".join(base), " ".join([*base[:80], "edit", *base[81:]]), "", None, " \n ", "two words", " ".join(words(8, 40_000, 3000)), "x " * 400]
    data = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    data += [data[0], data[7], (None, texts[0], "en", "s0", 1), (None, None, None, None, None), (3, "other text of id three", "en", "s0", 1)]
    names = ("range", "set", "key", "__n", "__s", "__set", "__row", "__slot", "__mark", "__spans", "__reps", "__copy")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names)
    return spark.createDataFrame([(*r, *range(len(names))) for r in data], schema).repartition(3).cache()


def check_others(before, after):
    """Columns that a stage has no part in are as they were."""
    assert after.columns == before.columns and all(tuple(r)[5:] == tuple(range(12)) for r in after.collect())


def test_odd_rows_in_every_stage(spark, odd):
    stage = dict(corpus_pipeline.STAGES)
    before = plain(odd)
    kept = stage["quality classifier"](spark, odd, SF)
    check_others(odd, kept)
    got = plain(kept)
    assert set(got) <= set(before) and all(n in (0, before.count(x)) for x, n in Counter(got).items())
    one = stage["n-gram jaccard join"](spark, odd, SF)
    check_others(odd, one)
    after = plain(one)
    blank = [x for x in before if not shingle_set(x[1])]
    assert Counter(x for x in after if not shingle_set(x[1])) == Counter(blank)
    linked = [d for d, t in after if shingle_set(t)]
    assert sorted(linked) == [0, 3, 6, 7, 8] and set(after) <= set(before)
    cut = stage["substring dedup"](spark, odd, SF)
    check_others(odd, cut)
    want = Counter((d, t if not g else b" ".join(k).decode()) for (_, t), (d, _, g, k) in zip(before, brute_repeats(before), strict=True))
    assert Counter(plain(cut)) == want
    mix = stage["mixing to target weights"](spark, odd, SF)
    check_others(odd, mix)
    copies = Counter(plain(mix))
    assert all(n <= 3 * before.count(x) for x, n in copies.items()) and set(copies) <= set(before)
    pieces = stage["best-fit packing"](spark, odd, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == Counter(brute_pieces(before))
    check_packing(pieces, 1024)


def test_empty_tables_in_every_stage(spark, odd):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0


def test_mixture_is_what_the_order_says(outputs):
    """The stage against brute force; the targets, which the order cuts, are held against SQL as those of op4."""
    d = outputs[3]
    targets = {r.source: r.target for r in mixing.mix(d).join(d.select("doc_id", "source"), "doc_id").collect()}
    taken = Counter()
    for r in outputs[4].collect():
        taken[(r.source, r.doc_id)] += len(r.text.encode().split())
    assert +taken == +brute_reps([(r.doc_id, r.text, r.source) for r in d.collect()], targets)


def test_catalogue():
    names = catalogue.queries()
    assert {f"op{i}" for i in range(1, 14)} | {"pipeline"} == {n.split("_")[0] for n in names} and set(catalogue.oracle_sql()) <= set(names)
