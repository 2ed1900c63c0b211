"""Divergence of sources, periodic runs and BPE by chunks, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crewgrid.llm import bpe, divergence, packing, periods
from tests.conftest import rows
from tests.llm.test_queries import docs, nothing, plain, words  # noqa: F401

PATH = public_tokenizers.path(packing.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)


def brute_divergence(table, least, top):
    """table: (text, lang, source)."""
    found = [(l or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for t, l, s in table]
    out = []
    for lang in {x[0] for x in found}:
        mine = [x for x in found if x[0] == lang]
        kept = {t for t, n in Counter(t for _, _, ts in mine for t in set(ts)).items() if n >= least}
        by = {s: Counter(t for _, x, ts in mine if x == s for t in ts if t in kept) for s in {x[1] for x in mine}}
        share = lambda c, t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))  # noqa: B023, E731
        f = lambda p, q: (p - q) ** 2 // (p + q)
        every = sum(by.values(), Counter())
        for s, c in by.items():
            pairs = [(-sum(f(share(c, t), share(d, t)) for t in kept), o.encode(), o) for o, d in by.items() if o != s]
            terms = [(-f(share(c, t), share(every, t)), t.encode(), t) for t in kept if c[t] and share(c, t) > share(every, t)]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(terms)[:top])]
    return sorted(out, key=repr)


def test_divergence(docs, nothing):  # noqa: F811
    table = [(r.text, r.lang, r.source) for r in docs.collect()]
    for least, top in ((10, 10), (2, 3), (1000, 10)):
        got = divergence.divergence(docs, least, top)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert rows(got) == brute_divergence(table, least, top)
    assert divergence.divergence(nothing).count() == 0


def test_divergence_of_odd_terms(spark):
    table = [("ÀB àb İi ß_ß 日本 x1y", "en", "a"), ("àB ab", "en", None), ("", "en", "c"), (None, None, None), ("ab ab [ab]", None, "a"), ("ab" * 50_000 + " ab", None, "b")]
    df = spark.createDataFrame(table, "text string, lang string, source string")
    for least in (1, 2):
        assert rows(divergence.divergence(df, least)) == brute_divergence(table, least, 10)


def test_shares_of_counts_over_64_bits(spark):
    n = 9_000_000_000_000
    got = spark.range(1).select(divergence._share(divergence.F.lit(n), divergence.F.lit(3 * n), divergence.F.lit(7)).alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (n + 2) // (3 * n + 14)


def brute_runs(w, least=24, times=3):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def odd_words(r):
    w = [b"%d" % r.randrange(r.randrange(1, 4)) for _ in range(r.randrange(2, 90))]
    for _ in range(r.randrange(0, 4)):
        s, p = r.randrange(len(w)), r.randrange(1, 9)
        w = w[:s] + w[s : s + p] * r.randrange(2, 6) + w[s:]
    return w


def test_runs_are_those_found_by_every_period():
    r = random.Random(3)
    for _ in range(400):
        w = odd_words(r)
        assert periods.runs(w) == brute_runs(w)
        for times in (2, 3):
            assert periods.runs_of(w, 1, times) == brute_runs(w, 1, times)


def test_runs_in_several_parts_of_a_text():
    r = np.random.default_rng(4)
    plain_words = lambda: [b"u%d" % x for x in r.integers(0, 1 << 40, 50)]
    block = [b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h"]
    w = plain_words() + block * 3 + plain_words() + block[:5] * 7 + [b"a"] + plain_words() + block * 3 + [b"z"] * 24
    assert periods.runs(w) == brute_runs(w) and len(periods.runs(w)) == 4
    fibonacci = [b"a"], [b"a", b"b"]
    for _ in range(13):
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    assert periods.runs_of(fibonacci[1], 1, 2) == brute_runs(fibonacci[1], 1, 2)


def test_walks_find_what_the_covering_squares_leave_out():
    r, more = random.Random(8), 0
    for _ in range(300):
        text = [int(x) for x in odd_words(r)]
        numbers = periods.Numbers(np.array(text))
        cover = {tuple(text[s : s + 2 * k]) for s, k in zip(*(x.tolist() for x in periods.covering_squares(numbers)), strict=True)}
        marks, tree = periods.squares(text, numbers)
        found = {tuple(text[tree.suffixes[tree.left[v]] :][: 2 * k]) for v, k in marks}
        every = {tuple(text[i : i + 2 * k]) for k in range(1, len(text) // 2 + 1) for i in range(len(text) - 2 * k + 1) if text[i : i + k] == text[i + k : i + 2 * k]}
        primitive = {s for s in every if not any(len(s) // 2 % d == 0 and s[d:] == s[:-d] for d in range(1, len(s) // 2))}
        assert cover <= found == primitive
        more += len(found) > len(cover)
    assert more > 50


def brute_periodic(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        a = h // 10 % len(w)
        p = 1 + (len(w) - a) // (3 + h // 10 % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *tail, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def test_periodic_runs_query(docs, plain, tmp_path, spark, nothing):  # noqa: F811
    r = random.Random(11)
    more = [(1000 + i, b" ".join(odd_words(r)).decode()) for i in range(40)] + [(2000, "é " * 30), (2001, " ".join(words(7, 20_000)))]
    table = [x for x in [*plain, *more] if len((x[1] or "").split()) < 4000 or x[0] == 2001]
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = periods.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows(got) == sorted((brute_periodic(*x) for x in table), key=repr)
    assert sum(x[1] > 0 for x in rows(got)) > 10
    assert periods.periodic(nothing).count() == 0


def test_long_periodic_text():
    w = [b"%d" % (i % 9973) for i in range(200_000)]
    assert periods.runs(w) == [(0, 200_000, 9973)]
    assert len(periods.kept(w, periods.runs(w))) == 9973


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " of", " ", "  ", "\n", "\t", "'", "'re", "é", "日本", "12", "!", "<|endoftext|>", "　", "​", "😀", "-"]), max_size=120).map("".join), st.integers(1, 4))
def test_repaired_chunks_give_the_whole_texts_ids(text, bits):
    chunker = bpe.Chunker(PATH, bits)
    chunks = list(chunker(text))
    got = bpe.repaired(chunker.ids, [(follows, bpe.record(chunker.ids, c)) for follows, c in chunks])
    assert b"".join(c for _, c in chunks) == text.encode()
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(got, "<u4").tolist() == want
    assert bpe.decoder(PATH)(got) == LIBRARY.decode(want, skip_special_tokens=False) == text


def test_decoding_of_broken_ids():
    decode = bpe.decoder(PATH)
    r = np.random.default_rng(1)
    for _ in range(300):
        ids = r.integers(0, 300, 12)
        assert decode(ids.astype("<u4").tobytes()) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


def test_chunks_are_the_same_wherever_a_passage_stands():
    passage = " ".join(words(1, 6000, 100_000)).encode()
    cut = lambda data: {data[a:b] for a, b in zip(bpe.cuts(data)[:-1], bpe.cuts(data)[1:], strict=True)}
    alone = cut(passage)
    assert len(alone) > 10 and len(alone & cut(b"some other words " * 9 + passage + b" and an end")) >= len(alone) - 2
    assert max(map(len, cut("日".encode() * 100_000))) <= bpe.LONGEST and all(c.decode() for c in cut("日".encode() * 100_000))


@pytest.mark.parametrize("hot", [bpe.HOT, 1 << 20])
def test_encoding_by_shared_chunks(docs, plain, nothing, spark, monkeypatch, hot):  # noqa: F811
    """Chunks small enough that most are shared; with and without salts for those that come often."""
    monkeypatch.setattr(bpe, "HOT", 3 if hot == bpe.HOT else hot)
    got = bpe.encoded(docs, PATH, 5)
    want = Counter((d, np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()) for d, t in plain)
    assert Counter((r.doc_id, bytes(r.ids)) for r in got.collect()) == want
    assert Counter((r.doc_id, r.text) for r in bpe.decoded(got, PATH).collect()) == Counter((d, t or "") for d, t in plain)
    assert bpe.encoded(nothing, PATH).count() == 0


def test_bpe_query(spark, plain, tmp_path):  # noqa: F811
    spark.createDataFrame([*plain, *[(5000 + i, t) for i, (_, t) in enumerate(plain)]], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for d, t in [*plain, *[(5000 + i, t) for i, (_, t) in enumerate(plain)]]:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows(bpe.op13_bpe_chunks(spark, str(tmp_path))) == sorted(want, key=repr)
