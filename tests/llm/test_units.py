"""Parts of the operators without Spark, against plain versions."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crewgrid.llm import fingerprints, licences, media, packing, quality, repeats, similarity, toxicity

settings.register_profile("machines may be slow", deadline=None)
settings.load_profile("machines may be slow")


@given(st.binary(max_size=500))
def test_images_give_their_payload_back(data):
    payload = media.padded(data)
    assert len(payload) % 64 == 0 and len(payload) > 0 and payload[: len(data)] == data and not any(payload[len(data) :])
    assert media.decode(media.encode(payload)) == payload
    media.feature(payload)


def test_broken_images_are_told():
    good = media.encode(media.padded(b"abc"))
    with pytest.raises(ValueError):
        media.decode(good[:-20] + b"x" + good[-19:])


@pytest.mark.parametrize(
    ("expression", "labels", "allowed"),
    [
        ("MIT", {"mit"}, True), ("MIT OR GPL-2.0-only", {"mit", "gpl"}, True), ("MIT AND GPL-2.0-only", {"mit", "gpl"}, False),
        ("(MIT AND GPL-3.0) OR BSD-3-Clause", {"mit", "gpl", "bsd"}, True), ("MIT AND GPL-3.0 OR BSD-3-Clause", {"mit", "gpl", "bsd"}, True),
        ("MIT AND (GPL-3.0 OR BSD-3-Clause)", {"mit", "gpl", "bsd"}, True), ("GPL-2.0 WITH Classpath-exception-2.0", {"gpl"}, False), ("Foo-1.0", set(), False),
    ],
)
def test_licence_expressions(expression, labels, allowed):
    assert licences.parse(expression) == (labels, allowed)


@pytest.mark.parametrize("expression", ["", "MIT AND", "(MIT", "MIT)", "AND MIT", "()", "MIT (GPL"])
def test_broken_expressions_give_none(expression):
    assert licences.parse(expression) is None


def test_expressions_end_before_prose():
    assert licences.parse("MIT OR Apache-2.0 see file") == ({"mit", "apache"}, True)


def brute_places(text):
    words = text.encode().translate(licences.ALNUM).split()
    found = [(i, label) for phrase, label in licences.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.encode().split()]
    return len(words), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))


@given(st.lists(st.sampled_from(["MIT", "license", "License,", "apache", "general", "public", "é", "x-y", "Apache License:", "spdx license identifier"]), max_size=30))
def test_base_phrases(words):
    text = " ".join(words)
    got = licences.scan(text, licences.automaton())
    assert got[:5] == brute_places(text)
    assert set(filter(None, got[4].split(","))) <= set(filter(None, got[5].split(",")))


def test_longest_phrase_counts():
    assert licences.scan("Licensed under CC BY-NC 4.0.", licences.automaton())[5] == "cc-by-nc"
    assert licences.scan(None, licences.automaton()) == (0, 0, None, None, "", "", 0.0, None)


@pytest.fixture(scope="module")
def reference_tokens():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    return t


@settings(max_examples=150)
@given(st.lists(st.sampled_from([*"ab'st 　 \n\r\t é日1#<|>", "<|endoftext|>", "<|endoftext"]), max_size=60).map("".join))
def test_tokens_are_those_of_the_file(reference_tokens, text):
    ids = packing.Ids(public_tokenizers.path(packing.VOCABULARY), words=3)
    assert np.frombuffer(ids(text), "<u4").tolist() == reference_tokens.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids("x " + text + " y"), "<u4").tolist() == reference_tokens.encode("x " + text + " y", add_special_tokens=False).ids


def test_added_tokens_have_their_ids(reference_tokens):
    text = "a <|endoftext|> b<|endoftext|>"
    assert 50256 in reference_tokens.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.Ids(public_tokenizers.path(packing.VOCABULARY))(text), "<u4").tolist() == reference_tokens.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 16), min_size=1, max_size=60))
def test_best_fit_and_its_bound(lengths):
    x = np.array(lengths)
    bins, offsets, fill = packing.best_fit(x, 16)
    assert packing.lower_bound(x, 16) <= len(fill) <= packing.lower_bound(x, 16) * 1.7 + 1
    for b in range(len(fill)):
        own = sorted((o, o + n) for o, n, c in zip(offsets.tolist(), lengths, bins.tolist(), strict=True) if c == b)
        assert own[0][0] == 0 and own[-1][1] == fill[b] <= 16 and all(p[1] == q[0] for p, q in zip(own, own[1:], strict=False))


@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_bound_is_not_over_the_optimum(lengths):
    def fits(rest, bins):
        if not rest:
            return True
        return any(fits(rest[1:], bins[:i] + [b - rest[0]] + bins[i + 1 :]) for i, b in enumerate(bins) if b >= rest[0])

    best = next(n for n in range(1, len(lengths) + 1) if fits(sorted(lengths, reverse=True), [12] * n))
    assert packing.lower_bound(np.array(lengths), 12) <= best


@given(st.lists(st.sampled_from(["a", "b", "c", "dd"]), max_size=60))
def test_super_kmers_are_all_windows(words):
    words = [w.encode() for w in words]
    got = {}
    for _, start, n, packed in repeats.super_kmers(words, 13):
        parts = repeats._starts(packed, 13)
        assert len(parts) == n
        got.update({start + i: w for i, w in enumerate(parts)})
    assert got == {i: b" ".join(words[i : i + 13]) for i in range(len(words) - 12)}


def test_equal_windows_share_a_minimiser():
    r = np.random.default_rng(1)
    shared = [b"s%d" % i for i in range(13)]
    keys = set()
    for _ in range(20):
        words = [b"w%d" % x for x in r.integers(0, 99, 20)] + shared + [b"w%d" % x for x in r.integers(0, 99, 20)]
        keys |= {k for k, s, n, _ in repeats.super_kmers(words, 13) if s <= 20 < s + n}
    assert len(keys) == 1


def test_shingles():
    assert len(similarity.shingles("A b c d e f")) == 2 and len(similarity.shingles("a b")) == 1 and len(similarity.shingles(" \n")) == 0 == len(similarity.shingles(None))
    assert (similarity.shingles("A b C d e") == similarity.shingles("a  b\nc d E")).all()
    assert similarity.shingles("É b c d e")[0] != similarity.shingles("é b c d e")[0]
    assert len(similarity.shingles("x " * 50)) == 1


@settings(max_examples=60)
@given(st.lists(st.lists(st.integers(0, 25), min_size=1, max_size=25), min_size=2, max_size=30))
def test_token_groups_find_all_links(raw):
    sets = [np.unique(np.array(x, np.uint64)) for x in raw]
    found = similarity.search(list(range(len(sets))), sets, list(range(len(sets))), list(range(len(sets))))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def partition(links):
        parent[:] = range(len(sets))
        for a, b in links:
            parent[root(a)] = root(b)
        return {frozenset(i for i in range(len(sets)) if root(i) == r) for r in map(root, range(len(sets)))}

    brute = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(set(raw[a]) & set(raw[b])) >= 80 * len(set(raw[a]) | set(raw[b]))]
    assert partition(found) == partition(brute)


@settings(max_examples=60)
@given(st.lists(st.integers(0, 1 << 62), min_size=1, max_size=40, unique=True), st.data())
def test_linked_sets_share_a_first_token(tokens, data):
    bits = np.frombuffer(np.random.default_rng(0).bytes(1 << 24), np.uint8)
    gone = data.draw(st.sets(st.sampled_from(tokens), max_size=len(tokens) // 8))
    a, b = np.unique(np.array(tokens, np.uint64)), np.unique(np.array([t for t in tokens if t not in gone], np.uint64))
    if similarity.linked(a, b):
        assert set(similarity.first_tokens(a, bits).tolist()) & set(similarity.first_tokens(b, bits).tolist())


@given(st.text(max_size=200), st.text(max_size=50))
def test_fingerprints(text, more):
    one, two = fingerprints.fingerprint(text.encode("utf-8", "surrogatepass")), fingerprints.fingerprint((text + more).encode("utf-8", "surrogatepass"))
    assert fingerprints.likeness(one, one) == 1.0 and 0 <= fingerprints.likeness(one, two) <= 1
    assert fingerprints.likeness(one, two) == pytest.approx(fingerprints.likeness(two, one))
    assert len(one.split(":")[1]) <= 64


def plain_fingerprint(data):
    """Byte by byte."""
    n, block, mix = len(data), 4, 0x9E3779B97F4A7C15
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    while block * 64 < n:
        block *= 2

    def letters(b):
        out, total = "", 0
        for i in range(n):
            value = sum((data[i - k] + 1) * 0x01000193**k for k in range(7) if i >= k) % 2**32 * mix % 2**64
            total = (total + value) % 2**64
            if (value >> 32) % b == b - 1 or i == n - 1:
                out, total = out + alphabet[total * mix % 2**64 >> 58], 0
        return out

    while len(letters(block)) > 64:
        block *= 2
    return f"{block}:{letters(block)}:{letters(2 * block)}"


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=600), st.integers(1, 40), st.integers(1, 3))
def test_fingerprints_byte_by_byte(data, piece, times):
    data *= times
    assert fingerprints.fingerprint(data) == fingerprints.fingerprint(data, piece) == plain_fingerprint(data)


def test_a_very_long_text_is_hashed_piece_by_piece():
    data = np.random.default_rng(1).bytes(50_000_000)
    assert fingerprints.fingerprint(data) == fingerprints.fingerprint(data, 9_999_999)


def test_edits_keep_a_likeness():
    words = np.random.default_rng(2).integers(0, 5000, 3000)
    text = " ".join(f"w{x}" for x in words)
    other = " ".join(f"v{x}" for x in np.random.default_rng(3).integers(0, 5000, 3000))
    mark = fingerprints.fingerprint(text.encode())
    assert fingerprints.likeness(mark, fingerprints.fingerprint((text[:4000] + "an edit" + text[4000:]).encode())) > 0.9
    assert fingerprints.likeness(mark, fingerprints.fingerprint((text[: len(text) // 2] + other[: len(text) // 2]).encode())) > 0.3
    assert fingerprints.likeness(mark, fingerprints.fingerprint(other.encode())) < 0.1
    for odd in (b"", b"a", b"a" * 100_000, b"abc" * 30_000):
        assert len(fingerprints.fingerprint(odd)) < 150


@given(st.text(alphabet="abcdefgh", max_size=64), st.text(alphabet="abcdefgh", max_size=64))
def test_edit_distance(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
    run = min(4, len(a), len(b))
    near = a == b or run and {a[i : i + run] for i in range(len(a) - run + 1)} & {b[i : i + run] for i in range(len(b) - run + 1)}
    assert fingerprints._likeness(a, b) == (1.0 if a == b else 2 * table[-1, -1] / (len(a) + len(b)) if near else 0.0)


def test_additive_model_learns_main_effects_and_a_pair():
    r = np.random.default_rng(0)
    x = r.random((4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.train(x[:3000], y[:3000])
    assert (0, 1) in m.pairs
    assert ((m.score(x[3000:]) > 0.5) == (y[3000:] > 0)).mean() > 0.9
    y = (x[:, 2] > 0.3).astype(float)
    assert ((quality.train(x[:3000], y[:3000]).score(x[3000:]) > 0.5) == (y[3000:] > 0)).mean() > 0.97


def test_additive_model_without_a_choice():
    assert quality.train(np.zeros((0, 20), np.float32), np.zeros(0)).score(np.zeros((2, 20), np.float32)).tolist() == [1.0, 1.0]
    assert quality.train(np.zeros((3, 20), np.float32), np.zeros(3)).score(np.zeros((1, 20), np.float32))[0] < 0.01
    assert len(quality.features(None)) == len(quality.FEATURES) == len(quality.features("a b. C!!\n"))


def test_compression_distance_tells_toxic_words():
    r = np.random.default_rng(0)
    common = ["".join(r.choice(list("aeinorst"), n)) for n in (2, 3, 3, 4, 4, 5, 5, 6, 7, 8) * 4]
    prose = lambda n: " ".join(r.choice(common, n))
    plain = [prose(120) for _ in range(300)]
    toxic = [f"{prose(60)} zkruggolib {prose(60)} qvompfander {prose(5)}" for _ in range(100)]
    m = toxicity.train(toxic[:80], plain[:250])
    p, q = m.compressors()
    score = lambda t: m.score(toxicity.gains(toxicity.windows(t, m.window), p, q))
    assert all(score(t) >= 0.7 for t in toxic[80:]) and all(score(t) < 0.7 for t in plain[250:])
    assert score("") == score(None) == min(m.scores)


def test_single_bytes_over_a_long_text_are_not_toxic():
    r = np.random.default_rng(0)
    common = ["".join(r.choice(list("aeinorst"), n)) for n in (2, 3, 3, 4, 4, 5, 5, 6, 7, 8) * 4]
    prose = lambda n: " ".join(r.choice(common, n))
    m = toxicity.train([f"{prose(60)} zkruggolib {prose(60)} qvompfander {prose(5)}" for _ in range(80)], [prose(120) for _ in range(250)])
    ws = toxicity.windows(f"{prose(800)} zkruggolib {prose(30)} qvompfander", m.window)
    each = [toxicity.gains([w], *m.compressors())[0] for w in ws]
    assert toxicity.gains(ws, *m.compressors()) == (sum(each), max(each)) and m.score((sum(each), max(each))) >= 0.7
    assert m.score((1000.0, 2.0)) < 0.7 and m.score((1000.0, 2.0)) < m.score((1000.0, 11.0))


@pytest.mark.parametrize("n", [10, 75, 200, 10_000])
def test_ordinary_windows_come_from_all_documents(n):
    """Of 75 ordinary documents that build, all give windows while there is room for one each, long ones equally many."""
    texts = [" ".join(f"d{i}w{j}" for j in range(8 * (1 + i % 10))) for i in range(100)]
    got = toxicity._Here([], texts, 8).ordinary(n)
    by = {w.split()[0].split(b"w")[0]: 0 for w in got}
    for w in got:
        by[w.split()[0].split(b"w")[0]] += 1
    assert len(by) == min(n, 75) and len(got) <= n
    most = max(by.values())
    assert all(by[b"d%d" % i] == min(1 + i % 10, most) for i in range(100) if b"d%d" % i in by)
    assert n < 10_000 or len(got) == sum(1 + i % 10 for i in range(100) if i % 4 != 1)


def test_toxicity_without_training_rows():
    assert toxicity.train([], ["a"]).scores == (0.0,) and toxicity.train([], []).scores == (0.0,) and toxicity.train(["x"], []).scores == (1.0,)


def test_crc_of_ids():
    assert zlib.crc32(np.array([1, 2], "<u4").tobytes()) == zlib.crc32(b"\1\0\0\0\2\0\0\0")
