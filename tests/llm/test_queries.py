"""The operators on small tables with odd rows, against brute force."""

import hashlib
import os
import re
import zipfile
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from crewgrid.llm import common, components, fingerprints, licences, media, mixing, packing, quality, repeats, similarity, toxicity, urls
from tests.conftest import rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `range` string, `set` string, `key` string"


def words(seed, n, vocabulary=400):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, vocabulary, n)]


def texts():
    base = words(1, 120, 5000)
    near = [base[:k] + ["edit"] + base[k + 1 :] for k in (0, 30, 60, 119)]
    chain = [base[i : i + 100] for i in range(0, 21, 4)]
    passage = words(2, 60, 5000)
    out = [" ".join(x) for x in [base, base, *near, *chain]]
    out += [" ".join(words(s, 40, 5000) + passage + words(s + 50, 40, 5000)) for s in range(10, 18)]
    out += ["", None, " \n\t ", "one two", "One  TWO", "one two three four five", "one two three four five six", "x " * 300, "x " * 280, "éa 日本 b　c d e f g"]
    out += [" ".join(words(99, 3000, 5000)), "a MIT license b Apache License c", "<|endoftext|> hi <|endoftext|>", "SPDX-License-Identifier: (MIT OR GPL-2.0-only)\nrest"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    t = texts()
    data = [(i * 3 % 101, x, "en", f"s{i % 4}" if i % 5 else None, 1, "r", "s", "k") for i, x in enumerate(t)]
    data += [data[3], data[3], (None, t[0], "en", "s1", 1, "r", "s", "k"), (None, "alone here today", None, None, 1, "r", "s", "k"), (data[5][0], t[20], "en", "s0", 1, "r", "s", "k")]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text):
    w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(plain):
    sets = [shingle_set(t) for _, t in plain]
    parent = list(range(len(plain)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(plain)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, (d, _) in enumerate(plain):
        if d is not None:
            least[root(i)].append(d)
    return sorted(((d, len(sets[i]), (min(least[root(i)], default=None) if sets[i] else d)) for i, (d, _) in enumerate(plain)), key=repr)


def test_jaccard_join(docs, plain, nothing):
    assert rows(similarity.similar(docs)) == brute_components(plain)
    assert similarity.similar(nothing).count() == 0


def test_jaccard_join_in_small_blocks_and_lists(docs, plain, monkeypatch):
    """Neighbourhoods over many blocks and lists too long to hold give the same."""
    monkeypatch.setattr(similarity, "BLOCK", 3)
    monkeypatch.setattr(similarity, "GROUP", 2)
    monkeypatch.setattr(similarity, "HELD", 4)
    assert rows(similarity.similar(docs)) == brute_components(plain)


def test_jaccard_join_with_ids_of_more_than_one_set(docs, plain, monkeypatch):
    """Of ids that two sets have, the other half of the hash is taken."""
    monkeypatch.setattr(similarity, "SET_BITS", 3)
    assert rows(similarity.similar(docs)) == brute_components(plain)
    assert similarity.representatives(docs).count() == len({c for _, n, c in brute_components(plain) if n}) + sum(not n for _, n, _ in brute_components(plain))


def test_a_long_chain_of_linked_sets(spark):
    """6,000 texts of which each is linked with its neighbours only, in one neighbourhood of many blocks: one component, and few visits."""
    w = words(4, 6000 * 2 + 60, 1 << 40)
    docs = spark.createDataFrame([(i, " ".join(w[2 * i : 2 * i + 40])) for i in range(6000)], "doc_id long, text string").repartition(4)
    got = similarity.similar(docs).collect()
    assert len(got) == 6000 and {r.component_id for r in got} == {0}


@pytest.mark.parametrize(("sets", "batch"), [(5, 1), (7, 1), (10, 1), (7, 10_000)])
def test_lists_too_long_to_hold_are_tied_whole(spark, monkeypatch, sets, batch):
    """A list that ends with the piece that is too much, one that goes on in later batches, one that ends with a second such piece, one in a single batch."""
    monkeypatch.setattr(similarity, "HELD", 4)
    set_id = similarity.SetIds()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        near = [" ".join([*words(5, 100, 5000), f"end{i}"]) for i in range(sets)]
        docs = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string").coalesce(1)
        ties = similarity._ties(docs, spark.sparkContext.broadcast(np.zeros(1 << (similarity.SHARED_BITS - 3), np.uint8)), set_id).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    reached, more = set(), {set_id(similarity.shingles(near[0]))}
    while more:
        reached |= more
        more = {x for t in ties if {t["set"], t["leader"]} & reached for x in (t["set"], t["leader"])} - reached
    assert reached == {set_id(similarity.shingles(t)) for t in near}


def test_sets_of_one_large_neighbourhood_stay_spread(spark):
    """The largest star's name is brought to the sets, not all sets of a neighbourhood to one task."""
    sets = [(1, b, b, j, 10, [100, b]) for b in range(6) for j in (min(b, 2),)]
    starred = spark.createDataFrame(sets, "near long, block long, set long, joint long, n long, tokens array<long>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = similarity._meetings(starred)
        plan = met._jdf.queryExecution().sparkPlan().toString()
        got = {(r.set, r.block) for r in met.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [near#" in plan
    assert got == {(s, b) for s in (0, 1) for b in range(6) if s != b}


@pytest.mark.parametrize("one_task", [0, 4_000_000])
def test_components_by_stars_and_by_one_task(spark, monkeypatch, one_task):
    """Chains, stars and repeated links; contracted locally a few at a time and by stars, or by one task."""
    monkeypatch.setattr(components, "ONE_TASK", one_task)
    monkeypatch.setattr(components, "PIECE", 7)
    r = np.random.default_rng(6)
    links = [(i, i + 1) for i in range(0, 30)] + [(100, 100 + i) for i in range(1, 40)] + [(int(a), int(b)) for a, b in r.integers(200, 400, (150, 2))] + [(5, 5), (3, 2)]
    parent = {x: x for p in links for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    table = common.written(spark.createDataFrame(links, "u long, v long").repartition(4), "links")
    assert rows(components.components(table).select("node", "root")) == sorted(((x, root(x)) for x in parent if root(x) != x), key=repr)


def test_representatives(docs, plain):
    out = similarity.representatives(docs)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    blank = [x for x in plain if not shingle_set(x[1])]
    assert len(got) - len(blank) == len({c for d, n, c in brute_components(plain) if n and c is not None}) + 1 + extra_roots(plain)
    assert set(got) <= set(plain)


def extra_roots(plain):
    """Components that share their id with another (rows of one doc_id with different texts)."""
    sets = {}
    for d, t in plain:
        if shingle_set(t):
            sets.setdefault(d, set()).add(shingle_set(t))
    comp = defaultdict(set)
    for d, n, c in brute_components(plain):
        comp[c].add(d)
    return sum(len(s) - 1 for d, s in sets.items() if d is not None and len(s) > 1 and comp.get(d) == {d})


def brute_repeats(plain):
    first = {}
    cut = [(t or "").encode().split() for _, t in plain]
    for (d, _), w in zip(plain, cut, strict=True):
        if d is not None:
            for i in range(len(w) - 12):
                k = tuple(w[i : i + 13])
                first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(plain, cut, strict=True):
        gone = set()
        if d is not None:
            for i in range(len(w) - 12):
                if first[tuple(w[i : i + 13])] < d:
                    gone |= set(range(i, i + 13))
        out.append((d, len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return out


def test_repeats(docs, plain, nothing, monkeypatch):
    expected = sorted(((d, n, g, hashlib.sha256(b" ".join(k)).hexdigest()) for d, n, g, k in brute_repeats(plain)), key=repr)
    assert rows(repeats.removed(docs)) == expected
    monkeypatch.setattr(repeats, "HELD", 500)
    assert rows(repeats.removed(docs)) == expected
    assert repeats.removed(nothing).count() == 0


def test_repeats_with_frequent_minimisers_and_small_shares(docs, plain, monkeypatch):
    """Most stretches frequent, strings combined a few words at a time, buckets opened a few strings at a time."""
    expected = sorted(((d, n, g, hashlib.sha256(b" ".join(k)).hexdigest()) for d, n, g, k in brute_repeats(plain)), key=repr)
    for name, value in (("HELD", 300), ("OPENED", 200), ("HOT", 5000), ("LEAST", 1)):
        monkeypatch.setattr(repeats, name, value)
    assert len(repeats.frequent(docs.selectExpr("cast(doc_id as long) doc_id", "text"))) > 20
    assert rows(repeats.removed(docs)) == expected


def test_repeats_leave_other_columns(docs, plain):
    out = repeats.deduplicated(docs)
    assert out.columns == docs.columns
    kept = Counter((d, t if not g else b" ".join(k).decode()) for (_, t), (d, _, g, k) in zip(plain, brute_repeats(plain), strict=True))
    assert Counter((r.doc_id, r.text) for r in out.collect()) == kept
    whole = {(d, t) for d, t in plain}
    assert all(r.n_chars == len(r.text) for r in out.collect() if (r.doc_id, r.text) not in whole)


def test_mixing(docs, plain, nothing):
    out = mixing.mix(docs).collect()
    assert len(out) == len(plain)
    total = sum(len((t or "").encode().split()) for _, t in plain)
    targets = {(r.source_size, r.target) for r in out}
    assert sum(t for _, t in targets) == pytest.approx(total) and all(t <= 3 * s for s, t in targets)
    for size, target in targets:
        own = [r for r in out if (r.source_size, r.target) == (size, target)]
        assert sum(r.size for r in own) == size
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own) / 2 + 1e-6
    assert all(r.taken % r.size == 0 and r.taken <= 3 * r.size if r.size else not r.taken for r in out)
    assert rows(mixing.mix(docs)) == sorted((tuple(r) for r in out), key=repr)
    assert mixing.mix(nothing).count() == 0


def brute_reps(plain, targets, seed="mix-1"):
    """(doc_id, text) and times taken, by the order of the hash; equal texts of one id are interchangeable."""
    by = defaultdict(list)
    for d, t, s in plain:
        by[s].append((hashlib.md5(f"{seed}:{'null' if d is None else d}".encode()).hexdigest(), d, t))
    out = Counter()
    for s, own in by.items():
        size, target = sum(len((t or "").encode().split()) for _, _, t in own), targets[s]
        whole = int(target // size) if size else 0
        rest, upto = target - whole * size, 0
        for h, d, t in sorted(own, key=lambda x: x[0]):
            n = len((t or "").encode().split())
            upto += n
            out[(s, d)] += n * (whole + (rest > 0 and 2 * upto - n <= 2 * rest))
    return out


@pytest.mark.parametrize("rows_held", [0, 20_000])
def test_mixing_takes_what_the_order_says(spark, monkeypatch, rows_held):
    """Unique ids with empty texts, ranges divided once or down to single rows; working names taken by columns."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", rows_held)
    r = np.random.default_rng(4)
    plain = [(i, " ".join(words(i, int(n), 50)) if n else None, f"s{i % 5}" if i % 5 else None) for i, n in enumerate(r.choice([0, 0, 3, 8, 40, 300], 300))]
    plain += [(1000 + i, "few words here", "tiny") for i in range(3)]
    d = spark.createDataFrame([(*x, 9, 9, 9, 9, 9) for x in plain], "doc_id long, text string, source string, `__n` int, `__s` int, `__b` int, `__key` int, `__size` int").repartition(4)
    got = mixing.mixed(d).collect()
    assert [c for c in d.columns] == list(got[0].asDict())[:-1] and all(r["__n"] == r["__s"] == r["__b"] == r["__key"] == r["__size"] == 9 for r in got)
    targets = {r.source: r.target for r in mixing.mix(d).join(d.select("doc_id", "source"), "doc_id").collect()}
    taken = Counter()
    for x in got:
        taken[(x.source, x.doc_id)] += x["__reps"] * len((x.text or "").encode().split())
        assert x["__reps"] <= 3
    assert +taken == +brute_reps(plain, targets) and len(got) == len(plain)
    with pytest.raises(ValueError):
        mixing.mixed(d, reps="__n")


def test_mixing_splits_equal_rows(spark):
    """A source of equal rows only, of which a third is taken: so many of them, not all or none, and the same in a rerun."""
    plain = [(None, "one two three", "a")] * 50 + [(7, "one two three", "b")] * 50 + [(i, "x " * 60, "c") for i in range(5)] + [(9, None, "b"), (10, "", None)]
    d = spark.createDataFrame(plain, "doc_id long, text string, source string").repartition(5)
    out = mixing.mix(d).collect()
    for s in {(r.source_size, r.target) for r in out}:
        own = [r for r in out if (r.source_size, r.target) == s]
        assert abs(sum(r.taken for r in own) - s[1]) <= max(r.size for r in own) / 2 + 1e-6 and all(r.taken <= 3 * r.size for r in own)
    assert len(out) == len(plain) and rows(mixing.mix(d)) == sorted((tuple(r) for r in out), key=repr)
    assert all(r["__reps"] <= 3 for r in mixing.mixed(d).collect())


def test_water_filling(spark):
    sizes = {"a": 10, "b": 100, "c": 1000, "d": 5, None: 40}
    df = spark.createDataFrame(list(sizes.items()), "__s string, __size long")
    got = {r["__s"]: r["__target"] for r in mixing.targets(df).collect()}
    weight, left = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}, dict(sizes)
    held, rest = {}, sum(sizes.values())
    while over := [s for s in left if weight[s] * rest / sum(weight[x] for x in left) > 3 * sizes[s]]:
        for s in over:
            held[s] = 3 * sizes[s]
            rest -= held[s]
            del left[s]
    assert got == pytest.approx(held | {s: weight[s] * rest / sum(weight[x] for x in left) for s in left})


def test_media(docs, plain, nothing, spark, monkeypatch):
    path = f"{common.shared_dir(spark)}/media-test"
    media.store(docs, path)
    out = media.media_digests(media.load(spark, path, range_bytes=700, batch_bytes=300)).collect()
    want = Counter()
    for d, t in plain:
        data = (t or "").encode()
        payload = data + bytes(-len(data) % 64 or (0 if data else 64))
        image = media.encode(payload)
        want[(d, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(image), hashlib.sha256(image).hexdigest(), media.feature(payload))] += 1
    assert Counter(tuple(r) for r in out) == want
    media.store(nothing, f"{path}-empty")
    assert media.load(spark, f"{path}-empty").count() == 0


def test_members_are_read_again(docs, spark, monkeypatch):
    path = f"{common.shared_dir(spark)}/media-retry"
    media.store(docs, path)
    reader = media.ArchiveReader(path, 1 << 20, 1 << 20, 2)
    part = reader.partitions()[0]

    with zipfile.ZipFile(part.archive) as archive:
        members = archive.infolist()
    good, broken = list(reader.read(part)), members[1]
    asked, real = [0, 0], media._filesystem

    class Flaky:
        """A source that fails at the second member, so often as is left."""

        def __init__(self, source):
            self.source = source

        def __getattr__(self, name):
            return getattr(self.source, name)

        def read(self, n=-1):
            at = self.source.tell()
            if n == broken.compress_size and broken.header_offset < at < members[2].header_offset:
                asked[0] += 1
                if asked[1]:
                    asked[1] -= 1
                    raise OSError("lost")
            return self.source.read(n)

    class Store:
        def open_input_file(self, path):
            return Flaky(open(path, "rb"))

    monkeypatch.setattr(media, "_filesystem", lambda path: (Store(), real(path)[1]))
    asked[:] = 0, 2
    assert list(reader.read(part)) == good and asked[0] == 3
    asked[:] = 0, 3
    with pytest.raises(OSError):
        list(reader.read(part))
    assert asked == [3, 0]  # retries + 1 times in all
    with open(part.archive, "rb") as f, pytest.raises(OSError):
        reader._member(f, broken.header_offset, broken.compress_size, broken.CRC ^ 1)


def test_licences(docs, plain, nothing):
    found = licences.automaton()
    assert rows(licences.license_scan(docs)) == sorted(((d, *licences.scan(t, found)) for d, t in plain), key=repr)
    assert licences.license_scan(nothing).count() == 0


def brute_pieces(plain, room=1024):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    out = []
    for d, text in plain:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = sorted({0, *range(len(ids), 0, -room)} - {len(ids)})
        for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)], strict=True)):
            out.append((d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    return out


def check_packing(got, room):
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert own[0][0] == 0 and sum(n for _, n in own) <= room and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False))
    return len(by)


def test_packing(docs, plain, nothing):
    got = packing.pack(docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(brute_pieces(plain))
    assert check_packing(got, 1024) <= packing.lower_bound(np.array([r.length for r in got])) + 1
    assert packing.pack(nothing).count() == 0


def test_packing_in_many_partitions_exchanges_gaps(spark):
    many = spark.createDataFrame([(i, " ".join(words(i, 1 + i * 7 % 40))) for i in range(600)], "doc_id long, text string")
    got = packing.pack(many, room=64, per_partition=40).collect()
    lengths = np.array([r.length for r in got])
    assert sum(lengths) == sum(n for _, _, _, n, _ in brute_pieces([(r.doc_id, r.text) for r in many.collect()], 64))
    assert check_packing(got, 64) <= packing.lower_bound(lengths, 64) * 1.03 + 2


def test_urls(spark):
    p = spark.createDataFrame(
        [(1, "HTTP://Example.COM/en/7?x", 1), (2, "http://m.example.com/en/8", 2), (3, "ftp://x.net/de/", None), (4, "http://a.example.net/de/81#t", None), (5, "no scheme", None), (6, None, None),
         (7, "://", None), (8, "http://org/es/1", None), (9, "http://notorg/es/1", None), (10, "http://bad.io/a", 10), (11, "http://bad.io/b", None), (11, "http://bad.io/b", None), (12, "http://a.org?/es/", None)]
        + [(100 + i, "http://bad.io/c", 10) for i in range(40)] + [(200 + i, "http://good.io/c", 2) for i in range(400)],
        "page_id long, url string, doc_id long",
    )
    o = spark.createDataFrame([(10, 1), (2, 0), (1, None), (None, 1)], "doc_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_filter(p, o).collect()}
    assert got[1] == ("example.com", "/en/7", "example.com/en/7", "allow")
    assert got[2] == ("m.example.com", "/en/8", "com/en/", "block")
    assert got[3] == ("x.net", "/de/", "net/de/", "allow")
    assert got[4] == ("a.example.net", "/de/81", "example.net/de/8", "block")
    assert got[5] == got[6] == ("", "", None, "allow") and got[7] == ("", "", None, "allow")
    assert got[8][2:] == ("org/es/", "block") and got[9][2] is None and got[12] == ("a.org", "", None, "allow")
    assert got[11] == ("bad.io", "/b", None, "block") and got[200] == ("good.io", "/c", None, "allow")
    assert urls.url_filter(p, o).count() == p.count()
    assert urls.url_filter(p.limit(0), o).count() == 0


def test_levels_of_hosts(spark):
    hosts = ["a.b.example.com", "x.y.co.uk", "co.uk", "a.com:8080", "10.0.0.1:80", "[::1]", "", "com"]
    d, s = urls.levels(F.col("host"))
    got = {r.host: (r.d, r.s) for r in spark.createDataFrame([(h,) for h in hosts], "host string").select("host", d.alias("d"), s.alias("s")).collect()}
    assert got == {
        "a.b.example.com": ("example.com", "com"), "x.y.co.uk": ("y.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "a.com:8080": ("a.com", "com"),
        "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "[::1]": ("[::1]", "[::1]"), "": ("", ""), "com": ("com", "com"),
    }


def test_many_rules_are_joined(spark, monkeypatch):
    p = spark.createDataFrame([(i, u) for i, u in enumerate(["http://m.example.com/en/7", "http://com/en/", "http://x.example.net/de/8", "http://a.org/", None])], "page_id long, url string")
    host, path = urls.parts(F.col("url"))
    p = p.select("page_id", host.alias("host"), path.alias("path"))
    short = rows(urls.with_rules(p, urls.RULES).select("page_id", "rule", "rule_verdict"))
    monkeypatch.setattr(urls, "INLINE_RULES", 0)
    assert rows(urls.with_rules(p, urls.RULES).select("page_id", "rule", "rule_verdict")) == short


@pytest.mark.parametrize("inline", [0, 256])
def test_of_equally_long_rules_the_last_counts(spark, monkeypatch, inline):
    p = spark.createDataFrame([(1, "a.b.com", "/xy"), (2, "c.org", "/")], "page_id long, host string, path string")
    monkeypatch.setattr(urls, "INLINE_RULES", inline)
    rules = (("allow", "b.com/xy"), ("block", "a.b.com/"), ("block", "c.org/"), ("allow", "c.org/"))
    assert rows(urls.with_rules(p, rules).select("page_id", "rule", "rule_verdict")) == [(1, "a.b.com/", "block"), (2, "c.org/", "allow")]


def test_fingerprints(docs, plain, nothing, spark):
    ids = sorted({d for d, _ in plain}, key=lambda d: (d is not None, d or 0))
    least = {d: min(t or "" for x, t in plain if x == d) for d in ids}
    following = {d: least[ids[(i + 1) % len(ids)]] for i, d in enumerate(ids)}
    want = Counter()
    for d, t in plain:
        t = t or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[d][:half]
        a, b, c = (fingerprints.fingerprint(x.encode()) for x in (t, edited, following[d]))
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, fingerprints.likeness(a, b), fingerprints.likeness(a, c))] += 1
    assert Counter(tuple(r) for r in fingerprints.fingerprints(docs).collect()) == want
    assert fingerprints.fingerprints(nothing).count() == 0
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    assert fingerprints.fingerprints(one).first().near_next == 1.0


def plain_features(text):
    """All of the classifier's features, counted anew, byte by byte and word by word."""
    data = (text or "").encode()
    w = data.split()
    if not w:
        return dict.fromkeys(quality.FEATURES, 0.0)
    upper, letter = set(range(65, 91)), set(range(65, 91)) | set(range(97, 123))
    mark = set(quality._MARK)
    share = lambda x, kinds: sum(b in kinds for b in x) / len(x)
    of_letters = max(1, sum(b in set(quality._LETTER) for b in data))
    lines = [x for x in data.split(b"\n") if x.strip()]
    long_lines = [x for x in lines if len(x) >= 60] or [data]
    repeats = [len(list(g)) - 1 for _, g in groupby(w)]
    places = lambda x: sum(data.startswith(x, i) for i in range(len(data)))
    return {
        "log_words": np.log(1 + len(w)), "word_length": (len(data) - len(w) + 1) / len(w), "letters": share(data, set(quality._LETTER)), "uppercase": sum(b in upper for b in data) / of_letters,
        "marks": share(data, mark), "marked_words": sum(x[-1] in mark for x in w) / len(w), "bars": places(b"|") / len(w), "shouts": len(re.findall(rb"!!", data)) / len(w),
        "digits": share(data, set(b"0123456789")), "distinct_words": len(set(w)) / len(w), "top_word": max(map(w.count, set(w))) / len(w), "adjacent_repeats": sum(repeats) / len(w),
        "longest_repeat": max(repeats), "distinct_lines": len(set(lines)) / len(lines), "words_a_line": len(w) / len(lines),
        "upper_words": sum(len(x) > 2 and any(b in upper for b in x[:3]) and not any(b in letter - upper for b in x[:3]) for x in w) / len(w),
        "sentence_ends": places(b". ") / len(w), "commas": places(b",") / len(w), "worst_line_marks": max(share(x, mark) for x in long_lines), "worst_line_upper": max(share(x, upper) for x in long_lines),
    }


def test_features_are_what_their_names_say(plain):
    odd = ["A B!! C!!! | x.  Y, z. Q", "ABC abc ABCd\n\n" + "x, " * 40 + "\n" + "LOUD LINE " * 9, "a a a b b a", "1 2 3 ... é É"]
    for text in [t for _, t in plain if len(t or "") < 5000] + odd:
        got = dict(zip(quality.FEATURES, quality.features(text), strict=True))
        want = plain_features(text)
        assert set(got) == set(want) and {k for k in got if got[k] != pytest.approx(want[k], rel=1e-6, abs=1e-9)} == set(), text


def held_out(query, spark, column, ways, sf):
    got = {r.doc_id: r for r in query(spark, sf).collect()}
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % ways[0] == ways[1]) for d, r in got.items())
    return [(labels[d], got[d].predicted) for d in labels if got[d].held_out]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the generated tables")
def test_held_out_quality(spark):
    pairs = held_out(quality.op1_quality_classifier, spark, "quality", (5, 0), "/root/testdata/sf0.01")
    assert len(pairs) > 40 and sum(a == b for a, b in pairs) >= 0.97 * len(pairs)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the generated tables")
def test_held_out_toxicity(spark):
    """Over the table with 2,600 training rows; with a tenth of them (sf0.01) 2 of 95 clean held-out rows are flagged."""
    pairs = held_out(toxicity.op8_toxicity, spark, "toxic", (3, 1), "/root/testdata/sf0.1")
    clean, toxic = [p for y, p in pairs if not y], [p for y, p in pairs if y]
    assert sum(clean) <= 0.005 * len(clean) and sum(toxic) >= 0.55 * len(toxic)


def test_quality(docs, plain, nothing, spark):
    labels = spark.createDataFrame([(d, int(i % 3 > 0), 0) for i, (d, _) in enumerate(plain)] + [(None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    x = quality.featured(docs)
    m = quality.fit(x, quality.training_rows(labels, F.lit(True)))
    out = quality.scored(x, m).collect()
    assert len(out) == len(plain) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    kept = quality.good_only(docs, m)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in out)
    assert quality.scored(quality.featured(nothing), m).count() == 0
    assert quality.fit(quality.featured(nothing), quality.training_rows(labels, F.lit(True))).score(np.zeros((1, 20), np.float32))[0] == 1.0


def test_toxicity(docs, plain, nothing, spark):
    labels = spark.createDataFrame([(d, 1, int(t is not None and "edit" in t)) for d, t in plain] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    m = toxicity.fit(docs, labels, F.lit(True))
    out = toxicity.toxicity(docs, m).collect()
    assert len(out) == len(plain) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert {r.score for r in toxicity.toxicity(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), m).collect()} == {min(m.scores)}
    assert toxicity.toxicity(nothing, m).count() == 0


def test_toxicity_trains_on_whole_texts(spark):
    """Toxic words past the first 20,000 characters teach the dictionary, and long clean texts calibrate with all their gain."""
    prose = lambda s, n: " ".join(words(s, n, 300))
    toxic = [(i, f"{prose(i, 6000)} zkruggolib qvompfander {prose(i + 500, 20)}") for i in range(40)]
    clean = [(i, prose(i, 6000 if i % 4 == 0 else 60)) for i in range(100, 200)]
    assert all(t.index("zkruggolib") > 20_000 for _, t in toxic)
    docs = spark.createDataFrame(toxic + clean, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in toxic + clean], "doc_id long, toxic int")
    m = toxicity.fit(docs, labels, F.lit(True))
    assert m == toxicity.train([t for _, t in toxic], [t for _, t in clean])
    assert toxicity.fit(docs, labels, F.lit(True), max_windows=500) == toxicity.train([t for _, t in toxic], [t for _, t in clean], max_windows=500)
    assert all(r.predicted == int(r.doc_id < 100) for r in toxicity.toxicity(docs, m).collect())
