"""Clustering, resampling and archives against brute force on tables with nulls, ties, repeats, hot groups and clashing names."""

import gzip
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_ops import WORDS, corpus, docs  # noqa: F401

from tessella.llm import resample, warc, yinyang

# clustering


def plain_rounds(vectors, centroids, rounds):
    """Lloyd rounds in Python's integers: (clusters, distances, centroids)."""

    def nearest():
        return [min(((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))) for v in vectors]

    centroids = [list(c) for c in centroids]
    for _ in range(rounds):
        at = nearest()
        for k in range(len(centroids)):
            own = [v for v, (_, c) in zip(vectors, at, strict=True) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = nearest()
    return [c for _, c in at], [d for d, _ in at], centroids


@pytest.mark.parametrize(("count", "groups", "spread"), [(1, 1, 5), (12, 3, 40), (12, 12, 3), (30, 5, yinyang.LIMIT - 1)])
def test_bounds_never_change_a_round(count, groups, spread):
    """Many rounds by bounds equal plain rounds, with ties (small values) and beyond the range of doubles, and compute fewer distances."""
    rng = np.random.default_rng(count + spread % 7)
    centres = rng.integers(-spread, spread + 1, (6, 8))
    vectors = np.clip(centres[rng.integers(0, 6, 400)] + rng.integers(-max(1, spread // 10), max(1, spread // 10) + 1, (400, 8)), -yinyang.LIMIT, yinyang.LIMIT)
    vectors[50:90] = vectors[3]
    centroids = vectors[:count].copy()
    group = yinyang.centroid_groups(centroids, groups)
    own, exact, upper, lower = yinyang.first_assignment(vectors, centroids, group)
    spent = 0
    for rounds in range(1, 9):
        moved = np.array(plain_rounds(vectors.tolist(), centroids.tolist(), 1)[2]) if rounds else centroids
        own, exact, upper, lower, computed = yinyang.next_assignment(vectors, own, upper, lower, centroids, moved, group)
        centroids, spent = moved, spent + computed
        want, distance, _ = plain_rounds(vectors.tolist(), centroids.tolist(), 0)
        assert own.tolist() == want
        assert all(e in (-1, d) for e, d in zip(exact.tolist(), distance, strict=True))
    assert count == 1 or spent < 8 * 400 * count


def test_clustering(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)], 1, "x") for i in range(150)]
    rows += [(200 + i, [0.5, 0.25, -0.5, 0.0], 2, "y") for i in range(80)]  # a hot vector, and ties
    rows += [(300, [1e30, -1e30, 0.0, 1.0], 1, "z"), (None, [0.1, 0.2, 0.3, 0.4], 1, None), rows[0], (301, [1.0, 2.0, 3.0, 4.0], None, "")]
    bad = [(400, None, 1, "x"), (401, [], 1, "x"), (402, [1.0] * 3, 1, "x"), (403, [1.0, None, 1.0, 1.0], 1, "x"), (404, [1.0, float("nan"), 1.0, 1.0], 1, "x"), (405, [float("inf"), 1.0, 1.0, 1.0], 1, "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, e array<double>, distance int, row string").repartition(3)
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    out = yinyang.cluster(df, "e", key, k=7, rounds=3, dims=4, groups=3)
    assert out.columns == ["vec_id", "row", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    whole = [[max(-yinyang.LIMIT, min(yinyang.LIMIT, math.floor(64 * x))) for x in r[1]] for r in rows]
    digest = [(r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), v) for r, v in zip(rows, whole, strict=True)]
    start = [v for _, _, v in sorted(digest)[:7]]
    at, distance, centroids = plain_rounds(whole, start, 3)
    inertia = Counter()
    for c, d in zip(at, distance, strict=True):
        inertia[c] += d
    name = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    want = Counter((r[0], r[3], c, d, inertia[c], sum(inertia.values()), name(c)) for r, c, d in zip(rows, at, distance, strict=True))
    assert Counter(tuple(r) for r in out.collect()) == want
    few = yinyang.cluster(df.where("vec_id in (1, 2, 405)"), "e", key, k=7, dims=4).collect()
    assert [(r.vec_id, r.distance) for r in sorted(few)] == [(1, 0), (2, 0)] and {r.cluster for r in few} == {0, 1}
    assert yinyang.cluster(df.where("vec_id >= 400"), "e", key, dims=4).count() == 0
    assert yinyang.cluster(df.where("false"), "e", key, dims=4).columns == out.columns


# resampling


def plain_resample(documents, target, longest, buckets, percent, least):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    def found(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    every = [found(text) for _, text in documents]
    for x in every:
        s.update(x)
    for text in target:
        t.update(found(text))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets))))
    rows = []
    for (i, text), x in zip(documents, every, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, x)) // len(x) if x else 0
        rows.append((i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= least))
    draw = sum(r[4] for r in rows) * percent // 100
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return rows, order[:draw]


@pytest.mark.parametrize(("longest", "buckets", "percent", "most"), [(1, 10000, 10, 64 << 20), (2, 97, 35, 0), (3, 70000, 100, 0)])
def test_resampling(spark, docs, corpus, longest, buckets, percent, most):  # noqa: F811
    """Against plain counting, by broadcast and by the way for large tables, for words and for runs of them."""
    extra = [(500 + i, corpus[9][1]) for i in range(300)] + [(None, corpus[3][1]), (None, None), (900, "É " + "w" * 200 + " Ab-aB 7é")]  # a hot text, null ids, a long word
    df = docs.select("doc_id", "text", "n").unionByName(spark.createDataFrame([(*r, 1) for r in extra], "doc_id long, text string, n long")).repartition(3)
    target = [" ".join(WORDS[5:60]), None, "", "ONE", corpus[2][1]]
    aim = spark.createDataFrame([(x,) for x in target], "text string")
    out = resample.resample(df, aim, "doc_id", longest=longest, buckets=buckets, percent=percent, most=most, carry=["n"])
    assert out.columns == ["doc_id", "n", "n_features", "weight", "score", "rank"]
    got = out.collect()
    rows, drawn = plain_resample([(r[0], r[1]) for r in corpus] + extra, target, longest, buckets, percent, 20)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(r[:4] for r in rows)
    ranks = sorted((r.rank, r.doc_id, r.score) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranks] == list(range(1, len(drawn) + 1)) and [r[1:] for r in ranks] == [(r[0], r[3]) for r in drawn]
    assert resample.resample(df, aim.where("false"), "doc_id").where("rank is not null").count() == len(plain_resample([(r[0], r[1]) for r in corpus] + extra, [], 1, 10000, 10, 20)[1])
    assert resample.resample(df.where("false"), aim, "doc_id").count() == 0
    assert resample.resample(df, aim, "doc_id", percent=0).where("rank is not null").count() == 0


def test_checksums_of_spans():
    rng = random.Random(8)
    data = bytes(rng.randrange(256) for _ in range(3000))
    spans = [(a, a + rng.choice([0, 1, 2, 7, 48, 49, 300])) for a in rng.sample(range(2600), 200)]
    starts, ends = np.array(spans).T
    got = resample.crc32_of_spans(np.frombuffer(data, np.uint8), starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in spans]
    again = resample.crc32_of_spans(np.frombuffer(data, np.uint8), starts, ends, got)
    assert again.tolist() == [zlib.crc32(data[a:b] * 2) for a, b in spans]


# archives

URLS = {
    "http://www.Example.com/a?q=1#top": "com,example,www)/a?q=1",
    "https://example.com:443": "com,example)/",
    "http://u:12@example.com:8080/x": "com,example:8080)/x",
    "http://u:12@example.com/": "com,example)/",
    "https://é.example/a b\tc": "example,é)/a%20b%09c",
    "mailto:x#y": ")mailto:x",
    "": ")",
    None: ")",
}


def test_url_keys(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string").select("url", warc.url_key(F.col("url")).alias("key"))
    assert {r.url: r.key for r in df.collect()} == URLS


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(11)
    rows = [[i, f"https://h{i % 7}.example.org/p/{i}", f"<p>é {i}</p>" * rng.choice([0, 1, 5, 400])] for i in range(120)]
    rows += [[200 + i, "http://hot.example.org/", "<b>hot</b>" * 30] for i in range(90)]  # one URL and one payload
    rows += [[300, None, None], [301, "", ""], [302, "http://x\r\nWARC-Type: y", "z" * 99], [303, "http://x", "z" * 99], [304, "http://x", "z" * 100], [305, "http://y", "z" * 100]]
    rows += [[None, "http://x", "z" * 100], [None, "http://n", "n" * 500], [None, "http://n", "n" * 500], rows[4], [-5, "http://big", "é\r\n\r\n" * 300000], [-6, "http://big", "é\r\n\r\n" * 300000]]
    return rows


def want_of(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            first[data] = min(first.get(data, i), i)
    out = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        m = first.get(data)
        revisit = m is not None and i != m
        out[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", m if revisit else None] += 1
    return out


def test_archives_index_and_lookups(spark, pages, tmp_path):
    df = spark.createDataFrame([(*r, "k", 1) for r in pages], "page_id long, url string, html string, key string, file int").repartition(3)
    archive, index = str(tmp_path / "warc"), "file:" + str(tmp_path / "cdx")
    os.makedirs(archive)
    open(f"{archive}/part-00000-9999-0.warc.gz", "wb").close()  # of a lost attempt
    captures = warc.write_archives(df, archive, most=20000)
    files = {r.file for r in captures.collect()}
    assert set(os.listdir(archive)) == files and len(files) > 3 and captures.count() == len(pages)
    shards = warc.write_index(captures, index, lines=4)
    assert len(os.listdir(str(tmp_path / "cdx"))) == 2 * len(shards) > 2

    found = warc.read_captures(warc.lookup(df.select(warc.url_key(F.col("url")).alias("key"), "page_id"), index, shards), archive, payload=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == want_of(pages)
    text = {(i, (html or "").encode()) for i, _, html in pages}
    assert all((r.page_id, bytes(r.payload)) in text for r in found if r.record_type == "response")
    assert all(r.payload is None for r in found if r.record_type == "revisit")

    keys = spark.createDataFrame([("org,example,hot)/",), ("org,example,h3)/p/3",), ("org,example,nowhere)/",), (None,), ("",), ("zzz",), ("org,example,hot)/",)], "key string")
    by_key = Counter(r.key for r in warc.lookup(keys, index, shards).collect())
    assert by_key == {"org,example,hot)/": 90, "org,example,h3)/p/3": 1}

    # any WARC reader can go through the files: gzip members, one record each
    records = 0
    for name in files:
        with gzip.open(f"{archive}/{name}") as f:
            records += len(re.findall(rb"(?m)^WARC-Type: (?:response|revisit)\r$", f.read()))
    assert records == len(pages)


def test_a_damaged_record_is_an_error():
    data = warc.warc_record("response", 7, "http://a/", b"some payload", hashlib.sha256(b"some payload").hexdigest(), None, "2000-01-01T00:00:00Z")
    assert warc.parse_record(data)["payload"] == b"some payload"
    for bad in (data.replace(b"some", b"same"), data[:-9]):
        with pytest.raises(ValueError, match="damaged"):
            warc.parse_record(bad)


def test_archives_of_an_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    captures = warc.write_archives(none, str(tmp_path / "w"))
    shards = warc.write_index(captures, str(tmp_path / "i"))
    assert captures.count() == 0 and shards == []
    assert warc.lookup(spark.createDataFrame([("a)/",)], "key string"), str(tmp_path / "i"), shards).count() == 0
