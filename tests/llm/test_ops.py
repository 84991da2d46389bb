"""The operators against brute force on small fixtures with nulls, empty texts, ties, repeats and clashing columns."""

import bisect
import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import decontaminate, jaccard_join, kernel, langid, mixing, pq_neardup, quality, secrets, sharding, suffix_dedup, toxicity

WORDS = ["".join(random.Random(i).choices("abcdefghé", k=3 + i % 5)) for i in range(400)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(120):
        rows.append([i, " ".join(rng.choices(WORDS, k=rng.choice([3, 7, 12, 60, 300]))), "en" if i % 3 else "fr", ["a", "b", None, "cé"][i % 4]])
    for i in range(120, 170):  # near copies, one word changed in each
        words = rows[rng.randrange(60)][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append([i, " ".join(words), "en", "a"])
    passage = " ".join(WORDS[:40])
    for i in range(170, 200):
        rows.append([i, " ".join(rng.choices(WORDS, k=50)) + " " + passage + " " + " ".join(rng.choices(WORDS, k=50)), "en", "b"])
    rows += [[200 + i, rows[5][1], None, "a"] for i in range(30)]
    rows += [[240, None, None, None], [241, "", "en", "a"], [242, " \n\t", "en", "a"], [243, "one", "en", "b"], [244, "ONE", "en", "b"], [245, "x" * 60, "en", "b"], [246, "x" * 70, "en", "cé"]]
    rows += [[247, " ".join(rng.choices(WORDS, k=20000)), "fr", "a"], list(rows[7])]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame([tuple(r) + (1, "x") for r in corpus], "doc_id long, text string, lang string, source string, n long, node string").repartition(3)


def rows_by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: str(r))


def empty(docs):
    return docs.where("false")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c in string.ascii_uppercase else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def groups(n, linked):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_kernel_hashes_do_not_depend_on_place():
    import pyarrow as pa

    buf, offsets = kernel.string_buffer(pa.array(["a loser is LOSER", "loser x", None, "", "loser"]))
    hashes, first = kernel.word_hashes(buf, offsets, kernel.ALNUM)
    assert first.tolist() == [0, 4, 6, 6, 6, 7]
    assert len({int(hashes[i]) for i in (1, 3, 4, 6)}) == 1 and len(set(hashes.tolist())) == 4


@pytest.mark.parametrize("block", [1_000_000, 800])
def test_jaccard_components(docs, corpus, block):
    sets = [shingles(r[1]) for r in corpus]
    want = groups(len(sets), lambda i, j: bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    least = defaultdict(lambda: 1 << 60)
    for r, g in zip(corpus, want, strict=True):
        least[g] = min(least[g], r[0])
    got = jaccard_join.jaccard_components(docs, block=block)
    assert rows_by_id(got) == sorted(((r[0], len(s), least[g]) for r, s, g in zip(corpus, sets, want, strict=True)), key=str)


@pytest.mark.parametrize("block", [1_000_000, 800])
def test_jaccard_rows_without_an_id(spark, corpus, block):
    rng = random.Random(6)
    words = WORDS[:100]
    left, middle, right = words, words[:90] + WORDS[200:210], WORDS[210:220] + words[10:90] + WORDS[200:210]
    rows = [(None, " ".join(middle)), (None, " ".join(middle)), (501, " ".join(left)), (500, " ".join(right))]  # linked by the middle only
    other = [w + "q" for w in words]
    rows += [(None, " ".join(other)), (600, " ".join(other)), (601, " ".join(other[:-1]))]  # the first copy has no id
    rows += [(None, " ".join(w + "z" for w in words[:i])) for i in (100, 99)]
    rows += [(None if rng.random() < 0.4 else r[0], r[1]) for r in corpus]
    sets = [shingles(t) for _, t in rows]
    want = groups(len(sets), lambda i, j: bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    least = {}
    for (i, _), g in zip(rows, want, strict=True):
        least[g] = min((x for x in (i, least.get(g)) if x is not None), default=None)
    assert least[want[2]] == 500 and least[want[6]] == 600
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert rows_by_id(jaccard_join.jaccard_components(docs, block=block)) == sorted(((i, len(s), least[g]) for (i, _), s, g in zip(rows, sets, want, strict=True)), key=str)


def test_jaccard_of_a_family_in_many_blocks(spark):
    """A large family of near copies, some that only chain, and others that share a passage without a link: blocks hold far less than the group."""
    rng = random.Random(12)
    base = rng.choices([f"w{i}" for i in range(3000)], k=60)
    rows = []
    for i in range(120):
        words = list(base)
        words[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(words)))
    chain = list(base)
    for i in range(30):  # each differs from the one before in two words at the end of a growing stretch
        chain = [*chain[2:], f"y{i}", f"z{i}"]
        rows.append((500 + i, " ".join(chain)))
    rows += [(700 + i, " ".join(base[:25] + rng.choices([f"v{j}" for j in range(9000)], k=35))) for i in range(60)]
    rng.shuffle(rows)
    sets = [shingles(t) for _, t in rows]
    want = groups(len(sets), lambda i, j: 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    least = defaultdict(lambda: 1 << 60)
    for (i, _), g in zip(rows, want, strict=True):
        least[g] = min(least[g], i)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for block in (400,):
        got = dict(jaccard_join.jaccard_components(docs, block=block).select("doc_id", "component_id").collect())
        assert got == {i: least[g] for (i, _), g in zip(rows, want, strict=True)}


def test_joined_with_known_classes():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 14, 10).astype(np.uint64)) for _ in range(80)]
    known = rng.integers(0, 60, 80)
    want = groups(80, lambda i, j: known[i] == known[j] or 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])))
    assert jaccard_join.joined(sets, known).tolist() == want
    assert jaccard_join.joined(sets).tolist() == groups(80, lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])))


def test_jaccard_small_sets_and_empty(spark, docs):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randrange(1, 22)))) for i in range(300)]
    rows += [(300 + i, t + " z") for i, t in rows[:100]]
    sets = [shingles(t) for _, t in rows]
    want = groups(len(sets), lambda i, j: 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    got = dict(jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect())
    least = defaultdict(lambda: 1 << 60)
    for (i, _), g in zip(rows, want, strict=True):
        least[g] = min(least[g], i)
    assert got == {i: least[g] for (i, _), g in zip(rows, want, strict=True)}
    assert jaccard_join.jaccard_components(empty(docs)).count() == 0


def test_distinct_documents_keeps_columns(docs, corpus):
    out = jaccard_join.distinct_documents(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) and 5 in ids and not {200, 201} & set(ids) and {240, 241, 242} <= set(ids)


def removed_bytes(corpus, length):
    where = defaultdict(lambda: 1 << 60)
    data = [(r[0], (r[1] or "").encode()) for r in corpus]
    for i, b in data:
        for k in range(len(b) - length + 1):
            where[b[k : k + length]] = min(where[b[k : k + length]], i)
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if where[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, kept))
    return out


def test_suffix_dedup(docs, corpus):
    got = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in suffix_dedup.remove_repeated(docs).collect()]
    assert sorted(got, key=str) == sorted(removed_bytes(corpus, 50), key=str)
    assert suffix_dedup.remove_repeated(empty(docs)).count() == 0


@pytest.mark.parametrize("searched", [1 << 20, 300])
def test_least_of_starts(monkeypatch, searched):
    """Also with keys that have more contexts than are searched at once."""
    monkeypatch.setattr(suffix_dedup, "SEARCHED", searched)
    rng = np.random.default_rng(3)
    texts = sorted({bytes((rng.integers(97, 99, rng.integers(8, 20)) + 2 * (k % 4)).astype(np.uint8)) for k in range(200)})
    keys, least = np.array([(t[0] - 97) // 2 for t in texts], np.uint64), rng.integers(0, 50, len(texts))  # equal strings have equal keys
    want = {}
    for t, k, d in zip(texts, keys, least, strict=True):
        for i in range(len(t) - 7):
            want[k, t[i : i + 8]] = min(d, want.get((k, t[i : i + 8]), 99))
    begin = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = suffix_dedup.least_of_starts(np.frombuffer(b"".join(texts), np.uint8), begin, keys, least, 8)
    assert got.tolist() == [want[k, t[i : i + 8]] for t, k in zip(texts, keys, strict=True) for i in range(len(t) - 7)]


def test_suffix_dedup_of_periodic_and_long_texts(spark, monkeypatch):
    """Periods, hot passages with other text around, texts over a piece, repeats within a text, copies and equal ids."""
    import functools

    monkeypatch.setattr(suffix_dedup, "pieces", functools.partial(kernel.pieces, most=700))
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choices("abcdé ", k=n))
    passage, long = noise(130), noise(3000)
    texts = ["x" * 900, "x" * 120 + noise(80), "ab" * 300, "b" + "abc" * 200, noise(40) + "ab" * 40, long, noise(20) + long[500:2500] + noise(30), long, passage * 3, None, "", "short", noise(49), "é" * 60]
    texts += [noise(rng.randrange(60)) + passage[rng.randrange(40) : 130 - rng.randrange(40)] + noise(rng.randrange(60)) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [(5, long), (3, noise(30) + passage), (None, passage + "!"), (None, passage + "!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in suffix_dedup.remove_repeated(docs).collect()]
    null = (1 << 60) - 1
    want = [(None if r[0] == null else r[0], *r[1:]) for r in removed_bytes([(null if i is None else i, t) for i, t in rows], 50)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_common_intervals_are_equal_prefixes():
    rng = np.random.default_rng(0)
    text = np.append(rng.integers(1, 4, 3000), 0).astype(np.uint8)
    order, block = suffix_dedup.common_intervals(text, 6)
    strings = [bytes(text[i : i + 6]) for i in order]
    for k in range(1, len(order)):
        if len(strings[k]) == 6 == len(strings[k - 1]) and 0 not in strings[k] + strings[k - 1]:
            assert (block[k] == block[k - 1]) == (strings[k] == strings[k - 1])


def test_decontamination(spark, docs, corpus):
    items = [(1, " ".join(WORDS[5:30])), (2, corpus[3][1].upper()), (3, None), (4, "..."), (5, "one"), (6, " ".join(WORDS[5:30])), (7, "x not there at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def tokens(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c in string.ascii_uppercase else c for c in t or ""))

    windows = defaultdict(set)
    for i, t in items:
        w = tokens(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    want = []
    for r in corpus:
        w, hit, which = tokens(r[1]), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if len(w) >= k + n and (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    which |= windows[x]
        want.append((r[0], len(w), len(hit), sorted(map(str, which))))
    got = [tuple(r) for r in decontaminate.contamination(docs, bench).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {r[0] for r in want if not r[2]}
    assert decontaminate.contamination(empty(docs), bench).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs, bench.where("false")).collect()} == {0}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "c x x b x a"), (3, "a x x x x x x x x x b c")], "doc_id long, text string")
    tokens = decontaminate.tokenised(docs)
    phrases = decontaminate.windows(spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
    found = decontaminate.proximity_matches(decontaminate.build_index(tokens), phrases, slack=3).select("doc").distinct()
    assert {r.doc_id for r in tokens.join(found, "doc").collect()} == {1, 2}


def test_secrets(spark):
    rng = random.Random(0)
    key = lambda n, a=string.ascii_letters + string.digits: "".join(rng.choices(a, k=n))
    texts = [None, "", "token=token:abcdefgh secret = 'abc' api_key: \"" + key(30) + "\"", "\U0001f600 PASSWORD=hunter22 AKIA" + key(16, string.ascii_uppercase) + " " + key(40, "0123456789abcdef"), "deadbeef AKIA123", "the-quick-brown-fox-2024-jumps-over", *["see " + key(40) + " there" for _ in range(20)], "x" * 5000 + " token=abcdef"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end, s.kind, s.text) for s in r.spans] for r in secrets.scan(docs, ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        want = [(m.start(), m.end(), "assign", m[0]) for m in re.finditer(secrets.ASSIGN, t, re.A) if len(m[2]) >= 6]
        want += [(m.start(), m.end(), "access", m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [(m.start(), m.end(), "hex", m[0]) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        assert [s for s in got[i] if s[2] != "random"] == sorted(want), t
        assert all(t[a:b] == x for a, b, _, x in got[i])
    assert sum(any(s[2] == "random" for s in got[i]) for i in range(6, 26)) >= 16 and not got[5]
    assert secrets.scan(docs.where("false"), ["doc_id"]).count() == 0


def test_secrets_of_any_length_and_symbols(spark):
    rng = random.Random(1)
    key = lambda n, a=secrets.BASE62: "".join(rng.choices(a, k=n))
    keys = [key(n, secrets.BASE62 + more) for n in (600, 1600, 5000) for more in ("+/", "-_") for _ in range(4)] + [key(40, string.ascii_letters) for _ in range(12)]
    plain = ["x" * 5000, "=" * 40, "-" * 40, "ab-" * 700, "the-quick-brown-fox-2024-jumps-over", "the-quick-brown-fox-jumps-over"]
    docs = spark.createDataFrame(list(enumerate(f"see {t} there" for t in keys + plain)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end, s.kind, s.text) for s in r.spans] for r in secrets.scan(docs, ["doc_id"]).collect()}
    found = [got[i] == [(4, 4 + len(t), "random", t)] for i, t in enumerate(keys)]
    assert sum(found[:24]) >= 23 and sum(found[24:]) >= 11
    assert not any(got[len(keys) + i] for i in range(len(plain)))


def test_secrets_after_a_name(spark):
    rng = random.Random(5)
    key = lambda n, a=secrets.BASE62: "".join(rng.choices(a, k=n))
    forms = [("AWS_SECRET_ACCESS_KEY=", "", ""), ("signing_key=", "", " there"), ("https://h/x?sig=", "", "&page=2"), ("a_name_of_more_than_twenty=", "", ""), ("x=", "-_==", "\n"), ("y=", "+/=", ""), ("see ", "/a-key", ".")]
    cases = [(a, key(40) + more, b) for a, more, b in forms for _ in range(5)]
    plain = ["first_long_name=some-plain-words-2024-and-more", "the-quick-brown-fox-2024-jumps-over=the-quick-brown-fox-2024-jumps-over", "=" * 60, "name" + "=" * 40 + "value", "a=b=" * 30]
    docs = spark.createDataFrame(list(enumerate([a + t + b for a, t, b in cases] + plain)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end, s.kind, s.text) for s in r.spans] for r in secrets.scan(docs, ["doc_id"]).collect()}
    wrong = [(c, got[i]) for i, c in enumerate(cases) if got[i] != [(len(c[0]), len(c[0] + c[1]), "random", c[1])]]
    assert len(wrong) <= 1, wrong
    assert not any(got[len(cases) + i] for i in range(len(plain)))
    odd = spark.createDataFrame([("ab=cd",), ("",), (None,), ("==",), ("x",)], "token string")
    assert all(r.p is None for r in secrets.battery(odd).collect())


def test_battery_matches_a_plain_reading(spark):
    rng = random.Random(2)
    alphabets = {"hex": secrets.HEX_DIGITS, "base32": secrets.BASE32, "base62": secrets.BASE62, "base64": secrets.BASE62 + "+/"}
    tokens = [("".join(rng.choices(a, k=n - 2)) + a[-2:], e) for e, a in alphabets.items() for n in (40, 255, 256, 257, 258, 513, 2000)]
    tokens += [(t.translate(str.maketrans("+/", "-_")), e) for t, e in tokens if e == "base64"]
    got = {r.token: r for r in secrets.battery(spark.createDataFrame([(t,) for t, _ in tokens], "token string")).collect()}
    for t, e in tokens:
        v = np.array([alphabets[e].index(c) + 1.0 for c in t.translate(str.maketrans("-_", "+/"))])
        n, k = len(v), len(alphabets[e])
        chi = sum((np.sum(v == x) - n / k) ** 2 for x in range(1, k + 1)) * k / n
        uniform = (np.cbrt(chi / (k - 1)) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
        runs = (np.sum(np.diff(v > k / 2)) - (n - 1) / 2) / math.sqrt((n - 1) / 4)
        serial = np.sum((v[1:] - (k + 1) / 2) * (v[:-1] - (k + 1) / 2)) / ((k * k - 1) / 12 * math.sqrt(n - 1))
        want = [math.erfc(uniform / math.sqrt(2)) / 2, math.erfc(abs(runs) / math.sqrt(2)), math.erfc(abs(serial) / math.sqrt(2))]
        r = got[t]
        assert r.encoding == e and np.allclose([r.p_uniform, r.p_runs, r.p_serial], want, atol=1e-5), (t, r, want)


def test_secrets_of_a_text_with_many_matches(spark):
    """8 MB of lines of hex, assignments and tokens: spans in seconds, each where it is."""
    import time

    rng = random.Random(5)
    word = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    lines = ["%064x" % rng.getrandbits(256) if i % 4 else f"é token = {word(12)} and {word(30)}" for i in range(125_000)]
    text = "\n".join(lines)
    few = "\n".join(lines[:30])
    df = spark.createDataFrame([(1, text), (2, few), (3, None)], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r.spans for r in secrets.scan(df, ["doc_id"]).collect()}
    assert time.time() - began < 120 and got[3] == []
    for i, t in ((1, text), (2, few)):
        base = sorted((m.start(), m.end(), k) for k, p in (("assign", secrets.ASSIGN), ("hex", "[0-9a-f]+")) for m in re.finditer(p, t, re.A) if (len(m[0]) >= 24 if k == "hex" else len(m[2]) >= 6))
        assert sorted((s.start, s.end, s.kind) for s in got[i] if s.kind != "random") == base
        assert all(t[s.start : s.end] == s.text for s in got[i])
        taken = sorted((a, b) for a, b, _ in base)
        more = [(s.start, s.end) for s in got[i] if s.kind == "random"]
        at = [a for a, _ in taken]
        assert all(not (k := bisect.bisect_left(at, e)) or taken[k - 1][1] <= s for s, e in more)
        assert len(more) > 0.9 * sum("token" in x for x in t.split("\n"))


def test_mixing_meets_targets(docs, corpus):
    size = {}
    for r in corpus:
        size[r[3]] = size.get(r[3], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    targets = mixing.weighted_targets(size)
    assert list(targets) and abs(sum(targets.values()) - 1.5 * sum(size.values())) < 1e-6 and all(targets[s] <= 2 * size[s] + 1e-9 for s in size)
    run = lambda cut: mixing.mix_sources(docs, F.array("source"), mixing.word_count(F.col("text")), [F.col("doc_id")], cut=cut)
    taken = {r[0]: r[1] for r in run(True).groupBy("source").agg(F.sum("mix_taken")).collect()}
    assert all(abs(taken[s] - targets[s]) <= 1 for s in size)
    assert rows_by_id(run(False).select("doc_id", "mix_taken")) == rows_by_id(run(False).select("doc_id", "mix_taken"))
    assert run(False).where("mix_taken > 2 * mix_size").count() == 0
    assert mixing.repeated(run(False)).columns == docs.columns
    assert mixing.mix_sources(empty(docs), F.array("source"), F.lit(1), [F.col("doc_id")]).count() == 0


def test_mixing_takes_the_seeded_order(spark):
    rows = [(i, "abc"[i * 7 % 11 % 3], "abc"[i * 5 % 13 % 3], i * 3 % 10) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, s string, t string, w long")
    mixed = mixing.mix_sources(docs, F.array("s", "t"), F.col("w"), [F.col("doc_id")], {"a": 1000, "b": 3000, "c": 5000}, cut=True)
    groups, order = {}, F.shiftrightunsigned(F.xxhash64(F.lit(17), "doc_id"), 64 - mixing.ORDER_BITS)
    for r in mixed.withColumn("o", order).collect():
        groups.setdefault(tuple(r.mix_pattern), []).append((r.o, r.mix_size, r.mix_taken))
    assert len(groups) > 3 and sum(t for g in groups.values() for _, _, t in g) == 9000
    for group in groups.values():
        whole, left = divmod(sum(t for _, _, t in group), sum(w for _, w, _ in group))
        for _, w, taken in sorted(group):
            more = min(w, left)
            left -= more
            assert taken == whole * w + more


def test_mixing_of_ties_and_nulls(spark):
    rows = [(None, "a b c", "x", 1)] * 2 + [(1, None, None, 2), (2, "", "x", 2)] + [(3, "q w e r", "y", 3)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_p int")
    for cut in (True, False):
        mixed = mixing.mix_sources(docs, F.array("source"), mixing.word_count(F.col("text")), [F.col("doc_id")], cut=cut)
        taken = sorted((r.mix_size, r.mix_taken) for r in mixed.collect())
        assert taken == [(0, 0), (0, 0), (3, 6), (3, 6), (4, 4), (4, 4)]


def test_min_cost_flow_prefers_first_copies():
    flow = mixing.min_cost_flow({("a",): 10, ("a", "b"): 10, ("b",): 2}, {"a": 18, "b": 6})
    used = {p: sum(f.values()) for p, f in flow.items()}
    assert sum(f.get("a", 0) for f in flow.values()) == 18 and sum(f.get("b", 0) for f in flow.values()) == 6
    assert sum(max(0, used[p] - c) for p, c in {("a",): 10, ("a", "b"): 10, ("b",): 2}.items()) == 2  # 24 tokens of 22: no more than two are repeats


def test_min_cost_flow_is_least():
    """Against every split of small quotas over two sources whose patterns overlap."""
    capacity, cells, quotas = {("a",): 4, ("a", "b"): 6, ("b",): 3}, {(("a",), "a"): 8, (("a", "b"), "a"): 12, (("a", "b"), "b"): 10, (("b",), "b"): 6}, {"a": 9, "b": 8}
    cost = lambda p, n: sum(k // capacity[p] + 1 for k in range(n))
    best = min(cost(("a",), 9 - x) + cost(("a", "b"), x + y) + cost(("b",), 8 - y) for x in range(1, 10) for y in range(2, 9))
    flow = mixing.min_cost_flow(capacity, quotas, cells=cells)
    assert sum(f.get("a", 0) for f in flow.values()) == 9 and sum(f.get("b", 0) for f in flow.values()) == 8
    assert all(n <= cells[p, s] for p, f in flow.items() for s, n in f.items())
    assert sum(cost(p, sum(f.values())) for p, f in flow.items()) == best


@pytest.mark.parametrize("seed", range(6))
def test_no_move_betters_a_flow(seed):
    """Random networks: the flow is maximal (no path augments it) and the least (no cycle improves it)."""
    rng = random.Random(seed)
    sources = [f"s{i}" for i in range(6)]
    capacity = {k: rng.randrange(1, 12) for k in range(9)}
    cells = {(p, s): rng.randrange(1, 25) for p in capacity for s in rng.sample(sources, rng.randrange(1, 5))}
    quotas = {s: rng.randrange(0, 40) for s in sources}
    flow = mixing.min_cost_flow(capacity, quotas, cells=cells)
    used = {p: sum(f.values()) for p, f in flow.items()}
    got = {s: sum(f.get(s, 0) for f in flow.values()) for s in sources}
    assert all(0 < n <= cells[p, s] for p, f in flow.items() for s, n in f.items()) and all(got[s] <= quotas[s] for s in sources)

    def reach(first):
        """Patterns and sources that a token more out of pattern ``first`` can reach by moving others."""
        p_seen, s_seen, queue = {first}, set(), [first]
        while queue:
            p = queue.pop()
            for s in sources:
                if s not in s_seen and flow[p].get(s, 0) < cells.get((p, s), 0):
                    s_seen.add(s)
                    for q in capacity:
                        if q not in p_seen and flow[q].get(s, 0) > 0:
                            p_seen.add(q)
                            queue.append(q)
        return p_seen, s_seen

    pass_of = lambda p, n: -(-n // capacity[p])
    for p in capacity:
        patterns, reached = reach(p)
        if used[p] < sum(cells.get((p, s), 0) for s in sources):
            assert all(got[s] == quotas[s] for s in reached)
            assert all(pass_of(p, used[p] + 1) >= pass_of(q, used[q]) for q in patterns if q != p)  # moving a token here from there gains nothing


def test_mixing_spares_texts_that_sources_share(spark):
    """The rows of one text repeat each other: sources take what only they hold first."""
    rows = [(i, "a" if i < 100 else "b", 10, 1000 + i) for i in range(200)] + [(200 + i, "ab"[i % 2], 10, i // 2) for i in range(200)]
    rows += [(400, None, 10, 0), (401, "a", 0, 5000), (402, None, 0, 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, same long")
    held = mixing.holders(docs, "same", "source").select("doc_id", "source", "size", F.col("mix_pattern").alias("pattern"), F.col("mix_rows").alias("copies"))
    pattern = {r.doc_id: (r.pattern, r.copies) for r in held.collect()}
    assert [pattern[i][1] for i in (0, 200, 202, 400, 401)] == [1, 3, 2, 3, 2]
    assert pattern[0][0] == pattern[1][0] and pattern[401] == pattern[402] and pattern[200] == pattern[400] and len({pattern[i][0] for i in (0, 100, 200, 202, 402)}) == 5
    targets = {"a": 1500, "b": 1200, None: 5}
    mixed = mixing.mix_sources(held, None, F.col("size"), [F.col("doc_id")], targets, cut=True, own=F.col("source"), pattern=F.col("pattern"), copies=F.col("copies")).collect()
    taken = Counter()
    for r in mixed:
        taken[r.source] += r.mix_taken
        assert r.mix_taken <= 2 * r.mix_size
    assert taken == targets
    # 1000 distinct words in each source's own and 1000 that both hold: one pass over all is 3000, and 2705 are wanted
    shared = sum(r.mix_taken for r in mixed if r.copies > 1)
    assert 705 <= shared <= 1000


@pytest.mark.parametrize("count", [130, 5000])
def test_mixing_of_many_sources(spark, count):
    """Thousands of sources and patterns: no bound, targets as exact, and a plan with a row for each source in a pattern."""
    rng = random.Random(count)
    rows = [(i, f"s{i % count:05}", rng.randrange(1, 30), i) for i in range(4 * count)]
    rows += [(4 * count + i, f"s{i:05}", 20, -1) for i in range(count)]  # a text that all hold
    rows += [(5 * count + i, f"s{(7 * i + j) % count:05}", 11, -2 - i) for i in range(count // 2) for j in range(3)]  # a pattern of three for each
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, same long")
    held = mixing.holders(docs, "same", "source").withColumnsRenamed({"mix_pattern": "pattern", "mix_rows": "copies"})
    sizes = Counter()
    for r in rows:
        sizes[r[1]] += r[2]
    targets = mixing.weighted_targets(sizes)
    mixed = mixing.mix_sources(held, None, F.col("size"), [F.col("doc_id"), F.col("source")], targets, cut=True, own=F.col("source"), pattern=F.col("pattern"), copies=F.col("copies"))
    taken = Counter()
    for r in mixed.collect():
        taken[r.source] += r.mix_taken
        assert 0 <= r.mix_taken <= 2 * r.mix_size
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)
    alone = mixing.mix_sources(docs, None, F.col("size"), [F.col("doc_id")], cut=True, own=F.col("source")).groupBy("source").agg(F.sum("mix_taken")).collect()
    assert all(abs(r[1] - targets[r[0]]) <= 1 for r in alone) and len(alone) == count




@pytest.mark.parametrize("shards", [1, 5, 40])
def test_sharding(spark, docs, corpus, shards):
    """Near equal bytes, gapless slots, groups of equal texts whole unless larger than a shard; names that clash stay."""
    rng = random.Random(2)
    hot = [(1000 + i, "hot " * 50) for i in range(400)]  # several shards
    warm = [(2000 + 100 * j + i, f"warm {j} " * 20) for j in range(6) for i in range(30 * j)]  # up to much of a shard
    rows = hot + warm + [(3000 + i, " ".join(rng.choices(WORDS, k=rng.randrange(1, 60)))) for i in range(3000)]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, _size long, _h long").repartition(4)
    out = sharding.shard(df, shards, sharding.record_size(F.col("text")), F.col("text"), F.col("doc_id"))
    assert out.columns == ["doc_id", "text", "_size", "_h", "shard", "slot"]
    found = out.collect()
    assert Counter((r.doc_id, r.text, r._size, r._h) for r in found) == Counter((*r, 7, 8) for r in rows)
    size, slots, where, volume = Counter(), defaultdict(list), defaultdict(set), Counter()
    for r in found:
        n = len(r.text.encode()) + 8
        size[r.shard] += n
        volume[r.text] += n
        slots[r.shard].append(r.slot)
        where[r.text].add(r.shard)
    ideal = sum(size.values()) / shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(shards))
    assert all(len(s) == 1 or volume[t] > ideal for t, s in where.items())
    whole = max([v for v in volume.values() if v <= ideal], default=0)
    assert all(abs(x - ideal) <= max(0.05 * ideal, whole) for x in size.values()), (ideal, size)
    assert sharding.shard(empty(docs), shards, F.lit(1), F.col("text"), F.col("doc_id")).count() == 0


def test_sharding_of_equal_and_of_few_rows(docs, corpus):
    even = docs.where("doc_id < 247").select("doc_id", F.lit("t").alias("text"))
    sizes = sharding.shard(even, 6, F.lit(10), F.col("text"), F.col("doc_id")).groupBy("shard").count().collect()
    assert max(r[1] for r in sizes) - min(r[1] for r in sizes) <= 1
    few = sharding.shard(docs.limit(3), 24, F.lit(10), F.col("text"), F.col("doc_id")).collect()
    assert len(few) == 3 and all(r.slot < 3 for r in few)


def test_embeddings(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    x[100:200] = x[:100] + rng.normal(size=(100, 16)).astype(np.float32) * 0.2
    x[200:230] = x[5]
    label = rng.integers(0, 3, 300)
    label[100:200], label[200:230] = label[:100], label[5]
    rows = [(i, x[i].tolist(), int(label[i])) for i in range(300)]
    bad = [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, x[0].tolist(), None), (304, [None] * 16, 1), (305, [], 1), (306, [1.0, 2.0], 1), (307, [2.0, 4.0], 1), (308, [5.0, 5.0, 0.0], 1), (308, [5.0, 5.0, 0.0], 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label)
    want = groups(300, lambda i, j: near[i, j])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pq_neardup.near_duplicates(df).collect()}
    exact = {i: (int(near[i].sum()) - 1, want[i], want[i] == i) for i in range(300)}
    assert sum(got[i][0] for i in range(300)) >= 0.9 * sum(v[0] for v in exact.values())
    assert all(got[i][0] <= exact[i][0] for i in range(300)) and all(got[i] == (0, i, True) for i in range(300, 306))
    assert got[306] == (1, 306, True) and got[307] == (1, 306, False) and got[308] == (1, 308, True)
    assert pq_neardup.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize(("dims", "block"), [(8, 40), (64, 40), (384, 1024)])
def test_embeddings_planted_near_the_threshold(spark, dims, block):
    """Recall of links at cosines from 0.93 on, against brute force: 0.9 at least; with all links found, components agree too.  Blocks far smaller than lists."""
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(700, dims))
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(base)
    side = rng.normal(size=(500, dims))
    side = unit(side - (side * base[:500]).sum(1, keepdims=True) * base[:500])
    cosine = rng.uniform(0.93, 0.97, (500, 1))
    hot = base[0] + 0.1 * unit(rng.normal(size=(300, dims)))
    x = np.concatenate((base, cosine * base[:500] + np.sqrt(1 - cosine**2) * side, hot)).astype(np.float32)
    label = np.concatenate((np.arange(700) % 3, np.arange(500) % 3, np.zeros(300, int)))
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<float>, label int")
    exact = unit(x.astype(float))
    near = (exact @ exact.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in pq_neardup.near_duplicates(df, pq_neardup.Settings(block=block)).collect()}
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.9 * near.sum(), found.sum() / near.sum()
    if found.sum() == near.sum():
        root = pq_neardup.forest(len(x), *np.nonzero(near))
        assert [got[i].component_id for i in range(len(x))] == root.tolist()
        assert all(got[i].kept == (root[i] == i) for i in range(len(x)))
    print(dims, found.sum() / near.sum())


def test_code_lengths_match_a_plain_reading():
    import pyarrow as pa

    texts = {"x": pa.array(["abracadabra", "abab"]), "y": pa.array(["zebra zebra"])}
    model = langid.train(texts)

    def nats(text, sample):
        counts = [defaultdict(Counter) for _ in range(4)]
        for s in sample:
            for k in range(len(s)):
                for o in range(4):
                    context = ("\0" * 3 + s)[k + 3 - o : k + 3]
                    counts[o][context][s[k]] += 1
        total = 0.0
        for k, c in enumerate(text):
            for o in (3, 2, 1, 0, -1):
                if o < 0:
                    total += np.log(256)
                    break
                seen = counts[o][("\0" * 3 + text)[k + 3 - o : k + 3]]
                n = sum(seen.values()) + len(seen)
                if seen[c] > 0:
                    total -= np.log(seen[c] / n)
                    break
                if n := sum(seen.values()):
                    d = len([v for v in seen.values() if v])
                    total -= np.log(d / (n + d))
        return total

    sample = ["abrazebra", "q", ""]
    got = langid.code_lengths(model, *kernel.string_buffer(pa.array(sample)), most=4)
    for s, row in zip(sample, got, strict=True):
        assert np.allclose(row, [nats(s, texts[x].to_pylist()) for x in "xy"], rtol=1e-5)


def test_trees_of_a_hundred_languages():
    """Related and unrelated languages, a hundred texts each: within the bound, told apart, and each cost that of its own tree alone."""
    import pyarrow as pa

    rng = random.Random(12)
    stems = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéüß", k=rng.randrange(2, 7))) for _ in range(3000)]
    texts, held = {}, {}
    for j in range(100):
        own = rng.sample(stems, 250)  # languages share letters, sequences and some words
        make = lambda own=own: " ".join(rng.choices(own, k=60))
        texts[f"l{j:03}"] = pa.array([make() for _ in range(100)])
        held[f"l{j:03}"] = [make() for _ in range(2)]
    model = langid.train(texts)
    assert model.dense.nbytes + sum(x.nbytes() for x in model.levels) < 512 << 20
    sample = pa.array([t for x in sorted(held) for t in held[x]])
    got = langid.code_lengths(model, *kernel.string_buffer(sample))
    assert (got.argmin(1) == np.repeat(np.arange(100), 2)).all()
    for j in (0, 57, 99):
        name = f"l{j:03}"
        alone = langid.code_lengths(langid.train({name: texts[name]}), *kernel.string_buffer(sample))
        assert np.allclose(got[:, j], alone[:, 0], rtol=1e-5)


def test_language_id(spark, docs):
    rng = random.Random(0)
    make = lambda a: " ".join("".join(rng.choices(a, k=5)) for _ in range(30))
    rows = [(i, make("abcde" if i % 2 else "cdefg"), "one" if i % 2 else "two") for i in range(200)] + [(200, None, "one"), (201, "", "one"), (202, "12 34", "one"), (203, make("abcde"), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df.where("doc_id < 100 or doc_id >= 200"))
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, model, ["doc_id"]).collect()}
    assert all(got[i] == ("one" if i % 2 else "two") for i in range(100, 200)) and [got[i] for i in (200, 201, 202)] == ["und"] * 3 and got[203] == "one"
    assert {r.lang_pred for r in langid.predict(df, langid.fit(df.where("false")), ["doc_id"]).collect()} == {"und"}


def test_toxicity(spark):
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choices(WORDS, k=40)) + (" vile" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(600)] + [(600, None, None), (601, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.where("doc_id < 400"), df.where("doc_id < 400").select("doc_id", "toxic"), "toxic")
    got = {r.doc_id: r.score for r in toxicity.score(df, model, F.col("text"), ["doc_id"]).collect()}
    assert sum((got[i] >= 0.3) == (i % 4 == 0) for i in range(400, 600)) >= 195 and got[600] == got[601] and 0 <= got[600] <= 1
    neutral = toxicity.fit(df, df.where("false").select("doc_id", "toxic"), "toxic")
    assert {r.score for r in toxicity.score(df, neutral, F.col("text"), ["doc_id"]).collect()} == {0.5}


def test_toxicity_samples_labelled_documents(spark):
    """Labels of ids that no document has take no place in the sample; repeated rows count once; a byte bound is kept."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(WORDS, k=40)) + (" vile" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows * 3, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic").unionByName(spark.range(1000, 51000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic")))
    one, many = (toxicity.fit(d, k, "toxic", toxicity.Settings(max_rows=200)) for d, k in ((df.distinct(), df.select("doc_id", "toxic").distinct()), (df, labels)))
    assert len(many.index) and many.index.tolist() == one.index.tolist() and np.allclose(many.weight, one.weight)
    from tessella.llm.common import sampled

    found = sampled(df.withColumn("o", F.xxhash64("doc_id")), "o", "text", 1000, 5000)
    assert 5 < found.num_rows < 200 and sum(len(t.encode()) for t in found["text"].to_pylist()) <= 5000


def test_language_table_has_a_bound():
    import pyarrow as pa

    with pytest.raises(ValueError, match="bytes"):
        langid.train({"x": pa.array(["abcdefgh" * 50])}, table_bytes=100)


def test_quality(spark):
    rng = random.Random(0)
    good = lambda: " ".join(rng.choices(WORDS, k=60)).capitalize() + "."
    rows = [(i, good() if i % 3 else good().upper().replace(" ", "!! "), float(bool(i % 3))) for i in range(600)] + [(600, None, None), (601, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality double")
    stats = quality.document_statistics(df, ["doc_id"])
    model = quality.fit(quality.training_rows(stats, df.where("doc_id < 400").select("doc_id", "quality")))
    got = {r.doc_id: r.score for r in quality.score(stats, model, ["doc_id"]).collect()}
    assert sum((got[i] >= 0.3) == bool(i % 3) for i in range(400, 600)) >= 195 and all(0 <= x <= 1 for x in got.values()) and len(got) == 602
    assert {r.score for r in quality.score(stats, quality.fit(quality.training_rows(stats, df.where("false").select("doc_id", "quality"))), ["doc_id"]).collect()} == {0.5}
    assert quality.kept(df, model).columns == df.columns


def test_isotonic_rises():
    v = quality.isotonic(np.array([1.0, 0, 3, 2, 5]), np.array([2.0, 2, 4, 4, 5]))
    assert (np.diff(v) >= 0).all() and abs(v @ np.array([2.0, 2, 4, 4, 5]) - 11) < 1e-9


def test_components_end_converged_or_fail(spark):
    from tessella.llm.common import components

    order = random.Random(0).sample(range(300), 300)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, 0) for i in range(300)}
    with pytest.raises(RuntimeError, match="2 rounds"):
        components(edges, rounds=2)
    assert components(edges.where("false"), rounds=1).count() == 0


def test_crc_fold(spark):
    from tessella.llm.common import fold

    rows = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", fold(F.col("doc_id"), 4)).collect()
    assert all(zlib.crc32(str(r[0]).encode()) % 4 == r[1] for r in rows)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97])
def test_range_lookup_is_bisection(spark, n):
    rng = random.Random(n)
    far = lambda: rng.choice([-(1 << 63), (1 << 63) - 1, rng.randrange(-(1 << 63), 1 << 63), rng.randrange(3)])
    splitters = sorted({(far(), far()) for _ in range(n)})
    keys = splitters + [(far(), far()) for _ in range(100)]
    got = spark.createDataFrame(keys, "h long, i long").select("h", "i", sharding._range_of(splitters)("h", "i").alias("r")).collect()
    assert all(r.r == bisect.bisect_right(splitters, (r.h, r.i)) for r in got)


def test_search_takes_only_strings_that_repeat(monkeypatch):
    """Contexts that share a key and no string are not searched, and of others only what lies between repeated starts is."""
    rng = np.random.default_rng(5)
    noise = lambda n: rng.integers(0, 256, n).astype(np.uint8)
    shared = noise(60)
    texts = [noise(90) for _ in range(40)] + [np.concatenate((noise(25), shared, noise(25))) for _ in range(3)]
    begin = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    least, seen = np.arange(len(texts))[::-1].copy(), []
    search = suffix_dedup.least_documents
    monkeypatch.setattr(suffix_dedup, "least_documents", lambda contexts, *rest: (seen.append(len(contexts)), search(contexts, *rest))[1])
    got = suffix_dedup.least_of_starts(np.concatenate(texts), begin, np.zeros(len(texts), np.uint32), least, 50)
    want = np.concatenate([np.full(len(t) - 49, d) for t, d in zip(texts, least, strict=True)])
    first = np.concatenate(([0], np.cumsum([len(t) - 49 for t in texts])))
    for k in (40, 41, 42):
        want[first[k] + 25 : first[k] + 36] = least[42]
    assert got.tolist() == want.tolist() and seen == [180]


def test_lists_grow_with_the_text_and_parts_more_slowly(spark, monkeypatch):
    """A task of contexts gives a row for each part: parts times lists must not grow with the square of the text."""
    monkeypatch.setattr(suffix_dedup, "LIST_BYTES", 100)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 2000)
    seen, resolve = [], suffix_dedup._resolve
    monkeypatch.setattr(suffix_dedup, "_resolve", lambda contexts, length, groups: (seen.append(groups), resolve(contexts, length, groups))[1])
    docs = spark.createDataFrame([(i, f"{i} " + "same words in all of them, again and again and once more " * 2) for i in range(200)], "doc_id long, text string")
    got = suffix_dedup.remove_repeated(docs).collect()
    total = sum(r.n_bytes for r in got)
    assert seen == [total // 2000] and sorted(r.doc_id for r in got if r.n_removed) == list(range(1, 200))
