"""Every query as the driver calls it: against its SQL where it has one, and its contract's columns on a small table."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import pytest
from oracle import connect, differences
from pyspark.sql import functions as F
from test_ops import WORDS, corpus, docs  # noqa: F401

from tessella.llm import mixing, queries, secrets

SF = "/root/testdata/sf0.001"
Q = queries.queries()


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_equals_sql(spark, name):
    assert differences(Q[name](spark, SF), connect(SF), queries.oracle_sql()[name]) == []


@pytest.fixture(scope="module")
def small(spark, docs, tmp_path_factory):  # noqa: F811
    """documents with nulls, empty and long texts, copies and other columns; labels; and all empty ones beside."""
    at = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{at}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i % 5 > 0), int(i % 4 == 0)) for i in range(240)] * 2 + [(None, 1, 1), (1, None, None), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{at}/labels.parquet")
    docs.where("false").write.parquet(f"{at}/none/documents.parquet")
    labels.where("false").write.parquet(f"{at}/none/labels.parquet")
    bench = spark.createDataFrame([(1, " ".join(WORDS[5:30])), (2, None)], "item_id long, text string")
    bench.write.parquet(f"{at}/benchmark.parquet")
    bench.where("false").write.parquet(f"{at}/none/benchmark.parquet")
    vectors = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [0.99, 0.05], 1), (3, [1.0, 0.0], 2), (4, None, 1)], "vec_id long, embedding array<float>, label int")
    vectors.write.parquet(f"{at}/embeddings.parquet")
    vectors.where("false").write.parquet(f"{at}/none/embeddings.parquet")
    pages = spark.createDataFrame([(1, "http://a.example/x", "<p>é</p>"), (2, None, None), (3, "https://B.example", "p" * 200), (None, "http://a.example/x", "p" * 200), (0, "", "p" * 200)], "page_id long, url string, html string")
    pages.write.parquet(f"{at}/pages.parquet")
    pages.where("false").write.parquet(f"{at}/none/pages.parquet")
    return at


COLUMNS = {
    "op1_mixing": "doc_id size source_size target taken",
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4_benchmark_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op5_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op6_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op7_quality_classifier": "doc_id held_out score predicted",
    "op8_ngram_jaccard_join": "doc_id n_shingles component_id",
    "op9_language_id": "doc_id held_out lang_pred score",
    "op10_embedding_near_dedup": "vec_id n_links component_id kept",
    "op11_yinyang_clustering": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op12_importance_resampling": "doc_id n_features weight score rank",
    "op13_warc": "page_id payload_bytes payload_digest record_type refers_to",
}
KINDS = {"held_out": "boolean", "score": "double", "predicted": "int", "target": "double", "law": "string", "shard": "int", "grown_shard": "int", "base_sha256": "string", "spans": "string", "items_sha256": "string", "contaminated": "boolean", "kept_sha256": "string", "lang_pred": "string", "kept": "boolean", "cluster": "int", "centroid_sha256": "string", "payload_digest": "string", "record_type": "string"}


@pytest.mark.parametrize("name", list(Q))
def test_columns_and_empty_tables(spark, small, name):
    out = Q[name](spark, f"{small}/none")
    kinds = dict(out.dtypes) | ({"score": "double"} if name.startswith("op12") and dict(out.dtypes)["score"] == "bigint" else {})
    assert {c: KINDS.get(c, "bigint") for c in COLUMNS[name].split()}.items() <= kinds.items()
    assert out.count() == 0


@pytest.mark.parametrize(("name", "modulus", "rest"), [("op2_toxicity", 4, 2), ("op7_quality_classifier", 5, 0), ("op9_language_id", 4, 2)])
def test_held_out_rows_teach_nothing(spark, small, corpus, name, modulus, rest, tmp_path):  # noqa: F811
    """Folds are by crc32, scores are in [0, 1], equal texts have equal scores, and labels of held-out rows don't matter."""
    rows = Q[name](spark, small).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in corpus)
    held = lambda i: zlib.crc32(str(i).encode()) % modulus == rest
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    by_text = defaultdict(set)
    text = {r[0]: r[1] for r in corpus}
    for r in rows:
        by_text[text[r.doc_id]].add(r.score)
    assert all(len(x) == 1 for x in by_text.values())
    if name != "op9_language_id":
        assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    else:
        assert all((r.lang_pred == "und") == (not re.search(r"[^\W\d_]", text[r.doc_id] or "")) for r in rows)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    other = F.when(fold == rest, F.lit(None))
    spark.read.parquet(f"{small}/documents.parquet").withColumn("lang", other.otherwise(F.col("lang"))).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    labels.select("doc_id", *[F.when(fold == rest, 1 - F.col(c)).otherwise(F.col(c)).cast("int").alias(c) for c in ("quality", "toxic")]).write.parquet(f"{tmp_path}/labels.parquet")
    assert sorted(map(str, Q[name](spark, str(tmp_path)).collect())) == sorted(map(str, rows))


def test_mixing_query(spark, small, corpus):  # noqa: F811
    rows = Q["op1_mixing"](spark, small).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in corpus)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    for r in corpus:
        sizes[r[3]] += size(r[1])
    targets = mixing.weighted_targets(sizes)
    for r in rows:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    assert sorted(map(str, rows)) == sorted(map(str, Q["op1_mixing"](spark, small).collect()))


def test_secrets_query(spark, small, corpus):  # noqa: F811
    text = {r[0]: r[1] or "" for r in corpus}
    for r in Q["op3_secret_scan"](spark, small).collect():
        t = text[r.doc_id]
        want = [(m.start(), 0, m.end(), "assign") for m in re.finditer(secrets.ASSIGN, t, re.A) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(want))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w[3] == k for w in want) for k in ("assign", "access", "hex"))
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_sharding_query(spark, small, corpus):  # noqa: F811
    """The law bytes, sizes and checksums, gapless slots, and equal texts in one shard unless they fill more than one."""
    rows = Q["op6_sharding"](spark, small).collect()
    text = {r[0]: r[1] or "" for r in corpus}
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in corpus)
    shards, groups, volume = defaultdict(list), defaultdict(set), Counter()
    for r in rows:
        data = text[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        shards[r.shard].append((r.slot, r["size"]))
        groups[data].add(r.shard)
        volume[data] += r["size"]
    ideal = sum(volume.values()) / 24
    assert set(shards) <= set(range(24)) and all(sorted(s for s, _ in x) == list(range(len(x))) for x in shards.values())
    assert all(len(s) == 1 or volume[t] > ideal for t, s in groups.items())
