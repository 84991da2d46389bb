"""The corpus pipeline: each stage against brute force on what its predecessor kept, and run() against the stages."""

import re
from collections import Counter, defaultdict

from test_ops import WORDS, corpus, docs, groups, shingles  # noqa: F401

from pyspark.sql import functions as F

import corpus_pipeline
from tessella.llm import mixing


def words10(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


CLASHES = ("_d", "_kept", "_hit", "_size", "_r", "_h", "_text", "mix_size", "mix_p", "r", "root", "doc", "d")


def test_stages_and_run(spark, docs, tmp_path):  # noqa: F811
    at = str(tmp_path)
    docs = docs.withColumns({c: F.lit(k) for k, c in enumerate(CLASHES)})  # noqa: F811
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i not in (245, 246)), 0) for i in range(0, 249)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    item = " ".join(WORDS[5:30])
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    now, tables = spark.read.parquet(f"{at}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, at)
        assert out.columns[: len(docs.columns)] == docs.columns and (k == 4 or out.columns == docs.columns)
        out.write.parquet(f"{at}/stage{k}")
        now = spark.read.schema(out.schema).parquet(f"{at}/stage{k}")
        tables.append([tuple(r) for r in now.collect()])
    given = Counter(tuple(r) for r in docs.collect())
    good, distinct, clean, mixed, shards = tables

    assert not Counter(good) - given
    kept = {r[0] for r in good}
    assert len(kept & set(range(200))) >= 190  # prose that is labelled as good stays

    sets = [shingles(r[1]) for r in good]
    group = groups(len(good), lambda i, j: bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    least = defaultdict(list)
    for r, g in zip(good, group, strict=True):
        least[g].append(r)
    assert sorted(min(g, key=lambda r: r[0]) for g in least.values() if g[0][0] is not None) == sorted(r for r in distinct if r[0] is not None)

    def leaks(text):
        w, i = words10(text), words10(item)
        return bool({tuple(w[k : k + 10]) for k in range(len(w) - 9)} & {tuple(i[k : k + 10]) for k in range(len(i) - 9)})

    assert Counter(clean) == Counter(r for r in distinct if not leaks(r[1])) and len(clean) < len(distinct)

    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in clean:
        sizes[r[3]] += size(r)
        longest[r[3]] = max(longest[r[3]], size(r))
    for r in mixed:
        taken[r[3]] += size(r)
    assert set(mixed) <= set(clean) and max((Counter(mixed) - Counter(clean)).values(), default=0) <= 1
    targets = mixing.weighted_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= longest[s] for s in sizes)

    assert Counter(r[:-2] for r in shards) == Counter(mixed)
    slots = defaultdict(list)
    for r in shards:
        slots[r[-2]].append(r[-1])
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())

    again = Counter(tuple(r)[:-2] for r in corpus_pipeline.run(spark, at).collect())
    assert again == Counter(mixed)


def test_stages_of_empty_tables(spark, docs, tmp_path):  # noqa: F811
    at = str(tmp_path)
    none = docs.where("false")
    none.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, at).count() == 0
    few = docs.where("doc_id in (0, 5, 200, 240, 241)")
    assert corpus_pipeline.quality_stage(spark, few, at).count() == 5  # nothing to learn from: all stay
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, few, at).collect()} == {0, 5, 240, 241}
    assert corpus_pipeline.decontamination_stage(spark, few, at).count() == 5
    assert corpus_pipeline.run(spark, at).count() == 0


def test_mixing_stage_of_many_sources(spark):
    rows = [(i, f"text number {i} " * (1 + i % 3), "en", f"source {i % 200}", 1) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")  # noqa: F811
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    targets, taken = mixing.weighted_targets(sizes), Counter()
    out = corpus_pipeline.mixing_stage(spark, docs, "")
    assert out.columns == docs.columns
    for r in out.collect():
        taken[r.source] += len(r.text.split())
    assert all(abs(taken[s] - targets[s]) <= 9 for s in sizes)
