"""Benchmark decontamination over a positional inverted index, with DataFrame functions only.

``build_index`` stores a posting (document, term, position) for each training token.
``phrase_matches`` orders the terms of each phrase by how often they occur, takes the
postings of the rarest term as candidate starts (position minus offset), and intersects
them with the offset-adjusted postings of the next rarer terms, until every term has
agreed.  ``proximity_matches`` asks instead for all terms within a window.

A phrase table is bounded by the test set, not by the corpus; it is broadcast only while
``broadcast_bytes`` bounds it, and shuffled beyond that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import kept, private, table, workspace, written

#: Between words of lower-cased texts, and a word of texts as they are; Java is slow with a negated class of many ranges.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; lower() is faster and does the same where no other letter has case to lose."""
    return F.when(text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^A-Z]]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def word_array(text: Column) -> Column:
    """The words of a text in order, split at the gaps; null and empty texts have none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1), "")


def word_count(text: Column) -> Column:
    """The number of words, without making them; null and empty texts have none."""
    return (F.size(F.split(F.coalesce(text, F.lit("")), WORD, -1)) - 1).cast("long")


ROW = 96  #: bytes of a row of up to six numbers in a broadcast hash table, keys and free places included


def _small(df: DataFrame, rows: int, broadcast_bytes: int, row_bytes: int = ROW) -> DataFrame:
    """Broadcast while the counted rows prove it small."""
    return F.broadcast(df) if rows * row_bytes <= broadcast_bytes else df


def windows(items: DataFrame, size: int = 10) -> DataFrame:
    """(phrase array, len, items array) of the distinct windows of ``size`` words; an item of fewer words is one window."""
    items = items.select("item_id", word_array(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    cut = items.select("item_id", "w", F.explode(starts).alias("i")).select("item_id", F.slice("w", F.col("i"), F.least(F.lit(size), F.size("w"))).alias("phrase"))
    cut = cut.distinct().groupBy("phrase").agg(F.collect_set("item_id").alias("items"))
    return cut.select(F.xxhash64("phrase").alias("window"), "phrase", F.size("phrase").alias("len"), "items")


def tokenised(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc, *keys, words): one pass over the texts; ``doc`` is a hash of keys and text, so equal rows share it."""
    return docs.select(F.xxhash64(*keys, F.coalesce(F.col(text), F.lit("")), F.col(text).isNull()).alias("doc"), *keys, word_array(F.col(text)).alias("words"))


def build_index(tokens: DataFrame, terms: DataFrame | None = None, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Stored postings (doc, term, pos) of all tokens, or of those whose word is in terms (word): no other posting can match.

    Without a shuffle where the terms can be broadcast; terms are 64-bit hashes of words.
    """
    postings = tokens.select("doc", F.posexplode("words").alias("pos", "word"))
    if terms is not None:
        known = terms.select(F.col("word").alias("w")).distinct()
        rows, size = known.agg(F.count("*"), F.sum(F.octet_length("w"))).first()
        postings = postings.join(_small(known, 1, broadcast_bytes, rows * ROW + (size or 0)), F.col("word") == F.col("w"), "left_semi")
    return written(postings.select("doc", F.xxhash64("word").alias("term"), "pos"), "postings")


def _ranked(phrases: DataFrame, index: DataFrame, broadcast_bytes: int) -> tuple[DataFrame, int]:
    """(window, len, rank, term, offset): the terms of each phrase from the rarest on; phrases with an absent term can't occur and go."""
    parts = phrases.select("window", "len", F.posexplode("phrase").alias("offset", "word")).select("window", "len", "offset", F.xxhash64("word").alias("term"))
    counts = written(index.groupBy("term").agg(F.count("*").alias("n")), "term-counts")
    parts = parts.join(_small(counts, counts.count(), broadcast_bytes), "term", "left")
    rarest = Window.partitionBy("window").orderBy(F.coalesce("n", F.lit(0)), "term", "offset")
    parts = parts.withColumns({"rank": F.row_number().over(rarest), "least": F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("window"))})
    parts = written(parts.where("least > 0").select("window", "len", "rank", "term", "offset"), "phrase-terms")
    return parts, parts.count()


def phrase_matches(index: DataFrame, phrases: DataFrame, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(doc, window, start, len) of every exact occurrence of the phrases (window, phrase, len).

    The two rarest terms are intersected first, one after the other; what is left is checked against
    all other terms at once by counting the offsets that agree.
    """
    parts, n = _ranked(phrases, index, broadcast_bytes)
    if not n:
        return index.sparkSession.createDataFrame([], "doc long, window long, start int, len int")

    def part(rank: int) -> DataFrame:
        return parts.where(F.col("rank") == rank)

    first = _small(part(1).select("window", "len", F.col("term").alias("t"), "offset"), n, broadcast_bytes)
    found = index.join(first, F.col("term") == F.col("t")).select("doc", "window", F.col("len").alias("len"), (F.col("pos") - F.col("offset")).alias("start")).where("start >= 0").distinct()
    def postings_of(candidates: DataFrame, terms: DataFrame | None) -> DataFrame:
        """The postings (d, t2, p) that candidates may ask for: of their terms, in their documents."""
        lists = index
        if terms is not None:
            lists = lists.join(_small(terms, n, broadcast_bytes), F.col("term") == F.col("x"), "left_semi")
        docs = candidates.select(F.col("doc").alias("d")).distinct()
        lists = lists.join(_small(docs, docs.count(), broadcast_bytes), F.col("doc") == F.col("d"), "left_semi")
        return lists.select(F.col("doc").alias("d"), F.col("term").alias("t2"), F.col("pos").alias("p"))

    for rank in (2, 3):
        # candidates that have such a term need its posting at the adjusted position; shorter phrases pass
        want = written(found.join(_small(part(rank).select(F.col("window").alias("w"), F.col("term").alias("t"), "offset"), n, broadcast_bytes), F.col("window") == F.col("w"), "left").drop("w"), f"candidates-{rank}")
        lists = postings_of(want, part(rank).select(F.col("term").alias("x")).distinct())
        must = want.where("t is not null")
        kept = must.join(lists, (F.col("doc") == F.col("d")) & (F.col("t") == F.col("t2")) & (F.col("start") + F.col("offset") == F.col("p")), "left_semi")
        found = kept.select("doc", "window", "len", "start").unionByName(want.where("t is null").select("doc", "window", "len", "start"))
    found = written(found, "candidates")
    rest = _small(parts.where("rank > 3").select(F.col("window").alias("w"), F.col("term").alias("t"), "offset"), n, broadcast_bytes)
    wanted = found.where("len > 3").join(rest, F.col("window") == F.col("w")).select("doc", "window", "len", "start", "t", (F.col("start") + F.col("offset")).alias("at"))
    lists = postings_of(found, parts.where("rank > 3").select(F.col("term").alias("x")).distinct())
    agreed = wanted.join(lists, (F.col("doc") == F.col("d")) & (F.col("at") == F.col("p")) & (F.col("t") == F.col("t2")), "left_semi")
    whole = agreed.groupBy("doc", "window", "len", "start").agg(F.count("*").alias("n")).where("n = len - 3")
    return whole.select("doc", "window", "start", "len").unionByName(found.where("len <= 3").select("doc", "window", "start", "len"))


def proximity_matches(index: DataFrame, phrases: DataFrame, slack: int = 5, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(doc, window, anchor): postings of a phrase's rarest term with every other term of the phrase within len + slack - 1 words.

    Terms may come in any order; a term that the phrase holds twice must be there once.
    """
    parts, n = _ranked(phrases, index, broadcast_bytes)
    first = _small(parts.where("rank = 1").select("window", "len", F.col("term").alias("t")), n, broadcast_bytes)
    anchors = index.join(first, F.col("term") == F.col("t")).select("doc", "window", "len", F.col("pos").alias("anchor")).distinct()
    others = parts.select(F.col("window").alias("w"), F.col("term").alias("t")).distinct()
    sizes = others.groupBy("w").agg(F.count("*").alias("terms"))
    wanted = anchors.join(_small(others.join(sizes, "w"), n, broadcast_bytes), F.col("window") == F.col("w"))
    near = wanted.join(index.select(F.col("doc").alias("d"), F.col("term").alias("t2"), "pos"), (F.col("doc") == F.col("d")) & (F.col("t") == F.col("t2")) & (F.abs(F.col("pos") - F.col("anchor")) < F.col("len") + slack))
    got = near.groupBy("doc", "window", "anchor", "terms").agg(F.countDistinct("t").alias("n"))
    return got.where("n = terms").select("doc", "window", "anchor")


def contamination(docs: DataFrame, items: DataFrame, keys: tuple[str, ...] = ("doc_id",), size: int = 10) -> DataFrame:
    """(*keys, n_words, n_hit, items): hit words are those inside any occurrence of a window of an item.

    A null text has no words; rows that agree in keys and text have the same result, once for each.
    """
    with workspace(docs.sparkSession):
        phrases = written(windows(items, size), "windows")
        index = build_index(tokenised(docs, keys=keys), phrases.select(F.explode("phrase").alias("word")))
        hits = written(phrase_matches(index, phrases), "phrase-hits")
        spans = hits.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("s"))
        # spans come by start: each adds what lies beyond the furthest end so far
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        covered = F.aggregate("s", zero, lambda a, x: F.struct(F.greatest(a["end"], x["end"]).alias("end"), (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["start"]))).cast("long").alias("n")), lambda a: a["n"])
        owners = phrases.select(F.col("window").alias("w"), F.explode("items").alias("item_id"))
        which = hits.select("doc", "window").distinct().join(owners, F.col("window") == F.col("w")).select("doc", "item_id").distinct()
        which = which.groupBy("doc").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
        found = kept(written(spans.select("doc", covered.alias("n_hit")).join(which, "doc", "left").select(F.col("doc").alias("d"), "n_hit", "items"), "contaminated"))
    counts = docs.select(F.xxhash64(*keys, F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull()).alias("doc"), *keys, word_count(F.col("text")).alias("n_words"))
    out = counts.join(found, F.col("doc") == F.col("d"), "left")
    return out.select(*keys, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.array_sort(F.coalesce("items", F.array().cast("array<string>"))).alias("items"))


def clean(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The rows of docs, all columns as they are, that hold no window of an item.

    Null and empty texts stay, and rows that agree in doc_id and text share their fate.
    """
    (name,) = private(docs, "hit")
    with workspace(docs.sparkSession):
        phrases = written(windows(items, size), "windows")
        index = build_index(tokenised(docs), phrases.select(F.explode("phrase").alias("word")))
        hits = kept(written(phrase_matches(index, phrases).select(F.col("doc").alias(name)).distinct(), "contaminated"))
    key = F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull())
    return docs.join(_small(hits, hits.count(), 64 << 20), key == F.col(name), "left_anti")


def op4(spark, sf_dir):
    """Whole ``documents`` against whole ``benchmark``, windows of ten words."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT g.doc_id, g.n, g.i, win.item_id FROM grams g JOIN win ON g.phrase = win.phrase AND g.n = win.n
), pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS joined FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(its.joined, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""
