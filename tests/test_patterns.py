"""The patterns as written for speed against the rules one by one, on strings that are dense in their symbols."""

import random

from pyspark.sql import functions as F

from tessella.functions import text as tx
from tessella.operators import lines

SPACES = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_]"
BITS = [*"aZ19_()-.;!\n\r\t \x0b\x1c\x1f\x85\xa0  　‐‑–—•·*é­😀𝐀ﬁ>", "  ", "\r\n", "a-\nb-\nc", "- \n ", "aBc", "exhibit 3: ", "Table of Contents", "liſt of tables", "chart 1 - "]


def plain_strip(c):
    return F.regexp_replace(c, rf"\A{SPACES}+|{SPACES}+\z", "")


def plain_clean(c):
    for old, new in (("ﬁ", "fi"), ("ﬂ", "fl"), ("­", "")):
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.replace(F.regexp_replace(c, rf"({WORD})-{SPACES}*\n{SPACES}*({WORD})", "$1$2"), F.lit(" "), F.lit(" "))
    for pattern in (r"(?<=[a-z])(?=[A-Z][a-z])", r"(?<=[a-zA-Z])(?=[0-9])", r"(?<=[0-9])(?=[A-Za-z])", r"(?<=[A-Za-z0-9])(?=\()", r"(?<=\))(?=[A-Za-z0-9])"):
        c = F.regexp_replace(c, pattern, " ")
    for pattern, to in (("[‐–—]+", "-"), ("[•·∙◦*]+", "-"), (rf"{SPACES}+", " "), (rf"\.{SPACES}*([A-Z])", r"\. $1")):
        c = F.regexp_replace(c, pattern, to)
    return plain_strip(c)


def test_patterns_equal_the_rules(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choices(BITS, k=rng.randrange(30))) for _ in range(20_000)]
    texts += ["".join(rng.choices("a-\n b", k=rng.randrange(14))) for _ in range(5_000)] + ["", " ", "\n" * 50_000, "x " * 50_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    t = F.col("t")
    edge = r"(?<![\p{L}\p{N}_])"
    letters = F.regexp_count(t, F.lit(r"\p{L}")) / F.nullif(F.length(plain_strip(t)), F.lit(0))
    caption = t.rlike(rf"(?iu){edge}(?:exhibit|figure|table|chart){SPACES}*\p{{Nd}}+{SPACES}*[:\-–]{SPACES}*")
    pairs = {
        "strip": (tx.strip(t), plain_strip(t)),
        "clean": (tx.clean_text(t), plain_clean(t)),
        "lines": (tx.split_lines(t), F.split(t, r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]", -1)),
        "collapse": (tx.collapse(t), F.regexp_replace(t, rf"{SPACES}+", " ")),
        "sentences": (F.split(t, tx.SENTENCE_BREAK, -1), F.split(t, rf"(?<=[.!?]){SPACES}+(?=[A-Z(0-9])", -1)),
        "gaps": (lines.column_gaps(t), F.regexp_count(plain_strip(t), F.lit(rf"\t|{SPACES}{{2,}}"))),
        "blank": (t.rlike(lines.NOT_BLANK), plain_strip(t) != ""),
        "alpha": (lines.keep_by_alpha_ratio(t), (plain_strip(t) != "") & (caption | F.coalesce(letters >= F.lit(0.2), F.lit(False)))),
        "contents": (t.rlike(lines.CONTENTS), t.rlike(rf"(?iu){edge}(table of contents|list of figures|list of tables)(?![\p{{L}}\p{{N}}_])")),
        "exhibit": (t.rlike(lines.EXHIBIT_OF), t.rlike(rf"(?iu){edge}exhibit{SPACES}*<?\p{{Nd}}+>?{SPACES}*of{SPACES}*<?\p{{Nd}}+>?")),
    }
    wrong = df.select("t", *[(~a.eqNullSafe(b)).alias(k) for k, (a, b) in pairs.items()])
    found = wrong.where(" or ".join(pairs)).limit(5).collect()
    assert not found, found


def test_white_space_and_the_rest_are_all_characters(spark):
    points = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    df = spark.createDataFrame([("".join(points[k : k + 4096]),) for k in range(0, len(points), 4096)], "t string")
    every = df.select(F.explode(F.split("t", "")).alias("c"))
    c = F.col("c")
    assert every.count() == len(points)
    assert every.where(c.rlike(SPACES)).count() == 29
    assert every.where((c.rlike(tx.WS) != c.rlike(SPACES)) | (c.rlike(tx.NOT_WS) == c.rlike(SPACES))).count() == 0


def test_no_class_of_ranges_is_negated():
    # on the JVM a complement beside unions makes all threads of a process wait for each other: many times slower on many cores
    names = ("WS", "NOT_WS", "LINE_BREAK", "HYPHEN_BREAK", "WORD_EDGES", "DASHES", "BULLETS", "STRIPPED", "WS_RUN", "DOT_CAPITAL", "SENTENCE_BREAK", "PARAGRAPH_BREAK", "CLAUSE_BREAK")
    assert [n for n in names if "[^" in getattr(tx, n)] == []
