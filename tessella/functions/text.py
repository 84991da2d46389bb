"""Text cleaning, splitting and counting as Column -> Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions import optional

# The 29 code points that count as white space, and the patterns of the cleaning steps.
# Classes are ranges beyond Latin-1, the widest first, and then a table of Latin-1 characters, named one by one; none is negated.  On the
# JVM a complement and a union test the same object for different types, each test undoes what the other has cached, and all threads of
# a process wait for that cache line: many times slower, and the more so the more cores.
_UPPER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_LOWER = _UPPER.lower()
_FAR_WS = r"[\x{1680}-\x{3000}]&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS = rf"[[{_FAR_WS}][\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x{{85}}\x{{a0}}]]"
NOT_WS = r"[!-~[\x{a1}-\x{167f}\x00-\x08\x0e-\x1b\x7f-\x{84}\x{86}-\x{9f}\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}]]"
WORD = r"[\p{L}\p{N}_]"
LINE_BREAK = r"[[\x{2028}-\x{2029}][\n\x0b\f\r\x1c\x1d\x1e\x{85}]](?:(?<=\r)\n)?+"
LIGATURES = (("ﬁ", "fi"), ("ﬂ", "fl"), ("­", ""))
# the hyphen first, as it is rare; a letter that ends a match begins no other; the branch that never holds makes room for letters of two units
HYPHEN_BREAK = rf"-(?<={WORD}(?:-|(?!)--))(?<!\G-){WS}*\n{WS}*({WORD})"
# the five boundaries by the character after them: no two meet at one place and none makes or unmakes another, so one pass does for all
WORD_EDGES = rf"(?=[{_UPPER}({_DIGIT}])(?:(?<=[{_LOWER}])(?=[{_UPPER}][{_LOWER}])|(?<=[{_LOWER}{_UPPER})])(?=[{_DIGIT}])|(?<=[{_DIGIT})])(?=[{_UPPER}])|(?<=[{_UPPER}{_LOWER}{_DIGIT}])(?=\())|(?<=[{_DIGIT})])(?=[{_LOWER}])"
DASHES = "[[‐-—]&&[‐–—]]+"
BULLETS = "[[[•-◦]&&[•∙◦]][*·]]+"
STRIPPED = rf"(?s)\A{WS}*+(.*{NOT_WS})"
WS_RUN = rf"{WS}(?:{WS}++|(?<! ))"  #: all runs but single blanks
DOT_CAPITAL = rf"\.{WS}*([A-Z])"
SENTENCE_BREAK = rf"{WS}(?<=[.!?]{WS}){WS}*+(?=[{_UPPER}({_DIGIT}])"
PARAGRAPH_BREAK = r"\n{2,}|(?<=\.)\n"
CLAUSE_BREAK = rf"(?<=[;:,]){WS}+"
LONG_SENTENCE = 1200
CHARS_PER_TOKEN = 6
TOKENS_PER_WORD = 1.3


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_extract(c, STRIPPED, 1)


def collapse(c: Column) -> Column:
    """A blank for each run of white space."""
    return F.regexp_replace(c, WS_RUN, " ")


def normalize_ligatures(c: Column) -> Column:
    for old, new in LIGATURES:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def fix_linebreak_hyphens(c: Column) -> Column:
    """Words cut by a hyphen at a line's end are joined."""
    return F.regexp_replace(c, HYPHEN_BREAK, "$1")


def clean_text(c: Column) -> Column:
    """All cleaning steps in their order; null and empty texts become empty."""
    c = fix_linebreak_hyphens(normalize_ligatures(F.coalesce(c, F.lit(""))))
    c = F.regexp_replace(c, WORD_EDGES, " ")
    c = F.regexp_replace(F.regexp_replace(c, DASHES, "-"), BULLETS, "-")
    return F.trim(F.regexp_replace(collapse(c), DOT_CAPITAL, r"\. $1"))  # only blanks are left of white space


def split_lines(c: Column) -> Column:
    return F.split(c, LINE_BREAK, -1)


def _pieces(c: Column) -> Column:
    """Stripped and not blank."""
    return F.filter(F.transform(c, strip), lambda s: s != "")


def naive_sentences(c: Column) -> Column:
    """Sentences; those over the limit are cut after semicolons too, which go."""
    split = F.split(F.coalesce(c, F.lit("")), SENTENCE_BREAK, -1)
    cut = F.flatten(F.transform(split, lambda s: F.when(F.length(s) > LONG_SENTENCE, F.split(s, rf";{WS}+", -1)).otherwise(F.array(s))))
    return _pieces(cut)


def paragraphs(c: Column) -> Column:
    return _pieces(F.split(F.coalesce(c, F.lit("")), PARAGRAPH_BREAK, -1))


def bounded_chunks(pieces: Column, max_tokens: int = 512) -> Column:
    """Pieces over the limit are cut at clause ends and packed again, as many as stay under it; a long clause stays whole."""
    limit = max_tokens * CHARS_PER_TOKEN

    def pack(piece: Column) -> Column:
        def add(state: Column, part: Column) -> Column:
            full = (state["buf"] != "") & (F.length(state["buf"]) + F.length(part) >= limit)
            out = F.when(full, F.concat(state["out"], F.array(state["buf"]))).otherwise(state["out"])
            buf = F.when(full | (state["buf"] == ""), part).otherwise(F.concat(state["buf"], F.lit(" "), part))
            return F.struct(out.alias("out"), buf.alias("buf"))

        start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("buf"))
        end = lambda s: F.when(s["buf"] != "", F.concat(s["out"], F.array(s["buf"]))).otherwise(s["out"])
        return F.aggregate(F.split(piece, CLAUSE_BREAK, -1), start, add, end)

    return F.flatten(F.transform(pieces, lambda p: F.when(F.length(p) <= limit, F.array(p)).otherwise(F.transform(pack(p), strip))))


def sentences(c: Column, punkt: bool = False) -> Column:
    """By the Punkt model if asked for and there, or else by the plain rule; blank texts have none."""
    if not punkt:
        return naive_sentences(c)
    found = F.coalesce(optional.punkt(c), naive_sentences(c))
    return F.when(strip(F.coalesce(c, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(found)


def segment_text(c: Column, mode: str = "sentence", max_tokens: int = 512, punkt: bool = False) -> Column:
    """Sentences or paragraphs of a text, each within the length bound; blank texts have none."""
    if mode not in ("sentence", "paragraph"):
        raise ValueError(f"mode {mode!r} is neither sentence nor paragraph")
    return bounded_chunks(paragraphs(c) if mode == "paragraph" else sentences(c, punkt), max_tokens)


def count_tokens(c: Column, tokenizer: str | None = None) -> Column:
    """By the named model's tokenizer if it can be had; else words, each with at most one dotted part, times 1.3, rounded down."""
    if tokenizer:
        return F.coalesce(optional.tokens_by_model(c, tokenizer), count_tokens(c))
    return F.floor(F.regexp_count(F.coalesce(c, F.lit("")), F.lit(rf"{WORD}+(\.{WORD}+)?")) * F.lit(TOKENS_PER_WORD)).cast("int")


def normalize_phrase(c: Column) -> Column:
    return F.regexp_replace(collapse(strip(F.coalesce(c, F.lit("")))), DASHES, "-")


def hyphen_space_variants(c: Column) -> Column:
    """The phrase, and with spaces for its hyphens if it has any."""
    return F.when(F.contains(c, F.lit("-")), F.array(c, F.replace(c, F.lit("-"), F.lit(" ")))).otherwise(F.array(c))


def protect_mwe(c: Column) -> Column:
    return F.regexp_replace(c, rf"{WS}+", "_")


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?\z", 1)
