"""Secret scanning with DataFrame functions only.

Base spans come from three patterns.  The offsets of all matches of a pattern are derived
from the matches and, in texts that have any, from the gaps between them (split by the
same pattern): their lengths add up to code point offsets.

Further spans come from a battery of randomness tests on token-like strings.  For each
candidate an encoding is inferred (hex, base32, base62, base64); under the hypothesis that
its symbols are drawn uniformly from that alphabet, p-values are computed for the
chi-squared statistic of symbol counts, for the number of runs above and below the middle
of the alphabet, and for the lag-one serial correlation.  Strings that are written by
people fail at least one of them; keys don't.  Over all candidates of the input, a
Benjamini-Hochberg step with weights in proportion to length controls the rate of keys
falsely called structured; what it doesn't reject is reported, if it is long enough for
the battery to have told it from prose.  Candidates of any length and of any symbols are
tested: the statistics are sums over a string or over slices of it.  The step needs the p-values of the whole input in
order: they are counted in bins of fixed number, and only the counts meet in one place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run shorter than the minimum can't hold a match, so the minimum is part of these two patterns.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: '=' pads the end and parts a value from its name anywhere else.
TOKEN = r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/=_-]))?"
KINDS = ("assign", "access", "hex", "random")
HEX_DIGITS = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: A slice is split into its symbols at once, a whole string isn't.
SLICE = ".{1,256}"


@dataclass(frozen=True)
class Settings:
    rate: float = 0.01  #: false-discovery rate of the rejections
    bins: int = 2000  #: of -log10 p, 100 to a decade
    least: int = 24  #: shortest reported string; hex and base32 need 32


_SPANS = "array<struct<start:int,end:int,kind:string,text:string>>"


def _scanned(docs: DataFrame, text: Column, patterns: dict[str, str]) -> DataFrame:
    """docs with, for each kind, the matches (``_m_kind``) and the gaps before and after them (``_g_kind``)."""
    docs = docs.withColumn("_t", text)
    docs = docs.withColumns({f"_m_{k}": F.regexp_extract_all("_t", F.lit(p), F.lit(0)) for k, p in patterns.items()})
    return docs.withColumns({f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split("_t", p, -1)) for k, p in patterns.items()})


def _bound(value: Column, body) -> Column:
    """body(value) with value computed once, as lambdas compute what they capture for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(items: Column, kind: str, weight, join, show, chunk: int = 256) -> Column:
    """show(before, item) of each item (of type ``kind``), ``before`` being 0 joined with the weights of all items before it.

    An aggregate copies what it has gathered at each step; so items are gathered chunk by chunk, and only the chunks' joined weights run over
    the whole array: linear in the items of a text, for all practical sizes.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<b:int,x:{kind}>>").alias("out"))

    def within(part: Column) -> Column:
        step = lambda state, x: F.struct(join(state["at"], weight(x)).alias("at"), F.concat(state["out"], F.array(F.struct(state["at"].alias("b"), x.alias("x")))).alias("out"))
        return F.aggregate(part, start, step)

    def across(done: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda state, d: F.struct(join(state["at"], d["at"]).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))
        shown = lambda offsets: F.flatten(F.zip_with(done, offsets, lambda d, o: F.transform(d["out"], lambda e: show(join(o, e["b"]), e["x"]))))
        return _bound(F.aggregate(done, zero, step, lambda state: state["out"]), shown)

    def whole(every: Column) -> Column:
        last = F.greatest(F.ceil(F.size(every) / chunk).cast("int") - 1, F.lit(0))
        parts = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(every, c * chunk + 1, F.lit(chunk)))
        return _bound(F.transform(parts, within), across)

    return _bound(items, whole)


def _spans(kind: str) -> Column:
    """The matches of a scanned kind as spans in code points: offsets are running sums of gaps and matches."""
    found, gaps = F.col(f"_m_{kind}"), F.col(f"_g_{kind}")
    pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(F.length(g).alias("gap"), m.alias("match")))
    size = lambda p: p["gap"] + F.length(p["match"])
    span = lambda before, p: F.struct((before + p["gap"]).alias("start"), (before + size(p)).alias("end"), F.lit(kind).alias("kind"), p["match"].alias("text"))
    spans = _running(pairs, "struct<gap:int,match:string>", size, lambda a, b: a + b, span)
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(_SPANS))


def _free(tokens: Column, base: Column) -> Column:
    """The tokens that touch no base span: at a token's end, the furthest end of the base spans that begin before it isn't past the token's start.

    Both are sorted together by place, and the furthest end runs along.
    """
    asked = F.transform(tokens, lambda t: F.struct(t["end"].alias("at"), F.lit(0).alias("is_base"), F.lit(0).alias("reach"), t.alias("span")))
    given = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("is_base"), b["end"].alias("reach"), F.lit(None).cast(_SPANS[6:-1]).alias("span")))
    kind = f"struct<at:int,is_base:int,reach:int,span:{_SPANS[6:-1]}>"
    clear = lambda before, x: F.when((x["is_base"] == 0) & (before <= x["span"]["start"]), x["span"])
    kept = _running(F.array_sort(F.concat(asked, given)), kind, lambda x: x["reach"], F.greatest, clear)
    return F.when((F.size(tokens) > 0) & (F.size(base) > 0), F.filter(kept, lambda x: x.isNotNull())).otherwise(tokens)


def _normal_tail(z: Column) -> Column:
    """P(Z > z) for a standard normal Z, by a rational approximation of absolute error below 1e-7."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _normal_tail(F.abs(z)))


def battery(candidates: DataFrame, token: str = "token") -> DataFrame:
    """candidates with ``encoding``, ``p_uniform``, ``p_runs``, ``p_serial`` and their Bonferroni combination ``p``.

    A token that no encoding fits, an empty one or a null one has null p-values.
    """
    t = F.col(token)
    body = F.translate(F.regexp_replace(t, "=+$", ""), "-_", "+/")
    encoding = (
        F.when(t.rlike("^[0-9a-f]+$") | t.rlike("^[0-9A-F]+$"), "hex").when(t.rlike("^[A-Z2-7]+=*$"), "base32").when(t.rlike("^[A-Za-z0-9]+$"), "base62").when(t.rlike("^[A-Za-z0-9+/_-]+=*$"), "base64")
    )
    rows = candidates.withColumn("encoding", encoding)
    alphabet = F.when(F.col("encoding") == "hex", HEX_DIGITS).when(F.col("encoding") == "base32", BASE32).when(F.col("encoding") == "base62", BASE62).otherwise(BASE62 + "+/")
    symbols = F.when(F.col("encoding") == "hex", F.lower(t)).otherwise(body)
    rows = rows.withColumns({"_s": symbols, "_k": F.length(alphabet).cast("double"), "_a": alphabet}).withColumn("_n", F.nullif(F.length("_s"), F.lit(0)).cast("double"))
    n, k = F.col("_n"), F.col("_k")
    slices = F.regexp_extract_all("_s", F.lit(SLICE), F.lit(0))
    each = lambda s: F.filter(F.split(s, ""), lambda c: c != "")
    distinct = F.aggregate(slices, F.array().cast("array<string>"), lambda a, s: F.array_union(a, each(s)))
    squares = F.aggregate(distinct, F.lit(0.0), lambda a, c: a + F.pow(n - F.length(F.replace(F.col("_s"), c, F.lit(""))), F.lit(2.0)))
    rows = rows.withColumn("_chi", squares * k / n - n)
    # Wilson and Hilferty: (chi / df) ** (1/3) is near normal
    df = k - 1
    z_uniform = (F.cbrt(F.col("_chi") / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    halves = lambda a: F.translate("_s", a, "0" * (len(a) // 2) + "1" * (len(a) // 2))
    rows = rows.withColumn("_b", F.when(F.col("encoding") == "hex", halves(HEX_DIGITS)).when(F.col("encoding") == "base32", halves(BASE32)).when(F.col("encoding") == "base62", halves(BASE62)).otherwise(halves(BASE62 + "+/")))
    changes = sum((n - F.length(F.replace(F.col("_b"), F.lit(x), F.lit("")))) / 2 for x in ("10", "01"))
    share = (F.floor(k / 2) / k) * (1 - F.floor(k / 2) / k)  # of each neighbouring pair to differ, halved
    z_runs = (changes - (n - 1) * 2 * share) / F.sqrt((n - 1) * 2 * share * (1 - 2 * share) + 1e-9)
    centre = (k + 1) / 2
    # the sum of products of neighbours, and the value of the symbol before
    first = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("last"))

    def neighbour(state: Column, c: Column) -> Column:
        v = F.instr(F.col("_a"), c) - centre
        return F.struct((state["total"] + state["last"] * v).alias("total"), v.alias("last"))

    serial = F.aggregate(slices, first, lambda state, s: F.aggregate(each(s), state, neighbour))["total"]
    z_serial = serial / ((k * k - 1) / 12 * F.sqrt(F.greatest(n - 1, F.lit(1.0))))
    ok = F.col("encoding").isNotNull() & (n > 1)
    rows = rows.withColumns({"_z_uniform": z_uniform, "_z_runs": z_runs, "_z_serial": z_serial})
    rows = rows.withColumns({"p_uniform": F.when(ok, _normal_tail(F.col("_z_uniform"))), "p_runs": F.when(ok, _two_sided(F.col("_z_runs"))), "p_serial": F.when(ok, _two_sided(F.col("_z_serial")))})
    rows = rows.withColumn("p", F.when(ok, F.least(F.lit(1.0), 3 * F.least("p_uniform", "p_runs", "p_serial"))))
    return rows.drop("_s", "_k", "_a", "_n", "_chi", "_b", "_z_uniform", "_z_runs", "_z_serial")


def rejection_threshold(tested: DataFrame, settings: Settings) -> tuple[float, float]:
    """(threshold on p / weight, mean length) of the weighted Benjamini-Hochberg step over tested rows (token, times, p).

    weight = length / mean length.  A bin's p-values count as its upper edge, which errs to fewer rejections.
    """
    length = F.length("token")
    mean = tested.agg(F.sum(length * F.col("times")) / F.sum("times")).first()[0]
    if not mean:
        return 0.0, 1.0
    q = F.greatest(F.col("p"), F.lit(1e-300)) * mean / length
    b = F.least(F.greatest(F.floor(-F.log10(q) * 100), F.lit(-settings.bins)), F.lit(settings.bins))
    counts = sorted(((r[0], r[1]) for r in tested.groupBy(b.alias("b")).agg(F.sum("times")).collect()), reverse=True)  # at most 2 * bins + 1
    total, seen, found = sum(c for _, c in counts), 0, 0.0
    for at, c in counts:
        seen += c
        if 10 ** (-at / 100) <= settings.rate * seen / total:
            found = 10 ** (-at / 100)
    return found, mean


def scan(docs: DataFrame, keys: list[str], text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(*keys, spans): all spans of each document as array<struct<start, end, kind, text>>, by start, then kind.

    Offsets are code points, ends exclusive.  A null text is empty.  ``keys`` should tell rows apart;
    rows that agree in keys and text keep their number and have the same spans.
    Candidates that touch a base span aren't tested: base spans stay as they are.
    """
    from .common import written

    t = F.coalesce(F.col(text), F.lit(""))
    scanned = _scanned(docs.select(*keys, F.col(text)), t, {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": TOKEN})
    value = lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2)) >= 6  # noqa: E731  failing matches go after matching
    found = scanned.select(*keys, F.concat(F.filter(_spans("assign"), value), _spans("access"), _spans("hex")).alias("base"), _spans("random").alias("tokens"))
    found = written(found.select(*keys, "base", _free(F.col("tokens"), F.col("base")).alias("tokens")), "secret-spans")
    # equal strings get equal p-values, and each occurrence counts in the step
    strings = found.select(F.explode("tokens").alias("s")).groupBy(F.col("s.text").alias("token")).agg(F.count("*").alias("times"))
    tested = written(battery(strings).where("p is not null"), "secret-tests")
    threshold, mean = rejection_threshold(tested, settings)
    need = F.when(F.col("encoding").isin("hex", "base32"), 32).otherwise(settings.least)
    keysets = tested.where((F.col("p") * mean / F.length("token") > threshold) & (F.length("token") >= need)).select("token")
    # few documents have candidates: only those rows are exploded, and matched by string
    one = found.where(F.size("tokens") > 0).select(F.monotonically_increasing_id().alias("_row"), *keys, "base", "tokens")
    one = written(one, "secret-candidates")
    hits = one.select("_row", F.explode("tokens").alias("s")).join(keysets, F.col("s.text") == F.col("token"))
    hits = hits.groupBy("_row").agg(F.collect_list("s").alias("more"))
    none = F.array().cast(_SPANS)
    many = one.join(hits, "_row", "left").select(*keys, F.concat("base", F.coalesce("more", none)).alias("spans"))
    every = found.where(F.size("tokens") == 0).select(*keys, F.col("base").alias("spans")).unionByName(many)
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["text"].alias("text"))))
    return every.select(*keys, F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["text"].alias("text"))).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3(spark, sf_dir):
    """All ``documents``: counts of the base kinds, the digest of base spans, and all spans; a null or empty text has none."""
    from .common import table

    spans = scan(table(spark, sf_dir, "documents"), ["doc_id"])
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return spans.select("doc_id", *[number(k).alias(f"n_{k}") for k in KINDS], F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
