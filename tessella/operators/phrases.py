"""Attribute tables to phrase lists and templated sentences, in one projection without UDFs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import count_tokens, hyphen_space_variants, normalize_phrase, protect_mwe, strip

PHRASE_DELIMITERS = "[;,/|]"  # fixed value


def cell(df: DataFrame, name: str) -> Column:
    """The column as text; null and absent cells are empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) if name in df.columns else F.lit("")


def split_phrases(c: Column) -> Column:
    """Parts of a cell; a cell of delimiters only is one phrase, a blank one has none."""
    parts = F.filter(F.split(c, PHRASE_DELIMITERS, -1), lambda s: strip(s) != "")
    return F.when(strip(c) == "", F.array().cast("array<string>")).when(F.size(parts) == 0, F.array(c)).otherwise(parts)


#: A driver's map of more entries than this becomes a table: a literal map is searched entry by entry.
LITERAL_ENTRIES = 32
#: Copies of a dictionary that is too large to broadcast, so that a frequent phrase is dealt to as many tasks.
SALT = 16


def given_phrases(df: DataFrame, columns: Sequence[str]) -> Column:
    """array<struct<p, field>>: the parts of all cells, normalised, in order."""
    named = lambda name: lambda p: F.struct(normalize_phrase(p).alias("p"), F.lit(name).alias("field"))
    every = [F.transform(split_phrases(cell(df, name)), named(name)) for name in columns]
    return F.concat(*every) if every else F.array().cast("array<struct<p:string,field:string>>")


def _grown(each: Column, table: Column) -> Column:
    """Each phrase, followed by its expansions in the map ``table``."""
    none = F.array().cast("array<string>")
    return F.flatten(F.transform(each, lambda s: F.transform(F.concat(F.array(s["p"]), F.coalesce(F.try_element_at(table, s["p"]), none)), lambda p: F.struct(p.alias("p"), s["field"].alias("field")))))


def _forms(grown: Column) -> Column:
    """With hyphens and without, normalised, blank ones left out."""
    forms = F.flatten(F.transform(grown, lambda s: F.transform(hyphen_space_variants(s["p"]), lambda v: F.struct(normalize_phrase(v).alias("p"), s["field"].alias("field")))))
    return F.filter(forms, lambda s: s["p"] != "")


def found_phrases(df: DataFrame, columns: Sequence[str], expand: Mapping[str, Sequence[str]] | None = None) -> Column:
    """array<struct<p, field>> in the order of discovery; expand is a small map that becomes part of the plan."""
    given = given_phrases(df, columns)
    if expand:
        none = F.array().cast("array<string>")
        given = _grown(given, F.create_map(*[x for k, v in expand.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if v else none)]))
    return _forms(given)


def expand_by_table(df: DataFrame, given: str, dictionary: DataFrame, most: int = 64 << 20) -> DataFrame:
    """df with each phrase of the column ``given`` (array<struct<p, field>>) followed by its expansions, by a join.

    dictionary: (phrase string, expansions array<string>); of entries with one phrase the longest list counts, then the greatest.
    Phrases are dealt out with their place, joined, and put together again in order.  The dictionary is broadcast if its measured
    bytes are at most ``most``; beyond that both sides are shuffled by phrase and salt, so that a frequent phrase is split.  The
    other columns go with the first phrase of a row only.  Null phrases, and entries with a null phrase or list, match nothing.
    """
    entries = dictionary.where("phrase is not null and expansions is not null").select("phrase", F.struct(F.size("expansions").alias("n"), F.col("expansions").alias("e")).alias("x"))
    entries = entries.groupBy("phrase").agg(F.max("x").alias("x")).select("phrase", F.col("x.e").alias("expansions"))
    size = entries.agg(F.sum(100 + F.octet_length("phrase") + F.octet_length(F.array_join("expansions", "")) + 20 * F.size("expansions"))).first()[0] or 0
    rest = [c for c in df.columns if c != given]
    rows = df.withColumn("_row", F.monotonically_increasing_id()).select("_row", F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("_")).alias("_rest"), F.posexplode_outer(given).alias("_at", "_s"))
    rows = rows.withColumn("_rest", F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("_rest"))).withColumn("_p", F.col("_s.p"))
    if size <= most:
        rows = rows.join(F.broadcast(entries), F.col("_p") == F.col("phrase"), "left")
    else:
        salted = entries.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        rows = rows.withColumn("_deal", F.pmod(F.xxhash64("_row", "_at"), F.lit(SALT)).cast("int"))
        rows = rows.join(salted, (F.col("_p") == F.col("phrase")) & (F.col("_deal") == F.col("_salt")), "left")
    each = F.struct(F.col("_at").alias("at"), F.col("_s").alias("s"), F.col("expansions").alias("e"))
    back = rows.groupBy("_row").agg(F.array_sort(F.collect_list(F.when(F.col("_at").isNotNull(), each))).alias("_all"), F.first("_rest", ignorenulls=True).alias("_rest"))
    none = F.array().cast("array<string>")
    grown = F.flatten(F.transform("_all", lambda x: F.transform(F.concat(F.array(x["s"]["p"]), F.coalesce(x["e"], none)), lambda p: F.struct(p.alias("p"), x["s"]["field"].alias("field")))))
    return back.select(*[F.col(f"_rest.`{c}`") for c in rest], grown.alias(given))


def first_by_lower(c: Column) -> Column:
    """The first of each phrase by lower case, in order: the array is sorted by key and place, and each key's first is put back.

    What lambdas capture is bound first, as they would compute it for each element: n log n in the phrases of a row.
    """
    keyed = F.array_sort(F.transform(c, lambda s, i: F.struct(F.lower(s["p"]).alias("k"), i.alias("i"), s.alias("s"))))
    first = lambda every: F.filter(every, lambda x, i: (i == 0) | (F.get(every, i - 1)["k"] != x["k"]))
    kept = F.get(F.transform(F.array(keyed), first), F.lit(0))
    return F.transform(F.array_sort(F.transform(kept, lambda x: F.struct(x["i"].alias("i"), x["s"].alias("s")))), lambda x: x["s"])


def phrases_text(found: Column, protect: bool = False) -> Column:
    """Phrases by falling length, then lower case, joined by bars."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct((-F.length(s["p"])).alias("n"), F.lower(s["p"]).alias("k"), s["p"].alias("p"))))
    return F.array_join(F.transform(ordered, lambda s: protect_mwe(s["p"]) if protect else s["p"]), " | ")


def template_text(df: DataFrame, id_col: str, summary_col: str, columns: Sequence[str]) -> Column:
    """One of four shapes (fixed values), by whether there are a summary and fields; blank fields are left out."""
    rid, summary = strip(cell(df, id_col)), strip(cell(df, summary_col))
    pairs = [F.when(strip(cell(df, c)) != "", F.concat(F.lit(f"{c}: "), normalize_phrase(cell(df, c)))) for c in columns]
    fields = F.concat_ws("; ", *pairs) if pairs else F.lit("")
    head = F.concat(F.lit("RiskID "), rid, F.lit("."))
    both = F.concat(head, F.lit(" Summary: "), summary, F.lit(" Related attributes — "), fields, F.lit("."))
    only_fields = F.concat(head, F.lit(" Attributes — "), fields, F.lit("."))
    return F.when((summary != "") & (fields != ""), both).when(fields != "", only_fields).when(summary != "", F.concat(head, F.lit(" Summary: "), summary)).otherwise(head)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df with rows numbered from 0 in the order in which they are read, without a gap: one count of each partition, no window."""
    rows = df.withColumn(name, F.monotonically_increasing_id())  # partition in the high bits, place in the low 33
    counts = sorted(rows.groupBy(F.shiftright(name, 33).alias("p")).agg(F.count("*").alias("n")).collect())
    before, found = 0, []
    for p, n in counts:
        found.append((p, before))
        before += n
    starts = df.sparkSession.createDataFrame(found, f"{name}_p long, {name}_before long")  # a row for each partition
    rows = rows.join(F.broadcast(starts), F.shiftright(name, 33) == F.col(f"{name}_p"))
    return rows.withColumn(name, F.col(f"{name}_before") + F.col(name).bitwiseAND((1 << 33) - 1)).drop(f"{name}_p", f"{name}_before")


def render(df: DataFrame, columns: Sequence[str], id_col: str = "RiskID", summary_col: str = "Summary", expand: Mapping[str, Sequence[str]] | DataFrame | None = None, protect: bool = False, row_id: Column | None = None, tokenizer: str | None = None) -> DataFrame:
    """The nine output columns of each row.  Without an id column rows are ``row_n``, by ``row_id`` or else counted from 0.

    expand: expansions of phrases, a map or a table (phrase, expansions); what is more than a few entries is joined.
    """
    if id_col not in df.columns and row_id is None:
        df, row_id = numbered(df, "_row"), F.col("_row")
    who = cell(df, id_col) if id_col in df.columns else F.concat(F.lit("row_"), row_id)
    if isinstance(expand, Mapping) and len(expand) > LITERAL_ENTRIES:
        expand = df.sparkSession.createDataFrame([(k, list(v)) for k, v in expand.items()], "phrase string, expansions array<string>")
    if isinstance(expand, DataFrame):
        rows = expand_by_table(df.withColumns({"_given": given_phrases(df, columns), "_who": who}), "_given", expand)
        rows, who = rows.withColumn("_found", _forms(F.col("_given"))), F.col("_who")
    else:
        rows = df.withColumn("_found", found_phrases(df, columns, expand))
    rows = rows.withColumn("_found", first_by_lower(F.col("_found")))
    text = phrases_text(F.col("_found"), protect)
    rows = rows.select(who.alias("riskid"), text.alias("text_phrases"), template_text(df, id_col, summary_col, columns).alias("text_template"), text.alias("text_mwe"), F.transform("_found", lambda s: s["field"]).alias("fields_used"), cell(df, summary_col).alias("summary"))
    return rows.withColumns({f"tokens_{k}": count_tokens(F.col(f"text_{k}"), tokenizer) for k in ("phrases", "template", "mwe")})


def totals(rendered: DataFrame) -> DataFrame:
    return rendered.agg(F.count("*").alias("rows"), F.coalesce(F.sum("tokens_template"), F.lit(0)).alias("tokens_template"))
