"""Queries for the document and table operators on the driver's tables, each with the same in SQL.

The documents as they are trigger few line operators, so queries on lines append noise lines by doc_id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import sql
from tessella.functions import text as tx
from tessella.operators import folds, layout, lines, phrases
from tessella.plans.pipelines import Options, filtered_lines, process_blocks
from tessella.sources import files, named, pdf, tabular
from tessella.streaming import assembly

NOISE_LINES = [
    "",
    "Table of Contents",
    "Chapter 3 ........ 17",
    "Exhibit 2 of 9",
    "Web <2024> page",
    "- 42 -",
    "12.5 33.1 2,004 | 8%",
    "Table 4: 10 20 30 40 50 60 70",
    "alpha  beta  gamma\nalpha  beta  gamma\nalpha  beta  gamma",
    "left\tmid\tright\nleft\tmid\tright\nleft\tmid\tright",
    "row1  x2  y3\nrow1  x2  y3",
    "aBcDeF co-\noperation",
    "x1y2 f(x)y end.Next – done • ok ﬁne soft­",
    "Scan • Download • Personalize",
    "Figure 12",
    "U.S. rules; all of it. A second one! (Third) 4 more",
]
EXPAND = {"Brand#13": ["Brand-Thirteen", "B13"]}
CHUNK_TOKENS = 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def spread(df: DataFrame) -> DataFrame:
    """df as it is, but a table of fewer splits than cores is dealt out first; large tables never are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def with_noise(docs: DataFrame) -> DataFrame:
    noise = F.element_at(F.array(*map(F.lit, NOISE_LINES)), (F.pmod("doc_id", F.lit(16)) + 1).cast("int"))
    return docs.withColumn("text", F.concat("text", F.lit("\n"), noise))


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_noise(documents(spark, sf_dir))


def _noisy_lines(spark, sf_dir):
    return lines.text_lines(noisy(spark, sf_dir), keys=("doc_id",))


def doc_lines(spark, sf_dir):
    return lines.text_lines(documents(spark, sf_dir), keys=("doc_id",))


def drop_numeric_lines(spark, sf_dir):
    return _noisy_lines(spark, sf_dir).where(lines.keep_by_alpha_ratio(F.col("line")))


def strip_toc_footer(spark, sf_dir):
    return _noisy_lines(spark, sf_dir).where(lines.keep_by_contents(F.col("line")))


def mask_text_tables(spark, sf_dir):
    return lines.mask_text_tables(_noisy_lines(spark, sf_dir), keys=("doc_id",))


def clean_text(spark, sf_dir):
    return noisy(spark, sf_dir).select("doc_id", tx.clean_text(F.col("text")).alias("cleaned"))


def sentence_segments(spark, sf_dir):
    return noisy(spark, sf_dir).select("doc_id", F.posexplode(tx.naive_sentences(tx.clean_text(F.col("text")))).alias("segment_index", "segment"))


def paragraph_segments(spark, sf_dir):
    return noisy(spark, sf_dir).select("doc_id", F.posexplode(tx.paragraphs(F.col("text"))).alias("segment_index", "segment"))


def chunk_long(spark, sf_dir):
    pieces = tx.segment_text(tx.clean_text(F.col("text")), max_tokens=CHUNK_TOKENS)
    return noisy(spark, sf_dir).select("doc_id", F.posexplode(pieces).alias("segment_index", "segment"))


OPTIONS = Options(drop_tables=True, drop_toc=True, drop_text_tables=True)


def _pages(spark, sf_dir):
    """Each document is one page; runs and pages share one distribution by document."""
    rows = filtered_lines(_noisy_lines(spark, sf_dir).repartition("doc_id"), OPTIONS, keys=("doc_id",))
    return lines.clean_pages(lines.page_text(rows, keys=("doc_id",)), keys=("doc_id",))


def full_pipeline(spark, sf_dir):
    return lines.segment_records(_pages(spark, sf_dir), keys=("doc_id",)).withColumnRenamed("text", "segment")


def doc_narrative(spark, sf_dir):
    """Pages are tens of lines of a document; one distribution by document serves pages and documents."""
    rows = _noisy_lines(spark, sf_dir).withColumn("page", F.floor(F.col("line_no") / 10).cast("int")).repartition("doc_id")
    pages = lines.page_text(rows, keys=("doc_id", "page")).select("doc_id", "page", tx.clean_text(F.col("text")).alias("cleaned"))
    return lines.narrative(pages, doc="doc_id")


def token_counts(spark, sf_dir):
    a = documents(spark, sf_dir).select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("part"), tx.count_tokens(F.col("text")).alias("tokens"))
    b = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"), F.col("turn").alias("part"), tx.count_tokens(F.col("text")).alias("tokens"))
    return a.unionByName(b)


def _blocks(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rows.select(F.col("l_orderkey").alias("doc"), F.lit(0).alias("page"), F.col("l_linenumber").alias("block_no"), (F.col("l_quantity") * 10).alias("x0"), (F.col("l_quantity") * 10 + F.col("l_tax") * 1000).alias("x1"), (F.col("l_discount") * 7000).alias("y0"))


def column_reorder(spark, sf_dir):
    return layout.reorder_two_columns(_blocks(spark, sf_dir)).select("doc", "block_no", "reading_no")


def find_captions(spark, sf_dir):
    rows = _noisy_lines(spark, sf_dir).select(F.col("doc_id").alias("doc"), F.lit(0).alias("page"), F.col("line_no").alias("block_no"), *[F.lit(0.0).alias(c) for c in ("x0", "x1", "y1")], F.col("line_no").cast("double").alias("y0"), F.col("line").alias("text"))
    return layout.find_captions(rows).select("doc", "block_no", F.col("text").alias("caption"), "kind", "ordinal", "caption_no")


def _records(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    key = F.col("p_partkey")
    return p.select(
        key.cast("string").alias("RiskID"),
        F.when(key % 7 != 0, F.col("p_name")).alias("Summary"),
        F.when(key % 11 != 0, F.concat("p_brand", F.lit("; "), "p_type")).alias("L1"),
        F.when(key % 11 != 0, F.concat("p_type", F.lit(" / "), "p_name", F.lit(", a-b|"), F.upper("p_brand"))).alias("K"),
        F.when(key % 5 == 0, F.lit(" ; ")).otherwise("").alias("D"),
    )


def _rendered(spark, sf_dir, protect=False):
    return phrases.render(_records(spark, sf_dir), ["L1", "K", "D"], expand=EXPAND, protect=protect)


def phrases_normalised(spark, sf_dir):
    return _rendered(spark, sf_dir).select("riskid", "text_phrases", "tokens_phrases")


def phrases_mwe(spark, sf_dir):
    return _rendered(spark, sf_dir, True).select("riskid", "text_phrases", "text_mwe", "tokens_mwe")


def fields_used(spark, sf_dir):
    return _rendered(spark, sf_dir).select("riskid", F.array_join("fields_used", ",").alias("used"))


def record_template(spark, sf_dir):
    return _rendered(spark, sf_dir).select("riskid", "text_template", "summary", "tokens_template")


def render_totals(spark, sf_dir):
    return phrases.totals(_rendered(spark, sf_dir))


PDF_LINES = 40  #: of a document on each page of the PDF made from it


def _pdf_files(spark, sf_dir):
    """A PDF of each document, made at run time: a line is one TJ of two strings, cut anywhere, 20 below the line before."""
    found = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    shown = F.transform("l", lambda t, i: F.concat(F.lit("1 0 0 1 72 "), (F.lit(900) - 20 * F.pmod(i, F.lit(PDF_LINES))).cast("string"), F.lit(" Tm [<"), F.hex(F.encode(F.substr(t, F.lit(1), F.floor(F.length(t) / 2).cast("int")), "UTF-8")), F.lit("> -5 <"), F.hex(F.encode(F.substr(t, (F.floor(F.length(t) / 2) + 1).cast("int")), "UTF-8")), F.lit(">] TJ")))
    rows = documents(spark, sf_dir).select("doc_id", found.alias("l")).select("doc_id", shown.alias("s"))
    pages = F.sequence(F.lit(0), F.floor((F.size("s") - 1) / PDF_LINES).cast("int"))
    name = lambda k: k.cast("string")
    kids = F.array_join(F.transform(pages, lambda k: F.concat(name(10 + 2 * k), F.lit(" 0 R"))), " ")
    page = lambda k: F.concat(
        name(10 + 2 * k), F.lit(" 0 obj <</Type /Page /Parent 2 0 R /Contents "), name(11 + 2 * k), F.lit(" 0 R>> endobj\n"),
        name(11 + 2 * k), F.lit(" 0 obj <<>> stream\nBT /F1 10 Tf "), F.array_join(F.slice("s", 1 + k * PDF_LINES, F.lit(PDF_LINES)), "\n"), F.lit(" ET\nendstream endobj\n"),
    )
    head = F.concat(F.lit("%PDF-1.4\n1 0 obj <</Type /Catalog /Pages 2 0 R>> endobj\n2 0 obj <</Type /Pages /MediaBox [0 0 600 1000] /Kids ["), kids, F.lit("]>> endobj\n"))
    return rows.select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path"), F.encode(F.concat(head, F.array_join(F.transform(pages, page), "")), "UTF-8").alias("content"))


def pdf_blocks(spark, sf_dir):
    return pdf.parse_binary(_pdf_files(spark, sf_dir)).select(tx.stem(F.col("doc")).alias("doc"), "page", "pages", "width", "height", "block_no", "x0", "text")


def pdf_pipeline(spark, sf_dir):
    pages = process_blocks(pdf.text_blocks(pdf.parse_binary(_pdf_files(spark, sf_dir))))
    return lines.segment_records(pages.withColumn("doc", tx.stem(F.col("doc"))))


def _folder(spark, tag):
    return f"{files.shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def folded_pipeline(spark, sf_dir):
    """``full_pipeline`` within each row: no window, no shuffle."""
    pages = folds.clean_rows(noisy(spark, sf_dir), folds.page_lines(F.col("text")), OPTIONS, ("doc_id",))
    return lines.segment_records(pages, keys=("doc_id",)).withColumnRenamed("text", "segment")


def streamed_pipeline(spark, sf_dir):
    """The same as a stream of the table's files in append mode, written and read again."""
    out = _folder(spark, "streamed")
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    docs = spark.readStream.schema(schema).parquet(f"{sf_dir}/[d]ocuments.parquet").select("doc_id", "text")  # a pattern, as streams take no single file
    pages = folds.clean_rows(with_noise(docs), folds.page_lines(F.col("text")), OPTIONS, ("doc_id",))
    records = lines.segment_records(pages, keys=("doc_id",)).withColumnRenamed("text", "segment")
    records.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(records.schema).parquet(out)


def assembled_documents(spark, sf_dir):
    """Conversations as documents whose turns are pages, dealt over two batches of a stream, each put together once by its state."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    sizes = turns.groupBy("conv_id").agg(F.count("*").cast("int").alias("pages"))
    pages = turns.join(sizes, "conv_id").select(F.col("conv_id").cast("string").alias("doc"), F.col("turn").cast("int").alias("page"), "pages", tx.clean_text(F.col("text")).alias("cleaned"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at"))
    source, out = _folder(spark, "turns"), _folder(spark, "assembled")
    for half in (0, 1):  # even turns first
        pages.where(F.pmod("page", F.lit(2)) == half).write.parquet(f"{source}/half={half}")
    schema = pages.schema
    for half in (0, 1):
        stream = spark.readStream.schema(schema).option("basePath", source).parquet(f"{source}/half=[0-{half}]")
        found = assembly.assemble(stream.select(*schema.names))
        found.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(assembly.OUTPUT).parquet(out).select(F.col("doc").cast("long").alias("conv_id"), "status", "pages", "missing", "text")


def quoted_csv(spark, sf_dir):
    """Whole documents through quoted CSV and back, line breaks, quotes and all, each file read in ranges."""
    out = _folder(spark, "quoted")
    docs = documents(spark, sf_dir).select("doc_id", F.concat_ws("", F.lit('"'), F.col("text"), F.lit('",')).alias("text"))
    docs.write.csv(out, header=True, quote='"', escape='"')
    return tabular.read_csv(spark, out).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))


def named_documents(spark, sf_dir):
    """A text and a JSONL file, by name, for each conversation; both read again."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    cleaned = turns.select(F.concat(F.lit("/in/conv "), F.col("conv_id").cast("string"), F.lit(".pdf")).alias("doc"), F.col("turn").cast("int").alias("page"), tx.clean_text(F.col("text")).alias("cleaned"))
    out = _folder(spark, "named")
    named.write_documents(cleaned.withColumn("segments", tx.segment_text(F.col("cleaned"))), out)
    name = F.regexp_extract(F.url_decode(F.col("_metadata.file_name")), r"\A(.*)\.[a-z]+\z", 1)
    texts = spark.read.text(out, wholetext=True, pathGlobFilter="*.txt").select(name.alias("file"), F.lit("txt").alias("kind"), F.lit(None).cast("int").alias("page"), F.lit(None).cast("int").alias("segment_index"), F.col("value").alias("text"))
    records = spark.read.schema("page int, segment_index int, text string").option("pathGlobFilter", "*.jsonl").json(out)
    return texts.unionByName(records.select(name.alias("file"), F.lit("jsonl").alias("kind"), "page", "segment_index", "text"))


def column_reorder_rounded(spark, sf_dir):
    """Reading order by coordinates that are correctly rounded to one decimal."""
    return layout.reorder_two_columns(_blocks(spark, sf_dir), exact=True).select("doc", "block_no", "reading_no")


def expanded_phrases(spark, sf_dir):
    """Phrases expanded by a dictionary that is a table: all types of parts."""
    kinds = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_type").alias("phrase")).distinct()
    dictionary = kinds.select("phrase", F.array(F.concat(F.lit("Kind-of "), "phrase"), F.lower("phrase"), F.lit("kind")).alias("expansions"))
    return phrases.render(_records(spark, sf_dir), ["L1", "K", "D"], expand=dictionary).select("riskid", "text_phrases", F.array_join("fields_used", ",").alias("used"))


def sql_lines(spark, sf_dir):
    """``doc_lines`` by the table function."""
    sql.register(spark)
    return spark.sql("SELECT * FROM text_lines(TABLE({docs}))", docs=documents(spark, sf_dir))


def sql_table_runs(spark, sf_dir):
    """``mask_text_tables`` by the table function, which keeps a few rows instead of a window."""
    sql.register(spark)
    return spark.sql("SELECT * FROM table_runs(TABLE({rows}), keys => 'doc_id')", rows=_noisy_lines(spark, sf_dir))


def sql_segments(spark, sf_dir):
    """``chunk_long`` by SQL functions that run on the JVM."""
    sql.register(spark)
    pieces = f"SELECT doc_id, text_segments(cleaned_text(text), 'sentence', {CHUNK_TOKENS}) AS s FROM {{docs}}"
    return spark.sql(f"SELECT doc_id, posexplode(s) AS (segment_index, segment) FROM ({pieces})", docs=noisy(spark, sf_dir))


def queries() -> dict:
    base = (pdf_blocks, pdf_pipeline, doc_lines, drop_numeric_lines, strip_toc_footer, mask_text_tables, clean_text, sentence_segments, paragraph_segments, chunk_long, full_pipeline, doc_narrative, token_counts, column_reorder, find_captions, phrases_normalised, phrases_mwe, fields_used, record_template, render_totals)
    return {f.__name__: f for f in (*base, folded_pipeline, streamed_pipeline, assembled_documents, quoted_csv, named_documents, column_reorder_rounded, expanded_phrases, sql_lines, sql_table_runs, sql_segments)}


# The same in SQL for an engine without lookaround: boundaries are captured and put back, or marked with chr(1).

# Fixed values of the SQL side, written out here from the rules and not taken from the operators.
_WS = r"[\t\n\v\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WORD = r"[\p{L}\p{N}_]"
_LINE_BREAK = r"\r\n|[\n\v\f\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_DASHES = "[‐–—]+"
_EDGE = r"(?:\A|[^\p{L}\p{N}_])"
_CAPTION_LINE = rf"(?i){_EDGE}(exhibit|figure|table|chart){_WS}*\p{{Nd}}+{_WS}*[:\-–]"
_CAPTION = rf"(?i){_EDGE}(exhibit|figure|table|chart){_WS}*(\p{{Nd}}+)(?:{_WS}*[:\-–]{_WS}*|{_WS}+|\z)"
_DROPPED = (
    r"(?i)(?:\A|[^\p{L}\p{N}_])(?:table of contents|list of figures|list of tables)(?:[^\p{L}\p{N}_]|\z)",
    rf"[._]{{4,}}{_WS}*\p{{Nd}}+\z",
    rf"(?i){_EDGE}exhibit{_WS}*<?\p{{Nd}}+>?{_WS}*of{_WS}*<?\p{{Nd}}+>?",
    rf"\A-?{_WS}*\p{{Nd}}{{1,4}}{_WS}*-?\z",
    rf"(?i)\Aweb{_WS}*<\p{{Nd}}{{4}}>",
    rf"(?i)mckinsey{_WS}*&{_WS}*company",
    rf"(?i)scan{_WS}*•{_WS}*download{_WS}*•{_WS}*personalize",
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _re(c: str, pattern: str, to: str) -> str:
    return f"regexp_replace({c}, {_q(pattern)}, {to if to.startswith('chr') or '||' in to else _q(to)}, 'g')"


def _strip(c: str) -> str:
    return _re(c, rf"\A{_WS}+|{_WS}+\z", "")


def _clean(c: str) -> str:
    for code, new in ((0xFB01, "fi"), (0xFB02, "fl"), (0xAD, "")):
        c = f"replace({c}, chr({code}), {_q(new)})"
    c = f"replace({_re(c, rf'({_WORD})-{_WS}*' + chr(92) + 'n' + rf'{_WS}*({_WORD})', chr(92) + '1' + chr(92) + '2')}, chr(160), ' ')"
    both = r"\1 \2"
    for pattern in (r"([a-z])([A-Z][a-z])", r"([a-z])([A-Z][a-z])", r"([a-zA-Z])([0-9])", r"([0-9])([A-Za-z])", r"([A-Za-z0-9])(\()", r"(\))([A-Za-z0-9])"):
        c = _re(c, pattern, both)
    c = _re(_re(_re(c, _DASHES, "-"), "[•·∙◦*]+", "-"), rf"{_WS}+", " ")
    return _strip(_re(c, rf"\.{_WS}*([A-Z])", r". \1"))


def _pieces(c: str) -> str:
    return f"list_filter(list_transform({c}, lambda s: {_strip('s')}), lambda s: s <> '')"


def _sentences(c: str) -> str:
    marked = _re(c, rf"([.!?]){_WS}+([A-Z(0-9])", r"'\1' || chr(1) || '\2'")
    cut = f"CASE WHEN length(s) > {1200} THEN string_split_regex(s, {_q(';' + _WS + '+')}) ELSE [s] END"
    return _pieces(f"flatten(list_transform(string_split({marked}, chr(1)), lambda s: {cut}))")


def _tokens(c: str) -> str:
    return f"CAST(floor(len(regexp_extract_all({c}, {_q(_WORD + '+(?:[.]' + _WORD + '+)?')})) * CAST(1.3 AS DOUBLE)) AS INTEGER)"


_DOCS = "SELECT doc_id, text FROM documents"
_NOISY = "SELECT doc_id, text || chr(10) || CASE doc_id % 16 " + " ".join(f"WHEN {k} THEN {_q(s)}" for k, s in enumerate(NOISE_LINES)) + " END AS text FROM documents"


def _lines(source: str) -> str:
    return f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, l[i] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split_regex(text, {_q(_LINE_BREAK)}) AS l FROM ({source}))) WHERE {_strip('l[i]')} <> ''"


_ALPHA = f"(regexp_matches(line, {_q(_CAPTION_LINE)}) OR len(regexp_extract_all({_strip('line')}, '\\p{{L}}')) / length({_strip('line')}) >= CAST(0.2 AS DOUBLE))"
_TOC = "NOT (" + " OR ".join(f"regexp_matches({_strip('line')}, {_q(p)})" for p in _DROPPED) + ")"


def _masked(source: str) -> str:
    wide = f"CAST(len(regexp_extract_all({_strip('line')}, {_q(rf"\t|{_WS}{{2,}}")})) >= 2 AS INTEGER)"
    return f"SELECT doc_id, line_no, line, w = 1 AND sum(w) OVER (PARTITION BY doc_id, g) >= 3 AS masked FROM (SELECT *, sum(1 - w) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM (SELECT *, {wide} AS w FROM ({source})))"


def _exploded(source: str, pieces: str, keys: str = "doc_id") -> str:
    return f"SELECT {keys}, CAST(i - 1 AS INTEGER) AS segment_index, s[i] AS segment FROM (SELECT {keys}, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT {keys}, {pieces} AS s FROM ({source})))"


def _chunks(pieces: str, limit: int) -> str:
    parts = f"string_split({_re('p', '([;:,])' + _WS + '+', chr(39) + chr(92) + '1' + chr(39) + ' || chr(1)')}, chr(1))"
    step = f"CASE WHEN a.buf <> '' AND length(a.buf) + length(x) >= {limit} THEN {{'out': list_append(a.out, a.buf), 'buf': x}} WHEN a.buf = '' THEN {{'out': a.out, 'buf': x}} ELSE {{'out': a.out, 'buf': a.buf || ' ' || x}} END"
    fold = f"list_reduce({parts}, lambda a, x: {step}, {{'out': CAST([] AS VARCHAR[]), 'buf': ''}})"
    done = f"list_transform([{fold}], lambda r: CASE WHEN r.buf <> '' THEN list_append(r.out, r.buf) ELSE r.out END)[1]"
    return f"flatten(list_transform({pieces}, lambda p: CASE WHEN length(p) <= {limit} THEN [p] ELSE {done} END))"


_FULL = _masked(f"SELECT * FROM ({_lines(_NOISY)}) WHERE {_ALPHA} AND {_TOC}")
_FULL = f"SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM ({_FULL}) WHERE NOT masked GROUP BY doc_id"
_NARRATIVE = f"SELECT doc_id, line_no // 10 AS page, string_agg(line, chr(10) ORDER BY line_no) AS text FROM ({_lines(_NOISY)}) GROUP BY 1, 2"
_RECORDS = "SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS riskid, CASE WHEN p_partkey % 7 <> 0 THEN p_name ELSE '' END AS summary, CASE WHEN p_partkey % 11 <> 0 THEN p_brand || '; ' || p_type ELSE '' END AS l1, CASE WHEN p_partkey % 11 <> 0 THEN p_type || ' / ' || p_name || ', a-b|' || upper(p_brand) ELSE '' END AS kk, CASE WHEN p_partkey % 5 = 0 THEN ' ; ' ELSE '' END AS d FROM part"


def _norm(c: str) -> str:
    return _re(_re(_strip(c), rf"{_WS}+", " "), _DASHES, "-")


_CELLS = f"SELECT k, riskid, f, name, c FROM (SELECT k, riskid, unnest([1, 2, 3]) AS f, unnest(['L1', 'K', 'D']) AS name, unnest([l1, kk, d]) AS c FROM ({_RECORDS})) WHERE {_strip('c')} <> ''"
_PARTS = f"SELECT *, CASE WHEN len(q) = 0 THEN [c] ELSE q END AS parts FROM (SELECT *, list_filter(string_split_regex(c, {_q("[;,/|]")}), lambda s: {_strip('s')} <> '') AS q FROM ({_CELLS}))"
_EACH = f"SELECT k, riskid, f, name, i, {_norm('parts[i]')} AS p FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM ({_PARTS}))"
_BY_MAP = "SELECT *, CASE p " + " ".join(f"WHEN {_q(x)} THEN [p, {', '.join(map(_q, v))}]" for x, v in EXPAND.items()) + f" ELSE [p] END AS g FROM ({_EACH})"
_BY_TABLE = f"SELECT e.*, CASE WHEN t.phrase IS NULL THEN [p] ELSE [p, 'Kind-of ' || p, lower(p), 'kind'] END AS g FROM ({_EACH}) e LEFT JOIN (SELECT DISTINCT p_type AS phrase FROM part) t ON e.p = t.phrase"


def _found(expanded: str) -> str:
    grown = f"SELECT k, riskid, f, name, i, unnest(range(1, len(g) + 1)) AS j, unnest(g) AS p FROM ({expanded})"
    forms = f"SELECT k, riskid, f, name, i, j, unnest([1, 2]) AS v, unnest([p, CASE WHEN contains(p, '-') THEN replace(p, '-', ' ') END]) AS p FROM ({grown})"
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, lower(p) ORDER BY f, i, j, v) AS r FROM (SELECT k, riskid, f, name, i, j, v, {_norm('p')} AS p FROM ({forms}) WHERE p IS NOT NULL) WHERE p <> '') WHERE r = 1"


_FOUND = _found(_BY_MAP)


def _phrases(p: str, found: str = _FOUND) -> str:
    return f"SELECT r.k, r.riskid, coalesce(t.s, '') AS s FROM ({_RECORDS}) r LEFT JOIN (SELECT k, string_agg({p}, ' | ' ORDER BY length(p) DESC, lower(p)) AS s FROM ({found}) GROUP BY k) t ON r.k = t.k"


_FIELDS = "concat_ws('; ', " + ", ".join(f"CASE WHEN {_strip(c)} <> '' THEN '{n}: ' || {_norm(c)} END" for n, c in (("L1", "l1"), ("K", "kk"), ("D", "d"))) + ")"
_TEMPLATE = f"SELECT riskid, summary, 'RiskID ' || riskid || '.' || CASE WHEN summary <> '' AND x <> '' THEN ' Summary: ' || summary || ' Related attributes — ' || x || '.' WHEN x <> '' THEN ' Attributes — ' || x || '.' WHEN summary <> '' THEN ' Summary: ' || summary ELSE '' END AS text_template FROM (SELECT riskid, summary, {_FIELDS} AS x FROM ({_RECORDS}))"


_PDF_LINES = f"SELECT doc_id, (i - 1) // 40 AS page, i, {_strip(_re('l[i]', '[' + chr(92) + 'x00-' + chr(92) + 'x1f]', ' '))} AS t, (len(l) - 1) // 40 + 1 AS pages FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))"
_PDF_PAGES = f"SELECT doc_id, page, string_agg(t, chr(10) ORDER BY i) AS t FROM ({_PDF_LINES}) WHERE t <> '' GROUP BY doc_id, page"


def oracle_sql() -> dict[str, str]:
    side = "CASE WHEN c > a[CAST(len(a) // 2 + 1 AS BIGINT)] THEN 1 ELSE 0 END"
    blocks = "SELECT l_orderkey AS doc, l_linenumber AS block_no, l_quantity * 10 AS x0, (l_quantity * 10 + (l_quantity * 10 + l_tax * 1000)) / 2 AS c, l_discount * 7000 AS y0 FROM lineitem"
    full = _exploded(f"SELECT doc_id, {_sentences('t')} AS z FROM (SELECT doc_id, {_clean('text')} AS t FROM ({_FULL}))", _chunks("z", 512 * 6))
    rounded = "CAST(format('{:.1f}', CAST(%s AS DOUBLE)) AS DOUBLE)"
    by_table = _found(_BY_TABLE)
    turns = f"SELECT conv_id, turn, {_clean('text')} AS t FROM (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations)"
    joined = f"SELECT conv_id, count(*) AS n, string_agg(CASE WHEN t <> '' THEN t END, chr(10) ORDER BY turn) AS s FROM ({turns}) GROUP BY conv_id"
    turn_segments = _exploded(f"SELECT conv_id, turn, {_chunks('z', 512 * 6)} AS z FROM (SELECT conv_id, turn, {_sentences('t')} AS z FROM ({turns}))", "z", "conv_id, turn")
    mwe = _re("p", rf"{_WS}+", "_")
    chunks = _exploded(f"SELECT doc_id, {_sentences('t')} AS z FROM (SELECT doc_id, {_clean('text')} AS t FROM ({_NOISY}))", _chunks("z", CHUNK_TOKENS * 6))
    pdf_text = f"SELECT doc_id, page, {_sentences('c')} AS z FROM (SELECT doc_id, page, {_clean('t')} AS c FROM ({_PDF_PAGES}))"
    size = "CAST(page AS INTEGER) AS page, CAST(pages AS INTEGER) AS pages, CAST(600 AS DOUBLE) AS width, CAST(1000 AS DOUBLE) AS height"
    return {
        "pdf_blocks": f"SELECT CAST(doc_id AS VARCHAR) AS doc, {size}, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY i) - 1 AS INTEGER) AS block_no, CAST(72 AS DOUBLE) AS x0, t AS text FROM ({_PDF_LINES}) WHERE t <> '' UNION ALL SELECT CAST(doc_id AS VARCHAR), {size}, NULL, NULL, '' FROM ({_PDF_LINES}) GROUP BY doc_id, page, pages HAVING max(t) = ''",
        "pdf_pipeline": f"SELECT CAST(doc_id AS VARCHAR) AS doc, CAST(page AS INTEGER) AS page, segment_index, segment AS text FROM ({_exploded(pdf_text, _chunks('z', 512 * 6), 'doc_id, page')})",
        "doc_lines": _lines(_DOCS),
        "drop_numeric_lines": f"SELECT * FROM ({_lines(_NOISY)}) WHERE {_ALPHA}",
        "strip_toc_footer": f"SELECT * FROM ({_lines(_NOISY)}) WHERE {_TOC}",
        "mask_text_tables": _masked(_lines(_NOISY)),
        "clean_text": f"SELECT doc_id, {_clean('text')} AS cleaned FROM ({_NOISY})",
        "sentence_segments": _exploded(f"SELECT doc_id, {_clean('text')} AS t FROM ({_NOISY})", _sentences("t")),
        "paragraph_segments": _exploded(_NOISY, _pieces("string_split(" + _re(_re("text", r"\n{2,}", "chr(1)"), r"\.\n", "'.' || chr(1)") + ", chr(1))")),
        "chunk_long": chunks,
        "full_pipeline": full,
        "doc_narrative": f"SELECT doc_id, string_agg(t, chr(10) ORDER BY page) AS text FROM (SELECT doc_id, page, {_clean('text')} AS t FROM ({_NARRATIVE})) WHERE t <> '' GROUP BY doc_id",
        "token_counts": f"SELECT 'documents' AS origin, doc_id AS id, CAST(0 AS BIGINT) AS part, {_tokens('text')} AS tokens FROM documents UNION ALL SELECT 'conversations', conv_id, turn, {_tokens('text')} FROM conversations",
        "column_reorder": f"SELECT doc, block_no, CAST(row_number() OVER (PARTITION BY doc ORDER BY {side}, floor(y0 * 10 + CAST(0.5 AS DOUBLE)), floor(x0 * 10 + CAST(0.5 AS DOUBLE)), block_no) - 1 AS INTEGER) AS reading_no FROM (SELECT *, list_sort(list(c) OVER (PARTITION BY doc)) AS a FROM ({blocks}))",
        "find_captions": f"SELECT doc_id AS doc, line_no AS block_no, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS INTEGER) AS caption_no, s AS caption, lower(regexp_extract(s, {_q(_CAPTION)}, 1)) AS kind, CAST(regexp_extract(s, {_q(_CAPTION)}, 2) AS INTEGER) AS ordinal FROM (SELECT doc_id, line_no, {_strip('line')} AS s FROM ({_lines(_NOISY)})) WHERE regexp_matches(s, {_q(_CAPTION)})",
        "phrases_normalised": f"SELECT riskid, s AS text_phrases, {_tokens('s')} AS tokens_phrases FROM ({_phrases('p')})",
        "phrases_mwe": f"SELECT riskid, s AS text_phrases, s AS text_mwe, {_tokens('s')} AS tokens_mwe FROM ({_phrases(mwe)})",
        "fields_used": f"SELECT r.riskid, coalesce(t.s, '') AS used FROM ({_RECORDS}) r LEFT JOIN (SELECT k, string_agg(name, ',' ORDER BY f, i, j, v) AS s FROM ({_FOUND}) GROUP BY k) t ON r.k = t.k",
        "record_template": f"SELECT riskid, text_template, summary, {_tokens('text_template')} AS tokens_template FROM ({_TEMPLATE})",
        "render_totals": f"SELECT count(*) AS rows, CAST(coalesce(sum({_tokens('text_template')}), 0) AS BIGINT) AS tokens_template FROM ({_TEMPLATE})",
        "streamed_pipeline": full,
        "sql_lines": _lines(_DOCS),
        "sql_table_runs": _masked(_lines(_NOISY)),
        "sql_segments": chunks,
        "folded_pipeline": full,
        "assembled_documents": f"SELECT conv_id, 'complete' AS status, CAST(n AS INTEGER) AS pages, 0 AS missing, coalesce(s, '') AS text FROM ({joined})",
        "quoted_csv": "SELECT doc_id, chr(34) || coalesce(text, '') || chr(34) || ',' AS text FROM documents",
        "named_documents": f"SELECT 'conv ' || conv_id AS file, 'txt' AS kind, CAST(NULL AS INTEGER) AS page, CAST(NULL AS INTEGER) AS segment_index, coalesce(s || chr(10), '') AS text FROM ({joined}) UNION ALL SELECT 'conv ' || conv_id, 'jsonl', CAST(turn AS INTEGER), segment_index, segment FROM ({turn_segments})",
        "column_reorder_rounded": f"SELECT doc, block_no, CAST(row_number() OVER (PARTITION BY doc ORDER BY {side}, {rounded % 'y0'}, {rounded % 'x0'}, block_no) - 1 AS INTEGER) AS reading_no FROM (SELECT *, list_sort(list(c) OVER (PARTITION BY doc)) AS a FROM ({blocks}))",
        "expanded_phrases": f"SELECT p.riskid, p.s AS text_phrases, coalesce(t.u, '') AS used FROM ({_phrases('p', by_table)}) p LEFT JOIN (SELECT k, string_agg(name, ',' ORDER BY f, i, j, v) AS u FROM ({by_table}) GROUP BY k) t ON p.k = t.k",
    }
