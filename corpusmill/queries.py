"""The operators as queries over the given tables, each with the same result in SQL.

Inputs that the tables do not have as such are derived from whole tables: bitext pairs a
document with the next one, scores are hashes of row numbers, code and math samples are a
user turn and the answer to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from .functions import langs, rand, text as T
from .functions.text import WHITESPACE, count_tokens
from .operators import (
    budget, checks, filters, formats, inference, joins, layout, prefix, sampling, scores, shards,
)
from .plans import bitext as bitext_plan, extended, mixture, recipes, synthetic
from .session import shared_path
from .sinks import writers
from .sources import bitext as bitext_source, corpus as corpus_source, normalize
from .sources.lines import read_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn

    return register


# --- inputs -------------------------------------------------------------------------------

NAMES = {"de": "German", "es": "Spanish"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "lang", F.col("source").alias("split"), F.col("doc_id").alias("ord"), "text", "n_chars"
    )


CORPUS = "SELECT lang, source AS split, doc_id AS ord, text, n_chars FROM documents"


def bitext(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    after = docs.select(
        (F.col("doc_id") - 1).alias("doc_id"), F.col("lang").alias("lang2"), F.col("text").alias("sentence2")
    )
    return docs.join(after, "doc_id").select(
        F.concat_ws("-", "lang", "lang2").alias("pair"), F.col("doc_id").alias("row_id"),
        F.col("text").alias("sentence1"), "sentence2",
    )


BITEXT = (
    "SELECT a.lang || '-' || b.lang AS pair, a.doc_id AS row_id, a.text AS sentence1, b.text AS sentence2 "
    "FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1"
)


def sized_bitext(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the bitext with the bytes of both sentences in place of these."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", shards.row_bytes(["text"]).alias("bytes1"))
    after = docs.select(
        (F.col("doc_id") - 1).alias("doc_id"), F.col("lang").alias("lang2"), F.col("bytes1").alias("bytes2")
    )
    return docs.join(after, "doc_id").select(
        F.concat_ws("-", "lang", "lang2").alias("pair"), F.col("doc_id").alias("row_id"), "bytes1", "bytes2"
    )


def comet(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the bitext, from keys alone."""
    return bitext(spark, sf).select("pair", "row_id", rand.uniform(7, "row_id").alias("comet_score"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return bitext(spark, sf).withColumn("comet_score", rand.uniform(7, "row_id"))


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """User turns with the answers to them."""
    rows = table(spark, sf, "conversations")
    asked = rows.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("asked"))
    told = rows.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("told")
    )
    return asked.join(told, ["conv_id", "turn"])


TURNS = (
    "SELECT a.conv_id, a.turn, a.text AS asked, b.text AS told FROM conversations a JOIN conversations b "
    "ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'"
)


def config(spark: SparkSession, sf: str) -> DataFrame:
    """A mixture config: every language in all its splits, with one budget for each."""
    docs = table(spark, sf, "documents")
    each = docs.agg(F.expr("sum(n_chars) div 20")).scalar()
    lists = docs.select("lang", "source").distinct().groupBy("lang").agg(
        F.array_join(F.sort_array(F.collect_set("source")), ",").alias("split")
    )
    return lists.select(
        F.col("lang").alias("subset"), each.alias("token_count"), F.concat("split", F.lit(", ,")).alias("split")
    )


def md5_of(c: str) -> Column:
    return F.md5(F.col(c)).alias(f"{c}_md5")


def sql_key(seed, *ids: str) -> str:
    return f"md5(concat_ws(':', {seed}, {', '.join(ids)}))"


def sql_uniform(seed, *ids: str) -> str:
    return f"(('0x' || substr({sql_key(seed, *ids)}, 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def sql_tokens(c: str) -> str:
    return f"len(regexp_extract_all({c}, '[^ \\t-\\r]+'))::BIGINT"


def sql_strip(c: str) -> str:
    return f"trim({c}, '{WHITESPACE}')"


SCORED = f"SELECT *, {sql_uniform(7, 'row_id')} AS comet_score FROM ({BITEXT})"


# --- sources ------------------------------------------------------------------------------


@query(f"""
SELECT lang, split, CASE split WHEN 'src3' THEN 0 ELSE 1 END AS split_pos, ord, md5(text) AS text_md5
FROM ({CORPUS}) WHERE lang = 'en' AND split IN ('src3', 'src1')
""")
def scan_subset(spark, sf):
    rows = corpus_source.select_subset(corpus(spark, sf), "en", ["src3", "", " src1"])
    return rows.select("lang", "split", "split_pos", "ord", md5_of("text"))


@query(f"""
SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE {sql_strip('text')} <> ''
ORDER BY doc_id LIMIT 300
""")
def first_n(spark, sf):
    rows = corpus_source.read_rows(spark, f"{sf}/documents.parquet", max_samples=300)
    return rows.select("doc_id", md5_of("text"))


@query("""
SELECT d.lang, md5(d.text) AS text_md5, d.doc_id::VARCHAR AS id, '' AS dump, coalesce(p.url, '') AS url,
       '' AS date, d.lang AS language, '' AS language_script, 0.0::DOUBLE AS language_score,
       d.n_chars AS minhash_cluster_size, 0::BIGINT AS n_top_langs, 'fw2' AS dataset
FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id
""")
def norm_web(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "url")
    rows = table(spark, sf, "documents").join(pages, "doc_id", "left").select(
        "lang", "text", F.col("doc_id").alias("id"), "url", F.col("n_chars").alias("minhash_cluster_size")
    )
    fields = ("id", "dump", "url", "date", "language", "language_script", "language_score",
              "minhash_cluster_size", "dataset")
    return normalize.normalize_web(rows).select(
        "lang", md5_of("text"), *[F.col(f"meta.{f}").alias(f) for f in fields],
        F.size("meta.top_langs").cast("bigint").alias("n_top_langs"),
    )


def text_files(spark: SparkSession, rows: DataFrame, by: str, order: str) -> str:
    """`value` of the rows as lines of text files, a folder `<by>=<value>` each, in the order of a column; gives the root."""
    root = shared_path(spark, "lines")
    ordered = rows.repartitionByRange(order).sortWithinPartitions(by, order)
    ordered.select(by, "value").write.option("lineSep", "\n").partitionBy(by).text(root)
    return root


def folder_value(name: str) -> Column:
    return F.regexp_extract("_path", f"/{name}=([^/]+)/", 1)


ONE_LINE = "replace(replace(text, chr(10), ' '), chr(13), ' ')"
PASSAGES = f"""
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS line,
       CASE WHEN doc_id % 2 = 0 THEN doc_id || chr(9) || {ONE_LINE} ELSE {ONE_LINE} END AS value FROM documents
"""


@query(f"""
SELECT lang, CASE WHEN instr(value, chr(9)) > 0 THEN substr(value, 1, instr(value, chr(9)) - 1)
                  ELSE 'wura_' || lang || '_' || line END AS id,
       md5(CASE WHEN instr(value, chr(9)) > 0 THEN substr(value, instr(value, chr(9)) + 1) ELSE value END) AS text_md5
FROM ({PASSAGES})
""")
def norm_passages(spark, sf):
    text = F.translate("text", "\n\r", "  ")
    value = F.when(F.col("doc_id") % 2 == 0, F.concat_ws("\t", "doc_id", text)).otherwise(text)
    root = text_files(spark, table(spark, sf, "documents").withColumn("value", value), "lang", "doc_id")
    rows = read_lines(spark, root, folder_value("lang"), line_sep="\n")
    return normalize.normalize_passages(rows).select("lang", F.col("meta.id").alias("id"), md5_of("text"))


DOC_LINES = "SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS line FROM documents"


def json_lines(spark, sf, *fields: str, broken: bool = True) -> DataFrame:
    """(lang, value, line) of files of documents as JSON lines; every seventh document is cut off and so no JSON."""
    docs = table(spark, sf, "documents").withColumn("source-category", F.concat("lang", F.lit("-news")))
    whole = F.to_json(F.struct(*fields))
    cut = F.substring(whole, F.lit(1), F.length(whole) - 1)
    bad = (F.col("doc_id") % 7 == 3) & F.lit(broken)
    root = text_files(spark, docs.withColumn("value", F.when(bad, cut).otherwise(whole)), "lang", "doc_id")
    return read_lines(spark, root, folder_value("lang"), line_sep="\n")


@query(f"""
SELECT lang, 'wura_' || lang || '_' || line AS id, 'wura' AS dataset, md5(text) AS text_md5 FROM ({DOC_LINES})
""")
def norm_documents(spark, sf):
    rows = normalize.parse_json_lines(json_lines(spark, sf, "text", broken=False), ["text"])
    return normalize.normalize_documents(rows).select(
        "lang", F.col("meta.id").alias("id"), F.col("meta.dataset").alias("dataset"), md5_of("text")
    )


@query(f"""
SELECT doc_id, lang, md5({sql_strip(f"{sql_strip('source')} || ' ' || {sql_strip('text')}")}) AS text_md5 FROM documents
""")
def headline_concat(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.concat(F.lit(" \t"), "source", F.lit(" ")).alias("headline"), F.col("text").alias("content"),
        "doc_id", "lang",
    )
    return normalize.build_documents(rows).select("rest.doc_id", "rest.lang", md5_of("text"))


@query(f"""
SELECT lang, 'madlad400_' || lang || '_' || line AS id, md5(text) AS text_md5 FROM ({DOC_LINES}) WHERE doc_id % 7 <> 3
""")
def json_lines_skip_bad(spark, sf):
    rows = normalize.normalize_json_lines(json_lines(spark, sf, "text"))
    return rows.select("lang", F.col("meta.id").alias("id"), md5_of("text"))


@query("""
SELECT lang, count(*)::BIGINT AS lines, (count(*) FILTER (doc_id % 7 = 3))::BIGINT AS skipped FROM documents GROUP BY lang
""")
def json_lines_skipped(spark, sf):
    lines = json_lines(spark, sf, "text")
    found = []
    for r in table(spark, sf, "documents").select("lang").distinct().orderBy("lang").collect():
        seen = Observation(f"skipped {r.lang}")
        rows = normalize.parse_json_lines(lines.where(F.col("lang") == r.lang), ["text"], seen=seen)
        rows.write.format("noop").mode("overwrite").save()
        found.append((r.lang, seen.get["lines"], seen.get["skipped"]))
    return spark.createDataFrame(found, "lang string, lines long, skipped long")


@query(f"""
SELECT lang, 'extra_' || lang || '_' || line AS id, source, lang || '-news' AS source_category, md5(text) AS text_md5
FROM ({DOC_LINES}) WHERE doc_id % 7 <> 3
""")
def norm_extra(spark, sf):
    rows = normalize.normalize_extra(json_lines(spark, sf, "text", "source", "source-category"))
    return rows.select(
        "lang", *[F.col(f"meta.{f}").alias(f) for f in ("id", "source", "source_category")], md5_of("text")
    )


@query("SELECT md5(text) AS text_md5 FROM documents")
def text_fallback(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("text").alias("sentence"), "lang")
    return normalize.text_fallback(rows).select(md5_of("text"))


def sql_line(c: str) -> str:
    return f"replace({c}, chr(10), ' ')"


@query(f"""
SELECT pair, row_number() OVER (PARTITION BY pair ORDER BY row_id) - 1 AS row_id, md5({sql_strip(sql_line('sentence1'))}) AS sentence1_md5,
       md5({sql_strip(sql_line('sentence2'))}) AS sentence2_md5, comet_score AS score
FROM ({SCORED}) WHERE pair NOT IN ('es-es', 'de-de')
""")
def moses_align(spark, sf):
    return bitext_source.align_lines(*moses_lines(spark, sf)).select(
        "pair", "row_id", md5_of("sentence1"), md5_of("sentence2"), "score"
    )


def moses_lines(spark, sf) -> list[DataFrame]:
    """Lines of source, target and score files; one pair lacks a line on one side, one has scores that are no numbers."""
    rows = scored(spark, sf).withColumn("line", F.col("row_id"))
    lacking = rows.where("pair = 'es-es'").agg(F.min("row_id")).first()[0]
    padded = F.concat(F.lit(" "), F.translate("sentence1", "\n", " "), F.lit("\r"))
    number = F.when(F.col("pair") == "de-de", F.lit("n/a")).otherwise(F.col("comet_score").cast("string"))
    tables = [
        rows.withColumn("value", padded),
        rows.withColumn("value", F.translate("sentence2", "\n", " ")).where((F.col("pair") != "es-es") | (F.col("row_id") != lacking)),
        rows.withColumn("value", number),
    ]
    return [
        read_lines(spark, text_files(spark, t, "pair", "row_id"), folder_value("pair"), line_sep="\n", name="pair") for t in tables
    ]


@query("""
SELECT pair, count(*)::BIGINT AS n_src, (count(*) - CASE WHEN pair = 'es-es' THEN 1 ELSE 0 END)::BIGINT AS n_tgt,
       count(*)::BIGINT AS n_scores, (CASE WHEN pair = 'de-de' THEN 0 ELSE count(*) END)::BIGINT AS n_numbers
FROM ({bitext}) WHERE pair IN ('es-es', 'de-de') GROUP BY pair
""".format(bitext=BITEXT))
def moses_rejected(spark, sf):
    return bitext_source.pair_sizes(*moses_lines(spark, sf)).where("not aligned").drop("aligned")


@query("""
SELECT doc_id, 'shard-' || lpad((doc_id % 300)::VARCHAR, 5, '0') || '.jsonl.gz' AS name FROM documents
WHERE (doc_id % 300) % 2 = 1 AND doc_id % 300 <= 239
""")
def odd_shards(spark, sf):
    name = F.concat(F.lit("shard-"), F.lpad((F.col("doc_id") % 300).cast("string"), 5, "0"), F.lit(".jsonl.gz"))
    files = table(spark, sf, "documents").select("doc_id", name.alias("name"))
    return files.where(corpus_source.odd_shard("name"))


CONFIG = """
SELECT d.lang, d.source AS split, (row_number() OVER (PARTITION BY d.lang ORDER BY d.source) - 1)::INTEGER AS split_pos,
       floor((SELECT sum(n_chars) // 20 FROM documents) * {fraction})::BIGINT AS target
FROM (SELECT DISTINCT lang, source FROM documents) d
"""


@query(CONFIG.format(fraction="(1.0::DOUBLE / 3.0::DOUBLE)"))
def mixture_config(spark, sf):
    return corpus_source.parse_mixture_config(config(spark, sf), "1/3")


@query(f"""
SELECT lang AS pair, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1)::BIGINT AS row_id,
       {sql_uniform(7, 'doc_id')} AS comet_score
FROM documents
""")
def merge_shards(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("lang").alias("pair"), F.col("doc_id").alias("ord"))
    numbered = prefix.running_sum(rows, ["pair"], prefix.source_order("ord"), F.lit(1), "n")
    parts = numbered.select(
        "pair", F.expr("n div 100 + 1").alias("index"), (F.col("n") % 100).alias("row_id"),
        rand.uniform(7, "ord").alias("comet_score"),
    )
    manifest = parts.groupBy("pair", "index").agg(F.count("*").alias("num_rows"))
    return bitext_source.merge_scored_shards(parts, manifest)


@query("""
SELECT lang, source AS split, (row_number() OVER (PARTITION BY lang ORDER BY source) - 1)::INTEGER AS split_pos
FROM (SELECT DISTINCT lang, source FROM documents WHERE lang IN ('fr', 'en'))
UNION ALL VALUES ('twi_Latn', 'fineweb2', 0), ('wol_Latn', 'fineweb2', 0), ('wol_Latn', 'madlad400', 1)
""")
def split_discovery(spark, sf):
    found = corpus(spark, sf).select("lang", "split")
    return joins.discover_splits(found, ["fr", "twi_Latn", "en", "wol_Latn"], extended.FALLBACK_SPLITS)


# --- file names ---------------------------------------------------------------------------

KIND_NAMES = ["fw2", "wura_documentLevel", "ml400", "extra", "FWedu", "wura", "madlad", "notes"]
STEMS = (
    "SELECT doc_id, CASE WHEN lang = 'en' THEN 'eng_Latn' ELSE lang || '_Latn' END AS lang, "
    f"lang || '_' || doc_id || '_' || ({KIND_NAMES!r})[doc_id % 8 + 1] AS stem FROM documents"
)
SQL_SPLIT = """CASE WHEN contains(lower(stem), 'documentlevel') THEN 'wura_documentLevel'
  WHEN contains(lower(stem), 'fwedu') THEN 'finewebEdu'
  WHEN lang = 'eng_Latn' AND contains(lower(stem), 'fw2') THEN 'finewebEdu'
  WHEN contains(lower(stem), 'fw2') THEN 'fineweb2'
  WHEN contains(lower(stem), 'ml400') OR contains(lower(stem), 'madlad') THEN 'madlad400'
  WHEN contains(lower(stem), 'extra') THEN 'extraData'
  WHEN contains(lower(stem), 'wura') THEN 'wura' END"""


def stems(spark, sf) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(k) for k in KIND_NAMES]), (F.col("doc_id") % 8 + 1).cast("int"))
    return table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("lang") == "en", F.lit("eng_Latn")).otherwise(F.concat("lang", F.lit("_Latn"))).alias("lang"),
        F.concat_ws("_", "lang", "doc_id", kind).alias("stem"),
    )


@query(f"""
SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'fw2' WHEN 1 THEN 'wuraDocumentLevel' WHEN 2 THEN 'madlad400'
  WHEN 3 THEN 'extra' WHEN 4 THEN 'fwedu' WHEN 5 THEN 'wura' END AS dataset_origin
FROM ({STEMS}) WHERE doc_id % 8 < 6
""")
def infer_origin(spark, sf):
    return layout.with_origin(stems(spark, sf)).select("doc_id", "dataset_origin")


@query(f"SELECT doc_id, {SQL_SPLIT} AS split FROM ({STEMS})")
def infer_split(spark, sf):
    return stems(spark, sf).select("doc_id", layout.infer_split("lang", "stem").alias("split"))


@query(f"""
SELECT lang, split, count(*) AS n_files FROM (SELECT lang, {SQL_SPLIT} AS split FROM ({STEMS}))
WHERE split IS NOT NULL GROUP BY lang, split
""")
def file_inventory(spark, sf):
    path = F.concat(F.lit("file:/data/"), "lang", F.lit("/"), "stem", F.lit(".parquet"))
    return layout.inventory(stems(spark, sf).select(path.alias("path")))


@query(f"""
WITH found AS (SELECT DISTINCT lang, {SQL_SPLIT} AS split FROM ({STEMS})),
     wanted AS (SELECT DISTINCT lang, unnest(['fineweb2', 'madlad400', 'goldData']) AS split FROM ({STEMS}))
SELECT w.lang, w.split FROM wanted w ANTI JOIN found f ON f.lang = w.lang AND f.split = w.split
""")
def missing_splits(spark, sf):
    files = stems(spark, sf)
    found = files.select("lang", layout.infer_split("lang", "stem").alias("split")).where("split IS NOT NULL")
    names = F.array(*[F.lit(s) for s in ("fineweb2", "madlad400", "goldData")])
    wanted = files.select("lang").distinct().select("lang", F.explode(names).alias("split"))
    absent = spark.createDataFrame([("xx_Latn", "fineweb2")], "lang string, split string")
    return joins.missing_splits(wanted.unionByName(absent), found)


# --- expressions --------------------------------------------------------------------------


@query("SELECT doc_id, md5(" + sql_strip("text") + ") AS stripped_md5 FROM documents")
def strip_ws(spark, sf):
    padded = F.concat(F.lit(" \t　"), "text", F.lit("\n  \x85"))
    return table(spark, sf, "documents").select("doc_id", F.md5(T.strip(padded)).alias("stripped_md5"))


@query("SELECT doc_id, length(text) AS n FROM documents")
def char_len(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length("text").cast("bigint").alias("n"))


@query(f"SELECT doc_id, {sql_tokens('text')} AS n_tokens FROM documents")
def token_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", count_tokens("text").alias("n_tokens"))


@query(f"SELECT conv_id, turn, md5({sql_strip("asked || chr(10) || chr(10) || told")}) AS text_md5 FROM ({TURNS})")
def concat_code(spark, sf):
    return turns(spark, sf).select("conv_id", "turn", F.md5(T.join_code("asked", "told")).alias("text_md5"))


@query("""
SELECT doc_id, CASE lang WHEN 'en' THEN 'eng_Latn' WHEN 'fr' THEN 'fra_Latn' ELSE lang END AS plain,
       'ku_Latn' AS scripted, CASE doc_id % 2 WHEN 0 THEN 'kmr_Latn' ELSE 'ace_Arab' END AS special
FROM documents
""")
def lang_codes(spark, sf):
    special = F.when(F.col("doc_id") % 2 == 0, F.lit("ku_Latn")).otherwise(F.lit("ace"))
    return table(spark, sf, "documents").select(
        "doc_id", langs.long_code("lang").alias("plain"), langs.long_code(F.lit("ku_Latn")).alias("scripted"),
        langs.long_code(special, specials=True).alias("special"),
    )


@query("""
SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' ELSE 'Spanish' END AS bitext_name,
       CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE lang END AS translation_name
FROM documents
""")
def lang_names(spark, sf):
    code = langs.long_code("lang")
    return table(spark, sf, "documents").select(
        "doc_id", langs.bitext_name(code, NAMES).alias("bitext_name"), langs.translation_name(code).alias("translation_name")
    )


@query(f"""
SELECT row_id, pair, split_part(pair, '-', 1) AS src, split_part(pair, '-', 2) AS tgt FROM ({BITEXT})
""")
def pair_parse(spark, sf):
    named = bitext(spark, sf).select("row_id", F.concat("pair", F.col("row_id").cast("string")).alias("stem"))
    pair = layout.pair_of("stem")
    src, tgt = layout.pair_sides(pair)
    return named.select("row_id", pair.alias("pair"), src.alias("src"), tgt.alias("tgt"))


SQL_FLIP = "(split_part(pair, '-', 2) IN ('en', 'fr', 'pt') AND split_part(pair, '-', 1) NOT IN ('en', 'fr', 'pt'))"


@query(f"""
SELECT pair, row_id, md5(CASE WHEN {SQL_FLIP} THEN sentence2 ELSE sentence1 END) AS src_md5,
       md5(CASE WHEN {SQL_FLIP} THEN sentence1 ELSE sentence2 END) AS mt_md5
FROM ({BITEXT})
""")
def score_direction(spark, sf):
    return layout.score_direction(bitext(spark, sf)).select("pair", "row_id", md5_of("src"), md5_of("mt"))


RATIO = f"""
SELECT lang, sum(length(head))::BIGINT AS chars, sum({sql_tokens('head')})::BIGINT AS tokens,
       CASE WHEN sum(length(head)) > 0 THEN sum({sql_tokens('head')}) / sum(length(head)) ELSE 0.0 END::DOUBLE AS ratio
FROM (SELECT lang, substr(text, 1, least(length(text), {{n}} - before)::BIGINT) AS head
      FROM (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY lang ORDER BY split, ord
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({CORPUS}))
      WHERE before < {{n}})
GROUP BY lang
"""


@query(RATIO.format(n=100000))
def token_char_ratio(spark, sf):
    ratio = budget.token_char_ratio(corpus(spark, sf), order=prefix.source_order("ord", "split"), sample_chars=100_000)
    return ratio.drop("n_rows")


@query(f"""
SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN n_chars // 6 ELSE 0 END, 0),
                        nullif(floor(length(text) * 0.01::DOUBLE)::BIGINT, 0), {sql_tokens('text')}) AS n_tokens
FROM documents
""")
def token_estimate(spark, sf):
    known = F.when(F.col("doc_id") % 3 == 0, F.expr("n_chars div 6")).otherwise(0)
    return table(spark, sf, "documents").select(
        "doc_id", budget.token_estimate("text", F.lit(0.01), known).alias("n_tokens")
    )


# --- filters ------------------------------------------------------------------------------

# every fifth text is emptied, every fifth blanked
GAPS = "CASE doc_id % 5 WHEN 1 THEN '' WHEN 2 THEN chr(160) || chr(10) ELSE text END"


def gaps(spark, sf) -> DataFrame:
    blanked = F.when(F.col("doc_id") % 5 == 1, F.lit("")).when(F.col("doc_id") % 5 == 2, F.lit(" \n"))
    return corpus(spark, sf).withColumn("doc_id", F.col("ord")).withColumn("text", blanked.otherwise(F.col("text")))


@query(f"SELECT doc_id, length({GAPS}) AS n FROM documents WHERE {GAPS} <> ''")
def nonempty(spark, sf):
    return filters.nonempty(gaps(spark, sf)).select("doc_id", F.length("text").cast("bigint").alias("n"))


@query(f"SELECT doc_id, length({GAPS}) AS n FROM documents WHERE {sql_strip(GAPS)} <> ''")
def nonblank(spark, sf):
    return filters.nonblank(gaps(spark, sf)).select("doc_id", F.length("text").cast("bigint").alias("n"))


@query(f"""
SELECT pair, row_id FROM ({BITEXT}) WHERE length(sentence1) BETWEEN 200 AND 2000 AND length(sentence2) BETWEEN 200 AND 2000
""")
def length_filter(spark, sf):
    return filters.filter_length(bitext(spark, sf), min_char=200, max_char=2000).select("pair", "row_id")


@query(f"SELECT pair, row_id, comet_score FROM ({SCORED}) WHERE comet_score >= 0.93")
def score_absolute(spark, sf):
    rows = comet(spark, sf)
    return scores.filter_score(rows, "comet_score", "absolute", 0.93)


@query(f"""
SELECT pair, row_id, comet_score FROM ({SCORED}) JOIN
  (SELECT pair, quantile_cont(comet_score, 0.7) AS cutoff FROM ({SCORED}) GROUP BY pair) USING (pair)
WHERE comet_score >= cutoff
""")
def score_percentile(spark, sf):
    return scores.filter_score(comet(spark, sf), "comet_score").select("pair", "row_id", "comet_score")


BINNED = f"""
SELECT pair, row_id, comet_score, CASE WHEN comet_score < r * 0.001::DOUBLE THEN r - 1
  WHEN r < 999 AND comet_score >= (r + 1) * 0.001::DOUBLE THEN r + 1 ELSE r END AS bin
FROM (SELECT *, least(floor(comet_score * 1000), 999)::BIGINT AS r FROM ({SCORED}))
"""


@query(f"SELECT pair, bin, count(*) AS n FROM ({BINNED}) GROUP BY pair, bin")
def score_histogram(spark, sf):
    return scores.score_histogram(comet(spark, sf), "comet_score")


@query(f"""
WITH top AS (
  SELECT pair, first(bin ORDER BY n DESC, bin) AS bin
  FROM (SELECT pair, bin, count(*) AS n FROM ({BINNED}) GROUP BY pair, bin) GROUP BY pair),
bounds AS (
  SELECT pair, peak + (1.0::DOUBLE - 0.93::DOUBLE) * (1.0::DOUBLE - peak) AS cutoff
  FROM (SELECT pair, (bin * 0.001::DOUBLE + (bin + 1) * 0.001::DOUBLE) / 2 AS peak FROM top))
SELECT pair, row_id, comet_score FROM ({SCORED}) JOIN bounds USING (pair) WHERE comet_score >= cutoff
""")
def score_peak(spark, sf):
    rows = scores.filter_score(comet(spark, sf), "comet_score", "peak_percentile", 0.93)
    return rows.select("pair", "row_id", "comet_score")


@query(f"SELECT pair, row_id FROM ({BITEXT}) WHERE pair IN ('en-en', 'en-fr', 'fr-en', 'fr-fr')")
def pair_allow(spark, sf):
    return filters.allow_pairs(bitext(spark, sf), ["eng_Latn", "fra_Latn", "por_Latn"]).select("pair", "row_id")


# --- joins --------------------------------------------------------------------------------


@query(f"""
SELECT pair, row_id, md5(sentence1) AS sentence1_md5, comet_score FROM ({SCORED}) WHERE pair <> 'es-de'
""")
def join_scores(spark, sf):
    # a pair without scores is skipped
    known = comet(spark, sf).where("pair <> 'es-de'")
    return joins.join_scores(bitext(spark, sf), known).select("pair", "row_id", md5_of("sentence1"), "comet_score")


@query("SELECT 'es-de' AS pair UNION ALL SELECT 'de-es'")
def missing_scores(spark, sf):
    known = comet(spark, sf).where("pair NOT IN ('es-de', 'de-es')")
    return joins.missing_scores(bitext(spark, sf), known)


@query("""
SELECT DISTINCT lang, source AS split FROM documents ANTI JOIN
  (SELECT d.lang, d.source FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 1) USING (lang, source)
""")
def pending_work(spark, sf):
    done = table(spark, sf, "documents").join(table(spark, sf, "labels").where("toxic = 1"), "doc_id")
    work = corpus(spark, sf).select("lang", "split").distinct()
    return joins.pending_work(work, done.select("lang", F.col("source").alias("split")), ["lang", "split"])


# --- budgets and sampling -----------------------------------------------------------------

PREFIX = f"""
SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k, ord) - 1 AS idx,
  coalesce(sum(CASE WHEN text <> '' THEN {sql_tokens('text')} ELSE 0 END) OVER (PARTITION BY lang ORDER BY k, ord
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM (SELECT lang, doc_id AS ord, {GAPS} AS text, {sql_key(42, 'doc_id')} AS k FROM documents)
"""


@query(f"SELECT lang, ord FROM ({PREFIX}) WHERE text <> '' AND before < 20000")
def budget_prefix(spark, sf):
    rows = budget.take_token_budget(gaps(spark, sf), count_tokens("text"), max_tokens=20_000, by=["lang"])
    return rows.select("lang", "ord")


@query(f"""
SELECT lang, ord FROM (SELECT *, lag(idx) OVER (PARTITION BY lang ORDER BY k, ord) AS prev FROM ({PREFIX}) WHERE text <> '')
WHERE (prev IS NULL OR prev + 1 < 80) AND before < 30000
""")
def budget_samples(spark, sf):
    rows = budget.take_token_budget(
        gaps(spark, sf), count_tokens("text"), max_tokens=30_000, max_samples=80, by=["lang"]
    )
    return rows.select("lang", "ord")


WEIGHED = f"""
SELECT c.lang, c.split, g.split_pos, c.ord, c.text, g.target,
  coalesce(nullif(CASE WHEN c.ord % 3 = 0 THEN c.n_chars // 6 ELSE 0 END, 0),
           nullif(floor(length(c.text) * r.ratio)::BIGINT, 0), {sql_tokens('c.text')}) AS n_tokens
FROM ({CORPUS}) c JOIN ({CONFIG.format(fraction='1')}) g USING (lang, split) JOIN ({RATIO.format(n=1000000)}) r USING (lang)
"""
MIXTURE = f"""
SELECT lang, split, split_pos, ord, text, n_tokens,
       unnest(generate_series(0, (target - before + total - 1) // total - 1))::BIGINT AS epoch
FROM (SELECT *, sum(n_tokens) OVER (PARTITION BY lang)::BIGINT AS total,
        coalesce(sum(n_tokens) OVER (PARTITION BY lang ORDER BY split_pos, ord
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM ({WEIGHED}))
WHERE before < target
"""


def with_counts(spark, sf) -> DataFrame:
    known = F.when(F.col("ord") % 3 == 0, F.expr("n_chars div 6")).otherwise(0)
    return corpus(spark, sf).withColumn("token_count", known)


def mixed(spark, sf) -> DataFrame:
    wanted = corpus_source.parse_mixture_config(config(spark, sf))
    return mixture.build_mixture(with_counts(spark, sf), wanted, "token_count")


@query(f"SELECT lang, split, split_pos, ord, epoch, n_tokens, md5(text) AS text_md5 FROM ({MIXTURE})")
def mixture_unimax(spark, sf):
    return mixed(spark, sf).select("lang", "split", "split_pos", "ord", "epoch", "n_tokens", md5_of("text"))


@query(f"""
SELECT lang, count(*) AS n_rows, sum(n_tokens)::BIGINT AS n_tokens FROM ({MIXTURE}) GROUP BY ROLLUP (lang)
""")
def mixture_totals(spark, sf):
    return mixture.mixture_totals(mixed(spark, sf))


@query(f"""
SELECT pair, row_id, unnest(generate_series(0, CASE WHEN n <= 100 AND n < 40 // 2 THEN 40 // n ELSE 1 END - 1))::BIGINT AS copy,
       md5(sentence1) AS sentence1_md5
FROM (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY {sql_key(42, 'pair', 'row_id')}, row_id) AS r,
             count(*) OVER (PARTITION BY pair) AS n FROM ({BITEXT}))
WHERE n <= 100 OR r <= 100
""")
def bounded_sample(spark, sf):
    rows = bitext(spark, sf).select("pair", "row_id", "sentence1")
    return sampling.bounded_sample(rows, max_n=100, min_n=40).select("pair", "row_id", "copy", md5_of("sentence1"))


@query(f"""
SELECT lang, split, ord, epoch, md5((2025 + epoch) || ':' || lang || ':' || split || ':' || ord) AS order_key
FROM (SELECT lang, source AS split, doc_id AS ord, {GAPS} AS text FROM documents), range(5) AS e(epoch)
WHERE text <> ''
""")
def epoch_repeat(spark, sf):
    rows = sampling.repeat_epochs(gaps(spark, sf))
    return rows.select("lang", "split", "ord", F.col("epoch").cast("bigint").alias("epoch"), "order_key")


@query(f"""
SELECT lang, count(*) AS n_rows, count(DISTINCT epoch) AS n_epochs, count(DISTINCT split_pos) AS n_splits
FROM (SELECT lang, dense_rank() OVER (PARTITION BY lang ORDER BY split) - 1 AS split_pos, text
      FROM (SELECT lang, source AS split, {GAPS} AS text FROM documents)), range(3) AS e(epoch)
WHERE text <> '' AND lang IN ('fr', 'es') GROUP BY lang
""")
def epoch_rows(spark, sf):
    rows = extended.repeated_languages(gaps(spark, sf), ["fr", "es"], times=3)
    return rows.groupBy("lang").agg(
        F.count("*").alias("n_rows"), F.countDistinct("epoch").alias("n_epochs"),
        F.countDistinct("split_pos").alias("n_splits"),
    )


TOPIC_ROWS = f"""
SELECT doc_id AS ord, text, (doc_id % 24)::INTEGER AS top_choice_index, {sql_uniform(3, 'doc_id')} AS top_choice_prob FROM documents
"""


@query(f"""
SELECT ord, md5(text) AS text_md5, domain FROM (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY {sql_key(2026, 'ord')}, ord) AS r
  FROM (SELECT *, map {synthetic.TOPICS!r}[top_choice_index] AS domain FROM ({TOPIC_ROWS})
        WHERE top_choice_prob >= 0.3 AND length(text) BETWEEN 200 AND 20000) WHERE domain IS NOT NULL)
WHERE r <= 15
""")
def topic_sample(spark, sf):
    rows = corpus(spark, sf).withColumns({
        "top_choice_index": (F.col("ord") % 24).cast("int"), "top_choice_prob": rand.uniform(3, "ord")
    })
    return sampling.sample_topics(rows, synthetic.TOPICS, 15).select("ord", md5_of("text"), "domain")


@query(f"""
SELECT conv_id, turn, md5('<problem>' || p || '</problem>' || chr(10) || s) AS text_md5
FROM (SELECT conv_id, turn, {sql_strip("CASE WHEN conv_id % 5 = 0 THEN ' ' ELSE asked END")} AS p, {sql_strip('told')} AS s
      FROM ({TURNS}) ORDER BY {sql_key(2026, 'conv_id', 'turn')}, conv_id, turn LIMIT 120)
WHERE p <> '' AND s <> ''
""")
def math_format(spark, sf):
    problem = F.when(F.col("conv_id") % 5 == 0, F.lit(" ")).otherwise(F.col("asked"))
    rows = turns(spark, sf).withColumns({"problem": problem, "generated_solution": F.col("told")})
    return sampling.sample_math(rows, 120, key=("conv_id", "turn")).select("conv_id", "turn", md5_of("text"))


def recipe_sql(source: str, tokens: str, ids: str, limit: int) -> str:
    names = [n.strip() for n in ids.split(",")]
    order = f"{sql_key(42, *names)}, {ids}"
    return f"""SELECT {ids}, md5(text) AS text_md5 FROM (
      SELECT *, coalesce(sum({tokens}) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM ({source}) WHERE text <> '') WHERE before < {limit}"""


@query(recipe_sql(
    f"SELECT conv_id, turn, {sql_strip('asked || chr(10) || chr(10) || told')} AS text FROM ({TURNS})",
    sql_tokens("text"), "conv_id, turn", 5000))
def code_recipe(spark, sf):
    rows = turns(spark, sf).select("conv_id", "turn", F.col("asked").alias("query"), F.col("told").alias("document"))
    return recipes.code_sample(rows, max_tokens=5_000, key=("conv_id", "turn")).select("conv_id", "turn", md5_of("text"))


@query(recipe_sql(
    "SELECT doc_id AS ord, text, CASE WHEN doc_id % 2 = 0 THEN n_chars ELSE 0 END AS token_count FROM documents",
    f"coalesce(nullif(token_count, 0), {sql_tokens('text')})", "ord", 200000))
def math_recipe(spark, sf):
    stored = F.when(F.col("ord") % 2 == 0, F.col("n_chars")).otherwise(0)
    rows = corpus(spark, sf).withColumn("token_count", stored)
    return recipes.math_sample(rows, max_tokens=200_000).select("ord", md5_of("text"))


@query(f"""
SELECT ord, md5(text) AS text_md5 FROM (
  SELECT *, coalesce(sum({sql_tokens('text')}) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT doc_id AS ord, {sql_strip(GAPS)} AS text FROM documents) WHERE text <> '') WHERE before < 50000
""")
def web_recipe(spark, sf):
    return recipes.web_sample(gaps(spark, sf), 50_000).select("ord", md5_of("text"))


@query(f"SELECT doc_id, (row_number() OVER (ORDER BY {sql_key(42, 'doc_id')}, doc_id) - 1)::BIGINT AS position, md5(text) AS text_md5 FROM documents")
def shuffle_order(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text")
    return sampling.shuffle_position(rows, key=("doc_id",)).select("doc_id", "position", md5_of("text"))


@query(f"""
SELECT pair, row_id, swapped, md5(CASE WHEN swapped THEN sentence2 ELSE sentence1 END) AS sentence1_md5,
       md5(CASE WHEN swapped THEN sentence1 ELSE sentence2 END) AS sentence2_md5
FROM (SELECT *, {sql_uniform(42, "'swap'", 'pair', 'row_id')} < 0.5 AS swapped FROM ({BITEXT}))
""")
def swap_bitext(spark, sf):
    rows = sampling.swap_bitext(bitext(spark, sf), prob=0.5)
    return rows.select("pair", "row_id", "swapped", md5_of("sentence1"), md5_of("sentence2"))


@query("""
SELECT lang, doc_id, ((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 25 + 1)::BIGINT AS part_id, md5(text) AS text_md5 FROM documents
""")
def part_assign(spark, sf):
    rows = table(spark, sf, "documents").select("lang", "doc_id", "text")
    numbered = sampling.assign_parts(rows, 25, prefix.source_order("doc_id"), ["lang"])
    return numbered.select("lang", "doc_id", "part_id", md5_of("text"))


@query(f"SELECT pair, row_id, md5(sentence1) AS sentence1_md5, comet_score FROM ({SCORED})")
def scored_shards(spark, sf):
    # shards of the bitext, their scores checked against the manifest, and joined with the bitext
    rows = bitext(spark, sf)
    # bytes are taken before sentences meet, so that only numbers are shuffled for the shards
    sides = sized_bitext(spark, sf).withColumnRenamed("pair", "source")
    sharded, manifest = shards.assign_shards(sides, 20_000, F.col("bytes1") + F.col("bytes2"), block_rows=8)
    scored = sharded.select(
        F.col("source").alias("pair"), F.col("shard").alias("index"), "row_id", rand.uniform(7, "row_id").alias("comet_score")
    )
    whole = bitext_source.complete_shards(scored, manifest.withColumnRenamed("source", "pair")).drop("index")
    return joins.join_scores(rows, whole).select("pair", "row_id", md5_of("sentence1"), "comet_score")


@query("""
WITH RECURSIVE units AS (
  SELECT lang AS source, doc_id // 8 AS unit, count(*) AS n_rows, sum(strlen(text))::BIGINT AS n_bytes FROM documents GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY unit) AS rn FROM units),
walk AS (
  SELECT source, rn, n_rows, n_bytes, 1::BIGINT AS shard, n_bytes AS filled FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.source, n.rn, n.n_rows, n.n_bytes,
         CASE WHEN w.filled + n.n_bytes > 60000 THEN w.shard + 1 ELSE w.shard END,
         CASE WHEN w.filled + n.n_bytes > 60000 THEN n.n_bytes ELSE w.filled + n.n_bytes END
  FROM walk w JOIN numbered n ON n.source = w.source AND n.rn = w.rn + 1)
SELECT source, shard AS index, sum(n_rows)::BIGINT AS num_rows, count(*) AS row_groups,
       sum(n_bytes)::BIGINT AS estimated_bytes, source || shard || '.parquet' AS path
FROM walk GROUP BY source, shard
""")
def byte_shards(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("lang").alias("source"), F.col("doc_id").alias("row_id"), "text")
    return shards.assign_shards(rows, 60_000, shards.row_bytes(["text"]), block_rows=8)[1]


# --- formats ------------------------------------------------------------------------------

TEMPLATES = [
    "{source}: {source_content}\n{target}: {target_content}",
    "[{source_code}>{target_code}] {source_content} = {target_content}",
]
SIDES = f"""
SELECT *, map {{'en': 'English', 'fr': 'French', 'de': 'German', 'es': 'Spanish'}} AS names,
  map {{'en': 'eng_Latn', 'fr': 'fra_Latn', 'de': 'de', 'es': 'es'}} AS codes,
  split_part(pair, '-', 1) AS a, split_part(pair, '-', 2) AS b
FROM ({BITEXT}) WHERE {sql_strip('sentence1')} <> '' AND {sql_strip('sentence2')} <> ''
"""


@query(f"""
SELECT pair, row_id, md5(CASE floor({sql_uniform(5, "'template'", 'pair', 'row_id')} * 2)
  WHEN 0 THEN names[a] || ': ' || sentence1 || chr(10) || names[b] || ': ' || sentence2
  ELSE '[' || codes[a] || '>' || codes[b] || '] ' || sentence1 || ' = ' || sentence2 END) AS text_md5
FROM ({SIDES})
""")
def template_pt(spark, sf):
    rows = formats.format_pt(bitext(spark, sf), TEMPLATES, seed=5, names=NAMES)
    return rows.select("pair", "row_id", md5_of("text"))


@query(f"""
SELECT pair, row_id, md5(CASE WHEN w THEN sentence2 ELSE sentence1 END) AS human_md5,
       md5(CASE WHEN w THEN sentence1 ELSE sentence2 END) AS gpt_md5,
       'Translate the ' || names[CASE WHEN w THEN b ELSE a END] || ' content to ' || names[CASE WHEN w THEN a ELSE b END] || '.' AS system
FROM (SELECT *, {sql_uniform(42, "'swap'", 'pair', 'row_id')} < 0.5 AS w FROM ({SIDES}))
""")
def sft_format(spark, sf):
    rows = formats.format_sft(sampling.swap_bitext(bitext(spark, sf), prob=0.5), names=NAMES)
    return rows.select(
        "pair", "row_id", F.md5(F.col("conversations")[0]["value"]).alias("human_md5"),
        F.md5(F.col("conversations")[1]["value"]).alias("gpt_md5"), "system",
    )


TARGET_NAMES = {"afr_Latn": "Afrikaans", "swa_Latn": "Swahili", "xx_Latn": "xx_Latn", "eng_Latn": "English"}
SQL_PROMPT = (
    f"'{formats.TRANSLATOR}' || chr(10) || chr(10) || 'Translate this English text into ' || "
    f"map {TARGET_NAMES!r}[target_language] || ':' || chr(10) || chr(10) || text || chr(10) || chr(10) || 'Translation:'"
)
FANNED = (
    "SELECT doc_id, text, source, 'eng_Latn' AS source_language, "
    f"unnest({list(TARGET_NAMES)!r}) AS target_language FROM documents"
)


@query(f"SELECT doc_id, md5({SQL_PROMPT}) AS prompt_md5 FROM (SELECT doc_id, text, 'swa_Latn' AS target_language FROM documents)")
def translate_prompt(spark, sf):
    prompt = formats.translation_prompt(
        "text", langs.translation_name(F.lit("eng_Latn")), langs.translation_name(F.lit("swa_Latn"))
    )
    return table(spark, sf, "documents").select("doc_id", F.md5(prompt).alias("prompt_md5"))


@query(f"""
SELECT doc_id, source_language, target_language,
       CASE WHEN target_language <> source_language THEN md5({SQL_PROMPT}) END AS prompt_md5 FROM ({FANNED})
""")
def target_fanout(spark, sf):
    rows = formats.fan_out_targets(table(spark, sf, "documents"), list(TARGET_NAMES))
    return rows.select("doc_id", "source_language", "target_language", md5_of("prompt"))


# --- inference ----------------------------------------------------------------------------


def _length_scorer():
    """A stand-in for a quality model."""
    return lambda src, mt: [min(len(s), len(m)) / max(len(s), len(m), 1) for s, m in zip(src, mt)]


def _echo_generator():
    """A stand-in for a translation model: tells how long the prompt is."""
    return lambda prompts: [f" {len(p)} chars\n" for p in prompts]


@query(f"""
SELECT pair, row_id, least(length(sentence1), length(sentence2)) / greatest(length(sentence1), length(sentence2), 1) AS comet_score
FROM ({BITEXT})
""")
def score_pairs(spark, sf):
    return inference.score_pairs(bitext(spark, sf), _length_scorer)


@query(f"""
SELECT source_language, target_language, source, NULL::VARCHAR AS domain,
       md5(CASE WHEN target_language = source_language THEN text ELSE length({SQL_PROMPT}) || ' chars' END) AS text_md5
FROM ({FANNED})
""")
def translate(spark, sf):
    rows = synthetic.translate(table(spark, sf, "documents"), list(TARGET_NAMES), _echo_generator, "documents")
    return rows.select("source_language", "target_language", "source", "domain", md5_of("text"))


# --- bitext pipeline ----------------------------------------------------------------------

STEPS = [
    {"name": "FilterbyLength", "kargs": {"min_char": 20, "max_char": 10000}},
    {"name": "FilterbyScore", "kargs": {"threshold": 0.7}},
    {"name": "SwapBitext", "kargs": {"prob": 0.5, "seed": 2026}},
    {"name": "Sampling", "kargs": {"max_num_samples": 30, "seed": 2026, "min_num_samples": 24}},
]
LONG_ENOUGH = f"SELECT * FROM ({SCORED}) WHERE length(sentence1) BETWEEN 20 AND 10000 AND length(sentence2) BETWEEN 20 AND 10000"
GOOD = f"""
SELECT *, count(*) OVER (PARTITION BY pair) AS n,
  row_number() OVER (PARTITION BY pair ORDER BY {sql_key(2026, 'pair', 'row_id', '0')}, row_id) AS r
FROM ({LONG_ENOUGH}) JOIN (SELECT pair, quantile_cont(comet_score, 0.7) AS cutoff FROM ({LONG_ENOUGH}) GROUP BY pair) USING (pair)
WHERE comet_score >= cutoff
"""
SAMPLED = f"""
SELECT *, {sql_uniform(2026, "'swap0'", 'pair', 'row_id', "'0'")} < 0.5 AS w
FROM (SELECT *, unnest(generate_series(0, CASE WHEN n < 12 THEN 24 // n ELSE 1 END - 1)) AS copy FROM ({GOOD}) WHERE n <= 30 OR r <= 30)
"""
FINAL = f"SELECT * FROM ({SAMPLED}) WHERE {sql_strip('sentence1')} <> '' AND {sql_strip('sentence2')} <> ''"
NAME_MAP = "map {'en': 'English', 'fr': 'French', 'de': 'German', 'es': 'Spanish'}"


@query(f"""
SELECT pair, row_id, copy::VARCHAR AS copy, md5(CASE WHEN w THEN sentence2 ELSE sentence1 END) AS human_md5,
       md5(CASE WHEN w THEN sentence1 ELSE sentence2 END) AS gpt_md5,
       'Translate the ' || {NAME_MAP}[split_part(pair, '-', CASE WHEN w THEN 2 ELSE 1 END)] || ' content to ' ||
       {NAME_MAP}[split_part(pair, '-', CASE WHEN w THEN 1 ELSE 2 END)] || '.' AS system
FROM ({FINAL})
""")
def bitext_pipeline(spark, sf):
    rows, _ = bitext_plan.run_bitext(bitext(spark, sf), comet(spark, sf), STEPS, names=NAMES)
    return rows.select(
        "pair", "row_id", "copy", F.md5(F.col("conversations")[0]["value"]).alias("human_md5"),
        F.md5(F.col("conversations")[1]["value"]).alias("gpt_md5"), "system",
    )


STATS = " UNION ALL ".join(
    f"SELECT p.pair, {no} AS step_no, '{name}' AS step, count(x.row_id) AS n_rows "
    f"FROM (SELECT DISTINCT pair FROM ({BITEXT})) p LEFT JOIN ({source}) x USING (pair) GROUP BY p.pair"
    for no, (name, source) in enumerate([
        ("original", BITEXT), ("FilterbyLength", LONG_ENOUGH), ("FilterbyScore", GOOD), ("SwapBitext", GOOD),
        ("Sampling", SAMPLED), ("final", FINAL),
    ])
)


@query(STATS)
def pipeline_stats(spark, sf):
    _, stats = bitext_plan.run_bitext(bitext(spark, sf), comet(spark, sf), STEPS, names=NAMES)
    return stats


@query(f"""
SELECT pair, actual, expected, actual = expected AND expected > 0 AS valid FROM (
  SELECT p.pair, count(x.row_id) AS actual, CASE WHEN p.pair = 'es-en' THEN 0 WHEN p.pair = 'en-es' THEN count(x.row_id) + 1 ELSE count(x.row_id) END AS expected
  FROM (SELECT DISTINCT pair FROM ({BITEXT})) p LEFT JOIN (SELECT * FROM ({BITEXT}) WHERE length(sentence1) > 100) x USING (pair) GROUP BY p.pair)
""")
def validate_outputs(spark, sf):
    outputs = bitext(spark, sf).where(F.length("sentence1") > 100)
    counts = bitext(spark, sf).groupBy("pair").agg(F.count_if(F.length("sentence1") > 100).alias("n"))
    # an older run of every pair, and a later one that is wrong for one pair and has no other
    older = counts.select("pair", F.lit(1).alias("run"), F.lit(0).cast("bigint").alias("final_samples"))
    later = counts.where("pair <> 'es-en'").select(
        "pair", F.lit(2).alias("run"), F.when(F.col("pair") == "en-es", F.col("n") + 1).otherwise(F.col("n")).alias("final_samples")
    )
    return checks.validate_outputs(outputs, older.unionByName(later))


# --- written and read back ----------------------------------------------------------------


@query("SELECT lang, md5(text) AS text_md5 FROM documents")
def jsonl_by_lang(spark, sf):
    path = shared_path(spark, "jsonl")
    writers.write_jsonl(corpus(spark, sf), path, shard_bytes=1 << 20)
    return spark.read.schema("text string, lang string").json(path).select("lang", md5_of("text"))


@query(f"SELECT lang, split, ord, n_chars, md5(text) AS text_md5 FROM ({CORPUS})")
def corpus_parquet(spark, sf):
    path = shared_path(spark, "corpus")
    writers.write_corpus(corpus(spark, sf), path)
    return corpus_source.read_corpus(spark, path).select("lang", "split", "ord", "n_chars", md5_of("text"))


@query(f"""
SELECT lang, split, ord >> 16 AS block, count(*) AS n_rows, min(ord) AS first, max(ord) AS last,
  sum(length(text))::BIGINT AS chars
FROM ({CORPUS}) GROUP BY ALL
""")
def block_sizes(spark, sf):
    path = shared_path(spark, "corpus")
    writers.write_corpus(corpus(spark, sf), path)
    corpus_source.store_block_sizes(spark, path)
    wanted = corpus_source.parse_mixture_config(config(spark, sf))
    return corpus_source.read_block_sizes(spark, path, wanted)


@query(f"SELECT lang, split, split_pos, ord, epoch, n_tokens, md5(text) AS text_md5 FROM ({MIXTURE})")
def mixture_stored(spark, sf):
    path = shared_path(spark, "corpus")
    writers.write_corpus(with_counts(spark, sf), path)
    corpus_source.store_block_sizes(spark, path)
    wanted = corpus_source.parse_mixture_config(config(spark, sf))
    blocks = corpus_source.read_block_sizes(spark, path, wanted)
    rows = corpus_source.scan_corpus(spark, path, wanted)
    out = mixture.build_mixture(rows, wanted, "token_count", blocks=blocks)
    return out.select("lang", "split", "split_pos", "ord", "epoch", "n_tokens", md5_of("text"))


@query("""
SELECT lang AS pair, run, CASE run WHEN 1 THEN count(*) ELSE count(*) // 2 END AS final_samples
FROM documents, (VALUES (1::BIGINT), (2::BIGINT)) r(run) GROUP BY lang, run
""")
def stats_appended(spark, sf):
    path = shared_path(spark, "stats")
    counts = corpus(spark, sf).groupBy(F.col("lang").alias("pair")).agg(F.count("*").alias("final_samples"))
    writers.append_stats(counts.withColumn("run", F.lit(1).cast("bigint")), path)
    halves = counts.withColumn("final_samples", F.expr("final_samples div 2"))
    writers.append_stats(halves.withColumn("run", F.lit(2).cast("bigint")), path)
    return spark.read.parquet(path).select("pair", "run", "final_samples")


@query("""
SELECT lang, doc_id, (coalesce(sum(n_chars) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS chars_before
FROM documents
""")
def prefix_sum(spark, sf):
    rows = table(spark, sf, "documents").select("lang", "doc_id", "n_chars")
    return prefix.running_sum(rows, ["lang"], prefix.source_order("doc_id"), F.col("n_chars"), "chars_before").drop("n_chars")


@query(f"""
SELECT pair, row_id, {sql_uniform(7, 'row_id')} AS comet_score FROM ({BITEXT}) WHERE row_id % 3 = 0
""")
def scored_units(spark, sf):
    path = shared_path(spark, "units")
    rows = comet(spark, sf).where("row_id % 3 = 0")
    size = max(1, rows.count())
    # two attempts: the second finds every unit in the log
    for _ in range(2):
        writers.write_units(rows, lambda part: part, path, unit_rows=size, job_rows=size)
    return spark.read.parquet(path).select("pair", "row_id", "comet_score")
