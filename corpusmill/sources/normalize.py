"""Sources brought to one schema: `lang`, `text`, `meta`.

Each function takes the table a source is read as; `lang` is a column, so one call handles
all languages. `meta` has the same fields for every source, null where a source has none.
Columns named in `keep` are passed through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ..functions.text import or_empty, strip

META = StructType(
    [StructField(n, StringType()) for n in (
        "id", "dump", "url", "date", "file_path", "language", "language_script",
        "source", "source_category", "dataset")]
    + [
        StructField("language_score", DoubleType()),
        StructField("minhash_cluster_size", LongType()),
        StructField("top_langs", ArrayType(StringType())),
    ]
)


def _meta(**known: Column) -> Column:
    return F.struct(*[
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in META.fields
    ]).alias("meta")


def _generated_id(dataset: str, lang: str, line: str) -> Column:
    return F.concat_ws("_", F.lit(dataset), F.col(lang), F.col(line).cast("string"))


def normalize_web(
    df: DataFrame, lang: str = "lang", text: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """Web pages with whichever of the known fields the table has; the rest get defaults."""
    if text not in df.columns:
        raise ValueError("web pages need a text column")

    def field(name: str, kind: str, default: Column) -> Column:
        return F.coalesce(F.col(name).cast(kind), default) if name in df.columns else default

    empty = F.lit("")
    known = {n: field(n, "string", empty) for n in ("id", "dump", "url", "date", "file_path", "language_script")}
    return df.select(
        *keep,
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        _meta(
            **known,
            language=F.col(lang),
            language_score=field("language_score", "double", F.lit(0.0)),
            minhash_cluster_size=field("minhash_cluster_size", "bigint", F.lit(0)),
            top_langs=field("top_langs", "array<string>", F.array().cast("array<string>")),
            dataset=F.lit("fw2"),
        ),
    )


def normalize_passages(
    df: DataFrame, lang: str = "lang", value: str = "value", line: str = "line",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Lines `id<TAB>text` (split at the first tab), or bare text with an id from the line number."""
    tab = F.instr(F.col(value), "\t")
    own_id = F.substring(F.col(value), F.lit(1), tab - 1)
    rest = F.substring(F.col(value), tab + 1, F.length(value))
    return df.select(
        *keep,
        F.col(lang).alias("lang"),
        F.when(tab > 0, rest).otherwise(F.col(value)).alias("text"),
        _meta(
            id=F.when(tab > 0, own_id).otherwise(_generated_id("wura", lang, line)),
            language=F.col(lang),
            dataset=F.lit("wura"),
        ),
    )


def parse_json_lines(
    df: DataFrame, fields: list[str], value: str = "value", seen: Observation | None = None
) -> DataFrame:
    """String fields of JSON objects, '' where missing; lines that are no JSON object are dropped.

    Parsing keeps the rest of the row, so a dropped line still uses up its line number. `seen`
    gets the numbers of `lines` and of those `skipped`, from the pass that drops them.
    """
    schema = StructType([StructField(f, StringType()) for f in [*fields, "_bad"]])
    parsed = F.from_json(F.col(value), schema, {"columnNameOfCorruptRecord": "_bad"})
    good = F.col("_json").isNotNull() & F.col("_json._bad").isNull()
    rows = df.withColumn("_json", parsed)
    if seen is not None:
        rows = rows.observe(seen, F.count("*").alias("lines"), F.count_if(~good).alias("skipped"))
    return rows.where(good).select(
        *[c for c in df.columns if c != value],
        *[or_empty(F.col("_json")[f]).alias(f) for f in fields],
    )


def normalize_documents(
    df: DataFrame, lang: str = "lang", text: str = "text", line: str = "line",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Whole documents which have a text already."""
    return _with_generated_id(df, "wura", lang, text, line, keep)


def normalize_json_lines(
    df: DataFrame, dataset: str = "madlad400", lang: str = "lang", value: str = "value",
    line: str = "line", keep: Sequence[str] = (), seen: Observation | None = None,
) -> DataFrame:
    """JSON lines with a text."""
    parsed = parse_json_lines(df, ["text"], value, seen)
    return _with_generated_id(parsed, dataset, lang, "text", line, keep)


def _with_generated_id(
    df: DataFrame, dataset: str, lang: str, text: str, line: str, keep: Sequence[str]
) -> DataFrame:
    return df.select(
        *keep,
        F.col(lang).alias("lang"),
        or_empty(text).alias("text"),
        _meta(id=_generated_id(dataset, lang, line), language=F.col(lang), dataset=F.lit(dataset)),
    )


def normalize_extra(
    df: DataFrame, lang: str = "lang", value: str = "value", line: str = "line",
    keep: Sequence[str] = (), seen: Observation | None = None,
) -> DataFrame:
    """JSON lines with a text, a source and a source category."""
    parsed = parse_json_lines(df, ["text", "source", "source-category"], value, seen)
    return parsed.select(
        *keep,
        F.col(lang).alias("lang"),
        "text",
        _meta(
            id=_generated_id("extra", lang, line),
            language=F.col(lang),
            source=F.col("source"),
            source_category=F.col("source-category"),
            dataset=F.lit("extra"),
        ),
    )


def build_documents(df: DataFrame, headline: str = "headline", content: str = "content") -> DataFrame:
    """`text` from headline and content; all other columns go into the struct `rest`."""
    text = strip(F.concat(strip(or_empty(headline)), F.lit(" "), strip(or_empty(content))))
    rest = [c for c in df.columns if c not in (headline, content)]
    return df.select(text.alias("text"), F.struct(*rest).alias("rest"))


def text_fallback(df: DataFrame) -> DataFrame:
    """One column `text`: the text, else the sentence, else the whole row as JSON."""
    for c in ("text", "sentence"):
        if c in df.columns:
            return df.select(F.col(c).cast("string").alias("text"))
    return df.select(F.to_json(F.struct("*")).alias("text"))
