"""Language codes and names.

The short tables below are the ones the pipelines need out of the box. Names or codes of
further languages are passed in by the caller (see `read_language_names`).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession, functions as F

# Short language code -> long code.
SHORT_TO_LONG = {
    "af": "afr_Latn", "afr": "afr_Latn",
    "am": "amh_Ethi", "amh": "amh_Ethi",
    "ar": "arb_Arab", "arb": "arb_Arab",
    "ary": "ary_Arab", "arz": "arz_Arab", "aeb": "aeb_Arab",
    "en": "eng_Latn", "eng": "eng_Latn",
    "fr": "fra_Latn", "fra": "fra_Latn",
    "ha": "hau_Latn", "hau": "hau_Latn",
    "ig": "ibo_Latn", "ibo": "ibo_Latn",
    "rw": "kin_Latn", "kin": "kin_Latn",
    "mg": "plt_Latn", "plt": "plt_Latn",
    "ny": "nya_Latn", "nya": "nya_Latn",
    "om": "orm_Latn", "orm": "orm_Latn",
    "pt": "por_Latn", "por": "por_Latn",
    "sn": "sna_Latn", "sna": "sna_Latn",
    "so": "som_Latn", "som": "som_Latn",
    "st": "sot_Latn", "sot": "sot_Latn",
    "sw": "swa_Latn", "swa": "swa_Latn", "swh": "swa_Latn",
    "ti": "tir_Ethi", "tir": "tir_Ethi",
    "tn": "tsn_Latn", "tsn": "tsn_Latn",
    "xh": "xho_Latn", "xho": "xho_Latn",
    "yo": "yor_Latn", "yor": "yor_Latn",
    "zu": "zul_Latn", "zul": "zul_Latn",
}

# Short codes with a script or region, looked up first for line-aligned bitext.
SPECIAL_TO_LONG = {
    "az_Arab": "azb_Arab", "ace": "ace_Arab", "kr_Arab": "knc_Arab",
    "kr_Latn": "knc_Latn", "ks_Arab": "kas_Arab", "ks_Deva": "kas_Deva",
    "ku_Arab": "ckb_Arab", "ku_Latn": "kmr_Latn", "zh_TW": "zh_Hant",
}

# Names used in bitext prompts.
BITEXT_NAMES = {
    "aeb_Arab": "Tunisian Arabic", "afr_Latn": "Afrikaans", "amh_Ethi": "Amharic",
    "arb_Arab": "Modern Standard Arabic", "ary_Arab": "Moroccan Arabic",
    "arz_Arab": "Egyptian Arabic", "eng_Latn": "English",
    "fra_Latn": "French", "hau_Latn": "Hausa", "ibo_Latn": "Igbo", "kin_Latn": "Kinyarwanda",
    "nya_Latn": "Nyanja", "orm_Latn": "Oromo", "plt_Latn": "Plateau Malagasy",
    "por_Latn": "Portuguese", "sna_Latn": "Shona", "som_Latn": "Somali",
    "sot_Latn": "Southern Sotho", "swa_Latn": "Swahili",
    "tir_Ethi": "Tigrinya", "tsn_Latn": "Tswana", "xho_Latn": "Xhosa", "yor_Latn": "Yoruba",
    "zul_Latn": "Zulu",
}

# Names used in translation prompts.
TRANSLATION_NAMES = {
    "afr_Latn": "Afrikaans", "amh_Ethi": "Amharic", "arb_Arab": "Arabic",
    "ary_Arab": "Moroccan Arabic", "arz_Arab": "Egyptian Arabic", "eng_Latn": "English",
    "fra_Latn": "French", "hau_Latn": "Hausa", "ibo_Latn": "Igbo", "kin_Latn": "Kinyarwanda",
    "nya_Latn": "Nyanja", "orm_Latn": "Oromo", "plt_Latn": "Plateau Malagasy",
    "por_Latn": "Portuguese", "sna_Latn": "Shona", "som_Latn": "Somali",
    "sot_Latn": "Southern Sotho", "swa_Latn": "Swahili", "tir_Ethi": "Tigrinya",
    "tsn_Latn": "Tswana", "xho_Latn": "Xhosa", "yor_Latn": "Yoruba", "zul_Latn": "Zulu",
}

MAX_LANGUAGES = 20_000


def read_language_names(
    spark: SparkSession, path: str, code: str = "code", value: str = "name"
) -> dict[str, str]:
    """A caller's own code -> name (or code -> other code) table from a CSV with a header."""
    rows = (
        spark.read.option("header", True).csv(path)
        .select(F.col(code), F.col(value)).limit(MAX_LANGUAGES + 1).collect()
    )
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"{path} has more than {MAX_LANGUAGES} languages")
    return {r[0]: r[1] for r in rows}


def lookup(table: Mapping[str, str], key: Column) -> Column:
    """`table[key]`, or null. The table is a constant of the plan, so no join is needed."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.create_map(*pairs)[key] if pairs else F.lit(None).cast("string")


def long_code(col: str | Column, specials: bool = False) -> Column:
    """Codes with a script stay as they are, known short codes are expanded, others stay."""
    c = F.col(col) if isinstance(col, str) else col
    known = F.when(F.contains(c, F.lit("_")), c).otherwise(F.coalesce(lookup(SHORT_TO_LONG, c), c))
    return F.coalesce(lookup(SPECIAL_TO_LONG, c), known) if specials else known


def bitext_name(code: Column, names: Mapping[str, str] | None = None) -> Column:
    """The name for a prompt; a language without a name fails the job."""
    table = {**BITEXT_NAMES, **(names or {})}
    return F.coalesce(
        lookup(table, code),
        F.raise_error(F.concat(F.lit("no name for language "), F.coalesce(code, F.lit("null")))),
    )


def translation_name(code: Column, names: Mapping[str, str] | None = None) -> Column:
    """The name for a prompt; a language without a name is called by its code."""
    table = {**TRANSLATION_NAMES, **(names or {})}
    return F.coalesce(lookup(table, code), code)
