"""Further languages, repeated over several epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import discover_splits
from ..operators.lookup import attach, small_table
from ..operators.sampling import repeat_epochs

# The languages, and their splits where none can be discovered.
FALLBACK_SPLITS = {
    "aka_Latn": ["madlad400"],
    "bam_Latn": ["fineweb2", "madlad400"],
    "bem_Latn": ["fineweb2"],
    "dik_Latn": ["fineweb2", "madlad400"],
    "dyu_Latn": ["fineweb2", "madlad400"],
    "ewe_Latn": ["fineweb2", "madlad400"],
    "fon_Latn": ["fineweb2", "madlad400"],
    "fuv_Latn": ["fineweb2", "madlad400"],
    "kab_Latn": ["fineweb2"],
    "kam_Latn": ["fineweb2"],
    "kbp_Latn": ["fineweb2", "madlad400"],
    "kea_Latn": ["fineweb2"],
    "kik_Latn": ["fineweb2"],
    "kmb_Latn": ["fineweb2", "madlad400"],
    "knc_Arab": ["fineweb2"],
    "knc_Latn": ["fineweb2"],
    "kon_Latn": ["madlad400"],
    "lin_Latn": ["fineweb2", "madlad400"],
    "lua_Latn": ["fineweb2"],
    "lug_Latn": ["fineweb2", "madlad400"],
    "luo_Latn": ["fineweb2"],
    "mos_Latn": ["fineweb2"],
    "nqo_Nkoo": ["fineweb2"],
    "nso_Latn": ["fineweb2"],
    "run_Latn": ["fineweb2", "madlad400"],
    "sag_Latn": ["fineweb2", "madlad400"],
    "ssw_Latn": ["fineweb2", "madlad400"],
    "taq_Latn": ["fineweb2"],
    "tso_Latn": ["fineweb2", "madlad400"],
    "twi_Latn": ["fineweb2"],
    "tzm_Tfng": ["fineweb2", "madlad400"],
    "wol_Latn": ["fineweb2", "madlad400"],
}


def repeated_languages(
    corpus: DataFrame, languages: Sequence[str] | None = None, times: int = 5,
    seed: int | None = 2025, fallback: dict[str, list[str]] | None = None,
) -> DataFrame:
    """All splits of the languages, `times` over; `split_pos` is the place of a split.

    A language that is asked for but has no rows is an error; of the default list, those with
    rows are taken.
    """
    fallback = FALLBACK_SPLITS if fallback is None else fallback
    asked, languages = languages, list(languages or fallback)
    splits, fits = small_table(discover_splits(corpus.select("lang", "split"), languages, fallback))
    present = {r["lang"] for r in corpus.where(F.col("lang").isin(languages)).select("lang").distinct().collect()}
    if absent := sorted(set(asked or ()) - present):
        raise ValueError(f"no rows of {', '.join(absent)}")
    rows = corpus.where(F.col("lang").isin(languages))
    rows = attach(rows, splits, ["lang", "split"], fits, spread=["ord"])
    return repeat_epochs(rows, times, seed, ("lang", "split", "ord"))
