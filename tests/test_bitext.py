"""Scores, steps, labels and records of bitext."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.operators import checks, filters, formats, inference, joins, layout, sampling, scores
from corpusmill.plans.bitext import run_bitext


def scored(spark, groups):
    rows = [(p, i, None if s is None else float(s)) for p, ss in groups.items() for i, s in enumerate(ss)]
    return spark.createDataFrame(rows, "pair string, row_id long, score double").repartition(5)


GROUPS = {
    "one": [0.5],
    "ties": [0.25] * 40 + [0.5] * 3,
    "wide": [-1e6, 3.0, 1e9, 0.1, 0.2, 0.30000001, 0.30000002],
    "close": [0.5 + i * 1e-15 for i in range(50)],
    "even": list(np.random.default_rng(1).random(501)),
    "peaked": list(0.8 + np.random.default_rng(2).normal(0, 1e-6, 400)),
    "outlier": [1e300, *np.random.default_rng(3).random(100)],
}


@pytest.mark.parametrize("t", [0.0, 0.3, 0.5, 0.7, 0.93, 1.0])
def test_percentile_equals_numpy(spark, t):
    df = scored(spark, GROUPS)
    cut = {r.pair: r.cutoff for r in scores.score_percentile(df, "score", t).collect()}
    for pair, values in GROUPS.items():
        assert cut[pair] == np.percentile(values, t * 100), pair
    kept = Counter(r.pair for r in scores.filter_score(df, "score", "percentile", t).collect())
    for pair, values in GROUPS.items():
        assert kept[pair] == sum(v >= np.percentile(values, t * 100) for v in values)


def test_missing_scores_never_pass(spark):
    df = scored(spark, {"p": [None, float("nan"), 0.1, 0.9]})
    assert [r.score for r in scores.filter_score(df, "score", "percentile", 0.5).collect()] == [0.9]
    assert sorted(r.score for r in scores.filter_score(df, "score", "absolute", 0.0).collect()) == [0.1, 0.9]


def test_histogram_equals_numpy(spark):
    edges = [k * 0.001 for k in range(1001)]
    values = edges + [np.nextafter(e, 0) for e in edges[1:]] + [np.nextafter(e, 2) for e in edges[:-1]] + [-0.1, 1.1]
    got = {r.bin: r.n for r in scores.score_histogram(scored(spark, {"p": values}), "score").collect()}
    expected, _ = np.histogram(values, bins=1000, range=(0.0, 1.0))
    assert got == {i: n for i, n in enumerate(expected) if n}


def test_peak_equals_numpy(spark):
    groups = {**GROUPS, "outside": [2.0, 3.0], "tie": [0.1, 0.2]}
    got = {r.pair: r.cutoff for r in scores.score_peak(scored(spark, groups), "score", 0.93).collect()}
    for pair, values in groups.items():
        hist, edges = np.histogram(values, bins=1000, range=(0.0, 1.0))
        i = int(np.argmax(hist))
        peak = (edges[i] + edges[i + 1]) / 2
        assert got[pair] == pytest.approx(peak + (1 - 0.93) * (1 - peak), abs=1e-15)


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        scores.filter_score(scored(spark, {"p": [1]}), "score", "median")


def test_null_text_has_no_length(spark):
    df = spark.createDataFrame([("abcd", None), ("abcd", "abc"), ("😀bc", "abc")], "sentence1 string, sentence2 string")
    assert filters.filter_length(df, min_char=3, max_char=4).count() == 2


def test_pairs_that_do_not_split_in_two_are_not_allowed(spark):
    df = spark.createDataFrame([("en-fr",), ("en",), ("en-fr-sw",), ("en-xx",), ("swh-eng_Latn",)], "pair string")
    got = {r.pair for r in filters.allow_pairs(df, ["eng_Latn", "fra_Latn", "swa_Latn"]).collect()}
    assert got == {"en-fr", "swh-eng_Latn"}
    assert filters.allow_pairs(df, []).count() == 5


@pytest.mark.parametrize("pair, flipped", [("sw-en", True), ("fr-en", False), ("af-sw", False), ("-en", False), ("en", False), ("sw-fr-x", False)])
def test_direction(spark, pair, flipped):
    df = spark.createDataFrame([(pair,)], "pair string")
    assert df.select(layout.scored_reversed("pair")).first()[0] is flipped


def bitext_of(spark, pairs):
    rows = [(p, i, f"source text number {i}", f"target text number {i}") for p, n in pairs.items() for i in range(n)]
    return spark.createDataFrame(rows, "pair string, row_id long, sentence1 string, sentence2 string").repartition(4)


def scores_of(bitext):
    return bitext.select("pair", "row_id", (F.col("row_id") / 1000.0).alias("comet_score"))


def test_scores_of_another_length_fail(spark):
    bitext = bitext_of(spark, {"en-sw": 5, "en-fr": 4})
    good = scores_of(bitext)
    assert joins.join_scores(bitext, good).count() == 9
    short = good.where("NOT (pair = 'en-sw' AND row_id = 4)")
    with pytest.raises(PySparkException, match="en-sw"):
        joins.join_scores(bitext, short).collect()
    shifted = good.withColumn("row_id", F.when(F.col("pair") == "en-sw", F.col("row_id") + 1).otherwise(F.col("row_id")))
    with pytest.raises(PySparkException, match="en-sw"):
        joins.join_scores(bitext, shifted).collect()
    assert joins.join_scores(bitext, good.where("pair = 'en-fr'")).count() == 4


@pytest.mark.parametrize("compat, human", [(False, "B"), (True, "A")])
def test_labels_of_swapped_rows(spark, compat, human):
    df = spark.createDataFrame([("en-fr", 1, "A", "B")], "pair string, row_id long, sentence1 string, sentence2 string")
    row = formats.format_sft(sampling.swap_bitext(df, prob=1.0), compat_labels=compat).first()
    assert row.system == "Translate the French content to English."
    assert [t.value for t in row.conversations] == [human, "A" if human == "B" else "B"]
    assert [t["from"] for t in row.conversations] == ["human", "gpt"]


def test_unswapped_rows_and_blank_sides(spark):
    df = spark.createDataFrame(
        [("en-fr", 1, "A", "B"), ("en-fr", 2, None, "B"), ("en-fr", 3, "A", " \n")],
        "pair string, row_id long, sentence1 string, sentence2 string")
    row, = formats.format_pt(df, ["{source_code}|{target_content}"]).collect()
    assert row.text == "eng_Latn|B"
    with pytest.raises(KeyError):
        formats.format_pt(df, ["{nothing}"])


def test_a_language_without_name_fails(spark):
    df = spark.createDataFrame([("en-qq", 1, "A", "B")], "pair string, row_id long, sentence1 string, sentence2 string")
    with pytest.raises(PySparkException, match="qq"):
        formats.format_sft(df).collect()
    assert formats.format_sft(df, names={"qq": "Q"}).first().system == "Translate the English content to Q."


STEPS = [
    {"name": "FilterbyLength", "kargs": {"min_char": 20, "max_char": 100}},
    {"name": "FilterbyScore", "kargs": {"threshold": 0.5}},
    {"name": "SwapBitext", "kargs": {"prob": 0.5, "seed": 1}},
    {"name": "Sampling", "kargs": {"max_num_samples": 100, "min_num_samples": 20, "seed": 1}},
]


def test_pipeline_counts(spark):
    bitext = bitext_of(spark, {"en-sw": 500, "en-fr": 12, "en-so": 60})
    rows, stats = run_bitext(bitext, scores_of(bitext), STEPS)
    wide = {r.pair: r for r in checks.wide_stats(
        stats, ["original", "FilterbyLength", "FilterbyScore", "SwapBitext", "Sampling", "final"]).collect()}
    assert tuple(wide["en-sw"])[1:] == (500, 500 - 0, 250, 250, 100, 100)
    assert tuple(wide["en-fr"])[1:] == (12, 12, 6, 6, 18, 18)
    assert tuple(wide["en-so"])[1:] == (60, 60, 30, 30, 30, 30)
    assert Counter(r.pair for r in rows.collect()) == {"en-sw": 100, "en-fr": 18, "en-so": 30}
    # a second run gives the same rows
    again, _ = run_bitext(bitext.repartition(9), scores_of(bitext), STEPS)
    key = lambda r: (r.pair, r.row_id, r.copy, r.system, r.conversations)
    assert sorted(map(key, rows.collect())) == sorted(map(key, again.collect()))


def test_pipeline_steps_in_any_order(spark):
    bitext = bitext_of(spark, {"en-sw": 50, "en-fr": 4})
    twice = [
        {"name": "Sampling", "kargs": {"min_num_samples": 12}},
        {"name": "SwapBitext", "kargs": {}},
        {"name": "FilterbyScore", "kargs": {"strategy": "absolute", "threshold": 0.002}},
        {"name": "SwapBitext", "kargs": {}},
        {"name": "Sampling", "kargs": {"max_num_samples": 5}},
        {"name": "Sampling", "kargs": {"min_num_samples": 40}},
    ]
    rows, stats = run_bitext(bitext, scores_of(bitext), twice, task="pt", templates=["{source}: {source_content}"])
    counts = {(r.pair, r.step_no): r.n_rows for r in stats.collect()}
    assert [counts["en-fr", i] for i in range(8)] == [4, 12, 12, 6, 6, 5, 40, 40]
    got = rows.collect()
    assert len({(r.pair, r.row_id, r.copy) for r in got}) == len(got) == 80
    # two certain swaps undo each other
    assert all(r.text.startswith("English: source") and not r.swapped for r in got)


def test_pipeline_of_pairs_that_end_empty(spark):
    bitext = bitext_of(spark, {"en-sw": 5, "en-fr": 5}).withColumn(
        "sentence1", F.when(F.col("pair") == "en-sw", F.lit("short")).otherwise(F.col("sentence1")))
    rows, stats = run_bitext(bitext, scores_of(bitext), STEPS)
    counts = {r.step: r.n_rows for r in stats.where("pair = 'en-sw'").collect()}
    assert counts == {"original": 5, "FilterbyLength": 0, "FilterbyScore": 0, "SwapBitext": 0, "Sampling": 0, "final": 0}
    assert {r.pair for r in rows.collect()} == {"en-fr"}


def test_unknown_steps_and_tasks(spark):
    bitext = bitext_of(spark, {"en-fr": 2})
    with pytest.raises(ValueError):
        run_bitext(bitext, scores_of(bitext), [{"name": "Dedup"}])
    with pytest.raises(ValueError):
        run_bitext(bitext, scores_of(bitext), STEPS, task="dpo")


def test_latest_statistics_decide(spark):
    out = spark.createDataFrame([("a",)] * 3 + [("b",)] + [("d",)], "pair string")
    stats = spark.createDataFrame([("a", 1, 9), ("a", 2, 3), ("b", 1, 1), ("b", 2, 5), ("c", 1, 0)], "pair string, run int, final_samples long")
    got = {r.pair: r.valid for r in checks.validate_outputs(out, stats).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}


def test_scorer_is_loaded_once_per_task_and_sees_batches(spark):
    df = bitext_of(spark, {"sw-en": 25}).coalesce(1)

    def load():
        seen = []

        def score(src, mt):
            seen.append(len(src))
            assert len(src) <= 10 and src[0].startswith("target")
            return [len(seen)] * len(src)

        return score

    got = Counter(r.comet_score for r in inference.score_pairs(df, load, batch_rows=10).collect())
    assert got == {1.0: 10, 2.0: 10, 3.0: 5}
