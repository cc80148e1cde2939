"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from corpusmill.queries import QUERIES
from corpusmill.operators import budget, prefix, sampling
from corpusmill.queries import corpus

SF = "/root/testdata/sf0.001"
PYTHON = {"score_pairs", "translate"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON))
def test_only_models_run_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not any(word in plan for word in ("PythonUDF", "MapInPandas", "ArrowEvalPython", "FlatMapGroups"))


@pytest.mark.parametrize("name", [
    "mixture_unimax", "budget_prefix", "topic_sample", "bounded_sample", "math_recipe", "web_recipe",
    "score_percentile", "score_peak", "token_estimate", "norm_web", "epoch_repeat", "json_lines_skip_bad",
])
def test_the_corpus_itself_is_not_shuffled(spark, name):
    # the joins of test tables to make an input are broadcast at this size
    assert "Exchange hashpartitioning" not in plan_of(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["shuffle_order", "part_assign", "bitext_pipeline", "join_scores"])
def test_rows_are_shuffled_by_a_balanced_key(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "Exchange SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_cut_and_columns_reach_the_scan(spark):
    rows = corpus(spark, SF).select("ord", "text")
    plan = plan_of(sampling.take(rows, 50, order=prefix.source_order("ord")).select("ord"))
    assert "LessThanOrEqual(doc_id" in plan
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_edge_rows_are_read_by_block(spark, tmp_path):
    """The second scan of a cut skips row groups outside the block with the limit."""
    spark.range(0, 1 << 18).select(F.col("id").alias("ord"), F.lit("a").alias("lang")).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    seen = []
    original = prefix._only_blocks
    try:
        prefix._only_blocks = lambda *a: seen.append(original(*a)) or seen[-1]
        cut = prefix.prefix_cut(rows, ["lang"], prefix.source_order("ord"), F.lit(1), F.lit(100_000))
    finally:
        prefix._only_blocks = original
    assert "GreaterThanOrEqual(ord,65536)" in plan_of(seen[0]) and seen[0].count() == 1 << 16
    assert cut.keep(rows).count() == 100_000


def test_tokens_are_counted_for_kept_rows_only(spark):
    """The token count of a mixture sits above the filter by the cut."""
    rows = corpus(spark, SF)
    targets = spark.createDataFrame([("en", 1000)], "lang string, target long")
    mixed = budget.mix_to_budget(rows, targets, F.regexp_count("text", F.lit("\\S+")), order=prefix.source_order("ord"))
    plan = plan_of(mixed)
    assert plan.index("regexp_extract_all") < plan.index("BroadcastHashJoin")


def test_heads_of_large_languages_reach_the_scan(spark, tmp_path):
    from corpusmill.plans import mixture

    rows = spark.range(0, 4000).select(
        F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("lang"), F.lit("s").alias("split"), F.col("id").alias("ord"))
    rows.where("lang = 'a' OR ord < 800").write.partitionBy("lang", "split").parquet(str(tmp_path / "c"))
    corpus_ = spark.read.parquet(str(tmp_path / "c")).withColumn("split_pos", F.lit(0))
    extents = mixture._extents(corpus_)
    assert extents == {"a": [("s", 3000, 1, 3999)], "b": [("s", 200, 0, 796)]}
    head, large = mixture._heads(extents, {"a": 1000, "b": 500})
    plan = plan_of(corpus_.where(head))
    assert large == ["a"] and "LessThanOrEqual(ord,1000)" in plan
    assert corpus_.where(head).groupBy("lang").count().count() == 2
    assert mixture._heads(extents, {"a": 3000, "b": 500})[1] == []
