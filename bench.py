"""Times the headline queries, each from call to last row, and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession, Window, functions as F

from corpusmill.queries import QUERIES
from corpusmill.session import build_session

HEADLINE = [
    "mixture_unimax", "token_char_ratio", "budget_prefix", "budget_samples", "bounded_sample",
    "topic_sample", "math_format", "epoch_repeat", "shuffle_order", "part_assign", "byte_shards",
    "join_scores", "score_percentile", "score_peak", "bitext_pipeline", "pipeline_stats",
    "sft_format", "template_pt", "norm_web", "norm_passages", "json_lines_skip_bad",
    "token_count", "target_fanout", "score_pairs",
]


def _warm_up(spark: SparkSession) -> None:
    """Loads the classes of joins, windows, aggregates and Arrow before the first measurement."""
    rows = spark.range(1000).withColumn("g", F.col("id") % 7)
    sums = rows.groupBy("g").agg(F.sum("id").alias("s"))
    window = Window.partitionBy("g").orderBy("id")
    rows.withColumn("n", F.sum("id").over(window)).join(F.broadcast(sums), "g").toArrow()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    _warm_up(spark)

    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
