"""Times the stages of a full run and headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from contextlib import contextmanager

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import driver_tables  # noqa: E402
import query_registry as registry  # noqa: E402
from stallwise import contract  # noqa: E402
from stallwise.operators import splits  # noqa: E402
from stallwise.plans import build, features, modeling, quality, runs  # noqa: E402
from stallwise.session import configure, fresh_path  # noqa: E402
from stallwise.sources import sinks  # noqa: E402

HEADLINE = [
    "met_daily_gmv", "met_daily_revenue", "met_daily_delay_rate", "payments_aggregated", "int_orders_enriched",
    "dim_customers", "fact_orders", "fact_order_items", "order_features", "roc_auc", "precision_at_k",
    "monthly_metrics", "numeric_drift", "categorical_drift",
]


def run(df: DataFrame) -> None:
    """Computes every column of every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    @contextmanager
    def timed(name: str):
        started = time.time()
        yield
        seconds[name] = round(time.time() - started, 3)

    derived = driver_tables.RawTables(spark, sf_dir)
    with timed("load_raw"):
        raw = {name: sinks.overwrite(derived[name], fresh_path(spark, f"raw-{name}")) for name in build.STAGING}

    root = fresh_path(spark, "marts")
    with timed("build_and_test"):
        tables = build.build(raw, root, splits.cut(registry.AS_OF))
        predictions = registry.Data(spark, sf_dir).predictions
        tables["fct_predictions"] = sinks.overwrite(
            features.fct_predictions(predictions, tables["fact_orders"]), f"{root}/fct_predictions"
        )
        quality.quality_suite(tables, splits.cut(registry.AS_OF)).summary().collect()

    with timed("features_export"):
        exported = sinks.overwrite(
            features.order_features(
                tables["order_core"], tables["dim_customers"], tables["dim_sellers"], tables["dim_products"]
            ),
            f"{root}/features_export",
        )

    split = splits.with_split(
        splits.labelled(exported, contract.LABEL), "order_purchase_timestamp", registry.VALIDATION_START,
        registry.TEST_START,
    )
    with timed("train"):
        sizes = splits.require_splits(split)
        train = sinks.overwrite(split.where(F.col("split") == splits.TRAIN), f"{root}/train_v1")
        model = modeling.fit(train, "v1")
        modeling.save(model, f"{root}/models")
        modeling.evaluation_summary(modeling.labelled_scores(model, split), split).collect()

    with timed("score"):
        loaded = modeling.load_linear(spark, f"{root}/models", "v1")
        scored = modeling.store_scores(loaded, exported, f"{root}/predictions")

    with timed("bridge"):
        bridge = sinks.overwrite(features.fct_predictions(scored, tables["fact_orders"]), f"{root}/bridge")

    active = registry.Data(spark, sf_dir).registry
    with timed("monitor"):
        report = runs.monitor(
            bridge, exported, active, lambda name: sinks.table(spark, f"{root}/{name}"), f"{root}/reports",
            F.current_timestamp(),
        )

    with timed("retrain"):
        done = runs.retrain(
            exported, active, report, f"{root}/models", F.lit(registry.AS_OF).cast("date"), registry.EXTENDED_END,
            registry.TEST_START, force=True,
        )
        done.registry.collect()

    for name in HEADLINE:
        with timed(name):
            run(registry.QUERIES[name](spark, sf_dir))

    print(
        json.dumps(
            {
                "metric": "stage and query wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows": sizes,
            }
        )
    )


if __name__ == "__main__":
    main()
