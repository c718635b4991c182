"""Stage times when hot keys hold a third of all purchases.

``python tests/skew_trial.py FOLDER [MILLIONS]`` writes purchases to FOLDER (about 32 MB per million
rows), runs the main models over them, and prints for each longer stage the median and the
longest task from Spark's event log.
"""

from __future__ import annotations

import collections
import json
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratalake import configure  # noqa: E402
from stratalake.operators import checks  # noqa: E402
from stratalake.plans import analytics, gold, marts, spec  # noqa: E402


def write_tables(spark: SparkSession, folder: Path, n: int) -> None:
    """A third of the purchases by user 7, a third of product 11, a third without product."""
    at = F.timestamp_seconds(F.lit(1700000000) + F.col("id"))
    none = F.lit(None).cast("timestamp")
    spark.range(n, numPartitions=32).select(
        F.col("id").alias("purchase_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % (n // 15)).alias("user_id"),
        F.when(F.col("id") % 3 == 0, 11).when(F.col("id") % 3 == 1, F.col("id") % (n // 10)).alias("product_id"),
        at.alias("purchased_at"),
        at.alias("added_to_cart_at"),
        F.when(F.col("id") % 10 == 0, at).alias("returned_at"),
        at.alias("loaded_at"),
    ).write.parquet(f"{folder}/purchases")
    spark.range(n // 10, numPartitions=8).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("make"), F.col("id") % 100).alias("make"),
        F.concat(F.lit("model"), F.col("id")).alias("model"),
        F.lit(2020).alias("year"),
        (F.col("id") % 1000).cast("decimal(10,2)").alias("price"),
        none.alias("created_at"),
        none.alias("loaded_at"),
    ).write.parquet(f"{folder}/products")
    names = ("full_name", "email", "occupation", "city", "state", "country_code")
    spark.range(n // 15, numPartitions=8).select(
        F.col("id").alias("user_id"),
        *[F.concat(F.lit(c), F.col("id")).alias(c) for c in names],
        F.lit(30).alias("age"),
        none.alias("created_at"),
    ).write.parquet(f"{folder}/users")


def report(log: Path) -> None:
    tasks = collections.defaultdict(list)
    for line in log.open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            metrics = event["Task Metrics"]
            read = metrics["Shuffle Read Metrics"]["Total Records Read"]
            tasks[event["Stage ID"]].append((metrics["Executor Run Time"] / 1000, read))
    for stage, found in sorted(tasks.items()):
        seconds = sorted(s for s, _ in found)
        if sum(seconds) > 4:
            print(
                f"stage {stage:3d}: {len(found):3d} tasks, median {seconds[len(seconds) // 2]:6.2f} s, "
                f"longest {seconds[-1]:6.2f} s, rows read by one task at most {max(r for _, r in found)}"
            )


def main() -> None:
    folder, n = Path(sys.argv[1]), int(float(sys.argv[2]) * 1e6) if len(sys.argv) > 2 else 30_000_000
    log = folder / f"events_{time.time_ns()}"
    log.mkdir(parents=True)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", str(log))
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    configure(spark)
    if not (folder / "purchases").exists():
        write_tables(spark, folder, n)
    purchases, products, users = (spark.read.parquet(f"{folder}/{t}") for t in ("purchases", "products", "users"))
    fact = marts.fct_purchases(purchases, products)
    table = gold.gold_user_purchases(marts.dim_users_from_fact(users, fact), fact, F.lit(None).cast("timestamp"))
    runs = {
        "dim_products": marts.dim_products(products, purchases),
        "fct_purchases": fact,
        "dim_users": marts.dim_users(users, purchases, products),
        "gold_user_purchases": table,
        "checks": checks.run_checks(
            purchases, "staging", "stg_purchases", spec.CHECKS["stg_purchases"], {"stg_users": users, "stg_products": products}
        ),
        "weekly_retention": analytics.weekly_retention(fact),
    }
    for name, frame in runs.items():
        started = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - started:.1f} s", flush=True)
    spark.stop()
    report(next(log.iterdir()))


if __name__ == "__main__":
    main()
