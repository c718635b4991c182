"""Lineage tables and questions about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.plans.spec import EXPOSURES, LAYERS, UPSTREAM
from stratalake.session import materialized
from stratalake.sources.small import small_table


def lineage_edges(spark: SparkSession) -> DataFrame:
    edges = [(up, down) for down, ups in UPSTREAM.items() for up in ups]
    return small_table(spark, edges, "upstream string, downstream string")


def exposures(spark: SparkSession) -> DataFrame:
    return small_table(spark, EXPOSURES, "exposure string, kind string, model string, version int")


def declared_models(spark: SparkSession) -> DataFrame:
    rows = [(name, name, LAYERS[name]) for name in UPSTREAM]
    return small_table(spark, rows, "unique_id string, name string, schema_name string")


def unused_models(models: DataFrame, edges: DataFrame, consumers: DataFrame) -> DataFrame:
    """Models that no other model reads and no consumer declares.

    Anti joins ignore NULL names, where ``NOT IN`` would return nothing at all. Both
    right sides are reduced to distinct names first.
    """
    read = edges.select(F.col("upstream").alias("name")).distinct()
    declared = consumers.select(F.col("model").alias("name")).distinct()
    return models.join(read, "name", "left_anti").join(declared, "name", "left_anti").orderBy("name")


def unreached_models(models: DataFrame, edges: DataFrame, consumers: DataFrame) -> DataFrame:
    """Models that no consumer reads, neither itself nor through other models.

    So a model that only unused models read is unused too. From the consumers' models upstream, step
    by step: each step joins the edges with what the step before found anew, so cycles end and the
    number of steps is the length of the longest path. What has been found is written at each step.
    """
    edges = materialized(edges.select("upstream", "downstream").distinct())
    new = materialized(consumers.select(F.col("model").alias("name")).where("name IS NOT NULL").distinct())
    used = new
    while not new.isEmpty():
        above = edges.join(new, F.col("downstream") == F.col("name"), "left_semi").select(F.col("upstream").alias("name"))
        new = materialized(above.where("name IS NOT NULL").distinct().join(used, "name", "left_anti"))
        used = materialized(used.unionByName(new))
    return models.join(used, "name", "left_anti").orderBy("name")
