"""What several operators of this subpackage share."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import shared_root

#: Words of the space-separated contracts, and the characters between them.
SPACES = r"[\x20\x09-\x0D]+"


def bounded(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of some megabytes whatever the length of texts.

    By default they hold up to 64 MB, several times over in a Python task and its executor. Joins here
    sort, which spills, and hash nothing beside those batches.
    """
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "0")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    return spark


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def space_words(text: Column) -> Column:
    """Words between white space, as an array; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def saved(frame: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared checkpoint folder, its lineage cut."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(frame.sparkSession))
    return frame.checkpoint()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small(frame: DataFrame, rows: int, bound: int) -> DataFrame:
    """The frame, to be broadcast if its counted rows stay within the bound, else joined by a shuffle."""
    return F.broadcast(frame) if rows <= bound else frame


#: Trusted documents that a target model is fitted on, at most.
TRUSTED = 20_000


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """``doc_id`` of at most ``most`` documents labelled as good, those with the smallest hashes."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(documents: DataFrame) -> Column:
    """A row by its id and text: rows that agree in both are repetitions of one another.

    Ordered by id, those without one last.
    """
    text_hash = F.xxhash64(F.col("text"), F.length("text"))
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), text_hash.alias("text_hash"))


#: Column that row keys travel in beside the columns of a table.
KEY = "__row_key"


def free_name(name: str, taken: Iterable[str]) -> str:
    """The name, with as many underscores behind it as tell it from the names that are taken."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name


def with_marks(documents: DataFrame, marks: DataFrame, bound: int = 500_000) -> DataFrame:
    """``documents`` with the other columns of ``marks`` (one row per ``KEY``), NULL where there are none.

    ``marks`` are counted first: up to ``bound`` they are broadcast, beyond it both sides are shuffled.
    """
    key = free_name(KEY, documents.columns)
    marks = saved(marks.withColumnRenamed(KEY, key))
    return documents.withColumn(key, row_key(documents)).join(small(marks, marks.count(), bound), key, "left").drop(key)
