"""Comparison of two tables, for checking a migration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.session import materialized


def _hash(column: str, salt: int) -> Column:
    """64 bits of a value; NULL hashes unlike any value."""
    value = F.col(f"`{column}`")
    return F.xxhash64(F.lit(salt), value.isNull(), value)


def _per_key(a: DataFrame, b: DataFrame, keys: Sequence[str], groups: dict[str, list[str]]) -> DataFrame:
    """One row per key: its rows on each side, and for each group of columns whether both sides agree.

    One shuffle of two 64-bit hashes per group, whose sums are hash-aggregated; no pairing
    of rows. Grouping instead of joining keeps a repeated key at one row per task, where a
    join would emit every pair of its rows. A key on both sides once agrees when the
    hashes of its one row here and its one row there cancel out.
    """
    def side(frame: DataFrame, sign: int) -> DataFrame:
        hashes = [
            (F.xxhash64(F.lit(salt), *[_hash(c, salt) for c in columns]).cast("decimal(20,0)") * sign).alias(f"{group}_{salt}")
            for group, columns in groups.items()
            for salt in (1, 2)
        ]
        return frame.select(*keys, F.lit(sign).alias("sign"), *hashes)

    zero = F.lit(0).cast("decimal(20,0)")
    agree = [
        ((F.sum(f"{g}_1") == zero) & (F.sum(f"{g}_2") == zero)).alias(f"{g}_agrees") for g in groups
    ]
    grouped = side(a, 1).unionByName(side(b, -1)).groupBy(*keys).agg(
        F.count_if(F.col("sign") == 1).alias("n_a"), F.count_if(F.col("sign") == -1).alias("n_b"), *agree
    )
    status = (
        F.when((F.col("n_a") > 1) | (F.col("n_b") > 1), "duplicate_key")
        .when(F.col("n_b") == 0, "only_in_a")
        .when(F.col("n_a") == 0, "only_in_b")
    )
    return grouped.withColumn("status", status.otherwise("both"))


def _others(a: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in a.columns if c not in keys]


def compare_relations(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that are identical, changed, on one side only, or repeated."""
    per_key = _per_key(a, b, keys, {"row": _others(a, keys)})
    status = F.when(F.col("status") != "both", F.col("status")).when(F.col("row_agrees"), "identical").otherwise("changed")
    return per_key.groupBy(status.alias("status")).agg(F.count("*").alias("keys")).orderBy("status")


def compare_columns(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per column: keys on both sides whose values agree and differ (NULLs agree)."""
    columns = _others(a, keys)
    groups = {f"c{k}": [c] for k, c in enumerate(columns)}
    both = _per_key(a, b, keys, groups).where("status = 'both'")
    counts = both.agg(
        *[F.count_if(F.col(f"{g}_agrees")).alias(f"{g}_matching") for g in groups],
        *[F.count_if(~F.col(f"{g}_agrees")).alias(f"{g}_differing") for g in groups],
    )
    rows = [
        F.struct(
            F.lit(columns[0]).alias("column_name"),
            F.col(f"{g}_matching").alias("matching"),
            F.col(f"{g}_differing").alias("differing"),
        )
        for g, columns in groups.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, counting repeats, that only one side has: ``(only_in_a, only_in_b)``."""
    sides = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(-1)))
    surplus = sides.groupBy(*a.columns).agg(F.sum("_side").alias("_surplus"))
    zero = F.lit(0).cast("bigint")
    return surplus.agg(
        F.coalesce(F.sum(F.greatest(F.col("_surplus"), zero)), zero).alias("only_in_a"),
        F.coalesce(F.sum(F.greatest(-F.col("_surplus"), zero)), zero).alias("only_in_b"),
    )


#: Bits of a key's hash that name its bucket, by default.
BUCKET_BITS = 14
#: Differing buckets that are opened by a list of literals; more are joined.
LISTED_BUCKETS = 1000


def _bucket(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(1 << bits))


def digests(rows: DataFrame, keys: Sequence[str], bits: int = BUCKET_BITS) -> DataFrame:
    """``bucket, n, d1, d2``: per bucket of keys its rows, and sums of their hashes, which no order changes.

    Summed beside the rows, so a row per task and bucket is shuffled. May be written, to compare a
    relation later without reading it again.
    """
    hashes = [F.xxhash64(F.lit(salt), *[_hash(c, salt) for c in rows.columns]).cast("decimal(20,0)") for salt in (1, 2)]
    hashed = rows.select(_bucket(keys, bits).alias("bucket"), hashes[0].alias("h1"), hashes[1].alias("h2"))
    return hashed.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("h1").alias("d1"), F.sum("h2").alias("d2"))


def differing_buckets(a: DataFrame, b: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """Buckets whose digests differ, from the root down: only below differing inner nodes are leaves compared."""
    half = bits // 2

    def apart(x: DataFrame, y: DataFrame, node: Column) -> DataFrame:
        signed = x.withColumn("_sign", F.lit(1)).unionByName(y.withColumn("_sign", F.lit(-1)))
        sums = signed.groupBy(node.alias("node")).agg(*[F.sum(F.col(c) * F.col("_sign")).alias(c) for c in ("n", "d1", "d2")])
        return sums.where("n <> 0 OR d1 <> 0 OR d2 <> 0").select("node")

    inner = apart(a, b, F.shiftright("bucket", half))
    below = [x.join(inner, F.shiftright("bucket", half) == F.col("node"), "left_semi") for x in (a, b)]
    return apart(*below, F.col("bucket")).withColumnRenamed("node", "bucket")


def differences(a: DataFrame, b: DataFrame, keys: Sequence[str], bits: int = BUCKET_BITS) -> DataFrame:
    """``keys, status, columns``: every key that is not the same on both sides.

    ``status`` is ``only_in_a``, ``only_in_b``, ``changed`` (with the names of the columns that differ) or
    ``duplicate_key`` (a repeated key whose rows differ as a whole). First digests of buckets are
    compared; then only rows of differing buckets are read again and shuffled, so equal relations
    shuffle a row per task and bucket. NULL keys and values are equal to themselves.
    """
    apart = materialized(differing_buckets(digests(a, keys, bits), digests(b.select(a.columns), keys, bits), bits))
    n = apart.count()
    if n <= LISTED_BUCKETS:
        listed = [r[0] for r in apart.collect()]
        opened = [x.where(_bucket(keys, bits).isin(listed)) for x in (a, b)]
    else:
        opened = [x.join(apart, _bucket(keys, bits) == F.col("bucket"), "left_semi") for x in (a, b)]
    columns = _others(a, keys)
    groups = {"row": columns} | {f"c{k}": [c] for k, c in enumerate(columns)}
    per_key = _per_key(*opened, keys, groups)
    names = F.array_compact(
        F.array(F.lit(None).cast("string"), *[F.when(~F.col(f"c{k}_agrees"), F.lit(c)) for k, c in enumerate(columns)])
    )
    changed = F.when(F.col("status") == "both", names).otherwise(F.array().cast("array<string>"))
    status = F.when(F.col("status") == "both", "changed").otherwise(F.col("status"))
    found = per_key.where(~F.col("row_agrees") | (F.col("n_a") != F.col("n_b")))
    return found.select(*[F.col(f"`{k}`") for k in keys], status.alias("status"), changed.alias("columns"))
