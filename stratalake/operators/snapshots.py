"""Row history (type 2): every version of a row with the period it was valid.

:func:`snapshot` compares what is with what was; :func:`from_changes` reads a log of changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions import surrogate_key

PERIOD = ("valid_from", "valid_to", "scd_id")


def first_snapshot(source: DataFrame, keys: Sequence[str], valid_from: Column) -> DataFrame:
    """History of a source seen for the first time: one open version per row."""
    return (
        source.withColumn("valid_from", valid_from)
        .withColumn("valid_to", F.lit(None).cast("timestamp"))
        .withColumn("scd_id", surrogate_key([*keys, "valid_from"]))
    )


def snapshot(
    history: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    updated_at: str | None = None,
    check_columns: Sequence[str] | None = None,
    close_deleted: bool = False,
) -> DataFrame:
    """The history after one more look at the source.

    With ``updated_at`` a row has a new version when that timestamp is later than the open
    version's (or that has none), valid from it; with ``check_columns`` when any of them
    differs (NULLs being equal), valid from ``as_of``. ``close_deleted`` ends versions whose
    key is gone. A key that comes back has a version from its ``updated_at`` on, but not from
    before its last version ended.

    Closed versions pass through untouched.
    """
    open_versions = history.where(F.col("valid_to").isNull())
    closed = history.where(F.col("valid_to").isNotNull())
    ended = closed.groupBy(*keys).agg(F.max("valid_to").alias("ended")) if updated_at else None
    following = next_versions(open_versions, source, keys, as_of, updated_at, check_columns, close_deleted, ended)
    return closed.unionByName(following)


def next_versions(
    open_versions: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    updated_at: str | None = None,
    check_columns: Sequence[str] | None = None,
    close_deleted: bool = False,
    ended: DataFrame | None = None,
) -> DataFrame:
    """What becomes of the open versions: still open, newly closed, and newly opened ones.

    ``ended`` has the keys of closed versions and when the last of each ended; a version is
    not opened before. A large history can keep its closed versions in a place of their own and append the
    newly closed ones to it, so that only open versions are ever rewritten. Open versions
    and the source, both unique per key, meet in one full outer join, and each joined row
    yields its one or two versions.
    """
    if (updated_at is None) == (check_columns is None):
        raise ValueError("give either updated_at or check_columns")
    columns = source.columns

    old = open_versions.select(
        *[F.col(k).alias(f"old_key_{i}") for i, k in enumerate(keys)], F.struct(*columns, *PERIOD).alias("old")
    )
    new = source.select(
        *[F.col(k).alias(f"new_key_{i}") for i, k in enumerate(keys)], F.struct(*columns).alias("new")
    )
    not_before = F.lit(None).cast("timestamp")
    if ended is not None:
        last = ended.select(*[F.col(k).alias(f"ended_key_{i}") for i, k in enumerate(keys)], "ended")
        new = new.join(last, [F.col(f"new_key_{i}") == F.col(f"ended_key_{i}") for i in range(len(keys))], "left")
        not_before = F.col("ended")
    opened_at = F.greatest(F.col(f"new.{updated_at}"), not_before) if updated_at else as_of
    on = [F.col(f"old_key_{i}") == F.col(f"new_key_{i}") for i in range(len(keys))]
    joined = old.join(new, on, "full_outer")

    if updated_at:
        at, was = F.col(f"new.{updated_at}"), F.col(f"old.{updated_at}")
        changed = F.coalesce(at > was, was.isNull() & at.isNotNull())
    else:
        same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_columns]
        changed = ~F.array_min(F.array(*same))

    def version(side: str, valid_from: Column, valid_to: Column, scd_id: Column) -> Column:
        values = [F.col(f"{side}.{c}").alias(c) for c in columns]
        return F.struct(*values, valid_from.alias("valid_from"), valid_to.alias("valid_to"), scd_id.alias("scd_id"))

    still_open = F.lit(None).cast("timestamp")
    in_old, in_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    ends = F.when(in_old & in_new & changed, opened_at)
    if close_deleted:
        ends = ends.when(in_old & ~in_new, as_of)
    new_id = surrogate_key([*[F.col(f"new.{k}") for k in keys], opened_at])
    versions = F.array_compact(
        F.array(
            F.when(in_old, version("old", F.col("old.valid_from"), ends.cast("timestamp"), F.col("old.scd_id"))),
            F.when(in_new & (~in_old | changed), version("new", opened_at, still_open, new_id)),
        )
    )
    return joined.select(F.inline(versions))


def from_changes(
    log: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    deleted: Column | None = None,
    sequence: Sequence[str] = (),
    slice_by: str = "month",
) -> DataFrame:
    """The history that an unordered log of changes tells.

    A row of the log gives the columns of its key from ``changed_at`` on, or ends the key where
    ``deleted`` is true; a key may be deleted and come back any number of times. Of changes of a key
    at one time the last by ``sequence`` counts (of those not told apart by it, the greatest by
    content); a change to what is valid already, and the deletion of what is not there, change
    nothing. Changes without a time come before all others. Rows of the log may repeat and come in
    any order; periods of a key never overlap, and each starts at another time.

    Columns as in the log without ``sequence``, then ``valid_from, valid_to, scd_id``.

    A key's changes are ordered within slices of time (``slice_by``, a unit of ``date_trunc``), and
    slices are linked by one row each, so a key with a third of the log is ordered by many tasks.
    """
    columns = [c for c in log.columns if c not in {changed_at, *sequence}]
    values = [c for c in columns if c not in keys]
    gone = F.coalesce(deleted if deleted is not None else F.lit(False), F.lit(False))
    content = [F.struct(*[F.col(f"`{c}`") for c in values]).alias("values")] if values else []
    state = F.when(~gone, F.struct(F.lit(True).alias("there"), *content))
    order = F.struct(*[F.col(f"`{c}`") for c in sequence], F.xxhash64(*[F.col(f"`{c}`") for c in columns], gone), gone)
    key_columns = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    changes = log.select(
        *key_columns,
        F.col(f"`{changed_at}`").cast("timestamp").alias("_at"),
        order.alias("_order"),
        F.struct(state.alias("is")).alias("_state"),
    )
    # The last change at each time; repeated rows go before the shuffle.
    last = changes.groupBy(*names, "_at").agg(F.max_by("_state", "_order").alias("_state"))
    sliced = last.withColumn("_slice", F.date_trunc(slice_by, "_at"))
    in_slice = Window.partitionBy(*names, "_slice").orderBy("_at")
    of_key = Window.partitionBy(*names).orderBy("_slice")

    # What was valid when a slice began: the last state of the key's slice before it.
    ends = sliced.groupBy(*names, "_slice").agg(F.max_by("_state", F.struct("_at")).alias("_end"))
    begins = ends.select(*names, "_slice", F.lag("_end").over(of_key).alias("_begin"))
    before = F.coalesce(F.lag("_state").over(in_slice), F.col("_begin"))
    same = _null_safe(names + ["_slice"], "l", "r")
    steps = (
        _renamed(sliced, names + ["_slice"], "l")
        .join(_renamed(begins, names + ["_slice"], "r"), same)
        .select(*[F.col(f"l{c}").alias(c) for c in names + ["_slice"]], "_at", "_state", "_begin")
        .withColumn("_was", before["is"])
        .where(~F.col("_was").eqNullSafe(F.col("_state.is")))
        .select(*names, "_slice", "_at", F.col("_state.is").alias("_is"))
    )

    # A period ends with the next step: in its slice, else the first of a later slice.
    firsts = steps.groupBy(*names, "_slice").agg(F.min("_at").alias("_first"))
    nexts = firsts.select(*names, "_slice", F.lead("_first").over(of_key).alias("_later"))
    periods = (
        _renamed(steps, names + ["_slice"], "l")
        .join(_renamed(nexts, names + ["_slice"], "r"), same)
        .select(*[F.col(f"l{c}").alias(c) for c in names + ["_slice"]], "_at", "_is", "_later")
        .withColumn("_until", F.coalesce(F.lead("_at").over(in_slice), F.col("_later")))
        .where(F.col("_is").isNotNull())
    )
    found = {**dict(zip(keys, names)), **{c: f"_is.values.`{c}`" for c in values}}
    return periods.select(
        *[F.col(found[c]).alias(c) for c in columns],
        F.col("_at").alias("valid_from"),
        F.col("_until").alias("valid_to"),
        surrogate_key([*[F.col(n) for n in names], F.col("_at")]).alias("scd_id"),
    )


def _renamed(rows: DataFrame, names: Sequence[str], side: str) -> DataFrame:
    return rows.withColumnsRenamed({c: f"{side}{c}" for c in names})


def _null_safe(names: Sequence[str], left: str, right: str) -> list[Column]:
    return [F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}")) for c in names]


def merge_changes(
    history: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    deleted: Column | None = None,
    sequence: Sequence[str] = (),
    slice_by: str = "month",
) -> DataFrame:
    """The history after one more batch of changes; ``log`` has the batches before.

    Only keys of the batch get a new history, from their part of the log: a late change may split a
    period, or make two of one that two equal changes had confirmed. So the history does not depend
    on how the log was divided into batches or in which order these came.
    """
    touched = batch.select(*[F.col(f"`{k}`").alias(f"_touched_{i}") for i, k in enumerate(keys)]).distinct()
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_touched_{i}")) for i, k in enumerate(keys)]
    told = log.join(touched, same, "left_semi").unionByName(batch)
    again = from_changes(told, keys, changed_at, deleted, sequence, slice_by)
    return history.join(touched, same, "left_anti").unionByName(again)
