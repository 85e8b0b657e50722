"""Change detection, type 1 and type 2 merges, and CDC feeds.

Open-source Spark has no MERGE for plain tables, so every operator returns the
new target content; publishing it is a separate step.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.aggregates import one_row, require_unique
from stratalake.operators.history import apply_versions, scd2_from_snapshot
from stratalake.operators.latest import latest_records
from stratalake.operators.observations import DELETED as DELETED_FLAG
from stratalake.operators.observations import merge_observations, operations, versions_of
from stratalake.session import materialize
from stratalake.sources.config import ChangeSettings

NEW, CHANGED, UNCHANGED, DELETED, STALE = "new", "changed", "unchanged", "deleted", "stale"


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """NULL-safe equality, so that a replayed NULL key meets itself."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def detect_changes(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = ("business_key",),
    hash_column: str = "record_hash",
    current: str | None = None,
    detect_deletes: bool = False,
    effective: str | None = None,
) -> DataFrame:
    """The source rows with a ``change_type`` column.

    One join against the target's keys and hashes classifies every row; hashes
    compare NULL-safely, so no row falls between the classes. ``current`` names
    a boolean target column that restricts a history to its open rows, without
    which old versions would multiply matches. ``effective`` names the time both
    sides carry: a difference that is older than the target's row is stale. With ``detect_deletes`` target
    keys missing from the source appear too, their other columns NULL.
    """
    if current:
        target = target.filter(F.col(current))
    since = F.col(effective) if effective else F.lit(None)
    slim = target.select(
        *keys, F.col(hash_column).alias("_target_hash"), since.alias("_target_since"), F.lit(True).alias("_in_target")
    )
    older = F.coalesce(F.col(f"s.{effective}") < F.col("_target_since"), F.lit(False)) if effective else F.lit(False)
    marked = source.withColumn("_in_source", F.lit(True))
    joined = marked.alias("s").join(
        slim.alias("t"), same_keys("s", "t", keys), "full" if detect_deletes else "left"
    )
    kind = (
        F.when(F.col("_in_source").isNull(), DELETED)
        .when(F.col("_in_target").isNull(), NEW)
        .when(F.col(f"s.{hash_column}").eqNullSafe(F.col("_target_hash")), UNCHANGED)
        .when(older, STALE)
        .otherwise(CHANGED)
    )
    columns = [
        F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c) if detect_deletes and c in keys else F.col(f"s.{c}").alias(c)
        for c in source.columns
    ]
    return joined.select(*columns, kind.alias("change_type"))


def change_metrics(changes: DataFrame, target: DataFrame) -> DataFrame:
    """One row: source_rows, target_rows, new_rows, changed_rows, unchanged_rows, stale_rows."""

    def rows_of(kind: str) -> Column:
        return F.count_if(F.col("change_type") == kind)

    counted = changes.agg(
        F.count_if(F.col("change_type") != DELETED).alias("source_rows"),
        rows_of(NEW).alias("new_rows"),
        rows_of(CHANGED).alias("changed_rows"),
        rows_of(UNCHANGED).alias("unchanged_rows"),
        rows_of(STALE).alias("stale_rows"),
    )
    sized = target.agg(F.count(F.lit(1)).alias("target_rows"))
    return one_row(counted, sized).select(
        "source_rows", "target_rows", "new_rows", "changed_rows", "unchanged_rows", "stale_rows"
    )


def scd1_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], check_unique: bool = True
) -> DataFrame:
    """Matched rows are replaced, others inserted; no history.

    An anti join keeps the target from being shuffled whenever the source keys
    are small enough to broadcast, which a full outer join would not allow. As
    with MERGE, a source that repeats a key is an error; ``check_unique=False``
    skips that extra job for a source already reduced to one row per key.
    """
    if check_unique:
        require_unique(source, keys, "upsert source")
    kept = target.alias("t").join(source.select(*keys).alias("s"), same_keys("t", "s", keys), "left_anti")
    return kept.unionByName(source)


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = ("business_key",),
    hash_column: str = "record_hash",
    start: str = "effective_from",
    end: str = "effective_to",
    current: str = "is_current",
    check_unique: bool = True,
    small_source: bool = False,
) -> DataFrame:
    """Close the open version of changed keys, add their new version, insert new keys.

    The source brings keys, payload, hash and ``start``. ``small_source`` keeps
    a large target from being shuffled (see :func:`apply_versions`).
    """
    if check_unique:
        require_unique(source, keys, "merge source")
    return apply_versions(
        target,
        source,
        keys,
        compare=[hash_column],
        start=start,
        end=end,
        current=current,
        small_incoming=small_source,
    )


def run_merge(
    source: DataFrame,
    target: DataFrame,
    strategy: str = "TYPE1",
    keys: Sequence[str] = ("business_key",),
    hash_column: str = "record_hash",
) -> tuple[DataFrame, DataFrame]:
    """Detect changes, apply new and changed rows, and report row metrics.

    Both results are computed from the same, not yet replaced target, so the
    metrics describe the merge and not its outcome. The classified rows are
    written once and feed both. A stale row changes nothing and is counted.
    """
    kind = strategy.strip().upper()
    if kind not in ("TYPE1", "TYPE2"):
        raise ValueError(f"unsupported merge strategy: {strategy!r}")
    require_unique(source, keys, "merge source")
    current = "is_current" if kind == "TYPE2" else None
    effective = "effective_from" if kind == "TYPE2" else None
    changes = materialize(detect_changes(source, target, keys, hash_column, current=current, effective=effective), "merge-changes")
    metrics = change_metrics(changes, target)
    delta = changes.filter(F.col("change_type").isin(NEW, CHANGED)).drop("change_type")
    if kind == "TYPE1":
        return scd1_upsert(target, delta, keys, check_unique=False), metrics
    return scd2_merge(target, delta, keys, hash_column, check_unique=False), metrics


DELETE_CODES = ("D", "DELETE")


def _last_operations(
    feed: DataFrame, keys: Sequence[str], operation_column: str, sequence_column: str, delete_codes: Sequence[str]
) -> DataFrame:
    """The last operation per key as a row of the table, with ``is_deleted``. NULL sequences come before all others."""
    deleting = F.coalesce(F.upper(F.col(operation_column)).isin([c.upper() for c in delete_codes]), F.lit(False))
    return latest_records(feed, keys, [sequence_column]).withColumn("is_deleted", deleting).drop(operation_column)


def _upsert_newer(known: DataFrame, last: DataFrame, keys: Sequence[str], sequence_column: str) -> DataFrame:
    """``known`` with those rows of ``last`` that are newer than its own.

    A row without a sequence can't be newer than a row that is there. The feed
    is the small side of all three joins, so a large target is streamed past a
    broadcast feed and not shuffled.
    """
    same, t_seq, s_seq = same_keys("t", "s", keys), F.col(f"t.{sequence_column}"), F.col(f"s.{sequence_column}")
    not_newer = s_seq.isNull() | F.coalesce(t_seq >= s_seq, F.lit(False))
    stale = known.alias("t").join(last.alias("s"), same & not_newer).select(*[F.col(f"s.{k}") for k in keys])
    fresh = last.alias("t").join(stale.alias("s"), same, "left_anti")
    kept = known.alias("t").join(fresh.select(*keys).alias("s"), same, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def _with_flag(table: DataFrame) -> DataFrame:
    return table if "is_deleted" in table.columns else table.withColumn("is_deleted", F.lit(False))


def apply_changes(
    target: DataFrame | None,
    feed: DataFrame,
    keys: Sequence[str],
    operation_column: str,
    sequence_column: str,
    delete_handling: str = "HARD",
    delete_codes: Sequence[str] = DELETE_CODES,
) -> DataFrame:
    """Apply an insert / update / delete feed to a one-row-per-key table.

    The last operation per key by ``sequence_column`` counts, and only when it
    is newer than the target row: late, lower sequences are ignored, and so is
    an operation without a sequence on a key that is there. A hard delete
    removes the row, a soft delete keeps it with ``is_deleted``. The sequence
    stays in the table as the guard for later batches. A hard delete takes it
    away; :func:`apply_changes_with_tombstones` keeps it.
    """
    handling = delete_handling.strip().upper()
    if handling not in ("HARD", "SOFT"):
        raise ValueError(f"unknown delete handling: {delete_handling!r}")
    last = _last_operations(feed, keys, operation_column, sequence_column, delete_codes)
    if target is not None:
        # Written once: three joins read it.
        last = _upsert_newer(_with_flag(target), materialize(last, "feed-last"), keys, sequence_column)
    if handling == "HARD":
        return last.filter(~F.col("is_deleted")).drop("is_deleted")
    return last


def apply_changes_with_tombstones(
    target: DataFrame | None,
    tombstones: DataFrame | None,
    feed: DataFrame,
    keys: Sequence[str],
    operation_column: str,
    sequence_column: str,
    delete_codes: Sequence[str] = DELETE_CODES,
) -> tuple[DataFrame, DataFrame]:
    """Hard deletes that are remembered: the new table, and keys and sequences of what was deleted.

    Both go into the next batch, where an operation older than a delete does
    not revive its key. A key is in one of the two only.
    """
    state = _last_operations(feed, keys, operation_column, sequence_column, delete_codes)
    known = None if target is None else _with_flag(target)
    if tombstones is not None:
        graves = tombstones.withColumn("is_deleted", F.lit(True))
        known = graves if known is None else known.unionByName(graves, allowMissingColumns=True)
    if known is not None:
        # Written once: three joins read it.
        state = _upsert_newer(known, materialize(state, "feed-last"), keys, sequence_column)
    state = materialize(state, "feed-state")
    alive = state.filter(~F.col("is_deleted")).drop("is_deleted")
    return alive, state.filter("is_deleted").select(*keys, sequence_column)


def apply_configured(
    target: DataFrame | None, incoming: DataFrame, keys: Sequence[str], settings: ChangeSettings
) -> DataFrame:
    """Apply a source's changes the way its configuration asks for.

    Mode FEED applies operations (:func:`apply_changes`); mode SNAPSHOT upserts
    one row per key, or folds it into a history when the strategy is TYPE2, and
    then tracks every column but the keys and the sequence. The sequence is
    cast to its configured type first, so that numbers do not compare as text.

    FEED with strategy TYPE2 keeps every operation, deletes included, as one row
    per key and sequence; :func:`configured_history` reads the versions off
    them. So operations may come late, and batches in any order.
    """
    mode = settings.cdc_mode.strip().upper()
    sequence = settings.sequence_column
    typed = incoming.withColumn(sequence, F.col(sequence).cast(settings.sequence_type))
    if mode == "FEED" and settings.snapshot_strategy and settings.snapshot_strategy.strip().upper() == "TYPE2":
        return merge_observations(target, operations(typed, settings.operation_column, DELETE_CODES), keys, [sequence])
    if mode == "FEED":
        return apply_changes(
            target, typed, keys, settings.operation_column, sequence, settings.delete_handling
        )
    if mode != "SNAPSHOT":
        raise ValueError(f"unknown CDC mode: {settings.cdc_mode!r}")
    keys = [settings.snapshot_key_column] if settings.snapshot_key_column else list(keys)
    newest = latest_records(typed, keys, [sequence])
    if settings.snapshot_strategy.strip().upper() == "TYPE2":
        tracked = [c for c in newest.columns if c not in {*keys, sequence}]
        return scd2_from_snapshot(target, newest, keys, tracked, sequence)
    return newest if target is None else scd1_upsert(target, newest, keys, check_unique=False)


def configured_history(
    operations_kept: DataFrame, keys: Sequence[str], settings: ChangeSettings, tracked: Sequence[str] | None = None
) -> DataFrame:
    """The type 2 history of a FEED source with strategy TYPE2, from the table that :func:`apply_configured` keeps."""
    sequence = settings.sequence_column
    tracked = list(tracked) if tracked is not None else [c for c in operations_kept.columns if c not in {*keys, sequence, DELETED_FLAG}]
    return versions_of(operations_kept, keys, tracked, [sequence])
