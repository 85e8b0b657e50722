"""Type 2 history: incremental from snapshots, in bulk from a log, and its public view."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.numbering import global_row_number
from stratalake.operators.skew import bucketed_by_sequence
from stratalake.session import materialize

START, END = "__START_AT", "__END_AT"


def apply_versions(
    history: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    start: str = START,
    end: str = END,
    current: str | None = None,
    close_missing_at: Column | None = None,
    small_incoming: bool = False,
) -> DataFrame:
    """Bring a version history up to date with one row per key of ``incoming``.

    ``incoming`` carries its effective time in ``start``. Open rows and
    incoming rows meet in one full outer join whose every result row emits the
    versions that follow from it, so neither side is read twice:

    * same ``compare`` values (NULL-safe): the open row stays as it is;
    * different and newer: the open row ends where the incoming one starts, and
      the incoming one becomes the open version;
    * different with the same effective time: a correction, which takes the
      place of the open row, as a version without duration would say nothing;
    * older than the open row: ignored (``detect_changes`` reports it as stale).

    Keys compare NULL-safely, and a replay of the same input changes nothing.
    * key only in ``history``: kept, or closed at ``close_missing_at``;
    * key only in ``incoming``: a new open version.

    Intervals are half-open.

    The full outer join moves all open rows once, which suits a snapshot of
    most keys. With ``small_incoming`` the open rows are streamed past the
    incoming ones instead, so that a batch small enough to broadcast touches a
    large history without shuffling it.
    """
    history = _with_new_columns(history, incoming, [c for c in (end, current) if c])
    is_open = F.col(current) if current else F.col(end).isNull()
    closed = history.filter(~F.coalesce(is_open, F.lit(False)))
    open_rows = history.filter(is_open)

    payload = [c for c in history.columns if c not in {start, end, current}]
    types = {f.name: f.dataType for f in history.schema.fields}
    known = set(incoming.columns)

    def version(side: str, begin: Column, finish: Column, live: bool | Column) -> Column:
        fields = [
            (F.col(f"{side}.`{c}`") if side == "h" or c in known else F.lit(None)).cast(types[c]).alias(c)
            for c in payload
        ]
        fields += [begin.cast(types[start]).alias(start), finish.cast(types[end]).alias(end)]
        if current:
            fields.append((live if isinstance(live, Column) else F.lit(live)).alias(current))
        return F.struct(*fields)

    same_key = reduce(lambda a, b: a & b, [F.col(f"h.`{k}`").eqNullSafe(F.col(f"i.`{k}`")) for k in keys])
    joined = open_rows.withColumn("_h", F.lit(True)).alias("h").join(
        incoming.withColumn("_i", F.lit(True)).alias("i"), same_key, "left" if small_incoming else "full"
    )
    in_history, in_incoming = F.col("_h").isNotNull(), F.col("_i").isNotNull()
    equal = reduce(
        lambda a, b: a & b, [F.col(f"h.`{c}`").eqNullSafe(F.col(f"i.`{c}`")) for c in compare]
    )
    newer = F.coalesce(F.col(f"i.`{start}`") > F.col(f"h.`{start}`"), F.lit(False))
    same_time = F.col(f"i.`{start}`").eqNullSafe(F.col(f"h.`{start}`"))
    replaced = in_history & in_incoming & ~equal & newer
    corrected = in_history & in_incoming & ~equal & same_time
    none = F.lit(None)
    kept_end = F.when(replaced, F.col(f"i.`{start}`"))
    live = ~replaced
    if close_missing_at is not None:
        missing = in_history & ~in_incoming
        kept_end = F.when(missing, close_missing_at).otherwise(kept_end)
        live = live & ~missing
    versions = F.array(
        F.when(in_history & ~corrected, version("h", F.col(f"h.`{start}`"), kept_end, live)),
        F.when(~in_history | replaced | corrected, version("i", F.col(f"i.`{start}`"), none, True)),
    )
    moved = joined.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select("v.*")
    if small_incoming:
        # Incoming keys without an open row, found through the keys that have one.
        matched = open_rows.alias("h").join(incoming.alias("i"), same_key).select(
            *[F.col(f"i.`{k}`").alias(k) for k in keys]
        )
        unmatched = incoming.alias("i").join(matched.alias("h"), same_key, "left_anti").alias("i")
        fresh = unmatched.select(version("i", F.col(f"i.`{start}`"), none, True).alias("v")).select("v.*")
        moved = moved.unionByName(fresh)
    return closed.unionByName(moved)


def _with_new_columns(history: DataFrame, incoming: DataFrame, interval: Sequence[str]) -> DataFrame:
    """The history with NULL in columns that only the incoming rows have yet."""
    missing = [c for c in interval if c not in history.columns]
    if missing:
        raise ValueError(f"history lacks {missing}")
    for f in incoming.schema.fields:
        if f.name not in history.columns:
            history = history.withColumn(f.name, F.lit(None).cast(f.dataType))
    return history


def scd2_from_snapshot(
    history: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: Column | str = "ingestion_timestamp",
    close_missing: bool = False,
    missing_at: Column | None = None,
    small_incoming: bool = False,
) -> DataFrame:
    """Fold one snapshot (one row per key) into a history.

    Only a change in a ``tracked`` column opens a version; a snapshot that
    differs elsewhere leaves the open row untouched. A key absent from the
    snapshot closes only with ``close_missing``, at ``missing_at``.
    """
    if close_missing and missing_at is None:
        raise ValueError("close_missing needs missing_at, the time the keys were found missing")
    at = F.col(effective) if isinstance(effective, str) else effective
    incoming = snapshot.withColumn(START, at)
    if history is None:
        history = incoming.limit(0).withColumn(END, F.lit(None).cast(incoming.schema[START].dataType))
    return apply_versions(
        history,
        incoming,
        keys,
        tracked,
        close_missing_at=missing_at if close_missing else None,
        small_incoming=small_incoming,
    )


def scd2_from_log(
    log: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    sequence: Sequence[str],
    start: str = START,
    end: str = END,
    max_rows_per_group: int = 5_000_000,
) -> DataFrame:
    """Build the whole history of a change log at once.

    A version starts where a tracked column differs from the key's previous
    row, and ends where its next version starts. ``sequence`` orders a key's
    rows; its first column is the effective time. Of rows of one key and time
    the last one counts, as folding them one by one would leave it; rows equal
    in the whole sequence are ordered by their tracked columns. These rows are
    written once, and every later step reads them instead of the log.

    Keys with more than ``max_rows_per_group`` times are cut into ranges of the
    time. Each range is a window group of its own; the row before its first,
    and the change after its last, come from one summary row per range.
    """
    time = sequence[0]
    others = [c for c in log.columns if c not in (*keys, time)]
    order = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([*sequence[1:], *tracked])])
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), order)
    per_time = log.groupBy(*keys, time).agg(last.alias("_row")).select(*keys, time, "_row.*").select(*[f"`{c}`" for c in log.columns])
    bucketed, hot = bucketed_by_sequence(materialize(per_time, "history-log"), keys, time, max_rows_per_group)
    group = [*keys, "_bucket"]
    ordered = [F.col(time)]
    within = Window.partitionBy(*group).orderBy(*ordered)
    state = F.struct(*[F.col(f"`{c}`") for c in tracked])
    previous = F.lag(state).over(within)

    if hot is None:
        rows = bucketed.withColumn("_previous", previous)
    else:
        # One row per (hot key, range): its last state, handed to the next range.
        by_range = Window.partitionBy(*keys).orderBy("_bucket")
        position = F.struct(*ordered)
        carried = (
            bucketed.filter("_hot")
            .groupBy(*group)
            .agg(F.max_by(state, position).alias("_last"))
            .select(*group, F.lag("_last").over(by_range).alias("_carried"))
        )
        rows = (
            bucketed.withColumn("_previous", previous)
            .withColumn("_first", F.row_number().over(within) == 1)
            .transform(lambda d: _with_range_value(d, carried, keys))
            .withColumn("_previous", F.when(F.col("_first") & F.col("_hot"), F.col("_carried")).otherwise(F.col("_previous")))
            .drop("_first", "_carried")
        )
    # A missing previous row is NULL, which differs from any state.
    changes = rows.filter(~F.col("_previous").eqNullSafe(state)).drop("_previous")
    versions = changes.withColumn(start, F.col(time)).withColumn(end, F.lead(F.col(time)).over(within))
    if hot is not None:
        upcoming = (
            changes.filter("_hot")
            .groupBy(*group)
            .agg(F.min(time).alias("_opens"))
            .select(*group, F.lead("_opens").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_carried"))
        )
        versions = (
            _with_range_value(versions, upcoming, keys)
            .withColumn(end, F.coalesce(F.col(end), F.col("_carried")))
            .drop("_carried")
        )
    return versions.drop("_bucket", "_hot")


def _with_range_value(rows: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach ``_carried`` per (key, range).

    ``values`` has one row per range of a hot key. Ranges are cut so that their
    number is bounded (see ``bucketed_by_sequence``), hence the broadcast.
    """
    renamed = values.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_kb"), "_carried"
    )
    condition = (F.col("_bucket") == F.col("_kb")) & F.col("_hot")
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(F.broadcast(renamed), condition, "left").drop(
        *[f"_k{i}" for i in range(len(keys))], "_kb"
    )


def scd2_view(history: DataFrame, key: str, surrogate: str, start: str = START, end: str = END) -> DataFrame:
    """Public form of a history: sequential key, readable interval, active flag."""
    numbered = global_row_number(
        history,
        [F.col(key).asc(), F.col(start).asc(), F.col(end).asc_nulls_last()],
        surrogate,
    )
    others = [c for c in history.columns if c not in (start, end)]
    return numbered.select(
        surrogate,
        *others,
        F.col(start).alias("effective_start_ts"),
        F.col(end).alias("effective_end_ts"),
        F.col(end).isNull().alias("is_active"),
    )
