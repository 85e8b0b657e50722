"""Histories whose changes may arrive in any order, with deletes and with keys that come back.

A history alone can't take a late change rightly: it has merged what confirmed a
state, so nobody can tell where the old state was seen again after the change. So
the observations are kept, one row for each key and time, and versions are read
off them. A batch changes the observations and versions of its own keys only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.history import END, START, scd2_from_log

DELETED = "is_deleted"
#: A table of at most so many snapshots is broadcast.
BROADCAST_SNAPSHOTS = 100_000


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def of_keys(rows: DataFrame, touched: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """The rows whose key is (``left_semi``) or isn't (``left_anti``) among ``touched``; NULL meets NULL."""
    return rows.alias("r").join(touched.select(*keys).distinct().alias("t"), _same("r", "t", keys), how)


def last_observations(rows: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """One row for each key and time, the first column of ``sequence``: the last one by the rest of it, then by all other columns."""
    time, others = sequence[0], [c for c in rows.columns if c not in (*keys, sequence[0])]
    if not others:
        return rows.distinct()
    order = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([*sequence[1:], *others])])
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), order).alias("_row")
    return rows.groupBy(*keys, time).agg(last).select(*keys, time, "_row.*").select(*[f"`{c}`" for c in rows.columns])


def merge_observations(known: DataFrame | None, batch: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """``known`` with those of ``batch``. In whatever order batches come, and however often, the result is the same."""
    if known is None:
        return last_observations(batch, keys, sequence)
    both = of_keys(known, batch, keys, "left_semi").unionByName(batch, allowMissingColumns=True)
    rest = of_keys(known, batch, keys, "left_anti")
    return rest.unionByName(last_observations(both, keys, sequence), allowMissingColumns=True)


def versions_of(
    observations: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    sequence: Sequence[str],
    start: str = START,
    end: str = END,
    max_rows_per_group: int = 5_000_000,
) -> DataFrame:
    """The history that ``observations`` tell: equal neighbours are one version, and while a key is deleted it has none.

    ``is_deleted`` marks observations of a missing key; without such a column
    no key ever goes. What a deleted row carries else says nothing. Hot keys are
    cut into ranges of the time (see :func:`scd2_from_log`).
    """
    if DELETED not in observations.columns:
        return scd2_from_log(observations, keys, tracked, sequence, start, end, max_rows_per_group)
    there = ~F.coalesce(F.col(DELETED), F.lit(False))
    plain = observations.withColumns({DELETED: ~there, **{c: F.when(there, F.col(f"`{c}`")) for c in tracked}})
    states = scd2_from_log(plain, keys, [*tracked, DELETED], sequence, start, end, max_rows_per_group)
    return states.filter(~F.col(DELETED)).drop(DELETED)


def operations(feed: DataFrame, operation_column: str, delete_codes: Sequence[str]) -> DataFrame:
    """A feed's operations as observations: ``is_deleted`` in place of the operation."""
    deleting = F.upper(F.trim(F.col(operation_column))).isin([c.upper() for c in delete_codes])
    return feed.withColumn(DELETED, F.coalesce(deleting, F.lit(False))).drop(operation_column)


def scd2_from_feed(
    feed: DataFrame,
    keys: Sequence[str],
    operation_column: str,
    sequence: Sequence[str],
    tracked: Sequence[str] | None = None,
    delete_codes: Sequence[str] = ("D", "DELETE"),
    start: str = START,
    end: str = END,
    max_rows_per_group: int = 5_000_000,
) -> DataFrame:
    """The type 2 history of a whole feed of inserts, updates and deletes.

    A delete ends the open version; an insert after it opens another one, which
    leaves a gap between them. ``tracked`` is every column but keys, operation and
    sequence if not given. An operation without a sequence comes before all others.
    """
    rows = operations(feed, operation_column, delete_codes)
    tracked = list(tracked) if tracked is not None else [c for c in rows.columns if c not in {*keys, *sequence, DELETED}]
    return versions_of(rows, keys, tracked, sequence, start, end, max_rows_per_group)


def apply_late(
    history: DataFrame | None,
    observations: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    sequence: Sequence[str],
    start: str = START,
    end: str = END,
) -> tuple[DataFrame, DataFrame]:
    """(history, observations) after a batch whose rows may be older than what is known.

    A late change splits the version that covers its time, and what no longer
    differs from its neighbour is one version again. Versions of keys that the
    batch doesn't name are passed through. After the same rows, in any order and
    any batches, the history is the same.
    """
    merged = merge_observations(observations, batch, keys, sequence)
    touched = of_keys(merged, batch, keys, "left_semi")
    renewed = versions_of(touched, keys, tracked, sequence, start, end)
    if history is None:
        return renewed, merged
    return of_keys(history, batch, keys, "left_anti").unionByName(renewed, allowMissingColumns=True), merged


def scd2_from_snapshots(
    snapshots: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    taken_at: str,
    start: str = START,
    end: str = END,
    times: DataFrame | None = None,
) -> DataFrame:
    """The history of many full snapshots at once; ``taken_at`` tells them apart and is their time.

    A key that a snapshot lacks ends there, and opens again where it comes
    back. One window over each key's snapshots finds where a version begins: at
    another state, or after a snapshot without the key. A version's payload is
    that of its first row, as folding snapshot by snapshot leaves it. A key has
    one row in a snapshot at most; of several the greatest counts. ``times`` (one
    column, ``taken_at``) lists all snapshots where some may be empty.
    """
    others = [c for c in snapshots.columns if c not in (*keys, taken_at)]
    rows = last_observations(snapshots, keys, [taken_at])
    taken = (times if times is not None else snapshots).select(taken_at).distinct()
    # One row for each snapshot, so one task may number them.
    whole = Window.orderBy(taken_at)
    taken = taken.select(F.col(taken_at).alias("_at"), F.row_number().over(whole).alias("_no"), F.lead(taken_at).over(whole).alias("_next"))
    if taken.count() <= BROADCAST_SNAPSHOTS:
        taken = F.broadcast(taken)
    rows = rows.join(taken, F.col(taken_at) == F.col("_at"))
    by_key = Window.partitionBy(*keys).orderBy("_no")
    state = F.struct(*[F.col(f"`{c}`") for c in tracked])
    goes_on = F.coalesce(F.lag("_no").over(by_key) == F.col("_no") - 1, F.lit(False)) & F.lag(state).over(by_key).eqNullSafe(state)
    numbered = rows.withColumn("_new", (~goes_on).cast("int")).withColumn("_version", F.sum("_new").over(by_key))
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in others]), F.col("_no")).alias("_row") if others else F.lit(None).alias("_row")
    made = numbered.groupBy(*keys, "_version").agg(first, F.min(taken_at).alias(start), F.max_by("_next", "_no").alias(end))
    return made.select(*keys, *([f"_row.`{c}`" for c in others]), start, end)
