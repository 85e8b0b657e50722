"""Gold models kept up to date by what changed, not by reading everything again.

A model's state holds, beside its columns, how many rows stand behind each group
and each sum, so that rows can be taken back. Sums and counts move by the
difference of what left and what came. Minima, maxima and distinct counts can't be
taken back, so they are computed again, from the rows of the touched groups only.
Groups that nothing touches are passed through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import packed, unpacked
from stratalake.operators.observations import of_keys
from stratalake.plans import gold
from stratalake.session import materialize

_ROWS, _SIGN = "_rows", "_sign"


@dataclass(frozen=True)
class Model:
    """An aggregate by ``keys``. ``sums``: summed columns, and ``again``: expressions that can't be taken back, both by the name of the result."""

    keys: tuple[str, ...]
    sums: Mapping[str, str]
    again: Mapping[str, Column]


def signed(left: DataFrame | None, came: DataFrame) -> DataFrame:
    """What left and what came, told apart by a sign."""
    plus = came.withColumn(_SIGN, F.lit(1))
    return plus if left is None else left.withColumn(_SIGN, F.lit(-1)).unionByName(plus, allowMissingColumns=True)


def maintain(state: DataFrame | None, delta: DataFrame, base: DataFrame, model: Model) -> DataFrame:
    """The state after ``delta`` (rows with a sign). ``base``: all rows as they are now, read for touched groups and for ``again`` only.

    A group without rows is gone. A sum over NULLs only is NULL, also after its last value was taken back.
    Text keys travel packed, as they go along with every row.
    """
    texts = [k for k in model.keys if delta.schema[k].dataType == T.StringType()]
    pack = lambda df: df.withColumns({k: packed(k) for k in texts})
    delta, base, state = pack(delta), pack(base), None if state is None else pack(state)
    unpack = lambda df: df.withColumns({k: unpacked(k) for k in texts})
    sign = F.col(_SIGN)
    moved = [F.sum(sign * F.col(c)).alias(f"_d_{n}") for n, c in model.sums.items()]
    counted = [F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"_dn_{n}") for n, c in model.sums.items()]
    diff = materialize(delta.groupBy(*model.keys).agg(F.sum(sign).alias(f"_d{_ROWS}"), *moved, *counted), "model-delta")
    made = _joined(diff, None if state is None else of_keys(state, diff, model.keys, "left_semi"), model.keys)

    def old(name: str) -> Column:
        return F.lit(None) if state is None else F.col(f"_old_{name}")

    columns = [F.col(k) for k in model.keys] + [(F.coalesce(old(_ROWS), F.lit(0)) + F.col(f"_d{_ROWS}")).alias(_ROWS)]
    for n in model.sums:
        values = F.coalesce(old(f"_n_{n}"), F.lit(0)) + F.col(f"_dn_{n}")
        columns.append(F.when(values > 0, F.coalesce(old(n), F.lit(0)) + F.coalesce(F.col(f"_d_{n}"), F.lit(0))).alias(n))
        columns.append(values.alias(f"_n_{n}"))
    updated = made.select(*columns).filter(F.col(_ROWS) > 0)
    if model.again:
        # Without a state all rows came, so every group is touched.
        rows = base if state is None else of_keys(base, diff, model.keys, "left_semi")
        fresh = rows.groupBy(*model.keys).agg(*[e.alias(n) for n, e in model.again.items()])
        updated = _joined(updated, fresh, model.keys, "").select(*updated.columns, *model.again)
    if state is None:
        return unpack(updated)
    rest = of_keys(state, diff, model.keys, "left_anti")
    return unpack(rest.unionByName(updated.select(*[F.col(f.name).cast(f.dataType) for f in state.schema.fields])))


def _joined(rows: DataFrame, more: DataFrame | None, keys: Sequence[str], prefix: str = "_old_") -> DataFrame:
    """``rows`` with the other columns of ``more``, one row per key at most; NULL keys meet."""
    if more is None:
        return rows
    named = more.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"{prefix}{c}") for c in more.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(named, same, "left").drop(*[f"_k_{k}" for k in keys])


def _customer_sales() -> Model:
    return Model(("customer_sk", "customer_id"), {"sales_amount": "order_total", "units_sold": "units_sold"}, {})


def _product_sales() -> Model:
    again = {"order_count": F.count_distinct("order_id"), "first_order_date": F.min("order_date"), "last_order_date": F.max("order_date")}
    return Model(("product_sk", "product_id"), {"units_sold": "quantity"}, again)


def customer_state(state: DataFrame | None, lines_before: DataFrame | None, lines_after: DataFrame) -> DataFrame:
    """State of customer sales after orders changed from ``lines_before`` to ``lines_after``: all lines of the touched orders."""
    before = None if lines_before is None else gold.order_kpis(lines_before)
    after = gold.order_kpis(lines_after)
    return maintain(state, signed(before, after), after, _customer_sales())


def product_state(state: DataFrame | None, lines_before: DataFrame | None, lines_after: DataFrame, fact: DataFrame) -> DataFrame:
    """State of product sales likewise. ``fact``: all lines as they are now."""
    return maintain(state, signed(lines_before, lines_after), fact, _product_sales())


def customer_sales(state: DataFrame, customers: DataFrame) -> DataFrame:
    """The model that :func:`gold.customer_sales` gives."""
    named = state.withColumnRenamed(_ROWS, "order_count")
    joined = gold._with_attributes(named, customers, "customer_sk", "customer_id", "customer_name")
    return gold.with_processed_time(
        joined.select("customer_sk", "customer_id", "customer_name", "order_count", "sales_amount", "units_sold")
    )


def product_sales(state: DataFrame, products: DataFrame) -> DataFrame:
    """The model that :func:`gold.product_sales` gives."""
    title = F.col("title").alias("product_title")
    joined = gold._with_attributes(state, products, "product_sk", "product_id", title, "category")
    columns = ("order_count", "units_sold", "first_order_date", "last_order_date")
    return gold.with_processed_time(joined.select("product_sk", "product_id", "product_title", "category", *columns))
