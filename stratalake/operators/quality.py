"""Data-quality rules: report, gate, in-plan assertion and quarantine.

A rule is a name and a SQL predicate. A predicate that evaluates to NULL fails.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Rule names appear in reports.
FACT_ORDER_RULES = {
    "valid_order_id": "order_id IS NOT NULL",
    "valid_line_number": "line_number IS NOT NULL",
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_product_id": "product_id IS NOT NULL",
    "valid_quantity": "quantity IS NOT NULL AND quantity > 0",
}


class ExpectationFailed(ValueError):
    """Rows broke a rule; ``failures`` maps rule name to row count."""

    def __init__(self, failures: Mapping[str, int]):
        self.failures = dict(failures)
        super().__init__(f"expectations failed: {self.failures}")


def _broken(predicate: str) -> Column:
    return ~F.coalesce(F.expr(predicate), F.lit(False))


def _counters(rules: Mapping[str, str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total")] + [
        F.count_if(_broken(p)).alias(f"r{i}") for i, p in enumerate(rules.values())
    ]


def quality_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: rule, failed, total, passed. One pass over the data."""
    counted = df.agg(*_counters(rules))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"r{i}").alias("failed"),
                F.col("total").alias("total"),
                (F.col(f"r{i}") == 0).alias("passed"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return counted.select(F.inline(rows))


def expect_or_fail(df: DataFrame, rules: Mapping[str, str]) -> None:
    """Raise :class:`ExpectationFailed` when any row breaks any rule."""
    counted = df.agg(*_counters(rules)).first()
    raise_failures({name: counted[f"r{i}"] for i, name in enumerate(rules)})


def raise_failures(failed: Mapping[str, int]) -> None:
    broken = {name: n for name, n in failed.items() if n}
    if broken:
        raise ExpectationFailed(broken)


def observe_rules(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """Count rule failures while ``df`` is being written, at no extra pass."""
    observation = Observation()
    return df.observe(observation, *_counters(rules)), observation


def observed_failures(observation: Observation, rules: Mapping[str, str]) -> dict[str, int]:
    seen = observation.get
    return {name: seen[f"r{i}"] for i, name in enumerate(rules)}


def assert_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """``df`` whose evaluation raises at the first row that breaks a rule."""
    checked = df
    for name, predicate in rules.items():
        # assert_true gives NULL when it holds, so the filter keeps every row
        # and cannot be optimised away.
        checked = checked.filter(F.assert_true(~_broken(predicate), F.lit(f"expectation failed: {name}")).isNull())
    return checked


def quarantine(df: DataFrame, rules: Mapping[str, str], column: str = "failed_rules") -> DataFrame:
    """``df`` plus the names of the rules each row breaks; empty for good rows."""
    names = F.array(*[F.when(_broken(p), F.lit(name)) for name, p in rules.items()])
    return df.withColumn(column, F.array_compact(names))
