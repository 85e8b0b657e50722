"""Source configuration: defaults, routes and validated lookups.

Configuration is one row per source and is read to the driver only where a
table per source has to be set up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.values import json_map
from stratalake.operators.shape import normalize_identifier, normalize_record_path

# The configuration columns and their types.
CONFIG_COLUMNS = {
    "api_id": "string",
    "api_name": "string",
    "endpoint": "string",
    "http_method": "string",
    "auth_type": "string",
    "secret_scope": "string",
    "secret_key": "string",
    "auth_header_name": "string",
    "auth_header_prefix": "string",
    "headers_json": "string",
    "query_parameters": "string",
    "landing_container": "string",
    "landing_path": "string",
    "bronze_catalog": "string",
    "bronze_schema": "string",
    "bronze_table": "string",
    "record_path": "string",
    "pagination_type": "string",
    "page_size": "int",
    "cursor_field": "string",
    "cursor_parameter": "string",
    "load_type": "string",
    "incremental_column": "string",
    "incremental_parameter": "string",
    "incremental_format": "string",
    "overlap_minutes": "int",
    "initial_load_value": "string",
    "download_mode": "string",
    "schedule": "string",
    "execution_group": "string",
    "enabled": "boolean",
    "schema_version": "int",
    "created_by": "string",
    "created_ts": "timestamp",
    "updated_ts": "timestamp",
}

# What a missing or NULL setting means.
CONFIG_DEFAULTS = {
    "landing_container": "landing",
    "landing_path": "",
    "cursor_field": "next_cursor",
    "cursor_parameter": "cursor",
    "load_type": "FULL",
    "download_mode": "BUFFER",
    "schema_version": 1,
}
JSON_SETTINGS = ("headers_json", "query_parameters")


def with_defaults(config: DataFrame) -> DataFrame:
    """The full set of configuration columns with defaults filled in.

    Absent columns are added, JSON settings become string maps. ``enabled``
    defaults to true only when the column is absent.
    """
    out = []
    for name, dtype in CONFIG_COLUMNS.items():
        present = name in config.columns
        value = F.col(name).cast(dtype) if present else F.lit(None).cast(dtype)
        # Blank text counts as unset, for these settings only.
        if name in CONFIG_DEFAULTS:
            value = F.when(value.cast("string") != "", value) if dtype == "string" else value
            value = F.coalesce(value, F.lit(CONFIG_DEFAULTS[name]).cast(dtype))
        elif name == "enabled" and not present:
            value = F.lit(True)
        elif name in JSON_SETTINGS:
            value = json_map(value)
        out.append(value.alias(name))
    return config.select(*out)


def enabled_sources(config: DataFrame, schedule: str | None = None, group: str | None = None) -> DataFrame:
    """Enabled sources by name, optionally of one schedule and execution group."""
    wanted = config.filter(F.col("enabled"))
    if schedule is not None:
        wanted = wanted.filter(F.col("schedule") == schedule)
        if group:
            wanted = wanted.filter(F.col("execution_group") == group)
    return wanted.orderBy("api_name")


def single_source(config: DataFrame, predicate: Column | str, what: str):
    """The one enabled row that matches; none or several raise."""
    rows = config.filter(F.col("enabled")).filter(predicate).limit(2).collect()
    if not rows:
        raise LookupError(f"no enabled configuration for {what}")
    if len(rows) > 1:
        raise LookupError(f"several enabled configurations for {what}")
    return rows[0]


@dataclass(frozen=True)
class Route:
    """Where one source's documents are and which table they feed."""

    api_id: str
    catalog: str
    schema: str
    table: str
    record_path: str | None

    @property
    def name(self) -> str:
        return f"{self.catalog}.{self.schema}.{self.table}"


def bronze_routes(config: DataFrame) -> list[Route]:
    """Routes of all enabled sources; a bad identifier or a repeated id raises."""
    rows = (
        config.filter(F.col("enabled"))
        .select("api_id", "bronze_catalog", "bronze_schema", "bronze_table", "record_path")
        .orderBy("api_id")
        .collect()
    )
    routes = [
        Route(
            normalize_identifier(r["api_id"], "api_id"),
            normalize_identifier(r["bronze_catalog"], "bronze_catalog"),
            normalize_identifier(r["bronze_schema"], "bronze_schema"),
            normalize_identifier(r["bronze_table"], "bronze_table"),
            normalize_record_path(r["record_path"]),
        )
        for r in rows
    ]
    ids = [r.api_id for r in routes]
    repeated = sorted({i for i in ids if ids.count(i) > 1})
    if repeated:
        raise LookupError(f"several enabled configurations for {repeated}")
    return routes


def route_for(routes: list[Route], api_id: str) -> Route:
    found = [r for r in routes if r.api_id == api_id]
    if len(found) != 1:
        raise LookupError(f"expected exactly one route for {api_id!r}, found {len(found)}")
    return found[0]


@dataclass(frozen=True)
class ChangeSettings:
    """How one source's changes are applied to its table."""

    source_id: str
    cdc_mode: str
    operation_column: str | None
    sequence_column: str
    sequence_type: str
    delete_handling: str
    snapshot_key_column: str | None
    snapshot_strategy: str


def change_settings(config: DataFrame, source_id: str) -> ChangeSettings:
    """The one enabled change configuration of a source; none or several raise."""
    row = single_source(config, F.col("source_id") == source_id, f"changes of {source_id!r}")
    return ChangeSettings(**{name: row[name] for name in ChangeSettings.__dataclass_fields__})
