"""Run audit and run summaries."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import or_na
from stratalake.operators.latest import latest_records
from stratalake.sources.sinks import append_rows

# The columns of the audit table.
AUDIT_COLUMNS = {
    "run_id": "STRING NOT NULL",
    "job_run_id": "STRING",
    "api_name": "STRING NOT NULL",
    "job_name": "STRING NOT NULL",
    "start_time": "TIMESTAMP NOT NULL",
    "end_time": "TIMESTAMP NOT NULL",
    "status": "STRING NOT NULL",
    "records_read": "BIGINT",
    "records_written": "BIGINT",
    "pages_read": "BIGINT",
    "schema_version": "INT",
    "duration_seconds": "DOUBLE NOT NULL",
    "landing_file": "STRING",
    "landing_file_size_bytes": "BIGINT",
    "failure_stage": "STRING",
    "failure_type": "STRING",
    "http_status": "INT",
    "retry_count": "INT",
    "total_attempts": "INT",
    "error_message": "STRING",
}
AUDIT_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in AUDIT_COLUMNS.items())

# The summary text, line by line; a column name fills its line.
SUMMARY_SUBJECT = "API Ingestion Run Summary"
SUMMARY_LINES = (
    ("Job: ", "job_name"),
    ("Run ID: ", "job_run_id"),
    ("Overall Status: ", "overall_status"),
    ("", None),
    ("Ingestion", None),
    ("---------", None),
    ("API records read: ", "records_read"),
    ("Pages read: ", "pages_read"),
    ("Landing file: ", "landing_file"),
    ("Landing file size (bytes): ", "landing_file_size_bytes"),
    ("Ingestion status: ", "ingestion_status"),
    ("", None),
    ("Pipeline", None),
    ("--------", None),
    ("Bronze: ", "bronze_status"),
    ("Silver: ", "silver_status"),
    ("Gold: ", "gold_status"),
    ("", None),
    ("Data Quality", None),
    ("-----------", None),
    ("DQ status: ", "dq_status"),
    ("", None),
    ("Reconciliation", None),
    ("--------------", None),
    ("Status: ", "reconciliation_status"),
    ("", None),
    ("Failure Diagnostics", None),
    ("--------------------", None),
    ("Failure stage: ", "failure_stage"),
    ("Failure type: ", "failure_type"),
    ("Retry count: ", "retry_count"),
    ("Total attempts: ", "total_attempts"),
    ("Error message: ", "error_message"),
)


@contextlib.contextmanager
def audited(
    spark: SparkSession, path: str, api_name: str, job_name: str, job_run_id: str | None = None
) -> Iterator[dict]:
    """Append one audit row for the enclosed step, also when it fails.

    The step fills the yielded dict with metrics (``records_read``, ...) and
    keeps ``stage`` current, which names the place of a failure. The error is
    raised again; should its audit row fail to be written, that is noted on it.
    """
    row: dict = {"run_id": uuid.uuid4().hex, "stage": None, "schema_version": 1}
    start = datetime.now(timezone.utc)
    status, failure = "SUCCESS", None
    try:
        yield row
    except BaseException as error:
        status, failure = "FAILED", error
        row.update(
            failure_stage=row.get("stage"), failure_type=type(error).__name__, error_message=str(error)
        )
        raise
    finally:
        end = datetime.now(timezone.utc)
        row.update(
            job_run_id=job_run_id,
            api_name=api_name,
            job_name=job_name,
            start_time=start,
            end_time=end,
            status=status,
            duration_seconds=(end - start).total_seconds(),
        )
        try:
            append_rows(spark, [tuple(row.get(c) for c in AUDIT_COLUMNS)], AUDIT_SCHEMA, path)
        except Exception as unwritten:
            if failure is None:
                raise
            failure.add_note(f"its audit row was not written: {unwritten}")


def run_summary(audit: DataFrame, stages: DataFrame) -> DataFrame:
    """Subject and text body per run.

    ``audit`` has the audit columns, of which the newest row per run counts.
    ``stages`` has one row per run: job_run_id, overall_status and the status
    of ingestion, bronze, silver, gold, dq and reconciliation. Missing numbers
    and diagnostics read ``N/A``.
    """
    runs = latest_records(audit, ["job_run_id"], ["end_time", "run_id"])
    joined = stages.join(runs, "job_run_id", "left")
    lines = [
        F.concat(F.lit(label), or_na(column)) if column else F.lit(label) for label, column in SUMMARY_LINES
    ]
    subject = F.concat_ws(" - ", F.lit(SUMMARY_SUBJECT), or_na("overall_status"), or_na("job_run_id"))
    return joined.select("job_run_id", subject.alias("subject"), F.concat_ws("\n", *lines).alias("body"))
