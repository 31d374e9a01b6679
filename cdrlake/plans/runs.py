"""Audit rows around plans, also around those that fail."""

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ..config import RunResult
from ..operators import control
from ..sinks.tables import append_merge

#: characters of an error's text that the audit keeps
ERROR_CHARS = 4_000


log = logging.getLogger(__name__)


def report(pipeline: str, result: RunResult, debug: bool) -> None:
    """One line for a run; with ``debug`` also each of its figures."""
    log.info("%s %s: %d rows read, %d written", pipeline, result.status, sum(result.rows_read.values()), sum(result.rows_written.values()))
    if debug:
        for kind in ("rows_read", "rows_written", "quality", "detail"):
            for name, figure in getattr(result, kind).items():
                log.info("%s %s %s: %s", pipeline, kind, name, figure)


def now() -> datetime:
    return datetime.now(timezone.utc)


@contextmanager
def audited(
    spark: SparkSession,
    audit_path: str | None,
    pipeline: str,
    watermarks: "control.ControlTable | None" = None,
    debug: bool = False,
) -> Iterator[RunResult]:
    """A run whose result the plan fills in; its audit row is appended when it ends.

    A plan that fails gets the row FAILED with the counts so far and the error's text, its
    watermark stays, and the error goes on to the caller.
    """
    result, started, run_id = RunResult(), now(), uuid.uuid4().hex

    def record(error: str | None) -> None:
        report(pipeline, result, debug)
        if audit_path:
            read, written = sum(result.rows_read.values()), sum(result.rows_written.values())
            row = control.audit_row(spark, pipeline, run_id, result.status, read, written, started, now(), error)
            append_merge(row, audit_path)

    try:
        yield result
    except Exception as e:
        result.status = "FAILED"
        record(f"{type(e).__name__}: {e}"[:ERROR_CHARS])
        if watermarks is not None:
            watermarks.move(pipeline, None, "FAILED", None)
        raise
    record(None)
