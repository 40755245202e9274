"""Executions of stages as rows of the ``pipeline_runs`` control table, whether they succeed or fail."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable

from pyspark.sql import SparkSession

from quillspark.operators import control
from quillspark.sources import writers

Run = tuple[str | None, str]
_log = logging.getLogger(__name__)


class Stage:
    """One execution of a stage over some runs, as a context.

    ``expect`` names the runs that it works on and ``done`` gives each one's counts.  On
    leaving, each run is a row: with its counts, or with the class, code and
    summary of the error for those that were expected and not done; a stage that
    fails before it knows its runs leaves one row without a run.  The error goes on.
    Every attempt adds its rows, so a retry shows beside what it repeats.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, code_version: str | None = None, inputs: Iterable[str] = (), outputs: Iterable[str] = ()) -> None:
        self.spark, self.root, self.name = spark, root, name
        self.facts = {"stage": name, "code_version": code_version, "input_paths": list(inputs), "output_paths": list(outputs)}
        self.expected: set[Run] = set()
        self.rows: dict[Run, dict] = {}

    def __enter__(self) -> Stage:
        self.start = dt.datetime.now(dt.UTC)
        return self

    def expect(self, runs: Iterable[Run]) -> None:
        self.expected |= set(runs)

    def done(self, run: Run, **facts) -> None:
        self.rows[run] = facts

    def times(self) -> dict:
        """Start, end and duration so far."""
        end = dt.datetime.now(dt.UTC)
        return {"start_ts": self.start, "end_ts": end, "duration_ms": int((end - self.start).total_seconds() * 1000)}

    def _row(self, run: Run, status: str, facts: dict) -> dict:
        name, day = run
        keys = [f"{k}={v}" for k, v in (("ingest_date", day), ("run_id", name)) if v is not None]
        return self.facts | self.times() | {"run_id": name, "status": status, "partition_keys": keys} | facts

    def __exit__(self, kind, error, trace) -> bool:
        rows = [self._row(run, "SUCCEEDED", facts) for run, facts in sorted(self.rows.items(), key=str)]
        try:
            if error is not None:
                left = sorted(self.expected - self.rows.keys(), key=str) or ([] if self.rows else [(None, None)])
                rows += [self._row(run, "FAILED", self._told(error)) for run in left]
            writers.append_ops(self.spark, self.root, "pipeline_runs", rows)
        except Exception:
            # the stage's own outcome counts for more than the account of it
            _log.warning("no rows of stage %s in pipeline_runs", self.name, exc_info=True)
        return False

    def _told(self, error: BaseException) -> dict:
        first = (str(error).strip().splitlines() or [""])[0]
        failure = self.spark.createDataFrame([(first[:2000], type(error).__name__)], "message string, code string")
        return control.error_rows(failure).select("error_category", "error_code", "error_summary").first().asDict()
