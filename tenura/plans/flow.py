"""The whole build, raw file to predictions, checked after every step."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tenura import specs
from tenura.operators.quality import (
    Check, Observed, fingerprint, min_rows, observations, observed_from, require, run_checks, same_rows,
)
from tenura.plans import data_tests as names
from tenura.plans import registry, scoring, training
from tenura.session import scratch_scope
from tenura.sources.readers import scan_first_available
from tenura.sources.tables import Lake

RUN_TABLE = "gold.build_log"
RUN_SCHEMA = (
    "run_id string, started_at timestamp, position int, task string, status string, seconds double, details string, "
    "inputs map<string,string>, outputs map<string,struct<n_rows:bigint,fingerprint:string>>"
)


@dataclass
class Outcome:
    """What a task says, and what the writes of its tables counted."""

    details: str
    tables: Mapping[str, Observed] = field(default_factory=dict)


class Run:
    """Task log of one build; a failing task is logged, then stops the build.

    A log row keeps the fingerprints of the tables that its task read and wrote. With
    ``resume`` a task is skipped when its settings and inputs are those of the last time it passed
    and its outputs still are what it wrote then; a fingerprint is order-free, so a
    table that was rebuilt with the same rows starts nothing.
    """

    def __init__(self, lake: Lake, resume: bool = False):
        self.lake, self.run_id, self.entries = lake, uuid.uuid4().hex, []
        self.known: dict[str, str] = {}
        self.before = self._passed() if resume and lake.exists(RUN_TABLE) else {}

    def _passed(self) -> dict[str, Row]:
        """The last row of each task that passed or was skipped: one row per task."""
        done = self.lake.read(RUN_TABLE).filter(F.col("status") != "FAIL")
        last = F.row_number().over(Window.partitionBy("task").orderBy(F.col("started_at").desc(), "run_id"))
        return {r.task: r for r in done.withColumn("_last", last).filter("_last = 1").drop("_last").collect()}

    def fingerprint(self, table: str) -> str:
        """From this build's write of the table, else from a scan of it."""
        if table not in self.known:
            self.known[table] = fingerprint(self.lake.read(table)) if self.lake.exists(table) else ""
        return self.known[table]

    def _unchanged(self, name: str, inputs: Mapping[str, str]) -> Row | None:
        old = self.before.get(name)
        if old is None or old.inputs != inputs:
            return None
        return old if all(self.fingerprint(t) == was.fingerprint for t, was in old.outputs.items()) else None

    def task(self, position: int, name: str, work: Callable[[], Outcome], reads: Sequence[str] = (), settings: str = "") -> str:
        start = datetime.now(timezone.utc)
        inputs: dict[str, str] = {}
        try:
            inputs = {table: self.fingerprint(table) for table in reads} | {"settings": settings}
            old = self._unchanged(name, inputs)
            if old is not None:
                self._log(position, name, "SKIP", start, old.details, inputs, {t: (o.n_rows, o.fingerprint) for t, o in old.outputs.items()})
                return old.details
            done = work()
        except Exception as error:
            self._log(position, name, "FAIL", start, str(error), inputs, {})
            raise
        self.known |= {table: seen.fingerprint for table, seen in done.tables.items()}
        self._log(position, name, "PASS", start, done.details, inputs, {t: (o.rows, o.fingerprint) for t, o in done.tables.items()})
        return done.details

    def _log(self, position: int, name: str, status: str, start: datetime, details: str, inputs: dict, outputs: dict) -> None:
        seconds = (datetime.now(timezone.utc) - start).total_seconds()
        self.entries.append((self.run_id, start.replace(tzinfo=None), position, name, status, seconds, details, inputs, outputs))

    def save(self) -> DataFrame:
        """Append the log to the run table and return this run's rows."""
        log = self.lake.spark.createDataFrame(self.entries, RUN_SCHEMA).coalesce(1)
        self.lake.write(log, RUN_TABLE, mode="append")
        return self.lake.read(RUN_TABLE).filter(F.col("run_id") == self.run_id)


# the declared tests of each task's tables, and the row counts that must be kept
CHECKS: dict[str, list[Check]] = {
    names.RAW: names.RAW_CHECKS,
    names.CLEAN: [*names.CLEAN_CHECKS, same_rows(names.CLEAN, names.RAW)],
    names.FEATURES: [*names.FEATURE_CHECKS, same_rows(names.FEATURES, names.RAW)],
    names.FACT: [*names.DIMENSION_CHECKS, *names.FACT_CHECKS, same_rows(names.FACT, names.RAW)],
    names.ANALYTICS: names.ANALYTICS_CHECKS,
    names.PREDICTIONS: [same_rows(names.PREDICTIONS, names.RAW)],
}


def _validated(lake: Lake, table: str, expected: int, observed: Mapping[str, Observed]) -> str:
    """Runs the declared tests of a table in one call; a failure stops the build.

    Row counts, nulls and accepted values are known from its write; keys and relationships are scanned for.
    """
    checks = [min_rows(table, expected), *CHECKS[table]]
    used = {c.table for c in checks} | {c.arg[0] for c in checks if c.test in ("relationships", "row_preservation")}
    require(run_checks({name: lake.read(name) for name in used}, checks, observed=observed))
    return f"{observed[table].rows:,} rows, {len(checks) - 1} tests"


def _load(lake: Lake, paths: Sequence[str] | DataFrame, expected: int, if_exists: str) -> Outcome:
    there = if_exists != "replace" and lake.has_rows(names.RAW, expected)
    raw = None
    if not there or if_exists == "changed":
        raw = paths if isinstance(paths, DataFrame) else scan_first_available(lake.spark, paths, specs.RAW_SCHEMA)
    if there and (if_exists == "skip" or fingerprint(raw) == fingerprint(lake.read(names.RAW))):
        stored = lake.read(names.RAW)
        metrics, decided = observations(stored, CHECKS[names.RAW])
        observed, said = observed_from(stored.agg(*metrics).first().asDict(), decided), "already loaded; "
    else:
        observed, said = lake.write_observed(raw, names.RAW, CHECKS[names.RAW]), ""
    return Outcome(said + _validated(lake, names.RAW, expected, {names.RAW: observed}), {names.RAW: observed})


def load_raw(lake: Lake, paths: Sequence[str] | DataFrame, expected: int, if_exists: str = "skip") -> str:
    """Raw table from the first readable path (or a DataFrame), unless already loaded.

    ``if_exists``: "skip" leaves a table of enough rows, "changed" replaces it when the
    source has other rows, "replace" always.
    """
    return _load(lake, paths, expected, if_exists).details


def tables_of(log: DataFrame) -> DataFrame:
    """task, table_name, n_rows, fingerprint of every table that the logged tasks wrote."""
    return log.select("task", F.explode("outputs").alias("table_name", "_wrote")).select("task", "table_name", "_wrote.n_rows", "_wrote.fingerprint")


def summary(log: DataFrame) -> DataFrame:
    """Tasks, failures, seconds and overall verdict of one run."""
    return log.agg(
        F.count(F.lit(1)).alias("tasks"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.sum("seconds").alias("seconds"),
        F.bool_and(F.col("status") != "FAIL").alias("all_passed"),
    )


def run(lake: Lake, paths: Sequence[str] | DataFrame, expected: int,
        models: Sequence[training.ModelSpec] = training.MODELS, folds: int = 0,
        if_exists: str = "skip", model_root: str = "", resume: bool = False) -> DataFrame:
    """Raw -> clean -> {features, star, analytics} -> training -> scoring.

    Features and star schema run side by side. Training hands its best run's id
    to scoring; without ``models`` the build ends before both. Every task runs the declared tests of its tables; the log is saved even
    on failure. ``expected`` is the least number of people; a raw table that holds as
    many counts as loaded. ``resume`` skips the tasks for which nothing has changed, see :class:`Run`.
    """
    log = Run(lake, resume)
    observed: dict[str, Observed] = {}

    def raw_rows() -> Observed:
        """Rows of the raw table for the tests that keep them, if this build has not loaded it."""
        rows, _ = log.fingerprint(names.RAW).split(":")
        return Observed(int(rows), log.fingerprint(names.RAW), {})

    def transform(table: str, tags: Sequence[str], rows: int = expected) -> Outcome:
        every = [c for checks in CHECKS.values() for c in checks]
        built = registry.build(lake, tags, checks=every)
        return Outcome(_validated(lake, table, rows, {names.RAW: raw_rows(), **built}), built)

    def load() -> Outcome:
        return _load(lake, paths, expected, if_exists)

    def train() -> Outcome:
        return Outcome(training.train_all(lake, lake.read(names.FEATURES), specs.KEY, models, folds=folds, model_root=model_root))

    def score() -> Outcome:
        # the run logged last by this build, by its id
        best = lake.read("gold.ml_runs").filter(F.col("run_id") == best_run_id)
        scored = scoring.batch_score(lake.read(names.FEATURES), best)
        seen = lake.write_observed(scoring.predictions(scored), names.PREDICTIONS, CHECKS[names.PREDICTIONS])
        return Outcome(_validated(lake, names.PREDICTIONS, expected, {names.RAW: raw_rows(), names.PREDICTIONS: seen}), {names.PREDICTIONS: seen})

    try:
        with scratch_scope(lake.spark):
            for layer in ("bronze", "silver", "gold"):
                lake.create_schema(layer)
            # loading decides for itself whether there is something to do
            log.before.pop("raw load", None)
            log.task(1, "raw load", load)
            log.task(2, "clean", lambda: transform(names.CLEAN, ["silver"]), [names.RAW], str(expected))
            with ThreadPoolExecutor(2) as pool:
                side_by_side = [
                    pool.submit(copy_context().run, log.task, 3, "features", lambda: transform(names.FEATURES, ["features"]), [names.CLEAN], str(expected)),
                    pool.submit(copy_context().run, log.task, 4, "star schema", lambda: transform(names.FACT, ["star_schema"]), [names.CLEAN], str(expected)),
                ]
                for done in side_by_side:
                    done.result()
            log.task(5, "analytics", lambda: transform(names.ANALYTICS, ["analytics"], rows=1), [names.CLEAN])
            if models:
                settings = repr(([(m.name, m.kind, sorted(m.params.items())) for m in models], folds))
                best_run_id = log.task(6, "training", train, [names.FEATURES], settings)
                log.task(7, "scoring", score, [names.FEATURES], best_run_id)
    finally:
        saved = log.save()
    return saved
