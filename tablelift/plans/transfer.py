"""Transfers: every table of a plan from its source over staged files into its target."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.util import inheritable_thread_target

from tablelift.formats import FlatFormat
from tablelift.functions.text import map_strings, null_marker, strip_control_all
from tablelift.functions.typemap import ColumnSpec, align_schema, relaxed_schema, relaxed_specs, spark_schema
from tablelift.operators.chunk import DEFAULT_CHUNK_ROWS
from tablelift.operators.load_order import levels, load_order
from tablelift.operators.reconcile import difference_summary, reconcile_rows
from tablelift.operators.status import COUNTS, append_status
from tablelift.plans.checked import write_checked
from tablelift.plans.endpoints import Source, Target, VersionedTarget
from tablelift.plans.journal import COMMITTED, EXPORTED, FINISHED, LOADING, STARTED, Journal
from tablelift.session import new_staging_dir, remove_staged
from tablelift.sinks.delimited import save_mode, staging_path, write_delimited
from tablelift.sinks.replace import Pending, Version, accepted_rows, rejected_records
from tablelift.sources.delimited import path_exists, scan_delimited

JOB_SCHEMA = (
    "database_name string, schema_name string, table_name string, status string, "
    "input_count bigint, flatfile_count bigint, output_count bigint, "
    "run_at timestamp_ntz, duration double, error string"
)


@dataclass(frozen=True)
class TransferPlan:
    """What to move, and how.

    ``tables``: names to take, all of the source when empty; ``exclude`` is taken off.
    ``specs``: declared columns of a table; without them the source's own types are loaded.
    ``staged``: go through delimited files, counted on the way.  ``False`` loads the source straight
    into the target: half the work, and nothing is rendered as text; then ``flatfile_count`` is NULL.
    ``staging``: root of the staged files; by default a new folder in the shared location, which is
    removed when the run is over.
    ``if_exists``: ``replace``, ``skip`` (a SKIPPED job) or ``error`` (a FAILED job).
    ``chunk_rows``: staged files have this many rows at most.
    ``on_error``: ``relax`` reads files that do not fit the declared encoding in the one that their bytes show, and loads
    columns with uncastable texts as text instead of failing.  Both are decided by a pass over the data beforehand.
    ``verify``: ``counts``, or ``rows`` to compare every row by ``keys`` as well.
    ``checked``: files are loaded with every rule of ``specs`` checked in the one pass that writes them; good rows go to
    the target, other records to :func:`rejects_of`, and a job with rejects is a WARNING.  More than
    ``max_rejects`` fail the table before it is replaced.  ``extra_fields``: ``reject`` or ``truncate`` records
    with more fields than columns.
    ``foreign_keys``: pairs (table, table it refers to).  Parents are loaded before their children, and
    ``parallel_tables`` are those of one level; tables that refer to each other in a circle share a level.
    ``replace_unproven``: what ``replace`` does with a load whose counts or rows differ from the source.  By default
    the load is dropped and the table keeps its old rows (if it had any); ``True`` replaces it all the same.
    ``journal``: where a run writes what it has done, for :func:`run_transfer` with ``resume``.
    ``status_path``: where counts are kept between runs; a table whose staged files were written from
    the same rows in the same format is not exported again (set ``staging`` as well).
    """

    source: Source
    target: Target
    database: str = "source"
    schema: str = "dbo"
    tables: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    specs: Mapping[str, Sequence[ColumnSpec]] = field(default_factory=dict)
    type_overrides: Mapping[str, str] = field(default_factory=dict)
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    staged: bool = True
    staging: str | None = None
    fmt: FlatFormat = FlatFormat()
    if_exists: str = "replace"
    chunk_rows: int = DEFAULT_CHUNK_ROWS
    on_error: str = "fail"
    verify: str = "counts"
    checked: bool = False
    max_rejects: int | None = None
    extra_fields: str = "reject"
    replace_unproven: bool = False
    journal: str | None = None
    status_path: str | None = None
    parallel_tables: int = 1
    foreign_keys: tuple[tuple[str, str], ...] = ()

    def table_names(self, spark: SparkSession) -> list[str]:
        names = list(self.tables) or self.source.tables(spark)
        return [n for n in names if n not in self.exclude]

    def about(self) -> str:
        """What a run has to have in common with the one that it resumes."""
        parts = (
            self.target, self.database, self.schema, self.tables, self.exclude, self.staged, self.staging, self.fmt, self.if_exists,
            sorted((t, tuple(s)) for t, s in self.specs.items()), sorted(self.type_overrides.items()),
        )
        return hashlib.sha256(repr(parts).encode()).hexdigest()


def transfer_table(spark: SparkSession, plan: TransferPlan, table: str, journal: Journal | None = None) -> dict:
    """Move one table; the outcome is a job row, whatever happens."""
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    job = _job(plan, table, started)
    try:
        if journal:
            journal.note(table, STARTED)
        job["status"], job["error"] = _move(spark, plan, table, job, journal)
    except Exception as error:  # one table's failure must not stop the others
        job["status"], job["error"] = "FAILED", str(error)
    job["duration"] = (datetime.now(timezone.utc).replace(tzinfo=None) - started).total_seconds()
    if journal:
        journal.note(table, FINISHED, **job | {"run_at": started.isoformat()})
    return job


def _job(plan: TransferPlan, table: str, started: datetime) -> dict:
    return {
        "database_name": plan.database, "schema_name": plan.schema, "table_name": table, "status": "RUNNING",
        "input_count": 0, "flatfile_count": 0 if plan.staged else None, "output_count": 0, "run_at": started, "duration": 0.0, "error": None,
    }


def _counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """``df``, and its number of rows once it has been written: no pass of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: seen.get["rows"]


class _InPlace(Pending):
    """A load straight into the table, for targets that cannot load beside it."""

    def __init__(self, spark: SparkSession, plan: TransferPlan, table: str):
        self.spark, self.plan, self.table, self.place = spark, plan, table, None

    def write(self, df: DataFrame) -> None:
        self.plan.target.write(df, self.table, self.plan.if_exists)

    def read(self) -> DataFrame:
        return self.plan.target.read(self.spark, self.table)

    def commit(self) -> None:
        pass

    def abort(self) -> None:
        pass


def _move(spark: SparkSession, plan: TransferPlan, table: str, job: dict, journal: Journal | None) -> tuple[str, str | None]:
    if journal and (before := journal.found(table, COMMITTED)):  # the run ended after the table was in place
        job.update(before["counts"])
        return before["status"], before["error"]
    there = plan.target.exists(spark, table)
    if plan.if_exists != "replace" and there:  # before anything is exported
        job["input_count"] = plan.source.count(spark, table)
        return ("SKIPPED" if plan.if_exists == "skip" else "FAILED"), "Table already exists"
    if plan.checked:
        return _move_checked(spark, plan, table, job, journal, there)
    relax = plan.on_error == "relax"
    source = strip_control_all((plan.source.relaxed() if relax else plan.source).read(spark, table))
    if plan.staged:
        loaded, rows = _counted(_staged(spark, plan, table, source, job, journal))
        count = "flatfile_count"
    else:
        counted, rows = _counted(source)
        specs = plan.specs.get(table)
        if specs and relax:
            specs = relaxed_specs(source, specs, plan.type_overrides)
        loaded = align_schema(counted, specs, plan.type_overrides) if specs else counted
        count = "input_count"
    load = plan.target.stage(spark, table) or _InPlace(spark, plan, table)
    if journal:
        journal.note(table, LOADING, place=load.place)
    try:
        load.write(loaded)
        job[count] = rows()
        in_place = isinstance(load, _InPlace)
        job["output_count"] = plan.target.count(spark, table) if in_place else load.read().count()
        problem = _difference(plan, table, source, load, job)
        if problem and there and not in_place and not plan.replace_unproven:
            problem += "; the table keeps its old rows"
            load.abort()
        else:
            load.commit()
    except Exception:
        load.abort()
        raise
    status = "WARNING" if problem else "SUCCESS"
    if journal:
        journal.note(table, COMMITTED, status=status, error=problem, counts={c: job[c] for c in COUNTS})
    if not problem:
        plan.target.analyze(spark, table)
    return status, problem


def _checked_place(plan: TransferPlan, table: str) -> str:
    return f"{plan.staging}/checked/{plan.database}/{plan.schema}/{table}"


def rejects_of(spark: SparkSession, plan: TransferPlan, table: str) -> DataFrame:
    """(record, reason, bad_columns) of a table's last checked load; needs a versioned target or a named ``staging``."""
    if isinstance(plan.target, VersionedTarget):
        return plan.target.versions(table).rejects(spark)
    return rejected_records(spark, _checked_place(plan, table))


def _move_checked(
    spark: SparkSession, plan: TransferPlan, table: str, job: dict, journal: Journal | None, there: bool
) -> tuple[str, str | None]:
    """Files to rows and rejects in one pass; a versioned target takes what it wrote as it is."""
    path, fmt = plan.source.files(table)
    load = plan.target.stage(spark, table) or _InPlace(spark, plan, table)
    own = isinstance(load, Version)
    place = load.place if own else _checked_place(plan, table)
    if journal:
        journal.note(table, LOADING, place=load.place)
    try:
        if not own:
            remove_staged(spark, place)
        checks = write_checked(spark, path, plan.specs[table], place, fmt, plan.extra_fields)
        job["input_count"], job["flatfile_count"] = checks.records, checks.accepted
        if plan.max_rejects is not None and checks.rejected > plan.max_rejects:
            load.abort()
            return "FAILED", f"{checks.message()}; at most {plan.max_rejects} may be"
        if not own:
            load.write(accepted_rows(spark, place))
        job["output_count"] = load.read().count()
        problem = None if checks.accepted == job["output_count"] else f"Row count mismatch: {checks.accepted} vs {job['output_count']}"
        if problem and there and not plan.replace_unproven:
            load.abort()
            return "WARNING", f"{problem}; the table keeps its old rows"
        load.commit()
    except Exception:
        load.abort()
        raise
    problem = problem or checks.message()
    status = "WARNING" if problem else "SUCCESS"
    if journal:
        journal.note(table, COMMITTED, status=status, error=problem, counts={c: job[c] for c in COUNTS})
    return status, problem


def _difference(plan: TransferPlan, table: str, source: DataFrame, load: Pending, job: dict) -> str | None:
    """What a load lacks compared with its source, or None."""
    if job["input_count"] != job["output_count"]:
        return f"Row count mismatch: {job['input_count']} vs {job['output_count']}"
    if plan.verify == "rows":
        keys = list(plan.keys.get(table, source.columns))
        # An empty text that the files do not tell from NULL is loaded as NULL by design.
        expected = map_strings(source, null_marker) if plan.staged and plan.fmt.collapse_empty else source
        found = difference_summary(reconcile_rows(expected, load.read(), keys)).first()
        if any(found):
            return f"Rows differ: missing {found.missing}, extra {found.extra}, changed {found.changed}"
    return None


def _digest(source: DataFrame) -> list[Column]:
    """Number of rows and a sum over all of them, as aggregates."""
    columns = [
        F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)) else F.col(f"`{f.name}`")
        for f in source.schema.fields
    ]
    total = F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(20,0)")), F.lit(0))
    return [F.count(F.lit(1)).alias("rows"), total.cast("string").alias("total")]


def _fingerprint(plan: TransferPlan, source: DataFrame, rows: int, total: str) -> str:
    """What staged files depend on: the format, the columns and a digest of all rows."""
    made_by = repr((plan.fmt, plan.chunk_rows, [(f.name, f.dataType.simpleString()) for f in source.schema.fields]))
    return f"{hashlib.sha256(made_by.encode()).hexdigest()}:{rows}:{total}"


def _read_mark(spark: SparkSession, path: str) -> str | None:
    return spark.read.text(path).first().value if path_exists(spark, path) else None


def _write_mark(spark: SparkSession, path: str, mark: str) -> None:
    spark.createDataFrame([(mark,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _staged(
    spark: SparkSession, plan: TransferPlan, table: str, source: DataFrame, job: dict, journal: Journal | None
) -> DataFrame:
    """Export to the staged files, unless they are still right, and read them back typed."""
    staged = staging_path(plan.staging, plan.database, plan.schema, table)
    mark_path = f"{staged}.fingerprint"
    there = path_exists(spark, staged)
    before = journal and journal.found(table, EXPORTED)
    if before and there:  # by the same run, before it ended
        job["input_count"] = before["input_count"]
    else:
        old = _read_mark(spark, mark_path) if plan.status_path and there else None
        if old:
            found = source.agg(*_digest(source)).first()
            job["input_count"] = found.rows
        if not old or old != _fingerprint(plan, source, *found):
            if plan.status_path:
                _write_mark(spark, mark_path, "being written")
            # What is exported is summed on the way, so the digest is that of the staged rows.
            seen = Observation()
            write_delimited(source.observe(seen, *_digest(source)), staged, plan.fmt, "replace", max_rows_per_file=plan.chunk_rows)
            job["input_count"] = seen.get["rows"]
            if plan.status_path:
                _write_mark(spark, mark_path, _fingerprint(plan, source, seen.get["rows"], seen.get["total"]))
        if journal:
            journal.note(table, EXPORTED, input_count=job["input_count"])
    schema = spark_schema(plan.specs[table], plan.type_overrides) if table in plan.specs else source.schema
    if plan.on_error == "relax":
        text_schema = T.StructType([T.StructField(n, T.StringType()) for n in source.columns])
        schema = relaxed_schema(scan_delimited(spark, staged, plan.fmt, text_schema), schema)
    return scan_delimited(spark, staged, plan.fmt, schema)


def run_transfer(spark: SparkSession, plan: TransferPlan, resume: bool = False) -> DataFrame:
    """Move all tables of the plan and return one row per table (``JOB_SCHEMA``).

    With a ``journal`` every step is written down before and after it.  ``resume`` goes on with the last run if
    it has not come to its end: tables that are done keep their job rows, files that it staged are loaded without
    another export (if ``staging`` is named), what an unfinished load left is removed, and the rest is moved.

    Tables are independent: one that fails is a FAILED row, and so is one that the source does not
    have, before anything is read.  A plan that selects nothing is an error.  Only job rows pass the driver.
    """
    save_mode(plan.if_exists)
    if resume and not plan.journal:
        raise ValueError("a run without a journal cannot be resumed")
    if plan.checked and not hasattr(plan.source, "files"):
        raise ValueError("only files can be checked while they are loaded")
    if plan.on_error not in ("fail", "relax"):
        raise ValueError("on_error is 'fail' or 'relax'")
    if plan.on_error == "relax" and plan.checked:
        raise ValueError("a checked load rejects records and relaxes nothing")
    own_staging, about = None, plan.about()
    if plan.staging is None:
        own_staging = new_staging_dir(spark, "staged")
        plan = replace(plan, staging=own_staging)
    names = plan.table_names(spark)
    if not names:
        raise ValueError("the plan selects no table")
    known = {n for n in names if not plan.tables or plan.source.has(spark, n)}
    missing = _job(plan, "", datetime.now(timezone.utc).replace(tzinfo=None)) | {"status": "FAILED", "error": "Table is not in the source"}

    journal = Journal.open(spark, plan.journal, names, about, resume) if plan.journal else None

    def one(table: str) -> dict:
        if journal and (done := journal.finished(table)):
            return done
        if journal and (left := journal.found(table, LOADING)) and left["place"]:
            plan.target.discard(spark, left["place"])
        return transfer_table(spark, plan, table, journal) if table in known else missing | {"table_name": table}

    order = [names]
    if plan.foreign_keys:
        listed = spark.createDataFrame([(n,) for n in names], "table_name string")
        order = levels(load_order(listed, spark.createDataFrame(list(plan.foreign_keys), "table_name string, ref_table string")))
    jobs = []
    for together in order:
        if plan.parallel_tables > 1:
            with ThreadPoolExecutor(plan.parallel_tables) as pool:
                jobs += pool.map(inheritable_thread_target(spark)(one), together)
        else:
            jobs += [one(name) for name in together]
    columns = [c.split()[0] for c in JOB_SCHEMA.split(", ")]
    result = spark.createDataFrame([tuple(job[c] for c in columns) for job in jobs], JOB_SCHEMA)
    if plan.status_path:
        append_status(result, plan.status_path)
    if journal:
        journal.close()
    if own_staging:  # the targets are loaded, nothing reads it any more
        remove_staged(spark, own_staging)
    return result


def run_batch(spark: SparkSession, plans: Iterable[TransferPlan]) -> DataFrame:
    """Several plans, for instance one per database, as one table of jobs."""
    result = None
    for plan in plans:
        jobs = run_transfer(spark, plan)
        result = jobs if result is None else result.unionByName(jobs)
    return spark.createDataFrame([], JOB_SCHEMA) if result is None else result
