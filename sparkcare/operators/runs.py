"""ETL run analytics (W7, W9): report parsing, job filters, box elapsed time,
batch registry and run/step summaries (S7, T1-T5, F2-F5, F7, F9, J6, X3-X13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import basename, collapse_ws, split_ws, strip_last
from ..functions.timefmt import format_elapsed, micros_ntz, parse_date_time_ntz
from .joins import range_argmax_join
from .ranking import with_sequence

# The report's positional fields and the scheduler's status word.
REPORT_FIELDS = ["job_name", "start_date", "start_time", "start_day", "end_date", "end_time", "end_day",
                 "elapsed_time", "project", "status", "type", "job_name_"]
JOB_COLUMNS = REPORT_FIELDS[:10]
FINISHED = "Finished"
HEADER_PATTERN = r"^\s*Job\s+Name\b"
MIN_TOKENS = 12
DAY_US = 86_400_000_000
DAY_S = 86_400

# Fixed value: the job that opens the box of the warehouse load.
BOX_START_JOB = "bDropCdwIndex"


def _tokens(lines: DataFrame, value_col: str) -> DataFrame:
    return lines.withColumn("_tok", split_ws(collapse_ws(F.col(value_col))))


def _body(lines: DataFrame, value_col: str, header_lines: int | None) -> DataFrame:
    """The lines behind the header: by their place in the file, or, without places, by their look."""
    if header_lines is None:
        return lines.where(~F.col(value_col).rlike(HEADER_PATTERN))
    return lines.where(F.col("line_no") > header_lines)


def parse_report(lines: DataFrame, value_col: str = "value", header_lines: int | None = None) -> DataFrame:
    """Report lines -> the 10 text fields of a run.

    With ``header_lines`` the first so many lines of each report are skipped, whatever they
    look like (``lines`` has ``line_no``, see ``sources.read_report_lines``); without, lines that
    look like a header.  Blank lines are skipped; a line whose status field is not
    ``Finished`` takes its status from field 12 without its last character
    (``(Status = Aborted)`` -> ``Aborted``).  Short lines are left out here and
    listed by ``report_rejects``.
    """
    t = _tokens(_body(lines, value_col, header_lines), value_col)
    ok = t.where(F.size("_tok") >= MIN_TOKENS)
    # get() is null past the end instead of failing: the optimizer may evaluate
    # these before the length filter once predicates are pushed down
    field = lambda i: F.get(F.col("_tok"), F.lit(i))
    status = F.when(field(9) != FINISHED, strip_last(field(11))).otherwise(field(9))
    # The fields leave through a generator: a later filter on them (status, job
    # name) cannot be pushed below it, where the optimizer would substitute the
    # tokenizing regexes into the predicate once per field reference.
    row = F.struct(*[field(i).alias(c) for i, c in enumerate(JOB_COLUMNS[:9])], status.alias("status"))
    return ok.select(F.inline(F.array(row)))


def report_rejects(lines: DataFrame, value_col: str = "value", header_lines: int | None = None) -> DataFrame:
    """Lines that are neither header nor blank but have too few fields."""
    t = _tokens(_body(lines, value_col, header_lines), value_col)
    return t.where((F.size("_tok") > 0) & (F.size("_tok") < MIN_TOKENS)).drop("_tok")


def filter_jobs(runs: DataFrame, jobs) -> DataFrame:
    """Keep the runs of the listed jobs.  A Python list becomes an ``IN`` set (over a table of
    runs it is pushed to the scan, over parsed lines it stays above the parse); a DataFrame
    of job names is a left-semi join."""
    if isinstance(jobs, DataFrame):
        names = jobs.select(F.col(jobs.columns[0]).alias("job_name")).distinct()
        return runs.join(names, "job_name", "left_semi")
    return runs.where(F.col("job_name").isin(list(jobs)))


def sequence_runs(runs: DataFrame, name: str = "record_num") -> DataFrame:
    """K5: the processing log with a surrogate record number (in run order)."""
    return with_sequence(runs, [F.col(c) for c in ["start_date", "start_time", "job_name", "end_date",
                                                  "end_time", "status", "project", "elapsed_time"]], name)


def box_elapsed(runs: DataFrame, start_job: str = BOX_START_JOB, window_days: int = 5,
                keep_unmatched: bool = False) -> DataFrame:
    """For every finished run of ``start_job``, the latest finished run of any
    other job that ended within ``(start, start + window_days]``; the box's total
    elapsed time is that end minus the start, printed like ``4 days and 3:02:01``.

    A start without such an end is dropped (or kept with nulls when
    ``keep_unmatched``).  Ties on the end instant go to the smallest job name;
    the printed fields depend only on the end instant.
    """
    fin = runs.where(F.col("status") == FINISHED).select(
        "job_name", "start_date", "start_time", "start_day", "end_date", "end_time", "end_day")
    # The report prints whole seconds, so the range join runs on epoch seconds.
    def seconds(d, t):
        return F.floor(micros_ntz(parse_date_time_ntz(d, t)) / F.lit(1_000_000)).cast("bigint")

    starts = fin.where(F.col("job_name") == start_job).select(
        "start_date", "start_time", "start_day", seconds("start_date", "start_time").alias("_s_s"))
    starts = starts.withColumn("_h_s", F.col("_s_s") + F.lit(window_days * DAY_S))
    ends = fin.where(F.col("job_name") != start_job).select(
        "job_name", "end_date", "end_time", "end_day", seconds("end_date", "end_time").alias("_e_s"))
    m = range_argmax_join(starts, ends, "_s_s", "_h_s", "_e_s", ["end_date", "end_time", "end_day"],
                          tie_cols=["job_name"],
                          how="left" if keep_unmatched else "inner")
    return m.select("start_date", "start_time", "start_day",
                    F.col("m_end_date").alias("end_date"), F.col("m_end_time").alias("end_time"),
                    F.col("m_end_day").alias("end_day"),
                    format_elapsed((F.col("m__e_s") - F.col("_s_s")) * F.lit(1_000_000)).alias("total_elapsed_time"),
                    F.lit("").alias("run_data"))


REGISTRY_TIMES = {"batch_system_id": "bigint", "insert_ts": "timestamp", "mod_ts": "timestamp",
                  "delete_ts": "timestamp"}


def register_new(registry: DataFrame, programs: DataFrame, path_col: str = "program",
                 id_col: str = "batch_run_id", name_col: str = "batch_name", now=None) -> DataFrame:
    """Add every program (by file name) not yet in the batch registry.

    Returns the whole registry: existing rows (``is_new`` false) and the new
    names with ids continuing after the largest existing id, in name order.  With ``now``
    (a timestamp) also the columns of REGISTRY_TIMES: existing rows keep theirs (null if
    the registry has none), new rows get ``now`` as insert and mod time, the rest null."""
    names = programs.select(basename(F.col(path_col)).alias(name_col)).distinct()
    new = names.join(registry.select(name_col), name_col, "left_anti")
    top = registry.agg(F.max(id_col)).first()[0] or 0   # one number
    new_rows = with_sequence(new, [F.col(name_col)], id_col, start=int(top) + 1)
    old, fresh = [], []
    if now is not None:
        for c, kind in REGISTRY_TIMES.items():
            if c in registry.columns:
                kind = registry.schema[c].dataType
            old.append((F.col(c) if c in registry.columns else F.lit(None)).cast(kind).alias(c))
            fresh.append(F.lit(now if c in ("insert_ts", "mod_ts") else None).cast(kind).alias(c))
    return (registry.select(id_col, name_col, F.lit(False).alias("is_new"), *old)
            .unionByName(new_rows.select(id_col, name_col, F.lit(True).alias("is_new"), *fresh)))


REGISTRY = "batch_run_id bigint, batch_name string, batch_system_id bigint, insert_ts {0}, mod_ts {0}, delete_ts {0}"


def sync_registry(registry: DataFrame | None, programs: DataFrame, now: Column, path_col: str = "program",
                  system_col: str | None = None) -> DataFrame:
    """The batch registry after a snapshot of the programs in use, by a keyed full outer
    comparison with a digest of the attributes.

    ``registry`` (columns of REGISTRY; None: empty) against ``programs`` (a path or name, and a
    system id if ``system_col`` is given).  Returns the registry with ``action``:

    * ``insert``: a new name; ids go on after the largest one in name order, ``insert_ts`` and
      ``mod_ts`` are ``now``;
    * ``change``: a known name with another system id; it takes that, ``mod_ts`` is ``now``;
    * ``delete``: a live name that the snapshot lacks; ``delete_ts`` and ``mod_ts`` are ``now``;
    * ``reinsert``: a deleted name that is back; ``delete_ts`` is null again, ``mod_ts`` is ``now``;
    * ``keep``: the rest, unchanged.

    A name that occurs several times in the snapshot has its smallest system id; programs
    without a name are left out.  Registry names are unique."""
    system = F.col(system_col).cast("bigint") if system_col else F.lit(None).cast("bigint")
    seen = (programs.select(basename(F.col(path_col)).alias("_name"), system.alias("_system"))
            .where(F.col("_name") != "").groupBy("_name").agg(F.min("_system").alias("_system")))
    spark = programs.sparkSession
    if registry is None:
        registry = spark.createDataFrame([], REGISTRY.format(spark.range(1).select(now.alias("t")).schema[0].dataType.simpleString()))
    registry = registry.select(*(c.split()[0] for c in REGISTRY.split(", ")))
    digest = lambda c: F.xxhash64(F.col(c).isNull(), F.col(c))
    both = registry.withColumn("_known", F.lit(True)).join(
        seen.withColumn("_seen", F.lit(True)), F.col("batch_name") == F.col("_name"), "full_outer")
    known, here, dead = F.col("_known").isNotNull(), F.col("_seen").isNotNull(), F.col("delete_ts").isNotNull()
    action = (F.when(~known, "insert").when(here & dead, "reinsert")
              .when(here & (digest("batch_system_id") != digest("_system")), "change")
              .when(~here & ~dead, "delete").otherwise("keep"))
    both = both.withColumn("action", action)
    moved = F.col("action") != "keep"
    old = both.where("_known").select(
        "batch_run_id", "batch_name",
        F.when(here, F.col("_system")).otherwise(F.col("batch_system_id")).alias("batch_system_id"), "insert_ts",
        F.when(moved, now).otherwise(F.col("mod_ts")).alias("mod_ts"),
        F.when(F.col("action") == "delete", now).when(here, F.lit(None)).otherwise(F.col("delete_ts")).alias("delete_ts"), "action")
    top = registry.agg(F.max("batch_run_id")).first()[0] or 0   # one number
    new = with_sequence(both.where("_known is null").select("_name", "_system"), ["_name"], "batch_run_id", start=int(top) + 1)
    kind = registry.schema["insert_ts"].dataType
    return old.unionByName(new.select(
        "batch_run_id", F.col("_name").alias("batch_name"), F.col("_system").alias("batch_system_id"),
        now.cast(kind).alias("insert_ts"), now.cast(kind).alias("mod_ts"), F.lit(None).cast(kind).alias("delete_ts"),
        F.lit("insert").alias("action")))


def run_summary(step_events: DataFrame, run_col: str = "run_id", step_col: str = "step",
                ts_col: str = "ts", status_col: str = "status", event_col: str | None = None,
                stop_status: str = "FS") -> DataFrame:
    """T5: records of batch runs and steps -> one row per (run, step): first and last time,
    duration (microseconds), event count and the status of the latest event.  One hash
    aggregate (partial aggregation map-side).

    With ``event_col`` (``start`` or ``stop``) the finish is the latest stop, and null as
    long as none follows the latest start; so is the duration.  A stop at the same instant
    as the start follows it; a stop without a status has ``stop_status``.  A run's own
    records have a null step.  Without ``event_col`` the records have no kind, and the last
    one counts as the finish.  Equal times are decided by kind, then by status."""
    ts, status = F.col(ts_col), F.col(status_col)
    if event_col is None:
        started, finished = F.min(ts), F.max(ts)
        latest = F.max_by(status, F.struct(ts, status))
    else:
        is_start, is_stop = F.col(event_col) == "start", F.col(event_col) == "stop"
        status = F.when(is_stop, F.coalesce(status, F.lit(stop_status))).otherwise(status)
        last_start, last_stop = F.max(F.when(is_start, ts)), F.max(F.when(is_stop, ts))
        started = F.min(F.when(is_start, ts))
        finished = F.when(last_start.isNull() | (last_stop >= last_start), last_stop)
        latest = F.max_by(status, F.struct(ts, F.coalesce(is_stop, F.lit(False)), status))
    g = step_events.groupBy(run_col, step_col).agg(
        started.alias("started_ts"), finished.alias("finished_ts"),
        F.count(F.lit(1)).alias("n_events"), latest.alias("last_status"))
    return g.withColumn("duration_us", F.timestamp_diff("MICROSECOND", F.col("started_ts"), F.col("finished_ts")))
