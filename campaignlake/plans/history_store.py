"""The type-2 history in storage, merged forward load by load and month by month.

A key includes its execution date, so the history of a month follows from the
log rows of that month alone.  Versions are stored by execution month (see
:mod:`.month_tables`)::

    versions/data/execution_month=<m>/merge=<n>/open=0/   versions that merge n closed; never written again
    versions/data/execution_month=<m>/merge=<n>/open=1/   the month's open versions after merge n
    changes/data/execution_month=<m>/merge=<n>/           rows that stopped (sign -1) or began (+1) to be open
    state/merge=<n>/                                      what counts, written last

:func:`update` looks up which months have rows loaded after ``merged_through``
and reads and writes those months only: their open versions and their fresh rows
become their versions after the merge.  A log row that arrives with an older or
no load time cannot be placed among sightings that the history does not store;
it shows as a month whose row count differs from the recorded one, and that month
is built again from the log's rows of the month.  A history that was built with
other options (keys, checked columns, load time checked or not) is built again as a
whole.  A merge that died before its state was written is repeated under the same
number.  Keys without the execution date make one "month" of the whole log.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_bucket, ntz_literal
from ..operators.history import history_from_log, history_from_log_split
from ..schema import DATE_COL, KEY_COLS, LOADED_AT, SCD_ID, VALID_FROM, VALID_TO
from ..session import drop_path, path_exists
from . import month_tables
from .month_tables import MERGE, MONTH, MonthTable, in_months, month_name

PLANS = ("default", "split")
OPEN, CLOSED = "open=1", "open=0"
Parts = dict[str, list[int]]


@dataclass(frozen=True)
class State:
    merge: int
    base: int                            # the merge that the whole history was last built in
    merged_through: _dt.datetime | None  # newest load time merged
    options: str
    rows: dict[str, int] = field(default_factory=dict)  # log rows by month
    open: Parts = field(default_factory=dict)           # by month: the merge that holds its open versions
    closed: Parts = field(default_factory=dict)         # by month: the merges that closed versions
    changes: Parts = field(default_factory=dict)        # by month: the merges since ``base`` that changed it
    void: list[str] = field(default_factory=list)       # folders that only readers of the merge before may still use


@dataclass(frozen=True)
class Update:
    state: State
    kind: str  # "rebuilt", "merged" or "current" (nothing new)
    merged_months: tuple[str, ...] = ()
    rebuilt_months: tuple[str, ...] = ()


@dataclass(frozen=True)
class Pending:
    """What the next update has to do."""
    before: State | None
    options: str
    rows: dict[str, int]                 # log rows by month
    newest: _dt.datetime | None
    whole: bool                          # all is built from the log
    merged: list[str]                    # months with fresh rows only
    late: list[str]                      # months built from the log's rows

    @property
    def months(self) -> list[str]:
        return [*self.merged, *self.late]


def _tables(spark: SparkSession, path: str) -> tuple[MonthTable, MonthTable]:
    return MonthTable(spark, f"{path}/versions"), MonthTable(spark, f"{path}/changes")


def read_state(spark: SparkSession, path: str) -> State | None:
    """The last complete merge, or None before the first."""
    found = month_tables.read_state(spark, path)
    if found is None:
        return None
    merge, body = found
    through = body.pop("merged_through")
    return State(merge=merge, merged_through=through and _dt.datetime.fromisoformat(through), **body)


def _write_state(spark: SparkSession, path: str, state: State) -> None:
    body = asdict(state)
    del body["merge"]
    body["merged_through"] = state.merged_through and state.merged_through.isoformat(sep=" ")
    month_tables.write_state(spark, path, state.merge, body)


def open_versions(spark: SparkSession, path: str, state: State, months: list[str] | None = None,
                  with_month: bool = False) -> DataFrame | None:
    """The open versions, read from their own folders; of some months only if told which."""
    v = _tables(spark, path)[0].read(state.open, months, inner=OPEN)
    return v if v is None or with_month else v.drop(MONTH)


def read_history(spark: SparkSession, path: str, state: State) -> DataFrame | None:
    """All versions."""
    versions, _ = _tables(spark, path)
    is_open, closed = versions.read(state.open, inner=OPEN), versions.read(state.closed, inner=CLOSED)
    if is_open is None:
        return None
    return (is_open if closed is None else is_open.unionByName(closed)).drop(MONTH)


def read_changes(spark: SparkSession, path: str, state: State, since: int) -> DataFrame | None:
    """Log rows that stopped (``sign`` -1) or began (+1) to be the open version of their key in the
    merges after ``since``, with ``execution_month`` and ``merge``; None if there are none."""
    if since < state.base:
        raise ValueError(f"the history was built anew in merge {state.base}; there are no changes since merge {since}")
    parts = {m: [n for n in ns if n > since] for m, ns in state.changes.items()}
    return _tables(spark, path)[1].read({m: ns for m, ns in parts.items() if ns}, keep_merge=True)


def _by_month(log: DataFrame, keys) -> DataFrame:
    if DATE_COL not in keys:
        return log.withColumn(MONTH, F.lit(None).cast("date"))
    if MONTH in log.columns:
        return log.withColumn(MONTH, F.col(MONTH).cast("date"))
    return log.withColumn(MONTH, month_bucket(DATE_COL))


def fresh_rows(log: DataFrame, state: State, ts: str = LOADED_AT) -> DataFrame:
    return log.where(F.col(ts) > ntz_literal(state.merged_through).cast(log.schema[ts].dataType))


def merged_versions(spark: SparkSession, log: DataFrame, path: str, state: State, months: list[str],
                    ts: str = LOADED_AT, **options) -> DataFrame:
    """What the months' open versions become with the log rows loaded since the last merge."""
    fresh = in_months(fresh_rows(log, state, ts), months, _date(options)).drop(MONTH)
    before = open_versions(spark, path, state, months)
    if before is not None:
        fresh = before.drop(VALID_FROM, VALID_TO, SCD_ID).unionByName(fresh)
    return history_from_log(fresh, ts=ts, **options)


def _date(options) -> str:
    """The column that months are ranges of; without dates in the key all rows have the month null."""
    return DATE_COL if DATE_COL in options.get("keys", KEY_COLS) else MONTH


def _options(ts: str, options: dict) -> str:
    said = {"keys": list(options.get("keys", KEY_COLS)), "ts": ts,
            "check_cols": list(options["check_cols"]) if options.get("check_cols") else None,
            "include_load_ts": bool(options.get("include_load_ts"))}
    return json.dumps(said, sort_keys=True)


def _signed_changes(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """Rows of only one side, -1 and +1; a row of both cancels."""
    sides = [df.drop(VALID_FROM, VALID_TO, SCD_ID).withColumn("sign", F.lit(sign).cast("long"))
             for df, sign in ((before, -1), (after, 1)) if df is not None]
    both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    rest = [c for c in both.columns if c != "sign"]
    return both.groupBy(*rest).agg(F.sum("sign").alias("sign")).where("sign <> 0")


def pending(spark: SparkSession, log: DataFrame, path: str, *, ts: str = LOADED_AT, **options) -> Pending:
    """Which months an update would touch: row counts, and the rows loaded since the last merge.

    With month folders in the log (an ``execution_month`` column) rows are counted from the files' footers
    and other months are not read.
    """
    log = _by_month(log, options.get("keys", KEY_COLS))
    state, said = read_state(spark, path.rstrip("/")), _options(ts, options)
    rows = {month_name(m): n for m, n in log.groupBy(MONTH).count().collect()}  # a row a month
    if state is None or state.options != said or state.merged_through is None:
        return Pending(state, said, rows, log.agg(F.max(ts)).first()[0], True, [], sorted(rows))
    fresh = fresh_rows(log, state, ts).groupBy(MONTH).agg(F.count("*"), F.max(ts)).collect()
    newer = {month_name(m): n for m, n, _ in fresh}
    late = sorted(m for m in rows.keys() | state.rows.keys()
                  if rows.get(m, 0) - newer.get(m, 0) != state.rows.get(m, 0))
    return Pending(state, said, rows, max([state.merged_through, *(t for _, _, t in fresh)]), False,
                   sorted(newer.keys() - set(late)), late)


def log_rows(log: DataFrame, months: list[str], keys=KEY_COLS) -> DataFrame:
    """The log's rows of some months, with ``execution_month``."""
    return in_months(_by_month(log, keys), months, DATE_COL if DATE_COL in keys else MONTH)


def months_since(state: State, merge: int) -> list[str]:
    """Months that merges after ``merge`` have written."""
    return sorted({m for parts in (state.open, state.closed) for m, ns in parts.items()
                   if any(n > merge for n in ns)})


def update(spark: SparkSession, log: DataFrame, path: str, *, history_plan: str = "default",
           ts: str = LOADED_AT, todo: Pending | None = None, **options) -> Update:
    """Bring the stored history up to the log; see the module's text.

    ``history_plan`` says how months are built from the log: ``default`` or ``split`` (keys restated very many
    times).  ``todo`` is what :func:`pending` said of the same log, options and path, if that has been asked before.
    """
    if history_plan not in PLANS:
        raise ValueError(f"unknown history_plan {history_plan!r}, expected one of {PLANS}")
    path = path.rstrip("/")
    todo = todo or pending(spark, log, path, ts=ts, **options)
    log = _by_month(log, options.get("keys", KEY_COLS))
    said, rows, newest, whole, merged, late = (todo.options, todo.rows, todo.newest, todo.whole, todo.merged, todo.late)
    state = todo.before or State(-1, 0, None, said)
    if not whole and not todo.months:
        return Update(state, "current")

    number, touched, scratch = state.merge + 1, [*merged, *late], []
    build = history_from_log if history_plan == "default" else (
        lambda df, **o: history_from_log_split(df, scratch=scratch, **o))
    some = [merged_versions(spark, log, path, state, merged, ts, **options)] if merged else []
    if late or not merged:
        src = log if whole else in_months(log, late, _date(options))
        some.append(build(src.drop(MONTH), ts=ts, **options))
    versions = some[0] if len(some) == 1 else some[0].unionByName(some[1])
    kept, changed = _tables(spark, path)
    month = _by_month(versions, options.get("keys", KEY_COLS)).withColumn("open", F.col(VALID_TO).isNull().cast("int"))
    kept.write(month, number, touched, inner=("open",))
    for folder in scratch:
        drop_path(spark, folder)

    has = lambda m, part: path_exists(spark, f"{kept.folder(m, number)}/{part}")
    now_open = {m: [number] for m in touched if has(m, OPEN)}
    now_closed = {m: [*([] if m in late else state.closed.get(m, [])), *([number] if has(m, CLOSED) else [])]
                  for m in touched}
    stay = (lambda parts: {}) if whole else (lambda parts: {m: ns for m, ns in parts.items() if m not in touched})
    gone = [(m, ns, OPEN) for m, ns in state.open.items() if whole or m in touched]
    gone += [(m, ns, CLOSED) for m, ns in state.closed.items() if whole or m in late]
    after = State(
        number, number if whole else state.base, newest, said, rows,
        {**stay(state.open), **now_open}, {**stay(state.closed), **now_closed}, {} if whole else dict(state.changes),
        [f"{kept.folder(m, n)}/{part}" for m, ns, part in gone for n in ns])
    if not whole:
        signed = _signed_changes(kept.read(state.open, touched, inner=OPEN), kept.read(after.open, touched, inner=OPEN))
        for m in changed.write(signed, number, touched):
            after.changes[m] = [*after.changes.get(m, []), number]
    _write_state(spark, path, after)
    for folder in state.void:  # nobody reads the merge before the last any more
        drop_path(spark, folder)
    return Update(after, "rebuilt" if whole else "merged", tuple(merged), tuple(late))


__all__ = ["MERGE", "MONTH", "Pending", "State", "Update", "log_rows", "months_since", "open_versions", "pending",
           "read_changes", "read_history", "read_state", "update"]
