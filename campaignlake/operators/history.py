"""Type-2 history of the append log (snapshot "check" strategy), rebuilt or merged.

Contract
--------
* Key: (execution date, campaign, ad).  Version order: load time.
* Rows sharing (key, load time) are one sighting; the tie-break keeps the row
  with the greatest metrics (compared in log column order), so the result is
  deterministic whatever order the rows arrive in.
* A sighting starts a new version when its checked columns differ
  (null-safe) from the previous sighting of the key.  ``include_load_ts=True``
  checks the load time too, i.e. every sighting is a version.
* ``valid_from`` = the version's load time, ``valid_to`` = the next
  version's load time (NULL while open).

Plan shape (why it scales)
--------------------------
1. Rows move once, by key.  The tie-break window, which leaves one of any
   copies too, and the change (lag) and ``valid_to`` (lead) windows all run on
   that partitioning: one hash exchange and one sort for the whole history.
2. Two arguments trade more work for less imbalance, by the caller's
   knowledge of the log and never by its measured size: ``precombine=True``
   collapses exact copies, and all rows of a load, map-side first (re-appended
   batches), and
   :func:`history_from_log_split` spreads a key that is restated with very many
   distinct load times over its load days.
No Python, no collect, no cross join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import ntz_literal
from ..functions.keys import version_id
from ..session import ensure_checkpoint_dir, scratch_path
from ..schema import KEY_COLS, LOADED_AT, SORTED_METRIC_COLS, SCD_ID, VALID_FROM, VALID_TO


def _payload(df: DataFrame, keys, ts) -> list[str]:
    """Non-key, non-time columns, metrics first in log order (the tie-break order)."""
    rest = [c for c in df.columns if c not in keys and c != ts]
    metrics = [c for c in SORTED_METRIC_COLS if c in rest]
    return metrics + [c for c in rest if c not in metrics]


def latest_per_key(log: DataFrame, keys=KEY_COLS, ts: str = LOADED_AT) -> DataFrame:
    """Most recent row of each key (ties on load time: greatest metrics).

    A single aggregate with one exchange: the partial ``max(struct)`` runs
    before the shuffle, so hot keys and duplicate batches are combined
    map-side (it plans as a sort-based aggregate, a struct buffer not being
    fixed-width; it spills rather than fails on a large partition).
    """
    keys = list(keys)
    payload = _payload(log, keys, ts)
    best = F.max(F.struct(F.col(ts), *[F.col(c) for c in payload])).alias("__best")
    out = log.groupBy(*keys).agg(best)
    return out.select(*[F.col(c) if c in keys else F.col("__best")[c].alias(c) for c in log.columns])


def _checked(df: DataFrame, keys, ts, check_cols) -> list[str]:
    """Columns whose change makes a version: the log's metrics unless told otherwise.

    Partition or batch columns that a storage layout adds to the log are not
    business columns; a relation without any log metric checks all the rest.
    """
    if check_cols:
        return list(check_cols)
    payload = _payload(df, keys, ts)
    return [c for c in payload if c in SORTED_METRIC_COLS] or payload


def _version_id(keys, ts) -> Column:
    if len(keys) == 3:
        return version_id(F.col(ts), *keys).alias(SCD_ID)
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys],
                             F.col(ts).cast("string"))).alias(SCD_ID)


def _one_per_load(log: DataFrame, partition, keys, ts) -> DataFrame:
    """Rows sharing (key, load time) reduced to the first in (metrics descending) order."""
    # Sorted as the windows over the key need it; only first rows get past the sort.
    w = Window.partitionBy(*partition, ts).orderBy(
        *[F.col(c).desc() for c in _payload(log, [*keys, *partition], ts)] or [F.col(ts)])
    return log.withColumn("__nth", F.row_number().over(w)).where(F.col("__nth") == 1).drop("__nth")


def _plain_zeros(log: DataFrame) -> DataFrame:
    """Minus zero equals zero; both are given back as zero, whichever row of a load is kept."""
    return log.select(*[(F.col(c) + F.lit(0.0).cast(kind)).alias(c) if kind in ("double", "float") else F.col(c)
                        for c, kind in log.dtypes])


def _one_per_load_map_side(log: DataFrame, keys, ts) -> DataFrame:
    """The rows of :func:`_one_per_load`, by an aggregate whose partial step runs before any row moves.

    Copies and the other rows of a load meet in a task before the exchange, and one row a load leaves it: no
    group is held, only its greatest row so far.  ``max`` of a struct alone would plan as a sort aggregate, twice
    sorted; beside a collecting aggregate (of nothing: it stays empty) it plans as an object hash aggregate, which
    keeps few keys in memory, as with a log of copies, and sorts and spills when there are many.
    """
    payload = _payload(log, keys, ts)
    rows = log.groupBy(*keys, ts).agg(F.max(F.struct(*payload)).alias("__row"),
                                      F.collect_set(F.lit(None).cast("boolean")).alias("__none"))
    return rows.where(F.size("__none") == 0).select(
        *[F.col("__row")[c].alias(c) if c in payload else F.col(c) for c in log.columns])


def history_from_log(log: DataFrame, keys=KEY_COLS, ts: str = LOADED_AT,
                     check_cols=None, include_load_ts: bool = False, precombine: bool = False) -> DataFrame:
    """Full rebuild of the type-2 history from the whole log.

    Output: the log columns (values of the version's first sighting) plus
    ``valid_from``, ``valid_to`` and ``scd_id``.

    ``precombine=True`` removes exact copies in a map-side aggregate before the
    rows move, at the price of a second exchange, of one row per key and load
    time: for logs whose batches were appended several times over.
    """
    keys = list(keys)
    if precombine:
        sightings = _one_per_load_map_side(_plain_zeros(log), keys, ts)
    else:
        sightings = _one_per_load(_plain_zeros(log).repartition(*[F.col(k) for k in keys]), keys, keys, ts)
    w = Window.partitionBy(*keys).orderBy(F.col(ts))
    if include_load_ts:
        versions = sightings
    else:
        # Per-column null-safe lags are evaluated inside the Window operator on
        # columns already shuffled; a lagged struct would be materialised
        # before the exchange and double the bytes it moves.
        changed = F.row_number().over(w) == 1
        for c in _checked(log, keys, ts, check_cols):
            changed = changed | ~F.lag(F.col(c)).over(w).eqNullSafe(F.col(c))
        versions = (sightings.withColumn("__changed", changed)
                    .where(F.col("__changed")).drop("__changed"))
    return versions.select(
        *log.columns,
        F.col(ts).alias(VALID_FROM),
        F.lead(F.col(ts)).over(w).alias(VALID_TO),
        _version_id(keys, ts),
    )


def _null_safe_join(left: DataFrame, right: DataFrame, cols, how: str = "inner") -> DataFrame:
    """Join on ``cols`` treating NULL = NULL as a match (key parts may be NULL)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in cols])


def history_from_log_split(log: DataFrame, keys=KEY_COLS, ts: str = LOADED_AT, check_cols=None,
                           include_load_ts: bool = False, bucket=None,
                           scratch: list[str] | None = None) -> DataFrame:
    """Same result as :func:`history_from_log`, with each key's timeline split by load day.

    For logs where a single key is restated with very many *distinct* load
    times: every window over rows runs per (key, load day), or per (key,
    ``bucket``) for a finer split, so a hot key's work spreads over its load
    days.  Full rows move once, to have one row per load left, and are then
    stored once (eager: calling this runs that job): as a checkpoint, which goes
    when nothing refers to it, or with a list ``scratch`` as a table below the
    checkpoint folder, read by column, whose path is put on the list for the
    caller to drop.  Everything about days and their borders is
    worked out on (key, load time, digest of the checked columns); across
    days that takes one row per key and day.  The versions found are joined to
    the stored rows at the end.
    """
    keys = list(keys)
    day = bucket if bucket is not None else F.to_date(F.col(ts))
    grp = keys + ["__b"]
    kinds = dict(log.dtypes)
    # As text every type is exact (JSON would cut times to milliseconds).  Minus zero equals zero.
    state = [(F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.hex(c) if kinds[c] == "binary"
              else F.col(c)).cast("string") for c in _checked(log, keys, ts, check_cols)]
    digest = F.md5(F.to_json(F.array(*state)))
    rows = log.withColumn("__b", day).repartition(*[F.col(c) for c in grp]).dropDuplicates()
    rows = _one_per_load(rows, grp, keys, ts).withColumn("__d", digest)
    if scratch is None:
        ensure_checkpoint_dir(log.sparkSession)
        rows = rows.checkpoint()
    else:
        scratch.append(scratch_path(log.sparkSession, "history-split"))
        rows.write.parquet(scratch[-1])
        rows = log.sparkSession.read.parquet(scratch[-1])
    slim = rows.select(*grp, ts, "__d")
    within = Window.partitionBy(*grp).orderBy(F.col(ts))
    over_days = Window.partitionBy(*keys).orderBy(F.col("__b"))
    # A day's last state, handed to the key's next day.  Null load times are a day of their own, the first.
    last = slim.groupBy(*grp).agg(F.max(F.struct(F.col(ts).alias("t"), F.col("__d").alias("d")))["d"].alias("__last"))
    border = last.select(*grp, (F.row_number().over(over_days) == 1).alias("__first_day"),
                         F.lag("__last").over(over_days).alias("__before"))
    marked = slim.select("*", F.row_number().over(within).alias("__rn"), F.lag("__d").over(within).alias("__prev"))
    marked = _null_safe_join(marked, border, grp)
    changed = F.when(F.col("__rn") > 1, F.col("__prev") != F.col("__d")).otherwise(
        F.col("__first_day") | (F.col("__before") != F.col("__d")))
    versions = marked if include_load_ts else marked.where(changed)
    versions = versions.select(*grp, ts)
    # A version ends at the next one of its day, or at the first of the key's next day that has one.
    next_day = (versions.groupBy(*grp).agg(F.min(F.col(ts)).alias("__start"))
                .select(*grp, F.lead("__start").over(over_days).alias("__next_day")))
    ends = _null_safe_join(versions.withColumn("__next", F.lead(F.col(ts)).over(within)), next_day, grp)
    ends = ends.select(*grp, ts, F.coalesce("__next", "__next_day").alias(VALID_TO))
    return _null_safe_join(rows, ends, [*grp, ts]).select(
        *log.columns, F.col(ts).alias(VALID_FROM), VALID_TO, _version_id(keys, ts))


@dataclass
class MergeResult:
    history: DataFrame   # closed versions + rebuilt open versions
    late: DataFrame      # batch rows that are not known to be newer than ``merged_through`` (not merged)


def split_late(batch: DataFrame, merged_through, ts: str = LOADED_AT) -> tuple[DataFrame, DataFrame]:
    """(fresh, late): rows loaded after ``merged_through``, and all others, null load times included."""
    cutoff = ntz_literal(merged_through).cast(batch.schema[ts].dataType)
    fresh = F.coalesce(F.col(ts) > cutoff, F.lit(False))
    return batch.where(fresh), batch.where(~fresh)


def snapshot_merge(history: DataFrame, batch: DataFrame, merged_through,
                   keys=KEY_COLS, ts: str = LOADED_AT, check_cols=None,
                   include_load_ts: bool = False) -> MergeResult:
    """Incremental merge of a log batch into an existing history.

    closed(history) passes through untouched; the open versions are turned
    back into sightings and rebuilt together with the batch, so a key absent
    from the batch stays open, an unchanged key keeps its version, a changed
    key is closed and re-opened, and several versions inside one batch are all
    kept.  Rows not newer than ``merged_through`` cannot be placed without the
    unchanged sightings a history does not store; they, and rows without a load
    time, come back as ``late`` for a full rebuild instead of being merged
    wrongly.

    ``merged_through`` is the newest load time already merged.  It cannot be
    read off the history (an unchanged sighting leaves no row there), so it is
    kept beside it: see :mod:`campaignlake.plans.history_store`.  None stands
    for "nothing merged yet" and needs an empty history.
    """
    log_cols = [c for c in history.columns if c not in (VALID_FROM, VALID_TO, SCD_ID)]
    batch = batch.select(*log_cols)
    if merged_through is None:
        if not history.isEmpty():
            raise ValueError("merged_through is needed to merge into a history that has rows")
        return MergeResult(history_from_log(batch, keys, ts, check_cols, include_load_ts), batch.where("false"))
    closed = history.where(F.col(VALID_TO).isNotNull())
    open_rows = history.where(F.col(VALID_TO).isNull()).select(*log_cols)
    fresh, late = split_late(batch, merged_through, ts)
    rebuilt = history_from_log(open_rows.unionByName(fresh), keys, ts, check_cols, include_load_ts)
    return MergeResult(history=closed.unionByName(rebuilt), late=late)


def merge_or_rebuild(history: DataFrame, batch: DataFrame, full_log: DataFrame, merged_through,
                     keys=KEY_COLS, ts: str = LOADED_AT, check_cols=None,
                     include_load_ts: bool = False) -> DataFrame:
    """Merge ``batch`` incrementally; keys that have late rows are built again from ``full_log``.

    A late row (not newer than ``merged_through``) may fall between sightings
    the history no longer stores, so its key's rows are needed once more; all
    other keys are merged.  ``full_log`` holds the batch, too.  Checking for late
    rows costs one ``limit 1`` pass over the batch.
    """
    m = snapshot_merge(history, batch, merged_through, keys, ts, check_cols, include_load_ts)
    if m.late.isEmpty():
        return m.history
    keys = list(keys)
    again = m.late.select(*keys).distinct()
    rebuilt = history_from_log(_null_safe_join(full_log, again, keys, "left_semi"), keys, ts, check_cols,
                               include_load_ts)
    return _null_safe_join(m.history, again, keys, "left_anti").unionByName(rebuilt)


def current(history: DataFrame) -> DataFrame:
    """Open versions only (``valid_to IS NULL``; pushed down to a Parquet scan)."""
    return history.where(F.col(VALID_TO).isNull())


def as_of(history: DataFrame, when) -> DataFrame:
    """State of every key at time ``when``: the version valid at that instant."""
    t = ntz_literal(when)
    return history.where((F.col(VALID_FROM) <= t) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > t)))


# Versions of one key and bin that an as-of join hands over together.
BLOCK = 32


def as_of_join(probes: DataFrame, history: DataFrame, at: str, keys=KEY_COLS, columns=None,
               bin_of: Callable[[Column], Column] = F.to_date) -> DataFrame:
    """Each row of ``probes`` (keys and an instant ``at``) with the version of its key valid then.

    Adds ``columns`` of the history (default: all but the keys) as they were, null
    where no version was valid yet, the instant is null, or the key is unknown.

    Time is cut into bins (days, or what ``bin_of`` makes of a time).  A bin holds the versions that begin in it, in blocks of
    up to ``BLOCK``, and, if it has probes, the one that is valid when it begins, carried over from earlier bins; so a
    version that stays open for years meets no probe but those of its key, once each.  What crosses bins is one row
    per key, bin and block.  The history is worked out once.  The probes are read twice, for the bins they ask for and
    for the join on key and bin, where they move once, as they are, and AQE deals the probes of a hot key to many tasks.
    """
    keys = list(keys)
    columns = list(columns or [c for c in history.columns if c not in keys])
    ks = [f"__k_{c}" for c in keys]
    alike = [probes.schema[c].dataType == history.schema[c].dataType for c in keys]
    key = [F.col(c) if same else F.col(c).cast("string") for c, same in zip(keys, alike)]
    named = [e.alias(k) for e, k in zip(key, ks)]
    when = lambda c: F.col(c).cast("timestamp_ntz")
    versions = history.where(F.col(VALID_FROM).isNotNull()).select(
        *named, bin_of(when(VALID_FROM)).alias("__b"), when(VALID_FROM).alias("t"), F.struct(*columns).alias("v"))
    # A block: a version and those that follow it in its bin.
    in_bin = Window.partitionBy(*ks, "__b").orderBy("t")
    nth = F.row_number().over(in_bin) - 1
    states = F.collect_list(F.struct("t", "v")).over(in_bin.rowsBetween(0, BLOCK - 1))
    blocks = (versions.select(*ks, "__b", nth.alias("__nth"), states.alias("__states")).where(F.col("__nth") % BLOCK == 0))
    asked = probes.where(F.col(at).isNotNull()).select(*named, bin_of(when(at)).alias("__b")).distinct()
    line = blocks.unionByName(asked.select("*", F.lit(-1).alias("__nth"),
                                           F.lit(None).cast(blocks.schema["__states"].dataType).alias("__states")))
    in_order = Window.partitionBy(*ks).orderBy("__b", "__nth")
    carried = (F.last(F.element_at("__states", -1), ignorenulls=True)
               .over(in_order.rowsBetween(Window.unboundedPreceding, -1)))
    start = F.element_at("__states", 1)["t"]
    next_start = F.lead(start).over(Window.partitionBy(*ks, "__b").orderBy("__nth"))
    cells = line.select("*", carried.alias("__carried"), start.alias("__start"), next_start.alias("__next")).where(
        "__states is not null or __carried is not null").select(
        *ks, "__b", "__start", "__next", F.coalesce("__states", F.array("__carried")).alias("__states"))
    t = when(at)
    match = ((bin_of(t) == F.col("__b")) & (F.col("__start").isNull() | (F.col("__start") <= t))
             & (F.col("__next").isNull() | (t < F.col("__next"))))
    for e, k in zip(key, ks):
        match = match & e.eqNullSafe(F.col(k))
    found = F.when(F.size("__states") == 1, F.element_at("__states", 1)).otherwise(
        F.element_at(F.filter("__states", lambda x: x["t"] <= t), -1))["v"]
    return probes.join(cells, match, "left").select(*probes.columns, *(found[c].alias(c) for c in columns))
