"""Data-quality checks between layers.

Every check returns a DataFrame of ``(check_name, model_name, column_name,
failures)`` rows, so several checks union into one result and a gate can
stop a chain when any count is above zero.  Each check is one aggregation
pass (partial aggregates per task) or one anti join; nothing is collected
except the final handful of counts a gate reads.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLS = ("check_name", "model_name", "column_name", "failures")


def _result(df: DataFrame, check: str, model: str, column: str, failures) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.lit(model).alias("model_name"),
                     F.lit(column).alias("column_name"),
                     F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"))


def not_null(df: DataFrame, columns: Iterable[str], model: str = "") -> DataFrame:
    """Rows with a NULL, per column, all columns in one aggregation pass."""
    cols = list(columns)
    agg = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"__n{i}")
                   for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', coalesce(`__n{i}`, 0L)" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, failures)").select(
        F.lit("not_null").alias("check_name"), F.lit(model).alias("model_name"),
        "column_name", F.col("failures").cast("bigint").alias("failures"))


def expression_is_true(df: DataFrame, column: str, expression: str, model: str = "") -> DataFrame:
    """Rows where ``<column> <expression>`` is false (NULL results pass)."""
    cond = F.expr(f"`{column}` {expression}")
    return _result(df.agg(F.sum(F.when(~cond, 1).otherwise(0)).alias("f")),
                   f"expression_is_true {expression}", model, column, F.col("f"))


def unique(df: DataFrame, columns: Iterable[str] | str, model: str = "") -> DataFrame:
    """Number of key values occurring more than once.

    A single column ignores NULLs (as a unique test does); a combination
    counts every combination.  groupBy-count is a partial + final aggregate.
    """
    cols = [columns] if isinstance(columns, str) else list(columns)
    src = df.where(F.col(cols[0]).isNotNull()) if len(cols) == 1 else df
    dup = src.groupBy(*cols).count().where(F.col("count") > 1)
    return _result(dup.agg(F.count(F.lit(1)).alias("f")), "unique", model, "|".join(cols), F.col("f"))


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str, model: str = "") -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row.

    The child side is first reduced to (key, row count) by a partial
    aggregate, so a hot key (one campaign holding a third of all rows) is
    combined in every task before the shuffle; the anti join then sees each
    distinct key once, and the orphan count is the sum of their row counts.
    """
    keys = parent.select(F.col(pk).alias("__pk")).distinct()
    per_key = (child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("__pk"))
               .agg(F.count(F.lit(1)).alias("__n")))
    orphans = per_key.join(keys, "__pk", "left_anti")
    return _result(orphans.agg(F.sum("__n").alias("f")), "relationships", model, fk, F.col("f"))


def relationships_of(child: DataFrame, links: list[tuple[str, DataFrame, str]], model: str = "") -> DataFrame:
    """:func:`relationships` for several foreign keys at once, from one pass over ``child``.

    ``links``: (foreign key, parent, its key).  The child is reduced to its
    distinct key combinations with their row counts before anything is joined.
    """
    fks = [fk for fk, _, _ in links]
    keys = child.groupBy(*fks).agg(F.count(F.lit(1)).alias("__n"))
    for i, (fk, parent, pk) in enumerate(links):
        known = parent.select(F.col(pk).alias(f"__pk{i}")).distinct()
        keys = keys.join(known, F.col(fk) == F.col(f"__pk{i}"), "left")
    sums = keys.agg(*[F.sum(F.when(F.col(fk).isNotNull() & F.col(f"__pk{i}").isNull(), F.col("__n"))
                            .otherwise(0)).alias(f"__f{i}") for i, fk in enumerate(fks)])
    stack = ", ".join(f"'{fk}', coalesce(`__f{i}`, 0L)" for i, fk in enumerate(fks))
    return sums.selectExpr(f"stack({len(fks)}, {stack}) AS (column_name, failures)").select(
        F.lit("relationships").alias("check_name"), F.lit(model).alias("model_name"),
        "column_name", F.col("failures").cast("bigint").alias("failures"))


def freshness(df: DataFrame, ts_col: str, now, warn_after_hours: float = 24.0,
              error_after_hours: float = 48.0, model: str = "") -> DataFrame:
    """Age of the newest load time against ``now``: status pass / warn / error.

    ``now`` is a parameter (not the wall clock) so reruns are reproducible.
    """
    n = F.lit(str(now)).cast("timestamp_ntz")
    newest = df.agg(F.max(F.col(ts_col)).cast("timestamp_ntz").alias("max_loaded_at"))
    age = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), n).cast("double") / F.lit(3_600_000_000.0)
    status = (F.when(F.col("max_loaded_at").isNull() | (age > error_after_hours), F.lit("error"))
              .when(age > warn_after_hours, F.lit("warn")).otherwise(F.lit("pass")))
    return newest.select(
        F.lit("freshness").alias("check_name"), F.lit(model).alias("model_name"),
        F.lit(ts_col).alias("column_name"), "max_loaded_at",
        age.alias("age_hours"), status.alias("status"),
        F.when(status == "error", 1).otherwise(0).cast("bigint").alias("failures"))


class CheckFailed(RuntimeError):
    """Raised by :func:`gate` when a layer's checks report failures."""


def gate(stage: str, checks: Iterable[DataFrame]) -> DataFrame:
    """Run a layer's checks (one small job) and raise if any has failures.

    Returns the check results.  Only the aggregated result rows (a handful
    per check) reach the driver.
    """
    results = None
    for c in checks:
        c = c.select(*RESULT_COLS)
        results = c if results is None else results.unionByName(c)
    if results is None:
        return None
    rows = results.collect()
    bad = [r for r in rows if r["failures"] > 0]
    if bad:
        detail = ", ".join(f"{r['check_name']}({r['model_name']}.{r['column_name']})={r['failures']}"
                           for r in bad)
        raise CheckFailed(f"stage {stage!r} failed: {detail}")
    return results
