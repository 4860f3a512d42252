"""Ingest-clean: nested source records -> typed append-log rows.

One row-local projection (no shuffle, no Python UDF): rename fields, default
the ad, unnest the lifeday metrics into wide columns, turn money into exact
integer cents, coerce numbers, null out infinities, clip negatives, cast to
whole numbers, fill remaining nulls with 0 and stamp the batch load time.

Rows whose date does not parse are not cleaned; :func:`rejects` returns them.
"""

from __future__ import annotations

import datetime as _dt
import functools

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import ntz_literal
from ..functions.money import cents_of_cut, cut_amount
from ..schema import (AD_COL, CAMPAIGN_COL, CORRUPT_COL, DATE_COL, DEFAULT_AD, INT_METRIC_COLS,
                      LIFEDAYS, LOADED_AT, LOG_COLS, METRIC_COLS, RATE_COLS, lifeday_cols)
from ..session import compiled_code, ensure_checkpoint_dir

MONEY_COLS = ("cpc_cents",) + tuple(f"revenue_{ld}d_cents" for ld in LIFEDAYS)
# Column cast policy: up to so many chunks (a row of some twenty flags each) are broadcast.
MAX_BROADCAST_CHUNKS = 100_000
JAVA_LITERAL = r"[xX]|[0-9.][dDfF][\x00-\x20]*$"
COST_UNITS = ("cents", "currency")
FLAGS = ("non_numeric", "non_finite", "negative", "cast_failed")


def _flag(kind: str, col: str) -> str:
    return f"__{kind}__{col}"


def _lifeday(metrics: Column, ld: int) -> Column:
    """Element of ``metrics`` whose lifeday text equals ``ld``; the last one wins.

    ``array_position`` over the reversed lifeday field finds the last match;
    unlike a ``filter`` lambda (evaluated interpreted, outside whole-stage
    codegen) every function here is compiled.
    """
    pos = F.array_position(F.reverse(metrics["lifeday"]), F.lit(str(ld)))
    return F.when(pos > 0, F.element_at(metrics, (-pos).cast("int")))


def _raw_sources(records: DataFrame) -> dict[str, Column]:
    """Raw (still textual) source value of each metric column.

    Expects the lifeday elements already extracted as ``__m<ld>`` columns.
    """
    src: dict[str, Column] = {
        # A missing, null or empty cost counts as 0.
        "spend_cents": F.when(F.col("cost").isNull() | (F.trim(F.col("cost")) == ""), F.lit("0"))
                        .otherwise(F.col("cost")),
        "impressions": F.col("impressions"),
        "clicks": F.col("clicks"),
        "registrations": F.col("registrations"),
        "ctr": F.col("ctr"),
        "cr": F.col("cr"),
        "cpc_cents": F.col("cpc"),
    }
    for ld in LIFEDAYS:
        m = F.col(f"__m{ld}")
        players, payers, payments, revenue = lifeday_cols(ld)
        src[players] = m["players"]
        src[payers] = m["payers"]
        src[payments] = m["payments"]
        src[revenue] = m["revenue"]
    return src


def _number_text(raw: Column) -> Column:
    """Text of a numeric leaf read as STRING.

    The JSON reader hands a number token over as its text, except that the
    non-finite ones (``NaN``, ``Infinity``, an overflowing ``1e400``) come
    back re-serialised with quotes; strip them so they parse as doubles.
    """
    s = raw.cast("string")
    return F.when(s.startswith('"') & s.endswith('"'), F.btrim(s, F.lit('"'))).otherwise(s)


def _as_number(text: Column) -> Column:
    """A number's text as DOUBLE; the type suffixes and hexadecimal forms that Java's parser would take are no numbers."""
    # Few texts hold one of these letters at all; only those are matched against the pattern.
    suspect = functools.reduce(Column.__or__, (text.contains(x) for x in "xXdDfF"))
    return F.when(~(suspect & text.rlike(JAVA_LITERAL)), text.try_cast("double"))


def _money_cols(cost_unit: str) -> tuple[str, ...]:
    """Columns whose source value is an amount in currency units."""
    if cost_unit not in COST_UNITS:
        raise ValueError(f"unknown cost_unit {cost_unit!r}, expected one of {COST_UNITS}")
    return MONEY_COLS if cost_unit == "cents" else ("spend_cents", *MONEY_COLS)


def _coerce(col: str, rounding: str, money: tuple[str, ...]) -> dict[str, Column]:
    """Value (before fill) and data-quality flags of one metric column.

    Reads ``__s_<col>`` (text), ``__d_<col>`` (its double) and for money
    ``__p_<col>`` (the amount cut), computed once in an earlier projection.  Each value is one flat CASE whose branches are
    tested in order (not finite -> NULL, negative -> 0, then the type rule),
    which keeps the generated code small: nesting the derived predicates
    inside each other re-expands the same subtrees many times over.
    """
    s = F.col(f"__s_{col}")
    d = F.col(f"__d_{col}")
    not_finite = d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    bigint_null = F.lit(None).cast("bigint")
    if col in money:
        cents = cents_of_cut(F.col(f"__p_{col}"), rounding)
        val = F.when(not_finite, bigint_null).when(d < 0, F.lit(0).cast("bigint")).otherwise(cents)
        cast_failed = F.when(not_finite, F.lit(False)).otherwise(cents.isNull())
    elif col in RATE_COLS:
        val = F.when(not_finite, F.lit(None).cast("double")).when(d < 0, F.lit(0.0)).otherwise(d)
        cast_failed = F.lit(False)
    else:
        whole = F.coalesce(s.try_cast("bigint"), d.try_cast("bigint"))
        val = (F.when(not_finite, bigint_null).when(d < 0, F.lit(0).cast("bigint"))
               .when(d != F.floor(d), bigint_null).otherwise(whole))
        cast_failed = (F.when(not_finite | (d < 0), F.lit(False)).when(d != F.floor(d), F.lit(True))
                       .otherwise(whole.isNull()))
    return {
        col: val,
        _flag("non_numeric", col): s.isNotNull() & d.isNull(),
        _flag("non_finite", col): F.coalesce(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(False)),
        _flag("negative", col): F.coalesce((d < 0) & (F.abs(d) != F.lit(float("inf"))), F.lit(False)),
        _flag("cast_failed", col): cast_failed,
    }


def parsed_date(records: DataFrame) -> Column:
    """Execution date parsed from the record's ``date`` text (NULL if it does not parse)."""
    return F.col("date").cast("string").try_cast("date")


def well_formed(records: DataFrame) -> Column:
    """False for the rows of a document that the JSON reader could not parse."""
    return F.col(CORRUPT_COL).isNull() if CORRUPT_COL in records.columns else F.lit(True)


def coerce(records: DataFrame, rounding: str = "truncate", cost_unit: str = "cents") -> DataFrame:
    """Typed columns plus ``__<flag>__<col>`` quality flags, before null filling.

    Rows with an unparseable date are kept here (date NULL) so that counters
    see every row; :func:`clean` drops them and :func:`rejects` returns them.
    """
    compiled_code(records.sparkSession)
    extra, money = [c for c in records.columns if c.startswith("__")], _money_cols(cost_unit)
    # Three projections, so that each lifeday lookup (a lambda over the array)
    # and each text->double parse is evaluated once per row, not once per use.
    base = ["date", "campaign", "ad", "cost", "impressions", "clicks", "registrations",
            "ctr", "cr", "cpc"]
    step1 = records.select(*base, *extra, *[_lifeday(F.col("metrics"), ld).alias(f"__m{ld}")
                                            for ld in LIFEDAYS])
    src = _raw_sources(step1)
    step2 = step1.select("date", "campaign", "ad", *extra,
                         *[_number_text(src[c]).alias(f"__s_{c}") for c in METRIC_COLS])
    step3 = step2.select("*", *[_as_number(F.col(f"__s_{c}")).alias(f"__d_{c}") for c in METRIC_COLS],
                         *[cut_amount(F.col(f"__s_{c}"), rounding).alias(f"__p_{c}") for c in money])
    out: dict[str, Column] = {
        DATE_COL: parsed_date(step3),
        CAMPAIGN_COL: F.col("campaign").cast("string"),
        AD_COL: F.coalesce(F.col("ad").cast("string"), F.lit(DEFAULT_AD)),
    }
    for c in METRIC_COLS:
        out.update(_coerce(c, rounding, money))
    return step3.select(*[e.alias(n) for n, e in out.items()], *extra)


def clean(records: DataFrame, *, loaded_at: _dt.datetime | None = None,
          rounding: str = "truncate", cast_failure: str = "row",
          chunk_col: str | None = None, fill_numeric: int | None = 0, cost_unit: str = "cents",
          observation: Observation | None = None, strict: bool = False) -> DataFrame:
    """Clean nested records into append-log rows (27 columns, log order).

    ``cast_failure="row"`` nulls (then zero-fills) only the offending value of
    a whole-number column that holds a fraction; ``"column"`` reproduces the
    source pipeline, where one fractional value voids that column for every
    row of its load chunk (``chunk_col``; the whole input when None).  For that
    the records are parsed once, when this is called, and the values stored with
    their chunk and a bit per failed cast; the chunks' bits are added up from
    there, counted, and broadcast if there are few chunks.

    ``cost_unit`` says what the source's cost counts: ``"cents"``, passed through as a whole number, or
    ``"currency"`` units, turned into cents like the other amounts.

    ``observation`` collects the quality counters in the same pass as whatever
    action consumes the result.  ``strict=True`` raises if any row is rejected.
    """
    if cast_failure not in ("row", "column"):
        raise ValueError(f"unknown cast_failure {cast_failure!r}")
    if strict and not rejects(records).isEmpty():
        raise ValueError("records with an unparseable date were found (see rejects())")
    ts = loaded_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)

    # A record is cleaned or rejected, never both: rejects() has the complement.
    recs = records.where(well_formed(records))
    if chunk_col is not None:
        recs = recs.withColumn("__chunk", F.col(chunk_col))
    elif cast_failure == "column":
        recs = recs.withColumn("__chunk", F.lit(0))
    df = coerce(recs, rounding, cost_unit).where(F.col(DATE_COL).isNotNull())

    if observation is not None:
        df = df.observe(observation, *[
            F.sum(F.col(_flag(k, c)).cast("long")).alias(f"{k}__{c}")
            for c in METRIC_COLS for k in FLAGS])

    if cast_failure == "column":
        ensure_checkpoint_dir(records.sparkSession)
        bit = {c: 1 << i for i, c in enumerate(INT_METRIC_COLS)}
        failed = functools.reduce(Column.bitwiseOR, (
            F.when(F.col(_flag("cast_failed", c)), F.lit(b)).otherwise(F.lit(0)).cast("long") for c, b in bit.items()))
        values = (DATE_COL, CAMPAIGN_COL, AD_COL) + METRIC_COLS
        df = df.select(*values, "__chunk", failed.alias("__failed")).checkpoint()
        bad = df.where("__failed <> 0").groupBy("__chunk").agg(F.bit_or("__failed").alias("__bad")).checkpoint()
        few = bad.count() <= MAX_BROADCAST_CHUNKS
        bad = bad.withColumnRenamed("__chunk", "__bad_chunk")
        df = df.join(F.broadcast(bad) if few else bad, F.col("__chunk").eqNullSafe(F.col("__bad_chunk")), "left")
        df = df.select(*[F.when(F.col("__bad").bitwiseAND(F.lit(bit[c]).cast("long")) != 0, F.lit(None).cast("bigint"))
                         .otherwise(F.col(c)).alias(c) if c in bit else F.col(c) for c in values])

    def final(c: str) -> Column:
        if c == LOADED_AT:
            return ntz_literal(ts).alias(c)
        if c in METRIC_COLS and fill_numeric is not None:
            zero = F.lit(float(fill_numeric)) if c in RATE_COLS else F.lit(fill_numeric).cast("bigint")
            return F.coalesce(F.col(c), zero).alias(c)
        return F.col(c)

    return df.select(*[final(c) for c in LOG_COLS])


def rejects(records: DataFrame) -> DataFrame:
    """Records that cannot be loaded, with a reason: missing/unparseable date or malformed JSON."""
    d = parsed_date(records)
    reason = (F.when(F.col("date").isNull(), F.lit("missing_date"))
              .when(d.isNull(), F.lit("bad_date")))
    reason = F.when(~well_formed(records), F.lit("malformed")).otherwise(reason)
    return records.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())


def quality_counts(records: DataFrame, rounding: str = "truncate", cost_unit: str = "cents") -> DataFrame:
    """Per metric column: rows with non-numeric, non-finite, negative and uncastable values.

    A single aggregation pass (partial aggregation per task, one tiny final
    stage), then an unpivot of the one result row into one row per column.
    """
    df = coerce(records, rounding, cost_unit)
    sums = df.agg(*[F.sum(F.col(_flag(k, c)).cast("long")).alias(f"{k}__{c}")
                    for c in METRIC_COLS for k in FLAGS])
    stack = ", ".join(
        f"'{c}', " + ", ".join(f"coalesce(`{k}__{c}`, 0L)" for k in FLAGS) for c in METRIC_COLS)
    return sums.selectExpr(
        f"stack({len(METRIC_COLS)}, {stack}) AS (column_name, {', '.join(FLAGS)})")
