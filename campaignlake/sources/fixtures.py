"""The campaign append log, projected from the driver's TPC-H-style tables.

``campaign_log`` maps ``lineitem JOIN part`` onto the 27-column append-log
schema: ship date -> execution date, brand -> campaign, type -> ad (ECONOMY
plays the "no ad" default), prices and keys -> metrics, and ship date plus
1..5 days -> load time, which gives several versions per natural key.  A
quarter of the rows is loaded again, unchanged, a week later.
The same projection is written as SQL in :mod:`campaignlake.registry` for the
DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_bucket
from ..schema import DEFAULT_AD, LIFEDAYS, LOG_COLS, lifeday_cols
from ..session import compiled_code, shuffles_dropped
from .records import money, record_struct


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Bench only, off unless bench.py sets it: the driver's Parquet files are one row group each, so a
# scan is one task and every narrow operator after it inherits that.  Real inputs have more splits.
bench_partitions: int | None = None


def campaign_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append log (27 columns, log column order) over ``lineitem JOIN part``."""
    return _as_log(_source_rows(spark, sf_dir))


def campaign_log_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with ``execution_month``, each month's together and in order, to be written in month folders.

    The tables' own columns move, half the bytes of the log's 27, and the sort
    that a write in folders needs is theirs, not that of wide rows or documents.
    """
    rows = _source_rows(spark, sf_dir).withColumn("execution_month", month_bucket("l_shipdate"))
    rows = rows.hint("rebalance", "execution_month").sortWithinPartitions("execution_month")
    return _as_log(rows, "execution_month")


def _source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem JOIN part``, a row per load of a log row.

    Plain inner equi-join on the part key: the planner broadcasts ``part``
    only when its measured size is under the threshold and otherwise shuffles
    both sides (AQE splits a skewed part key).
    """
    compiled_code(spark)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_shipdate")
    if bench_partitions:
        li = li.repartition(bench_partitions)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    again = F.when(F.col("l_orderkey") % 4 == 0, F.array(F.lit(0), F.lit(7))).otherwise(F.array(F.lit(0)))
    return j.withColumn("days_later", F.explode(again))


def _as_log(j: DataFrame, *kept: str) -> DataFrame:
    """The log's columns of :func:`_source_rows`, beside the columns ``kept``."""
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    qty = F.col("l_quantity").cast("bigint")
    day = F.col("l_shipdate").cast("date")
    cols = {
        "campaigns_execution_date": day,
        "campaign_name": F.col("p_brand"),
        "ad_name": F.when(F.col("p_type") == "ECONOMY", F.lit(DEFAULT_AD)).otherwise(F.col("p_type")),
        "spend_cents": F.when(pk % 13 == 0, F.lit(0).cast("bigint"))
                        .otherwise(F.round(F.col("l_extendedprice") * 100).cast("bigint")),
        "impressions": qty * 100,
        "clicks": qty * (pk % 7),
        "registrations": (ok % 11) * (sk % 4),
        "ctr": F.col("l_discount"),
        "cr": F.col("l_tax"),
        "cpc_cents": pk % 500,
        "players_1d": ok % 3, "payers_1d": sk % 2, "payments_1d": ok % 5,
        "revenue_1d_cents": (ok % 97) * 13,
        "players_3d": ok % 5, "payers_3d": sk % 3, "payments_3d": ok % 7,
        "revenue_3d_cents": (ok % 97) * 29,
        "players_7d": ok % 7, "payers_7d": sk % 4, "payments_7d": ok % 9,
        "revenue_7d_cents": (ok % 97) * 61,
        "players_14d": ok % 9, "payers_14d": sk % 5, "payments_14d": ok % 11,
        "revenue_14d_cents": (ok % 97) * 101,
        "_etl_loaded_at": F.date_add(day, (F.lit(1) + sk % 5).cast("int") + F.col("days_later"))
                          .cast("timestamp_ntz"),
    }
    return j.select(*[cols[c].alias(c) for c in LOG_COLS], *kept)


# --- faults for the checks: rows that must fail, chosen by their own values ---------

def without_some_campaigns(log: DataFrame) -> DataFrame:
    """The campaign name missing where registrations leave 3 modulo 7."""
    return log.withColumn("campaign_name", F.when(F.col("registrations") % 7 != 3, F.col("campaign_name")))


def with_negative_roas(monthly: DataFrame) -> DataFrame:
    """ROAS of the opposite sign where the month's clicks are even."""
    return monthly.withColumn("roas_3d", F.when(F.col("total_clicks") % 2 == 0, -F.col("roas_3d"))
                              .otherwise(F.col("roas_3d")))


def with_orphans(fact: DataFrame) -> DataFrame:
    """A campaign key of no campaign where impressions are a multiple of 300."""
    return fact.withColumn("campaign_key", F.when(F.col("impressions") % 300 == 0, F.lit("orphan"))
                           .otherwise(F.col("campaign_key")))


def without_some_load_times(log: DataFrame) -> DataFrame:
    """The load time missing where registrations are a multiple of 5."""
    return log.withColumn("_etl_loaded_at", F.when(F.col("registrations") % 5 != 0, F.col("_etl_loaded_at")))


# --- nested JSON records derived from the log (ingest fixtures) -------------------
# Each generator writes one JSON document per log row (column ``value``), as the
# source API would send it, with deterministic dirt chosen from the row's own
# values.  No row is dropped; the expected clean result is stated in SQL by the
# oracle with the same selectors.

def _q(c: Column) -> Column:
    """JSON string literal of a text column (NULL stays NULL: key omitted)."""
    esc = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), esc, F.lit('"'))


def _n(c: Column) -> Column:
    """JSON number text of a numeric column."""
    return c.cast("string")


def _kv(key: str, val: Column) -> Column:
    return F.concat(F.lit(f'"{key}":'), val)


def _obj(*pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def _money_text(cents: Column) -> Column:
    return money(cents).cast("string")


def _metric(ld, players: Column, payers: Column, payments: Column, revenue: Column,
            numeric_lifeday: Column | bool = False) -> Column:
    ld_text = F.when(F.lit(numeric_lifeday) if isinstance(numeric_lifeday, bool) else numeric_lifeday,
                     F.lit(str(ld))).otherwise(F.lit(f'"{ld}"'))
    return _obj(_kv("lifeday", ld_text), _kv("players", players), _kv("payers", payers),
                _kv("payments", payments), _kv("revenue", revenue))


def _lifeday_metric(ld: int, numeric: Column | bool = False, revenue: Column | None = None) -> Column:
    players, payers, payments, rev = lifeday_cols(ld)
    return _metric(ld, _n(F.col(players)), _n(F.col(payers)), _n(F.col(payments)),
                   revenue if revenue is not None else _money_text(F.col(rev)), numeric)


NO_NUMBERS = ("abc", "12D", "1.5f", "0x1p3", "0x1F", "1_000", "3.d")


def dirt_selector() -> Column:
    """0..9 from the row's own values (cpc_cents % 10, i.e. part key % 10)."""
    return F.col("cpc_cents") % 10


def dirty_records(log: DataFrame, *kept: str) -> DataFrame:
    """One JSON record per log row, dirty according to :func:`dirt_selector`, beside the columns ``kept``.

    0 clean; 1 clicks -3 and registrations as a quoted number; 2 clicks a text that is no
    number (among them forms that only a programming language takes for one);
    3 ctr Infinity and lifeday-1 revenue NaN; 4 cost and ad keys absent;
    5 metrics null; 6 negative cpc; 7 fractional impressions; 8 a junk
    duplicate of lifeday 1 before the real one, an unknown lifeday 2 and
    numeric lifedays; 9 explicit null cost and ad, lifeday 14 absent.
    """
    s = dirt_selector()
    lt = LIFEDAYS
    no_number = F.element_at(F.array(*(F.lit(f'"{x}"') for x in NO_NUMBERS)),
                             (F.col("impressions") / 100 % len(NO_NUMBERS) + 1).cast("int"))
    metrics_default = [_lifeday_metric(ld) for ld in lt]
    metrics8 = ([_metric(1, F.lit("999"), F.lit("999"), F.lit("999"), F.lit("9.99"), True),
                 _metric(2, F.lit("5"), F.lit("5"), F.lit("5"), F.lit("5.00"), True)]
                + [_lifeday_metric(ld, True) for ld in lt])
    metrics3 = [_lifeday_metric(1, False, F.lit("NaN"))] + [_lifeday_metric(ld) for ld in lt[1:]]
    metrics9 = [_lifeday_metric(ld) for ld in lt if ld != 14]

    def arr(items):
        return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))

    metrics = (F.when(s == 5, F.lit("null")).when(s == 8, arr(metrics8)).when(s == 3, arr(metrics3))
               .when(s == 9, arr(metrics9)).otherwise(arr(metrics_default)))
    null = F.lit(None).cast("string")
    rec = _obj(
        _kv("date", _q(F.date_format("campaigns_execution_date", "yyyy-MM-dd"))),
        _kv("campaign", _q(F.col("campaign_name"))),
        _kv("ad", F.when(s == 4, null).when(s == 9, F.lit("null")).otherwise(_q(F.col("ad_name")))),
        _kv("cost", F.when(s == 4, null).when(s == 9, F.lit("null")).otherwise(_n(F.col("spend_cents")))),
        _kv("impressions", F.when(s == 7, F.concat(_n(F.col("impressions")), F.lit(".5")))
            .otherwise(_n(F.col("impressions")))),
        _kv("clicks", F.when(s == 1, F.lit("-3")).when(s == 2, no_number)
            .otherwise(_n(F.col("clicks")))),
        _kv("registrations", F.when(s == 1, _q(_n(F.col("registrations"))))
            .otherwise(_n(F.col("registrations")))),
        _kv("ctr", F.when(s == 3, F.lit("Infinity")).otherwise(_n(F.col("ctr")))),
        _kv("cr", _n(F.col("cr"))),
        _kv("cpc", F.when(s == 6, F.concat(F.lit("-"), _money_text(F.col("cpc_cents"))))
            .otherwise(_money_text(F.col("cpc_cents")))),
        _kv("metrics", metrics),
    )
    return log.select(rec.alias("value"), *kept)


def _by_month(rows: DataFrame) -> DataFrame:
    """The typed rows, a third of the size of their documents, moved to their months before those are made.

    Rows that have their month are taken to lie together already (:func:`campaign_log_by_month`).
    """
    compiled_code(rows.sparkSession)
    if "execution_month" in rows.columns:
        return rows
    return rows.withColumn("execution_month", month_bucket("campaigns_execution_date")).hint("rebalance", "execution_month")


def _write_landing(documents: DataFrame, path: str) -> None:
    """Documents (``value``) as lines in month folders, compressed by the fast level: a tenth of the text is written."""
    with shuffles_dropped(documents.sparkSession):
        (documents.write.partitionBy("execution_month").option("compression", "gzip")
         .option("zlib.compress.level", "BEST_SPEED").text(path))


def land(log: DataFrame, path: str, broken: Column | None = None) -> None:
    """Write the log as records, JSON lines in month folders; ``broken`` rows lose the end of their line."""
    rows = _by_month(log)
    doc = F.to_json(record_struct(rows))
    if broken is not None:
        doc = F.when(broken, F.substring(doc, 1, 20)).otherwise(doc)
    _write_landing(rows.select(doc.alias("value"), "execution_month"), path)


def land_dirty(log: DataFrame, path: str) -> None:
    """Write :func:`dirty_records` as lines in month folders.

    As text: the documents hold NaN and Infinity, which the JSON functions refuse.
    """
    rows = _by_month(log)
    _write_landing(dirty_records(rows, "execution_month"), path)


def scrambled_lifeday_records(log: DataFrame) -> DataFrame:
    """Records whose metrics list is out of order, repeats lifedays and has unknown ones.

    Per row: a junk lifeday-14 entry, 7, an unknown lifeday 2, 3 given as a
    number, 1, then the real 14 (the last duplicate wins), and a lifeday
    "1.0" that must not match lifeday 1.
    """
    junk = _metric(14, F.lit("1"), F.lit("2"), F.lit("3"), F.lit("4.56"))
    items = [junk, _lifeday_metric(7), _metric(2, F.lit("8"), F.lit("8"), F.lit("8"), F.lit("8.00")),
             _lifeday_metric(3, True), _lifeday_metric(1),
             _obj(_kv("lifeday", F.lit('"1.0"')), _kv("players", F.lit("77"))), _lifeday_metric(14)]
    rec = _obj(
        _kv("date", _q(F.date_format("campaigns_execution_date", "yyyy-MM-dd"))),
        _kv("campaign", _q(F.col("campaign_name"))),
        _kv("ad", _q(F.col("ad_name"))),
        _kv("metrics", F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))),
    )
    return log.select(rec.alias("value"))


def sub_cent_records(log: DataFrame) -> DataFrame:
    """Money written with a third decimal (the cents' last digit) to test truncation.

    cpc and revenues become e.g. ``1.233`` for 123 cents; rows whose cents end
    in 5 send cpc as a quoted string, rows ending in 6 send it negative.
    """
    def sub(col: str) -> Column:
        c = F.col(col)
        return F.concat(_money_text(c), (c % 10).cast("string"))
    last = F.col("cpc_cents") % 10
    cpc = (F.when(last == 5, _q(sub("cpc_cents")))
           .when(last == 6, F.concat(F.lit("-"), sub("cpc_cents"))).otherwise(sub("cpc_cents")))
    metrics = [_lifeday_metric(ld, False, sub(lifeday_cols(ld)[3])) for ld in LIFEDAYS]
    rec = _obj(
        _kv("date", _q(F.date_format("campaigns_execution_date", "yyyy-MM-dd"))),
        _kv("campaign", _q(F.col("campaign_name"))),
        _kv("ad", _q(F.col("ad_name"))),
        _kv("cpc", cpc),
        _kv("metrics", F.concat(F.lit("["), F.concat_ws(",", *metrics), F.lit("]"))),
    )
    return log.select(rec.alias("value"))


def cost_in_currency_records(log: DataFrame) -> DataFrame:
    """Records whose cost is an amount in currency units with a third decimal (the cents' last digit).

    Rows whose cpc ends in 3 send it as a quoted string, in 4 negative, in 5 as a text that is no
    number, in 6 as null, in 7 without the key.
    """
    amount = F.concat(_money_text(F.col("spend_cents")), (F.col("spend_cents") % 10).cast("string"))
    s = dirt_selector()
    cost = (F.when(s == 3, _q(amount)).when(s == 4, F.concat(F.lit("-"), amount)).when(s == 5, F.lit('"n/a"'))
            .when(s == 6, F.lit("null")).when(s == 7, F.lit(None).cast("string")).otherwise(amount))
    rec = _obj(_kv("date", _q(F.date_format("campaigns_execution_date", "yyyy-MM-dd"))),
               _kv("campaign", _q(F.col("campaign_name"))), _kv("ad", _q(F.col("ad_name"))), _kv("cost", cost),
               _kv("impressions", _n(F.col("impressions"))))
    return log.select(rec.alias("value"))


def bad_date_records(log: DataFrame) -> DataFrame:
    """Records with an unusable date: quantity 25 or 50 -> text "not-a-date", quantity 1 -> no date key."""
    qty = F.col("impressions") / 100
    date = (F.when(qty == 1, F.lit(None).cast("string"))
            .when(qty % 25 == 0, _q(F.lit("not-a-date")))
            .otherwise(_q(F.date_format("campaigns_execution_date", "yyyy-MM-dd"))))
    rec = _obj(_kv("date", date), _kv("campaign", _q(F.col("campaign_name"))),
               _kv("ad", _q(F.col("ad_name"))), _kv("cost", _n(F.col("spend_cents"))))
    return log.select(rec.alias("value"))
