"""Schemas and column lists of the append log and its nested source records.

Everything downstream refers to these names; nothing else hard-codes a
column list.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source system's contract) -------------------
# Lifedays reported by the source API, in days since registration.
LIFEDAYS = (1, 3, 7, 14)
# Default ad name when the source omits the ad.
DEFAULT_AD = "N/A"
# Backfill horizon of a first load: 5*365+1 days.
BACKFILL_DAYS = 5 * 365 + 1
# Default bounds of the date dimension (end exclusive).
DIM_DATES_START = "2020-01-01"
DIM_DATES_END = "2030-12-31"
# Key and load-time columns of the log.
DATE_COL = "campaigns_execution_date"
CAMPAIGN_COL = "campaign_name"
AD_COL = "ad_name"
LOADED_AT = "_etl_loaded_at"
# Whole-number and rate columns of the log beside those per lifeday.
BASE_INT_COLS = ("spend_cents", "impressions", "clicks", "registrations", "cpc_cents")
RATE_COLS = ("ctr", "cr")
# Fields of a source record and of its lifeday metrics; all are read as text.
RECORD_FIELDS = ("date", "campaign", "ad", "cost", "impressions", "clicks", "registrations",
                 "ctr", "cr", "cpc")
METRIC_FIELDS = ("lifeday", "players", "payers", "payments", "revenue")
# -------------------------------------------------------------------------------

# Where the JSON reader puts a document that it cannot parse.
CORRUPT_COL = "_corrupt_record"
# File formats of the log.
FILE_FORMATS = ("parquet", "orc", "json", "csv")
# Columns that the log's storage layout adds; not part of its rows.
STORAGE_COLS = ("execution_month", "load_batch")

KEY_COLS = (DATE_COL, CAMPAIGN_COL, AD_COL)

# Whole-number columns that are counts, per lifeday.
LIFEDAY_COUNT_FIELDS = ("players", "payers", "payments")


def lifeday_cols(ld: int) -> tuple[str, str, str, str]:
    """(players, payers, payments, revenue_cents) column names of one lifeday."""
    return (f"players_{ld}d", f"payers_{ld}d", f"payments_{ld}d", f"revenue_{ld}d_cents")


LIFEDAY_COLS = tuple(c for ld in LIFEDAYS for c in lifeday_cols(ld))
INT_METRIC_COLS = BASE_INT_COLS + LIFEDAY_COLS
# All 23 metric columns; every one is clipped at zero and null-filled by the ingest.
METRIC_COLS = INT_METRIC_COLS + RATE_COLS
# Log column order: three keys, the metrics sorted by name, the load time last.
LOG_COLS = KEY_COLS + tuple(sorted(METRIC_COLS)) + (LOADED_AT,)
SORTED_METRIC_COLS = tuple(sorted(METRIC_COLS))

LOG_SCHEMA = T.StructType(
    [
        T.StructField(DATE_COL, T.DateType(), False),
        T.StructField(CAMPAIGN_COL, T.StringType(), True),
        T.StructField(AD_COL, T.StringType(), False),
    ]
    + [
        T.StructField(c, T.DoubleType() if c in RATE_COLS else T.LongType(), False)
        for c in SORTED_METRIC_COLS
    ]
    + [T.StructField(LOADED_AT, T.TimestampNTZType(), True)]
)

# Nested source record.  Every leaf that carries a number is read as STRING so
# money stays an exact decimal and malformed values stay visible to the cleaner.
METRIC_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in METRIC_FIELDS])
RECORD_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in RECORD_FIELDS]
                             + [T.StructField("metrics", T.ArrayType(METRIC_SCHEMA))])

# History (SCD type 2) bookkeeping columns.
VALID_FROM = "valid_from"
VALID_TO = "valid_to"
SCD_ID = "scd_id"
HISTORY_COLS = LOG_COLS + (VALID_FROM, VALID_TO, SCD_ID)


def staging_lifeday_cols(ld: int) -> tuple[str, str, str, str]:
    return (f"players_{ld}d", f"payers_{ld}d", f"payments_{ld}d", f"revenue_{ld}d_eur")


STAGING_COLS = (
    ("campaign_performance_sk", "report_date", CAMPAIGN_COL, AD_COL, "spend_eur",
     "impressions", "clicks", "registrations", "cpc_eur", "ctr", "cr")
    + tuple(c for ld in LIFEDAYS for c in staging_lifeday_cols(ld))
    + ("valid_from_timestamp", "updated_at_timestamp")
)
