"""Nested ad-performance records: read them, parse them, or write the log back as them.

A record is ``{date, campaign, ad, cost, impressions, clicks, registrations,
ctr, cr, cpc, metrics: [{lifeday, players, payers, payments, revenue}, ...]}``.
Every numeric leaf is read as a STRING (see :data:`RECORD_SCHEMA`): money
stays an exact decimal and bad values reach the cleaner intact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CORRUPT_COL, LIFEDAYS, RECORD_SCHEMA, lifeday_cols
from ..session import compiled_code


def read_records(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Read landed JSON: lines, which split over tasks, or with ``multi_line`` an array of records per file.

    The explicit schema means no inference pass over the files; PERMISSIVE
    mode keeps malformed documents as rows with ``_corrupt_record`` set (of an
    array file with a malformed element, all rows).  A landing folder with
    ``execution_month=YYYY-MM-01`` subfolders gives a date column of that name,
    on which :func:`campaignlake.plans.load.load` prunes the files it reads.
    """
    schema = T.StructType(RECORD_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    return (spark.read.schema(schema)
            .option("columnNameOfCorruptRecord", CORRUPT_COL)
            .option("multiLine", multi_line)
            .option("mode", "PERMISSIVE")
            .option("allowNonNumericNumbers", True)
            .json(path))


def parse_records(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Parse a column of JSON documents (one record each) into record columns.

    The parsed struct is emitted through a one-element ``inline`` generator.
    Catalyst pushes filters on derived columns down through projections by
    substituting the defining expression, so a later ``where`` on a parsed
    field would otherwise parse every document a second time; predicates on
    generator output stay above the generator, so each document is parsed
    once.
    """
    compiled_code(df.sparkSession)
    parsed = F.from_json(F.col(json_col), RECORD_SCHEMA,
                         {"allowNonNumericNumbers": "true", "mode": "PERMISSIVE"})
    return df.select(F.inline(F.array(parsed)))


def money(cents: Column) -> Column:
    """Integer cents -> exact decimal currency amount (by a product: a decimal division costs several times as much)."""
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)")


def record_struct(log: DataFrame) -> Column:
    """The nested record of each log row (inverse of the ingest's unnest-pivot).

    ``cost`` carries cents unchanged (the source sends it that way); ``cpc``
    and ``revenue`` become currency amounts.  One metrics element per lifeday.
    """
    metrics = []
    for ld in LIFEDAYS:
        players, payers, payments, revenue = lifeday_cols(ld)
        metrics.append(F.struct(
            F.lit(str(ld)).alias("lifeday"), F.col(players).alias("players"),
            F.col(payers).alias("payers"), F.col(payments).alias("payments"),
            money(F.col(revenue)).alias("revenue")))
    return F.struct(
        F.date_format("campaigns_execution_date", "yyyy-MM-dd").alias("date"),
        F.col("campaign_name").alias("campaign"),
        F.col("ad_name").alias("ad"),
        F.col("spend_cents").alias("cost"),
        F.col("impressions").alias("impressions"),
        F.col("clicks").alias("clicks"),
        F.col("registrations").alias("registrations"),
        F.col("ctr").alias("ctr"),
        F.col("cr").alias("cr"),
        money(F.col("cpc_cents")).alias("cpc"),
        F.array(*metrics).alias("metrics"),
    )


def to_records(log: DataFrame) -> DataFrame:
    """Log rows -> one JSON document per row in column ``value`` (numbers stay JSON numbers)."""
    return log.select(F.to_json(record_struct(log)).alias("value"))
