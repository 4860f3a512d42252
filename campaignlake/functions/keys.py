"""Surrogate and composite keys (md5 hex text, as the warehouse models use)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import AD_COL, CAMPAIGN_COL, DATE_COL


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def natural_key_text(date=DATE_COL, campaign=CAMPAIGN_COL, ad=AD_COL) -> Column:
    """Null-safe ``date-campaign-ad`` text (a NULL part counts as empty)."""
    parts = [F.coalesce(_c(p).cast("string"), F.lit("")) for p in (date, campaign, ad)]
    return F.concat_ws("-", *parts)


def row_key(date=DATE_COL, campaign=CAMPAIGN_COL, ad=AD_COL) -> Column:
    """``md5(date || '-' || campaign || '-' || ad)``; NULL if any part is NULL."""
    return F.md5(F.concat(_c(date).cast("string"), F.lit("-"), _c(campaign).cast("string"),
                          F.lit("-"), _c(ad).cast("string")))


def campaign_key(campaign=CAMPAIGN_COL) -> Column:
    """``md5(campaign_name)``."""
    return F.md5(_c(campaign).cast("string"))


def ad_key(campaign=CAMPAIGN_COL, ad=AD_COL) -> Column:
    """``md5(campaign || '-' || ad)``; NULL if either part is NULL."""
    return F.md5(F.concat(_c(campaign).cast("string"), F.lit("-"), _c(ad).cast("string")))


def version_id(ts: Column | str, date=DATE_COL, campaign=CAMPAIGN_COL, ad=AD_COL) -> Column:
    """Id of one history version: ``md5(natural_key_text || '|' || ts)``."""
    return F.md5(F.concat(natural_key_text(date, campaign, ad), F.lit("|"),
                          F.coalesce(_c(ts).cast("string"), F.lit(""))))
