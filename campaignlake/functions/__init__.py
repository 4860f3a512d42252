"""Column-expression helpers (all built-in Spark expressions, no Python UDFs)."""

from .dates import as_date, day_of_week_sun0, in_month, in_range, month_bucket
from .keys import ad_key, campaign_key, natural_key_text, row_key, version_id
from .money import cents_to_eur, eur_to_cents, sum_eur, to_cents
from .ratios import ratio_or_null, ratio_or_zero

__all__ = [
    "as_date", "day_of_week_sun0", "in_month", "in_range", "month_bucket",
    "ad_key", "campaign_key", "natural_key_text", "row_key", "version_id",
    "cents_to_eur", "eur_to_cents", "sum_eur", "to_cents",
    "ratio_or_null", "ratio_or_zero",
]
