"""Exact money handling: decimal strings to integer cents and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts cut to the decimals that matter (exact), and scientific notation written out.
CUT_DECIMAL = "decimal(30,3)"
PLAIN_DECIMAL = "decimal(38,20)"


def cut_amount(amount: Column, rounding: str = "truncate") -> Column:
    """An amount's text, cut to the decimals that decide its cents; NULL if it is no number.

    A cast rounds at its own scale, so surplus decimals go before it: any number
    of them is exact.  Scientific notation is written out first (exact to 20
    decimals).
    """
    if rounding not in ("truncate", "half_up"):
        raise ValueError(f"unknown rounding {rounding!r}")
    text = F.trim(amount.cast("string"))
    plain = F.when(text.contains("e") | text.contains("E"), text.try_cast(PLAIN_DECIMAL).cast("string")).otherwise(text)
    # Text before the point and the first decimals after it; what is cut off must be digits.
    return F.regexp_extract(plain, rf"^([+-]?[0-9]*\.?[0-9]{{0,{3 if rounding == 'half_up' else 2}}})[0-9]*$", 1)


def cents_of_cut(cut: Column, rounding: str = "truncate") -> Column:
    """Cents of a text from :func:`cut_amount`."""
    value = cut.try_cast(CUT_DECIMAL) * F.lit(100)
    return (F.round(value, 0) if rounding == "half_up" else value).try_cast("bigint")


def to_cents(amount: Column, rounding: str = "truncate") -> Column:
    """Decimal amount (string or number) in currency units -> BIGINT cents.

    ``truncate`` (default) drops the fraction of a cent toward zero, as the
    source system does (1.999 -> 199, -1.999 -> -199); ``half_up`` rounds.
    Unparseable text, NaN and infinities give NULL.
    """
    return cents_of_cut(cut_amount(amount, rounding), rounding)


def cents_to_eur(cents: Column | str) -> Column:
    """BIGINT cents -> DOUBLE currency units (``cents / 100``)."""
    c = F.col(cents) if isinstance(cents, str) else cents
    return c.cast("double") / F.lit(100.0)


def eur_to_cents(eur: Column | str) -> Column:
    """DOUBLE currency units -> exact BIGINT cents (inverse of :func:`cents_to_eur`)."""
    c = F.col(eur) if isinstance(eur, str) else eur
    return F.round(c * F.lit(100.0), 0).cast("bigint")


def sum_eur(eur: Column | str) -> Column:
    """Sum of a currency column, exact to the cent and independent of row order.

    Doubles summed across partitions depend on the order rows arrive in
    (and so on retries and AQE coalescing).  Summing integer cents is exact;
    the single division at the end is the correctly rounded currency value.
    """
    return cents_to_eur(F.sum(eur_to_cents(eur)))
