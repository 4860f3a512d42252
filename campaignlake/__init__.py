"""campaignlake: append-log marketing analytics as Spark DataFrame operators.

Nested ad-performance records are cleaned into an append-only log, historised
as a type-2 history, projected into staging and a star schema, rolled up into
monthly and daily KPI reports and checked between layers.
"""

__version__ = "0.1.0"
