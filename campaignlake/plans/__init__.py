"""Multi-step jobs built from the operators: the load job, the layer build, SQL-file reports."""

from .daily import DailyResult, run_daily
from .layers import STAGES, Layers, build_layers
from .load import LoadResult, load, read_log
from .reports import export_reports, register_views, run_sql_reports

__all__ = ["DailyResult", "run_daily", "STAGES", "Layers", "build_layers", "LoadResult", "load", "read_log",
           "export_reports", "register_views", "run_sql_reports"]
