"""DataFrame -> DataFrame operators of the append-log pipeline."""

from . import checks, history, ingest, kpi, star, windows

__all__ = ["checks", "history", "ingest", "kpi", "star", "windows"]
