"""The queries of the engine, by name, and DuckDB SQL for the same rows."""

from . import archives, assembly, data, files, judging, markup, more, pools, web  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
