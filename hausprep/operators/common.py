"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Backtick-quote a column name (spaces, dots, symbols are all legal)."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    return F.col(quote(name))
