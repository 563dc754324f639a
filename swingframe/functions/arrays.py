"""Helpers for expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often `body` names it: the optimizer would
    put an expression in the place of a column's name, inside lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
