"""Name a value once inside a larger expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Catalyst may inline a projected column into the lambda of a later one, where it would be
    evaluated once per array element. A lambda argument is never inlined.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
