"""The registered queries and the SQL each is checked against."""

from chatprep.plans import (  # noqa: F401
    checks,
    convert,
    evaluation,
    mining,
    sampling,
    storage,
    training,
)
from chatprep.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
