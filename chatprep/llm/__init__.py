"""Operators of a training-data pipeline, each a Spark job over whole tables."""

from chatprep.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
