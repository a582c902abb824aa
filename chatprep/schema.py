"""Record layouts shared by readers, operators and writers."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
MESSAGES = T.ArrayType(MESSAGE)

CHAT = T.StructType([T.StructField("messages", MESSAGES)])
ALPACA = T.StructType(
    [
        T.StructField("instruction", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)
GENERATION = T.StructType(
    [
        T.StructField("response", T.StringType()),
        T.StructField("generation_time", T.DoubleType()),
        T.StructField("tokens_generated", T.IntegerType()),
    ]
)

# The closed set of message roles, and the columns each format needs.
ROLES = ("system", "user", "assistant")
REQUIRED_FIELDS = {
    "chatml": ("messages",),
    "alpaca": ("instruction", "output"),
}


def required_fields(data_format: str) -> tuple[str, ...]:
    """Columns a format needs; an unknown format needs none."""
    return REQUIRED_FIELDS.get(data_format, ())
