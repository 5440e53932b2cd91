"""Column names: camelCase to snake_case and back."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def to_snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", lambda m: "_" + m.group(1).lower(), name)


def to_camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part.capitalize() for part in rest)


def snake_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: to_snake(c) for c in df.columns})


def camel_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: to_camel(c) for c in df.columns})
