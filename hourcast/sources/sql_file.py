"""Query texts kept in files."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql_file(
    spark: SparkSession,
    path: str | Path,
    args: Mapping[str, Any] | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """Run the query in `path`.

    `:name` in the text takes a value from `args`, `{name}` a table.
    """
    return spark.sql(Path(path).read_text(), args=dict(args or {}), **tables)
