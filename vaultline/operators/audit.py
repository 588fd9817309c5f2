"""Audit columns stamped on every bronze table (K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_audit(df: DataFrame, source: str, as_of: str | None = None, from_file: bool = False) -> DataFrame:
    """``created_timestamp`` (load time) and ``source_table`` (where from).

    ``as_of`` pins the load time to one literal for the whole run, so a
    replay gives the same rows; otherwise the query start time is used.
    ``from_file=True`` records each row's own input file instead of a name.
    Timestamps are wall-clock (``timestamp_ntz``) in the session zone.
    """
    created = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    src = F.col("_metadata.file_path") if from_file else F.lit(source)
    return df.withColumns({"created_timestamp": created, "source_table": src})
