"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidemark.session import checkpoint_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = f"{checkpoint_dir(df.sparkSession)}/tidemark-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
