"""Daily landing as an incremental stream: each run takes the files that are new and stops.

The batch form (`append_bronze`) guards by day.  This form guards by file: the stream's progress,
kept in the session's checkpoint folder, says which files have been taken, and the file sink
commits a batch as a whole, so a lost executor or a second run adds nothing twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.documents import parsed
from tidemark.session import checkpoint_dir
from tidemark.sources.lifecycle import RUN_DATE, RUN_DAY, raw_rows, run_stamp


def land_new_files(spark: SparkSession, folder: str, location: str, as_of: dt.datetime, name: str,
                   files_per_batch: int = 10_000, progress: str | None = None) -> StreamingQuery:
    """Append the documents of all files not taken before to a raw table, then stop.

    Lines that are not JSON go to no table here; `land_rejects` takes them.  `name` identifies the stream in
    the checkpoint folder.
    """
    lines = (spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
             .filter(parsed("value").isNotNull()).withColumnRenamed("value", "json_data"))
    stamp = run_stamp(as_of)
    rows = raw_rows(lines).withColumn(RUN_DATE, F.lit(stamp)).withColumn(RUN_DAY, F.lit(stamp[:8]))
    return (rows.writeStream.format("parquet").partitionBy(RUN_DAY).outputMode("append")
            .option("checkpointLocation", progress or f"{checkpoint_dir(spark)}/{name}")
            .trigger(availableNow=True).start(location))


def land_rejects(spark: SparkSession, folder: str, location: str, as_of: dt.datetime, name: str,
                 files_per_batch: int = 10_000, progress: str | None = None) -> StreamingQuery:
    """Append (file, record) of all lines that are not JSON to a table by day, then stop.

    A stream of its own, with its own progress, so that it cannot hold up the documents.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    rejected = lines.filter((F.trim("value") != "") & parsed("value").isNull()).select(
        F.input_file_name().alias("file"), F.col("value").alias("record"), F.lit(run_stamp(as_of)[:8]).alias(RUN_DAY))
    return (rejected.writeStream.format("parquet").partitionBy(RUN_DAY).outputMode("append")
            .option("checkpointLocation", progress or f"{checkpoint_dir(spark)}/{name}-rejects")
            .trigger(availableNow=True).start(location))
