"""Raw landing as a Structured Streaming job over a folder of arriving files.

Same form as ``lakestar.sources.landing`` (every column as text, all-NULL rows dropped). A stream needs its
schema up front, so a CSV file's header must name the contract's columns in their order; a file with another header fails
the query instead of landing values in the wrong columns. The file sink plus the checkpoint make each file
land exactly once, and ``availableNow`` processes what is there and stops, so
the job can run on a schedule and survive restarts.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakestar import schemas
from lakestar.functions.conform import as_text
from lakestar.sources.landing import land


def land_stream(spark: SparkSession, src_dir: str, table: str, out_path: str, checkpoint: str,
                fmt: str = "csv", max_files_per_trigger: int = 1000) -> StreamingQuery:
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        stream = (reader.schema(schemas.RAW_STRING[table]).option("header", True)
                  .option("enforceSchema", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(src_dir))
    else:
        stream = reader.schema(schemas.RAW[table]).format(fmt).load(src_dir)
    landed = land(as_text(stream, schemas.RAW[table].names))
    return (landed.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_path))
