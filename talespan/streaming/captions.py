"""WebVTT files as a stream: each new file is read once; the checkpoint remembers which."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from talespan.runtime import ship
from talespan.sources.vtt import parse_files


def stream_captions(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Captions of the .vtt files that arrive in a folder, as talespan.sources.vtt gives them."""
    ship(spark)
    files = (spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", "*.vtt").option("maxFilesPerTrigger", files_per_trigger).load(folder)
             .select(F.col("_metadata.file_name").alias("file_name"), "value"))
    return parse_files(files)
