"""Which input files still lack an output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

OUTPUT_SUFFIX = "_enriched_segments.json"


def output_name(file_name: Column) -> Column:
    """The output file of an input file: its stem and a suffix."""
    return F.concat(F.regexp_replace(file_name, r"\.[^.]*$", ""), F.lit(OUTPUT_SUFFIX))


def new_inputs(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Input rows (file_name) that end in .vtt and have no output row (file_name)."""
    done = outputs.select(F.col("file_name").alias("done"))
    return inputs.where(F.col("file_name").endswith(".vtt")).join(done, output_name(F.col("file_name")) == F.col("done"), "left_anti")


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Names of the files directly in a folder; none if it does not exist."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "file_name string")
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select(F.col("_metadata.file_name").alias("file_name"))
