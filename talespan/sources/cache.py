"""Cached tables, keyed by what they were made from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from talespan.backends.embed import Embedder, embed


def fingerprint(df: DataFrame) -> str:
    """A hash of a table's rows, whatever their order."""
    row = F.xxhash64(*[F.to_json(F.struct(F.col(c))) for c in df.columns])
    n, x = df.agg(F.count("*"), F.bit_xor(row)).first()
    return f"{n}-{(x or 0) & (1 << 64) - 1:016x}"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame], force_reload: bool = False) -> DataFrame:
    """The table at ``path``; made and written when it is missing or ``force_reload``."""
    if force_reload or not _exists(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def text_key(text: Column) -> Column:
    return F.sha2(text, 256)


def embed_cached(texts: DataFrame, key: str, text: str, embedder: Embedder, folder: str, force_reload: bool = False) -> DataFrame:
    """(key, embedding) of a table of texts. Vectors are kept by text hash and model, so a
    changed text is embedded anew and others are reused; equal texts are embedded once."""
    spark = texts.sparkSession
    path = f"{folder}/embeddings-{embedder.name.replace('/', '_')}"
    wanted = texts.select(key, F.coalesce(text, F.lit("")).alias("_text")).withColumn("_key", text_key(F.col("_text")))
    todo = wanted.select("_key", "_text").distinct()
    if not force_reload and _exists(spark, path):
        todo = todo.join(spark.read.parquet(path).select("_key"), "_key", "left_anti")
    todo.select("_key", embed(F.col("_text"), embedder).alias("embedding")).write.mode("overwrite" if force_reload else "append").parquet(path)
    return wanted.join(spark.read.parquet(path), "_key").select(key, "embedding")
