"""N-Triples source, parsed line by line inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_LINE = r'^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?)\s*\.\s*(?:#.*)?$'


def _unescape(col: Column) -> Column:
    """Escapes of literals: the JSON string parser knows all of them but ``\\U``."""
    plain = F.regexp_replace(col, r"\\'", "'")
    return F.when(col.contains("\\"), F.from_json(F.concat(F.lit('{"v":"'), plain, F.lit('"}')), "v string")["v"]).otherwise(col)


def parse_triples(lines: DataFrame, col: str = "value") -> DataFrame:
    """Triples of a column of lines, without repeats: s, p, o, o_kind, lang, datatype. Comments,
    blank and malformed lines are left out."""
    g = lambda i: F.regexp_extract(F.col(col), _LINE, i)
    empty = lambda c: F.when(c != "", c)
    rows = lines.where(F.col(col).rlike(_LINE)).select(g(1).alias("s"), g(2).alias("p"), g(3).alias("iri"), g(4).alias("blank"), g(5).alias("lit"),
                                                      empty(F.lower(g(6))).alias("lang"), empty(g(7)).alias("datatype"))
    kind = F.when(F.col("iri") != "", "iri").when(F.col("blank") != "", "blank").otherwise("literal")
    return rows.select(
        F.regexp_replace("s", "^<|>$", "").alias("s"), "p",
        F.when(F.col("iri") != "", F.col("iri")).when(F.col("blank") != "", F.col("blank")).otherwise(_unescape(F.col("lit"))).alias("o"),
        kind.alias("o_kind"), "lang", "datatype").dropDuplicates()


def download(url: str, path: str) -> str:
    """Fetch a thesaurus file once, on the driver, before Spark reads it; an existing file stays."""
    import os
    import shutil
    import urllib.request

    if not os.path.exists(path):
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with urllib.request.urlopen(url) as source, open(path + ".part", "wb") as target:
            shutil.copyfileobj(source, target)
        os.replace(path + ".part", path)
    return path


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    return parse_triples(spark.read.text(path))
