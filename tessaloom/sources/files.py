"""Files read and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# What stands for null in a CSV of the pipeline.
NULLS = ("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "n/a", "<NA>", "#N/A", "-NaN", "-nan", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN", "#NA", "#N/A N/A")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, rows: int | None = None, order: str | None = None, nulls: tuple[str, ...] = NULLS) -> DataFrame:
    """A CSV with header, quoted line feeds and doubled quotes; the tokens of nulls become null in text columns.

    rows: the first so many in order of a column (0 or None: all).
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    df = df.select(*(F.when(~F.col(f"`{f.name}`").isin(*nulls), F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in df.schema.fields))
    if rows:
        df = (df.orderBy(order) if order else df).limit(rows)
    return df


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", True).option("encoding", "UTF-8").csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_frequencies(spark: SparkSession, pattern: str) -> DataFrame:
    """(n, rank, phrase, frequency) of the n-gram reports that a path pattern names; n is the number in the file's name."""
    df = spark.read.option("header", True).option("escape", '"').schema("Rank int, Phrase string, Frequency bigint, Type string").csv(pattern)
    return df.select(F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)grams", 1).try_cast("int").alias("n"), F.col("Rank").alias("rank"), F.col("Phrase").alias("phrase"), F.col("Frequency").alias("frequency")).where("n IS NOT NULL")


def schema_of(df: DataFrame) -> DataFrame:
    """(ordinal, name, type) of the columns."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, name string, type string")
