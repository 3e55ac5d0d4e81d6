"""Problem 7: visually identical text in different characters."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessaloom.llm import lookalike
from tessaloom.session import durable, small_side


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch["value"].to_pylist()
        usual = [lookalike.usual_form(v) for v in values]
        columns = [[lookalike.skeleton(v) for v in values], usual, [lookalike.latin_reading(u) or lookalike.digit_reading(u) for u in usual]]
        yield pa.RecordBatch.from_arrays([batch["value"], batch["seen"], *(pa.array(c, pa.string()) for c in columns)], ["value", "seen", "skeleton", "usual", "other"])


def one_form(values: DataFrame) -> DataFrame:
    """(value, skeleton, usual) for the distinct values (value, seen) of a column.

    Values are grouped by equal skeleton. A group's form is its member most
    often seen among those that are in composed letters, plain blanks and one
    script a word already; ties go by order. The others of the group take it.
    A group without such a member has every value in its own usual form. A
    value that is usual by itself but could be read otherwise (all letters of
    another script that all look Latin; 0 or 1 among letters) takes the
    group's form only if the group has a member without another reading.
    Groups are small (forms of one look), and only the best member of each is
    kept, so no group is gathered.
    """
    formed = durable(values.mapInArrow(_forms, "value string, seen bigint, skeleton string, usual string, other string"))
    settled = formed.where(F.col("other").isNull() & (F.col("usual") == F.col("value")))
    best = settled.groupBy("skeleton").agg(F.max_by("value", F.struct("seen", "value")).alias("_best"))
    agreed = formed.where(F.col("other").isNull()).groupBy("skeleton").agg(F.max_by("usual", F.struct("seen", "usual")).alias("_agreed"))
    groups = agreed.join(best, "skeleton", "left").select("skeleton", F.coalesce("_best", "_agreed").alias("_form"))
    # a value usual by itself stays, though another of its look may be seen more often
    stays = (F.col("usual") == F.col("value")) & F.col("other").isNull()
    return formed.join(groups, "skeleton", "left").select("value", "skeleton", F.when(stays, F.col("value")).otherwise(F.coalesce("_form", "usual")).alias("usual"))


def in_one_form(df: DataFrame, column: str, into: str = "usual_form", skeleton: str = "skeleton") -> DataFrame:
    """df with the usual form and the skeleton of a column; null stays null.

    Only distinct values go through Python. Extra columns are kept; a column
    already named as an output raises, so nothing is overwritten.
    """
    if {into, skeleton} & set(df.columns):
        raise ValueError(f"{into} or {skeleton} is there already")
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("seen"))
    forms = small_side(one_form(values).withColumnsRenamed({"usual": into, "skeleton": skeleton}))
    return df.join(forms, df[column] == forms["value"], "left").drop("value")


def unusual_rows(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, value) of the rows whose value isn't in its usual form; values in ASCII always are.

    Null and blank values are never found.
    """
    rows = df.where(F.col(column).isNotNull()).select(F.col(key), F.col(column).alias("value"))
    # Latin letters of ASCII values matter only as members of a group with others: their skeletons are kept by the distinct values.
    forms = one_form(rows.groupBy("value").agg(F.count(F.lit(1)).alias("seen")))
    changed = small_side(forms.where((F.col("usual") != F.col("value")) & F.col("usual").rlike(r"(?U)\S")).select("value"))
    return rows.join(changed, "value", "left_semi").select(key, "value")
