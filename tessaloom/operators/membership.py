"""Wide membership columns turned into maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def memberships(df: DataFrame, key: str, country: str = "Country", prefix: str = "BLOC_") -> DataFrame:
    """(key, country, organizations map): for each row its columns of the prefix that are neither null, NaN nor 0.

    Rows without any are left out. The name is the column's without the
    prefix, wherever in it. Without a country column it is Row_ and the key.
    """
    columns = [c for c in df.columns if c.startswith(prefix)]
    named = F.col(country) if country in df.columns else F.concat(F.lit("Row_"), F.col(key).cast("string"))
    if not columns:
        return df.select(key, named.alias("country"), F.create_map().cast("map<string,double>").alias("organizations")).limit(0)
    pairs = F.create_map(*(x for c in columns for x in (F.lit(c.replace(prefix, "")), F.col(c).cast("double"))))
    made = F.map_filter(pairs, lambda k, v: v.isNotNull() & ~F.isnan(v) & (v != 0))
    return df.select(key, named.alias("country"), made.alias("organizations")).where(F.size("organizations") > 0)


def without_prefix(df: DataFrame, prefix: str = "BLOC_") -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith(prefix)))
