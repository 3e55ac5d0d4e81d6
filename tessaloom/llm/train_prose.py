"""python -m tessaloom.llm.train_prose SF_DIR: induce prose_rules.json from labelled rows of gate_mwe at scale 0.1."""

from __future__ import annotations

import json
import sys
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaloom.llm import prose, rules

# Rows that are labelled as lists, tables or junk. The first 800 rows and those beyond 2400, chosen because they are near the border, were read;
# rows 801 to 2400 were labelled by the former rule list of words of four languages. Of the first 2400 the others with text are speeches, and so are those of ALSO_PROSE.
FIRST = 2400
ALSO_PROSE = (843, 6269, 7768, 7883)
NOT_PROSE = (
    14, 24, 66, 116, 119, 127, 129, 156, 161, 184, 186, 203, 213, 220, 232, 237, 251, 269, 289, 319, 328, 344, 351, 372, 384, 386, 463, 469, 477, 489,
    502, 506, 516, 545, 556, 566, 575, 581, 587, 615, 624, 629, 643, 647, 651, 662, 667, 668, 672, 683, 684, 696, 703, 714, 732, 739, 750, 772, 798, 813,
    825, 844, 856, 873, 879, 912, 921, 931, 942, 948, 950, 961, 972, 1004, 1007, 1026, 1033, 1061, 1064, 1067, 1068, 1072, 1079, 1081, 1105, 1112, 1126,
    1172, 1182, 1198, 1199, 1214, 1270, 1281, 1357, 1403, 1408, 1410, 1424, 1460, 1465, 1472, 1485, 1494, 1504, 1505, 1514, 1525, 1566, 1575, 1592, 1603,
    1612, 1667, 1689, 1696, 1700, 1702, 1703, 1712, 1739, 1740, 1755, 1778, 1782, 1791, 1796, 1815, 1826, 1835, 1866, 1885, 1897, 1901, 1915, 1923, 1947,
    1949, 1990, 2055, 2078, 2088, 2094, 2122, 2146, 2158, 2160, 2165, 2171, 2199, 2201, 2208, 2212, 2214, 2216, 2236, 2240, 2249, 2250, 2257, 2265, 2273,
    2274, 2297, 2320, 2339, 2344, 2346, 2359, 2372, 3307, 4017, 4891, 5218, 5314, 6145, 6894,
)
#: Splits tried; the list with the fewest errors on the labelled rows held out of all of them, every HELD_OUT-th, is taken.
SPLITS, HELD_OUT = range(1, 9), 4


def induced(x: np.ndarray, y: np.ndarray) -> list[list[rules.Condition]]:
    held = np.arange(len(y)) % HELD_OUT == 0
    lists = [rules.induce(x[~held], y[~held], seed) for seed in SPLITS]

    def errors(found: list[list[rules.Condition]]) -> int:
        hit = np.zeros(len(y), bool)
        for rule in found:
            hit |= rules._covered(rule, x)
        return int((hit != y)[held].sum())

    return min(lists, key=errors)


def train(table: DataFrame) -> list[dict]:
    """Rules from at most rules.MOST_ROWS labelled rows."""
    rows = prose.figures(table.where(F.col("Text").rlike(r"(?U)[^\s\x1c-\x1f]")).where(F.col("row_idx").between(1, FIRST) | F.col("row_idx").isin(*NOT_PROSE, *ALSO_PROSE)).orderBy("row_idx").limit(rules.MOST_ROWS)).select("row_idx", *prose.FIGURES).toPandas()
    x, y = rows[list(prose.FIGURES)].to_numpy(float), rows["row_idx"].isin(NOT_PROSE).to_numpy()
    return [{"if": [[prose.FIGURES[f], sign, round(threshold, 4)] for f, sign, threshold in rule], "prose": False} for rule in induced(x, y)]


if __name__ == "__main__":
    spark = SparkSession.builder.master("local[*]").getOrCreate()
    found = train(spark.read.parquet(f"{sys.argv[1]}/gate_mwe.parquet"))
    Path(__file__).with_name("prose_rules.json").write_text(json.dumps(found, indent=1) + "\n")
    print(found, np.__version__)
