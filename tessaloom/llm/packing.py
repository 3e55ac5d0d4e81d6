"""Problem 8: items filled into containers of fixed capacity by optimal length buckets."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaloom.llm.running import running
from tessaloom.session import durable

#: Buckets of lengths. With more of them less is left unused; the plan stays of the size of their number.
BUCKETS = 128


def boundaries(histogram: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """The upper bounds of the buckets of sizes 1..len(histogram)-1 that make padding least.

    Dynamic programming over the exact histogram: cost[j] for k buckets is the
    least over i of cost[i] for k - 1 buckets plus the padding of the items of
    sizes i + 1..j to j. The padding is a difference of prefix sums, and the
    best i never falls with j, so each layer is solved by halves.
    """
    sizes = np.flatnonzero(histogram)
    if len(sizes) <= buckets:
        return [int(s) for s in sizes]
    number, total = np.cumsum(histogram[sizes]), np.cumsum(histogram[sizes] * sizes)
    number, total = np.concatenate([[0], number]), np.concatenate([[0], total])
    n = len(sizes)
    upper = np.concatenate([[0], sizes])
    cost = upper * number - total
    choice = []
    for _ in range(buckets - 1):
        new, back = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        stack = [(1, n, 0, n)]
        while stack:
            low, high, first, last = stack.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(j - 1, last) + 1)
            tried = cost[i] + upper[j] * (number[j] - number[i]) - (total[j] - total[i])
            at = int(np.argmin(tried))
            new[j], back[j] = tried[at], i[at]
            stack += [(low, j - 1, first, int(i[at])), (j + 1, high, int(i[at]), last)]
        choice.append(back)
        cost = new
    out, j = [], n
    for back in reversed(choice):
        if j == 0:
            break
        out.append(int(upper[j]))
        j = int(back[j])
    if j:
        out.append(int(upper[j]))
    return sorted(out)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(containers, [(bucket, items of it in each)]): token-budget batches, the largest bucket first.

    A batch takes as many items of its bucket as the budget holds, and fills
    what is left of the budget from the largest buckets that still fit. All is
    planned on counts, so it costs the same for any number of items.
    """
    left, out = dict(sorted(counts.items(), reverse=True)), []
    bounds = list(left)
    for bound in bounds:
        while left[bound]:
            room, mix = capacity, []
            for b in bounds:
                if b <= bound and left[b] and (take := min(room // b, left[b])):
                    mix.append((b, take))
                    room -= take * b
            times = min(left[b] // take for b, take in mix)
            for b, take in mix:
                left[b] -= take * times
            out.append((times, mix))
    return out


def pack(spark: SparkSession, sizes: DataFrame, key: str, capacity: int, buckets: int = BUCKETS) -> DataFrame:
    """(key, piece_no, container_no, tokens) for items (key, tokens).

    Items larger than the capacity are cut into pieces of the capacity and a
    rest; no other item is cut. Items without tokens or with null tokens need
    no container and come out with container_no null. Repeated keys are items
    of their own. The plan is made from the histogram of sizes, which has at
    most `capacity` entries, on the driver; items are numbered within their
    buckets and take the place of that number in the plan by a join on a range
    of at most `buckets` entries for each batch of the plan.
    """
    whole = sizes.where(F.col("tokens") > 0)
    pieces = whole.select(key, F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / capacity).cast("int"))).alias("piece_no"), "tokens")
    pieces = pieces.select(key, "piece_no", F.least(F.lit(capacity), F.col("tokens") - F.col("piece_no") * capacity).cast("int").alias("tokens"))
    histogram = np.zeros(capacity + 1, np.int64)
    for size, n in pieces.groupBy("tokens").count().collect():  # at most `capacity` rows
        histogram[size] = n
    bounds = boundaries(histogram, buckets)
    below = np.cumsum(histogram)
    counts = {b: int(below[b] - below[a]) for a, b in zip([0, *bounds], bounds)}
    batches = plan(counts, capacity)
    firsts = list(accumulate((times for times, _ in batches), initial=0))
    used, places = dict.fromkeys(counts, 0), []
    for first, (times, mix) in zip(firsts, batches):
        for bound, take in mix:
            places.append((bound, used[bound], used[bound] + take * times, take, first))
            used[bound] += take * times
    table = spark.createDataFrame(places or [(0, 0, 0, 1, 0)], "_bound int, _from bigint, _to bigint, _take int, _first bigint")
    # the plan of a bucket is a sorted array, searched by the item's number
    runs = table.groupBy("_bound").agg(F.array_sort(F.collect_list(F.struct("_from", "_to", "_take", "_first"))).alias("_runs"))
    bucket = F.element_at(F.filter(F.array(*(F.lit(b) for b in bounds or [0])), lambda b: b >= F.col("tokens")), 1)
    placed = running(pieces.withColumn("_bound", bucket), "_bound", [key, "piece_no"], F.lit(1)).join(F.broadcast(runs), "_bound")
    run = F.element_at(F.filter("_runs", lambda r: (r["_from"] <= F.col("_at")) & (F.col("_at") < r["_to"])), 1)
    placed = placed.withColumn("_run", run).select(key, F.col("piece_no").cast("bigint").alias("piece_no"), (F.col("_run._first") + F.floor((F.col("_at") - F.col("_run._from")) / F.col("_run._take"))).cast("bigint").alias("container_no"), F.col("tokens").cast("bigint").alias("tokens"))
    none = sizes.where(F.coalesce(F.col("tokens"), F.lit(0)) <= 0).select(key, F.lit(0).cast("bigint").alias("piece_no"), F.lit(None).cast("bigint").alias("container_no"), F.lit(0).cast("bigint").alias("tokens"))
    return placed.unionByName(none)


def pack_all(spark: SparkSession, sizes: DataFrame, key: str, containers: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """pack for every row (container, capacity_tokens) of a small table of containers; capacities under 1 or null raise."""
    sizes, out = durable(sizes), None
    for name, capacity in containers.select("container", "capacity_tokens").orderBy("container").collect():  # one row a kind of container
        if not capacity or capacity < 1:
            raise ValueError(f"capacity of {name}: {capacity}")
        one = pack(spark, sizes, key, capacity, buckets).select(F.lit(name).alias("container"), "*")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else sizes.select(F.lit("").alias("container"), key, F.lit(0).cast("bigint").alias("piece_no"), F.lit(0).cast("bigint").alias("container_no"), "tokens").limit(0)
