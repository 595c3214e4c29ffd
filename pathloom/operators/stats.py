"""Statistics of arrays, metric maps, grids and masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pathloom.operators.prefix import checkpointed, running_before


def array_statistics(df: DataFrame, values: Column) -> DataFrame:
    """Per dimension of a vector column: mean, std (population, at least 1e-6), min, max and exact 1 % and 99 % points, of 32-bit values.

    Points are found by running numbers of the distinct values, which are counted before they are dealt by range, so no
    dimension is held in one place.
    """
    x = df.select(F.posexplode(values).alias("dim", "x")).withColumn("x", F.col("x").cast("float").cast("double")).where("x is not null")
    counted = running_before(x.groupBy("dim", "x").agg(F.count("*").alias("n")), ["dim", "x"], F.col("n"), "before")
    xn = F.col("x") * F.col("n")
    # numbers run on over the dimensions, so each has a first one
    mean = counted.groupBy("dim").agg((F.sum(xn) / F.sum("n")).alias("mean"), F.min("x").alias("min"), F.max("x").alias("max"), F.sum("n").alias("total"), F.min("before").alias("first"))
    mean = checkpointed(mean)  # one row per dimension
    before = F.col("before") - F.col("first")
    apart = (F.col("x") - F.col("mean")) * (F.col("x") - F.col("mean")) * F.col("n")
    found = [F.greatest(F.sqrt(F.sum(apart) / F.sum("n")), F.lit(1e-6)).alias("std")]
    for name, q in (("q01", 0.01), ("q99", 0.99)):
        place = (F.col("total") - 1) * q
        at = lambda p: F.max(F.when((before <= p) & (p < before + F.col("n")), F.col("x")))
        below, above, share = at(F.floor(place)), at(F.least(F.floor(place) + 1, F.col("total") - 1)), F.max(place - F.floor(place))
        found.append((below + (above - below) * share).alias(name))
    points = counted.join(F.broadcast(mean), "dim").groupBy("dim").agg(*found)
    return points.join(F.broadcast(mean), "dim").select("dim", "mean", "std", "min", "max", "q01", "q99")


def nested_means(df: DataFrame, key: str, metrics: Column) -> DataFrame:
    """Mean of each metric of a map over all episodes, also over those without it."""
    n = df.agg(F.count_distinct(key).alias("n"))
    sums = df.select(F.explode(metrics).alias("metric", "x")).groupBy("metric").agg(F.sum("x").alias("s"))
    return sums.crossJoin(F.broadcast(n)).select("metric", (F.col("s") / F.col("n")).alias("mean"))  # n is one row


def rolling_mean(value: str, keys: list[str], order: list[str]) -> Column:
    return F.avg(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def pooled(cells: DataFrame, keys: list[str], side: int, out: int) -> DataFrame:
    """Adaptive average pooling of a square row-major grid (columns ``cell``, ``x``) to ``out`` by ``out``.

    Bin i covers [floor(i n / m), ceil((i+1) n / m)); bins overlap if m does not divide n.
    """
    r, c = F.floor(F.col("cell") / side), F.col("cell") % side
    bins = lambda v: F.filter(F.sequence(F.lit(0), F.lit(out - 1)), lambda i: (F.floor(i * side / out) <= v) & (v < F.ceil((i + 1) * side / out)))
    rows = cells.select(*keys, F.explode(bins(r)).alias("r"), F.lit(0).alias("_"), c.alias("c"), "x")
    rows = rows.select(*keys, "r", F.explode(bins(F.col("c"))).alias("c"), "x")
    return rows.groupBy(*keys, (F.col("r") * out + F.col("c")).alias("bin")).agg(F.avg("x").alias("x"))


def vector_summary(v: Column, other: Column) -> list[Column]:
    """Mean, population deviation, largest difference to another vector, and whether all is finite; no explode."""
    v, other = v.cast("array<double>"), other.cast("array<double>")
    add = lambda a, x: a + x
    n = F.size(v)
    mean = F.aggregate(v, F.lit(0.0), add) / n
    var = F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), add) / n - mean * mean
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return [mean.alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("std"), F.array_max(F.zip_with(v, other, lambda a, b: F.abs(a - b))).alias("max_abs_diff"), fine.alias("all_finite")]


def bounding_box(cells: DataFrame, keys: list[str], mask: Column) -> DataFrame:
    """Box of the cells (``row``, ``col``) where the mask holds, as columns first."""
    m = cells.where(mask)
    return m.groupBy(*keys).agg(F.min("col").alias("cmin"), F.min("row").alias("rmin"), F.max("col").alias("cmax"), F.max("row").alias("rmax"), F.count("*").alias("n_cells"))


def band(count: Column, pixels: int, least: int, most: float = 0.95) -> Column:
    """A detector's verdict on a pixel count: more than the least, less than almost all."""
    return (count > least) & (count < most * pixels)
