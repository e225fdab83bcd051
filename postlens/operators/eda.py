"""Exploratory statistics.

Counts are grouped aggregations; the weekday axis is a seven-row table
joined to at most seven counts; the trimmed histogram finds its exact
quantile by a few rounds of bounded aggregations over ever narrower value
ranges, and then takes a single grouped count over bin numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Weekday axis in reference order, histogram shape.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
GRID = 200           # points of a density curve
FINE_BINS = 1000     # bins that its values are counted in
HIST_BINS = 50
TRIM_QUANTILE = 0.95


def parse_time(c: Column) -> Column:
    """ISO-8601 text (with or without 'Z') or epoch seconds -> timestamp."""
    s = F.trim(c.cast("string"))
    num = F.when(s.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), F.timestamp_seconds(s.cast("double")))
    iso = F.try_to_timestamp(F.regexp_replace(s, "Z$", ""))
    return F.coalesce(num, iso)


def iso_z(ts: Column) -> Column:
    """Timestamp -> 'YYYY-MM-DDTHH:MM:SSZ' (UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def time_parts(df: DataFrame, ts: str = "created_utc") -> DataFrame:
    """Hour of day and weekday name."""
    return df.withColumn("hour", F.hour(ts).cast("long")) \
             .withColumn("day_of_week", F.date_format(ts, "EEEE"))


def cutoff(hours: float, now: Column | None = None) -> Column:
    """D3: now minus ``hours``."""
    base = now if now is not None else F.current_timestamp()
    return base - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600.0))


def dataset_profile(df: DataFrame, ts: str = "created_utc", group: str = "subreddit",
                    author: str = "author") -> DataFrame:
    """Time range, distinct communities and authors (exact)."""
    return df.agg(F.min(ts).alias("first_post"), F.max(ts).alias("last_post"),
                  F.count_distinct(group).alias("unique_communities"),
                  F.count_distinct(author).alias("unique_authors"),
                  F.count(F.lit(1)).alias("total_posts"))


def counts_by(df: DataFrame, col: str | Column, name: str, k: int | None = None) -> DataFrame:
    """Posts per value, optionally the top ``k`` (count desc,
    value asc)."""
    c = df.groupBy(F.col(col).alias(name) if isinstance(col, str) else col.alias(name)) \
          .agg(F.count(F.lit(1)).alias("count"))
    if k is not None:
        c = c.orderBy(F.col("count").desc(), F.col(name).asc()).limit(k)
    return c


def weekday_counts(spark: SparkSession, df: DataFrame, ts: str = "created_utc") -> DataFrame:
    """Counts on the fixed Monday..Sunday axis; a missing day is null."""
    axis = spark.createDataFrame([(i, d) for i, d in enumerate(WEEKDAYS)], "day_index int, day_of_week string")
    c = df.groupBy(F.date_format(ts, "EEEE").alias("day_of_week")).agg(F.count(F.lit(1)).alias("count"))
    return axis.join(F.broadcast(c), "day_of_week", "left").select("day_index", "day_of_week", "count")


def text_length(title: Column, body: Column) -> Column:
    """len(title) + len(body), null parts count 0."""
    return (F.coalesce(F.length(title), F.lit(0)) + F.coalesce(F.length(body), F.lit(0))).cast("long")


def order_statistic(x: DataFrame, col: str, rank: int, parts: int = 4096) -> float:
    """The value at place ``rank`` (from 0) in ascending order, exactly.

    The range of the values is cut into ``parts`` bins, the bin that holds
    the place is cut again, and so on until it holds one value.  Each round
    is one aggregation with at most ``parts`` rows, however many values
    there are; the least and the greatest value of a range fall into
    different bins, so every round narrows it.  The values must be finite."""
    v = F.col(col)
    inside, low, high = x, None, None
    while True:
        if low is None:
            bin_ = F.lit(0)
        else:
            inside = x.where((v >= F.lit(low)) & (v <= F.lit(high)))
            # halves, where the width itself is beyond a double
            half = 1.0 if math.isfinite(high - low) else 0.5
            share = (v * half - F.lit(low * half)) / F.lit(high * half - low * half)
            bin_ = F.least(F.lit(parts - 1), F.floor(share * F.lit(parts)).cast("int"))
        rows = inside.groupBy(bin_.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).collect()
        for r in sorted(rows, key=lambda r: r["bin"]):
            if rank < r["n"]:
                break
            rank -= r["n"]
        low, high = r["low"], r["high"]
        if low == high:
            return low


def quantile(x: DataFrame, col: str, q: float) -> float | None:
    """Exact quantile with linear interpolation; null without values."""
    n = x.count()
    if not n:
        return None
    place = q * (n - 1)
    below, above = math.floor(place), math.ceil(place)
    low = order_statistic(x, col, below)
    if below == above:
        return low
    return (above - place) * low + (place - below) * order_statistic(x, col, above)


def _finite(df: DataFrame, col: str) -> DataFrame:
    x = df.select(F.col(col).cast("double").alias("x"))
    return x.where(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < F.lit(float("inf"))))


def trimmed_histogram(df: DataFrame, col: str, q: float = TRIM_QUANTILE, bins: int = HIST_BINS) -> DataFrame:
    """Drop values >= the exact q-quantile (linear interpolation),
    then ``bins`` equal-width bins over [min, max] of the rest (last bin
    closed) with counts, plus the trimmed mean on every row.  The cut and
    the range are scalar aggregates of a few small jobs; the binning is one
    grouped count.  Null, NaN and infinite values are left out."""
    x = _finite(df, col)
    cut = quantile(x, "x", q)
    if cut is None:
        return df.sparkSession.createDataFrame(
            [], "bin long, lower double, upper double, count long, mean double")
    kept = x.where(F.col("x") < F.lit(cut))
    r = kept.agg(F.min("x").alias("mn"), F.max("x").alias("mx"), F.avg("x").alias("mean")).first()
    mn, mx, mean = r["mn"], r["mx"], r["mean"]
    if mn is None:
        return df.sparkSession.createDataFrame(
            [], "bin long, lower double, upper double, count long, mean double")
    width = (mx - mn) / bins
    b = F.lit(0) if mx == mn else F.least(F.lit(bins - 1), F.floor((F.col("x") - F.lit(mn)) * F.lit(float(bins))
                                                                 / F.lit(float(mx - mn))).cast("int"))
    h = kept.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return h.select(F.col("bin").cast("long").alias("bin"),
                    F.round(F.lit(mn) + F.col("bin") * F.lit(width), 6).alias("lower"),
                    F.round(F.lit(mn) + (F.col("bin") + 1) * F.lit(width), 6).alias("upper"),
                    "count", F.round(F.lit(mean), 6).alias("mean"))


def density_curve(df: DataFrame, col: str, q: float = TRIM_QUANTILE, grid: int = GRID,
                  bins: int = FINE_BINS) -> DataFrame:
    """(point, x, density) of a Gaussian kernel estimate over the values
    below the q-quantile, at ``grid`` points from their least to their greatest.

    The values are counted in ``bins`` narrow bins, each of which adds its
    count times the kernel at its middle to every point, so the work on the
    curve is the same however many values there are.  The bandwidth is the
    standard deviation times n^(-1/5) (Scott's rule).  Null, NaN and infinite
    values are left out; without two different values there is no curve."""
    x = _finite(df, col)
    cut = quantile(x, "x", q)
    nothing = df.sparkSession.createDataFrame([], "point long, x double, density double")
    if cut is None:
        return nothing
    kept = x.where(F.col("x") < F.lit(cut))
    r = kept.agg(F.min("x").alias("mn"), F.max("x").alias("mx"), F.count("*").alias("n"),
                 F.stddev_samp("x").alias("sd")).first()
    if r["mn"] is None or r["mn"] == r["mx"]:
        return nothing
    mn, mx, n = r["mn"], r["mx"], r["n"]
    width, bw = mx - mn, r["sd"] * n ** -0.2
    bin_ = F.least(F.lit(bins - 1), F.floor((F.col("x") - F.lit(mn)) * F.lit(float(bins)) / F.lit(width)).cast("int"))
    counted = kept.groupBy(bin_.alias("bin")).agg(F.count("*").alias("c"))
    at = F.lit(mn) + F.lit(width) * F.col("point") / F.lit(float(grid - 1))
    middle = F.lit(mn) + (F.col("bin") + 0.5) * F.lit(width / bins)
    points = counted.select("bin", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid - 1).cast("long"))).alias("point"))
    kernel = F.col("c") * F.exp(-0.5 * F.pow((at - middle) / F.lit(bw), F.lit(2.0)))
    return points.groupBy("point").agg(F.sum(kernel).alias("s")).select(
        "point", F.round(at, 6).alias("x"),
        F.round(F.col("s") / F.lit(n * bw * math.sqrt(2 * math.pi)), 8).alias("density"))
