"""Wind rose and dominant wind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherlake.functions.sky import sector_index, sector_name, speed_bin


def wind_rose(df: DataFrame, k: int = 4, speed: str = "windspeed", direction: str = "winddirection") -> DataFrame:
    """Share of the observations by direction sector and speed class, for the k cities with the most wind.

    The rows are read once and counted down to at most 17 x 7 cells per city. A city's cells travel
    with its mean speed through the top k, so the rows are not read again for the chosen cities.
    """
    cells = (
        df.where(F.col("city").isNotNull())
        .groupBy("city", sector_index(F.col(direction)).alias("sector_no"), speed_bin(F.col(speed)).alias("speed_from"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(speed).alias("speed_sum"),
            F.count(speed).alias("speed_count"),
        )
    )
    measured = F.col("sector_no").isNotNull() & F.col("speed_from").isNotNull()
    cities = cells.groupBy("city").agg(
        F.try_divide(F.sum("speed_sum"), F.sum("speed_count")).alias("mean_speed"),
        F.sum(F.when(measured, F.col("n"))).alias("total"),
        F.collect_list(F.when(measured, F.struct("sector_no", "speed_from", "n"))).alias("cells"),
    )
    top = cities.orderBy(F.desc("mean_speed"), "city").limit(k)
    return top.select("city", "total", F.inline("cells")).select(
        "city",
        sector_name(F.col("sector_no")).alias("sector"),
        F.col("speed_from").cast("long").alias("speed_from"),
        "n",
        (F.col("n") / F.col("total")).alias("share"),
    )


def dominant_wind(df: DataFrame, direction: str = "winddirection") -> DataFrame:
    """The most frequent sector of each city; of equally frequent ones the first clockwise from north."""
    counts = (
        df.where(F.col(direction).isNotNull())
        .groupBy("city", sector_index(F.col(direction)).alias("sector_no"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("city").agg(
        F.max(F.struct("n", (-F.col("sector_no")).alias("rank"))).alias("best"), F.sum("n").alias("total")
    )
    return best.select(
        "city",
        sector_name(-F.col("best.rank")).alias("sector"),
        F.col("best.n").alias("n"),
        (F.col("best.n") / F.col("total")).alias("share"),
    )
