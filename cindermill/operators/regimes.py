"""Feature panels of macro series and soft states over them."""

from __future__ import annotations

from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_panel(observations: DataFrame, series: dict[str, str]) -> DataFrame:
    """date and one z-scored column per series, on the dates that all of them have."""
    columns = [F.max(F.when(F.col("series_id") == name, F.col("value"))).alias(column) for name, column in series.items()]
    wide = observations.where(F.col("series_id").isin(*series)).groupBy(F.col("observation_date").alias("date")).agg(*columns).dropna()
    moments = wide.agg(*[f(c).alias(f"{c}_{n}") for c in series.values() for n, f in (("mean", F.avg), ("sd", F.stddev_samp))])
    scaled = {c: (F.col(c) - F.col(f"{c}_mean")) / F.nullif(F.col(f"{c}_sd"), F.lit(0.0)) for c in series.values()}
    return wide.crossJoin(F.broadcast(moments)).select("date", *[x.alias(c) for c, x in scaled.items()])  # moments is one row


def assign_states(panel: DataFrame, columns: list[str], states: int = 5, seed: int = 7) -> DataFrame:
    """Each date's most likely state of a Gaussian mixture, numbered by the mean of the first column, and its probability."""
    rows = VectorAssembler(inputCols=columns, outputCol="features").transform(panel.dropna())
    fitted = GaussianMixture(k=states, seed=seed, featuresCol="features").fit(rows)
    found = fitted.transform(rows).select("date", *columns, F.col("prediction").alias("raw_"), F.array_max(vector_to_array("probability")).alias("probability"))
    means = [float(r["mean"][0]) for r in fitted.gaussiansDF.select("mean").collect()]  # one row per state
    order = {raw: number for number, raw in enumerate(sorted(range(states), key=lambda k: means[k]))}
    number = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    return found.select("date", number[F.col("raw_")].alias("state"), "probability")
