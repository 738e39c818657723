"""Scale and shift of pages from matched anchors, and their use on features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.session import shared_folder

#: Anchors whose residual is more than so many times their page's median are left out of the next fit.
REACH = 3.0


def least_squares(anchors: DataFrame, page: str, reach: float = REACH) -> DataFrame:
    """``(page, sx, tx, sy, ty, within)`` by least squares over the anchors ``(x, y, to_x, to_y)``; anchors ``within`` keep for the next fit.

    All of it is aggregates: one for the sums, one for the median residual.
    """
    fits = anchors.groupBy(page).agg(*[f(F.col(f"to_{a}"), F.col(a)).alias(n + a) for a in "xy" for n, f in (("s", F.regr_slope), ("t", F.regr_intercept))])
    away = residuals(anchors.join(fits, page)).groupBy(page).agg((F.median("residual") * reach + 1e-9).alias("within"))
    return fits.join(away, page)


def residuals(joined: DataFrame) -> DataFrame:
    """How far each anchor lies from where its page's fit puts it."""
    dx, dy = (F.col(f"s{a}") * F.col(a) + F.col(f"t{a}") - F.col(f"to_{a}") for a in "xy")
    return joined.withColumn("residual", F.sqrt(dx * dx + dy * dy))


def fit_pages(anchors: DataFrame, page: str, rounds: int = 3, reach: float = REACH) -> DataFrame:
    """``(page, sx, tx, sy, ty, anchors, confidence)``: fits after ``rounds`` rounds of leaving out what lies far off.

    Confidence is 0.85, and up to 0.15 more the more alike both scales are. Rows with a null coordinate don't count; pages whose
    anchors share one x or one y have no fit and no row.
    """
    spark, folder = anchors.sparkSession, shared_folder(anchors.sparkSession, "fits")
    columns = [page, "x", "y", "to_x", "to_y"]

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    # a table a round: each reads the one before three times
    anchors = stored(anchors.select(*columns).dropna(), "anchors")
    for i in range(rounds):
        fitted = stored(least_squares(anchors, page, reach), f"fits-{i}")
        anchors = stored(residuals(anchors.join(fitted, page)).where("residual <= within").select(*columns), f"anchors-{i}")
    fits = least_squares(anchors, page, reach).join(anchors.groupBy(page).agg(F.count("*").alias("anchors")), page)
    a, b = F.abs("sx"), F.abs("sy")
    return fits.where("sx <> 0 AND sy <> 0").select(page, "sx", "tx", "sy", "ty", "anchors", (0.85 + 0.15 * F.least(a, b) / F.greatest(a, b)).alias("confidence"))


def place_features(features: DataFrame, fits: DataFrame, page: str) -> DataFrame:
    """Features with ``to_x``, ``to_y`` and ``confidence`` by their page's fit; null where it has none."""
    moved = features.join(fits, page, "left")
    return moved.select(*features.columns, *[(F.col(f"s{a}") * F.col(a) + F.col(f"t{a}")).alias(f"to_{a}") for a in "xy"], "confidence")
