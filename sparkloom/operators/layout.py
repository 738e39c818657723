"""Sheets as grids of cells, and labels beside marks on a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid_rows(cells: DataFrame, sheet: str, row: str, col: str, value: str, label: str) -> DataFrame:
    """Rows below a sheet's header as maps of header text to value.

    The header is the first row with a cell that reads ``label``; a sheet without one takes the row above its first number.
    Of equal header texts the leftmost column counts; a sheet without label and number gives no rows.
    """
    number = F.when(F.col(value).try_cast("double").isNotNull(), F.col(row))
    heads = cells.groupBy(sheet).agg(F.coalesce(F.min(F.when(F.col(value) == label, F.col(row))), F.min(number) - 1).alias("__head"))
    placed = cells.join(heads, sheet)
    names = placed.where(F.col(row) == F.col("__head")).where(F.col(value).isNotNull()).groupBy(sheet, F.col(value).alias("__name")).agg(F.min(col).alias(col))
    below = placed.where(F.col(row) > F.col("__head")).join(names, [sheet, col])
    return below.groupBy(sheet, row).agg(F.first("__head").alias("head"), F.map_from_entries(F.collect_list(F.struct("__name", value))).alias("fields"))


def nearest_labels(marks: DataFrame, labels: DataFrame, page: str, reach: int, aside: int, most: int = 60) -> DataFrame:
    """Each mark's label by least ``dx + 2 dy`` among those to its right, with up to two lines below it joined on.

    ``marks`` and ``labels`` hold the page, ``id``, ``x`` and ``y``, labels ``text`` also. A page with more than
    ``most`` labels is no legend and gives none (W11), so what a row gathers is bounded. Ties go to the smaller id.
    """
    counts = labels.groupBy(page).agg(F.count("*").alias("__n")).where(F.col("__n") <= most).drop("__n")
    gathered = labels.join(counts, page, "left_semi").groupBy(page).agg(F.collect_list(F.struct("id", "x", "y", "text")).alias("__labels"))
    away = lambda a, b: F.abs(a - b)

    def scored(label: Column) -> Column:
        score = label["x"] - F.col("x") + 2 * away(label["y"], F.col("y"))
        return F.struct(score.alias("score"), label["id"].alias("id"), label["x"].alias("x"), label["y"].alias("y"), label["text"].alias("text"))

    right = F.filter("__labels", lambda t: (t["x"] >= F.col("x")) & (away(t["y"], F.col("y")) <= reach))
    best = marks.join(gathered, page, "left").withColumn("__best", F.array_min(F.transform(right, scored)))
    under = F.filter("__labels", lambda t: (t["y"] > F.col("__best.y")) & (away(t["x"], F.col("__best.x")) <= aside))
    ordered = F.array_sort(F.transform(under, lambda t: F.struct(t["y"].alias("y"), t["id"].alias("id"), t["text"].alias("text"))))
    joined = F.concat_ws(" ", F.col("__best.text"), F.transform(F.slice(ordered, 1, 2), lambda t: t["text"]))
    label = F.when(F.col("__best").isNotNull(), joined)
    return best.select(*marks.columns, F.col("__best.score").alias("score"), label.alias("label"))
