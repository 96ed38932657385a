"""Parting a wide table into compact facts, contours, zones and numbered parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factview.functions.names import column
from factview.plans.manifest import PART_COLUMN, Component, ContourDataset


def project(df: DataFrame, names: list[str] | tuple[str, ...]) -> DataFrame:
    return df.select(*map(column, names))


def compact(facts: DataFrame, dataset: ContourDataset) -> DataFrame:
    """The distinct facts without geometry; compact facts stay as they are."""
    return project(facts, dataset.compact_columns()).distinct()


def contours(source: DataFrame, dataset: ContourDataset) -> DataFrame:
    """The distinct contours; other columns are dropped first, so that labels do not tell rows apart."""
    return project(source, dataset.contour_columns()).distinct()


def zones(contour: DataFrame, dataset: ContourDataset) -> DataFrame:
    return project(contour, dataset.contour_join_columns).distinct()


def parts(contour: DataFrame, dataset: ContourDataset) -> DataFrame:
    """The contours with the number of each part within its zone, by geometry, nulls last."""
    order = Window.partitionBy(*map(column, dataset.contour_join_columns)).orderBy(column(dataset.geometry_column).asc_nulls_last())
    numbered = contours(contour, dataset).withColumn(PART_COLUMN, F.row_number().over(order).cast("int"))
    return project(numbered, (*dataset.contour_join_columns, PART_COLUMN, *[c for c in dataset.contour_columns() if c not in dataset.contour_join_columns]))


def component(source: DataFrame, one: Component) -> DataFrame:
    return source if one.columns is None else project(source, one.columns)


def first_by_priority(rows: DataFrame, keys: list[str], priority: list[str]) -> DataFrame:
    """For each key the row that comes first by the priority columns (nulls last), one even among ties."""
    order = [column(p).asc_nulls_last() for p in priority]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*map(column, keys)).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def total_order(df: DataFrame, first: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Sorted by all columns, the named ones first, nulls last."""
    names = [*first, *[c for c in df.columns if c not in first]]
    return df.orderBy(*[column(c).asc_nulls_last() for c in names])
