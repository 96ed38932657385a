"""What must hold of keys and joins before anything is written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factview.errors import ComponentColumnsError, ComponentKeyError, OrphanFactsError
from factview.functions.names import column
from factview.operators import normalize
from factview.plans.manifest import Component, ComponentDataset, ContourDataset


def null_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows with a null in the key."""
    return df.where(reduce(or_, [column(c).isNull() for c in key]))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of several rows, with their counts."""
    return df.groupBy(*map(column, key)).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")


def check_component(df: DataFrame, one: Component) -> None:
    """Declared columns are there; the key has neither nulls nor repeats. One pass with partial sums."""
    needed = [*one.primary_key, *([one.priority] if one.priority else []), *(one.columns or ())]
    absent = sorted({c for c in needed if c not in df.columns})
    if absent:
        raise ComponentColumnsError(f"component {one.name!r}: its source lacks {absent}")
    if not one.primary_key:
        return
    grouped = df.groupBy(*map(column, one.primary_key)).agg(F.count(F.lit(1)).alias("_rows"))
    null = reduce(or_, [column(c).isNull() for c in one.primary_key])
    row = grouped.agg(
        F.coalesce(F.sum(F.when(null, F.col("_rows"))), F.lit(0)).alias("nulls"), F.count_if(~null & (F.col("_rows") > 1)).alias("repeats")
    ).first()
    if row["nulls"]:
        raise ComponentKeyError(f"component {one.name!r}: {row['nulls']} row(s) have a NULL in the primary key {list(one.primary_key)}")
    if row["repeats"]:
        raise ComponentKeyError(f"component {one.name!r}: {row['repeats']} primary key(s) {list(one.primary_key)} are duplicate")


def orphans(left: DataFrame, left_key: Sequence[str], right: DataFrame, right_key: Sequence[str]) -> DataFrame:
    """Distinct keys of the left that the right lacks; a null key is one, since it joins nothing."""
    keys = left.select(*[column(c).alias(f"k{i}") for i, c in enumerate(left_key)]).distinct()
    found = right.select(*[column(c).alias(f"r{i}") for i, c in enumerate(right_key)])
    return keys.join(found, [F.col(f"k{i}") == F.col(f"r{i}") for i in range(len(left_key))], "left_anti")


def contour_orphans(facts: DataFrame, contour: DataFrame, dataset: ContourDataset) -> DataFrame:
    """The compact facts without a contour."""
    rows, keys = normalize.compact(facts, dataset).alias("f"), normalize.zones(contour, dataset).alias("c")
    pairs = zip(dataset.fact_join_columns, dataset.contour_join_columns, strict=True)
    return rows.join(keys, [column(a, "f") == column(b, "c") for a, b in pairs], "left_anti")


def check_contours(facts: DataFrame, contour: DataFrame, dataset: ContourDataset) -> None:
    if n := contour_orphans(facts, contour, dataset).count():
        raise OrphanFactsError(f"dataset {dataset.name!r}: {n} compact fact row(s) have no contour in {dataset.contour_table!r}")


def check_joins(dataset: ComponentDataset, components: Mapping[str, DataFrame]) -> None:
    """No inner join may lose rows; left joins keep them and templates are the author's own."""
    for join in dataset.joins:
        if join.type == "inner":
            left = join.left or dataset.base
            n = orphans(components[left], [a for a, _ in join.on], components[join.component], [b for _, b in join.on]).count()
            if n:
                raise OrphanFactsError(f"dataset {dataset.name!r}: {n} key(s) of {left!r} are not in {join.component!r}; an inner join would lose rows (declare `type: left` to keep them)")


def check_values(df: DataFrame, rules: Mapping[str, str]) -> dict[str, int]:
    """How many rows fail each named SQL condition (null counts as failing), in one pass."""
    if not rules:
        return {}
    row = df.agg(*[F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias(f"n{k}") for k, rule in enumerate(rules.values())]).first()
    return {name: row[f"n{k}"] for k, name in enumerate(rules)}
