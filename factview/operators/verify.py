"""Proof that two relations hold the same rows, as multisets.

Each relation is summed once per key (or per group of exact values): counts,
sums of row hashes, and for inexact columns their extremes and sums. The two
small sides meet in a full outer join. Nothing but mismatch counts and a few
sample rows reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factview.functions.hashing import close, row_hash, summed, text_hash
from factview.functions.names import column
from factview.functions.types import INEXACT


@dataclass(frozen=True)
class SchemaDifference:
    position: int
    original: tuple[str, str] | None
    view: tuple[str, str] | None


@dataclass(frozen=True)
class Equivalence:
    """The result of comparing key by key."""

    original_rows: int
    view_rows: int
    mismatched_keys: int
    keys: int
    batches: int
    schema: tuple[SchemaDifference, ...] = ()

    @property
    def equivalent(self) -> bool:
        return not self.mismatched_keys and not self.schema and self.original_rows == self.view_rows


@dataclass(frozen=True)
class ViewEquivalence:
    """The result of comparing groups of exact values, with a tolerance for inexact ones."""

    reference_rows: int
    view_rows: int
    missing_columns: tuple[str, ...] = ()
    extra_columns: tuple[str, ...] = ()
    groups: int = 0
    mismatched_groups: int = 0
    batches: int = 0
    inexact_columns: tuple[str, ...] = ()
    sample: tuple[dict, ...] = field(default=())

    @property
    def equivalent(self) -> bool:
        return self.reference_rows == self.view_rows and not (self.missing_columns or self.extra_columns or self.mismatched_groups)


def compare_schemas(original: DataFrame, view: DataFrame) -> tuple[SchemaDifference, ...]:
    """Positions where name or type differ."""
    left = [(f.name, f.dataType.simpleString()) for f in original.schema.fields]
    right = [(f.name, f.dataType.simpleString()) for f in view.schema.fields]
    n = max(len(left), len(right))
    pairs = zip(left + [None] * (n - len(left)), right + [None] * (n - len(right)), strict=True)
    return tuple(SchemaDifference(k, a, b) for k, (a, b) in enumerate(pairs) if a != b)


def key_summary(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """For each key, null being one: rows and the sum of their hashes."""
    return df.groupBy(column(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"), summed(text_hash(columns)).alias("_sum"))


def compare_keyed(original: DataFrame, view: DataFrame, columns: Sequence[str] | None = None, key: str | None = None, batch_size: int = 1000, types: bool = True, progress: Callable[[int, int], None] | None = None) -> Equivalence:
    """Whether both hold the same rows for every key; ``batches`` tells the work as batches of keys and one of null."""
    columns = list(columns or original.columns)
    key = key or columns[0]
    schema = compare_schemas(original.select(*map(column, columns)), view.select(*map(column, columns))) if types else ()
    a = key_summary(original, columns, key).select(F.col("_key").cast("string").alias("k"), F.col("_rows").alias("ra"), F.col("_sum").alias("sa"))
    b = key_summary(view, columns, key).select(F.col("_key").cast("string").alias("k2"), F.col("_rows").alias("rb"), F.col("_sum").alias("sb"))
    both = a.join(b, F.col("k").eqNullSafe(F.col("k2")), "full_outer")
    same = F.coalesce((F.col("ra") == F.col("rb")) & (F.col("sa") == F.col("sb")), F.lit(False))
    row = both.agg(
        F.coalesce(F.sum("ra"), F.lit(0)).alias("ra"), F.coalesce(F.sum("rb"), F.lit(0)).alias("rb"), F.count_if(~same).alias("bad"),
        F.count_if(F.coalesce("k", "k2").isNotNull()).alias("keys"),
    ).first()
    batches = -(-row["keys"] // batch_size) + 1
    if progress:
        progress(batches, batches)
    return Equivalence(row["ra"], row["rb"], row["bad"], row["keys"], batches, schema)


def inexact(columns: Sequence[str], *relations: DataFrame) -> list[str]:
    """Columns that are floating or decimal in any of the relations."""
    return [c for c in columns if any(isinstance(r.schema[c].dataType, INEXACT) for r in relations if c in r.columns)]


def group_summary(df: DataFrame, exact: Sequence[str], floats: Sequence[str]) -> DataFrame:
    """For each hash of the exact columns: rows and, per inexact column, count, extremes, sum and sum of sizes."""
    sums: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for k, name in enumerate(floats):
        x = column(name).cast("double")
        sums += [F.count(x).alias(f"n{k}"), F.min(x).alias(f"lo{k}"), F.max(x).alias(f"hi{k}"), F.sum(x).alias(f"sum{k}"), F.sum(F.abs(x)).alias(f"size{k}")]
    return df.groupBy(row_hash([column(c).cast("string") for c in exact]).alias("h")).agg(*sums)


def compare_relations(reference: DataFrame, view: DataFrame, columns: Sequence[str] | None = None, tolerance: float = 1e-9, key_column: str | None = None, key_batch_size: int = 1000, sample: int = 5) -> ViewEquivalence:
    """Whether both hold the same rows, up to a relative tolerance in inexact columns.

    Sums may differ by the tolerance times the sum of sizes, so that values
    that cancel do not make it stricter. Row counts are told even where
    columns differ.
    """
    names = list(columns or reference.columns)
    missing = tuple(c for c in names if c not in view.columns or c not in reference.columns)
    extra = () if columns else tuple(c for c in view.columns if c not in names)
    if missing or extra:
        return ViewEquivalence(reference.count(), view.count(), missing, extra)
    floats = inexact(names, reference, view)
    exact = [c for c in names if c not in floats]
    a, b = group_summary(reference, exact, floats).alias("a"), group_summary(view, exact, floats).alias("b")
    same = F.col("a.rows") == F.col("b.rows")
    for k in range(len(floats)):
        same &= F.col(f"a.n{k}") == F.col(f"b.n{k}")
        for part in ("lo", "hi"):
            same &= close(F.col(f"a.{part}{k}"), F.col(f"b.{part}{k}"), tolerance)
        same &= close(F.col(f"a.sum{k}"), F.col(f"b.sum{k}"), tolerance, F.greatest(f"a.size{k}", f"b.size{k}"))
    both = a.join(b, F.col("a.h") == F.col("b.h"), "full_outer").withColumn("_same", F.coalesce(same, F.lit(False)))
    row = both.agg(
        F.coalesce(F.sum("a.rows"), F.lit(0)).alias("ra"), F.coalesce(F.sum("b.rows"), F.lit(0)).alias("rb"), F.count(F.lit(1)).alias("groups"), F.count_if(~F.col("_same")).alias("bad")
    ).first()
    some: tuple[dict, ...] = ()
    if row["bad"] and sample:
        bad = both.where(~F.col("_same")).select(F.coalesce("a.h", "b.h").alias("h"), F.col("a.rows").alias("reference_rows"), F.col("b.rows").alias("view_rows"))
        some = tuple(r.asDict() for r in bad.orderBy("h").limit(sample).collect())
    batches = 1
    if key_column is not None:
        keys = reference.select(column(key_column)).union(view.select(column(key_column))).where(column(key_column).isNotNull()).distinct().count()
        batches = -(-keys // key_batch_size) + 1
    return ViewEquivalence(row["ra"], row["rb"], (), (), row["groups"], row["bad"], batches, tuple(floats), some)


def same_multiset(a: DataFrame, b: DataFrame) -> bool:
    """The plain way for small relations: nothing is left of either without the other."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
