"""Row digests for multiset comparison and group fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from factview.functions.names import column


def row_hash(columns: Sequence[Column]) -> Column:
    """A 64-bit hash of values and of which of them are null.

    ``xxhash64`` alone skips nulls, so (null, 'a') and ('a', null) would be
    equal; the flags between the values tell them apart.
    """
    parts = [x for c in columns for x in (c.isNull(), c)]
    return F.xxhash64(*parts) if parts else F.xxhash64(F.lit(0))


def summed(hashes: Column) -> Column:
    """A sum of 64-bit hashes that cannot overflow; 0 for no rows."""
    return F.coalesce(F.sum(hashes.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))


def bucket(hashed: Column, buckets: int) -> Column:
    """A bucket from 0 on, for negative hashes too."""
    return F.pmod(hashed, F.lit(buckets))


def text_hash(names: Sequence[str]) -> Column:
    """A row hash of the columns' texts, so that equal values of different types agree."""
    return row_hash([column(n).cast("string") for n in names])


def close(x: Column, y: Column, tolerance: float, scale: Column | None = None) -> Column:
    """Both null, equal, or apart by at most tolerance times the larger size (or ``scale``)."""
    size = F.greatest(F.abs(x), F.abs(y)) if scale is None else scale
    return (x.isNull() & y.isNull()) | F.coalesce(x == y, F.lit(False)) | F.coalesce(F.abs(x - y) <= tolerance * size, F.lit(False))
