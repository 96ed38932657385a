"""SimHash fingerprints and blocks of bits, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 64


#: Hashes counted in a few digits before they are added to the wide counters.
GROUP = 15
GROUP_PLANES = 4


def _count(hashes: Column, planes: int) -> Column:
    """For each bit the number of hashes that have it, as binary digits c0, c1, ...: a word for each digit."""
    names = [f"c{k}" for k in range(planes)]

    def add(held: Column, h: Column) -> Column:
        out, carry = [], h
        for name in names:
            out.append(held[name].bitwiseXOR(carry).alias(name))
            carry = held[name].bitwiseAND(carry)
        return F.struct(*out)

    return F.aggregate(hashes, F.struct(*[F.lit(0).cast("bigint").alias(n) for n in names]), add)


def simhash(hashes: Column, planes: int) -> Column:
    """Bit by bit the majority over 64-bit hashes; ``hashes`` should be a plain column.

    The 64 counters are kept as binary digits, one word for each digit, so
    that a hash is added to all of them by a few word operations: first in
    groups of GROUP hashes, then group by group in ``planes`` digits. Up to
    2 ** planes - 1 hashes can be counted. An empty array gives 0.
    """
    names = [f"c{k}" for k in range(planes)]

    def add(held: Column, group: Column) -> Column:
        out, carry = [], F.lit(0).cast("bigint")
        for k, name in enumerate(names):
            if k < GROUP_PLANES:
                either = held[name].bitwiseXOR(group[name])
                out.append(either.bitwiseXOR(carry).alias(name))
                carry = held[name].bitwiseAND(group[name]).bitwiseOR(carry.bitwiseAND(either))
            else:
                out.append(held[name].bitwiseXOR(carry).alias(name))
                carry = held[name].bitwiseAND(carry)
        return F.struct(*out)

    def majority(held: Column) -> Column:
        half = F.shiftright(F.size(hashes), 1)
        above, equal = F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")
        for k in reversed(range(planes)):
            digit = F.negative(F.shiftright(half, k).bitwiseAND(F.lit(1)).cast("bigint"))
            above = above.bitwiseOR(equal.bitwiseAND(held[names[k]]).bitwiseAND(F.bitwise_not(digit)))
            equal = equal.bitwiseAND(F.bitwise_not(held[names[k]].bitwiseXOR(digit)))
        return above

    groups = F.transform(F.sequence(F.lit(1), F.greatest(F.size(hashes), F.lit(1)), F.lit(GROUP)), lambda k: _count(F.slice(hashes, k, F.lit(GROUP)), GROUP_PLANES))
    start = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in names])
    return F.aggregate(groups, start, add, majority)


def blocks(fingerprint: Column, radius: int) -> Column:
    """radius + 1 values, the block's number and its bits; within the radius, two fingerprints share one of them."""
    n = radius + 1
    cuts = [k * BITS // n for k in range(n + 1)]
    out = [
        F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).bitwiseOR(F.lit(k << (BITS // n + 1)))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]
    return F.array(*out)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
