"""Where a pattern matches in a text, with DataFrame functions only.

``split`` and ``regexp_extract_all`` walk the same leftmost non-overlapping
matches, so the lengths of pieces and matches, summed in turn, are the offsets.
Sums run in blocks: appending to one array for each match would take time with
the square of their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"
SPAN_IN_CONTEXT = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
#: Items of a block of running sums.
BLOCK = 128
NOWHERE = 2**31 - 1


def _blocks(values: Column, op: Callable[[Column, Column], Column], first: int) -> Column:
    """Running results within blocks; each block has ``first`` before its own."""
    begins = F.sequence(F.lit(1), F.size(values), F.lit(BLOCK))
    grow = lambda held, x: F.concat(held, F.array(op(F.element_at(held, -1), x)))
    return F.transform(begins, lambda k: F.aggregate(F.slice(values, k, F.lit(BLOCK)), F.array(F.lit(first)), grow))


def _joined(blocks: Column, op: Callable[[Column, Column], Column], first: int) -> Column:
    """The running results over all blocks; ``blocks`` must be a plain column."""
    grow = lambda held, b: F.concat(held, F.array(op(F.element_at(held, -1), F.element_at(b, -1))))
    offsets = F.aggregate(blocks, F.array(F.lit(first)), grow)
    moved = lambda b, o: F.transform(F.slice(b, F.lit(2), F.lit(BLOCK)), lambda x: op(o, x))
    return F.flatten(F.zip_with(blocks, F.slice(offsets, F.lit(1), F.size(blocks)), moved))


def running(rows: DataFrame, columns: dict[str, str], op: Callable[[Column, Column], Column], first: int) -> DataFrame:
    """Adds, for each name, the running result of ``op`` over an array of int; null stays null, empty arrays must be null."""
    rows = rows.withColumns({f"{k}__b": _blocks(F.col(v), op, first) for k, v in columns.items()})
    return rows.withColumns({k: _joined(F.col(f"{k}__b"), op, first) for k in columns}).drop(*[f"{k}__b" for k in columns])


def _plus(a: Column, b: Column) -> Column:
    return a + b


def located(docs: DataFrame, text: str, patterns: dict[str, str], context: int = 0) -> DataFrame:
    """Adds, under each name, the pattern's matches as (start, end, value): code points, end exclusive.

    With ``context``, spans have ``before``, up to so many characters between
    the match before and this one, and ``after``, the character that follows.
    """
    any_ = {k: F.size(f"_m_{k}") > 0 for k in patterns}
    found = docs.withColumns({f"_m_{k}": F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)) for k, p in patterns.items()})
    found = found.withColumns({f"_p_{k}": F.when(any_[k], F.split(F.col(text), p, -1)) for k, p in patterns.items()})
    step = lambda m, p: F.length(m) + F.length(p)
    found = found.withColumns({f"_s_{k}": F.when(any_[k], F.zip_with(f"_m_{k}", F.slice(f"_p_{k}", F.lit(1), F.size(f"_m_{k}")), step)) for k in patterns})
    found = running(found, {f"_e_{k}": f"_s_{k}" for k in patterns}, _plus, 0)

    def spans(k: str) -> Column:
        n = F.size(f"_m_{k}")
        if not context:
            each = lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("value"))
            return F.zip_with(f"_e_{k}", f"_m_{k}", each)
        around = F.zip_with(F.slice(f"_p_{k}", F.lit(1), n), F.slice(f"_p_{k}", F.lit(2), n), lambda b, a: F.struct(b.alias("b"), a.alias("a")))
        around = F.zip_with(f"_m_{k}", around, lambda m, p: F.struct(m.alias("m"), p["b"].alias("b"), p["a"].alias("a")))
        each = lambda e, x: F.struct(
            (e - F.length(x["m"])).alias("start"), e.alias("end"), x["m"].alias("value"), F.right(x["b"], F.lit(context)).alias("before"), F.left(x["a"], F.lit(1)).alias("after")
        )
        return F.zip_with(f"_e_{k}", around, each)

    none = F.array().cast(SPAN_IN_CONTEXT if context else SPAN)
    found = found.withColumns({k: F.when(any_[k], spans(k)).otherwise(none) for k in patterns})
    return found.drop(*[f"_{x}_{k}" for x in "mpse" for k in patterns])


def apart(rows: DataFrame, names: list[str], others: list[str]) -> DataFrame:
    """Keeps, of each named column's spans, those that overlap none of the other columns' spans.

    Spans and others are sorted together; a span is free if no other one that
    begins before it reaches into it and the next one begins after its end.
    """
    event = lambda x, own: F.struct(x["start"].alias("at"), own.alias("own"), x["end"].alias("end"), x.alias("span"))
    rows = rows.withColumn("_others", F.concat(*[F.transform(k, lambda y: event(y, F.lit(0))) for k in others]))
    for name in names:
        own = F.transform(name, lambda x: event(x, F.lit(1)))
        rows = rows.withColumn("_events", F.when((F.size(name) > 0) & (F.size("_others") > 0), F.array_sort(F.concat("_others", own))))
        rows = rows.withColumns(
            {
                "_reach": F.transform("_events", lambda x: F.when(x["own"] == 0, x["end"]).otherwise(0)),
                "_next": F.transform(F.reverse("_events"), lambda x: F.when(x["own"] == 0, x["at"]).otherwise(NOWHERE)),
            }
        )
        rows = running(running(rows, {"_to": "_reach"}, F.greatest, 0), {"_from": "_next"}, F.least, NOWHERE)
        met = F.zip_with("_to", F.reverse("_from"), lambda a, b: F.struct(a.alias("to"), b.alias("from")))
        met = F.zip_with("_events", met, lambda x, m: F.when((x["own"] == 1) & (m["to"] <= x["at"]) & (m["from"] >= x["end"]), x["span"]))
        rows = rows.withColumn(name, F.when(F.col("_events").isNull(), F.col(name)).otherwise(F.filter(met, lambda x: x.isNotNull())))
    return rows.drop("_others", "_events", "_reach", "_next", "_to", "_from")


def written(kind: str, spans: Column) -> Column:
    """kind:start:end of each span."""
    return F.transform(spans, lambda x: F.concat(F.lit(f"{kind}:"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string")))
