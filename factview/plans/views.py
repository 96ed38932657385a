"""Views: declared joins as DataFrame plans, SQL templates as Spark SQL."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from factview.errors import ManifestError
from factview.functions.names import column, quoted
from factview.plans.manifest import PLACEHOLDER, ComponentDataset, ContourDataset, SelectItem


def pick_template(templates: Mapping[str, str] | Sequence[tuple[str, str]], dialect: str = "spark") -> str:
    """The template of the dialect, else the default one."""
    found = dict(templates)
    for name in (dialect, "default"):
        if name in found:
            return found[name]
    raise ManifestError(f"no view_sql for dialect {dialect!r} and no default")


def render_template(template: str, names: Mapping[str, str]) -> str:
    """``{component}`` replaced by its name; other braces stay, unknown components are refused."""
    unknown = sorted({n for n in PLACEHOLDER.findall(template) if n not in names})
    if unknown:
        raise ManifestError(f"view_sql references unknown component(s) {unknown}")
    return PLACEHOLDER.sub(lambda m: names[m[1]], template)


def resolve_select(dataset: ComponentDataset, columns: Mapping[str, Sequence[str]]) -> list[tuple[str, SelectItem]]:
    """(owner, item) for each output column.

    Without ``select``: the base's columns, then those of each join in order,
    the first of a name counts. A bare name belongs to the base if that has
    it, else to the one component that does.
    """
    order = [dataset.base, *(j.component for j in dataset.joins)]
    if not dataset.select:
        first: dict[str, str] = {}
        for owner in order:
            for name in columns[owner]:
                first.setdefault(name, owner)
        return [(owner, SelectItem(name, owner)) for name, owner in first.items()]
    out = []
    for item in dataset.select:
        owners = [item.component] if item.component else [o for o in order if item.column in columns[o]]
        owner = owners[0] if owners and (len(owners) == 1 or owners[0] == dataset.base) else None
        if owner is None:
            fault = "several components have it; name one with `from`" if owners else "no component has it"
            raise ManifestError(f"dataset {dataset.name!r}: select {item.column!r}: {fault}")
        if item.column not in columns[owner]:
            raise ManifestError(f"dataset {dataset.name!r}: component {owner!r} has no column {item.column!r}")
        out.append((owner, item))
    outputs = [item.output for _, item in out]
    twice = sorted({n for n in outputs if outputs.count(n) > 1})
    if twice:
        raise ManifestError(f"dataset {dataset.name!r}: duplicate output column(s) {twice}")
    return out


def join_plan(dataset: ComponentDataset, components: Mapping[str, DataFrame], drop_unused: bool = False) -> DataFrame:
    """The declared joins over the components.

    ``drop_unused`` leaves out many-to-one joins of which nothing is selected.
    That is right only where keys are proven unique and, for inner joins, no
    fact is an orphan, as for published components.
    """
    wanted = resolve_select(dataset, {n: components[n].columns for n in {dataset.base, *(j.component for j in dataset.joins)}})
    needed = {owner for owner, _ in wanted} | {dataset.base}
    kept = []
    for join in reversed(dataset.joins):
        one_row = not join.fan_out and set(r for _, r in join.on) == set(dataset.component(join.component).primary_key)
        if not drop_unused or join.component in needed or not one_row:
            needed |= {join.component, join.left or dataset.base}
            kept.append(join)
    out = components[dataset.base].alias(dataset.base)
    for join in reversed(kept):
        left = join.left or dataset.base
        on = [column(a, left) == column(b, join.component) for a, b in join.on]
        out = out.join(components[join.component].alias(join.component), on, join.type)
    return out.select(*[column(item.column, owner).alias(item.output) for owner, item in wanted])


def template_plan(spark: SparkSession, template: str, components: Mapping[str, DataFrame]) -> DataFrame:
    """The template's query over the components, which it sees under names of their own."""
    names = {}
    try:
        for name, df in components.items():
            view = f"factview_{uuid.uuid4().hex}_{name}"
            df.createOrReplaceTempView(view)
            names[name] = view
        return spark.sql(render_template(template, {n: quoted(v) for n, v in names.items()}))
    finally:  # the analysed plan holds the components, not the names
        for view in names.values():
            spark.catalog.dropTempView(view)


def view_plan(spark: SparkSession, dataset: ComponentDataset, components: Mapping[str, DataFrame], drop_unused: bool = False) -> DataFrame:
    if dataset.joins:
        return join_plan(dataset, components, drop_unused)
    return template_plan(spark, pick_template(dataset.view_sql), components)


def contour_plan(dataset: ContourDataset, facts: DataFrame, contours: DataFrame) -> DataFrame:
    """The wide table again: compact facts joined with their contours, in the declared column order."""
    pairs = zip(dataset.fact_join_columns, dataset.contour_join_columns, strict=True)
    joined = facts.alias("f").join(contours.alias("c"), [column(a, "f") == column(b, "c") for a, b in pairs], "inner")
    return joined.select(*[column(n, "c" if n == dataset.geometry_column else "f") for n in dataset.output_columns])
