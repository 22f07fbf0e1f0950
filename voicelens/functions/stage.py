"""Plan barriers: values that are computed once although several expressions use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage(df: DataFrame, *computed: str) -> DataFrame:
    """Keep the optimizer from inlining computed arrays into later lambdas.

    Catalyst's CollapseProject inlines a column that is referenced once into
    its consumer, also when that reference sits inside a lambda, where it would
    then be re-evaluated for every array element.  A one-element ``explode``
    is a Generate node, across which projections are not collapsed; it costs
    one row copy and no shuffle.  Only the ``computed`` columns (all, if none
    are named) go through it; filters and pruning on the others pass below it.
    """
    if not computed:
        return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_staged")).select("_staged.*")
    others = [c for c in df.columns if c not in computed]
    packed = df.select(*others, F.explode(F.array(F.struct(*computed))).alias("_staged"))
    return packed.select(*[F.col(f"_staged.{c}").alias(c) if c in computed else F.col(c) for c in df.columns])


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, inside lambdas too."""
    return F.element_at(F.transform(F.array(value), body), 1)
