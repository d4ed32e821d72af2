"""Column functions: typed extraction from JSON payloads (X*) and value text for DML (F*)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def pinned(c: Column) -> Column:
    """Evaluate an expensive expression once per row.

    Catalyst may copy a projected expression into every place that uses it (project
    collapsing, filters pushed below the projection). For a JSON parse or a rendered
    statement used many times that multiplies the work per row. A nondeterministic
    identity (the partition id is never negative) stops both rewrites for this column only."""
    return F.when(F.spark_partition_id() >= F.lit(0), c)


def pinned_apart(c: Column) -> Column:
    """``pinned`` for a long expression (hundreds of branches). Whole-stage code puts a projection into one method, and the JVM
    never compiles a method of more than 8,000 bytes of code. A condition with a lambda (one element, a comparison) keeps the
    projection out of the stage's method: its code is then cut into small ones."""
    return F.when(F.exists(F.array(F.spark_partition_id()), lambda p: p >= F.lit(0)), c)


def bind(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once (a one-element ``transform``), however often the body uses it."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))
