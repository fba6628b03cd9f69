"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule`` applied to ``c``, with ``c`` computed once.

    A rule that looks at its input in many branches would repeat the input's whole
    expression in each. Generated code then outgrows what the JVM compiles, and
    with it the loop over tokens it shares a stage with. As the variable of a
    higher-order function the input is a name, and the rule stays out of that loop.
    """
    return F.element_at(F.transform(F.array(c), rule), 1)
