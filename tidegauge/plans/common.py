"""Helpers to state a query twice: as Spark operators and as SQL for checking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame) -> DataFrame:
    """Doubles and floats to six decimals, shifted off decimal ties."""
    return df.select(*[
        F.round(F.col(c).cast("double") + F.lit(1e-9), 6).alias(c) if t in ("double", "float") else F.col(c)
        for c, t in df.dtypes])


def r(expr: str, name: str) -> str:
    return f"round(cast({expr} as double) + 1e-9, 6) as {name}"


def five_sql(expr: str, suffix: str, pop: bool) -> str:
    s = f"_{suffix}" if suffix else ""
    kind = "pop" if pop else "samp"
    return ", ".join([r(f"max({expr})", f"high{s}"), r(f"min({expr})", f"low{s}"), r(f"avg({expr})", f"mean{s}"),
                      r(f"var_{kind}({expr})", f"variance{s}"), r(f"stddev_{kind}({expr})", f"stdev{s}")])


def plain_five(expr: str, suffix: str, pop: bool) -> str:
    kind = "pop" if pop else "samp"
    return (f"max({expr}) as high_{suffix}, min({expr}) as low_{suffix}, avg({expr}) as mean_{suffix}, "
            f"var_{kind}({expr}) as variance_{suffix}, stddev_{kind}({expr}) as stdev_{suffix}")
