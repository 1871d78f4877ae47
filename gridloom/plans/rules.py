"""Rules of one's own, by name, beside those that are built in.

Survivorship is a priority of source types, an aggregation a column, a spatial rule a function of tables: all
stay expressions that Spark plans.  A temporal rule that no expression states is a Python function from a row
to months; it becomes a table function (UDTF) over the events, partitioned by event, which SQL can call too.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..operators import expand, gridagg, resolve

#: A row's values to (month's first day, values that replace the row's) of each month.
MonthRule = Callable[[Mapping[str, object]], Iterable[tuple[datetime.date, Mapping[str, object]]]]


def _new(kind: str, name: str, known) -> None:
    if name in known:
        raise ValueError(f"{kind} {name!r} is there already")


def survivorship(name: str, priorities: Mapping[str, int] | Callable[[Column], Column]) -> None:
    """A survivorship rule: priorities of source types (0 for others), or a function from the column of source
    types to one of priorities."""
    _new("rule", name, resolve.SURVIVORSHIP)
    resolve.SURVIVORSHIP[name] = priorities


def aggregation(name: str, column: Callable[[Column, Column | None], Column]) -> None:
    """An aggregation of features: (condition, value) to an aggregate column."""
    _new("aggregation", name, gridagg.AGGREGATIONS)
    gridagg.AGGREGATIONS[name] = column


def spatial(name: str, place: Callable[[DataFrame, DataFrame, DataFrame | None], DataFrame]) -> None:
    """A spatial rule: (rows by month, current rows of the store, polygons or None) to rows, which may have
    ``_spatial_distributed``."""
    _new("spatial rule", name, expand.SPATIAL)
    expand.SPATIAL[name] = place


def temporal(name: str, months: MonthRule, amounts: Sequence[str] = expand.AMOUNTS) -> None:
    """A temporal rule: a function from a row to its months."""
    _new("temporal rule", name, {*expand.TEMPORAL, *expand.TABLE_RULES})
    expand.TABLE_RULES[name] = month_function(months, amounts)


def month_function(months: MonthRule, amounts: Sequence[str] = expand.AMOUNTS):
    """A table function of a rule: the table's columns, amounts as doubles, and ``date_month``."""
    wanted = tuple(amounts)

    @F.udtf
    class Months:
        @staticmethod
        def analyze(table: AnalyzeArgument) -> AnalyzeResult:
            if not isinstance(table.dataType, T.StructType) or not table.isTable:
                raise ValueError("a temporal rule takes a table")
            fields = [T.StructField(f.name, T.DoubleType() if f.name in wanted else f.dataType) for f in table.dataType.fields if f.name != "date_month"]
            return AnalyzeResult(T.StructType([*fields, T.StructField("date_month", T.DateType())]))

        def eval(self, row):
            values = row.asDict()
            values.pop("date_month", None)
            for month, parts in months(values):
                out = values | dict(parts)
                yield (*(float(v) if n in wanted and v is not None else v for n, v in ((n, out[n]) for n in values)), month)

    return Months


def register_sql(spark: SparkSession, name: str) -> None:
    """Let SQL call a temporal rule: ``SELECT * FROM name(TABLE(events) PARTITION BY id)``."""
    if name not in expand.TABLE_RULES:
        raise KeyError(f"no temporal rule {name!r} of rows; there are {sorted(expand.TABLE_RULES)}")
    spark.udtf.register(name, expand.TABLE_RULES[name])
