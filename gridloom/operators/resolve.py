"""From all vintages to one row an event: stale versions out, one survivor each, row filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.versions import version_key


def _bounds(store: DataFrame, kleene: bool) -> DataFrame:
    """One row: ``_last``, the last end of the annual rows, and ``_last9``, the last .9 version with a row
    that is current.  One scan: rows become one for each event and .9 version, then one for each event, then
    one for each .9 version."""
    kind, end = F.col("_source_type"), F.col("date_end")
    nine = F.when(kind == "dot9", version_key(F.col("_source_version")))
    known = F.max(kind == "annual").alias("known")
    facts = store.groupBy("id", nine.alias("nine")).agg(known, F.max(F.when(kind == "annual", end)).alias("last"), F.max(end).alias("end"), F.max(end.isNull()).alias("undated"))
    nines = F.collect_list(F.when(F.col("nine").isNotNull(), F.struct("nine", "end", "undated")))
    events = facts.groupBy("id").agg((F.max("known") & F.first("id").isNotNull()).alias("known"), F.max("last").alias("last"), nines.alias("nines"))
    rows = events.select("known", "last", F.explode_outer("nines").alias("n")).groupBy("n.nine").agg(
        F.max("last").alias("last"),
        F.max(F.when(F.col("known"), F.col("n.end"))).alias("known_end"),
        F.max(F.when(~F.col("known"), F.col("n.end"))).alias("new_end"),
        F.max(F.when(F.col("known"), F.col("n.undated"))).alias("known_undated"),
        F.max(F.when(~F.col("known"), F.col("n.undated"))).alias("new_undated"),
    )
    kept = lambda n: n["known_end"].isNotNull() | F.coalesce(n["new_end"] > F.col("_last"), F.col("_last").isNull() & n["new_end"].isNotNull())
    undated = lambda n: F.coalesce(n["known_undated"], F.lit(False)) | (F.col("_last").isNull() & F.coalesce(n["new_undated"], F.lit(False)))
    current = (lambda n: kept(n) | undated(n)) if kleene else kept
    one = rows.agg(F.max("last").alias("_last"), F.collect_list(F.when(F.col("nine").isNotNull(), F.struct(*rows.columns))).alias("_nines"))
    return one.select("_last", F.array_max(F.transform(F.filter("_nines", current), lambda n: n["nine"])).alias("_last9"))


def with_stale(store: DataFrame, kleene: bool = False) -> DataFrame:
    """Add ``_stale``: whether :func:`drop_stale` drops a row.  Two scans of the store, one of them of four
    columns; whether the annual has an event is asked over the event's rows, which :func:`survivors` needs
    together anyway."""
    annual = F.col("_source_type") == "annual"
    known = F.coalesce(F.max(annual).over(Window.partitionBy("id")), F.lit(False)) & F.col("id").isNotNull()
    later = F.coalesce(F.col("date_end") > F.col("_last"), F.col("_last").isNull())
    current = known | later
    if not kleene:
        current = current & F.col("date_end").isNotNull()
    last9 = (F.col("_source_type") != "dot9") | (version_key(F.col("_source_version")) == F.col("_last9"))
    kept = F.coalesce((annual | current) & last9, F.lit(False))
    return store.crossJoin(F.broadcast(_bounds(store, kleene))).withColumn("_stale", ~kept).drop("_last", "_last9")


def drop_stale(store: DataFrame, kleene: bool = False) -> DataFrame:
    """Rows that are annual, or of an event that the annual has, or later than all annual ends; and of
    the .9 versions only the last.

    With ``kleene`` off a non-annual row without end date is dropped even if the annual has its id.
    """
    return with_stale(store, kleene).where("not _stale").drop("_stale")


#: Priority of source types under each survivorship rule, by name (types not named share the priority 0) or as a
#: function of the column.
SURVIVORSHIP: dict[str, Mapping[str, int] | Callable[[Column], Column]] = {
    "annual_wins": {"annual": 1},
    "dot9_wins": {"dot9": 2, "annual": 1},
}


def _order(rule: str, ties: Sequence[Column | str]) -> list[Column | str]:
    if rule not in SURVIVORSHIP:
        raise KeyError(f"unknown rule {rule!r}; there are {sorted(SURVIVORSHIP)}")
    priorities, kind = SURVIVORSHIP[rule], F.col("_source_type")
    if callable(priorities):
        priority = priorities(kind)
    else:
        priority = F.lit(0)
        for name, value in priorities.items():
            priority = F.when(kind == name, value).otherwise(priority)
    return [priority.desc(), version_key(F.col("_source_version")).desc(), *ties]


def survivors(store: DataFrame, rule: str = "annual_wins", ties: Sequence[Column | str] = (), key: str = "id") -> DataFrame:
    """One row for each event: highest priority, then highest version, then first by ``ties``."""
    order = Window.partitionBy(key).orderBy(*_order(rule, ties))
    return store.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def with_status(store: DataFrame, stale_filter: bool = True, rule: str = "annual_wins", ties: Sequence[Column | str] = ()) -> DataFrame:
    """Add ``_status`` to every row: stale, superseded or survivor, as :func:`drop_stale` and
    :func:`survivors` together decide."""
    rows = with_stale(store) if stale_filter else store.withColumn("_stale", F.lit(False))
    first = F.row_number().over(Window.partitionBy("id").orderBy("_stale", *_order(rule, ties))) == 1
    status = F.when(F.col("_stale"), "stale").when(first, "survivor").otherwise("superseded")
    return rows.withColumn("_status", status).drop("_stale")


def passes(min_pgid: int | None = None, max_violence: int | None = None, exclude_precision: Sequence[int] = (), distributed: Column | None = None) -> Column:
    """Row filter after survivorship and distribution; a null violence type passes, distributed rows keep
    any location precision."""
    out = F.lit(True)
    if min_pgid is not None:
        out = out & (F.coalesce(F.col("priogrid_gid"), F.lit(0)) >= min_pgid)
    if max_violence is not None:
        out = out & (F.coalesce(F.col("type_of_violence"), F.lit(0)) <= max_violence)
    if exclude_precision:
        allowed = ~F.coalesce(F.col("where_prec").isin(list(exclude_precision)), F.lit(False))
        out = out & (allowed | F.coalesce(distributed, F.lit(False)) if distributed is not None else allowed)
    return out
