"""Registered queries over the star-schema test tables, each with SQL that gives the same rows.

The tables stand for the engine's own inputs: line items are event versions (an order is an event, its
return flag the source type, its line number the version), suppliers are cells, nations and regions the
levels above them, parts a raster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import axes, versions
from ..operators import analytics, assemble, conserve, cover, expand, gridagg, interp, quality, query, resolve, spatial, store
from ..sources import cube, difftree, snapshots
from . import incremental, registry

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def registered(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        _QUERIES[name or fn.__name__] = fn
        if sql:
            _SQL[name or fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---------------------------------------------------------------- projections of the test tables


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


TIES = ("part", "cell", "date_end", "best", "nth")


def events(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    kind = F.when(c("l_returnflag") == "A", "annual").when(c("l_returnflag") == "N", "dot9").otherwise("candidate")
    middle = F.when(c("l_returnflag") == "A", "25.").when(c("l_returnflag") == "N", "25.9.").otherwise("25.0.")
    return table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("id"),
        kind.alias("_source_type"),
        F.concat(middle, c("l_linenumber").cast("string")).alias("_source_version"),
        c("l_quantity").cast("long").alias("best"),
        F.floor(c("l_quantity") / 2).alias("low"),
        (c("l_quantity") * 2).cast("long").alias("high"),
        ((c("l_suppkey") * 37 % 3600) / F.lit(20.0) - 90).alias("latitude"),
        ((c("l_suppkey") * 101 % 7200) / F.lit(20.0) - 180).alias("longitude"),
        c("l_shipdate").cast("date").alias("date_end"),
        (c("l_linenumber") % 3 + 1).alias("type_of_violence"),
        (c("l_partkey") % 7 + 1).cast("int").alias("where_prec"),
        (c("l_partkey") % 5 + 1).cast("int").alias("date_prec"),
        c("l_partkey").alias("part"),
        c("l_suppkey").alias("cell"),
        c("l_linenumber").alias("nth"),
        axes.month_id(c("l_shipdate")).alias("month_id"),
    )


EV = """
ev AS (
  SELECT l_orderkey AS id,
         CASE l_returnflag WHEN 'A' THEN 'annual' WHEN 'N' THEN 'dot9' ELSE 'candidate' END AS _source_type,
         CASE l_returnflag WHEN 'A' THEN '25.' WHEN 'N' THEN '25.9.' ELSE '25.0.' END || l_linenumber AS _source_version,
         CASE l_returnflag WHEN 'A' THEN [25, l_linenumber] WHEN 'N' THEN [25, 9, l_linenumber] ELSE [25, 0, l_linenumber] END AS version_key,
         CAST(l_quantity AS BIGINT) AS best, CAST(floor(l_quantity / 2) AS BIGINT) AS low, CAST(l_quantity * 2 AS BIGINT) AS high,
         (l_suppkey * 37 % 3600) / CAST(20 AS DOUBLE) - 90 AS latitude,
         (l_suppkey * 101 % 7200) / CAST(20 AS DOUBLE) - 180 AS longitude,
         CAST(l_shipdate AS DATE) AS date_end,
         l_linenumber % 3 + 1 AS type_of_violence, CAST(l_partkey % 7 + 1 AS INTEGER) AS where_prec, CAST(l_partkey % 5 + 1 AS INTEGER) AS date_prec,
         l_partkey AS part, l_suppkey AS cell, l_linenumber AS nth,
         CAST((year(l_shipdate) - 1980) * 12 + month(l_shipdate) AS INTEGER) AS month_id
  FROM lineitem
)"""

CELL = """
cells AS (
  SELECT month_id, cell AS pgid, s_nationkey AS country_id, CAST(sum(best) AS BIGINT) AS best, count(*) AS n
  FROM ev JOIN supplier ON cell = s_suppkey GROUP BY ALL
)"""


def cell_months(spark: SparkSession, sf: str) -> DataFrame:
    """(month_id, pgid, country_id, best, n): suppliers as cells, nations as countries."""
    country = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cell"), F.col("s_nationkey").alias("country_id"))
    sums = events(spark, sf).groupBy("month_id", "cell").agg(F.sum("best").alias("best"), F.count(F.lit(1)).alias("n"))
    return sums.join(country, "cell").select("month_id", F.col("cell").alias("pgid"), "country_id", "best", "n")


def cell_regions(spark: SparkSession, sf: str) -> DataFrame:
    """(region, nation, pgid)."""
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.col("s_suppkey").alias("pgid"), "s_nationkey")


def yearly(spark: SparkSession, sf: str) -> DataFrame:
    """(key, year, value): what each nation's customers ordered in a year."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    joined = o.join(c, o["o_custkey"] == c["c_custkey"])
    return joined.groupBy(F.col("c_nationkey").alias("key"), F.year("o_orderdate").alias("year")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))


YEARLY = """
yearly AS (
  SELECT c_nationkey AS key, CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
), months AS (SELECT CAST(m AS INTEGER) AS month_id FROM generate_series(175, 270) t(m))"""


def _axis(spark: SparkSession) -> DataFrame:
    return axes.months_between(spark, 175, 270)


def spans(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a start: the earlier of order and shipment, and the later as end."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("_o"))
    e = events(spark, sf).join(o, "id")
    return e.withColumns({"date_start": F.least("_o", "date_end"), "date_end": F.greatest("_o", "date_end")}).drop("_o")


SPANS = (
    EV
    + """, spans AS (
  SELECT ev.* EXCLUDE (date_end), least(CAST(o_orderdate AS DATE), date_end) AS date_start, greatest(CAST(o_orderdate AS DATE), date_end) AS date_end
  FROM ev JOIN orders ON id = o_orderkey
), spread AS (
  SELECT *, CAST((year(date_end) - year(date_start)) * 12 + month(date_end) - month(date_start) + 1 AS BIGINT) AS n_months FROM spans
)"""
)

# ---------------------------------------------------------------- the query and the grid


@registered(f"""
WITH {EV}, {CELL}
SELECT month_id, country_id, CAST(sum(best) AS DOUBLE) AS best, CAST(sum(n) AS DOUBLE) AS n
FROM cells WHERE month_id BETWEEN 193 AND 234 AND country_id > 0 AND country_id IN (
  SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = (SELECT min(r_name) FROM region))
GROUP BY ALL
""")
def country_month_sum(spark: SparkSession, sf: str) -> DataFrame:
    regions = cell_regions(spark, sf)
    first = regions.agg(F.min("region").alias("r")).head()["r"]
    region = query.region_cells(regions, [first])
    return query.load(cell_months(spark, sf), ["best", "n"], region, "1996", "1999-06", output="country_month")


_FEATURES_SQL = ", ".join(
    f"count(*) FILTER (type_of_violence = {code}) AS ged_{name}_count, CAST(coalesce(sum(best) FILTER (type_of_violence = {code}), 0) AS BIGINT) AS ged_{name}_best" for name, code in registry.VIOLENCE
)
PLACED = (
    EV
    + """, placed AS (
  SELECT ev.* EXCLUDE (month_id), CASE WHEN month_id BETWEEN 185 AND 250 THEN month_id END AS month_id,
         CASE WHEN latitude >= -90 AND latitude < 90 AND longitude >= -180 AND longitude < 180
              THEN CAST(floor((latitude + 90) / 0.5::DOUBLE) * 720 + floor((longitude + 180) / 0.5::DOUBLE) + 1 AS INTEGER) END AS pgid
  FROM ev
)"""
)


def placed_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf)
    return gridagg.place(rows.withColumnRenamed("month_id", "_month"), 185, 250, F.col("_month")).drop("_month")


@registered(f"WITH {PLACED} SELECT month_id, pgid, {_FEATURES_SQL} FROM placed WHERE pgid IS NOT NULL AND month_id IS NOT NULL GROUP BY month_id, pgid")
def grid_month_features(spark: SparkSession, sf: str) -> DataFrame:
    return gridagg.compile_grid(placed_events(spark, sf), registry.CONFLICT_FEATURES)


@registered(f"""
WITH {PLACED} SELECT month_id, pgid, CAST(coalesce(max(high) FILTER (where_prec = 1), 0) AS BIGINT) AS max_high, count(*) AS n
FROM placed WHERE pgid IS NOT NULL AND month_id IS NOT NULL GROUP BY month_id, pgid
""")
def grid_month_maxima(spark: SparkSession, sf: str) -> DataFrame:
    specs = [gridagg.FeatureSpec("max_high", "max_field", "high", {"where_prec": 1}), gridagg.FeatureSpec("n")]
    return gridagg.compile_grid(placed_events(spark, sf), specs)


@registered(f"""
WITH {PLACED} SELECT count(*) AS n_input, count(*) FILTER (pgid IS NOT NULL AND month_id IS NOT NULL) AS n_placed,
  count(*) FILTER (pgid IS NULL) AS skipped_spatial, count(*) FILTER (pgid IS NOT NULL AND month_id IS NULL) AS skipped_temporal
FROM (SELECT * REPLACE (CASE WHEN cell % 10 = 0 THEN NULL ELSE pgid END AS pgid) FROM placed)
""")
def placement_accounting(spark: SparkSession, sf: str) -> DataFrame:
    edge = events(spark, sf).withColumn("latitude", F.when(F.col("cell") % 10 == 0, F.lit(90.0)).otherwise(F.col("latitude")))
    return gridagg.accounting(gridagg.place(edge.withColumnRenamed("month_id", "_month"), 185, 250, F.col("_month")))


@registered(f"WITH {EV} SELECT CAST(event_type AS VARCHAR) AS event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type IN (SELECT DISTINCT event_type FROM events ORDER BY 1 LIMIT 3) GROUP BY ALL")
def event_type_filter(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    types = [r[0] for r in e.select("event_type").distinct().orderBy("event_type").limit(3).collect()]
    return e.where(F.col("event_type").isin(types)).groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@registered("SELECT CAST((year(ts) - 1980) * 12 + month(ts) AS INTEGER) AS month_id, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def monthly_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.groupBy(axes.month_id(F.col("ts")).alias("month_id"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


# ---------------------------------------------------------------- versions and vintages

_CHOSEN = ["id", "_source_type", "_source_version", "best", "part"]


def _survivor_sql(priority: str) -> str:
    return f"""
WITH {EV}, r AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {priority} DESC, version_key DESC, part, cell, date_end, best, nth) AS k FROM ev
) SELECT id, _source_type, _source_version, best, part FROM r WHERE k = 1"""


@registered(_survivor_sql("CASE _source_type WHEN 'annual' THEN 1 ELSE 0 END"))
def survivorship_annual_wins(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.survivors(events(spark, sf), "annual_wins", TIES).select(*_CHOSEN)


@registered(_survivor_sql("CASE _source_type WHEN 'dot9' THEN 2 WHEN 'annual' THEN 1 ELSE 0 END"))
def survivorship_dot9_wins(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.survivors(events(spark, sf), "dot9_wins", TIES).select(*_CHOSEN)


@registered(f"""
WITH {EV}, a AS (SELECT max(date_end) AS last FROM ev WHERE _source_type = 'annual'), k AS (
  SELECT ev.* FROM ev, a WHERE _source_type = 'annual'
     OR ((id IN (SELECT id FROM ev WHERE _source_type = 'annual') OR date_end > last) AND date_end IS NOT NULL)
) SELECT id, _source_type, _source_version, best, part FROM k
WHERE _source_type <> 'dot9' OR version_key = (SELECT max(version_key) FROM k WHERE _source_type = 'dot9')
""")
def stale_version_filter(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.drop_stale(events(spark, sf)).select(*_CHOSEN)


@registered("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders) WHERE k = 1
""")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return store.latest_per_key(table(spark, sf, "orders"), "o_custkey", "o_orderdate", F.col("o_orderkey")).select("o_custkey", "o_orderkey", "o_totalprice")


@registered(f"""
WITH {EV}, s AS (SELECT DISTINCT id, _source_type FROM ev WHERE nth <= 2)
SELECT id, _source_type, count(*) AS n FROM ev b
WHERE nth > 2 AND NOT EXISTS (SELECT 1 FROM s WHERE s.id IS NOT DISTINCT FROM b.id AND s._source_type IS NOT DISTINCT FROM b._source_type)
GROUP BY ALL
""")
def vintage_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    fresh = store.new_vintages(e.where("nth > 2"), e.where("nth <= 2"), ("id", "_source_type"))
    return fresh.groupBy("id", "_source_type").agg(F.count(F.lit(1)).alias("n"))


@registered("""
WITH s AS (SELECT o_custkey, max(o_orderdate) AS t, 'store' AS side FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
b AS (SELECT o_custkey, max(o_orderdate) AS t, 'batch' AS side FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
SELECT coalesce(s.o_custkey, b.o_custkey) AS o_custkey, CASE WHEN s.t IS NULL OR b.t > s.t THEN 'batch' ELSE 'store' END AS side
FROM s FULL JOIN b ON s.o_custkey = b.o_custkey
""")
def upsert_latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    side = lambda parity, name: o.where(F.col("o_orderkey") % 2 == parity).groupBy("o_custkey").agg(F.max("o_orderdate").alias("t")).withColumn("side", F.lit(name))
    return store.upsert_latest(side(0, "store"), side(1, "batch"), "o_custkey", "t").select("o_custkey", "side")


@registered(f"WITH {EV} SELECT _source_type, _source_version, count(*) AS n_events, min(date_end) AS first, max(date_end) AS last FROM ev GROUP BY ALL")
def manifest_stats(spark: SparkSession, sf: str) -> DataFrame:
    return store.manifest(events(spark, sf), "date_end")


@registered("""
WITH v AS (SELECT DISTINCT '25.' || CAST(l_linenumber AS VARCHAR) AS version FROM lineitem UNION SELECT '25.x')
SELECT version, CASE WHEN version = '25.x' THEN 0 ELSE CAST(split_part(version, '.', 2) AS INTEGER) END AS last_part FROM v
""")
def version_keys(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "lineitem").select(F.concat(F.lit("25."), F.col("l_linenumber").cast("string")).alias("version")).distinct()
    v = v.unionByName(spark.createDataFrame([("25.x",)], "version string"))
    return v.select("version", F.element_at(versions.version_key(F.col("version")), -1).alias("last_part"))


@registered(f"""
WITH {EV} SELECT id, part, nth, best, CAST('annual' AS VARCHAR) AS kind, 'd1' AS digest FROM ev WHERE nth = 1
UNION ALL SELECT id, part, nth, NULL AS best, 'annual' AS kind, 'd1' AS digest FROM ev WHERE nth = 2
""")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    batch = store.append(e.where("nth = 1").select("id", "part", "nth", "best"), e.where("nth = 2").select("id", "part", "nth"))
    tagged = store.tag(batch, "annual", "25.1", "t0", "d1", "t1")
    return tagged.select("id", "part", "nth", "best", F.col("_source_type").alias("kind"), F.col("_harvest_digest").alias("digest"))


# ---------------------------------------------------------------- expansion

_SUMMARY = "best > 0 AND n_months > 1 AND best >= n_months"


def _split_sql(condition: str, amount: str) -> str:
    return f"""
WITH {SPANS}, r AS (SELECT *, ({condition}) AS split FROM spread), x AS (
  SELECT *, CASE WHEN split THEN n_months ELSE 1 END AS n FROM r
), e AS (SELECT x.*, CAST(k AS BIGINT) AS k FROM x, unnest(range(n)) t(k))
SELECT date_month, count(*) AS n_rows, round(sum({amount}), 4) AS best FROM (
  SELECT *, CAST(CASE WHEN split THEN date_trunc('month', date_start) + to_months(CAST(k AS INTEGER)) ELSE date_trunc('month', date_end) END AS DATE) AS date_month FROM e)
GROUP BY 1"""


def _split(rule: str, by_source: dict[str, str] | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = expand.split_months(spans(spark, sf), rule, by_source=by_source)
        return rows.groupBy("date_month").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("best"), 4).alias("best"))

    return run


registered(_split_sql("false", "best * 1.0::DOUBLE"), "split_date_end")(_split("date_end_only"))
registered(_split_sql("date_prec = 5", "CAST(best AS DOUBLE) / n"), "split_even")(_split("even_split"))
registered(_split_sql(_SUMMARY, "CASE WHEN n > 1 THEN ceil(CAST(best AS DOUBLE) / n) ELSE best END"), "split_ceil")(_split("ceil_split"))
registered(_split_sql(_SUMMARY, "CASE WHEN n > 1 THEN floor(CAST(best AS DOUBLE) / n) ELSE best END"), "split_floor")(_split("floor_split"))
registered(
    _split_sql(f"_source_type <> 'annual' AND {_SUMMARY}", "CASE WHEN n > 1 THEN ceil(CAST(best AS DOUBLE) / n) ELSE best END"), "split_by_source"
)(_split("ceil_split", {"annual": "date_end_only"}))

WEIGHTS = (
    EV
    + """, sums AS (SELECT cell, sum(best) AS amount FROM ev WHERE where_prec <= 3 GROUP BY 1), c AS (
  SELECT s_nationkey AS code, s_suppkey AS pgid, coalesce(amount, 0) AS amount FROM supplier LEFT JOIN sums ON s_suppkey = cell
), t AS (SELECT *, sum(amount) OVER (PARTITION BY code) AS total, count(*) OVER (PARTITION BY code) AS n FROM c), weights AS (
  SELECT code, pgid, CASE WHEN total > 0 THEN CAST(amount AS DOUBLE) / CAST(total AS DOUBLE) ELSE 1.0::DOUBLE / n END AS share FROM t WHERE total = 0 OR amount > 0
)"""
)


def _polygons(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("pgid"), F.col("s_nationkey").alias("code"))


def _weights(spark: SparkSession, sf: str) -> DataFrame:
    return expand.weight_map(events(spark, sf).withColumn("priogrid_gid", F.col("cell")), _polygons(spark, sf))


@registered(f"WITH {WEIGHTS} SELECT code, pgid, round(share, 9) AS share FROM weights")
def weight_map(spark: SparkSession, sf: str) -> DataFrame:
    return _weights(spark, sf).withColumn("share", F.round("share", 9))


_ALLOCATION = """
  f AS (SELECT *, CAST(floor(best * share) AS BIGINT) AS base FROM p), g AS (
  SELECT *, best - sum(base) OVER (PARTITION BY r) AS rest, count(*) OVER (PARTITION BY r) AS n, row_number() OVER (PARTITION BY r ORDER BY share DESC, pgid) AS k FROM f
), a AS (SELECT *, CAST(base + floor(rest / n::DOUBLE) + CASE WHEN k <= ((rest % n) + n) % n THEN 1 ELSE 0 END AS BIGINT) AS part_of FROM g)"""


@registered(f"""
WITH {WEIGHTS}, p AS (SELECT n_nationkey AS r, 1000 + n_nationkey AS best, pgid, share FROM nation JOIN weights ON code = n_nationkey), {_ALLOCATION}
SELECT CAST(r AS INTEGER) AS code, pgid, part_of AS allocated FROM a
""")
def remainder_allocation(spark: SparkSession, sf: str) -> DataFrame:
    rows = _weights(spark, sf).withColumn("best", F.col("code") + 1000)
    return rows.select(F.col("code").cast("int").alias("code"), "pgid", expand.allocate(rows, "best", "share", ["code"], F.col("pgid")).alias("allocated"))


@registered(f"""
WITH {WEIGHTS}, q AS (SELECT *, row_number() OVER () AS r FROM ev), p AS (
  SELECT r, best, s.s_nationkey AS code, w.pgid, share FROM q JOIN supplier s ON cell = s_suppkey JOIN weights w ON w.code = s.s_nationkey WHERE where_prec >= 4 AND cell > 0
), {_ALLOCATION}
SELECT pgid, CAST(sum(v) AS BIGINT) AS best, count(*) AS n FROM (
  SELECT pgid, part_of AS v FROM a UNION ALL SELECT cell, best FROM q WHERE where_prec < 4 OR cell = 0) GROUP BY 1
""")
def proportional_distribution(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).withColumn("priogrid_gid", F.col("cell"))
    out = expand.distribute_totals(rows, _weights(spark, sf), _polygons(spark, sf), amounts=("best",))
    return out.withColumnRenamed("priogrid_gid", "pgid")


@registered(f"""
WITH {YEARLY}, g AS (SELECT DISTINCT key, month_id FROM yearly, months)
SELECT g.key, g.month_id, round(coalesce((SELECT arg_max(value, year) FROM yearly y WHERE y.key = g.key AND (year - 1980) * 12 + 1 <= g.month_id), 0), 2) AS value FROM g
""")
def interp_step(spark: SparkSession, sf: str) -> DataFrame:
    at = yearly(spark, sf).select("key", ((F.col("year") - 1980) * 12 + 1).cast("int").alias("month_id"), "value")
    return interp.step(at, _axis(spark), "key", "value").withColumn("value", F.round("value", 2))


@registered(f"""
WITH {YEARLY}, b AS (SELECT key, year AS y0, value AS v0, lead(year) OVER w AS y1, lead(value) OVER w AS v1 FROM yearly WINDOW w AS (PARTITION BY key ORDER BY year)),
g AS (SELECT DISTINCT key, month_id, floor((month_id - 1) / 12.0::DOUBLE) + 1980 + ((month_id - 1) % 12) / 12.0::DOUBLE AS t FROM yearly, months)
SELECT g.key, g.month_id, round(coalesce(max(CASE WHEN y1 IS NULL THEN v0 ELSE v0 + (v1 - v0) / (y1 - y0) * (t - y0) END), 0), 2) AS value
FROM g LEFT JOIN b ON b.key = g.key AND t >= y0 AND (y1 IS NULL OR t < y1) GROUP BY 1, 2
""")
def interp_linear(spark: SparkSession, sf: str) -> DataFrame:
    return interp.linear(yearly(spark, sf), _axis(spark), "key", "value").withColumn("value", F.round("value", 2))


@registered(f"""
WITH {YEARLY} SELECT s_suppkey AS pgid, CAST((year - 1980) * 12 + m AS INTEGER) AS month_id, value
FROM yearly JOIN supplier ON s_nationkey = key, generate_series(1, 12) t(m)
""")
def year_to_month_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    crosswalk = _polygons(spark, sf).withColumnRenamed("code", "key")
    return expand.years_to_months(yearly(spark, sf), crosswalk, "key").select("pgid", "month_id", "value")


_COVARIATES = f"""
WITH {YEARLY}, top AS (SELECT max(value) AS t FROM yearly), v AS (SELECT key, year, value / t AS a, CASE WHEN key % 5 = 0 THEN NULL ELSE year / 2000.0::DOUBLE END AS b FROM yearly, top WHERE NOT (key % 4 = 1 AND year BETWEEN 1996 AND 1997)),
s AS (SELECT *, coalesce(lead(year) OVER (PARTITION BY key ORDER BY year), year + 1) AS after FROM v), f AS (SELECT key, y AS year, a, b FROM s, unnest(range(s.year, after)) t(y)),
c AS (SELECT s_suppkey AS pgid, CAST((year - 1980) * 12 + m AS INTEGER) AS month_id, a, b FROM f JOIN supplier ON s_nationkey = key, generate_series(1, 12) t(m))"""


def _covariates(spark: SparkSession, sf: str) -> DataFrame:
    """Two variables of nations, one of them null for every fifth, with a gap of two years in every fourth."""
    rows = yearly(spark, sf)
    top = rows.agg(F.max("value").alias("top"))  # one row
    values = rows.crossJoin(top).where(~((F.col("key") % 4 == 1) & F.col("year").between(1996, 1997)))
    b = F.when(F.col("key") % 5 != 0, F.col("year") / 2000.0)
    values = values.select("key", "year", (F.col("value") / F.col("top")).alias("a"), b.alias("b"))
    crosswalk = _polygons(spark, sf).withColumnRenamed("code", "key")
    return registry.build_covariates(values, crosswalk, registry.CovariateView(("a", "b"), "key"))


@registered(f"{_COVARIATES} SELECT pgid, month_id, round(a, 6) AS a, round(b, 6) AS b FROM c")
def covariate_chain(spark: SparkSession, sf: str) -> DataFrame:
    return _covariates(spark, sf).select("pgid", "month_id", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"))


@registered(f"""
{_COVARIATES}, l AS (SELECT *, pgid % 6 <> 0 AS land FROM c), m AS (SELECT max(month_id) AS last FROM c), y AS (SELECT pgid, (month_id - 1) // 12 AS y, max(a) - min(a) > 1e-9 AS moves FROM c GROUP BY ALL)
SELECT 'values_in_range' AS "check", count(*) FILTER (NOT a BETWEEN -0.01 AND 1.01 OR NOT b BETWEEN -0.01 AND 1.01) = 0 AS ok FROM l
UNION ALL SELECT 'coverage_adequate', count(a) FILTER (land AND month_id = last) * 100 > 30.0 * 90 FROM l, m
UNION ALL SELECT 'step_function_holds', count(*) FILTER (moves) = 0 FROM y
UNION ALL SELECT 'nan_present', count(*) FILTER (a IS NULL OR b IS NULL) > 0 FROM l
UNION ALL SELECT 'mean_libdem_reasonable', avg(a) FILTER (month_id = last) > 0.2::DOUBLE AND avg(a) FILTER (month_id = last) < 0.8::DOUBLE FROM l, m
""")
def covariate_grid_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Cells whose number six does not divide stand for land."""
    rows = _covariates(spark, sf)
    return quality.covariate_checks(rows, ["a", "b"], "a", 90, rows.where("pgid % 6 <> 0").select("pgid"))


# ---------------------------------------------------------------- rasters and assembly


_RASTER = """
WITH px AS (SELECT CAST(1994 + l_linenumber * 2 AS INTEGER) AS epoch, l_partkey % 720 * 10 AS "row", l_suppkey * 37 % 1440 * 10 AS col, sum(l_quantity * (1 + l_linenumber)) AS value
  FROM lineitem WHERE l_linenumber <= 3 GROUP BY ALL), cells AS (
  SELECT epoch AS year, CAST((359 - "row" // 60) * 720 + col // 60 + 1 AS INTEGER) AS pgid, CAST(sum(CASE WHEN value = 100 THEN 0 ELSE value END) AS DOUBLE) AS value FROM px WHERE epoch <> 1998 AND "row" < 21600 AND col < 43200 GROUP BY ALL)"""


def _raster_months(spark: SparkSession, sf: str, how: str) -> DataFrame:
    c = F.col
    rows = table(spark, sf, "lineitem").where("l_linenumber <= 3")
    rows = rows.groupBy((1994 + c("l_linenumber") * 2).cast("int").alias("epoch"), (c("l_partkey") % 720 * 10).alias("row"), (c("l_suppkey") * 37 % 1440 * 10).alias("col"), "l_linenumber").agg(F.sum("l_quantity").alias("q"))
    pixels = rows.select("epoch", "row", "col", (c("q") * (1 + c("l_linenumber"))).alias("value"))
    view = registry.RasterView("value", (1996, 2000), 60, 100.0, how)
    return registry.build_raster(pixels, axes.months_between(spark, 193, 252), view)


@registered(f"""
{_RASTER}, b AS (SELECT pgid, year AS y0, value AS v0, lead(year) OVER w AS y1, lead(value) OVER w AS v1 FROM cells WINDOW w AS (PARTITION BY pgid ORDER BY year)),
g AS (SELECT DISTINCT pgid, CAST(m AS INTEGER) AS month_id, floor((m - 1) / 12.0::DOUBLE) + 1980 + ((m - 1) % 12) / 12.0::DOUBLE AS t FROM cells, generate_series(193, 252) u(m))
SELECT g.pgid, g.month_id, round(coalesce(max(CASE WHEN y1 IS NULL THEN v0 ELSE v0 + (v1 - v0) / (y1 - y0) * (t - y0) END), 0), 4) AS value
FROM g LEFT JOIN b ON b.pgid = g.pgid AND t >= y0 AND (y1 IS NULL OR t < y1) GROUP BY 1, 2
""")
def raster_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Two of three epochs; the third is none of the view's."""
    return _raster_months(spark, sf, "linear").select("pgid", "month_id", F.round("value", 4).alias("value"))


@registered(f"""
{_RASTER}, g AS (SELECT DISTINCT pgid, m AS month_id FROM cells, generate_series(193, 252) u(m)),
s AS (SELECT g.pgid, month_id, coalesce((SELECT arg_max(value, year) FROM cells c WHERE c.pgid = g.pgid AND (year - 1980) * 12 + 1 <= g.month_id), 0) AS value FROM g),
u AS (SELECT month_id, sum(value) AS total FROM s GROUP BY 1), t AS (SELECT *, lag(total) OVER (ORDER BY month_id) AS before FROM u), e AS (SELECT *, before IS NULL OR abs(total - before) > 1e-8 + 1e-6 * abs(before) AS begins FROM t),
l AS (SELECT * FROM s WHERE month_id = 252)
SELECT 'no_nan' AS "check", true AS ok UNION ALL SELECT 'no_negatives', count(*) FILTER (value < 0) = 0 FROM s
UNION ALL SELECT 'ocean_built_negligible', coalesce(sum(value) FILTER (pgid % 3 = 0), 0) * 100 < sum(value) * 0.5::DOUBLE FROM l
UNION ALL SELECT 'no_antarctic_built', coalesce(sum(value) FILTER ((pgid - 1) // 720 < 60), 0) < 1000000 FROM l
UNION ALL SELECT 'monotonic_epoch_growth', count(*) FILTER (begins AND total < before) = 0 FROM e
UNION ALL SELECT 'spatial_coverage', count(*) FILTER (value > 0) * 100 > 5.0 * 1000 FROM l
UNION ALL SELECT 'built_area_vs_jrc', count(*) FILTER (begins AND (month_id - 1) // 12 + 1980 = 1996 AND NOT total / 40000.0::DOUBLE BETWEEN 0.85 AND 1.15) = 0 FROM e
""")
def built_grid_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Cells whose number three does not divide stand for land."""
    rows = _raster_months(spark, sf, "step")
    return quality.built_checks(rows, "value", {1996: 40_000.0}, 1000, rows.where("pgid % 3 <> 0").select("pgid"))


# ---------------------------------------------------------------- rasters


@registered("""
SELECT CAST(floor((p_partkey // 60 + 3) / 10.0) AS INTEGER) AS block_row, CAST(floor((p_partkey % 60) / 10.0) AS INTEGER) AS block_col,
       CAST(sum(CASE WHEN p_size = 7 THEN 0 ELSE p_size END) AS DOUBLE) AS value FROM part GROUP BY ALL
""")
def raster_block_sum(spark: SparkSession, sf: str) -> DataFrame:
    pixels = table(spark, sf, "part").select(F.expr("p_partkey div 60").alias("row"), (F.col("p_partkey") % 60).alias("col"), F.col("p_size").alias("value"))
    return gridagg.raster_blocks(pixels, 10, row_offset=3, nodata=7)


@registered(f"""
WITH {EV}, o AS (SELECT month_id, cell AS pgid, CASE WHEN nth % 3 = 0 THEN NULL ELSE CAST(best AS DOUBLE) END AS a, CAST(high AS DOUBLE) AS b,
  row_number() OVER (ORDER BY id, nth, part, cell, date_end, best) AS k FROM ev)
SELECT month_id, pgid, arg_max(a, k) FILTER (a IS NOT NULL) AS a, arg_max(b, k) AS b FROM o GROUP BY ALL
""")
def pregridded_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    rows = e.withColumns({"pgid": F.col("cell"), "a": F.when(F.col("nth") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("best").cast("double")), "b": F.col("high").cast("double")})
    return gridagg.last_value_wins(rows, ["a", "b"], F.struct("id", "nth", "part", "cell", "date_end", "best"))


@registered(f"""
WITH {EV}, {CELL}, l AS (SELECT month_id, cell AS pgid, CAST(sum(low) AS BIGINT) AS low FROM ev WHERE _source_type = 'annual' GROUP BY ALL)
SELECT c.month_id, c.pgid, best, n, coalesce(low, 0) AS low, coalesce(s_acctbal, 0) AS static FROM cells c
LEFT JOIN l ON c.month_id = l.month_id AND c.pgid = l.pgid LEFT JOIN supplier ON s_suppkey = c.pgid
""")
def assemble_sources(spark: SparkSession, sf: str) -> DataFrame:
    axis = cell_months(spark, sf).select("month_id", "pgid", "best", "n")
    low = events(spark, sf).where(F.col("_source_type") == "annual").groupBy("month_id", F.col("cell").alias("pgid")).agg(F.sum("low").alias("low"))
    static = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("pgid"), F.col("s_acctbal").alias("static"))
    return assemble.stack(axis.select("month_id", "pgid"), [axis, low], [static])


@registered(f"""
WITH {EV}, m AS (SELECT month_id, sum(best) AS best, sum(CASE WHEN nth = 7 THEN low ELSE 0 END) AS low7 FROM ev GROUP BY 1)
SELECT 'best' AS feature, min(month_id) FILTER (best > 0) AS first_month, max(month_id) FILTER (best > 0) AS last_month FROM m
UNION ALL SELECT 'low7', min(month_id) FILTER (low7 > 0), max(month_id) FILTER (low7 > 0) FROM m
""")
def data_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).withColumn("low7", F.when(F.col("nth") == 7, F.col("low")).otherwise(0))
    return assemble.boundaries(rows, ["best", "low7"])


@registered(f"""
WITH {EV}, {CELL}, g AS (SELECT CAST(m AS INTEGER) AS month_id, s_suppkey AS pgid FROM generate_series(200, 211) t(m), supplier)
SELECT g.month_id, g.pgid, coalesce(best, 0) AS best, coalesce(n, -1) AS n FROM g LEFT JOIN cells c ON c.month_id = g.month_id AND c.pgid = g.pgid
""")
def dense_spine(spark: SparkSession, sf: str) -> DataFrame:
    units = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("pgid"))
    return assemble.densify(cell_months(spark, sf), axes.spine(axes.months_between(spark, 200, 211), units), {"best": 0, "n": -1})


@registered("""
SELECT a.o_custkey AS custkey, a.year, a.total, b.n FROM
 (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL) a JOIN
 (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL) b USING (o_custkey, year)
""")
def indicator_inner_merge(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "custkey": F.col("o_custkey")})
    total = o.groupBy("custkey", "year").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    closed = o.where("o_orderstatus = 'F'").groupBy("custkey", "year").agg(F.count(F.lit(1)).alias("n"))
    return assemble.merge_indicators([total, closed], ["custkey", "year"])


@registered("""
SELECT coalesce(f.k, g.k) AS k, coalesce(f.v, g.v) AS v FROM
 (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS v FROM customer WHERE c_custkey % 2 = 0) f
 FULL JOIN (SELECT c_custkey AS k, -1 AS v FROM customer WHERE c_custkey % 5 <> 0) g ON f.k = g.k
""")
def fallback_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("v"))
    return assemble.coalesce_levels(c.where("k % 2 = 0"), c.where("k % 5 <> 0").select("k", F.lit(-1).alias("v")), "k", "v")


# ---------------------------------------------------------------- axes and formats


@registered(f"WITH {EV}, {CELL} SELECT month_id, pgid, best, n FROM cells WHERE best - 50 > 0 OR n > 2")
def sparse_rows(spark: SparkSession, sf: str) -> DataFrame:
    cells = cell_months(spark, sf)
    marked = cells.withColumns({"a": F.greatest(F.col("best") - 50, F.lit(0)), "b": F.when(F.col("n") > 2, 1).otherwise(0)})
    return marked.where(query.nonzero(["a", "b"])).select("month_id", "pgid", "best", "n")


@registered(f"WITH {EV}, {CELL} SELECT month_id AS time, CAST(pgid AS INTEGER) AS unit, CAST(best AS DOUBLE) AS f0, CAST(n AS DOUBLE) AS f1 FROM cells WHERE month_id BETWEEN 200 AND 220")
def feature_frame_layout(spark: SparkSession, sf: str) -> DataFrame:
    frame = query.load(cell_months(spark, sf), ["best", "n"], None, 200, 220, output="feature_frame")
    return frame.select("time", "unit", *[F.col("features")[i].cast("double").alias(f"f{i}") for i in (0, 1)])


@registered("""
WITH p AS (SELECT s_suppkey, (s_suppkey * 37 % 3600) / 20.0::DOUBLE - 90 AS lat, (s_suppkey * 101 % 7200) / 20.0::DOUBLE - 180 AS lon FROM supplier),
q AS (SELECT *, CAST(floor((lat + 90) / 0.5::DOUBLE) AS INTEGER) AS r, CAST(floor((lon + 180) / 0.5::DOUBLE) AS INTEGER) AS c FROM p)
SELECT s_suppkey, r * 720 + c + 1 AS pgid, r AS cell_row, c AS cell_col, r * 0.5::DOUBLE - 89.75 AS lat, c * 0.5::DOUBLE - 179.75 AS lon,
  r * 0.5::DOUBLE - 90 AS south, c * 0.5::DOUBLE - 180 AS west, r * 0.5::DOUBLE - 89.5 AS north, c * 0.5::DOUBLE - 179.5 AS east FROM q
""")
def pgid_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    lat, lon = (F.col("s_suppkey") * 37 % 3600) / F.lit(20.0) - 90, (F.col("s_suppkey") * 101 % 7200) / F.lit(20.0) - 180
    rows = table(spark, sf, "supplier").select("s_suppkey", axes.latlon_to_pgid(lat, lon).alias("pgid"))
    p = F.col("pgid")
    return rows.select("s_suppkey", "pgid", axes.pgid_row(p).alias("cell_row"), axes.pgid_column(p).alias("cell_col"), axes.pgid_to_lat(p).alias("lat"), axes.pgid_to_lon(p).alias("lon"), axes.bounding_box(p).alias("b")).select("*", "b.*").drop("b")


@registered("""
SELECT DISTINCT CAST((year(l_shipdate) - 1980) * 12 + month(l_shipdate) AS INTEGER) AS month_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
  CAST((year(l_shipdate) - 1980) * 12 + month(l_shipdate) AS INTEGER) AS parsed FROM lineitem
""")
def month_id_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "lineitem").select(axes.month_id(F.col("l_shipdate")).alias("month_id"), axes.month_id_from_text(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("parsed")).distinct()
    return m.select("month_id", axes.month_start(F.col("month_id")).alias("month_start"), "parsed")


_REGION = "SELECT s_suppkey AS pgid FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE"


def _two_regions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    r = cell_regions(spark, sf)
    return r.where("s_nationkey % 2 = 0").select("pgid"), r.where("s_nationkey % 3 = 0").select("pgid")


@registered(f"WITH {EV}, {CELL} SELECT month_id, pgid, best FROM cells WHERE pgid IN ({_REGION} s_nationkey % 2 = 0)")
def region_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    return query.load(cell_months(spark, sf), ["best"], _two_regions(spark, sf)[0])


@registered(f"{_REGION} s_nationkey % 2 = 0 INTERSECT {_REGION} s_nationkey % 3 = 0")
def region_intersect(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two_regions(spark, sf)
    return a.intersect(b)


@registered(f"{_REGION} s_nationkey % 2 = 0 EXCEPT {_REGION} s_nationkey % 3 = 0")
def region_except(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two_regions(spark, sf)
    return a.subtract(b)


@registered(f"{_REGION} s_nationkey % 2 = 0 UNION {_REGION} s_nationkey % 3 = 0")
def region_union(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two_regions(spark, sf)
    return a.union(b).distinct()


# ---------------------------------------------------------------- conservation and hierarchy


@registered(f"""
WITH {EV}, {CELL} SELECT CAST(sum(best) AS BIGINT) AS best_all, CAST(coalesce(sum(best) FILTER (country_id > 0), 0) AS BIGINT) AS best_inside,
  CAST(coalesce(sum(best) FILTER (country_id <= 0), 0) AS BIGINT) AS best_outside FROM cells
""")
def conservation_check(spark: SparkSession, sf: str) -> DataFrame:
    return conserve.totals(cell_months(spark, sf), ["best"], F.col("country_id") > 0)


@registered("SELECT c_mktsegment AS fine, count(DISTINCT c_nationkey) AS n_parents FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey) > 1")
def hierarchy_nesting(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("fine"), F.col("c_nationkey").alias("coarse"))
    return conserve.nesting_violations(c, "fine", "coarse")


@registered(f"""
WITH {EV}, {CELL} SELECT n_regionkey AS l0, country_id AS l1, CAST(sum(best) AS BIGINT) AS total, CAST(grouping(n_regionkey, country_id) AS BIGINT) AS level
FROM cells JOIN nation ON country_id = n_nationkey GROUP BY ROLLUP (n_regionkey, country_id)
""")
def hierarchy_rollup(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("country_id"), F.col("n_regionkey").alias("l0"))
    rows = cell_months(spark, sf).join(F.broadcast(n), "country_id").withColumnRenamed("country_id", "l1")
    return conserve.level_totals(rows, ["l0", "l1"], "best")


# ---------------------------------------------------------------- validation and comparison


_DIFF = """
WITH o AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders WHERE o_orderkey % 7 <> 0),
n AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_orderkey % 5 = 0 THEN 3 ELSE 0 END AS v FROM orders WHERE o_orderkey % 11 <> 0)
SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'revised' END AS status, coalesce(n.v, 0) - coalesce(o.v, 0) AS delta
FROM o FULL JOIN n ON o.k = n.k WHERE o.k IS NULL OR n.k IS NULL OR o.v <> n.v
"""


@registered(_DIFF)
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.floor("o_totalprice").alias("v"))
    new = o.where("k % 11 <> 0").withColumn("v", F.col("v") + F.when(F.col("k") % 5 == 0, 3).otherwise(0))
    return quality.snapshot_diff(o.where("k % 7 <> 0"), new, "k", "v")


@registered(_DIFF)
def snapshot_diff_by_tree(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.floor("o_totalprice").alias("v"))
    old, new = snapshots.scratch(spark, "old"), snapshots.scratch(spark, "new")
    difftree.write(o.where("k % 7 <> 0"), old, "k")
    difftree.write(o.where("k % 11 <> 0").withColumn("v", F.col("v") + F.when(F.col("k") % 5 == 0, 3).otherwise(0)), new, "k")
    return difftree.diff(spark, old, new, "k", "v")


@registered(f"""
WITH {SPANS} SELECT * FROM (
  SELECT 'amounts_ordered' AS rule, count(*) FILTER (NOT (low <= best AND best <= high)) AS n_violations FROM spans
  UNION ALL SELECT 'violence_is_two', count(*) FILTER (type_of_violence <> 2) FROM spans
  UNION ALL SELECT 'dates_ordered', count(*) FILTER (date_start > date_end) FROM spans
  UNION ALL SELECT 'latitude_valid', count(*) FILTER (NOT latitude BETWEEN -90 AND 90) FROM spans)
""")
def schema_violations(spark: SparkSession, sf: str) -> DataFrame:
    rules = {k: v for k, v in quality.event_rules().items() if k in ("amounts_ordered", "dates_ordered", "latitude_valid")}
    return quality.violations(spans(spark, sf), rules | {"violence_is_two": F.col("type_of_violence") == 2})


@registered("""
WITH s AS (SELECT o_orderpriority AS name, CAST(min(year(o_orderdate)) AS INTEGER) AS first, CAST(max(year(o_orderdate)) AS INTEGER) AS last FROM orders GROUP BY 1)
SELECT a.name AS "left", b.name AS "right", CAST(least(a.last, b.last) - greatest(a.first, b.first) + 1 AS BIGINT) AS n_years
FROM s a JOIN s b ON a.name < b.name AND a.first <= b.last AND b.first <= a.last
""")
def year_overlap(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(F.min(F.year("o_orderdate")).alias("first"), F.max(F.year("o_orderdate")).alias("last"))
    return quality.overlapping_spans(s, "name")


@registered(f"""
WITH {EV}, {CELL} SELECT month_id, country_id, CAST(sum(best) AS BIGINT) AS left_sum, CAST(sum(CASE WHEN pgid % 10 = 0 THEN best + 1 ELSE best END) AS BIGINT) AS right_sum
FROM cells GROUP BY ALL HAVING abs(sum(best) - sum(CASE WHEN pgid % 10 = 0 THEN best + 1 ELSE best END)) > 1e-5::DOUBLE * greatest(sum(best), sum(CASE WHEN pgid % 10 = 0 THEN best + 1 ELSE best END))
""")
def compare_sums(spark: SparkSession, sf: str) -> DataFrame:
    left = cell_months(spark, sf)
    right = left.withColumn("best", F.when(F.col("pgid") % 10 == 0, F.col("best") + 1).otherwise(F.col("best")))
    return quality.compare_sums(left, right, ["month_id", "country_id"], "best")


@registered(f"WITH {YEARLY} SELECT year, key, 0.0::DOUBLE AS std, (SELECT count(*) FROM supplier WHERE s_nationkey = key) AS n FROM yearly WHERE key IN (SELECT s_nationkey FROM supplier)")
def broadcast_integrity(spark: SparkSession, sf: str) -> DataFrame:
    crosswalk = _polygons(spark, sf).withColumn("key", F.col("code"))
    rows = expand.years_to_months(yearly(spark, sf), crosswalk, "key").where(F.pmod(F.col("month_id"), F.lit(12)) == 1)
    spread = quality.spread_within(rows, ["month_id", "code"], "value")
    return spread.select((F.floor((F.col("month_id") - 1) / 12) + 1980).cast("int").alias("year"), F.col("code").alias("key"), F.round("std", 3).alias("std"), "n")


@registered(f"WITH {PLACED} SELECT count(DISTINCT (month_id, pgid)) AS n_bins, CAST(0 AS BIGINT) AS n_broken FROM placed WHERE pgid IS NOT NULL AND month_id IS NOT NULL")
def type_sum_invariant(spark: SparkSession, sf: str) -> DataFrame:
    grid = gridagg.compile_grid(placed_events(spark, sf), [*registry.CONFLICT_FEATURES, gridagg.FeatureSpec("n")])
    return quality.type_sums(grid, "n", [f"ged_{name}_count" for name, _ in registry.VIOLENCE])


@registered(f"""
WITH {PLACED}, g AS (SELECT month_id, pgid, count(*) FILTER (type_of_violence = 1) AS sb, count(*) FILTER (type_of_violence = 2) AS ns FROM placed WHERE pgid IS NOT NULL AND month_id IS NOT NULL GROUP BY ALL)
SELECT 'ged_sb_count' AS feature, count(*) FILTER (sb > 0) AS n_nonzero, count(DISTINCT CASE WHEN sb > 0 THEN pgid END) AS n_cells, round(1 - count(*) FILTER (sb > 0) / 17107200.0::DOUBLE, 9) AS zero_share FROM g
UNION ALL SELECT 'ged_ns_count', count(*) FILTER (ns > 0), count(DISTINCT CASE WHEN ns > 0 THEN pgid END), round(1 - count(*) FILTER (ns > 0) / 17107200.0::DOUBLE, 9) FROM g
""")
def zero_inflation(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.zero_inflation(grid_month_features(spark, sf), ["ged_sb_count", "ged_ns_count"], axes.GRID.cells, 66)
    return out.withColumn("zero_share", F.round("zero_share", 9))


@registered("SELECT s_nationkey AS grp, count(s_acctbal) AS n, round(avg(s_acctbal), 4) AS mean, round(stddev_pop(s_acctbal), 4) AS std, round(quantile_cont(s_acctbal, 0.5), 4) AS median, round(CASE WHEN stddev_pop(s_acctbal) = 0 THEN NULL ELSE 3 * (avg(s_acctbal) - quantile_cont(s_acctbal, 0.5)) / stddev_pop(s_acctbal) END, 4) AS skew FROM supplier GROUP BY 1")
def distribution_stats(spark: SparkSession, sf: str) -> DataFrame:
    m = analytics.moments(table(spark, sf, "supplier").withColumn("grp", F.col("s_nationkey")), "grp", "s_acctbal")
    return m.select("grp", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "median", "skew")])


@registered(f"WITH {EV}, {CELL} SELECT country_id, round(corr(best, n), 6) AS r FROM cells GROUP BY 1 HAVING count(*) > 2 AND stddev_pop(best) > 0 AND stddev_pop(n) > 0")
def covariate_corr(spark: SparkSession, sf: str) -> DataFrame:
    out = cell_months(spark, sf).groupBy("country_id").agg(F.corr("best", "n").alias("r"), F.count(F.lit(1)).alias("k"), F.stddev_pop("best").alias("a"), F.stddev_pop("n").alias("b"))
    return out.where("k > 2 AND a > 0 AND b > 0").select("country_id", F.round("r", 6).alias("r"))


# ---------------------------------------------------------------- analytics

NATION_MONTH = f"WITH {EV}, {CELL}, nm AS (SELECT month_id, country_id, CAST(sum(best) AS BIGINT) AS best FROM cells GROUP BY ALL)"


def nation_months(spark: SparkSession, sf: str) -> DataFrame:
    return cell_months(spark, sf).groupBy("month_id", "country_id").agg(F.sum("best").alias("best"))


@registered(f"{NATION_MONTH} SELECT month_id, country_id, best, best - lag(best) OVER (PARTITION BY country_id ORDER BY month_id) AS change FROM nm")
def mom_change(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.change(nation_months(spark, sf), "country_id", "best")


@registered(f"{NATION_MONTH}, c AS (SELECT country_id, best - lag(best) OVER (PARTITION BY country_id ORDER BY month_id) AS d FROM nm) SELECT country_id, coalesce(max(abs(d)), 0) AS max_abs_change FROM c GROUP BY 1")
def max_abs_change(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.max_abs_change(nation_months(spark, sf), "country_id", "best")


@registered(f"WITH {EV}, {CELL} SELECT pgid, min(CASE WHEN best > 40 THEN month_id END) AS first_month FROM cells GROUP BY 1")
def first_onset(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.first_onset(cell_months(spark, sf).withColumn("best", F.col("best") - 40), "pgid", "best")


@registered(f"WITH {EV}, {CELL} SELECT month_id, pgid, best FROM cells WHERE pgid IN (SELECT pgid FROM cells GROUP BY 1 ORDER BY sum(best) DESC, pgid LIMIT 12)")
def top12_series(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.top_series(cell_months(spark, sf), "pgid", "best").select("month_id", "pgid", "best")


@registered(f"""
WITH {EV}, {CELL}, t AS (SELECT country_id, pgid, sum(best) AS v FROM cells GROUP BY ALL), c AS (
  SELECT country_id, CAST(sum(v) OVER (PARTITION BY country_id ORDER BY v, pgid ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY country_id) AS DOUBLE) AS c FROM t)
SELECT country_id, round(1 - 2 * (sum(c) - (min(c) + max(c)) / 2) / count(*), 6) AS gini FROM c GROUP BY 1
""")
def lorenz_gini(spark: SparkSession, sf: str) -> DataFrame:
    sums = cell_months(spark, sf).groupBy("country_id", "pgid").agg(F.sum("best").alias("v"))
    return analytics.gini(sums, "country_id", "pgid", "v").withColumn("gini", F.round("gini", 6))


@registered(f"""
WITH {EV}, {CELL}, t AS (SELECT pgid, sum(best) AS v FROM cells GROUP BY ALL), c AS (
  SELECT CAST(sum(v) OVER (ORDER BY v, pgid ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(v) OVER () AS DOUBLE) AS c FROM t)
SELECT 0 AS everywhere, round(1 - 2 * (sum(c) - (min(c) + max(c)) / 2) / count(*), 6) AS gini FROM c
""")
def lorenz_gini_global(spark: SparkSession, sf: str) -> DataFrame:
    """One group of all cells, in many tasks."""
    sums = cell_months(spark, sf).groupBy("pgid").agg(F.sum("best").alias("v")).withColumn("everywhere", F.lit(0))
    return analytics.gini(sums, "everywhere", "pgid", "v", spread=True).withColumn("gini", F.round("gini", 6))


@registered(f"""
WITH {EV}, {CELL} SELECT month_id, pgid, CAST(row_number() OVER (ORDER BY best, month_id, pgid) - 1 AS INTEGER) AS rank,
  CAST(sum(best) OVER (ORDER BY best, month_id, pgid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM cells
""")
def global_ranks(spark: SparkSession, sf: str) -> DataFrame:
    rows = cell_months(spark, sf).withColumn("everywhere", F.lit(0))
    out = analytics.running(rows, "everywhere", "best", "best", "month_id", "pgid")
    return out.select("month_id", "pgid", (F.col("place") - 1).cast("int").alias("rank"), "running")


@registered(f"""
WITH {EV}, {CELL}, y AS (SELECT (month_id - 1) // 12 + 1980 AS year, * FROM cells), q AS (
  SELECT year, count(*) AS n, count(DISTINCT pgid) FILTER (best <> 0) AS exact FROM y GROUP BY 1)
SELECT CAST(year AS INTEGER) AS year, n, true AS cells_close, true AS median_close FROM q
""")
def yearly_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Years from monthly sketches, and whether they are as close to the exact values as stated."""
    rows = cell_months(spark, sf).withColumn("year", (F.floor((F.col("month_id") - 1) / 12) + 1980).cast("int"))
    years = analytics.merged(analytics.sketches(rows, ["year", "month_id"], "best", "pgid"), ["year"], [0.5])
    exact = rows.groupBy("year").agg(F.countDistinct(F.when(F.col("best") != 0, F.col("pgid"))).alias("exact"), F.percentile("best", F.array(F.lit(0.485), F.lit(0.515))).alias("near"))
    both = years.join(exact, "year")
    return both.select("year", "n", (F.abs(F.col("n_cells") - F.col("exact")) <= 0.05 * F.col("exact")).alias("cells_close"), F.col("p50").between(F.floor(F.col("near")[0]), F.ceil(F.col("near")[1])).alias("median_close"))


@registered(f"{NATION_MONTH} SELECT month_id, country_id, CAST(row_number() OVER (PARTITION BY month_id ORDER BY best, country_id) - 1 AS INTEGER) AS rank FROM nm")
def rank_mobility(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.ordinal_ranks(nation_months(spark, sf), "month_id", "best", "country_id").select("month_id", "country_id", "rank")


@registered(f"""
{NATION_MONTH}, r AS (SELECT month_id, country_id, row_number() OVER (PARTITION BY month_id ORDER BY best, country_id) - 1 AS rank FROM nm)
SELECT b.month_id, count(*) AS n, round(avg(abs(b.rank - a.rank)), 6) AS mobility,
  round(CASE WHEN count(*) > 1 AND stddev_pop(a.rank) > 0 AND stddev_pop(b.rank) > 0 THEN corr(a.rank, b.rank) END, 6) AS correlation
FROM r b JOIN r a ON a.country_id = b.country_id AND a.month_id = b.month_id - 1 GROUP BY 1
""")
def rank_changes(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.rank_changes(nation_months(spark, sf), "country_id", "best").select("month_id", "n", F.round("mobility", 6).alias("mobility"), F.round("correlation", 6).alias("correlation"))


@registered(f"""
{NATION_MONTH}, l AS (SELECT country_id, max(month_id) AS last_month FROM nm WHERE best <> 0 GROUP BY 1), w AS (
  SELECT nm.country_id, month_id, best FROM nm JOIN l USING (country_id) WHERE month_id <= last_month
  QUALIFY row_number() OVER (PARTITION BY nm.country_id ORDER BY month_id DESC) <= 12
), m AS (SELECT country_id, quantile_cont(best, 0.5) AS median FROM w GROUP BY 1 HAVING count(*) >= 3)
SELECT country_id, month_id, best, median, best > 1.1::DOUBLE * greatest(median, 100.0::DOUBLE) AS flag FROM w JOIN m USING (country_id)
""")
def plausibility_flags(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.implausible(nation_months(spark, sf), "country_id", "best", factor=1.1, floor=100.0)


@registered(f"""
{NATION_MONTH}, c AS (SELECT country_id, max(CASE WHEN v <> 0 THEN month_id END) AS last_month, count(*) FILTER (month_id > 258 AND v <> 0) = 0 AS absent
  FROM (SELECT *, CASE WHEN month_id > 270 - country_id THEN 0 ELSE best END AS v FROM nm) GROUP BY 1)
SELECT country_id, last_month, 270 - last_month AS age, absent, coalesce(270 - last_month > 10, true) AS stale FROM c
""")
def consumer_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Nations whose last months are padding: as many as their number."""
    padded = nation_months(spark, sf).withColumn("best", F.when(F.col("month_id") > 270 - F.col("country_id"), 0).otherwise(F.col("best")))
    return analytics.contract_failures(padded, "country_id", "best", 270, slo_months=10)


@registered(f"""
{NATION_MONTH}, c AS (SELECT *, best - lag(best) OVER (PARTITION BY country_id ORDER BY month_id) AS change FROM nm), r AS (
  SELECT *, row_number() OVER (PARTITION BY country_id ORDER BY abs(change) DESC, month_id) AS k FROM c WHERE change IS NOT NULL)
SELECT country_id, month_id, change FROM r WHERE k = 1
""")
def largest_jump(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.largest_jump(nation_months(spark, sf), "country_id", "best")


@registered(f"""
WITH {EV}, {CELL}, s AS (SELECT pgid, min(month_id) AS a, max(month_id) AS b FROM cells GROUP BY 1)
SELECT s.pgid, CAST(m AS INTEGER) AS month_id FROM s, unnest(range(a, b + 1)) t(m) WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.pgid = s.pgid AND c.month_id = m)
""")
def empty_months(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.empty_months(cell_months(spark, sf), "pgid", "best")


@registered(f"""
WITH {YEARLY}, m AS (SELECT key, CAST((year - 1980) * 12 + k AS INTEGER) AS month_id, value FROM yearly, generate_series(1, 12) t(k)),
c AS (SELECT *, lag(value) OVER (PARTITION BY key ORDER BY month_id) AS before FROM m)
SELECT key, month_id, value, before FROM c WHERE abs(value - before) > 1e-8::DOUBLE + 1e-6::DOUBLE * abs(before)
""")
def epoch_transitions(spark: SparkSession, sf: str) -> DataFrame:
    m = yearly(spark, sf).withColumn("month_id", F.explode(F.sequence((F.col("year") - 1980) * 12 + 1, (F.col("year") - 1980) * 12 + 12)))
    return analytics.transitions(m.select("key", "month_id", "value"), "key", "value")


@registered(f"WITH {EV}, {CELL} SELECT pgid, round(count(*) FILTER (best > 40) * 100.0::DOUBLE / count(*), 6) AS persistence FROM cells GROUP BY 1")
def persistence(spark: SparkSession, sf: str) -> DataFrame:
    rows = cell_months(spark, sf).withColumn("best", F.col("best") - 40)
    return analytics.persistence(rows, "pgid", "best").withColumn("persistence", F.round("persistence", 6))


@registered(f"WITH {EV}, {CELL}, v AS (SELECT pgid, month_id, best FROM cells WHERE best % 4 <> 0) SELECT pgid, max(month_id) AS month_id, arg_max(best, month_id) AS best FROM v GROUP BY 1")
def last_valid_value(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.last_valid(cell_months(spark, sf).withColumn("best", F.when(F.col("best") % 4 != 0, F.col("best"))), "pgid", "best")


@registered(f"""
{NATION_MONTH} SELECT CAST(floor((month_id - 1) / 12.0) + 1980 AS INTEGER) AS year, {", ".join(f"CAST(coalesce(sum(best) FILTER ((month_id - 1) % 12 = {m}), 0) AS BIGINT) AS m{m + 1}" for m in range(12))} FROM nm GROUP BY 1
""")
def calendar_matrix(spark: SparkSession, sf: str) -> DataFrame:
    rows = nation_months(spark, sf).withColumns({"year": (F.floor((F.col("month_id") - 1) / 12) + 1980).cast("int"), "m": F.concat(F.lit("m"), (F.pmod(F.col("month_id") - 1, F.lit(12)) + 1).cast("string"))})
    return rows.groupBy("year").pivot("m", [f"m{i}" for i in range(1, 13)]).agg(F.sum("best")).na.fill(0)


@registered(f"""
WITH {EV}, {CELL} SELECT feature, last_month, 300 - last_month AS age FROM (
  SELECT 'best' AS feature, max(month_id) FILTER (best > 0) AS last_month FROM cells UNION ALL SELECT 'busy', max(month_id) FILTER (n > 3) FROM cells)
""")
def freshness_age(spark: SparkSession, sf: str) -> DataFrame:
    rows = cell_months(spark, sf).withColumn("busy", F.col("n") - 3)
    return quality.freshness(rows, ["best", "busy"], 300)


@registered("""
SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_nationkey % 2 = 1 AND c_custkey % 5 <> 0
""")
def completeness_valid(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    sets = c.select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("a"),
        F.when(F.col("c_nationkey") % 2 == 1, F.col("c_nationkey")).alias("b"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("c"),
    )
    return sets.where(assemble.completeness(sets, ["a", "b", "c"])).select("c_custkey")


@registered("""
WITH o AS (SELECT o_custkey AS k, sum(o_orderkey) AS d FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1), n AS (SELECT o_custkey AS k, sum(o_orderkey) AS d FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY 1)
SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS status
FROM o FULL JOIN n ON o.k = n.k WHERE o.k IS NULL OR n.k IS NULL OR o.d <> n.d
""")
def changed_digests(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    digests = lambda keep: o.where(keep).groupBy(F.col("o_custkey").alias("k")).agg(F.sum("o_orderkey").alias("d"))
    return quality.changed_keys(digests("o_orderkey % 3 <> 0"), digests("o_orderkey % 4 <> 0"), "k", "d")


@registered("""
WITH l AS (SELECT o_orderpriority AS dataset, CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS outcome, strftime(o_orderdate, '%Y-%m-%d') || '#' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS t FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY t DESC) AS k FROM l)
SELECT dataset, count(*) AS runs, count(*) FILTER (outcome = 'failed') AS failures, max(t) FILTER (outcome <> 'failed') AS last_success,
  CAST(DATE '2003-01-01' - CAST(substr(max(t) FILTER (outcome <> 'failed'), 1, 10) AS DATE) AS INTEGER) AS days_since
FROM r WHERE k <= 10 GROUP BY 1
""")
def ledger_health(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("#"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    rows = o.select(F.col("o_orderpriority").alias("dataset"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("outcome"), stamp.alias("timestamp"))
    return quality.health(rows, "2003-01-01")


@registered("SELECT c_nationkey, c_custkey, c_acctbal, k FROM (SELECT *, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS k FROM customer) WHERE k <= 3")
def top_per_country(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.top_per_group(table(spark, sf, "customer"), "c_nationkey", "c_acctbal", 3, "c_custkey").select("c_nationkey", "c_custkey", "c_acctbal", F.col("rank").alias("k"))


# ---------------------------------------------------------------- polygons


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    """A rectangle for each nation, a few degrees wide."""
    n = table(spark, sf, "nation")
    west, south = F.col("n_nationkey") * 1.7 - 20, F.pmod(F.col("n_nationkey") * 3, F.lit(7)) * 0.9 - 5
    east, north = west + 2.3, south + 1.6
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return n.select(F.col("n_nationkey").alias("code"), F.array(point(west, south), point(east, south), point(east, north), point(west, north)).alias("ring"))


BOXES = """
b AS (SELECT n_nationkey AS code, n_nationkey * 1.7::DOUBLE - 20 AS west, (n_nationkey * 3 % 7) * 0.9::DOUBLE - 5 AS south FROM nation),
k AS (SELECT code, west, south, west + 2.3::DOUBLE AS east, south + 1.6::DOUBLE AS north FROM b),
c AS (SELECT CAST(r * 720 + q + 1 AS INTEGER) AS pgid, r * 0.5::DOUBLE - 90 AS lo_y, q * 0.5::DOUBLE - 180 AS lo_x FROM generate_series(150, 210) t(r), generate_series(300, 460) u(q))"""


@registered(f"WITH {BOXES} SELECT pgid, min(code) AS code FROM c JOIN k ON lo_x + 0.25 BETWEEN west AND east AND lo_y + 0.25 BETWEEN south AND north GROUP BY 1")
def centroid_join(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.centroid_join(_boxes(spark, sf))


@registered(f"""
WITH {BOXES}, o AS (SELECT pgid, code, (least(lo_x + 0.5, east) - greatest(lo_x, west)) * (least(lo_y + 0.5, north) - greatest(lo_y, south)) AS area
  FROM c JOIN k ON lo_x < east AND lo_x + 0.5 > west AND lo_y < north AND lo_y + 0.5 > south),
r AS (SELECT *, row_number() OVER (PARTITION BY pgid ORDER BY round(area, 9) DESC, code) AS n FROM o WHERE round(area, 9) > 0)
SELECT pgid, code, round(area, 6) AS area FROM r WHERE n = 1
""")
def area_majority_join(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.area_majority_join(_boxes(spark, sf)).withColumn("area", F.round("area", 6))


_AREA = "(least(lo_x + 0.5, east) - greatest(lo_x, west)) * (least(lo_y + 0.5, north) - greatest(lo_y, south))"


def _level_sql(won: str) -> str:
    """Codes of two levels (nations' boxes, and those around a region's nations) in a part of the grid."""
    return f"""
WITH {BOXES}, l AS (SELECT 'nation' AS level, * FROM k UNION ALL
  SELECT 'region', n_regionkey, min(west), min(south), max(east), max(north) FROM k JOIN nation ON code = n_nationkey GROUP BY ALL), o AS (
  SELECT pgid, level, code, lo_x, lo_y, west, south, east, north, {_AREA} AS area FROM c JOIN l ON lo_x < east AND lo_x + 0.5 > west AND lo_y < north AND lo_y + 0.5 > south
), r AS ({won}), w AS (SELECT c.pgid, max(CASE WHEN level = 'nation' THEN code END) AS nation, max(CASE WHEN level = 'region' THEN code END) AS region FROM c LEFT JOIN r USING (pgid) GROUP BY 1)
SELECT pgid, CAST(coalesce(nation, -1) AS INTEGER) AS nation, CAST(coalesce(region, -1) AS INTEGER) AS region FROM w"""


def _levels(spark: SparkSession, sf: str, by: str) -> DataFrame:
    boxes = spatial.with_box(_boxes(spark, sf))
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), "n_regionkey")
    edge = boxes.join(nations, "code").groupBy(F.col("n_regionkey").alias("code")).agg(*[f(c).alias(c) for f, c in ((F.min, "west"), (F.min, "south"), (F.max, "east"), (F.max, "north"))])
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    around = F.array(corner("west", "south"), corner("east", "south"), corner("east", "north"), corner("west", "north"))
    both = boxes.select(F.lit("nation").alias("level"), "code", "ring").unionByName(edge.select(F.lit("region").alias("level"), "code", around.alias("ring")))
    part = axes.pgid_row(F.col("pgid")).between(150, 210) & axes.pgid_column(F.col("pgid")).between(300, 460)
    return cover.level_codes(both, ["nation", "region"], by=by).where(part)


@registered(_level_sql("SELECT pgid, level, code FROM o WHERE round(area, 9) > 0 QUALIFY row_number() OVER (PARTITION BY pgid, level ORDER BY round(area, 9) DESC, code) = 1"))
def admin_levels_by_area(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf, "area")


@registered(_level_sql("SELECT pgid, level, min(code) AS code FROM o WHERE lo_x + 0.25 BETWEEN west AND east AND lo_y + 0.25 BETWEEN south AND north GROUP BY ALL"))
def admin_levels_by_centre(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf, "centre")


@registered(f"""
WITH {BOXES}, h AS (SELECT code, west + 0.4::DOUBLE AS hw, south + 0.3::DOUBLE AS hs, west + 1.7::DOUBLE AS he, south + 1.1::DOUBLE AS hn FROM k), o AS (
  SELECT pgid, code, {_AREA} - greatest(least(lo_x + 0.5, he) - greatest(lo_x, hw), 0) * greatest(least(lo_y + 0.5, hn) - greatest(lo_y, hs), 0) AS area
  FROM c JOIN k ON lo_x < east AND lo_x + 0.5 > west AND lo_y < north AND lo_y + 0.5 > south JOIN h USING (code))
SELECT code, count(*) AS n_cells, round(sum(area), 6) AS area FROM o WHERE round(area, 9) > 0 GROUP BY 1
""")
def polygon_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Cells and area of each nation's box with a hole in it."""
    boxes = _boxes(spark, sf)
    west, south = F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    point = lambda x, y: F.struct((west + x).alias("x"), (south + y).alias("y"))
    holed = boxes.withColumn("holes", F.array(F.array(point(0.4, 0.3), point(1.7, 0.3), point(1.7, 1.1), point(0.4, 1.1))))
    met = cover.cover(holed).where(F.round("area", 9) > 0)
    return met.groupBy("code").agg(F.count(F.lit(1)).alias("n_cells"), F.round(F.sum("area"), 6).alias("area"))


@registered(f"""
WITH {BOXES}, p AS (SELECT s_suppkey AS pgid, CAST(s_suppkey * 37 % 160 - 80 AS DOUBLE) AS lat, CAST(s_suppkey * 53 % 340 - 170 AS DOUBLE) AS lon FROM supplier),
d AS (SELECT pgid, round(sqrt(pow(greatest(west - lon, 0, lon - east), 2) + pow(greatest(south - lat, 0, lat - north), 2)), 4) AS distance FROM p, k)
SELECT pgid, min(distance) AS distance FROM d GROUP BY 1
""")
def nearest_polygon_edge(spark: SparkSession, sf: str) -> DataFrame:
    at = lambda f, m, o: (F.col("s_suppkey") * f % m - o).cast("double")
    points = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("pgid"), at(37, 160, 80).alias("lat"), at(53, 340, 170).alias("lon"))
    return spatial.nearest_polygon(points, _boxes(spark, sf), measure="edge").select("pgid", F.round("distance", 4).alias("distance"))


# ---------------------------------------------------------------- whole chains


def _won_sql(priority: str, split: str) -> str:
    """kept: the store without stale versions; m: survivors by month, with n months each."""
    return f"""
WITH {SPANS}, a AS (SELECT max(date_end) AS last FROM spread WHERE _source_type = 'annual'), s AS (
  SELECT spread.* FROM spread, a WHERE _source_type = 'annual'
     OR ((id IN (SELECT id FROM spread WHERE _source_type = 'annual') OR date_end > last) AND date_end IS NOT NULL)
), kept AS (
  SELECT * FROM s WHERE _source_type <> 'dot9' OR version_key = (SELECT max(version_key) FROM s WHERE _source_type = 'dot9')
), won AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {priority} DESC, version_key DESC, part, cell, date_end, best, nth) AS place FROM kept
), x AS (SELECT *, CASE WHEN {split} THEN n_months ELSE 1 END AS n FROM won WHERE place = 1), m AS (
  SELECT x.*, CAST(CASE WHEN n > 1 THEN date_trunc('month', date_start) + to_months(CAST(j AS INTEGER)) ELSE date_trunc('month', date_end) END AS DATE) AS date_month
  FROM x, unnest(range(n)) t(j))"""


@registered(f"""
{_won_sql("CASE _source_type WHEN 'dot9' THEN 2 WHEN 'annual' THEN 1 ELSE 0 END", f"_source_type <> 'annual' AND {_SUMMARY}")}
SELECT date_month, cell AS priogrid_gid, CAST(sum(CASE WHEN n > 1 THEN ceil(CAST(best AS DOUBLE) / n) ELSE best END) AS DOUBLE) AS best, count(*) AS n
FROM m WHERE cell >= 1 AND type_of_violence <= 3 AND where_prec NOT IN (4, 6) GROUP BY ALL
""")
def viewpoint_production_parity(spark: SparkSession, sf: str) -> DataFrame:
    rows = spans(spark, sf).withColumn("priogrid_gid", F.col("cell"))
    view = registry.build_viewpoint(rows, registry.PROFILES["production_parity"], ties=TIES)
    return view.groupBy("date_month", "priogrid_gid").agg(F.sum("best").alias("best"), F.count(F.lit(1)).alias("n"))


def _spread_sql(polygons: str, level: str) -> str:
    """Monthly amounts v over the cells of polygons (level, code, pgid); the level of an event by its precision."""
    return f"""
{_won_sql("CASE _source_type WHEN 'annual' THEN 1 ELSE 0 END", "date_prec = 5")}, sums AS (
  SELECT cell, sum(best) AS amount FROM kept WHERE where_prec <= 3 GROUP BY 1
), poly AS ({polygons}), c AS (SELECT level, code, pgid, coalesce(amount, 0) AS amount FROM poly LEFT JOIN sums ON pgid = cell), t AS (
  SELECT *, sum(amount) OVER (PARTITION BY level, code) AS total, count(*) OVER (PARTITION BY level, code) AS cells FROM c
), weights AS (
  SELECT level, code, pgid, CASE WHEN total > 0 THEN CAST(amount AS DOUBLE) / CAST(total AS DOUBLE) ELSE 1.0::DOUBLE / cells END AS share FROM t WHERE total = 0 OR amount > 0
), b AS (SELECT id, date_month, cell, where_prec, CAST(best AS DOUBLE) / n AS v FROM m), p AS (
  SELECT b.id, b.date_month, CAST(trunc(v) AS BIGINT) AS best, w.pgid, share FROM b
  JOIN poly h ON h.pgid = cell AND h.level = {level} JOIN weights w ON w.code = h.code AND w.level = h.level WHERE where_prec >= 4 AND cell > 0
), f AS (SELECT *, CAST(floor(best * share) AS BIGINT) AS base FROM p), g AS (
  SELECT *, best - sum(base) OVER e AS rest, count(*) OVER e AS cnt, row_number() OVER (PARTITION BY id, date_month ORDER BY share DESC, pgid) AS q FROM f
  WINDOW e AS (PARTITION BY id, date_month)
), o AS (
  SELECT date_month, pgid, CAST(base + floor(rest / cnt::DOUBLE) + CASE WHEN q <= ((rest % cnt) + cnt) % cnt THEN 1 ELSE 0 END AS DOUBLE) AS v FROM g
  UNION ALL SELECT date_month, cell, v FROM b WHERE (id, date_month) NOT IN (SELECT (id, date_month) FROM p))
SELECT date_month, pgid AS priogrid_gid, round(sum(v), 4) AS best, count(*) AS n FROM o GROUP BY 1, 2"""


@registered(_spread_sql("SELECT 1 AS level, s_nationkey AS code, s_suppkey AS pgid FROM supplier", "1"))
def viewpoint_default(spark: SparkSession, sf: str) -> DataFrame:
    rows = spans(spark, sf).withColumn("priogrid_gid", F.col("cell"))
    return registry.viewpoint_totals(rows, registry.PROFILES["default"], ("date_month",), _polygons(spark, sf), TIES).withColumn("best", F.round("best", 4))


@registered(
    _spread_sql(
        "SELECT 1 AS level, s_nationkey AS code, s_suppkey AS pgid FROM supplier WHERE s_suppkey % 4 <> 0 UNION ALL SELECT 0, n_regionkey, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey",
        "CASE WHEN where_prec >= 6 THEN 0 ELSE 1 END",
    )
)
def viewpoint_two_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Nations (without every fourth cell) for precisions 4 and 5, regions for 6 and more."""
    rows = spans(spark, sf).withColumn("priogrid_gid", F.col("cell"))
    nations = _polygons(spark, sf)
    above = table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_regionkey").alias("_region"))
    regions = nations.join(above, "code").select("pgid", F.col("_region").alias("code"), F.lit(0).alias("level"))
    levels = nations.where("pgid % 4 <> 0").select("pgid", "code", F.lit(1).alias("level")).unionByName(regions)
    return registry.viewpoint_totals(rows, registry.PROFILES["default"], ("date_month",), levels, TIES).withColumn("best", F.round("best", 4))


# ---------------------------------------------------------------- the second event source


def typed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a type by their number (the seventh is unknown) and fatalities that may be negative."""
    kinds = F.array(*map(F.lit, [*quality.EVENT_TYPES, "Other"]))
    e = events(spark, sf).where("nth <= 7")
    return e.withColumns({"event_type": F.element_at(kinds, F.col("nth").cast("int")), "fatalities": F.col("best") - 3, "event_date": F.col("date_end")})


_KINDS = ", ".join(f"'{k}'" for k in (*quality.EVENT_TYPES, "Other"))
TYPED = EV + f""", te AS (SELECT *, [{_KINDS}][nth] AS event_type, best - 3 AS fatalities, date_end AS event_date,
  CAST(floor((latitude + 90) / 0.5::DOUBLE) * 720 + floor((longitude + 180) / 0.5::DOUBLE) + 1 AS INTEGER) AS pgid FROM ev WHERE nth <= 7)"""
_TYPED_SUMS = ", ".join(f"count(*) FILTER (event_type = '{kind}') AS acled_{name}" for name, kind in registry.TYPES.items())


@registered(f"""
WITH {TYPED} SELECT date_month, event_type, count(*) AS n, CAST(sum(fatalities) AS BIGINT) AS fatalities FROM (
  SELECT *, strftime(event_date, '%Y-%m') AS date_month FROM te WHERE event_type IN ('Battles', 'Explosions/Remote violence', 'Violence against civilians')) GROUP BY ALL
""")
def typed_viewpoint_violence(spark: SparkSession, sf: str) -> DataFrame:
    view = registry.build_typed(typed_events(spark, sf), registry.TYPED_PROFILES["acled_violence_only"])
    return view.groupBy("date_month", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("fatalities").alias("fatalities"))


@registered(f"WITH {TYPED} SELECT count(*) AS n_input, count(*) FILTER (nth <= 3) AS n_output, count(*) FILTER (nth > 3) AS n_filtered FROM te")
def typed_viewpoint_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Counted while the viewpoint's rows are computed."""
    counts = registry.typed(typed_events(spark, sf), registry.TYPED_PROFILES["acled_violence_only"]).run()
    return spark.createDataFrame([(counts["n_input"], counts["n_output"], counts["n_filtered"])], "n_input long, n_output long, n_filtered long")


@registered(f"WITH {TYPED} SELECT month_id, pgid, count(*) AS acled_count, {_TYPED_SUMS}, CAST(sum(fatalities) AS BIGINT) AS acled_fatalities FROM te WHERE month_id BETWEEN 185 AND 250 GROUP BY ALL")
def typed_month_features(spark: SparkSession, sf: str) -> DataFrame:
    view = registry.build_typed(typed_events(spark, sf), registry.TYPED_PROFILES["acled_all_events"])
    placed = gridagg.place(view.drop("month_id"), 185, 250, axes.month_id(F.col("event_date")))
    return gridagg.compile_grid(placed, registry.TYPED_FEATURES)


@registered(f"""
WITH {TYPED} SELECT 'fatalities_not_negative' AS rule, count(*) FILTER (fatalities < 0) AS n_violations FROM te
UNION ALL SELECT 'event_type_known', count(*) FILTER (event_type = 'Other') FROM te
UNION ALL SELECT 'latitude_valid', count(*) FILTER (NOT latitude BETWEEN -90 AND 90) FROM te
UNION ALL SELECT 'longitude_valid', count(*) FILTER (NOT longitude BETWEEN -180 AND 180) FROM te
""")
def typed_event_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.violations(typed_events(spark, sf), quality.typed_rules())


_ROW = "(pgid - 1) // 720"


@registered(f"""
WITH {TYPED}, g AS (SELECT month_id, pgid, count(*) AS total, {_TYPED_SUMS} FROM te GROUP BY ALL),
m AS (SELECT g.*, {_ROW} AS r, pgid % 3 <> 0 AS land FROM g), y AS (SELECT (month_id - 1) // 12 AS y, sum(total) AS t FROM m GROUP BY 1)
SELECT 'no_nan' AS "check", true AS ok
UNION ALL SELECT 'no_negatives', true
UNION ALL SELECT 'type_sum_invariant', count(*) FILTER ({" + ".join(f"acled_{n}" for n in registry.TYPES)} <> total) = 0 FROM m
UNION ALL SELECT 'ocean_events_negligible', coalesce(sum(total) FILTER (NOT land), 0) * 100 < sum(total) FROM m
UNION ALL SELECT 'no_antarctic_events', coalesce(sum(total) FILTER (r < 60), 0) < 100 FROM m
UNION ALL SELECT 'annual_count_range', count(*) FILTER (NOT t BETWEEN 100 AND 1000000) = 0 FROM y
UNION ALL SELECT 'no_empty_months', max(month_id) - min(month_id) + 1 = count(DISTINCT month_id) FROM m
UNION ALL SELECT 'spatial_extent', (count(*) FILTER (r >= 110 AND r < 255) > 0) AND (count(*) FILTER (r >= 250 AND r < 325) > 0) AND (count(*) FILTER (r >= 180 AND r < 340) > 0) AND (count(*) FILTER (r >= 70 AND r < 350) > 0) FROM m
""")
def typed_grid_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Cells whose number three does not divide stand for land."""
    view = registry.build_typed(typed_events(spark, sf), registry.TYPED_PROFILES["acled_all_events"])
    grid = gridagg.compile_grid(gridagg.place(view.drop("month_id"), 1, 1200, axes.month_id(F.col("event_date"))), registry.TYPED_FEATURES)
    land = axes.cells(spark).where("pgid % 3 <> 0").select("pgid")
    return quality.event_grid_checks(grid, "acled_count", [f"acled_{n}" for n in registry.TYPES], land, (100, 1_000_000))


# ---------------------------------------------------------------- checks of covariates, exports, revisions

POPULATION = """
pop AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_suppkey * 997 % 259200 + 1 AS INTEGER) AS pgid, CAST(sum(l_quantity) AS DOUBLE) AS value FROM lineitem GROUP BY ALL)"""


def _population(spark: SparkSession, sf: str) -> DataFrame:
    cell = (F.col("l_suppkey") * 997 % 259200 + 1).cast("int").alias("pgid")
    return table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), cell).agg(F.sum("l_quantity").cast("double").alias("value"))


@registered(f"""
WITH {POPULATION}, y AS (SELECT year, sum(value) AS t FROM pop GROUP BY 1), l AS (SELECT * FROM pop WHERE year = (SELECT max(year) FROM pop))
SELECT 'no_nan' AS "check", count(*) FILTER (value IS NULL) = 0 AS ok FROM pop
UNION ALL SELECT 'no_negatives', count(*) FILTER (value < 0) = 0 FROM pop
UNION ALL SELECT 'ocean_pop_negligible', coalesce(sum(value) FILTER (pgid % 5 = 0), 0) * 100 < sum(value) * 0.5::DOUBLE FROM l
UNION ALL SELECT 'no_antarctic_pop', coalesce(sum(value) FILTER ({_ROW} < 60), 0) < 1000000 FROM l
UNION ALL SELECT 'pop_sanity_vs_known', count(*) FILTER (NOT t / 25000.0::DOUBLE BETWEEN 0.85::DOUBLE AND 1.15::DOUBLE) = 0 FROM y WHERE year IN (1994, 1996)
UNION ALL SELECT 'spatial_coverage', count(*) FILTER (value > 0) * 100 > 30 * 20 FROM l
""")
def population_grid_checks(spark: SparkSession, sf: str) -> DataFrame:
    land = axes.cells(spark).where("pgid % 5 <> 0").select("pgid")
    return quality.population_checks(_population(spark, sf), "value", {1994: 25000.0, 1996: 25000.0}, 20, land)


@registered(f"""
WITH {YEARLY}, i AS (SELECT key, year, value / (SELECT max(value) FROM yearly) * 1.02::DOUBLE AS v FROM yearly)
SELECT 'has_values' AS "check", count(v) > 0 AS ok FROM i UNION ALL SELECT 'in_range', min(v) >= -0.01::DOUBLE AND max(v) <= 1.01::DOUBLE FROM i UNION ALL SELECT 'constant_in_year', true
""")
def index_grid_checks(spark: SparkSession, sf: str) -> DataFrame:
    rows = yearly(spark, sf)
    top = rows.agg(F.max("value").alias("top"))
    index = rows.crossJoin(top).select(F.col("key").alias("pgid"), (F.col("value") / F.col("top") * 1.02).alias("v"), F.explode(F.sequence((F.col("year") - 1980) * 12 + 1, (F.col("year") - 1980) * 12 + 12)).alias("month_id"))
    return quality.index_checks(index, "v")


@registered(f"""
{_won_sql("CASE _source_type WHEN 'annual' THEN 1 ELSE 0 END", "date_prec = 5")}
SELECT (SELECT count(*) FROM spread) AS n_store, (SELECT count(*) FROM spread) - (SELECT count(*) FROM kept) AS n_stale,
  (SELECT count(*) FROM kept) - (SELECT count(*) FROM x) AS n_superseded, (SELECT count(*) FROM x) AS n_survivors,
  (SELECT CAST(sum(best) AS DOUBLE) FROM x) AS amount, (SELECT round(sum(CAST(best AS DOUBLE) / n), 4) FROM m) AS amount_by_month
""")
def viewpoint_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Counted while the viewpoint's rows are computed."""
    counts = registry.viewpoint(spans(spark, sf), registry.PROFILES["default"], ties=TIES).run()
    names = ("n_store", "n_stale", "n_superseded", "n_survivors", "amount", "amount_by_month")
    kinds = ", ".join(f"{n} {'long' if n.startswith('n_') else 'double'}" for n in names)
    return spark.createDataFrame([tuple(counts[n] for n in names)], kinds).withColumn("amount_by_month", F.round("amount_by_month", 4))


@registered(f"""
WITH {EV}, r AS (SELECT * REPLACE (CASE WHEN _source_version = '25.9.3' AND month_id BETWEEN 200 AND 210 THEN best + 7 ELSE best END AS best) FROM ev WHERE NOT (_source_version = '25.3' AND month_id < 184)), k AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE WHEN _source_type = 'annual' THEN 1 ELSE 0 END DESC, version_key DESC, part, cell, date_end, best, nth) AS k FROM r)
SELECT month_id, cell AS pgid, count(*) AS n, CAST(sum(best) AS BIGINT) AS best FROM k WHERE k = 1 GROUP BY ALL
""")
def incremental_cube(spark: SparkSession, sf: str) -> DataFrame:
    """A cube that is made, and made again after two versions have changed in some months."""
    path = snapshots.scratch(spark, "cube")
    chosen = lambda store: resolve.survivors(store, "annual_wins", TIES).withColumn("pgid", F.col("cell"))
    features = [gridagg.FeatureSpec("n"), gridagg.FeatureSpec("best", "sum_field", "best")]
    make = lambda store: incremental.refresh(store, chosen, lambda rows: gridagg.compile_grid(rows, features), path, "annual_wins")
    # the columns that the cube depends on: ties hold the cell and the amount
    first = events(spark, sf).select("id", "_source_type", "_source_version", "month_id", *TIES)
    make(first)
    more = F.when((F.col("_source_version") == "25.9.3") & F.col("month_id").between(200, 210), F.col("best") + 7).otherwise(F.col("best"))
    make(first.where(~((F.col("_source_version") == "25.3") & (F.col("month_id") < 184))).withColumn("best", more))
    return spark.read.parquet(path).select("month_id", "pgid", "n", "best")


def _blocks(spark: SparkSession, sf: str) -> cube.Cube:
    """Suppliers' months as a cube of blocks, 17 cells apart so that they lie in several tiles."""
    path = snapshots.scratch(spark, "blocks")
    cells = cell_months(spark, sf).withColumn("pgid", (F.col("pgid") * 17 % 259200 + 1).cast("int"))
    cube.write(cells.select("month_id", "pgid", "best", "n"), path, ["best", "n"], {"best": "extensive", "n": "extensive"})
    return cube.Cube(spark, path)


@registered(f"""
WITH {EV}, {CELL} SELECT month_id, CAST(pgid * 17 % 259200 + 1 AS INTEGER) AS pgid, CAST(best AS FLOAT) AS best FROM cells
WHERE month_id BETWEEN 193 AND 210 AND country_id < 4 AND n > 1
""")
def cube_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of some months and nations, with more than one event."""
    region = cell_regions(spark, sf).where("s_nationkey < 4").select((F.col("pgid") * 17 % 259200 + 1).cast("int").alias("pgid"))
    return _blocks(spark, sf).load(["best"], region, 193, 210, above={"n": 1})


@registered(f"""
WITH {EV}, {CELL} SELECT 'best' AS feature, count(*) AS n, CAST(sum(best) AS DOUBLE) AS total, CAST(min(best) AS FLOAT) AS least, CAST(max(best) AS FLOAT) AS greatest FROM cells
UNION ALL SELECT 'n', count(*), CAST(sum(n) AS DOUBLE), CAST(min(n) AS FLOAT), CAST(max(n) AS FLOAT) FROM cells
""")
def cube_totals(spark: SparkSession, sf: str) -> DataFrame:
    """From the zones, without opening a block."""
    return _blocks(spark, sf).totals()


@registered(f"""
WITH {EV}, {CELL} SELECT count(*) AS n_rows, count(*) FILTER (month_id BETWEEN 190 AND 250 AND pgid > 9) AS n_placed,
  CAST(sum(best) FILTER (month_id BETWEEN 190 AND 250 AND pgid > 9) AS DOUBLE) AS best FROM cells
""")
def frame_to_grid(spark: SparkSession, sf: str) -> DataFrame:
    frame = query.feature_frame(cell_months(spark, sf).withColumn("pgid", F.when(F.col("pgid") > 9, F.col("pgid")).otherwise(-F.col("pgid"))), ["best", "n"])
    back = cube.from_feature_frame(frame, ["best", "n"], 190, 250)
    placed = F.when(F.col("placed"), F.col("best").cast("double"))
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.count(placed).alias("n_placed"), F.sum(placed).alias("best"))


@registered(f"""
WITH {EV}, {CELL} SELECT month_id, pgid + 1 AS priogrid_id, CASE WHEN best % 4 = 0 THEN 0.0::DOUBLE ELSE CAST(best AS DOUBLE) END AS best, CAST(n AS DOUBLE) AS n,
  CAST(pgid // 720 + 1 AS DOUBLE) AS "row", CAST(pgid % 720 + 1 AS DOUBLE) AS col FROM cells
""")
def consumer_export(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers count from 0, cells from 1."""
    rows = cell_months(spark, sf).withColumns({"best": F.when(F.col("best") % 4 != 0, F.col("best")), "pgid": F.col("pgid") + 1})
    return assemble.export(rows, ["best", "n"])


@registered(f"""
WITH {EV}, {CELL}, s AS (SELECT m.month_id, s_suppkey AS pgid FROM (SELECT DISTINCT month_id FROM cells WHERE month_id < 200) m, supplier WHERE s_suppkey % 2 = 0)
SELECT s.month_id, s.pgid + 1 AS priogrid_id, coalesce(CAST(best AS DOUBLE), 0) AS best, CAST(s.pgid // 720 + 1 AS DOUBLE) AS "row", CAST(s.pgid % 720 + 1 AS DOUBLE) AS col
FROM s LEFT JOIN cells ON s.month_id = cells.month_id AND s.pgid = cells.pgid
""")
def consumer_export_dense(spark: SparkSession, sf: str) -> DataFrame:
    units = table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select((F.col("s_suppkey") + 1).alias("pgid"))
    return assemble.export(cell_months(spark, sf).where("month_id < 200").withColumn("pgid", F.col("pgid") + 1), ["best"], units)


@registered("SELECT DISTINCT s_suppkey AS pgid FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name IN (SELECT n_name FROM nation ORDER BY n_name LIMIT 3)")
def macro_region_cells(spark: SparkSession, sf: str) -> DataFrame:
    names = [r[0] for r in table(spark, sf, "nation").orderBy("n_name").limit(3).select("n_name").collect()]
    countries = cell_regions(spark, sf).select("pgid", F.col("nation").alias("country"))
    return query.resolve_region("north", countries, {"grid": axes.cells(spark)}, {"north": names})


@registered("""
WITH t AS (SELECT s_suppkey, CAST(s_suppkey * 997 % 300000 + 1 AS INTEGER) AS pgid FROM supplier), r AS (
  SELECT *, (pgid - 1) // 720 * 0.5::DOUBLE - 89.75::DOUBLE + s_suppkey % 3 * 0.008::DOUBLE AS lat, (pgid - 1) % 720 * 0.5::DOUBLE - 179.75::DOUBLE AS lon FROM t)
SELECT s_suppkey, pgid, CASE WHEN pgid <= 259200 THEN round(s_suppkey % 3 * 0.008::DOUBLE, 6) END AS error,
  CASE WHEN pgid > 259200 THEN 'missing' WHEN s_suppkey % 3 = 2 THEN 'differs' ELSE 'matched' END AS status FROM r
""")
def grid_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Centres of cells against a table of theirs, some moved and some off the grid."""
    s = table(spark, sf, "supplier").select("s_suppkey", (F.col("s_suppkey") * 997 % 300000 + 1).cast("int").alias("pgid"))
    theirs = s.withColumns({"lat": axes.pgid_row(F.col("pgid")) * 0.5 - 89.75 + F.col("s_suppkey") % 3 * 0.008, "lon": axes.pgid_column(F.col("pgid")) * 0.5 - 179.75})
    out = quality.parity(axes.cells(spark), theirs, "pgid", ["lat", "lon"])
    return out.select("s_suppkey", "pgid", F.round("error", 6).alias("error"), "status")


_SIDE = "SELECT o_custkey AS k, CAST(sum(o_orderkey) AS BIGINT) AS v FROM orders WHERE o_orderkey % {} <> 0 GROUP BY 1"


@registered(f"WITH a AS ({_SIDE.format(3)}), b AS ({_SIDE.format(4)}) SELECT k, b.v - a.v AS delta FROM a JOIN b USING (k) WHERE a.v <> b.v ORDER BY abs(b.v - a.v) DESC, k LIMIT 20")
def largest_revisions(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    side = lambda n: o.where(F.col("o_orderkey") % n != 0).groupBy(F.col("o_custkey").alias("k")).agg(F.sum("o_orderkey").alias("v"))
    return quality.largest_revisions(side(3), side(4), "k", "v")


@registered("""
SELECT CAST(floor((p_partkey // 60) / 10.0) AS INTEGER) AS block_row, CAST(floor((p_partkey % 60) / 10.0) AS INTEGER) AS block_col, CAST(sum(p_size - 10) AS DOUBLE) AS value FROM part GROUP BY ALL
""")
def raster_block_sum_unmasked(spark: SparkSession, sf: str) -> DataFrame:
    pixels = table(spark, sf, "part").select(F.expr("p_partkey div 60").alias("row"), (F.col("p_partkey") % 60).alias("col"), (F.col("p_size") - 10).alias("value"))
    return gridagg.raster_blocks(pixels, 10, masked=False)


@registered("""
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 3 = 0), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 4 = 0)
SELECT count(*) AS n_first, count(*) FILTER (b.o_custkey IS NULL) AS n_lost FROM a LEFT JOIN b USING (o_custkey)
""")
def indicator_row_loss(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return assemble.row_loss([o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 4 = 0")], ["o_custkey"])


@registered("SELECT c_nationkey AS k, count(*) AS n_rows FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 0) GROUP BY 1")
def unmatched_keys(spark: SparkSession, sf: str) -> DataFrame:
    crosswalk = table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_nationkey").alias("k"))
    return assemble.unmatched(table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), crosswalk, "k")


@registered("SELECT s_nationkey, sha256(string_agg(sha256(CAST(s_suppkey AS VARCHAR)), '|' ORDER BY s_suppkey)) AS composite FROM supplier GROUP BY 1")
def composite_digests(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "supplier").withColumn("digest", F.sha2(F.col("s_suppkey").cast("string"), 256))
    return quality.composite_digest(files, "s_nationkey", "s_suppkey", "digest")


@registered("SELECT substr(sha256(string_agg(column_name, ',' ORDER BY column_name)), 1, 16) AS fingerprint FROM (DESCRIBE supplier)")
def schema_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(quality.schema_fingerprint(table(spark, sf, "supplier")),)], "fingerprint string")


@registered(f"""
WITH {BOXES}, p AS (SELECT s_suppkey AS pgid, CAST(s_suppkey * 37 % 160 - 80 AS DOUBLE) AS lat, CAST(s_suppkey * 53 % 340 - 170 AS DOUBLE) AS lon FROM supplier),
d AS (SELECT pgid, code, round(pow(lon - (west + east) / 2, 2) + pow(lat - (south + north) / 2, 2), 9) AS d FROM p, k), m AS (SELECT *, min(d) OVER (PARTITION BY pgid) AS least FROM d)
SELECT pgid, round(least, 4) AS d FROM m WHERE d = least GROUP BY ALL
""")
def nearest_polygon(spark: SparkSession, sf: str) -> DataFrame:
    """Squared distance of the nearest polygon's centre."""
    at = lambda f, m, o: (F.col("s_suppkey") * f % m - o).cast("double")
    points = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("pgid"), at(37, 160, 80).alias("lat"), at(53, 340, 170).alias("lon"))
    boxes = _boxes(spark, sf)
    west, south = F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    centre = boxes.select("code", (west + 1.15).alias("x"), (south + 0.8).alias("y"))
    found = spatial.nearest_polygon(points, boxes).join(points, "pgid").join(centre, "code")
    d = F.pow(F.col("lon") - F.col("x"), 2) + F.pow(F.col("lat") - F.col("y"), 2)
    return found.select("pgid", F.round(d, 4).alias("d"))


@registered(f"""
WITH {BOXES}, o AS (SELECT s.code, max(greatest(least(s.west + 0.9, k.east) - greatest(s.west + 0.4, k.west), 0) * greatest(least(s.south + 2.1, k.north) - greatest(s.south + 1.1, k.south), 0)) AS shared
  FROM k s, k GROUP BY 1)
SELECT code, round(shared / 0.5, 6) AS covered FROM o
""")
def supplement_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Smaller rectangles that stand out of each nation's box, and how much of them one box covers."""
    boxes = _boxes(spark, sf)
    west, south = F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    point = lambda x, y: F.struct((west + x).alias("x"), (south + y).alias("y"))
    supplements = boxes.select("code", F.array(point(0.4, 1.1), point(0.9, 1.1), point(0.9, 2.1), point(0.4, 2.1)).alias("ring"))
    return spatial.coverage(supplements, boxes).withColumn("covered", F.round("covered", 6))


@registered(f"""
WITH {EV}, {CELL} SELECT count(*) AS n_excluded, count(*) FILTER (best + n > 0) AS n_with_mass, CAST(sum(best) AS DOUBLE) AS best, CAST(sum(n) AS DOUBLE) AS n FROM cells WHERE country_id < 4
""")
def excluded_mass(spark: SparkSession, sf: str) -> DataFrame:
    """Nations below 4 stand for the sea."""
    return query.excluded(cell_months(spark, sf).withColumn("country_id", F.col("country_id") - 3), ["best", "n"])


@registered(f"""
WITH {EV}, {CELL}, r AS (SELECT month_id, row_number() OVER (PARTITION BY month_id ORDER BY best, pgid) AS x, row_number() OVER (PARTITION BY month_id ORDER BY n, pgid) AS y FROM cells)
SELECT month_id, count(*) AS n, round(corr(x, y), 6) AS rho FROM r GROUP BY 1 HAVING count(*) >= 5
""")
def rank_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.rank_correlation(cell_months(spark, sf), "month_id", "pgid", "best", "n").withColumn("rho", F.round("rho", 6))


@registered("""
SELECT s_nationkey, count(*) AS n, round(var_pop(s_acctbal), 3) AS variance, round(quantile_cont(s_acctbal, 0.05), 4) AS p5, round(quantile_cont(s_acctbal, 0.5), 4) AS p50, round(quantile_cont(s_acctbal, 0.95), 4) AS p95
FROM supplier GROUP BY 1
""")
def distribution_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    out = analytics.quantiles(table(spark, sf, "supplier"), "s_nationkey", "s_acctbal", (0.05, 0.5, 0.95))
    return out.select("s_nationkey", "n", F.round("variance", 3).alias("variance"), *[F.round(c, 4).alias(c) for c in ("p5", "p50", "p95")])


@registered("""
WITH p AS (SELECT s_suppkey, s_acctbal, s_suppkey * 37 % 179 - 89 AS lat, s_suppkey * 53 % 359 - 179 AS lon FROM supplier)
SELECT s_suppkey, round(ln(1 + least(greatest(CAST(s_acctbal AS DOUBLE), 0), 5000)), 6) AS scaled,
  CASE WHEN lat BETWEEN -35 AND 37 AND lon BETWEEN -18 AND 52 THEN 'Africa'
  ELSE concat(abs(lat), chr(176), CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END, ', ', abs(lon), chr(176), CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END) END AS label
FROM p
""")
def scaled_labels(spark: SparkSession, sf: str) -> DataFrame:
    lat, lon = F.col("s_suppkey") * 37 % 179 - 89, F.col("s_suppkey") * 53 % 359 - 179
    label = analytics.place_label(lat, lon, {"Africa": (-35, 37, -18, 52)})
    return table(spark, sf, "supplier").select("s_suppkey", F.round(analytics.log_scaled(F.col("s_acctbal"), 0, 5000), 6).alias("scaled"), label.alias("label"))


@registered(f"""
WITH {YEARLY}, l AS (SELECT key, year, value FROM yearly WHERE year <> 1995 AND year BETWEEN 1993 AND 1997), s AS (SELECT key, min(year) AS y0, max(year) AS y1 FROM l GROUP BY 1),
m AS (SELECT s.key, month_id, CAST(floor((month_id - 1) / 12.0) AS INTEGER) + 1980 AS y FROM s, months WHERE month_id BETWEEN (y0 - 1980) * 12 + 1 AND (y1 - 1980) * 12 + 12)
SELECT s_suppkey AS pgid, m.month_id, round(max_by(l.value, l.year), 2) AS value FROM m JOIN l ON l.key = m.key AND l.year <= m.y JOIN supplier ON s_nationkey = m.key GROUP BY ALL
""")
def years_to_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Each year twice, of which the later counts; 1995 is a gap."""
    one = yearly(spark, sf).where("year <> 1995")
    twice = one.withColumn("at", F.lit(2)).unionByName(one.withColumns({"value": F.col("value") * 2, "at": F.lit(1)}))
    values = expand.last_of_year(twice, "key", "value", "at", 1993, 1997)
    cells = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("pgid"), F.col("s_nationkey").alias("key"))
    return expand.years_to_cells(values, _axis(spark), cells, "key", "value", "step").withColumn("value", F.round("value", 2))


@registered("SELECT p_partkey, p_size FROM part WHERE p_brand = (SELECT min(p_brand) FROM part)")
def rows_of_level(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_brand")
    least = parts.agg(F.min("p_brand")).head()[0]
    return assemble.of_level(parts, "p_brand", least).select("p_partkey", "p_size")
