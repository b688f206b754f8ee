"""Adapters that present the driver's tables in the collision-table column roles.

Two views share one construction:

* ``incidents``      - from ``events`` (one row per event; hours, days, weekend)
* ``incidents_long`` - from ``orders`` (one row per order; years, months, seasons)

Column roles (rules marked "own" are this library's, the collision data brings
them ready-made):

=================== ================================ ==================================
role                incidents (events)               incidents_long (orders)
=================== ================================ ==================================
DR_Number           event_id                         o_orderkey
Date_Occurred/Hour  ts                               o_orderdate
Area_Name           n_name via user_id = c_custkey   n_name via o_custkey = c_custkey
Address (own)       user_id as text                  o_custkey as text
Collision_Severity  event_type = 'error' -> major    priority 1-URGENT/2-HIGH -> major
(own)               else minor                       else minor
Road_Type (own)     event_type                       o_orderstatus
Is_Hotspot (own)    site share rule, see below       same rule over customers
Congestion_Index    site share rule, see below       same rule over customers
Victim_Age (measure) value                           o_totalprice
=================== ================================ ==================================

Site share rule (integers only, so no rounding question): for a site with
``cnt`` rows among ``sites`` sites and ``total`` rows, compare
``cnt * sites * 100`` with ``total * k``: k >= 115 Critical (and hotspot),
>= 100 High, >= 85 Medium, else Low.

Only the joins a caller needs are built: a query that reads hours never joins
customers, one that reads areas never computes the site statistics. Catalyst
cannot drop an unused outer join by itself (it does not know the key is
unique), so the adapter takes the list of columns up front.

``incidents`` and ``incidents_long`` always return one row per event or order
with the columns asked for. Aggregates read ``incident_cube``: the same view,
aggregated by (site, the other columns asked for) into additive weights before
the site is joined. Both do the same at every size; how a join runs is left to
the planner and to AQE, which measure it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.enrich import day_name, hour_band, is_weekend, season
from ..operators import rollups
from .schema import OPTIONAL_COLUMNS, REQUIRED_COLUMNS

# Fixed values of the own rules above (percent of the mean site share).
HOTSPOT_PCT = 115
CONGESTION_BANDS = [(115, "Critical"), (100, "High"), (85, "Medium")]
CONGESTION_ELSE = "Low"
MAJOR, MINOR = "major", "minor"
URGENT_PRIORITIES = ["1-URGENT", "2-HIGH"]

ALL_COLUMNS = REQUIRED_COLUMNS + OPTIONAL_COLUMNS
_AREA_COLS = {"Area_Name"}
_SITE_COLS = {"Is_Hotspot", "Congestion_Index"}
JOINED = _AREA_COLS | _SITE_COLS
# Row columns only ever counted or averaged: a cube carries them as weights.
_WEIGHT_SOURCES = ("DR_Number", "Victim_Age")
# Rows without a site, and those of each heavy one, are spread over this many join keys.
SITE_KEYS = 256
# A site is heavy from one row in this many; the sketch that finds them keeps so many items.
HEAVY_SHARE, HEAVY_SITES, SKETCH_ITEMS = 500, 500, 10_000

_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its files are listed at every call, so appended files are
    read; only the schema, which costs a job to infer, is remembered per path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def forget_schemas() -> None:
    """Call after a table's columns have changed."""
    _SCHEMAS.clear()


def area_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey -> Area_Name (nation name)."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey"), F.col("n_name").alias("Area_Name")
    )
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        "c_custkey", "Area_Name"
    )


def site_classes(fact: DataFrame, site: str) -> DataFrame:
    """Per site: Is_Hotspot and Congestion_Index from the site share rule.

    One aggregation of the fact, or of a cube of it, on the site key (partial
    counts map-side, so a site holding a third of all rows is one row per map
    task) and two global scalars over it.
    """
    counts = (
        fact.where(F.col(site).isNotNull())
        .groupBy(site)
        .agg((F.sum(rollups.W_ROWS) if rollups.is_weighted(fact) else F.count(F.lit(1))).alias("_cnt"))
    )
    # Global totals as ONE scalar subquery (a 1-row struct, values inlined):
    # no join of the site rows with anything.
    dec = T.DecimalType(38, 0)
    totals = counts.select(
        F.struct(F.sum("_cnt").cast(dec).alias("t"), F.count(F.lit(1)).cast(dec).alias("s"))
    ).scalar()
    total, sites = totals.getField("t"), totals.getField("s")
    share = F.col("_cnt").cast(dec) * sites * F.lit(100).cast(dec)

    def at_least(pct: int) -> Column:
        return share >= total * F.lit(pct).cast(dec)

    congestion = None
    for pct, label in CONGESTION_BANDS:
        congestion = (
            F.when(at_least(pct), F.lit(label)) if congestion is None
            else congestion.when(at_least(pct), F.lit(label))
        )
    return counts.select(
        F.col(site).alias("_site"),
        at_least(HOTSPOT_PCT).alias("Is_Hotspot"),
        congestion.otherwise(F.lit(CONGESTION_ELSE)).alias("Congestion_Index"),
    )


def site_dimension(
    spark: SparkSession, sf_dir: str, fact: DataFrame, site: str, with_classes: bool
) -> DataFrame:
    """One row per customer: c_custkey, Area_Name and, when asked, the site classes.

    Area and site classes are folded into one dimension so the fact table is
    joined once (one shuffle of the fact at most, one place for AQE to split a
    hot key); a row whose site is not a known customer gets null area and class.
    """
    dim = area_lookup(spark, sf_dir)
    if with_classes:
        dim = dim.join(site_classes(fact, site), F.col("c_custkey") == F.col("_site"), "left").drop("_site")
    return dim


def year_range(ts: str, years: Iterable[int]) -> Column:
    """Timestamp range covering the given calendar years: a superset of
    ``year(ts) IN years`` that Parquet can use to skip row groups."""
    ys = sorted(set(years))
    lo = F.lit(f"{ys[0]:04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{ys[-1] + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (F.col(ts) >= lo) & (F.col(ts) < hi)


@dataclass(frozen=True, eq=False)
class View:
    """How one driver table fills the column roles."""

    table: str
    site: str
    ts: str
    row_id: str
    columns: tuple[str, ...]
    exprs: dict[str, Callable[[], Column]]

    def fact(self, spark: SparkSession, sf_dir: str, wanted: list[str], years: Iterable[int] | None) -> tuple[DataFrame, DataFrame]:
        """(whole table, its rows in ``years``): site statistics read the whole."""
        unknown = [c for c in wanted if c not in ALL_COLUMNS]
        if unknown:
            raise ValueError(f"unknown incident columns: {unknown}")
        whole = table(spark, sf_dir, self.table).select(*self.columns)
        return whole, whole.where(year_range(self.ts, years)) if years else whole

    def rows(self, spark: SparkSession, sf_dir: str, columns: Iterable[str] | None, years: Iterable[int] | None) -> DataFrame:
        wanted = list(ALL_COLUMNS if columns is None else columns)
        whole, fact = self.fact(spark, sf_dir, wanted, years)
        dims = JOINED
        if not dims & set(wanted):
            return fact.select(*[self.exprs[c]().alias(c) for c in wanted])
        dim = site_dimension(spark, sf_dir, whole, self.site, bool(_SITE_COLS & set(wanted)))
        joined = join_sites(fact, dim, self.site, self.row_id)
        return joined.select(*[(F.col(c) if c in dims else self.exprs[c]()).alias(c) for c in wanted])

    def cube(
        self, spark: SparkSession, sf_dir: str, columns: Iterable[str], years: Iterable[int] | None, scale: int | None
    ) -> DataFrame:
        wanted = list(columns)
        whole, fact = self.fact(spark, sf_dir, wanted, years)
        dims = JOINED
        keys = [c for c in wanted if c not in dims and c not in _WEIGHT_SOURCES]
        site = [F.col(self.site).alias("_site_key")] if dims & set(wanted) else []
        base = fact.select(*site, *[self.exprs[c]().alias(c) for c in keys + list(_WEIGHT_SOURCES)])
        pre = rollups.weighted_cube(base, ["_site_key"] * bool(site) + keys, measure="Victim_Age", scale=scale)
        if not site:
            return pre
        dim = site_dimension(spark, sf_dir, whole, self.site, bool(_SITE_COLS & set(wanted)))
        joined = pre.join(dim, F.col("_site_key") == F.col("c_custkey"), "left")
        return joined.select(*[F.col(c) for c in wanted if c not in _WEIGHT_SOURCES], *rollups.WEIGHTS)


def heavy_sites(fact: DataFrame, site: str) -> Column:
    """The sites with a large share of the rows, as one array value: a frequency
    sketch of ``SKETCH_ITEMS`` items, made in each task and merged, tells the
    largest ``HEAVY_SITES``; those with at least one row in ``HEAVY_SHARE`` are
    heavy. The sketch may miss or add none that matters: a site is spread or not,
    and rows meet the same customer either way."""
    top = F.expr(f"approx_top_k({site}, {HEAVY_SITES}, {SKETCH_ITEMS})")
    found = fact.where(F.col(site).isNotNull()).agg(top.alias("top"), F.count(F.lit(1)).alias("n"))
    heavy = F.filter("top", lambda x: x["count"] * HEAVY_SHARE >= F.col("n"))
    return found.select(F.transform(heavy, lambda x: x["item"])).scalar()


def join_sites(fact: DataFrame, dim: DataFrame, site: str, row_id: str) -> DataFrame:
    """Rows of ``fact`` with their customer's columns, null where there is none.

    Rows without a site meet no customer and are spread over ``SITE_KEYS`` join
    keys. So are the rows of a heavy site, whose one customer row is repeated on
    each of these keys, so that no task gets all rows of one site.
    """
    heavy = heavy_sites(fact, site)
    is_heavy = lambda col: F.coalesce(F.array_contains(heavy, F.col(col)), F.lit(False))
    key = F.pmod(F.xxhash64(row_id), F.lit(SITE_KEYS))
    left = fact.withColumn("_key", F.when(F.col(site).isNull() | is_heavy(site), key).otherwise(F.lit(-1)))
    keys = F.when(is_heavy("c_custkey"), F.sequence(F.lit(0), F.lit(SITE_KEYS - 1))).otherwise(F.array(F.lit(-1)))
    right = dim.withColumn("_site_keys", F.explode(keys))
    return left.join(right, (F.col(site) == F.col("c_custkey")) & (F.col("_key") == F.col("_site_keys").cast("long")), "left")


def _time_exprs(ts: Callable[[], Column]) -> dict[str, Callable[[], Column]]:
    """Column builders (built only for the columns a query asks for)."""
    return {
        "Date_Occurred": lambda: F.to_date(ts()),
        "Hour": lambda: F.hour(ts()),
        "Day_of_Week": lambda: day_name(ts()),
        "Time_of_Day": lambda: hour_band(F.hour(ts())),
        "Season": lambda: season(F.month(ts())),
        "Is_Weekend": lambda: is_weekend(ts()),
        "Year": lambda: F.year(ts()),
        "Month": lambda: F.month(ts()),
        "Latitude": lambda: F.lit(None).cast("double"),
        "Longitude": lambda: F.lit(None).cast("double"),
    }


def _major(is_major: Column, known: Column) -> Column:
    return F.when(is_major, F.lit(MAJOR)).when(known.isNotNull(), F.lit(MINOR))


EVENTS = View(
    table="events", site="user_id", ts="ts", row_id="event_id",
    columns=("event_id", "ts", "user_id", "event_type", "value"),
    exprs=_time_exprs(lambda: F.col("ts")) | {
        "DR_Number": lambda: F.col("event_id"),
        "Collision_Severity": lambda: _major(F.col("event_type") == "error", F.col("event_type")),
        "Road_Type": lambda: F.col("event_type"),
        "Address": lambda: F.col("user_id").cast("string"),
        "Victim_Age": lambda: F.col("value"),
    },
)
ORDERS = View(
    table="orders", site="o_custkey", ts="o_orderdate", row_id="o_orderkey",
    columns=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    exprs=_time_exprs(lambda: F.col("o_orderdate")) | {
        "DR_Number": lambda: F.col("o_orderkey"),
        "Collision_Severity": lambda: _major(F.col("o_orderpriority").isin(URGENT_PRIORITIES), F.col("o_orderpriority")),
        "Road_Type": lambda: F.col("o_orderstatus"),
        "Address": lambda: F.col("o_custkey").cast("string"),
        "Victim_Age": lambda: F.col("o_totalprice"),
    },
)


def incidents(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, years: Iterable[int] | None = None
) -> DataFrame:
    """Events as incidents (see module doc), one row per event. ``columns`` limits
    what is built; ``years`` adds a scan-level time range covering those years
    (the report still applies its exact year test)."""
    return EVENTS.rows(spark, sf_dir, columns, years)


def incidents_long(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, years: Iterable[int] | None = None
) -> DataFrame:
    """Orders as incidents over several years (see module doc), one row per order."""
    return ORDERS.rows(spark, sf_dir, columns, years)


def incident_cubes(
    spark: SparkSession, sf_dir: str, view: View, grains: Iterable[tuple[str, ...]], scale: int | None = None
) -> dict[tuple[str, ...], DataFrame]:
    """The cubes of several grains of a view from one scan of its table.

    The scan fills the cells of every grain without areas and site classes, and
    those of (site, labels) that the others need, in one pass. Site classes are
    counted from the site cells; these meet their customers and fill the other
    grains in a second pass. Grains are sets of columns, none with weights.
    """
    grains = [tuple(g) for g in grains]
    sited = [g for g in grains if JOINED & set(g)]
    direct = [g for g in grains if g not in sited]
    labels = [c for c in dict.fromkeys(c for g in sited for c in g) if c not in JOINED]
    by_site = ("_site_key", *labels)
    columns = list(dict.fromkeys(c for g in grains for c in g if c not in JOINED))
    _, fact = view.fact(spark, sf_dir, columns, None)
    site = [F.col(view.site).alias("_site_key")] if sited else []
    base = fact.select(*site, *[view.exprs[c]().alias(c) for c in [*columns, *_WEIGHT_SOURCES]])
    found = rollups.cubes(base, [*direct, by_site] if sited else direct, measure="Victim_Age", scale=scale)
    if not sited:
        return found
    cells = found.pop(by_site)
    classes = any(_SITE_COLS & set(g) for g in sited)
    dim = area_lookup(spark, sf_dir)
    if classes:
        dim = dim.join(site_classes(cells, "_site_key"), F.col("c_custkey") == F.col("_site"), "left").drop("_site")
    joined = cells.join(dim, F.col("_site_key") == F.col("c_custkey"), "left")
    return found | rollups.cubes(joined, sited)


def incident_cube(
    spark: SparkSession, sf_dir: str, view: View, columns: Iterable[str], years: Iterable[int] | None = None, scale: int | None = None
) -> DataFrame:
    """A view aggregated to weights (``operators.rollups``) at the grain of the
    site and ``columns``; DR_Number and Victim_Age go into the weights.

    A site that holds a third of all rows reaches the join as one row per
    combination of labels. Measures are summed as they are, or exactly in
    decimal with ``scale`` digits.
    """
    return view.cube(spark, sf_dir, columns, years, scale)
