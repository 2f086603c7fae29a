"""Report queries over the star schema (KPIs, trends, distributions, top-k, extracts).

Pattern: aggregate the fact first (map-side combined), then join the *aggregated*
result to dimensions. Shares use a scalar subquery for the grand total (no global
window, no cross join). Top-k reports order by count with a value tiebreak so the
k rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.scoring import RESULT_PASS


def _n() -> Column:
    return F.count(F.lit(1))


def pass_rate(result_col: str = "inspection_result") -> Column:
    """Percent of rows whose result is Pass (double)."""
    return F.count_if(F.col(result_col) == RESULT_PASS).cast("double") * 100 / F.count(F.lit(1))


def _year(fact: DataFrame) -> Column:
    # date_key is yyyymmdd, so the year needs no dim_date join
    return (F.col("date_key") / 10000).cast("int")


def kpi(fact: DataFrame) -> DataFrame:
    """Inspections, distinct restaurants, overall pass rate."""
    return fact.agg(_n().alias("inspections"),
                    F.count_distinct("restaurant_key").alias("restaurants"),
                    pass_rate().alias("pass_rate_pct"))


def results_by_group(fact: DataFrame, group: str = "source_city") -> DataFrame:
    """Inspections per group and result."""
    return fact.groupBy(group, "inspection_result").agg(_n().alias("inspections"))


def by_year(fact: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """D3: inspections per year and source.

    With ``dim_date`` the year comes from the calendar dimension. The fact is aggregated per
    date_key first, then joined; Spark broadcasts the calendar if it measures it small.
    """
    if dim_date is None:
        return fact.groupBy(_year(fact).alias("year"), "source_city").agg(_n().alias("inspections"))
    per_day = fact.groupBy("date_key", "source_city").agg(_n().alias("_n"))
    cal = dim_date.select("date_key", "year")
    return (per_day.join(cal, "date_key").groupBy("year", "source_city")
            .agg(F.sum("_n").alias("inspections")))


def risk_share(fact: DataFrame, dim_restaurant: DataFrame) -> DataFrame:
    """Inspections per risk category and their share of all inspections."""
    per_key = fact.groupBy("restaurant_key").agg(_n().alias("_n"))
    dim = dim_restaurant.select("restaurant_key", "risk_category")
    counts = per_key.join(dim, "restaurant_key", "left").groupBy("risk_category").agg(F.sum("_n").alias("inspections"))
    total = counts.agg(F.sum("inspections")).scalar()  # of the few aggregated rows, not of the fact again
    return counts.withColumn("share_pct", F.col("inspections").cast("double") * 100 / total)


def top_facility_types(fact: DataFrame, dim_restaurant: DataFrame, k: int = 10) -> DataFrame:
    """The k facility types with most inspections."""
    per_key = fact.groupBy("restaurant_key").agg(_n().alias("_n"))
    dim = dim_restaurant.select("restaurant_key", "facility_type")
    return (per_key.join(dim, "restaurant_key", "left").groupBy("facility_type")
            .agg(F.sum("_n").alias("inspections"))
            .orderBy(F.desc("inspections"), F.asc_nulls_first("facility_type")).limit(k))


def score_histogram(fact: DataFrame, width: int = 5, source: str | None = None) -> DataFrame:
    """Inspections per score bucket [b, b+width)."""
    f = fact.filter(F.col("inspection_score").isNotNull())
    if source is not None:
        f = f.filter(F.col("source_city") == source)
    return (f.groupBy((F.floor(F.col("inspection_score") / width) * width).cast("int").alias("score_bucket"))
            .agg(_n().alias("inspections")))


def by_type(fact: DataFrame, dim_type: DataFrame) -> DataFrame:
    """Inspections per inspection type and source."""
    per_key = fact.groupBy("inspection_type_key").agg(_n().alias("_n"))
    return (per_key.join(dim_type, "inspection_type_key", "left")
            .groupBy("source_city", "inspection_type_name").agg(F.sum("_n").alias("inspections")))


def top_violation_codes(bridge: DataFrame, dim_violation: DataFrame, k: int = 15) -> DataFrame:
    """The k violation codes cited most often."""
    per_key = bridge.groupBy("violation_key").agg(_n().alias("_n"))
    return (per_key.join(dim_violation.select("violation_key", "violation_code"), "violation_key", "left")
            .groupBy("violation_code").agg(F.sum("_n").alias("citations"))
            .orderBy(F.desc("citations"), F.asc_nulls_first("violation_code")).limit(k))


def pass_rate_trend(fact: DataFrame) -> DataFrame:
    """Pass rate per year and source."""
    return fact.groupBy(_year(fact).alias("year"), "source_city").agg(
        _n().alias("inspections"), pass_rate().alias("pass_rate_pct"))


def lowest_pass_rate_year(fact: DataFrame) -> DataFrame:
    """D9 (cont.): per source, the year with the lowest pass rate (ties: earliest year)."""
    t = pass_rate_trend(fact)
    best = t.groupBy("source_city").agg(F.min(F.struct("pass_rate_pct", "year")).alias("_m"))
    return best.select("source_city", F.col("_m.year").alias("year"), F.col("_m.pass_rate_pct").alias("pass_rate_pct"))


def avg_score_by_year(fact: DataFrame) -> DataFrame:
    """Average score per year (NULL scores ignored)."""
    return fact.groupBy(_year(fact).alias("year")).agg(F.avg("inspection_score").alias("avg_score"),
                                                       F.count("inspection_score").alias("scored"))


def top_entities(fact: DataFrame, dim_restaurant: DataFrame, k: int = 10) -> DataFrame:
    """Most inspected businesses (aggregate per key first, join names after)."""
    per_key = fact.groupBy("restaurant_key").agg(_n().alias("inspections"))
    named = per_key.join(dim_restaurant.select("restaurant_key", "restaurant_name", "source_city"),
                         "restaurant_key", "inner")
    return (named.select("restaurant_name", "source_city", "inspections")
            .orderBy(F.desc("inspections"), "restaurant_name", "source_city").limit(k))


def geo_points(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Inspections per mapped point (latitude, longitude, city)."""
    per_key = fact.groupBy("location_key").agg(_n().alias("_n"))
    return (per_key.join(dim_location, "location_key", "inner")
            .groupBy("latitude", "longitude", "city").agg(F.sum("_n").alias("inspections")))


def denormalized(fact: DataFrame, dim_restaurant: DataFrame, dim_location: DataFrame,
                 dim_type: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The fact with every dimension's attributes (left joins on surrogate keys)."""
    r = dim_restaurant.select("restaurant_key", "restaurant_name", "facility_type", "risk_category")
    loc = dim_location.select("location_key", "address", "city", "state", "zip", "latitude", "longitude")
    t = dim_type.select("inspection_type_key", "inspection_type_name")
    d = dim_date.select("date_key", "full_date", "year", "month")
    return (fact.join(r, "restaurant_key", "left").join(loc, "location_key", "left")
            .join(t, "inspection_type_key", "left").join(d, "date_key", "left")
            .select("inspection_id", "source_city", "restaurant_name", "facility_type", "risk_category",
                    "address", "city", "state", "zip", "latitude", "longitude", "inspection_type_name",
                    "full_date", "year", "month", "inspection_result", "inspection_score"))


def summary_risk_facility(fact: DataFrame, dim_restaurant: DataFrame) -> DataFrame:
    """Inspections and pass rate per risk category x facility type."""
    dim = dim_restaurant.select("restaurant_key", "risk_category", "facility_type")
    per_key = fact.groupBy("restaurant_key").agg(
        _n().alias("_n"), F.count_if(F.col("inspection_result") == RESULT_PASS).alias("_p"))
    return (per_key.join(dim, "restaurant_key", "left").groupBy("risk_category", "facility_type")
            .agg(F.sum("_n").alias("inspections"),
                 (F.sum("_p").cast("double") * 100 / F.sum("_n")).alias("pass_rate_pct")))


# Reports that are slices of one cube: the columns each groups by.
CUBE = {
    "total": [],
    "results_by_group": ["source_city", "inspection_result"],
    "by_year": ["year", "source_city"],
    "risk": ["risk_category"],
    "facility": ["facility_type"],
    "score": ["source_city", "score_bucket"],
    "by_type": ["source_city", "inspection_type_name"],
}
_CUBE_COLS = ["source_city", "inspection_result", "year", "risk_category", "facility_type", "score_bucket", "inspection_type_name"]


def report_cube(fact: DataFrame, dim_restaurant: DataFrame, dim_type: DataFrame, width: int = 5) -> DataFrame:
    """Counts of every report in CUBE, from one scan of the fact.

    The fact is counted by its keys, the counts meet the dimensions, and are counted again by the
    reports' columns; only then do GROUPING SETS multiply the (by now few) rows. ``report`` names the
    slice; columns that a report does not group by are NULL.
    """
    bucket = (F.floor(F.col("inspection_score") / width) * width).cast("int")
    keyed = (fact.groupBy("restaurant_key", "inspection_type_key", _year(fact).alias("year"), "source_city", "inspection_result", bucket.alias("score_bucket"))
             .agg(_n().alias("_n")))
    named = (keyed.join(dim_restaurant.select("restaurant_key", "risk_category", "facility_type"), "restaurant_key", "left")
             .join(dim_type.select("inspection_type_key", "inspection_type_name"), "inspection_type_key", "left")
             .groupBy(*_CUBE_COLS).agg(F.sum("_n").alias("_n")))
    cube = named.groupingSets([[F.col(c) for c in cols] for cols in CUBE.values()], *[F.col(c) for c in _CUBE_COLS]).agg(
        F.grouping_id().alias("_set"), F.sum("_n").alias("inspections"))
    ids = {sum(1 << (len(_CUBE_COLS) - 1 - i) for i, c in enumerate(_CUBE_COLS) if c not in cols): name for name, cols in CUBE.items()}
    name = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    return cube.select(F.element_at(name, F.col("_set").cast("int")).alias("report"), *_CUBE_COLS, "inspections")


def cube_slice(cube: DataFrame, report: str) -> DataFrame:
    """One report of the cube, with its own columns."""
    return cube.where(F.col("report") == report).select(*CUBE[report], "inspections")
