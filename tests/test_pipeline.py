"""End-to-end batch job and determinism across partitioning."""

import datetime as dt
import tempfile

from tidewater.plans import pipeline, registry
from tidewater.sources.tables import current_version, read_current

from conftest import SF001


def test_pipeline_end_to_end_and_rerun_is_noop(spark):
    base = tempfile.mkdtemp(prefix="tidewater-test-")
    cfg = pipeline.default_config(spark, base=base, as_of=dt.date(2001, 12, 1), run_ts=dt.datetime(2001, 12, 1, 6))
    paths = pipeline.run(spark, SF001, cfg)
    counts = {r["table_name"]: r["row_count"] for r in pipeline.row_counts(spark, paths).collect()}
    silver_rows = counts["silver_north_inspections"] + counts["silver_south_inspections"]
    assert counts["fact_inspection"] == silver_rows          # one fact row per validated inspection
    assert counts["bridge_inspection_violation"] == (counts["silver_north_violations"]
                                                     + counts["silver_south_violations"])
    fact = spark.read.parquet(paths["fact_inspection"])
    assert fact.filter("restaurant_key IS NULL OR location_key IS NULL OR inspection_type_key IS NULL").count() == 0
    # second run on the same data: a new dim version with identical rows
    first_dim = counts["dim_restaurant"]
    cfg2 = pipeline.default_config(spark, base=base, as_of=dt.date(2001, 12, 2), run_ts=dt.datetime(2001, 12, 2, 6))
    pipeline.gold(spark, cfg2)
    assert current_version(spark, f"{base}/gold/dim_restaurant") == 2
    assert read_current(spark, f"{base}/gold/dim_restaurant").count() == first_dim


def test_results_do_not_depend_on_shuffle_partitions(spark):
    names = ["scd2_merge", "dedupe_first", "latest_per_key", "bridge_load"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = {}
        for parts in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            out[parts] = {n: sorted(map(tuple, registry.queries()[n](spark, SF001).collect())) for n in names}
        assert out["3"] == out["11"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bi_extracts(spark):
    base = tempfile.mkdtemp(prefix="tidewater-test-")
    cfg = pipeline.default_config(spark, base=base)
    paths = pipeline.run(spark, SF001, cfg)
    out = pipeline.extracts(spark, cfg, paths)
    assert spark.read.parquet(out["fact_inspections_denormalized"]).count() == \
        spark.read.parquet(paths["fact_inspection"]).count()
    top = spark.read.option("header", True).csv(out["summary_top_violations"])
    assert 0 < top.count() <= 15


def test_views_run_reference_style_sql(spark):
    base = tempfile.mkdtemp(prefix="tidewater-test-")
    cfg = pipeline.default_config(spark, base=base)
    paths = pipeline.run(spark, SF001, cfg)
    pipeline.register_views(spark, paths)
    hist = spark.sql("""
        SELECT restaurant_name, source_city, license_number FROM dim_restaurant
        WHERE (restaurant_name, source_city, COALESCE(license_number, '')) IN (
            SELECT restaurant_name, source_city, COALESCE(license_number, '') FROM dim_restaurant
            GROUP BY restaurant_name, source_city, COALESCE(license_number, '') HAVING COUNT(*) > 1)""")
    assert hist.count() == 0                      # a first load has no history yet
    multi = spark.sql("""SELECT restaurant_name, COUNT(*) FROM dim_restaurant WHERE is_current = True
                         GROUP BY restaurant_name, source_city, license_number HAVING COUNT(*) > 1""")
    assert multi.count() == 0
    assert spark.sql("SELECT COUNT(*) FROM fact_inspection").first()[0] > 0
