"""CSV readers (FIXTURES §2: multi-line vs single-line), versioned tables, namespaces, config."""

import os
import tempfile

import pytest

from tidewater.config import RunConfig, attribute_map
from tidewater.plans.pipeline import NORTH_MAP, SOUTH_MAP
from tidewater.sinks import ensure_namespace, register_view, write_table, write_version
from tidewater.sources.csv import read_csv, string_schema
from tidewater.sources.tables import current_version, list_tables, read_current, table_exists, version_path


def _csv(text):
    d = tempfile.mkdtemp(prefix="tidewater-csv-")
    with open(os.path.join(d, "f.csv"), "w") as f:
        f.write(text)
    return d


def test_multiline_vs_single_line(spark):
    path = _csv('id,name\n1,"A ""R"" US"\n2,"line1\nline2"\n')
    schema = string_schema(["id", "name"])
    multi = [tuple(r) for r in read_csv(spark, path, schema=schema, multiline=True).orderBy("id").collect()]
    assert multi == [("1", 'A "R" US'), ("2", "line1\nline2")]
    single = [tuple(r) for r in read_csv(spark, path, schema=schema, multiline=False).collect()]
    # single-line reader: doubled quotes kept verbatim, the quoted newline splits row 2
    assert single == [("1", '"A ""R"" US"'), ("2", "line1"), ('line2"', None)]


def test_versioned_table_pointer(spark):
    base = tempfile.mkdtemp(prefix="tidewater-ver-")
    assert read_current(spark, base) is None
    df1 = spark.createDataFrame([(1, True), (2, False)], "k int, is_current boolean")
    assert write_version(spark, df1, base) == 1
    assert write_version(spark, df1.filter("k = 1"), base) == 2
    assert current_version(spark, base) == 2
    assert read_current(spark, base).count() == 1
    assert spark.read.parquet(version_path(spark, base, 1)).count() == 2      # old version untouched


def test_namespace_and_listing(spark):
    ensure_namespace(spark, "tw_test_silver")
    assert list_tables(spark, "tw_test_silver", include_temporary=False).count() == 0
    with pytest.raises(ValueError):
        ensure_namespace(spark, "bad; drop")


def test_run_config_validation():
    with pytest.raises(ValueError):
        RunConfig(base_path=" ")
    cfg = RunConfig(base_path="/x", silver_path="/y")
    assert cfg.layer("bronze") == "/x/bronze" and cfg.layer("silver") == "/y"


def test_attribute_map():
    m = {a.concept: (a.left, a.right) for a in attribute_map(NORTH_MAP, SOUTH_MAP)}
    assert m["restaurant_name"] == ("DBA_Name", "Restaurant_Name")
    assert m["license_number"] == ("License", None)
    assert len(m) == 17


def test_temp_view_sql_anti_join(spark):
    stg = spark.createDataFrame([("a", None), ("b", "1"), ("c", "2")], "name string, lic string")
    dim = spark.createDataFrame([("a", "", True), ("b", "1", False)], "name string, lic string, is_current boolean")
    register_view(stg, "staging_v")
    register_view(dim, "dim_v")
    got = spark.sql("""SELECT s.name FROM staging_v s LEFT ANTI JOIN dim_v t
                       ON s.name = t.name AND coalesce(s.lic, '') = coalesce(t.lic, '') AND t.is_current""")
    assert sorted(r[0] for r in got.collect()) == ["b", "c"]


def test_scale_conf_sizes_partitions():
    from tidewater.session import JIT_HUGE_METHODS, scale_conf
    big = scale_conf(100 * 2**40, total_cores=8000)
    assert big["spark.sql.shuffle.partitions"] == "409600"          # 256 MB each
    small = scale_conf(2**30, total_cores=64)
    assert small["spark.sql.shuffle.partitions"] == "128"           # at least two waves
    assert JIT_HUGE_METHODS in big["spark.executor.extraJavaOptions"]


def test_unreadable_version_log_is_an_error(spark, tmp_path):
    base = str(tmp_path / "t")
    df = spark.range(10)
    assert write_version(spark, df, base) == 1
    bad = tmp_path / "t" / "_versions" / "part-bad.txt.gz"
    bad.write_bytes(b"not gzip")
    with pytest.raises(Exception):
        write_version(spark, df.limit(1), base)
    bad.unlink()
    assert read_current(spark, base).count() == 10


def test_crash_before_commit_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path / "t")
    write_version(spark, spark.range(10), base)
    spark.range(3).write.parquet(f"{base}/v=2-half")     # a writer that died before its commit
    assert read_current(spark, base).count() == 10
    assert write_version(spark, spark.range(5), base) == 2
    assert read_current(spark, base).count() == 5


def test_full_refresh_replaces_every_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10).selectExpr("id", "id % 3 AS p"), path, partition_by=["p"])
    write_table(spark.range(4).selectExpr("id", "0 AS p"), path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 4


def test_table_exists_with_provider(spark):
    spark.range(1).write.mode("overwrite").saveAsTable("exists_probe")
    assert table_exists(spark, "exists_probe") and table_exists(spark, "exists_probe", "parquet")
    assert not table_exists(spark, "exists_probe", "csv") and not table_exists(spark, "no_such_table")
    spark.sql("DROP TABLE exists_probe")
