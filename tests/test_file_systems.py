"""Everything that touches files, on a file system that is not the default one."""

import pytest
from test_pipeline import EXPECTED_DAILY, _daily, _load, _publish
from test_publishing import by_day, sales

from orderflow.operators import gold, runlog
from orderflow.plans import steps
from orderflow.sources import staging, tables
from orderflow.sources.files import read_csv, read_table
from orderflow.sources.metric_log import read_log
from orderflow.schemas import ORDERS_RAW


@pytest.fixture
def other(spark, tmp_path):
    """A folder of this machine under a scheme of its own, which only Hadoop's readers can open."""
    (tmp_path / "mounted").mkdir()
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    link = "fs.viewfs.mounttable.lake.link./data"
    settings.set(link, f"file://{tmp_path}/mounted")
    settings.set("fs.viewfs.impl.disable.cache", "true")
    yield "viewfs://lake/data"
    settings.unset(link)


@pytest.fixture
def elsewhere(spark, other, request, monkeypatch):
    name = "else_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())[:40]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{other}/{name}'")
    # The session's own folder for staged copies cannot be changed while it runs.
    monkeypatch.setattr(staging, "work_root", lambda spark: f"{other}/work")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_all_steps_run_on_another_file_system(spark, other, elsewhere, tmp_path, feeds):
    for name, path in feeds.items():
        target = tmp_path / "mounted" / f"{name}.csv"
        target.write_text(open(path).read())
    there = {name: f"{other}/{name}.csv" for name in feeds}
    lake = steps.Lake(spark, elsewhere, f"{other}/metrics", "run-1", as_of="2025-05-20 00:00:00")
    _load(lake, there, "orders", "orders")
    steps.validate_orders(lake, today="2025-07-01", summary_path=f"{other}/summary")
    steps.review_late_orders(lake, tolerance_hours=24 * 365)
    _publish(lake)
    _publish(lake)
    assert _daily(lake) == EXPECTED_DAILY
    for table in ("orders_bronze", "orders_silver", "daily_sales_summary", "customers_silver"):
        files = lake.table(table).inputFiles()
        assert files and all(file.startswith(f"{other}/{elsewhere}/") for file in files)
    assert (tmp_path / "mounted" / elsewhere / "daily_sales_summary").is_dir()
    metrics = steps.collect_gold_metrics(lake)
    assert metrics["total_days"] == 3 and metrics["gold_table_last_updated_timestamp"]
    steps.record_run(lake)
    log = read_log(spark, f"{other}/metrics")
    assert [r.status for r in runlog.run_status(log).collect()] == ["success"]
    assert (tmp_path / "mounted" / "metrics").is_dir()


def test_staging_reading_and_retiring(spark, other, elsewhere, tmp_path):
    with staging.staging_scope():
        staged = staging.stage(sales(spark, (1, 1), (2, 2)))
        assert all(file.startswith(f"{other}/work/") for file in staged.inputFiles())
        assert any((tmp_path / "mounted" / "work").rglob("*.parquet"))
    assert not any((tmp_path / "mounted" / "work").rglob("*.parquet"))
    name = f"{elsewhere}.sales"
    tables.publish_all_dates(sales(spark, (1, 1), (2, 2)), name)
    tables.publish_all_dates(sales(spark, (2, 3)), name)
    assert by_day(spark, name) == {2: [3]}
    assert tables.sweep_retired(spark, name, older_than=-5) == 2
    assert by_day(spark, name) == {2: [3]} and gold.last_written(spark.table(name)).first()[0]
    (tmp_path / "mounted" / "in.csv").write_text("order_id,status\n5,completed\n")
    assert [r.order_id for r in read_csv(spark, f"{other}/in.csv", ORDERS_RAW).collect()] == [5]
    sales(spark, (1, 1)).write.partitionBy("order_date").parquet(f"{other}/plain")
    assert tables.partition_columns(spark, f"{other}/plain") == ["order_date"]
    assert read_table(spark, f"{other}/plain").count() == 1


def test_a_cluster_must_name_a_shared_folder(spark, monkeypatch):
    class Conf:
        def __init__(self, values):
            self.get = lambda name, default=None: values.get(name, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({key.replace("_", "."): value for key, value in values.items()})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.work_root(Session(spark_master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.work_root(Session(spark_master="local-cluster[3,2,1000]"))
    local = Session(spark_master="local[4]", spark_sql_warehouse_dir="file:/w/")
    assert staging.work_root(local) == "file:/w-work"
