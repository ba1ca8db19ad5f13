"""Queries over whole tables, and stores that are really written."""

from pyspark.sql import functions as F

from cellwright import plans, sources

from .conftest import DATA


def test_whole_tables(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    rows = [(r.us is None, r.us, r.seq) for r in plans.QUERIES["sort_nulls_last_all"](spark, DATA).collect()]
    assert len(rows) == events.count() and rows[-1][0] and rows == sorted(rows, key=lambda r: (r[0], r[1] or 0, r[2]))
    wide = plans.QUERIES["pivot_all_units"](spark, DATA)
    assert wide.select("unit_id").distinct().count() == events.select("user_id").distinct().count()
    assert plans.QUERIES["split_fast_slow_all"](spark, DATA).count() == 2 * spark.read.parquet(f"{DATA}/lineitem.parquet").count()


def test_compaction_and_date_check_run_on_stores(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    filled = plans.QUERIES["compact_ffill"](spark, DATA)
    assert filled.count() == events.count() and all("/compact-" in f for f in filled.inputFiles())
    units = plans.QUERIES["compact_inject_unit"](spark, DATA)
    want = {r.event_id: f"u{r.user_id % 20}" for r in events.collect()}
    assert {r.event_id: r.unit_id for r in units.collect()} == want and all("/compact-" in f for f in units.inputFiles())
    dates = plans.QUERIES["dq_partition_date"](spark, DATA).collect()
    assert all(r.ok for r in dates) and {r.folder for r in dates} == {str(r.d) for r in events.select(F.to_date("ts").alias("d")).distinct().collect()}


def test_missing_paths_and_pruned_folders(spark, tmp_path):
    df = spark.range(10).withColumn("date", F.expr("date_add(date'2024-01-01', cast(id as int))"))
    store = str(tmp_path / "store")
    sources.write_store(df, store, ["date"])
    schema = sources.read_store(spark, store).schema
    assert sources.read_store(spark, str(tmp_path / "none"), schema=schema).count() == 0
    assert sources.read_store(spark, str(tmp_path / "none"), store, schema=schema).count() == 10
    two = sources.scoped(sources.read_store(spark, store), "2024-01-02", "2024-01-03")
    assert two.count() == 2 and "PartitionFilters: [isnotnull(date" in two._jdf.queryExecution().executedPlan().toString()
    assert sources.trim_store(spark, store, 7, "2024-01-10") == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert sources.read_store(spark, store).count() == 7


def test_storage_figures_are_those_of_the_files(spark):
    """What SQL cannot tell: names, bytes, wire sizes, layouts, drift, against pyarrow and plain loops."""
    import os

    import pyarrow.parquet as pq

    path = f"{DATA}/events.parquet"
    table = pq.read_table(path)
    one = plans.QUERIES["agg_storage_stats"](spark, DATA).first()
    ts = [t for t in table["ts"].to_pylist() if t is not None]
    assert (one.files, one.bytes, one.rows) == (1, os.path.getsize(path), table.num_rows)
    assert (one.first_ts, one.last_ts) == (min(ts), max(ts))
    ratio = plans.QUERIES["agg_storage_ratio"](spark, DATA).first()
    raw = sum(len(a.encode()) + len(b.encode()) + 4 for a, b in zip(table["event_type"].to_pylist(), table["props"].to_pylist()) if a is not None and b is not None)
    assert (ratio.rows, ratio.raw_bytes, ratio.file_bytes) == (table.num_rows, raw, os.path.getsize(path))
    assert abs(ratio.ratio - raw / os.path.getsize(path)) < 1e-9 and abs(ratio.bytes_per_row - os.path.getsize(path) / table.num_rows) < 1e-9
    layouts = {r.layout: r for r in plans.QUERIES["agg_schema_compare"](spark, DATA).collect()}
    assert set(layouts) == {"narrow", "compound", "wide"} and layouts["narrow"].rows == layouts["compound"].rows == table.num_rows
    assert layouts["wide"].rows == len({(u, t) for u, t in zip(table["user_id"].to_pylist(), table["ts"].to_pylist())})
    assert all(abs(r.bytes_per_row - r.bytes / r.rows) < 1e-9 and r.bytes > 0 for r in layouts.values())
    assert [tuple(r) for r in plans.QUERIES["src_filename_col"](spark, DATA).collect()] == [("events.parquet", table.num_rows)]
    assert [r.column for r in plans.QUERIES["dq_schema_drift"](spark, DATA).collect()] == [c for c in table.column_names if c not in ("event_id", "ts", "user_id", "value")]
