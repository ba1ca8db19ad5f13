import glob
import os

import pytest
from pyspark.sql import functions as F

from cellwright import sources as S


def test_partitions_by_event_date_and_prunes(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00"), (3, "2024-01-02 11:00:00")], "id long, t string")
    path = str(tmp_path / "store")
    S.write_store(S.with_event_date(df.withColumn("ts", F.to_timestamp("t")).withColumn("site", F.lit(1))), path, ("site", "date"))
    assert sorted(os.path.basename(p) for p in glob.glob(f"{path}/site=1/*")) == ["date=2024-01-01", "date=2024-01-02"]
    got = S.scoped(S.read_store(spark, path), "2024-01-02", "2024-01-03", site=1)
    assert got.count() == 2
    assert "PartitionFilters: [" in got._jdf.queryExecution().executedPlan().toString()
    assert S.scoped(S.read_store(spark, path), "2030-01-01", "2030-01-02").count() == 0


def test_schemas_unite_by_name(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(2).write.parquet(f"{path}/a")
    spark.range(2).withColumn("extra", F.lit("x")).write.parquet(f"{path}/b")
    assert set(S.read_store(spark, f"{path}/a", f"{path}/b").columns) == {"id", "extra"}


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "c")
    for k in range(4):
        spark.range(k * 10, k * 10 + 10).withColumn("v", F.when(F.col("id") % 2 == 0, 1)).coalesce(1).write.mode("append").parquet(f"{path}/date=2024-01-01")
    spark.range(3).coalesce(1).write.parquet(f"{path}/date=2024-01-02")
    dry = S.compact(spark, path, dry_run=True).collect()
    assert [(r.files, r.rows, r.compacted) for r in dry] == [(4, 40, False)]
    done = S.compact(spark, path).collect()
    assert [(r.files, r.rows, r.compacted) for r in done] == [(4, 40, True)] and done[0].null_pct == pytest.approx(25.0)
    assert len(glob.glob(f"{path}/date=2024-01-01/*.parquet")) == 1
    assert spark.read.parquet(path).count() == 43
    assert S.compact(spark, path).count() == 0  # nothing new
    assert S.compact(spark, path, min_files=1, min_age_s=3600).count() == 0  # too young


def test_hot_and_current(spark, tmp_path):
    path = str(tmp_path / "hot")
    S.publish_hot(spark.range(3), path)
    S.publish_hot(spark.range(5), path)
    assert S.read_hot(spark, path).count() == 5
    rows = spark.createDataFrame([(s, c, t, v) for s in (0, 1) for c in (0, 1) for t, v in ((1, 1.0), (2, 2.0))], "site long, cell long, ts long, v double")
    assert sorted(tuple(r) for r in S.merge_current(None, rows, ["site", "cell"], "ts").select("site", "cell", "v").collect()) == [(0, 0, 2.0), (0, 1, 2.0), (1, 0, 2.0), (1, 1, 2.0)]
    late = spark.createDataFrame([(0, 0, 1, 9.0)], rows.schema)
    assert {r.v for r in S.merge_current(rows, late, ["site", "cell"], "ts").collect()} == {2.0}


def test_recording(spark, tmp_path):
    lines = [
        "ems/site/S1/unit/U1/bms/bms_1/SOC/float,\"{\"\"value\"\":1}\",0,0,1.0,0.1", "ems/site/S2/unit/U1/bms/bms_1/SOC/float,x,0,0,1.0,0.1",
        "ems/site/S1/unit/U1/root/r/IP/string,x,0,0,1.0,0.1", "ems/site/S1/meter/m/kW/float,x,0,0,1.0,0.1", "other/topic,x,0,0,1.0,0.1",
    ]
    (tmp_path / "r.csv").write_text("\n".join(lines))
    got = S.read_recording(spark, str(tmp_path / "r.csv"), "S1").collect()
    assert [(r.topic, r.unit_id, r.point_name, r.dtype) for r in got] == [("unit/U1/bms/bms_1/SOC/float", "U1", "SOC", "float")]


def test_annotated_csv_blocks(spark, tmp_path):
    ems = "#group,false,false,true,true\n#datatype,string,long,dateTime:RFC3339,double,string,string,string\n#default,_result,,,,,,\n,result,table,_time,_value,_field,_measurement,point_name\n,,0,2026-04-10T13:00:01Z,63.5,float,bms,SysSOC\n,,0,2026-04-10T13:00:02Z,7,integer,bms,Mode"
    std = "#group,false\n#datatype,string,long,dateTime:RFC3339,string,string,string\n#default,_result,,,,,\n,result,table,_time,_value,_field,_measurement\n,,0,2026-04-10T13:00:03Z,on,State,pcs"
    (tmp_path / "a.csv").write_text(ems + "\n\n" + std + "\n\n")
    got = {r.field: r for r in S.read_annotated_csv(spark, str(tmp_path / "a.csv")).collect()}
    assert got["float"].value_f == 63.5 and got["float"].tags == {"point_name": "SysSOC"} and got["float"].measurement == "bms"
    assert got["integer"].value_i == 7 and got["integer"].value_f is None
    assert got["State"].value_str == "on"


def test_template_columns():
    assert S.partition_columns("site={site_id}/{year}/{month}/{day}") == ["site_id", "date"]
