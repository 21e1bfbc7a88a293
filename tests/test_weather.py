from datetime import datetime

from tripmill.operators import weather
from tripmill.sources.files import read_weather


def dimension(spark, hours):
    return spark.createDataFrame([(i + 1, datetime(2025, 1, 1, h)) for i, h in enumerate(hours)], "datetime_id bigint, full_datetime timestamp_ntz")


def test_first_in_file_order_wins(spark, tmp_path):
    lines = ["datetime,temp,conditions"]
    lines += [f"2025-01-01T00:00:00,{i},c{i}" for i in range(500)]
    lines += ["2025-01-01T01:30:00,1,half past", "n/a,1,bad", "2025-01-01T05:00:00,1,other"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    (tmp_path / "b.csv").write_text("datetime,temp,conditions\n2025-01-01T00:00:00,-5,late\n2025-01-01T01:00:00,7,one\n")
    raw = read_weather(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    try:
        out = weather.build_dim_weather(raw, dimension(spark, (0, 1, 2)), small=True).orderBy("datetime_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r) for r in out] == [(1, 0.0, "c0"), (2, 7.0, "one")]


def test_only_present_attributes_are_kept(spark):
    raw = spark.createDataFrame([("2025-01-01 00:00:00", 5.0, "x", 1)], "datetime string, uvindex double, name string, humidity int")
    out = weather.build_dim_weather(raw, dimension(spark, (0,)), small=False)
    assert out.columns == ["datetime_id", "humidity", "uvindex"]
    assert tuple(out.first()) == (1, 1, 5.0)
