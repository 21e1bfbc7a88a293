import json

import pytest
from pyspark.errors import AnalysisException

from tripmill import fixtures
from tripmill.operators import geometry
from tripmill.sources import files, geojson


def test_trip_files_unite_by_name(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "id int, extra double").write.parquet(str(tmp_path / "a.parquet"))
    spark.createDataFrame([(2.5, 3)], "late double, id int").coalesce(1).write.parquet(str(tmp_path / "b.parquet"))
    spark.createDataFrame([(9, 9.0)], "id int, extra double").write.parquet(str(tmp_path / "deep" / "c.parquet"))
    (tmp_path / "note.txt").write_text("x")
    rows = files.read_trips(spark, str(tmp_path)).select("id", "extra", "late").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 2.0, None), (3, None, 2.5)]


def test_trip_files_of_different_types_are_widened(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, code string").write.parquet(str(tmp_path / "a.parquet"))
    spark.createDataFrame([(2.5, "b")], "id double, code string").write.parquet(str(tmp_path / "b.parquet"))
    df = files.read_trips(spark, str(tmp_path))
    assert sorted(tuple(r) for r in df.collect()) == [(1.0, "a"), (2.5, "b")]


def test_trip_files_of_equal_types_are_one_scan(spark, tmp_path):
    """Twelve entries of three forms, dealt in turn; the last is a folder of two files that lack a column each."""
    kinds = ["id int, code string", "id double, code string", "code string, id bigint, late int"]
    expected = []
    for n in range(12):
        row = [(n, "a"), (n + 0.5, "b"), ("c", n, n)][n % 3]
        frame, path = spark.createDataFrame([row], kinds[n % 3]).coalesce(1), str(tmp_path / f"m{n:02}.parquet")
        if n == 11:
            frame.drop("late").write.parquet(path)
            frame.drop("code").write.mode("append").parquet(path)
            expected += [(11.0, "c", None), (11.0, None, 11)]
        else:
            frame.write.parquet(path)
            expected.append((float(row[n % 3 // 2]), row[1 - n % 3 // 2], n if n % 3 == 2 else None))
    df = files.read_trips(spark, str(tmp_path))
    assert sorted(map(str, map(tuple, df.select("id", "code", "late").collect()))) == sorted(map(str, expected))
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == len({"int", "double", "bigint"})
    placed = files.read_trips(spark, str(tmp_path), positions=True)
    assert placed.select(*files.POSITION).distinct().count() == placed.count() == 13


def test_trip_files_with_given_schema(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "id int, extra double").write.parquet(str(tmp_path / "a.parquet"))
    assert files.read_trips(spark, str(tmp_path), "id int").columns == ["id"]


def test_no_trip_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_trips(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        files.read_trips(spark, str(tmp_path / "missing"))


def test_weather_columns_by_name_and_rows_in_order(spark, tmp_path):
    (tmp_path / "a b .csv").write_text('name,datetime,temp,conditions\n"x, y",2025-01-01T00:00:00,1.5,Rain\nx,2025-01-01T00:00:00,bad,Snow\n')
    (tmp_path / "c.csv").write_text("datetime,precip,temp\n2025-01-01T01:00:00,0.25,3\n")
    df = files.read_weather(spark, [str(tmp_path / "a b .csv"), str(tmp_path / "none.csv"), str(tmp_path / "c.csv")])
    rows = df.orderBy("source_order", "block_start", "row_in_block").collect()
    assert [(r["source_order"], r["temp"], r["precip"], r["conditions"]) for r in rows] == [
        (0, 1.5, None, "Rain"),
        (0, None, None, "Snow"),
        (2, 3.0, 0.25, None),
    ]
    assert files.read_weather(spark, [str(tmp_path / "none.csv")]) is None


def test_zone_lookup(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Old","EWR"\n,"No","Id","x"\n264,"Unknown","N/A","N/A"\n1,"EWR","New","EWR"\n')
    rows = files.read_zone_lookup(spark, str(path)).orderBy("LocationID").collect()
    assert [tuple(r) for r in rows] == [(1, "EWR", "New", "EWR"), (264, "Unknown", "N/A", "N/A")]
    assert files.read_zone_lookup(spark, str(tmp_path / "none"), on_error="empty").count() == 0
    with pytest.raises(AnalysisException):
        files.read_zone_lookup(spark, str(tmp_path / "none"))


FEATURES = [
    {"type": "Feature", "properties": {"LocationID": 7}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 4], [0, 0]]]}},
    {"type": "Feature", "properties": {"LocationID": 0, "locationid": "8"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 1]]], [[[9, 9]]]]}},
    {"type": "Feature", "properties": {"LOCATIONID": "9.0"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
    {"type": "Feature", "properties": {"location_id": "abc"}, "geometry": {"type": "Polygon", "coordinates": []}},
    {"type": "Feature", "properties": {"LocationID": 7.9}, "geometry": {"type": "Polygon", "coordinates": [[[4, 4], [6, 6]]]}},
    {"type": "Feature", "properties": None, "geometry": None},
]


@pytest.mark.parametrize("layout", ["document", "lines"])
def test_features_of_both_layouts(spark, tmp_path, layout):
    path = tmp_path / "zones.geojson"
    if layout == "document":
        path.write_text(json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=1))
    else:
        path.write_text('{"type":"FeatureCollection","features":[\n' + ",\n".join(json.dumps(f) for f in FEATURES) + "\n]}\n")
    df = files.read_features(spark, str(path), layout)
    rows = geometry.with_points(geometry.with_location_id(df)).orderBy("feature_order").collect()
    assert [r["location_id"] for r in rows] == [7, 8, 9, None, 7, None]
    assert [len(r["points"]) for r in rows] == [4, 3, 0, 0, 2, 0]
    assert rows[1]["points"] == [[0.0, 0.0], [1.0, 1.0], [9.0, 9.0]]
    centroids = {r["location_id"]: (r["lon"], r["lat"]) for r in geometry.zone_centroids(df).collect()}
    assert centroids == {7: (5.0, 5.0), 8: (4.5, 4.5)}
    assert geometry.count_location_ids(df).first()[0] == 4
    assert files.read_features(spark, str(tmp_path / "none"), layout, on_error="empty").count() == 0


def test_collection_is_one_document_and_reads_back(spark, tmp_path):
    vertices = geometry.reproject(fixtures.vertices(spark, "/root/testdata/sf0.001"))
    ids = spark.range(1, 41).withColumnRenamed("id", "feature_id")
    features = ids.selectExpr(
        "feature_id",
        """CASE WHEN feature_id = 5 THEN map('LocationID', 'a"b') WHEN feature_id = 6 THEN map('zone', 'x')
                ELSE map('locationid', concat(feature_id, '.0'), 'zone', 'z') END AS properties""",
    )
    assembled = geometry.assemble(vertices, features)
    path = tmp_path / "zones"
    assert geojson.write_collection(assembled, str(path)) == 40
    text = "".join(p.read_text() for p in sorted(path.glob("part-*")))
    document = json.loads(text)
    assert document["type"] == "FeatureCollection" and len(document["features"]) == 40
    by_id = {i + 1: f for i, f in enumerate(document["features"])}
    assert by_id[1]["properties"] == {"LocationID": 1, "locationid": "1.0", "zone": "z"}
    assert by_id[5]["properties"]["LocationID"] == 'a"b' and by_id[6]["properties"]["LocationID"] is None
    assert by_id[40]["geometry"] == {"type": "GeometryCollection", "geometries": []}
    wanted = {}
    for r in vertices.orderBy("seq").collect():
        wanted.setdefault(r["feature_id"], {}).setdefault(r["part"], []).append([r["lon"], r["lat"]])
    for feature_id, parts in wanted.items():
        rings = [parts[k] for k in sorted(parts)]
        shape = by_id[feature_id]["geometry"]
        if len(rings) == 1:
            assert shape == {"type": "Polygon", "coordinates": rings}
        else:
            assert shape == {"type": "MultiPolygon", "coordinates": [[r] for r in rings]}
    summary = {r["feature_id"]: tuple(r)[1:] for r in geometry.ring_summary(vertices, ids).collect()}
    assert summary[40] == ("GeometryCollection", 0, 0)
    assert summary[1][1] == len(wanted[1]) and summary[1][2] == sum(map(len, wanted[1].values()))
    again = files.read_features(spark, str(path))
    assert again.count() == 40
    assert geometry.zone_centroids(again).count() == len(wanted) - sum(i in wanted for i in (5, 6))


def test_months_with_disagreeing_types_in_a_folder_with_spaces(spark, tmp_path):
    folder = tmp_path / "trip files"
    spark.sql("SELECT 1 AS id, 7 AS PULocationID, 2.5D AS fare").write.parquet(str(folder / "a b.parquet"))
    spark.sql("SELECT 2 AS id, '8' AS PULocationID, 'n/a' AS fare").write.parquet(str(folder / "c.parquet"))
    spark.sql("SELECT 3 AS id, 'n/a' AS PULocationID, 3.5D AS fare").write.parquet(str(folder / "d.parquet"))
    rows = sorted(map(tuple, files.read_trips(spark, str(folder)).select("id", "PULocationID", "fare").collect()))
    assert rows == [(1, 7.0, 2.5), (2, 8.0, None), (3, None, 3.5)]


def test_doubled_quotes_in_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,B,"Q ""x"" y",s\n')
    assert files.read_zone_lookup(spark, str(path)).first()["Zone"] == 'Q "x" y'
