"""Dimension files, landing trees, versioned tables and split tables."""

from datetime import date

import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from dugout.operators import model
from dugout.sources import games, tables
from dugout.sources.schemas import ddl

SCHEMA = ddl("key int, name string, size double")


def test_dimension_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_bytes(b'Name,extra,KEY , size\r"A, B",1,7,2.5\rC,,x,\r')
    got = tables.read_dimension(spark, str(path), SCHEMA).orderBy("name").collect()
    assert [tuple(r) for r in got] == [(7, "A, B", 2.5), (None, "C", None)]
    path.write_text("key,title,size\n1,a,2\n")
    with pytest.raises(ValueError, match="no column name"):
        tables.read_dimension(spark, str(path), SCHEMA)
    path.write_text("size,name,key\n1,a,2\n")
    assert tuple(tables.read_dimension(spark, str(path), SCHEMA).first()) == (2, "a", 1.0)
    path.write_text("")
    with pytest.raises(ValueError, match="no column"):
        tables.read_dimension(spark, str(path), SCHEMA)


@pytest.mark.parametrize("layout", [games.PLAIN, games.KEYED])
def test_listing_prunes_directories(spark, tmp_path, layout, rows, monkeypatch):
    def put(y, m, d, name):
        if layout is games.PLAIN:
            path = tmp_path / f"year_{y}" / f"month_{m}" / f"day_{d}" / f"gid_{y}_{m}_{d}_x" / name
        else:
            path = tmp_path / f"year={y}" / f"month={m}" / f"day={d}" / f"game=gid_{y}_{m}_{d}_x" / f"topic={name}" / "part-0.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("{}")

    for y, m, d in (("2014", "12", "31"), ("2015", "01", "02"), ("2015", "01", "00"), ("2015", "03", "05")):
        put(y, m, d, "linescore.json")
        put(y, m, d, "other.txt")
    put("2015", "01", "02", "boxscore.json")
    topics = ("linescore.json", "boxscore.json")
    every = games.list_games(spark, str(tmp_path), topics, layout=layout)
    assert every.count() == 5 and every.filter("bytes <> 2").count() == 0
    some = games.list_games(spark, str(tmp_path), topics, date(2015, 1, 1), date(2015, 2, 20), layout)
    assert rows(some, "day", "file_name") == sorted([(date(2015, 1, 2), "linescore.json"), (date(2015, 1, 2), "boxscore.json"), (None, "linescore.json")], key=repr)
    assert all("2015" in f and "month" in f and "03" not in f.split("month")[1][:4] for f in some.inputFiles())
    lack = games.missing_files(spark, str(tmp_path), topics, layout=layout)
    assert rows(lack, "game_id", "file_name") == [(f"gid_{k}_x", "boxscore.json") for k in ("2014_12_31", "2015_01_00", "2015_03_05")]
    assert games.list_games(spark, str(tmp_path), topics, date(1999, 1, 1), date(1999, 2, 1), layout).count() == 0


def test_versions_survive_a_kill_at_each_step(spark, tmp_path, monkeypatch, rows):
    path, schema = str(tmp_path / "t"), ddl("k int, v string")
    assert tables.read_version(spark, path, schema).count() == 0
    tables.replace_version(spark.createDataFrame([(1, "a"), (2, "b")], schema), path)
    late = tables.read_version(spark, path, schema)
    # killed while writing: files but no success marker
    half = tmp_path / "t" / "version-0000000002-dead"
    tables.read_version(spark, path, schema).limit(1).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert rows(tables.read_version(spark, path, schema)) == [(1, "a"), (2, "b")]
    # killed after the new version is whole, before old ones go
    monkeypatch.setattr(tables, "_remove", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    for n in range(2):
        new = tables.read_version(spark, path, schema).withColumn("v", F.concat("v", F.lit("+")))
        if n == 0:
            tables.replace_version(new, path)
        else:
            with pytest.raises(OSError):
                tables.replace_version(new, path)
    monkeypatch.undo()
    assert rows(tables.read_version(spark, path, schema)) == [(1, "a++"), (2, "b++")]
    assert rows(tables.read_version(spark, path, schema, back=1)) == [(1, "a+"), (2, "b+")]
    assert rows(late) == [(1, "a"), (2, "b")]
    tables.replace_version(tables.read_version(spark, path, schema).filter("k = 1"), path)
    assert rows(tables.read_version(spark, path, schema)) == [(1, "a++")]
    assert len(tables._versions(spark, path)) == 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_best_split_is_the_root_of_the_fitted_tree(spark, seed):
    df = spark.range(400).select(
        (F.floor(F.rand(seed) * 9)).cast("double").alias("a"), F.floor(F.rand(seed + 10) * 30).cast("double").alias("b"), F.floor(F.rand(seed + 20) * 3).alias("c"), F.floor(F.randn(seed + 30) * 100).alias("e")
    )
    label = F.col("e") + F.when(F.col("b") > 11 + seed, 90).otherwise(0) + F.col("a") * 5
    df = df.withColumn("label", label.cast("long")).cache()
    found = model.best_split(df, ["a", "b", "c"], "label").first()
    fitted = DecisionTreeRegressor(maxDepth=1, maxBins=64).fit(model.to_vectors(df, ["a", "b", "c"], "label"))
    root = fitted._call_java("rootNode")
    assert ["a", "b", "c"][root.split().featureIndex()] == found["feature"]
    assert df.filter(F.col(found["feature"]) <= root.split().threshold()).count() == found["n_left"]
    rough = model.best_split(df, ["a", "b", "c"], "label", {"b": [4.0, 9.0, 19.0]}).first()
    assert rough["gain"] <= found["gain"]
