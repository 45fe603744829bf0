import os

import pytest
from pyspark.sql import types as T

from reviewscope import schema, session
from reviewscope.sources import (
    enforce_schema, load_reviews, read_csv_reviews, read_csv_typed, scan_table, write_csv, write_parquet,
)

TRICKY = [(1, 'say "hi", ok'), (2, "two\nlines\r\nthree"), (3, ""), (4, None), (5, "  padded  "), (6, "back\\slash \\\""),
          (7, "'")]


def test_csv_round_trip_keeps_every_character(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write_csv(spark.createDataFrame(TRICKY, "id int, text string").repartition(3), path)
    typed = read_csv_reviews(spark, path, T.StructType.fromDDL("id int, text string"))
    assert sorted(map(tuple, typed.collect())) == TRICKY
    write_parquet(typed, str(tmp_path / "t"))
    assert load_reviews(spark, str(tmp_path / "t")).count() == len(TRICKY)
    assert dict(read_csv_typed(spark, path).dtypes) == {"id": "int", "text": "string"}


def test_load_by_path_or_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    write_csv(df, str(tmp_path / "x.csv"))
    write_parquet(df, str(tmp_path / "x"))
    df.createOrReplaceTempView("some_reviews")
    for source in (str(tmp_path / "x.csv"), str(tmp_path / "x"), "some_reviews"):
        assert [tuple(r) for r in load_reviews(spark, source).collect()] == [(1, "a")]
    assert scan_table(spark, "some_reviews").columns == ["id", "text"]


def test_required_columns_are_checked(spark):
    wanted = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("note", T.StringType(), True)])
    good = spark.createDataFrame([(1, None), (2, "x")], "id int, note string")
    assert enforce_schema(good, wanted).dtypes == [("id", "bigint"), ("note", "string")]
    assert enforce_schema(good, wanted).count() == 2
    bad = spark.createDataFrame([(None, "x")], "id int, note string")
    with pytest.raises(Exception, match="NULL in required column id"):
        enforce_schema(bad, wanted).collect()
    with pytest.raises(Exception, match="NULL in required column id"):
        enforce_schema(bad, wanted).select("note").collect()
    with pytest.raises(Exception, match="NULL in required column id"):
        enforce_schema(bad, wanted).count()


def test_review_schemas_agree():
    names = [f.name for f in schema.RAW_REVIEWS]
    assert names == schema.REVIEW_COLUMNS == [f.name for f in schema.CLEAN_REVIEWS]
    assert {f.dataType.simpleString() for f in schema.SCALED_REVIEWS if f.name in schema.ID_COLUMNS} == {"double"}


def test_intermediate_tables_go_to_the_named_folder(spark):
    root = session.checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    kept = session.materialize(spark.range(10), "numbers")
    folder = f"file://{root}/reviewscope/{spark.sparkContext.applicationId}/numbers-"
    assert kept.inputFiles()[0].startswith(folder) and kept.count() == 10


def test_intermediate_tables_are_removed(spark):
    with session.intermediate_tables(spark):
        kept = session.materialize(spark.range(10), "numbers")
        folder = kept.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        assert os.path.isdir(folder) and kept.count() == 10
    assert not os.path.exists(folder)


def test_default_folder_is_below_the_warehouse(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_CONF", "spark.some.unset.name")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(type(spark.sparkContext), "setCheckpointDir", lambda self, path: None)
    assert session.checkpoint_root(spark) == spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def test_compressed_csv_keeps_every_character(spark, tmp_path):
    path = tmp_path / "t.csv"
    write_csv(spark.createDataFrame(TRICKY, "id int, text string").repartition(2), str(path), compression="gzip")
    assert list(path.glob("*.csv.gz")) and not list(path.glob("*.csv"))
    assert sorted(map(tuple, read_csv_reviews(spark, str(path), T.StructType.fromDDL("id int, text string")).collect())) == TRICKY
