import os

from tessera.operators import curate as C
from tessera.sources import files as S


def test_column_resolution_and_renames(spark):
    assert C.resolve_key(["x", "Smiles", "SMILES"]) == "SMILES"
    assert C.resolve_target(["Target", "x"], "target") == "Target"
    df = spark.createDataFrame([("C", 1)], "Drug string, Y int")
    assert C.rename_source_columns(df).columns == ["smiles", "label"]
    both = spark.createDataFrame([("C", "D")], "Drug string, smiles string")
    assert C.rename_source_columns(both).columns == ["Drug", "smiles"]


def test_header_cleaning(spark):
    df = spark.createDataFrame([(1, 2)], "`﻿a ` int, ` b` int")
    assert C.clean_header(df).columns == ["a", "b"]


def test_csv_na_spellings_and_typed_columns(spark):
    path = S.scratch_path(spark, "csvtest")
    spark.createDataFrame([("1", "NA", "2.5"), ("2", "x", "bad"), ("3", "", "N/A")], "a string, b string, c string") \
        .coalesce(1).write.option("header", True).csv(path)
    back = S.read_csv(spark, path, typed={"a": "bigint", "c": "double"}).orderBy("a").collect()
    assert [r.b for r in back] == [None, "x", None]
    assert [r.c for r in back] == [2.5, None, None]


def test_source_registry(spark):
    df = S.get_data(spark, "parquet", path=os.path.join("/root/testdata/sf0.001", "region.parquet"))
    assert df.count() == 5
