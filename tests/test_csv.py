"""CSV cases of FIXTURES B5."""

from pyspark.sql import functions as F

from conftest import rows
from trellis.functions import scalar as S
from trellis.model import Graph
from trellis.session import scratch_path
from trellis.sources import csv as C


def test_round_trip_keeps_hard_values(spark):
    data = [(1, 'a,b', 'say "hi"'), (2, "line1\nline2", None), (3, "", "x")]
    df = spark.createDataFrame(data, "k long, s string, t string")
    path = scratch_path(spark, "t-csv")
    C.unload_csv(df.repartition(3), path)
    back = C.read_positional(spark, path, 3, multiline=True)
    got = rows(back.select(S.to_integer(C.row(0)).alias("k"), C.row(1).alias("s"), C.row(2).alias("t")))
    assert got == rows(df)


def test_header_and_numbers(spark):
    df = spark.createDataFrame([("12",), (" 12 ",), ("3.7",), ("abc",), ("",), (None,), ("-3.7",)], "v string")
    got = [r.i for r in df.select(S.to_integer("v").alias("i")).collect()]
    assert got == [12, 12, 3, None, None, None, -3]
    f = [r.f for r in df.select(S.to_float("v").alias("f")).collect()]
    assert f == [12.0, 12.0, 3.7, None, None, None, -3.7]
    path = scratch_path(spark, "t-csvh")
    C.unload_csv(spark.createDataFrame([(1, "x")], "a long, b string"), path, header=True)
    assert rows(C.read_header_csv(spark, path, "a long, b string")) == [(1, "x")]


def test_row_index_past_end_is_null(spark):
    path = scratch_path(spark, "t-csvp")
    C.unload_csv(spark.createDataFrame([(1, "x")], "a long, b string"), path)
    r = C.read_positional(spark, path, 2).select(C.row(0).alias("a"), C.row(5).alias("z")).collect()
    assert [(x.a, x.z) for x in r] == [("1", None)]


def test_inline_csv(spark):
    df = spark.createDataFrame([(1, "Ann,1990\nBen,1985\n")], "id int, csv_data string")
    got = rows(C.inline_csv(df, "csv_data", "name STRING, year INT", keep=["id"]), "id", "line_no", "name", "year")
    assert got == [(1, 0, "Ann", 1990), (1, 1, "Ben", 1985)]


def test_parts_in_name_order_and_empty(spark):
    rows_ = spark.createDataFrame([("p1", 1), ("p1", 2), ("p2", 2), ("p2", 3), ("p3", 1)], "part string, k long")
    g = Graph().with_nodes("N", spark.createDataFrame([(3,)], "k long"), "k")
    g2, summary = C.load_parts_merge_nodes(g, rows_, "N", {"k": F.col("k")})
    assert rows(summary) == [("p1", 2, 0), ("p2", 0, 2), ("p3", 0, 1)]
    assert rows(g2.nodes["N"]) == [(1,), (2,), (3,)]
    empty = rows_.where(F.lit(False))
    g3, s3 = C.load_parts_merge_nodes(g, empty, "N", {"k": F.col("k")})
    assert s3.count() == 0 and rows(g3.nodes["N"]) == [(3,)]


def test_parts_tagged_by_file_name(spark):
    path = scratch_path(spark, "t-parts")
    df = spark.range(0, 30).select(F.col("id").alias("k"))
    C.unload_csv(df.repartition(3, "k"), path)
    tagged = C.with_part(C.read_positional(spark, path, 1))
    parts = sorted({r.part for r in tagged.select("part").collect()})
    assert len(parts) == 3 and all(p.startswith("part-") and p.endswith(".csv") for p in parts)
    assert tagged.count() == 30


def test_parts_tagged_by_partition_folder(spark):
    path = scratch_path(spark, "t-pfold")
    df = spark.range(0, 12).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    C.unload_csv(df, path, partition_by=["g"])
    name = path.rstrip("/").split("/")[-1]
    tagged = C.with_part(C.read_positional(spark, path, 1), folder=name)
    assert sorted({r.part for r in tagged.select("part").collect()}) == ["g=0", "g=1", "g=2"]
