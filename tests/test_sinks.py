"""Result-shape normaliser, raw results, row index and report round trip."""

from pyspark.sql import functions as F

from conftest import rows
from trellis.session import scratch_path
from trellis.sources import sinks as K


def norm(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    v = K.parse_or_raw(F.col("t"))
    out = df.select("i", F.posexplode(K.normalize_result(v)).alias("pos", "e"))
    return [(r.i, r.pos, r.e) for r in out.select("i", "pos", F.to_json("e").alias("e")).orderBy("i", "pos").collect()]


def test_normaliser_shapes(spark):
    texts = ['[1, 2]', '{"data": [3]}', '{"records": [4]}', '{"results": [5, 6]}', '{"data": 5, "x": 1}',
             'null', None, '', '"text"', '""', 'not json']
    got = norm(spark, texts)
    assert got == [(0, 0, "1"), (0, 1, "2"), (1, 0, "3"), (2, 0, "4"), (3, 0, "5"), (3, 1, "6"),
                   (4, 0, '{"data":5,"x":1}'), (7, 0, '{"raw_result":""}'), (8, 0, '"text"'),
                   (10, 0, '{"raw_result":"not json"}')]


def test_write_rows_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"), F.lit("x").alias("v")).repartition(7)
    out = scratch_path(spark, "t-write")
    s = K.write_rows(df, out, ["k"]).collect()[0]
    assert s.row_count == 5000 and s.output_table == out
    back = spark.read.parquet(out).select("row_index", F.variant_get("row_data", "$.k", "bigint").alias("k"))
    assert all(r.row_index == r.k for r in back.collect())


def test_table_name_check(spark):
    import pytest
    K.check_table_name("DB.SCHEMA.TABLE")
    for bad in ["DB.TABLE", "DB.SCHEMA.TA-BLE", "", None, '"DB".S.T']:
        with pytest.raises(ValueError):
            K.check_table_name(bad)


def test_report_round_trip(spark):
    recs = spark.createDataFrame([("a", "x@y"), ("b", "")], "hs_name string, email string")
    path = scratch_path(spark, "t-report")
    head = K.write_report(spark, recs, path, {"listing_filter": "%X%"}).collect()[0]
    assert head.subscription_count == 2 and head.listing_filter == "%X%"
    assert rows(K.read_report(spark, path), "hs_name", "email") == [("a", "x@y"), ("b", "")]


def test_single_document_report(spark, tmp_path):
    p = tmp_path / "report.json"
    p.write_text('{"run_id": "r", "subscriptions": [{"hs_name": "a"}, {"hs_name": "b"}]}')
    assert rows(K.read_report(spark, str(p)), "hs_name") == [("a",), ("b",)]


def test_array_of_objects(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    items = K.array_of_objects(df, ["k"]).first()["items"]
    assert [(x.k, x.v) for x in items] == [(1, "a"), (2, "b")]


def test_query_result_options(spark):
    import pytest
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    assert K.query_result(df, None) is df
    assert K.query_result(df, '{"other": 1}') is df
    s = K.query_result(df, {"WRITE": {"output_table": "spark_catalog.default.trellis_t_query"}}, ["k"]).first()
    assert (s.output_table, s.row_count) == ("spark_catalog.default.trellis_t_query", 2)
    back = spark.table("spark_catalog.default.trellis_t_query")
    assert sorted((r.row_index, r.v) for r in back.select(
        "row_index", F.variant_get("row_data", "$.v", "string").alias("v")).collect()) == [(0, "a"), (1, "b")]
    with pytest.raises(ValueError):
        K.query_result(df, '{"write": {"outputTable": "not_qualified"}}')
    spark.sql("DROP TABLE IF EXISTS spark_catalog.default.trellis_t_query")


def test_query_echo_returns_rows_only(spark):
    from trellis.sources.sinks import query_echo
    out = query_echo("g", "MATCH (n) RETURN n.a AS a", spark.createDataFrame([(1, "x"), (2, None)], "a long, b string"))
    assert out.columns == ["graph_name", "cypher_query", "result"]
    assert sorted(r.result for r in out.collect()) == ['{"a":1,"b":"x"}', '{"a":2}']
