import datetime as dt

from pyspark.sql import types as T

from chronodim import DimSpec
from chronodim.operators.reports import late_rows, long_histories, null_key_rows
from chronodim.operators.versions import map_columns

S = dt.datetime(2200, 1, 1)
SPEC = DimSpec(name="toy", keys=(("k", "k"),), tracked=(("a", "a"),), ts="ts")
DIM = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("a", T.StringType()),
                    T.StructField("version", T.IntegerType()), T.StructField("lastversion", T.BooleanType()),
                    T.StructField("date_from", T.TimestampNTZType()), T.StructField("date_to", T.TimestampNTZType())])
STG = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("a", T.StringType()),
                    T.StructField("ts", T.TimestampNTZType())])


def d(m):
    return dt.datetime(2024, m, 1)


def test_reports(spark):
    dim = spark.createDataFrame([(1, "a", 1, False, d(1), d(5)), (1, "b", 2, True, d(5), S),
                                 (2, "a", 1, True, d(1), S)], DIM)
    stg = map_columns(spark.createDataFrame([(1, "c", d(3)), (2, "c", d(2)), (None, "z", d(2))], STG), SPEC)
    assert [(r.k, r.a) for r in late_rows(stg, dim, SPEC).collect()] == [(1, "c")]
    assert [(r.k, r.a) for r in null_key_rows(stg, SPEC).collect()] == [(None, "z")]
    assert [(r.k, r.versions, r.max_version) for r in long_histories(dim, SPEC, 2).collect()] == [(1, 2, 2)]
