"""Helpers on frames: pinned files, names, new columns."""

import os

import pyarrow as pa
from pyspark.sql import types as T

from nestdoc.llm import _frames as H


def files(df):
    plan = df._jdf.queryExecution().analyzed()
    return plan.rdd().getCheckpointFile().get().replace("file:", "")


def test_released_frames_leave_no_files(spark):
    a = H.pinned(spark.range(100))
    b = H.pinned(a.selectExpr("id * 2 AS id"))
    path, other = files(a), files(b)
    assert os.listdir(path)
    H.release(a.select("id"), spark.range(3))
    assert not os.path.exists(path) and os.path.exists(other)
    assert b.count() == 100 and b.agg({"id": "sum"}).collect()[0][0] == 9900


def test_new_columns_beside_any_names(spark):
    df = spark.createDataFrame([(1, "ab", 2.5), (2, None, None)], "c1 int, `a.b` string, size double")

    def read(batches, at):
        for b in batches:
            yield b, [pa.array([len(x or "") for x in b.column(at).to_pylist()], pa.int64())]

    out = H.widened(df, "a.b", [("size", T.LongType())], read)
    assert out.columns == ["c1", "a.b", "size", "_size"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "ab", 2.5, 2), (2, None, None, 0)]
