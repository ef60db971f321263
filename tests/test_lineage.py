import os

import pytest

from lodestrata import lineage, skew
from lodestrata.skew import salted_join


def test_cut_and_release(spark):
    df = lineage.cut(spark.range(10))
    assert sorted(r["id"] for r in df.collect()) == list(range(10))
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and lineage.release(spark) >= 1 and not os.path.exists(path)


def test_named_folder_is_used(spark, monkeypatch):
    class Session:
        sparkContext = spark.sparkContext

        class conf:
            @staticmethod
            def get(key, default=None):
                return "file:///shared/x/" if key == "spark.checkpoint.dir" else default

    assert lineage.shared_dir(Session) == "file:///shared/x"


def test_release_takes_what_lies_beside(spark):
    before = lineage.mark()
    path = lineage.folder(spark, "x")
    spark.range(3).write.parquet(f"{path}-out")
    spark.range(3).write.parquet(path)
    kept = lineage.cut(spark.range(2))
    file = kept.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(file) and lineage.release(spark, lineage.mark() - 1) == 1 and not os.path.exists(file)
    assert lineage.release(spark, before) == 1 and not os.path.exists(path.removeprefix("file://")) and not os.path.exists(f"{path}-out".removeprefix("file://"))


@pytest.mark.parametrize("small_bytes", [256 << 10, -1])
@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_join_is_a_join(spark, monkeypatch, how, small_bytes):
    monkeypatch.setattr(skew, "SMALL_BYTES", small_bytes)
    big = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(200)] + [(900, "x"), (901, "y")], "id int, k string")
    small = lineage.cut(spark.createDataFrame([("hot", 1), ("x", 2)], "k string, v int"))
    got = salted_join(big, small, ["k"], "id", how)
    columns = ["id", "k"] + ["v"] * (how != "left_anti")
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, big.join(small, "k", how).select(*columns).collect()))
    plan = got._jdf.queryExecution().toString()
    assert ("__salt" in plan) == (small_bytes < 0)
