"""Pages of a sorted result against a plain sort."""

import random

import pyarrow.parquet as pq
import pytest

from ledgerlens.operators.paging import result_pages


def expect(rows, size):
    """rows: (group, start, id); the order of each group, nulls last."""
    at = {}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, r[1] or "", r[2]))
        at.update({r: (i + 1, i // size + 1) for i, r in enumerate(own)})
    return at


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pages_of_groups_hot_and_null(spark, size):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else rnd.choice(["a", "b", None]), rnd.choice(["t1", "t1", "t2", "t3", None]), i)
            for i in range(700)]
    df = spark.createDataFrame(rows, "g string, start string, id long").repartition(5)
    got = result_pages(df, ["start", "id"], group=["g"], size=size).collect()
    assert {(r.g, r.start, r.id): (r.position, r.page) for r in got} == expect(rows, size)
    assert len(got) == len(rows)


def test_one_hot_group_is_numbered_in_many_tasks(spark):
    """No task takes a whole group: the rows are written by several, about alike
    (small tasks, which are put together by default, left alone)."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        _one_hot_group(spark)
    finally:
        spark.conf.unset(setting)


def _one_hot_group(spark):
    df = spark.range(0, 20000, numPartitions=6).selectExpr("id", "'same' as start", "1 as at", "2 as task", "3 as `of`")
    out = result_pages(df, ["start", "id"], group=["start"])
    assert out.filter("position <> id + 1 or page <> id div 100 + 1").count() == 0 and out.count() == 20000
    assert (out.columns, out.first()["task"]) == (["id", "start", "at", "task", "of", "position", "page"], 2)
    sizes = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows for f in out.inputFiles()]
    assert sum(sizes) == 20000 and max(sizes) < 10000


def test_without_group_repeats_and_empty(spark):
    df = spark.createDataFrame([(2,), (1,), (2,), (None,)], "x int")
    assert sorted((r.position, r.x) for r in result_pages(df, ["x"], size=2).collect()) == [(1, 1), (2, 2), (3, 2), (4, None)]
    assert result_pages(df.filter("x > 5"), ["x"]).count() == 0
    for bad in ({"by": []}, {"by": ["x"], "size": 0}):
        with pytest.raises(ValueError):
            result_pages(df, **bad)
    with pytest.raises(ValueError):
        result_pages(df.withColumnRenamed("x", "page"), ["page"])
