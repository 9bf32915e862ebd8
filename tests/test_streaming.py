"""Incremental load: a second run over the same directory adds nothing; new
files are picked up by the next run."""

from pyspark.sql import DataFrameWriter

from ledgerlens.streaming.incremental import read_sink, run_incremental


def test_second_run_adds_no_rows(spark, tmp_path):
    src = str(tmp_path / "in")
    first = spark.createDataFrame([(1, "a"), (2, "")], "id int, key string")
    first.coalesce(1).write.mode("append").parquet(src)
    sink, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def clean(df):
        return df.filter("key <> ''")

    assert run_incremental(spark, src, first.schema, clean, sink, ckpt) == 2
    assert read_sink(spark, sink).count() == 1
    assert run_incremental(spark, src, first.schema, clean, sink, ckpt) == 0
    assert read_sink(spark, sink).count() == 1
    spark.createDataFrame([(3, "c")], first.schema).coalesce(1).write.mode("append").parquet(src)
    assert run_incremental(spark, src, first.schema, clean, sink, ckpt) == 1
    assert sorted(r.id for r in read_sink(spark, sink).collect()) == [1, 3]


def test_dedup_keys_across_runs(spark, tmp_path):
    src = str(tmp_path / "in")
    df = spark.createDataFrame([(1, "a"), (1, "a")], "id int, key string")
    df.coalesce(1).write.mode("append").parquet(src)
    sink, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run_incremental(spark, src, df.schema, lambda d: d, sink, ckpt, dedup_keys=["id"])
    df.coalesce(1).write.mode("append").parquet(src)
    run_incremental(spark, src, df.schema, lambda d: d, sink, ckpt, dedup_keys=["id"])
    assert read_sink(spark, sink).count() == 1


def test_rows_are_not_copied_to_be_rid_of_the_batch_names(spark, tmp_path, monkeypatch):
    src, sink, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, key string")
    df.coalesce(1).write.parquet(src)
    by = []
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *c: by.append(c) or self)
    assert run_incremental(spark, src, df.schema, lambda d: d, sink, ckpt) == 2
    back = read_sink(spark, sink)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert not by and "Project" not in plan and "batch_id#" not in plan and "load_id#" not in plan
    assert back.columns == ["id", "key"] and sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b")]
    assert sorted(map(tuple, read_sink(spark, sink, df.schema).collect())) == [(1, "a"), (2, "b")]


def test_a_replayed_batch_replaces_its_own_rows(spark, tmp_path):
    src, sink, ckpt = (tmp_path / x for x in ("in", "out", "ckpt"))
    schema = spark.range(1).schema
    for n in (3, 2):  # two batches
        spark.range(n).coalesce(1).write.mode("append").parquet(str(src))
        assert run_incremental(spark, str(src), schema, lambda d: d, str(sink), str(ckpt)) == n
    for f in (ckpt / "commits" / "1", ckpt / "commits" / ".1.crc"):  # the driver died before it took note of the second
        f.unlink()
    spark.range(100, 109).write.parquet(str(next(sink.glob("load_id=*"))).replace("load_id=", ".staging-") + "-1")  # half written
    assert run_incremental(spark, str(src), schema, lambda d: d, str(sink), str(ckpt)) == 2
    assert sorted(r.id for r in read_sink(spark, str(sink)).collect()) == [0, 0, 1, 1, 2]
    assert not list(sink.glob(".staging-*"))


def test_a_batch_of_which_no_row_is_kept(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    spark.range(3).write.parquet(src)
    assert run_incremental(spark, src, spark.range(1).schema, lambda d: d.filter("id > 5"), sink, ckpt) == 3
    assert read_sink(spark, sink).columns == ["id"] and read_sink(spark, sink).count() == 0
