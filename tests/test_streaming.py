from datetime import datetime

from pyspark.sql import functions as F

from cadastra.operators.dedupe import latest_wins
from cadastra.streaming import incremental

SCHEMA = "ticker string, date string, adj_close double, _ingested_at timestamp"


def test_incremental_equals_batch_whatever_arrival_order(spark, tmp_path):
    order = [F.col("_ingested_at").desc()]
    rows = [("A", "2024-01-01", 1.0, datetime(2024, 1, 1)), ("A", "2024-01-01", 2.0, datetime(2024, 1, 3)),
            ("A", "2024-01-02", 3.0, datetime(2024, 1, 2)), ("B", "2024-01-01", 4.0, datetime(2024, 1, 5)),
            ("B", "2024-01-01", 5.0, datetime(2024, 1, 4)), ("A", "2024-01-01", 9.0, datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, SCHEMA)
    batch = sorted(latest_wins(df, ["ticker", "date"], order).collect())
    root, landing_dir = str(tmp_path / "table"), str(tmp_path / "landing")

    def run(checkpoint, **kw):
        incremental.start(spark, f"{landing_dir}/*", df.schema, root, str(tmp_path / checkpoint), **kw).awaitTermination()

    def current():
        return sorted(incremental.read_current(spark, root, df.schema, ["ticker", "date"], order).collect())

    # newest versions arrive first, an old re-delivery arrives last
    for k, idx in enumerate([[1, 3], [4, 2], [0, 5]]):
        spark.createDataFrame([rows[i] for i in idx], SCHEMA).coalesce(1).write.parquet(f"{landing_dir}/d={k}")
        run("ckpt")
    assert current() == batch
    run("ckpt")  # nothing new
    assert current() == batch
    run("lost", max_files_per_trigger=1)  # a lost checkpoint delivers everything again, batch by batch
    assert current() == batch
    # and a delivery that only the second checkpoint has seen is there
    spark.createDataFrame([("C", "2024-01-01", 7.0, datetime(2024, 2, 1))], SCHEMA).write.parquet(f"{landing_dir}/d=9")
    run("lost")
    assert [r for r in current() if r["ticker"] == "C"] and len(current()) == len(batch) + 1


def test_merge_keeps_only_the_newest_and_survives_a_lost_run(spark, tmp_path):
    order = [F.col("_ingested_at").desc()]
    rows = [("A", "2024-01-01", 1.0, datetime(2024, 1, 1)), ("A", "2024-01-01", 2.0, datetime(2024, 1, 3)),
            ("A", "2024-02-02", 3.0, datetime(2024, 1, 2)), ("B", "2024-01-01", 4.0, datetime(2024, 1, 5)),
            ("B", "2024-01-01", 5.0, datetime(2024, 1, 4)), ("A", "2024-01-01", 9.0, datetime(2024, 1, 2)),
            ("C", None, 1.0, datetime(2024, 1, 2)), ("C", None, 2.0, datetime(2024, 1, 3))]
    df = spark.createDataFrame(rows, SCHEMA)
    batch = sorted(map(str, latest_wins(df, ["ticker", "date"], order).collect()))
    root, landing_dir = str(tmp_path / "table"), str(tmp_path / "landing")

    def run(checkpoint, **kw):
        incremental.start_merge(spark, f"{landing_dir}/*", df.schema, root, str(tmp_path / checkpoint), ["ticker", "date"],
                                order, F.substring("date", 1, 7), **kw).awaitTermination()

    def table():
        return sorted(map(str, incremental.read_merged(spark, root, df.schema).collect()))

    assert table() == []
    for k, idx in enumerate([[1, 3, 7], [4, 2], [0, 5, 6]]):
        spark.createDataFrame([rows[i] for i in idx], SCHEMA).coalesce(1).write.parquet(f"{landing_dir}/d={k}")
        run("ckpt")
    assert table() == batch  # every key stands there once, without a ranking on read
    untouched = (tmp_path / "table" / "_part=2024-02").stat().st_mtime
    run("lost", max_files_per_trigger=1)
    assert table() == batch
    # a run lost after it wrote the merged rows and dropped a partition: the next run puts them in place
    kept = spark.read.parquet(root)
    kept.where("_part = '2024-01'").write.parquet(root + "-merging")
    for f in (tmp_path / "table" / "_part=2024-01").iterdir():
        f.unlink()
    spark.createDataFrame([("D", "2024-03-01", 7.0, datetime(2024, 2, 1))], SCHEMA).write.parquet(f"{landing_dir}/d=9")
    run("ckpt")
    assert len(table()) == len(batch) + 1 and set(batch) < set(table()) and untouched > 0
