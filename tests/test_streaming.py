"""Keys seen for the first time, over batches and a restart."""

from pyspark.sql import functions as F

from eventloom.streaming.seen import collect_unseen

SCHEMA = "key string, ord long, note string"


def test_first_rows_over_batches_and_a_restart(spark, tmp_path):
    source, table, log = (str(tmp_path / n) for n in ("in", "table", "log"))

    def add(*rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        collect_unseen(stream, "key", "ord", table, log)
        return sorted(tuple(r) for r in spark.read.parquet(table).select("key", "ord", "note").collect())

    add(("a", 5, "x"), ("a", 3, "y"), ("b", 1, None), (None, 0, "no"), ("", 0, "no"))
    first = [("a", 3, "y"), ("b", 1, None)]
    assert run() == first
    add(("a", 1, "late"), ("c", 9, "z"))
    add(("c", 2, "later"), ("d", 4, "w"))
    assert run() == [*first, ("c", 9, "z"), ("d", 4, "w")]  # two batches; the same state after a restart
    assert run() == [*first, ("c", 9, "z"), ("d", 4, "w")]


def test_a_batch_reads_no_table(spark, tmp_path):
    """The state tells what was seen: the table may be moved away between runs."""
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(source)
    for n, table in enumerate(("one", "two")):
        spark.createDataFrame([("a", n, ""), (f"k{n}", n, "")], SCHEMA).write.mode("append").parquet(source)
        collect_unseen(stream(), "key", "ord", str(tmp_path / table), log)
    assert [r["key"] for r in spark.read.parquet(str(tmp_path / "two")).orderBy("key").collect()] == ["k1"]
    assert spark.read.parquet(str(tmp_path / "one")).filter(F.col("key") == "a").count() == 1
