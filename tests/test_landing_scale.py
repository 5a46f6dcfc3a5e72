"""Landing files: what streams are given, and what a writer's task holds."""

import datetime

import __spark_entry__
from tierline.registry import _files_in


def events(n):
    when = datetime.datetime(2024, 1, 1)
    return [(i, when, i % 7, "error" if i % 5 == 0 else "click", float(i % 130), f'{{"k": "{i * 7919 % 100_003}"}}') for i in range(n)]


def test_rate_limit_counts_empty_files_as_the_stream_does(spark, workdir):
    """Nine splits of a file with one row group: the first has no rows, and
    Spark writes an empty landing file for it."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events(4000), schema).coalesce(1).write.parquet(f"{workdir}/events.parquet")
    size = sum(f.length for f in spark.read.format("binaryFile").load(f"{workdir}/events.parquet").select("length").collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 9 + 1))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = __spark_entry__.queries()["silver_available_now"](spark, workdir)
        assert rows.count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_in_counts_empty_files(spark, workdir):
    for name, text in (("a.json", ""), ("b.json", "[]")):
        with open(f"{workdir}/{name}", "w") as f:
            f.write(text)
    assert _files_in(spark, workdir) == 2


def test_writer_holds_a_line_once_and_no_batches():
    """A line of 32 MB from batches of 1 MB: while it grows, no batch is kept."""
    import tracemalloc

    import pyarrow as pa

    from tierline.sinks.landing import _array_lines

    records = [f'{{"ticket_id":"{i}","review_text":"{"x" * 10_000}"}}' for i in range(100)]
    start, seen = pa.total_allocated_bytes(), []

    def batches():
        for _ in range(32):
            seen.append(pa.total_allocated_bytes() - start)
            yield pa.RecordBatch.from_arrays([pa.array(records)], names=["record"])

    tracemalloc.start()
    lines = []
    for batch in _array_lines(1_000_000, 64 << 20)(batches()):
        lines.append(len(batch.column(0)[0].as_buffer()))
        seen.append(pa.total_allocated_bytes() - start)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lines == [sum(map(len, records)) * 32 + 3200 + 1]
    assert max(seen) < 6 << 20 and peak < 1.3 * lines[0]
