"""Landing-zone writer: files that each hold one JSON array of records.

Records are encoded to JSON in the JVM; a small per-partition step then joins
up to ``records_per_file`` of them (and ``max_bytes_per_file`` bytes at most)
into one array line, column-wise on Arrow arrays, so a batch never leaves its
partition (no shuffle) and its size is bounded. A task holds the line it fills
once, and besides it a small Arrow batch. The text writer puts each line into a
file of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORD = "record"


# Bytes of one Arrow batch of records, and of the records that are joined at a time.
BATCH_BYTES = 4 * 1024 * 1024
PIECE_BYTES = 1024 * 1024


def _array_lines(records_per_file: int, max_bytes_per_file: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def joined(records: pa.Array):
            lists = pa.ListArray.from_arrays(pa.array([0, len(records)], pa.int32()), records)
            return pc.binary_join(lists, ",")[0].as_buffer()

        def line(text: bytearray) -> pa.RecordBatch:
            text += b"]"
            offsets = pa.array([0, len(text)], pa.int32()).buffers()[1]
            value = pa.StringArray.from_buffers(1, offsets, pa.py_buffer(text))
            return pa.RecordBatch.from_arrays([value], names=["value"])

        text, count, size = bytearray(), 0, 0  # of the next line; its bytes are held once
        for batch in batches:
            records = batch.column(0)
            ends = np.cumsum(pc.binary_length(records).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            begin = 0
            while begin < len(records):
                before = int(ends[begin - 1]) if begin else 0
                fits = int(np.searchsorted(ends, before + max_bytes_per_file - size, side="right")) - begin
                take = max(min(records_per_file - count, fits, len(records) - begin), 0 if count else 1)
                while take:
                    start = int(ends[begin - 1]) if begin else 0
                    n = int(np.searchsorted(ends, start + PIECE_BYTES, side="right")) - begin
                    n = min(max(n, 1), take)
                    text += b"," if count else b"["
                    text += joined(records.slice(begin, n))
                    begin, count, take = begin + n, count + n, take - n
                size += (int(ends[begin - 1]) if begin else 0) - before
                if begin < len(records) or count >= records_per_file:
                    yield line(text)
                    text, count, size = bytearray(), 0, 0
            del batch, records, ends  # before the next one is read
        if count:
            yield line(text)
        pa.default_memory_pool().release_unused()

    return run


MAX_BYTES_PER_FILE = 64 * 1024 * 1024


def landing_arrays(
    df: DataFrame,
    records_per_file: int = 500,
    columns: list[str] | None = None,
    max_bytes_per_file: int = MAX_BYTES_PER_FILE,
) -> DataFrame:
    """One row per future file: a JSON array of up to ``records_per_file``
    records and ``max_bytes_per_file`` bytes (a single larger
    record still gets a file of its own). Null fields are left out and read
    back as null."""
    if records_per_file < 1:
        raise ValueError("records_per_file must be positive")
    cols = columns or df.columns
    records = df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias(RECORD))
    return records.mapInArrow(_array_lines(records_per_file, max_bytes_per_file), "value string")


def write_landing_files(
    df: DataFrame,
    path: str,
    records_per_file: int = 500,
    columns: list[str] | None = None,
    mode: str = "append",
    max_bytes_per_file: int = MAX_BYTES_PER_FILE,
) -> None:
    """Write ``df`` into ``path`` as files of one JSON array each. Appending
    adds new files next to the old ones, which a file stream picks up."""
    arrays = landing_arrays(df, records_per_file, columns, max_bytes_per_file)
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    held = conf.get(name)
    conf.set(name, str(BATCH_BYTES))
    try:
        arrays.write.mode(mode).option("maxRecordsPerFile", 1).text(path)
    finally:
        conf.set(name, held)
