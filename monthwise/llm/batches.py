"""Rows packed into written batches of about one size: what a later step needs again is found under its number."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from monthwise.llm.common import written
from monthwise.llm.words import pieces


def packed(df: DataFrame, text: str, size: int, name: str) -> DataFrame:
    """(batch, rows): every task's rows in batches of about ``size`` bytes of the column ``text``, written.

    No shuffle is needed, and numbers are fixed by being written.  A single longer text is a batch of its own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held, held_bytes = 0, [], 0
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))

        def row() -> pa.RecordBatch:
            nonlocal seq
            table, sink = pa.Table.from_batches(held), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=options) as out:
                out.write_table(table.combine_chunks())
            number, seq = TaskContext.get().partitionId() << 32 | seq, seq + 1
            return pa.RecordBatch.from_pydict({"batch": pa.array([number], pa.int64()),
                                               "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
        for batch in batches:
            for part in pieces(batch, text, size, 1 << 20):
                more = part[text].nbytes
                if held and held_bytes + more > size:
                    yield row()
                    held, held_bytes = [], 0
                held.append(part)
                held_bytes += more
        if held:
            yield row()
    return written(df.mapInArrow(run, "batch long, rows binary"), name)


def unpacked(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all().combine_chunks()
