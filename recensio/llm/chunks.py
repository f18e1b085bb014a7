"""Documents in chunks that several passes see alike.

A pass over the chunks sends each bucket of the hash space one packed row with
the hashes a chunk holds; a bucket answers each chunk in the order of its
request. So counts and first owners of billions of n-grams travel as packed
arrays and never as one row each, no task sees more than its chunk or bucket,
and any task can be run again alone: a chunk depends on the ids only, and
nothing in a request or an answer on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a chunk; a task holds some hundred times as much.
CHUNK_BYTES = 2 << 20


def text_size(docs: DataFrame, text: Column) -> int:
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        chunk = batch.column("chunk").to_numpy(zero_copy_only=False)
        order = np.argsort(chunk, kind="stable")
        rows = pa.Table.from_batches([batch]).drop_columns(["chunk"]).take(pa.array(order))
        chunks, first = np.unique(chunk[order], return_index=True)
        blobs = []
        for i, j in zip(first, [*first[1:], len(order)], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                out.write_table(rows.slice(i, j - i).combine_chunks())
            blobs.append(sink.getvalue())
        yield pa.record_batch([pa.array(chunks, pa.int32()), pa.array([b.to_pybytes() for b in blobs], pa.binary())], names=["chunk", "blob"])


def chunked(rows: DataFrame, doc_id: str, text: str, chunk_bytes: int = CHUNK_BYTES, spread: Column | None = None) -> tuple[DataFrame, int]:
    """``(chunk, blob)``, dealt by chunk, and the number of chunks; ``chunk_table`` reads the blobs.

    Rows of one id share a chunk; rows without id are spread by their text. ``spread`` is another number to deal rows by.
    """
    chunks = max(1, ceil(text_size(rows, F.col(text)) / chunk_bytes))
    if spread is None:
        spread = F.when(F.col(doc_id).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id))
    dealt = rows.withColumn("chunk", F.pmod(spread, F.lit(chunks)).cast("int"))
    return dealt.mapInArrow(_packed, "chunk int, blob binary").repartition(chunks, "chunk"), chunks


def chunk_table(blobs: pa.Table) -> pa.Table:
    """The rows of a chunk."""
    return pa.concat_tables([pa.ipc.open_stream(b.as_buffer()).read_all() for b in blobs["blob"]]).combine_chunks()


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
