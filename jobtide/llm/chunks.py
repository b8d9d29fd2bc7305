"""Texts in chunks, so that a task asks about each distinct key of a chunk once.

Two readers of one stored source cut it into the same chunks: one sends the distinct keys of each
chunk to where they are answered, the other sends the chunk itself (compressed) to the answers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from jobtide.llm.common import byte_view, release, steps

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20  # of text whose distinct keys one bucket answers


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, pa.Table]]:
    """Runs of rows (id, text, ...) of about CHUNK_BYTES of text, each named by a digest of what
    it holds: equal chunks have equal names, and equal answers."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        for a, b in steps(lengths.astype(np.int64), CHUNK_BYTES // 4):
            held.append(batch.slice(a, b - a))
            size += int(lengths[a:b].sum())
            if size >= CHUNK_BYTES:
                yield _named(held)
                held, size = [], 0
                release()
    if held:
        yield _named(held)
        release()


def _named(held: list[pa.RecordBatch]) -> tuple[bytes, pa.Table]:
    table = pa.Table.from_batches(held).combine_chunks()
    digest = hashlib.blake2b(digest_size=16)
    for name in table.column_names:
        if name != "text":
            digest.update(repr(table[name].to_pylist()).encode())
    flat, offsets = byte_view(table["text"])
    digest.update(offsets.tobytes() + flat[offsets[0]:offsets[-1]].tobytes())
    return digest.digest(), table


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, rows): each chunk as one compressed value."""
    codec = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    for name, table in chunks(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=codec) as out:
            out.write_table(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([sink.getvalue().to_pybytes()])], ["chunk", "rows"])


def unpacked(left: pa.Table) -> Iterator[pa.Table]:
    """The rows of the chunks of one name. Answers that meet no chunk mean that the source was
    read in another order the second time; that stops the job."""
    if not left.num_rows:
        raise ValueError("answers without their chunk: the source changed between two reads")
    for x in left.column("rows"):
        yield pa.ipc.open_stream(x.as_py()).read_all()


def answers_of(right: pa.Table, names: list[str]) -> dict[int, tuple]:
    """The answers of each bucket to one chunk; chunks of one name have been answered alike."""
    out: dict[int, tuple] = {}
    columns = [right.column(n) for n in names]
    for row, bucket in enumerate(right.column("bucket").to_pylist()):
        if bucket not in out:
            out[bucket] = tuple(c[row] for c in columns)
    return out
