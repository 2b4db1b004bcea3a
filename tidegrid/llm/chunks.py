"""Chunks: the rows of a stored table in bounded pieces that tasks exchange short messages about.

A chunk is a run of rows of one partition. Its id is a digest of its content, so a repeated
scan, or a task that runs again after an executor was lost, gives the same chunks. Sets of
hashes travel between chunks and shards as sorted, difference-coded blocks: each distinct hash
once for each chunk, however often it occurs there.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

CHUNK_BYTES = 6 << 20


@functools.cache
def _trim():
    """The C library's function that returns freed memory, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def give_back() -> None:
    """Return the memory freed so far to the system; workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def pieces(batches: Iterable[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """The batches dealt anew into tables of at most ``most`` bytes of text, or one row.

    What the work on a table has freed goes back to the system before the next one.
    """
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto, at = np.cumsum(lengths), 0
        while at < batch.num_rows:
            before = int(upto[at - 1]) if at else 0
            end = int(np.searchsorted(upto, before + most - size, "right"))
            if end <= at and held:
                yield pa.Table.from_batches(held)
                held, size = [], 0
                give_back()
                continue
            end = max(at + 1, end)
            held.append(batch.slice(at, end - at))
            size += int(upto[end - 1]) - before
            at = end
    if held:
        yield pa.Table.from_batches(held)
    give_back()


def digest(table: pa.Table) -> tuple[int, bytes]:
    """Id of a chunk, and its rows compressed."""
    sink = pa.BufferOutputStream()
    table = table.combine_chunks()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    body = sink.getvalue()
    name = int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)
    return name, zstandard.compress(body, 3)


def unpacked(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.decompress(payload)).read_all()


def coded(values: np.ndarray) -> bytes:
    """Ascending unsigned values as compressed planes of their differences' bytes."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = steps.view(np.uint8).reshape(len(steps), values.dtype.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def decoded(block: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(block), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def bits(flags: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(flags).tobytes(), 1)


def from_bits(block: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(block), np.uint8), count=n).astype(bool)


def shard_bits(total: int, each: int, least: int) -> int:
    """Binary digits of a shard number: shards of some ``each`` values, ``least`` shards."""
    return max(1, int(max(total / each, least) - 1).bit_length())


def by_shard(hashes: np.ndarray, digits: int) -> np.ndarray:
    """Where the shards of ascending hashes begin, and the last one ends."""
    edges = np.arange(1 << digits, dtype=np.uint64) << np.uint64(64 - digits)
    return np.append(np.searchsorted(hashes, edges), len(hashes))
