"""Dealing keys out to tasks in packed blocks.

A corpus has about as many windows or signatures as words. One Spark row for each
would cost more than the work itself, so a map task packs those of a slab of texts
into one block per bucket of keys, and Spark shuffles the blocks. Who deals keys sends
each key of a slab once, so that one that a third of all documents share reaches its
bucket as often as there are slabs, not documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A block has a bucket and no id. A row with an id is passed on as it is.
BLOCKS = "bucket int, doc_id long, packed binary"
_NAMES = ["bucket", "doc_id", "packed"]
BUCKETS_PER_TASK = 8
KEY48 = np.uint64((1 << 48) - 1)


def group_begin(*columns: np.ndarray) -> np.ndarray:
    """For each entry of sorted columns the index at which its group of equals begins."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    begin = np.flatnonzero(new)
    return np.repeat(begin, np.diff(np.append(begin, n)))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by bits 16-47 of the keys."""
    return ((((keys & KEY48) >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def pack(keys: np.ndarray, columns: list[tuple[np.ndarray, int]], buckets: int) -> pa.RecordBatch:
    """Blocks of equally long columns; of each 8-byte value the given low bytes are kept."""
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    parts = [np.ascontiguousarray(c[order].view(np.uint8).reshape(-1, 8)[:, :width]) for c, width in columns]
    used, begin = np.unique(bucket, return_index=True)
    stop = np.append(begin[1:], len(bucket))
    blocks = [b"".join(p[a:b].tobytes() for p in parts) for a, b in zip(begin, stop, strict=True)]
    arrays = [pa.array(used, pa.int32()), pa.nulls(len(used), pa.int64()), pa.array(blocks, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def unpack(blocks: list[bytes], widths: list[int]) -> list[np.ndarray]:
    """The columns of some blocks, as 64-bit unsigned values."""
    sizes = [len(b) // sum(widths) for b in blocks]
    out = [np.zeros((sum(sizes), 8), np.uint8) for _ in widths]
    at = 0
    for block, n in zip(blocks, sizes, strict=True):
        skip = 0
        for column, width in zip(out, widths, strict=True):
            column[at : at + n, :width] = np.frombuffer(block, np.uint8, n * width, skip).reshape(n, width)
            skip += n * width
        at += n
    return [column.view(np.uint64).ravel() for column in out]


def per_id(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Ids and, for each, its values packed."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    own, begin = np.unique(ids, return_index=True)
    stop = np.append(begin[1:], len(ids))[: len(begin)]
    return own, [values[a:b].tobytes() for a, b in zip(begin, stop, strict=True)]


def passed_on(ids: np.ndarray, values: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows for documents that need nobody's decision, spread over the buckets."""
    own, packed = per_id(ids, values)
    bucket = (own % buckets).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(own, pa.int64()), pa.array(packed, pa.binary())], _NAMES)


PACKED = "doc_id long, packed binary"
SINGLE = "doc_id long, value long"


def _single(ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(ids, pa.int64()), pa.array(values.view(np.int64), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "value"])


def _packed(ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    own, packed = per_id(ids, values)
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "packed"])


def deal(frame: DataFrame, dealer: Callable, decide: Callable, widths: list[int], schema: str = PACKED) -> DataFrame:
    """Deal keys of a frame out and decide on each bucket.

    ``dealer(buckets)`` makes the function that turns batches into blocks.
    ``decide(*columns)`` gets all entries of a bucket and returns ids and values, which
    come as rows of ``schema``: ``PACKED`` by id, or ``SINGLE``. A task works on a
    bucket at a time.
    """
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows_of = _packed if schema == PACKED else _single

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks = None, []
        for batch in batches:
            block = batch.column("doc_id").is_null()
            if block.true_count < len(block):
                own = batch.filter(batch.column("doc_id").is_valid())
                if schema == PACKED:
                    yield own.select(["doc_id", "packed"])
                else:
                    packed = own.column("packed").to_pylist()
                    ids = np.repeat(own.column("doc_id").to_numpy(), [len(p) // 8 for p in packed])
                    yield _single(ids, np.frombuffer(b"".join(packed), np.int64))
            batch = batch.filter(block)
            for bucket, one in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if bucket != now and blocks:
                    yield rows_of(*decide(*unpack(blocks, widths)))
                    blocks = []
                now = bucket
                blocks.append(one)
        if blocks:
            yield rows_of(*decide(*unpack(blocks, widths)))

    blocks = frame.mapInArrow(dealer(tasks * BUCKETS_PER_TASK), BLOCKS)
    dealt = blocks.repartitionById(tasks, F.pmod(F.col("bucket"), F.lit(tasks))).sortWithinPartitions("bucket")
    return dealt.mapInArrow(settle, schema)
