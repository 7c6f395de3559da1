"""Token ids as files: fixed-size blocks, transposed into byte or bit planes, zstandard.

Writing: documents are dealt into ranges of doc_id (``repartitionByRange``), sorted
within each range, and encoded by the tokenizers library, a batch of texts together
(``word_codes``); each document's ids are followed by ``END_ID``. The ids of one range
run into blocks of ``BLOCK_IDS`` ids; a block is transposed into planes (the k-th byte, or the k-th bit,
of every id side by side), and each plane is compressed with zstandard on its own, so
that the high planes of small ids cost next to nothing. One row per block is the file
format: part (range), block number, offset of its first id in the part, id count, the
compressed planes, and the chunk index of the documents that start in it (doc_id,
offset in the part, length). Rows are written as Parquet in the shared folder.

Reading: the blocks of each part are decoded in order, and each document's ids are
checked against the index and digested (crc32 of the ids as little-endian uint32). A
part's start is the sum of the id counts of all parts before it, from a table of one
row per part. A part holds about ``PART_BYTES`` of text, so one group of the reading
side is bounded by that parameter and not by the data.

Null texts and empty texts have only the end id. Rows without doc_id come first, and
rows of equal doc_id are ordered by text; each is written, repeated rows too. Only
doc_id and text are read, so other columns, whatever their names, play no part.
"""

from __future__ import annotations

import math
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billsift.llm.word_codes import column_codes
from billsift.session import new_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BLOCK_IDS = 1 << 16
PART_BYTES = 256 << 20
LEVEL = 3

BLOCKS = (
    "part int, block int, first long, n_ids int, planes array<binary>, "
    "doc_ids array<long>, doc_starts array<long>, doc_lengths array<long>"
)
BLOCKS_ARROW = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("planes", pa.list_(pa.binary()))]
    + [(name, pa.list_(pa.int64())) for name in ("doc_ids", "doc_starts", "doc_lengths")]
)
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """Planes of a block of uint32 ids, each compressed on its own."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if kind == "byte":
        planes = ids.view(np.uint8).reshape(-1, 4).T
    elif kind == "bit":
        planes = [np.packbits(((ids >> k) & 1).astype(np.uint8)) for k in range(32)]
    else:
        raise ValueError(kind)
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    return [compressor.compress(np.ascontiguousarray(p).tobytes()) for p in planes]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    """The ids of a block from its compressed planes (4 byte planes or 32 bit planes)."""
    decompressor = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(decompressor.decompress(p, max_output_size=4 * n_ids + 64), np.uint8) for p in planes]
    if len(raw) == 4:
        return np.ascontiguousarray(np.stack(raw, axis=1)).view("<u4").reshape(-1)
    ids = np.zeros(n_ids, np.uint32)
    for k, plane in enumerate(raw):
        ids |= np.unpackbits(plane)[:n_ids].astype(np.uint32) << np.uint32(k)
    return ids


def _packer(path: str, kind: str, block_ids: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = column_codes(path)
        part, block = None, 0
        ids = np.zeros(0, np.uint32)  # not yet in a block, as are the documents that start in them
        names, starts, lengths = pa.array([], pa.int64()), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows(last: bool) -> Iterator[dict]:
            nonlocal block, ids, names, starts, lengths
            for lo in range(0, len(ids) if last else len(ids) - block_ids + 1, block_ids):
                first = block * block_ids
                head, n = ids[lo : lo + block_ids], int(np.searchsorted(starts, first + block_ids))
                yield dict(part=part, block=block, first=first, n_ids=len(head), planes=to_planes(head, kind),
                           doc_ids=names[:n].to_pylist(), doc_starts=starts[:n], doc_lengths=lengths[:n])
                block, names, starts, lengths = block + 1, names[n:], starts[n:], lengths[n:]
            ids = ids[len(ids) if last else len(ids) // block_ids * block_ids :]

        offset = 0
        for batch in batches:
            if not len(batch):
                continue
            part = batch.column("part")[0].as_py()
            new, n_ids = codes.encode(batch.column("text"))
            ids = np.concatenate([ids, np.insert(new, np.cumsum(n_ids), np.uint32(END_ID))])
            ends = offset + np.cumsum(n_ids + 1)
            names = pa.concat_arrays([names, batch.column("doc_id")])
            starts, lengths = np.append(starts, ends - n_ids - 1), np.append(lengths, n_ids + 1)
            offset = int(ends[-1])
            if len(ids) >= block_ids:
                yield pa.RecordBatch.from_pylist(list(rows(False)), schema=BLOCKS_ARROW)
        if len(ids):
            yield pa.RecordBatch.from_pylist(list(rows(True)), schema=BLOCKS_ARROW)

    return pack


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, kind: str = "byte",
                      block_ids: int = BLOCK_IDS, part_bytes: int = PART_BYTES) -> str:
    """Encode ``docs`` (doc_id, text) and write their blocks to ``path``; returns the path."""
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / part_bytes), 1)
    ranged = (
        docs.repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
        .withColumn("part", F.spark_partition_id())
    )
    ranged.mapInArrow(_packer(tokenizer, kind, block_ids), BLOCKS).write.parquet(path)
    return path


def _unpack(frame: pd.DataFrame) -> pd.DataFrame:
    """Documents of one part, digested from its blocks in order."""
    rows: list[tuple] = []
    pending: deque = deque()
    current = None  # doc_id, start, length, read, crc
    offset = 0
    for block in frame.sort_values("block").itertuples(index=False):
        if block.first != offset:
            raise ValueError(f"block {block.block} of part {block.part} starts at {block.first}, not {offset}")
        ids = from_planes(list(block.planes), block.n_ids)
        pending.extend(zip(block.doc_ids, block.doc_starts, block.doc_lengths, strict=True))
        at = 0
        while at < len(ids):
            if current is None:
                doc_id, start, length = pending.popleft()
                if start != offset + at:
                    raise ValueError(f"document {doc_id} starts at {start}, its ids at {offset + at}")
                current = [doc_id, start, length, 0, 0]
            take = min(current[2] - current[3], len(ids) - at)
            current[4] = zlib.crc32(ids[at : at + take].astype("<u4").tobytes(), current[4])
            current[3] += take
            at += take
            if current[3] == current[2]:
                if ids[at - 1] != END_ID:
                    raise ValueError(f"document {current[0]} does not end with the end id")
                rows.append((current[0], current[1], current[2], current[4]))
                current = None
        offset += len(ids)
    if current is not None or pending:
        raise ValueError("the blocks of a part end inside a document")
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    out["part"] = int(frame["part"].iloc[0])
    return out.astype({"start": "int64", "n_tokens": "int64", "ids_crc32": "int64"})


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens (end id included), ids_crc32."""
    blocks = spark.read.parquet(path)
    docs = blocks.groupBy("part").applyInPandas(_unpack, RESULT + ", part int")
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: a bounded table, sent to every task.
    offsets = sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    return docs.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("part_start") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """All blocks decoded: part, block, ids (array<long>), for tests and tools."""
    blocks = spark.read.parquet(path)

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({
                "part": frame["part"], "block": frame["block"],
                "ids": [from_planes(list(p), n).astype(np.int64) for p, n in zip(frame["planes"], frame["n_ids"], strict=True)],
            })

    return blocks.mapInPandas(decode, "part int, block int, ids array<long>")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = write_token_files(docs, new_path(spark, "llm-token-files"))
    return read_token_index(spark, path)
