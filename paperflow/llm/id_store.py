"""Token ids on disk: one zstandard frame per document, all with one shared dictionary, in blocks with an offset index.

A block is one binary value in a Parquet table, so any file system Spark knows can hold it and a lost task leaves
no half-written block.  Its layout, all numbers little-endian:

    magic "TID1" | id width in bytes: u8 | dictionary SHA-256: 32 bytes (zeros: no dictionary)
    documents: u32 | doc_id: i64 each | known flag of the doc_id: u8 each | ids: u32 each
    frame offset: u64 each and the end | frames

Beside ``first_doc_id`` and ``last_doc_id`` of each block, which Parquet statistics serve, this reads one short document without
unpacking its neighbours.  The dictionary lies in its own one-row table and is checked against the hash in every block.
It is trained on the serialized ids of at most ``sample_docs`` documents of at most ``sample_bytes`` bytes of text each,
the first ones by hash of the id; all other statistics cover every row.

Null and empty texts are one end id.  Rows with a null doc_id come first.  Repeated ids keep their rows, ordered by a hash of the
text, so that an id with very many rows spreads over tasks.
An empty table gives an empty store and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperflow.session import scratch_path

from .common import hashed_sample, in_batches
from .tokens import encoder, vocabulary_path

MAGIC, NO_DICTIONARY = b"TID1", bytes(32)
END_ID = 2
WIDTH = 2
BLOCK_BYTES = 256 << 10
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS, SAMPLE_BYTES = 1_000, 16 << 10
LEVEL = 3
CACHE_ENTRIES = 1_000_000
"""Of an encoder that writes; most of the time goes to words it does not know."""

BLOCKS = "part int, seq int, first_doc_id long, last_doc_id long, n_docs int, n_tokens long, block binary"


def serialized(ids: bytes, width: int) -> bytes:
    """Ids given as unsigned 32-bit numbers, in ``width`` bytes each."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def widened(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """An empty result means that the samples are too few for a dictionary."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else NO_DICTIONARY


def _shared(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def build_block(doc_ids: list[int | None], counts: list[int], frames: list[bytes], width: int, dictionary_sha: bytes) -> bytes:
    ends = np.cumsum([0, *map(len, frames)], dtype="<u8")
    return b"".join([
        MAGIC, bytes([width]), dictionary_sha, struct.pack("<I", len(frames)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is not None for d in doc_ids),
        np.array(counts, "<u4").tobytes(), ends.tobytes(), *frames,
    ])


class Block:
    """Reads a block; frames are unpacked one at a time."""

    def __init__(self, block: bytes, dictionary: bytes):
        if block[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        if block[5:37] != dictionary_hash(dictionary):
            raise ValueError("the block was written with another dictionary")
        self.block, self.width = block, block[4]
        (n,) = struct.unpack_from("<I", block, 37)
        at = 41
        known = block[at + 8 * n:at + 9 * n]
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(block, "<i8", n, at), known)]
        self.counts = np.frombuffer(block, "<u4", n, at + 9 * n)
        self.offsets = np.frombuffer(block, "<u8", n + 1, at + 13 * n)
        self.body = at + 13 * n + 8 * (n + 1)
        self.unpack = zstandard.ZstdDecompressor(**_shared(dictionary)).decompress

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, k: int) -> bytes:
        """The ids of document ``k`` as unsigned 32-bit numbers."""
        frame = self.block[self.body + int(self.offsets[k]):self.body + int(self.offsets[k + 1])]
        return widened(self.unpack(frame), self.width)


def sample_dictionary(docs: DataFrame, vocabulary: str, width: int = WIDTH, sample_docs: int = SAMPLE_DOCS,
                      sample_bytes: int = SAMPLE_BYTES, key: str = "doc_id", text: str = "text") -> bytes:
    """Only a bounded number of bounded texts comes to the driver."""
    short = docs.where(F.octet_length(text) <= sample_bytes).select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = hashed_sample(short, "key", sample_docs).collect()
    return train_dictionary([serialized(encoder(vocabulary).ids(r["text"]), width) for r in rows])


def write_store(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, width: int = WIDTH,
                block_bytes: int = BLOCK_BYTES, level: int = LEVEL, key: str = "doc_id", text: str = "text") -> None:
    """Writes ``path/dictionary`` and ``path/blocks``; documents are in ascending order of ``key`` over parts and blocks."""
    vocabulary = vocabulary or vocabulary_path()
    spark = docs.sparkSession
    if encoder(vocabulary).whole.get_vocab_size() > 1 << 8 * width:
        raise ValueError(f"ids of this vocabulary do not fit {width} bytes")
    dictionary = sample_dictionary(docs, vocabulary, width, key=key, text=text)
    sha = dictionary_hash(dictionary)
    spark.createDataFrame([(sha.hex(), dictionary)], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    end = np.array([end_id], "<u4").tobytes()
    fields = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_doc_id", pa.int64()), ("last_doc_id", pa.int64()),
                        ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("block", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary, CACHE_ENTRIES).ids
        pack = zstandard.ZstdCompressor(level=level, write_content_size=True, **_shared(dictionary)).compress
        part, seq, doc_ids, counts, frames, held = 0, 0, [], [], [], 0

        def flush():
            known = [d for d in doc_ids if d is not None]
            row = [part, seq, min(known, default=None), max(known, default=None), len(frames), sum(counts), build_block(doc_ids, counts, frames, width, sha)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, fields)], schema=fields)

        for batch in batches:
            for part, k, body in zip(*(c.to_pylist() for c in batch.columns)):
                ids = ids_of(body or "") + end
                frame = pack(serialized(ids, width))
                doc_ids.append(k), counts.append(len(ids) // 4), frames.append(frame)
                held += len(frame)
                if held >= block_bytes:
                    yield flush()
                    seq, doc_ids, counts, frames, held = seq + 1, [], [], [], 0
        if frames:
            yield flush()

    ordered = (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
               .withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
               .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    in_batches(ordered, write, BLOCKS).write.parquet(f"{path}/blocks")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").head()["dictionary"])


def read_document(spark: SparkSession, path: str, doc_id: int) -> np.ndarray | None:
    """The ids of one document: the block by its bounds, the frame by the offset index."""
    dictionary = read_dictionary(spark, path)
    for row in spark.read.parquet(f"{path}/blocks").where((F.col("first_doc_id") <= doc_id) & (F.col("last_doc_id") >= doc_id)).select("block").toLocalIterator():
        block = Block(bytes(row["block"]), dictionary)
        if doc_id in block.doc_ids:
            return np.frombuffer(block.ids(block.doc_ids.index(doc_id)), "<u4")
    return None


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: where its ids start among all ids, how many they are, and their CRC.

    The starts of blocks come from the blocks' own counts: per part, then over the parts, of which there are as many as
    the write had tasks.  Only those counts are shuffled.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    dictionary = read_dictionary(spark, path)
    fields = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("rel", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(*(c.to_pylist() for c in batch.columns)):
                block, rel, rows = Block(data, dictionary), 0, []
                for k in range(len(block)):
                    ids = block.ids(k)
                    n = len(ids) // 4
                    if n != block.counts[k]:
                        raise ValueError("a frame does not hold the ids its index promises")
                    rows.append((part, seq, block.doc_ids[k], rel, n, zlib.crc32(ids)))
                    rel += n
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    docs = in_batches(blocks.select("part", "seq", "block"), read, "part int, seq int, doc_id long, rel long, n_tokens long, ids_crc32 long")
    sizes = blocks.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total")).select(
        "part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    starts = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("in_part"))
    starts = starts.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("in_part")).alias("block_start"))
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("block_start") + F.col("rel")).alias("start"), "n_tokens", "ids_crc32")


def store_and_read(docs: DataFrame, **options) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-ids")
    write_store(docs, path, **options)
    return read_store(docs.sparkSession, path)
