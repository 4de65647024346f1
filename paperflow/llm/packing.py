"""Best-fit packing of documents into token sequences with a fixed number of open bins.

A document is its token ids and an end id.  Documents over ``capacity`` are cut into pieces of that length; the last
piece may be shorter.  Pieces are packed in groups of about ``group_rows`` rows (16 bytes each to the packer, no
text); within a group they arrive by falling length.  Open bins are kept by free space: bit ``f`` of one integer says
that a bin with ``f`` tokens of room is open, so the best fit is the lowest set bit from the piece's length on.  When a
piece needs a new bin and ``open_bins`` are open, the fullest one closes.

Null and empty texts are one end id.  Repeated rows are packed each for itself.  A null doc_id is kept as null.
An empty table gives no rows.  Columns besides the two named ones are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, staged
from .tokens import Encoder, vocabulary_path

CAPACITY = 4096
OPEN_BINS = 512
LOOK_AHEAD = 4_000
GROUP_ROWS = 100_000
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


class OpenBins:
    """Bounded-space best fit.  ``place(length)`` gives (bin number, offset in it)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.by_room: dict[int, list[int]] = {}
        self.rooms = 0
        self.open = 0
        self.made = 0

    def _take(self, room: int) -> int:
        stack = self.by_room[room]
        taken = stack.pop()
        if not stack:
            self.rooms ^= 1 << room
        self.open -= 1
        return taken

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(room)
        else:
            room, chosen = self.capacity, self.made
            self.made += 1
        left = room - length
        if left:
            if self.open == self.most:
                self._take((self.rooms & -self.rooms).bit_length() - 1)
            stack = self.by_room.setdefault(left, [])
            stack.append(chosen)
            self.rooms |= 1 << left
            self.open += 1
        return chosen, self.capacity - room


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: where it starts in its document, how long it is and the CRC of its ids.

    An encoder lives as long as its task: an executor's idle workers would each keep about 150 MB of it.
    """
    fields = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Encoder(vocabulary).ids
        for batch in batches:
            rows = []
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = ids_of(body or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((k, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    return in_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), cut, PIECES)


def arrivals(lengths: np.ndarray, look_ahead: int) -> np.ndarray:
    """The order in which pieces are placed: window after window, the longest of a window first."""
    window = np.arange(len(lengths)) // max(1, look_ahead)
    return np.lexsort((-lengths, window))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
                group_rows: int = GROUP_ROWS, look_ahead: int = LOOK_AHEAD) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``.  ``pieces`` must be rows at rest: they are counted, then dealt into groups."""
    groups = max(1, -(-pieces.count() // group_rows))

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending"), ("length", "ascending")])
        lengths = rows["length"].to_numpy()
        order = arrivals(lengths, look_ahead)
        rows, bins = rows.take(pa.array(order)), OpenBins(capacity, open_bins)
        placed = [bins.place(n) for n in lengths[order].tolist()]
        base = rows["packing_group"][0].as_py() << 32
        rows = rows.drop_columns("packing_group")
        rows = rows.append_column("sequence_id", pa.array([base + b for b, _ in placed], pa.int64()))
        return rows.append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    dealt = pieces.withColumn("packing_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    return dealt.groupBy("packing_group").applyInArrow(pack, PACKED)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
                   group_rows: int = GROUP_ROWS, end_id: int = END_ID, key: str = "doc_id", text: str = "text", look_ahead: int = LOOK_AHEAD) -> DataFrame:
    pieces = token_pieces(docs, vocabulary or vocabulary_path(), capacity, end_id, key, text)
    return pack_pieces(staged(pieces, "token-pieces"), capacity, open_bins, group_rows, look_ahead)
