"""Probabilistic suffix tree over words: learning from the whole corpus and scoring every text.

Symbols are the words of a text and one end after them.  The root is the unigram distribution (c + 1/2) / (N + (V + 1) / 2).  A
context is the last one, two ... ``depth`` symbols; the start of a text counts as the context "end".  Following Ron, Singer and
Tishby, a sequence that occurs less than ``least_count`` times is no context and no child of its own; the count is the same for every
corpus, so the tree grows with it.  A context stays only if its next-symbol distribution diverges from that of the next shorter context by
at least ``divergence`` nats for each child (count times Kullback-Leibler divergence, all that is no child taken as one).

A kept context s with the next shorter one s' has P(x | s) = (c(sx) + R(s) P(x | s')) / (K(s) + R(s)): K counts its known
children, R is the rest of its count plus ``prior``.  So each distribution sums to one over the words and one unknown word.
A text's score is the sum of log10 P(symbol | longest kept suffix of what went before).  It is a sum over what each position meets: a kept
context adds log10 R / (K + R), and a known child adds what its own P exceeds that and the shorter context's P by.

Sequences go by 64-bit keys, each made from the key of all but the last symbol.  Counts, contexts and values are tables that Spark
partitions and joins; nothing of the tree is gathered but its most frequent entries, at most ``SENT`` of words and of values, which are broadcast, and
filters of bounded size that tell which keys are worth a shuffle.  On a larger corpus the filters let more keys through, which costs
rows, never results.  What the broadcast does not answer is asked by packed stripes of keys that meet the entries of their stripe; rare
words are summed for each text and looked up by a join.
The children of one context meet in a task, as many as the context has different known ones.

Null texts count as empty and have the end alone.  A null id counts as the text "".  Repeated rows are learnt as often as they
occur and scored each.  Without training rows N and V are 0 and every symbol has probability 1.  An empty table gives
no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import filters
from .common import dropped, in_batches, raw, staged, words
from .filters import KeyFilter, distinct, key_filter, mixed

LEAST_COUNT = 3
DEPTH = 3
DIVERGENCE = 4.0
PRIOR = 5.0
SENT = 1 << 21
END = b" "
"""No word holds a space."""
FLUSH = 1_000_000
HELD = 1_500_000
"""Positions whose sequences a task counts at a time."""
STRIPE = 1 << 21
"""Positions whose sequences a stripe of the counting holds on average."""
PIECE = 1 << 15
"""Sequences that one row of the shuffle holds at most."""
ASKED = 1 << 20
"""Keys to look up that a task holds at a time, and entries that a stripe of the look-up holds on average."""
ANSWERS = pa.list_(pa.struct([("row", pa.int64()), ("gained", pa.float64())]))
DEALT = 64
"""Numbers below 0 by which scored texts are dealt to the tasks of the look-up."""
CONTEXT = np.uint64(0x5851F42D4C957F2D)
"""Sets a context's entry apart from that of the sequence itself."""
LONG = 64
"""Bytes of a word that are hashed eight at a time, all words at once; longer words go one by one."""
SEEDS = mixed(np.arange(LONG + 2, dtype=np.uint64))
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def symbols_at(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit symbols, never 0, which is a gap, of the words that lie in ``data``, which goes on for 8 bytes after the last one."""
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    out = SEEDS[np.minimum(sizes, LONG + 1)]
    left = np.flatnonzero(sizes <= LONG)
    for at in range(0, LONG, 8):
        out[left] = mixed(out[left] + (eights[starts[left] + at] & MASKS[np.minimum(sizes[left] - at, 8)]))
        left = left[sizes[left] > at + 8]
        if not len(left):
            break
    for k in np.flatnonzero(sizes > LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k]:starts[k] + sizes[k]].tobytes())
    out[out == 0] = 1
    return out


def symbols_of(found: pa.BinaryArray) -> np.ndarray:
    ends = np.frombuffer(found.buffers()[1], np.int32)[found.offset:found.offset + len(found) + 1].astype(np.int64)
    return symbols_at(np.concatenate([np.frombuffer(found.buffers()[2], np.uint8), np.zeros(8, np.uint8)]), ends[:-1], np.diff(ends))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word binary, symbol long, c`` of one column of texts, ends included."""
    schema = pa.schema([("word", pa.binary()), ("symbol", pa.int64()), ("c", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums in a bounded table; what does not fit goes on to the shuffle."""
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])

        def flush() -> Iterator[pa.RecordBatch]:
            rows = summed()
            found = rows["word"].combine_chunks()
            yield from pa.table([found, pa.array(symbols_of(found).view(np.int64)), rows["c"]], schema=schema).to_batches()

        for batch in batches:
            for lines in in_lines(batch.column(0).to_pylist()):
                held.append(lines.counted())
                if sum(map(len, held)) > FLUSH:
                    held = [summed()]
                    if len(held[0]) > FLUSH // 2:
                        yield from flush()
                        held = []
        if held:
            yield from flush()

    return in_batches(texts, count, "word binary, symbol long, c long").groupBy("word", "symbol").agg(F.sum("c").alias("c"))


class Keys:
    """Sorted 64-bit hashes with the place where those of each beginning start, so that most are found, or not, in one step."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        bits = max(6, (2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        beginning = (self.keys >> self.shift).astype(np.int64)
        new = np.flatnonzero(np.diff(beginning, prepend=-1))
        self.first = np.full(1 << bits, -1, np.int32)
        self.first[beginning[new]] = new

    def __reduce__(self):
        """The places are made anew where it arrives: every executor writes a broadcast to its disk."""
        return Keys, (self.keys, self.values)

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and their values, else 0."""
        there, out = np.zeros(len(asked), bool), np.zeros(len(asked))
        at = self.first[(asked >> self.shift).astype(np.int64)]
        left = np.flatnonzero(at >= 0)
        at, wanted = at[left], asked[left]
        while len(left):
            key = self.keys[at]
            same = np.flatnonzero(key == wanted)
            there[left[same]], out[left[same]] = True, self.values[at[same]]
            at += 1
            more = np.flatnonzero((key < wanted) & (at < len(self.keys)))
            left, at, wanted = left[more], at[more], wanted[more]
        return there, out


def chain(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The key of a sequence from that of all but its last symbol, and the last symbol; 0 where one of them is."""
    with np.errstate(over="ignore"):
        key = mixed(mixed(before) + last)
    return np.where((before == 0) | (last == 0), np.uint64(0), key)


END_SYMBOL = symbols_of(pa.array([END], pa.binary()))[0]


class Lines:
    """Several texts as one row of symbols: the start, the words, the end and a gap for each."""

    def __init__(self, bodies: list[bytes]):
        self.bytes = b" ".join([b"", *bodies, b""]).lower() + b" " * 8
        data = np.frombuffer(self.bytes, np.uint8)
        is_space = IS_SPACE[data]
        self.edges = np.flatnonzero(is_space[1:] != is_space[:-1]) + 1
        at = self.edges[::2]
        bounds = np.cumsum([1, *(len(b) + 1 for b in bodies)])
        self.sizes = np.diff(np.searchsorted(at, bounds))
        self.starts = np.cumsum(np.concatenate([[0], self.sizes[:-1] + 3]))
        self.ends = self.starts + self.sizes + 1
        is_word = np.ones(len(at) + 3 * len(bodies), bool)
        for k in (self.starts, self.ends, self.ends + 1):
            is_word[k] = False
        self.word_places = np.flatnonzero(is_word)

    @cached_property
    def symbols(self) -> np.ndarray:
        at, past = self.edges[::2], self.edges[1::2]
        out = np.zeros(len(at) + 3 * len(self.sizes), np.uint64)
        out[self.word_places] = symbols_at(np.frombuffer(self.bytes, np.uint8), at, past - at)
        out[self.starts] = out[self.ends] = END_SYMBOL
        return out

    def word(self, k: int) -> bytes:
        return self.bytes[self.edges[2 * k]:self.edges[2 * k + 1]]

    def counted(self) -> pa.Table:
        """``word, c``, ends included."""
        both = pa.Array.from_buffers(pa.binary(), max(0, len(self.edges) - 1), [None, pa.py_buffer(self.edges.astype(np.int32)), pa.py_buffer(self.bytes)])
        found = pc.value_counts(both.take(pa.array(np.arange(0, len(both), 2))))
        return pa.table([pa.chunked_array([found.field("values"), pa.array([END], pa.binary())]), pa.chunked_array([found.field("counts"), pa.array([len(self.sizes)], pa.int64())])],
                        names=["word", "c"])

    def keys(self, length: int) -> list[np.ndarray]:
        """For 1, 2 ... ``length`` symbols ending at each place their key, 0 where a gap lies between."""
        out = [self.symbols]
        for _ in range(1, length):
            longer = np.zeros_like(self.symbols)
            longer[1:] = chain(out[-1][:-1], self.symbols[1:])
            out.append(longer)
        return out


def in_lines(bodies: list[bytes], most: int = 1 << 19) -> Iterator[Lines]:
    """Texts in groups of about ``most`` bytes."""
    held, size = [], 0
    for body in bodies:
        held.append(body)
        size += len(body)
        if size >= most:
            yield Lines(held)
            held, size = [], 0
    if held:
        yield Lines(held)


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers, each as its different values and their places, which are short as words are unequally frequent."""
    parts = [np.array([len(columns), len(columns[0])], "<u4").tobytes()]
    for column in columns:
        found = pa.array(column).dictionary_encode()
        values, places = found.dictionary.to_numpy(), found.indices.to_numpy()
        kind = "<u1" if len(values) <= 1 << 8 else "<u2" if len(values) <= 1 << 16 else "<u4"
        parts += [np.array([len(values), int(kind[2])], "<u4").tobytes(), values.astype("<u8").tobytes(), places.astype(kind).tobytes()]
    return b"".join(parts)


def unpacked(data: bytes) -> list[np.ndarray]:
    columns, rows = np.frombuffer(data, "<u4", 2).tolist()
    at, out = 8, []
    for _ in range(columns):
        n, width = np.frombuffer(data, "<u4", 2, at).tolist()
        values = np.frombuffer(data, "<u8", n, at + 8)
        at += 8 + 8 * n
        out.append(values[np.frombuffer(data, f"<u{width}", rows, at)])
        at += width * rows
    return out


def planes(columns: list[np.ndarray]) -> bytes:
    """Columns of 4 or 8 bytes a number by the bytes' places, which an entropy coder shortens: high bytes of ranks and of differences are mostly 0."""
    whole = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns)
    head = np.array([len(columns), len(columns[0]), *(c.itemsize for c in columns)], "<u4").tobytes()
    return head + pa.Codec("zstd", compression_level=1).compress(whole, asbytes=True)


def from_planes(data: bytes) -> list[np.ndarray]:
    n, rows = np.frombuffer(data, "<u4", 2).tolist()
    widths = np.frombuffer(data, "<u4", n, 8).tolist()
    whole = np.frombuffer(pa.Codec("zstd").decompress(data[8 + 4 * n:], decompressed_size=rows * sum(widths)), np.uint8)
    at, out = 0, []
    for width in widths:
        out.append(np.ascontiguousarray(whole[at:at + width * rows].reshape(width, rows).T).view(f"<u{width}")[:, 0])
        at += width * rows
    return out


def stripes_of(keys: np.ndarray, bits: int, piece: int) -> Iterator[tuple[int, slice]]:
    """The pieces of sorted keys, cut by their first bits."""
    bounds = np.searchsorted((keys >> np.uint64(44)).astype(np.int64) >> (20 - bits), np.arange((1 << bits) + 1))
    for k in range(1 << bits):
        for at in range(bounds[k], bounds[k + 1], piece):
            yield k, slice(at, min(at + piece, bounds[k + 1]))


def summed(keys: np.ndarray, counts: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The different keys in order, their counts and columns."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.add.reduceat(counts[order], new), [c[order[new]] for c in columns]


def chained(symbols: list[np.ndarray]) -> np.ndarray:
    key = symbols[0]
    for last in symbols[1:]:
        key = chain(key, last)
    return key


def scaled_filter(keys: DataFrame, column: str) -> KeyFilter:
    """Up to eight times the bits where there are so many keys.  Few tasks set them, as each sends all it has set."""
    shift = min(3, (8 * keys.count() // filters.FILTER_BITS).bit_length())
    return key_filter(keys.coalesce(32), column, filters.FILTER_BITS << shift)


def sequence_counts(texts: DataFrame, length: int, known: KeyFilter, least_count: int, n_symbols: int, ranked: Broadcast) -> DataFrame:
    """``context, short, last, c, key`` of the sequences of ``length`` symbols that occur ``least_count`` times: the keys of all but the last symbol, of
    that without its first one (0 if that is all), the last symbol and the key of the whole.  ``known`` tells which shorter ones may be so frequent.

    Tasks sum what they hold and cut it by the first bits of the key into stripes, as many as ``n_symbols`` positions ask for; a stripe is summed at once.
    A sequence crosses as the ranks of its words in ``ranked``, or whole if one of them has none though it may be frequent."""
    sent = texts.sparkSession.sparkContext.broadcast(known.bits)
    bits = min(20, max(0, (n_symbols // STRIPE).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = KeyFilter(sent.value)
        ranks, complete = ranked.value
        short: list[list[np.ndarray]] = []
        whole: list[list[np.ndarray]] = []
        size = 0

        def cut() -> Iterator[pa.RecordBatch]:
            for by_rank, held in ((True, short), (False, whole)):
                own, *columns = [np.concatenate(x) for x in zip(*held)] if held else [np.zeros(0, np.uint64)]
                held.clear()
                if not len(own):
                    continue
                keys, c, columns = summed(own, np.ones(len(own), np.uint64), columns)
                for k, part in stripes_of(keys, bits, PIECE):
                    rows = [x[part] for x in columns]
                    data = planes([c[part].astype("<u4"), *rows]) if by_rank else packed([c[part], *rows])
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([by_rank]), pa.array([data], pa.binary())], names=["stripe", "ranked", "part"])

        for batch in batches:
            for lines in in_lines(batch.column(0).to_pylist()):
                key = lines.keys(length - 1)[-1]
                context, suffix, last = key[:-1], key[1:], lines.symbols[1:]
                at = np.flatnonzero((context != 0) & (last != 0))
                at = at[may.may_have(context[at])]
                at = at[may.may_have(suffix[at])]
                has_rank, rank = ranks.find(lines.symbols)
                rank = rank.astype("<u4")
                places = [at + k for k in range(2 - length, 2)]
                all_ranked = np.logical_and.reduce([has_rank[x] for x in places])
                keys = chain(context[at], last[at])
                short.append([keys[all_ranked], *(rank[x[all_ranked]] for x in places)])
                size += np.count_nonzero(all_ranked)
                if not complete and not all_ranked.all():
                    whole.append([keys[~all_ranked], *(lines.symbols[x[~all_ranked]] for x in places)])
                    size += len(whole[-1][0])
                if size > HELD:
                    yield from cut()
                    size = 0
        if size:
            yield from cut()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, _ = ranked.value
        symbol = np.zeros(len(ranks.keys), np.uint64)
        symbol[ranks.values.astype(np.int64)] = ranks.keys
        own, held = None, []

        def often() -> Iterator[pa.RecordBatch]:
            counts, *symbols = [np.concatenate(x) for x in zip(*held)]
            keys, c, symbols = summed(chained(symbols), counts, symbols)
            at = np.flatnonzero(c >= np.uint64(least_count))
            symbols = [x[at] for x in symbols]
            shorter = chained(symbols[1:-1]) if length > 2 else np.zeros(len(at), np.uint64)
            rows = pa.table([pa.array(x.view(np.int64)) for x in (chained(symbols[:-1]), shorter, symbols[-1], c[at], keys[at])], names=["context", "short", "last", "c", "key"])
            yield from rows.to_batches(max_chunksize=PIECE)

        for batch in batches:
            for stripe, by_rank, part in zip(*(x.to_pylist() for x in batch.columns)):
                if held and stripe != own:
                    yield from often()
                    held = []
                own = stripe
                if by_rank:
                    c, *places = from_planes(part)
                    held.append([c.astype(np.uint64), *(symbol[x] for x in places)])
                else:
                    held.append(unpacked(part))
        if held:
            yield from often()

    parts = in_batches(texts, count, "stripe int, ranked boolean, part binary").repartition(1 << bits, "stripe").sortWithinPartitions("stripe")
    out = staged(in_batches(parts, total, "context long, short long, last long, c long, key long"), "sequences")
    sent.destroy()
    return out


def judged(found: DataFrame, contexts: DataFrame, shorter: DataFrame, divergence: float, prior: float) -> DataFrame:
    """The known sequences with the P of their last symbol and whether their context is kept.

    ``contexts``: ``context, whole`` (its count).  ``shorter``: ``short, last, below``, the P of the symbol after the next shorter context.
    """
    met = found.join(shorter, ["short", "last"]).join(contexts, "context")
    of_context = Window.partitionBy("context")
    rest = F.greatest(F.col("whole") - F.col("kids"), F.lit(0)) + F.lit(prior)
    kids = met.withColumns({"kids": F.sum("c").over(of_context), "n_kids": F.count(F.lit(1)).over(of_context), "theirs": F.sum("below").over(of_context)})
    own = kids.withColumn("rest", rest).withColumn("p", (F.col("c") + F.col("rest") * F.col("below")) / (F.col("kids") + F.col("rest")))
    gain = F.sum(F.col("c") * F.ln(F.col("p") / F.col("below"))).over(of_context)

    def left_out(taken: Column) -> Column:
        return F.greatest(F.lit(1e-12), F.least(F.lit(1.0), 1 - taken))

    mine = left_out((F.col("kids") + F.col("rest") * F.col("theirs")) / (F.col("kids") + F.col("rest")))
    others = (F.col("rest") - F.lit(prior)) * F.ln(mine / left_out(F.col("theirs")))
    kept = own.withColumn("gain", gain).withColumn("kept", F.col("gain") + others >= F.lit(divergence) * F.col("n_kids"))
    left = F.log10(F.col("rest") / (F.col("kids") + F.col("rest")))
    return staged(kept.select("key", "context", "last", "c", "whole", "kept", "below", F.when(F.col("kept"), F.col("p")).otherwise(F.col("below")).alias("p"), left.alias("left")),
                  "judged-sequences")


def entries(levels: list[DataFrame], spark) -> DataFrame:
    """``k, v, c``: what a kept context and what a known child of one adds to a score, with its count."""
    tag = F.lit(int(CONTEXT.view(np.int64))).cast("long")
    out = spark.createDataFrame([], "k long, v double, c long")
    for rows in levels:
        kept = rows.where("kept")
        children = kept.select(F.col("key").alias("k"), (F.log10("p") - F.log10("below") - F.col("left")).alias("v"), "c")
        contexts = kept.groupBy("context").agg(F.first("left").alias("v"), F.first("whole").alias("c"))
        out = out.unionByName(children).unionByName(contexts.select(F.col("context").bitwiseXOR(tag).alias("k"), "v", "c"))
    return staged(out, "tree-entries")


def most_frequent(rows: DataFrame, most: int) -> int:
    """The least count that at most ``most`` rows reach."""
    step = F.floor(F.log2("c") * 8)
    cut, n = None, 0
    for r in sorted(rows.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect(), key=lambda r: -r["step"]):
        n += r["n"]
        if n > most:
            break
        cut = r["c"]
    return 1 << 62 if cut is None else cut


def _gathered(rows: DataFrame, key: str, value: Column) -> Keys:
    found = rows.select(F.col(key).alias("k"), value.alias("v")).toArrow()
    return Keys(found["k"].to_numpy().view(np.uint64), found["v"].to_numpy().astype(float))


@dataclass
class Sent:
    """What tasks know of the tree: the most frequent words' log10 P, the most frequent entries, and which keys the other entries may have."""

    words: Keys
    values: Keys
    others: KeyFilter
    depth: int


def scores(lines: Lines, known: Sent) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """For each text its unigram score and its tree score, as far as the broadcast tells; places of words that are not in it; owners and keys to look up."""
    n = len(lines.symbols)
    owner = np.repeat(np.arange(len(lines.sizes)), lines.sizes + 3)
    counted = np.ones(n, bool)
    counted[lines.starts] = counted[lines.ends + 1] = False
    told, base = known.words.find(lines.symbols)
    base = np.where(counted, base, 0.0)
    logs = base.copy()
    asked_owner, asked = [], []
    keys = lines.keys(known.depth + 1)
    for length in range(1, known.depth + 1):
        at = np.flatnonzero(keys[length])
        at = at[counted[at]]
        context = keys[length - 1][at - 1] ^ CONTEXT
        there, value = known.values.find(context)
        logs[at] += value
        unsure = np.zeros(len(at), bool)
        unsure[~there] = known.others.may_have(context[~there])
        asked.append(context[unsure]), asked_owner.append(owner[at[unsure]])
        at = at[there | unsure]
        own = keys[length][at]
        there, value = known.values.find(own)
        logs[at] += value
        rest = ~there
        rest[rest] = known.others.may_have(own[rest])
        asked.append(own[rest]), asked_owner.append(owner[at[rest]])
    missing = np.flatnonzero(counted & ~told)
    return np.add.reduceat(base, lines.starts), np.add.reduceat(logs, lines.starts), missing, (np.concatenate(asked_owner), np.concatenate(asked))


def asked_parts(owners: np.ndarray, keys: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """Per stripe the keys in order, as differences, each with its text and how often that asks for it."""
    order = np.lexsort((owners, keys))
    owners, keys = owners[order], keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), (owners[1:] != owners[:-1]) | (keys[1:] != keys[:-1])]))
    times = np.diff(np.concatenate([first, [len(keys)]]))
    owners, keys = owners[first], keys[first]
    for k, part in stripes_of(keys, bits, PIECE // 2):
        yield k, planes([np.diff(keys[part], prepend=np.uint64(0)), owners[part].astype("<u4"), times[part].astype("<u4")])


def answered(scored: DataFrame, others: DataFrame, bits: int) -> DataFrame:
    """The rows of ``scored`` that are texts, and ``answers`` with what the entries add to those that ask for them, a row for each request.

    A request has a stripe from 0 on, the row of the first text and ``asked_parts``; it meets the entries of its stripe in one task and is not kept."""
    def entry_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def cut() -> Iterator[pa.RecordBatch]:
            keys, values = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            order = np.argsort(keys)
            keys, values = keys[order], values[order]
            for k, part in stripes_of(keys, bits, PIECE // 2):
                data = planes([np.diff(keys[part], prepend=np.uint64(0)), values[part].view(np.uint64)])
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([-1], pa.int64()), pa.array([data], pa.binary())], names=["stripe", "row", "part"])

        for batch in batches:
            held.append([batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().astype(float)])
            if sum(len(x) for x, _ in held) > ASKED:
                yield from cut()
        if held:
            yield from cut()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, table = None, [], None
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            stripes, parts = columns.pop("stripe"), columns.pop("part")
            is_text = pc.less(stripes, 0)
            texts = batch.filter(is_text)
            if len(texts):
                yield pa.RecordBatch.from_arrays([*(texts.column(name) for name in columns), pa.nulls(len(texts), ANSWERS)], names=[*columns, "answers"])
            at_row = columns["row"].to_pylist()
            for k, stripe in enumerate(stripes.to_pylist()):
                if stripe < 0:
                    continue
                if stripe != own:
                    own, held, table = stripe, [], None
                found = from_planes(parts[k].as_py())
                keys = np.cumsum(found[0], dtype=np.uint64)
                if at_row[k] < 0:
                    held.append([keys, found[1].view(float)])
                    continue
                if table is None and held:
                    table = Keys(*[np.concatenate(x) for x in zip(*held)])
                if table is not None:
                    there, values = table.find(keys)
                    owners, gained = found[1][there].astype(np.int64), (values * found[2])[there]
                    rows = distinct(owners)
                    if len(rows):
                        pairs = pa.StructArray.from_arrays([pa.array(at_row[k] + rows), pa.array(np.bincount(owners, gained)[rows])], names=["row", "gained"])
                        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, c.type) for c in columns.values()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), pairs)],
                                                         names=[*columns, "answers"])

    sent = in_batches(others.select("k", "v"), entry_parts, "stripe int, row long, part binary")
    met = scored.unionByName(sent, allowMissingColumns=True).repartition(1 << bits, "stripe").sortWithinPartitions("stripe", "row")
    return in_batches(met, answer, ", ".join(f"`{n}` {t}" for n, t in scored.dtypes if n not in ("stripe", "part")) + ", answers array<struct<row: long, gained: double>>")


def _word_lists(lines: Lines, places: np.ndarray, n: int) -> pa.ListArray:
    found: list[Counter] = [Counter() for _ in range(n)]
    owner = np.searchsorted(lines.starts, places, side="right") - 1
    at_word = np.searchsorted(lines.word_places, places)
    ends = set(lines.ends.tolist())
    for place, k, w in zip(places.tolist(), owner.tolist(), at_word.tolist()):
        found[k][END if place in ends else lines.word(w)] += 1
    pairs = pa.StructArray.from_arrays([pa.array([w for x in found for w in x], pa.binary()), pa.array([c for x in found for c in x.values()], pa.int64())], names=["word", "n"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pairs)


def word_ranks(counts: DataFrame, least_count: int, sent: int) -> tuple[Keys, bool]:
    """The most frequent words, at most ``sent``, with their ranks, and whether these are all that occur ``least_count`` times."""
    cut = most_frequent(counts, sent)
    found = counts.where(F.col("c") >= max(least_count, cut)).select("symbol", "c").toArrow()
    symbol, c = found["symbol"].to_numpy().view(np.uint64), found["c"].to_numpy()
    rank = np.empty(len(c))
    rank[np.lexsort((symbol, -c))] = np.arange(len(c))
    return Keys(symbol, rank), cut <= least_count


def grow(training: DataFrame, counts: DataFrame, n_symbols: int, whole: float, least_count: int, depth: int, divergence: float, prior: float,
         sent: int = SENT) -> list[DataFrame]:
    """The judged sequences of 2, 3 ... ``depth`` + 1 symbols."""
    often = counts.where(F.col("c") >= least_count)
    ranked = training.sparkSession.sparkContext.broadcast(word_ranks(counts, least_count, sent))
    contexts = often.select(F.col("symbol").alias("context"), F.col("c").alias("whole"))
    shorter = often.select(F.lit(0).cast("long").alias("short"), F.col("symbol").alias("last"), ((F.col("c") + 0.5) / F.lit(whole)).alias("below"))
    known, levels = scaled_filter(often, "symbol"), []
    for length in range(2, depth + 2):
        found = sequence_counts(training, length, known, least_count, n_symbols, ranked)
        rows = judged(found, contexts, shorter, divergence, prior)
        dropped(found)
        levels.append(rows)
        if length <= depth:
            known = scaled_filter(rows, "key")
            contexts = rows.select(F.col("key").alias("context"), F.col("c").alias("whole"))
            shorter = rows.select(F.col("context").alias("short"), "last", F.col("p").alias("below"))
    ranked.destroy()
    return levels


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", least_count: int = LEAST_COUNT, depth: int = DEPTH,
                    divergence: float = DIVERGENCE, prior: float = PRIOR, sent: int = SENT) -> DataFrame:
    """Learns from the rows that ``held_out`` leaves and scores all rows.  ``sent`` bounds each of the two broadcast tables."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), raw(text).alias("body"))
    training = rows.where(~held_out(F.col("doc_id"))).select("body")
    counts = staged(word_counts(training), "word-counts")
    n_symbols, n_different = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).head()
    whole = n_symbols + 0.5 * (n_different + 1)
    own = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / whole) if n_symbols else F.lit(0.0)
    levels = grow(training, counts, n_symbols, whole, least_count, depth, divergence, prior, sent) if n_symbols else []
    found = entries(levels, spark)
    dropped(*levels)
    cut = most_frequent(found, sent)
    few, others = found.where(F.col("c") >= cut), staged(found.where(F.col("c") < cut), "other-entries")
    common = counts.where(F.col("c") >= max(least_count, most_frequent(counts, sent)))
    others_bits = scaled_filter(others, "k").bits
    told = spark.sparkContext.broadcast((_gathered(common, "symbol", own), _gathered(few, "k", F.col("v")), others_bits, depth))
    dropped(found)
    bits = min(20, (others.count() // ASKED).bit_length())
    part = (f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, n_tokens long, base double, logs double, "
            "rare array<struct<word: binary, n: long>>, row long, stripe int, part binary")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, values, filter_bits, deep = told.value
        known = Sent(frequent, values, KeyFilter(filter_bits), deep)
        names = ["doc_id", "held_out", "n_tokens", "base", "logs", "rare", "row", "stripe", "part"]
        kinds: list[pa.DataType] = []
        row = first = TaskContext.get().partitionId() << 33
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def requests() -> Iterator[pa.RecordBatch]:
            parts = list(asked_parts(*(np.concatenate(x) for x in zip(*held)), bits))
            held.clear()
            for stripe, data in parts:
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, kind) for kind in kinds), pa.array([first]), pa.array([stripe], pa.int32()), pa.array([data], pa.binary())], names=names)

        for batch in batches:
            n_tokens, base, logs, rare = [], [], [], []
            for lines in in_lines(batch.column(2).to_pylist()):
                own_base, own_logs, missing, (owners, keys) = scores(lines, known)
                n = len(lines.sizes)
                held.append((owners + (row - first + sum(map(len, n_tokens))), keys))
                n_tokens.append(lines.sizes + 1), base.append(own_base), logs.append(own_logs)
                rare.append(_word_lists(lines, missing, n))
            if rare:
                columns = [batch.column(0), batch.column(1), *[pa.array(np.concatenate(x)) for x in (n_tokens, base, logs)], pa.concat_arrays(rare)]
                kinds = [c.type for c in columns]
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(row, row + n)), pa.array(-1 - np.arange(n) % DEALT, pa.int32()), pa.nulls(n, pa.binary())], names=names)
                row += n
            if sum(len(keys) for _, keys in held) > ASKED:
                yield from requests()
                first = row
        if held:
            yield from requests()

    scored = in_batches(rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "body"), score, part)
    scored = staged(answered(scored, others, bits), "tree-scores")
    told.destroy()
    dropped(others)
    met = scored.where("answers IS NOT NULL").select(F.explode("answers").alias("a")).groupBy("a.row").agg(F.sum("a.gained").alias("gained"))
    scored = scored.where("answers IS NULL").drop("answers")
    nothing = F.lit(0.0)
    words_met = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").join(counts.select("word", "c"), "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * own).alias("own"), F.sum(F.when(F.col("c").isNull(), F.col("n")).otherwise(0)).alias("unknown"))
    words_met, met = staged(words_met, "rare-words"), staged(met, "looked-up")
    joined = scored.drop("rare").join(words_met, "row", "left").join(met, "row", "left")
    added, gained = F.coalesce("own", nothing), F.coalesce("gained", nothing)
    return joined.select(F.col("doc_id").alias(key), "held_out", "n_tokens", (F.col("n_tokens") - F.coalesce("unknown", F.lit(0))).alias("n_known"),
                         F.lit(n_symbols).cast("long").alias("train_tokens"), (F.col("base") + added).alias("base_score"),
                         (F.col("logs") + added + gained).alias("score"))
