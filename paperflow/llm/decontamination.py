"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are lower-cased and reduced to their words with single spaces.  An item is looked for by
the passages of ``passage_words`` words from each of its words on, so that a leaked part counts wherever it begins, and besides by longer ones,
whose edits may lie closer together: itself, or windows of ``LONG_WORDS`` words.  A passage of m characters may
differ by e = floor(rate * m) edits.  It is split into e + 1 pieces: whoever has it within e edits has one piece unchanged.  One
automaton finds all pieces in a document; every place so found is verified with Myers' bit-parallel distance.

Benchmarks are taken in chunks of about ``CHUNK_BYTES`` bytes of distinct text, each broadcast for one pass over the documents, so
what is broadcast is bounded and a larger benchmark costs more passes.  Nothing is shuffled but the few hits.

Passages under ``min_chars`` characters after reduction, such as short items, are looked for exactly and on word bounds (parameter).  Null and
empty texts have no hits, nor do items without a word.  A null item_id reads as 0.  Repeated items and documents report like single ones: one row per different (doc_id, item_id).
Empty tables give no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, small_batches, worker_table

RATE = 0.05
PASSAGE_WORDS = 13
LONG_WORDS = 32
MIN_CHARS = 30
CHUNK_BYTES = 256 << 10
"""A byte of items takes some hundred bytes of the automaton, as a passage begins at each word."""
HITS = "doc_id long, item_id long, distance int, passage_chars int, start long"
_WORD = re.compile(r"\w+")


def reduced(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


def windows(words: list[str], size: int, stride: int) -> list[str]:
    """All words if there are at most ``size``, else windows of that many, the last one ending with the words."""
    last = max(0, len(words) - size)
    return [" ".join(words[s:s + size]) for s in [*range(0, last, stride), last]]


def passages(item: str, passage_words: int = PASSAGE_WORDS) -> list[str]:
    """An item's passages: from each word on, and longer ones with a stride of half their length."""
    w = reduced(item).split()
    long = max(LONG_WORDS, passage_words)
    return [p for p in dict.fromkeys(windows(w, passage_words, 1) + windows(w, long, long // 2)) if p]


def budget(length: int, rate: float = RATE) -> int:
    return int(rate * length)


def pieces(passage: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of almost equal length, with their offsets."""
    m, k = len(passage), errors + 1
    cuts = [m * i // k for i in range(k + 1)]
    return [(a, passage[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to any part of ``text`` and where the first such part ends."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = mask, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & mask, pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = ph << 1 & mask, mh << 1 & mask
        pv, mv = mh | ~(xv | ph) & mask, ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def on_words(body: str, start: int, end: int) -> bool:
    return (start == 0 or body[start - 1] == " ") and (end == len(body) or body[end] == " ")


class Finder:
    """All passages of some items with one automaton over their pieces."""

    def __init__(self, items: list[tuple[int, str]], rate: float, passage_words: int, min_chars: int):
        import ahocorasick

        owners: dict[str, list[int]] = {}
        for item_id, text in items:
            for p in passages(text, passage_words):
                owners.setdefault(p, []).append(item_id)
        self.patterns = [(p, budget(len(p), rate) if len(p) >= min_chars else 0, ids) for p, ids in owners.items()]
        self.min_chars = min_chars
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (p, e, _) in enumerate(self.patterns):
            for at, piece in pieces(p, e):
                places.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def find(self, text: str) -> dict[int, tuple[int, int, int]]:
        """For each item found: its best (distance, passage length, start in the reduced text)."""
        if self.empty:
            return {}
        body, starts = reduced(text), {}
        for end, (length, where) in self.automaton.iter(body):
            for k, at in where:
                starts.setdefault(k, set()).add(end + 1 - length - at)
        best: dict[int, tuple[int, int, int]] = {}
        for k, places in starts.items():
            p, e, ids = self.patterns[k]
            m, found = len(p), None
            exact = sorted(s for s in places if s >= 0 and body.startswith(p, s) and (m >= self.min_chars or on_words(body, s, s + m)))
            if exact:
                found = (0, m, exact[0])
            elif e:
                for s in sorted(places):
                    left = max(0, s - e)
                    distance, stop = myers(p, body[left:max(0, s + m + e)])
                    if distance <= e and (found is None or distance < found[0]):
                        found = (distance, m, max(left, left + stop - m))
            if found:
                for i in ids:
                    if i not in best or found < best[i]:
                        best[i] = found
        return best


def _finder(items: tuple[tuple[int, str], ...], rate: float, passage_words: int, min_chars: int) -> Finder:
    return worker_table("finder", (items, rate, passage_words, min_chars), lambda: Finder(list(items), rate, passage_words, min_chars))


def _chunk_hits(docs: DataFrame, items: list[tuple[int, str]], rate: float, passage_words: int, min_chars: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(tuple(items))
    fields = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("passage_chars", pa.int32()), ("start", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(sent.value, rate, passage_words, min_chars)
        for batch in batches:
            rows = [(k, i, *hit) for k, body in zip(*(c.to_pylist() for c in batch.columns)) if body for i, hit in finder.find(body).items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return in_batches(docs, scan, HITS)


def _chunks(benchmark: DataFrame, chunk_bytes: int, item: str, item_text: str) -> Iterator[list[tuple[int, str]]]:
    """The different items in lists of about ``chunk_bytes`` bytes, dealt by hash."""
    items = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).head()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks))
    for c in range(chunks):
        yield sorted((r["item_id"] or 0, r["text"]) for r in items.where(part == c).collect())


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, passage_words: int = PASSAGE_WORDS, min_chars: int = MIN_CHARS,
               chunk_bytes: int = CHUNK_BYTES, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item with the least distance found, of equal ones the longest passage that comes first."""
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = [_chunk_hits(narrow, items, rate, passage_words, min_chars) for items in _chunks(benchmark, chunk_bytes, item, item_text)]
    best = F.min(F.struct("distance", (-F.col("passage_chars")).alias("shorter"), "start")).alias("best")
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.distance", (-F.col("best.shorter")).alias("passage_chars"), "best.start")


def _is_clean(sent, rate: float, passage_words: int, min_chars: int):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        finder = _finder(sent.value, rate, passage_words, min_chars)
        return pd.Series([not (body and finder.find(body)) for body in texts], dtype=bool)

    return clean


def drop_leaked(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, passage_words: int = PASSAGE_WORDS, min_chars: int = MIN_CHARS,
                chunk_bytes: int = CHUNK_BYTES, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without any leaked item: one narrow filter per chunk of the benchmark, no shuffle."""
    for items in _chunks(benchmark, chunk_bytes, item, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(tuple(items))
        docs = small_batches(docs).where(_is_clean(sent, rate, passage_words, min_chars)(F.col(text)))
    return docs
