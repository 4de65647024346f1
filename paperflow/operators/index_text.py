"""Inverted word index to text and back, row by row inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind, collapse_ws, text_or_empty

# A position and the number of its index entry share one BIGINT, so that sorting compares plain numbers.
_ENTRY_BITS = 31


def index_to_text(index: Column) -> Column:
    """Words in position order with gaps closed; on a clash the later entry of the map wins."""
    def placed(lists: Column) -> Column:
        return F.sort_array(F.flatten(F.transform(lists, lambda positions, entry: F.transform(
            F.coalesce(positions, F.array().cast("array<int>")),
            lambda p: F.shiftleft(p.cast("bigint"), _ENTRY_BITS) + entry))))

    def word_at(words: Column, codes: Column):
        def one(code: Column, i: Column) -> Column:
            following = F.get(codes, i + 1)
            last = following.isNull() | (F.shiftright(following, _ENTRY_BITS) != F.shiftright(code, _ENTRY_BITS))
            return F.when(last, F.get(words, code.bitwiseAND(F.lit((1 << _ENTRY_BITS) - 1)).cast("int")))
        return one

    text = bind(F.map_keys(index), lambda words: bind(placed(F.map_values(index)), lambda codes: F.array_join(
        F.transform(codes, word_at(words, codes)), " ")))
    return F.coalesce(text, F.lit(""))


def text_to_index(df: DataFrame, text: str, out: str = "inv") -> DataFrame:
    """Word -> sorted positions as a map column.

    Sorting words with their positions makes equal words adjacent, so the map is built
    from slices and no row leaves its task.
    """
    words = F.split(collapse_ws(text_or_empty(F.col(text))), " ")
    tagged = F.transform(F.filter(words, lambda w: w != ""), lambda w, i: F.struct(w.alias("w"), i.alias("i")))

    def entries(ordered: Column) -> Column:
        keys = F.transform(ordered, lambda x: x["w"])
        places = F.transform(ordered, lambda x: x["i"])
        return bind(keys, lambda k: bind(places, lambda p: bind(starts(k), lambda s: F.transform(s, lambda at, i: F.struct(
            F.get(k, at).alias("key"),
            # not `slice`: it copies the whole array on every call
            F.transform(F.sequence(at, F.coalesce(F.get(s, i + 1), F.size(p)) - 1), lambda j: F.get(p, j)).alias("value"))))))

    def starts(keys: Column) -> Column:
        marks = F.transform(keys, lambda w, i: F.when((i == 0) | (w != F.get(keys, i - 1)), i))
        return F.array_compact(marks)

    return df.withColumn(out, F.map_from_entries(bind(F.sort_array(tagged), entries)))
