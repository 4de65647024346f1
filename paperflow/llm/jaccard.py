"""Exact Jaccard self-join of word-shingle sets by universe partitioning, and its connected components.

Two sets whose Jaccard index is at least ``percent`` / 100 differ in at most H shingles (H follows from their sizes).  Sizes are
banded; in each band the universe of shingles is hashed into m segments, of which q also get one-deletion neighbourhoods.  As
m + q > H + 2, two such sets agree in two whole segments at least, or in some of the q up to one shingle: those are the signatures they share.  For each
band (m, q) is chosen by cost: signatures to index against chance agreements expected among the sets counted in the band.

Sets, names, stars, sketches, exact verification and edge cases are those of ``linking``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import C1, mixed
from .linking import Signer, document_sets, linked_components, most_different, one_row_each, set_classes, signatures_of_texts

K, PERCENT = 5, 80
RATIO = 1.5
ROW_COST, PAIR_COST = 10.0, 0.02
"""In index entries: a class that shares a signature by chance, whose sketch goes through two joins, and a comparison of two
sketches.  28 million entries took 112 s of task time on a slow machine, 4 us each; the two ratios are estimates."""
SHARED = 2
"""Signatures that two linked sets share at least, as ``linking`` asks."""


def band_starts(percent: int, largest: int) -> list[int]:
    """Least sizes of the bands.  A linked set of another band is in the next one, as bands grow by 100 / percent at least."""
    ratio, starts = max(RATIO, 100 / percent), [1]
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, math.floor(starts[-1] * ratio)))
    return [*starts, max(starts[-1] + 1, math.floor(starts[-1] * ratio))]


def allocation(band: int, starts: list[int], percent: int, n_sets: int) -> tuple[int, int]:
    """(m, q): segments, and how many of them get one-deletion neighbourhoods, at least cost for ``n_sets`` sets."""
    small = starts[band + 1] - 1
    total = small + 100 * small // percent
    h = max(0, most_different(total, percent), most_different(total - 1, percent))
    size = (starts[band] + small) / 2

    def cost(q: int) -> float:
        m = h + 1 + SHARED - q
        held = size / m
        empty, almost = math.exp(-held), (1 + held) * math.exp(-held)
        rows = n_sets * ((m - q) * empty + q * almost)
        pairs = n_sets * (n_sets - 1) / 2 * ((m - q) * empty**2 + q * almost**2)
        return n_sets * (m + q * held) + ROW_COST * rows + PAIR_COST * pairs

    best = min(range((h + 1) // 2 + 1), key=lambda q: (cost(q), q))
    return h + 1 + SHARED - best, best


def signatures(s: np.ndarray, starts: list[int], plan: list[tuple[int, int]], percent: int) -> np.ndarray:
    """In the band of the set's size, and in the one below if a linked set can be there."""
    n = len(s)
    if not n:
        return np.zeros(0, np.uint64)
    band = int(np.searchsorted(starts, n, side="right")) - 1
    spaces = [band] + ([band - 1] if band and n <= 100 * (starts[band] - 1) // percent else [])
    found, value = [], mixed(s ^ C1)
    for space in spaces:
        m, q = plan[space]
        segment = (mixed(s + np.uint64(space)) % np.uint64(m)).astype(np.min_scalar_type(m))  # few bytes are sorted by radix
        with np.errstate(over="ignore"):
            order = np.argsort(segment, kind="stable")
            ends = np.cumsum(np.bincount(segment, minlength=m))
            running = np.zeros(n + 1, np.uint64)
            np.cumsum(value[order], out=running[1:])
            running = running[ends]
            content = running.copy()
            content[1:] -= running[:-1]
            tag = mixed(np.arange(m, dtype=np.uint64) + np.uint64(space << 40))
            found.append(mixed(content ^ tag))
            if q:
                near = segment < q
                found.append(mixed((content[segment[near]] - value[near]) ^ tag[segment[near]]))
    return np.concatenate(found)


def band_plan(sets: DataFrame, percent: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Bands up to the largest set and what each is given, from counts over all sets."""
    largest = sets.agg(F.max("n_shingles")).head()[0] or 0
    starts = band_starts(percent, largest)
    band = F.size(F.filter(F.array(*[F.lit(x) for x in starts]), lambda x: x <= F.col("n_shingles"))) - 1
    counts = {r["band"]: r["count"] for r in sets.where("n_shingles > 0").groupBy(band.alias("band")).count().collect()}
    return starts, [allocation(b, starts, percent, counts.get(b, 0) + counts.get(b + 1, 0)) for b in range(len(starts) - 1)]


def certain_signer(sets: DataFrame, percent: int) -> Signer:
    """Signatures of which two linked sets share ``SHARED`` for certain."""
    starts, plan = band_plan(sets, percent)
    return lambda s: signatures(s, starts, plan, percent)


def similar_rows(docs: DataFrame, k: int = K, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its component, as ``linking.linked_components`` gives it."""
    sets = document_sets(docs, k, key, text)
    found = signatures_of_texts(docs, k, certain_signer(sets, percent), text)
    return linked_components(docs, sets, set_classes(sets), found, k, percent, key, text)


def similar_components(docs: DataFrame, k: int = K, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: the least id reachable by links, for every row."""
    return similar_rows(docs, k, percent, key, text).select(key, "n_shingles", "component_id")


def drop_near_copies(docs: DataFrame, k: int = K, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, and all rows without words."""
    return one_row_each(docs, similar_rows(docs, k, percent, key, text), key, text)
