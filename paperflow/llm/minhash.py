"""Near-duplicate documents by circulant MinHash: two permutations give all coordinates of a signature.

The universe is the circle of 2^32 places.  The first permutation deals shingles to places, the second gives each place a rank; coordinate j is the least
rank over a document's places shifted back by j, so the second permutation, moved around the circle, serves for every coordinate.
Coordinates are banded: ``rows`` neighbours make a signature, and documents that share one are compared exactly.

With 32 bands of 4 coordinates two sets of Jaccard index 0.85 share fewer than two signatures with probability 2e-9 (the binomial bound for
independent coordinates; shifted ones spread less), and sets of index 0.3 share one with probability 0.23.  One shared signature is enough however
many sets have it: the sets of a frequent one are dealt by the signatures of ``jaccard``, of which linked sets share some for certain.  All links
found are verified on the whole sets, so nothing is linked by chance.  Sets, names, stars, sketches and edge cases are those of ``linking``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import C3, mixed
from .jaccard import certain_signer
from .linking import components_sql, document_sets, linked_components, set_classes, signatures_of_classes

K, PERCENT = 5, 85
BANDS, ROWS = 32, 4
SKETCH_SLOTS = 4
CHUNK = 1024


def first_permutation(shingles: np.ndarray) -> np.ndarray:
    """Places on the circle of hashed shingles."""
    return (mixed(shingles ^ C3) >> np.uint64(32)).astype(np.uint32)


def second_permutation(x: np.ndarray) -> np.ndarray:
    """Ranks of places, in place: xor with a shift and multiplication by an odd number are each one-to-one."""
    with np.errstate(over="ignore"):
        for shift, odd in ((16, 0x7FEB352D), (15, 0x846CA68B)):
            x ^= x >> np.uint32(shift)
            x *= np.uint32(odd)
        x ^= x >> np.uint32(16)
    return x


def coordinates(shingles: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    """The signature of a set that is not empty."""
    places, back = first_permutation(shingles), np.arange(n, dtype=np.uint32)[:, None]
    out = np.full(n, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(places), CHUNK):
        np.minimum(out, second_permutation(places[None, i:i + CHUNK] - back).min(axis=1), out=out)
    return out


def band_signatures(shingles: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = coordinates(shingles, bands * rows).reshape(bands, rows).astype(np.uint64)
    out = np.arange(bands, dtype=np.uint64)
    for j in range(rows):
        out = mixed(out) + parts[:, j]
    return mixed(out)


def near_duplicates(docs: DataFrame, k: int = K, percent: int = PERCENT, key: str = "doc_id", text: str = "text",
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: the least id reachable by links, and whether it is the row's own."""
    sets = document_sets(docs, k, key, text, lambda s: band_signatures(s, bands, rows), SKETCH_SLOTS)
    classes = set_classes(sets)
    found = linked_components(docs, sets, classes, signatures_of_classes(classes), k, percent, key, text, lambda: certain_signer(sets, percent))
    return found.select(key, "n_shingles", "component_id", F.col(key).eqNullSafe(F.col("component_id")).alias("kept"))


SQL = components_sql(K, PERCENT, ", doc_id = component_id AS kept")
