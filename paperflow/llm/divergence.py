"""Which sources of a language use other words than the rest: an audit by in-mapper stripes.

Each partition folds whole documents into stripes, one hash entry per language and term with the term's document frequency and a
hash of occurrences by source.  A full table of stripes is spilled as rows and begun anew; stripes of one term are merged by key.  Merged
stripes of terms in at least ``min_docs`` documents of their language are kept and emit the divergences directly.

All arithmetic is on whole numbers.  A group's share of a term is ``p = 1 + floor(10^9 (count + 1) / (N + V))``, where ``N`` counts
the group's occurrences of kept terms and ``V`` the kept terms of the language; the divergence of p from q is ``floor((p - q)^2 / q)``.
Every source of a language is compared with each other one over all kept terms (part ``pair``), and with the whole language by
those terms that it uses more than the language does (part ``term``, the ``top`` largest).  A term that neither of two sources has adds the
same to their sum, so the sum starts there and only terms that occur are visited, pairs of sources only where both have the term.

Null text, language and source count as empty.  A group without terms is compared like any other; a language without kept terms has
pairs of value 0.  Repeated rows and ids are documents of their own.  Ties go by the item's bytes.  An empty table gives no rows.
Other columns are not read.  A task holds one number for each pair of sources of the languages in its share, as many as ``pair`` has rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, raw, staged

MIN_DOCS = 3
TOP = 200
SCALE = 10**9
ENTRIES = 400_000
"""(term, source) entries that a task holds before it spills."""
CELLS = 4_000_000
"""Pair sums that a task holds before it sends them on, and products it makes at a time."""
STRIPES = "lang string, term binary, df long, sources array<string>, counts array<long>"
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of letters and non-ASCII characters, A-Z in lower case."""
    return text.translate(LETTERS).split()


def _stripe_batch(langs: list, names: list, dfs: list, sizes: list, sources: list, counts: list) -> pa.RecordBatch:
    at = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array(langs, pa.string()), pa.array(names, pa.binary()), pa.array(dfs, pa.int64()),
        pa.ListArray.from_arrays(at, pa.array(sources, pa.string())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))],
        names=["lang", "term", "df", "sources", "counts"])


def _spilled(held: dict[str, dict[bytes, tuple]], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    for lang, stripes in held.items():
        items = list(stripes.items())
        for i in range(0, len(items), rows):
            part = items[i:i + rows]
            yield _stripe_batch([lang] * len(part), [t for t, _ in part], [s[0] for _, s in part], [len(s[1]) for _, s in part],
                                [k for _, s in part for k in s[1]], [n for _, s in part for n in s[1].values()])


def partial_stripes(docs: DataFrame, text: str, lang: str, source: str, entries: int = ENTRIES) -> DataFrame:
    """Stripes of whole documents, one or more rows for each partition and term."""
    rows = docs.select(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source"), raw(text).alias("body"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, list]] = {}
        size = 0
        for batch in batches:
            for name, site, body in zip(*(c.to_pylist() for c in batch.columns)):
                stripes = held.setdefault(name, {})
                for term, n in Counter(terms(body)).items():
                    stripe = stripes.get(term)
                    if stripe is None:
                        stripes[term] = [1, {site: n}]
                        size += 1
                        continue
                    stripe[0] += 1
                    by_site = stripe[1]
                    if site in by_site:
                        by_site[site] += n
                    else:
                        by_site[site] = n
                        size += 1
                if size > entries:
                    yield from _spilled(held)
                    held, size = {}, 0
        yield from _spilled(held)

    return in_batches(rows, fold, STRIPES)


def _merged_run(table: pa.Table, min_docs: int) -> pa.RecordBatch | None:
    """Sums of equal neighbours of a sorted table; None if no term is frequent enough."""
    lang, term = table["lang"].combine_chunks(), table["term"].combine_chunks()
    begins = np.ones(len(table), bool)
    begins[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    group = np.cumsum(begins) - 1
    at = np.flatnonzero(begins)
    df = np.add.reduceat(table["df"].to_numpy(), at)
    lists, numbers = table["sources"].combine_chunks(), table["counts"].combine_chunks()
    code = lists.flatten().dictionary_encode()
    names, codes = code.dictionary, code.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    cell = group[pc.list_parent_indices(lists).to_numpy()] * len(names) + codes
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    counts = np.add.reduceat(numbers.flatten().to_numpy()[order], first)
    owner, place = cell[first] // len(names), cell[first] % len(names)
    kept = df >= min_docs
    if not kept.any():
        return None
    used = kept[owner]
    sizes = np.bincount(owner[used], minlength=len(at))[kept]
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    rows = pa.array(at[kept])
    return pa.RecordBatch.from_arrays([
        lang.take(rows), term.take(rows), pa.array(df[kept]), pa.ListArray.from_arrays(ends, names.take(pa.array(place[used]))),
        pa.ListArray.from_arrays(ends, pa.array(counts[used]))], names=["lang", "term", "df", "sources", "counts"])


def merged_stripes(partial: DataFrame, min_docs: int) -> DataFrame:
    """One row per kept term of a language.  Rows of a key are streamed in order; the sums of its sources are all that is held of it."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            same = pc.and_(pc.equal(table["lang"], table["lang"][-1]), pc.equal(table["term"], table["term"][-1]))
            cut = int(np.argmax(same.to_numpy(zero_copy_only=False)))
            if cut:
                found = _merged_run(table.slice(0, cut), min_docs)
                if found is not None:
                    yield found
            rest = pa.Table.from_batches([_merged_run(table.slice(cut), 0)])
        if rest is not None:
            found = _merged_run(rest, min_docs)
            if found is not None:
                yield found

    ordered = partial.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return staged(ordered.mapInArrow(merge, STRIPES), "stripes")


def language_totals(docs: DataFrame, stripes: DataFrame, lang: str, source: str) -> DataFrame:
    """``lang, v, names, totals``: kept terms of a language, its sources in byte order and their occurrences of kept terms."""
    groups = docs.select(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source")).distinct()
    used = stripes.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e")).groupBy("lang", F.col("e.sources").alias("source")).agg(
        F.sum("e.counts").alias("n"))
    kept = stripes.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    by_lang = groups.join(used, ["lang", "source"], "left").groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n")))).alias("g"))
    return staged(by_lang.join(kept, "lang", "left").select(
        "lang", F.coalesce("v", F.lit(0)).alias("v"), F.col("g.source").alias("names"), F.col("g.n").alias("totals")), "language-totals")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(10^9 (count + 1) / total)``, three digits at a time, so that counts up to 9 * 10^15 stay exact."""
    rest, out = count + 1, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class PairSums:
    """For the sources of a language, what terms that occur add to their sums beyond a term that both sources lack."""

    def __init__(self, totals: np.ndarray, v: int):
        self.size, self.total = len(totals), totals + v
        self.base = share(np.zeros_like(totals), self.total)
        self.sums = np.zeros((self.size, self.size), np.int64)

    def add(self, row: np.ndarray, site: np.ndarray, p: np.ndarray, count: np.ndarray) -> None:
        """Entries ordered by row (a term): source and share."""
        self._against_base(site, count)
        _, at, held = np.unique(row, return_index=True, return_counts=True)
        begin, others = np.repeat(at, held), np.repeat(held, held)
        step = max(1, CELLS // max(1, int(held.max(initial=1))))
        for i in range(0, len(row), step):
            n = others[i:i + step]
            left = np.repeat(np.arange(i, i + len(n)), n)
            right = np.repeat(begin[i:i + step] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            g, h = site[left], site[right]
            far = apart(p[left], p[right]) - apart(p[left], self.base[h]) - apart(self.base[g], p[right]) + apart(self.base[g], self.base[h])
            np.add.at(self.sums, (g, h), far)

    def _against_base(self, site: np.ndarray, count: np.ndarray) -> None:
        """As though no other source had the term: once for each different count of a source."""
        pairs, times = np.unique(np.stack([site, count]), axis=1, return_counts=True)
        step = max(1, CELLS // self.size)
        for i in range(0, len(times), step):
            g, c, n = pairs[0, i:i + step], pairs[1, i:i + step], times[i:i + step, None]
            p, own = share(c, self.total[g])[:, None], self.base[g][:, None]
            np.add.at(self.sums, g, n * (apart(p, self.base) - apart(own, self.base)))
            np.add.at(self.sums.T, g, n * (apart(self.base, p) - apart(self.base, own)))


def stripe_divergences(stripes: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, part, g, h, item, value``: of part ``pair`` sums by places of two sources, of part ``term`` the place of a source and the term."""
    met = stripes.select("lang", "term", "sources", "counts").join(totals, "lang")
    schema = "lang string, part string, g int, h int, item string, value long"

    def batch_of(lang: str, part: str, g, h, item, value) -> pa.RecordBatch:
        n = len(value)
        return pa.RecordBatch.from_arrays([
            pa.array([lang] * n, pa.string()), pa.array([part] * n, pa.string()), pa.array(g, pa.int32()),
            pa.nulls(n, pa.int32()) if h is None else pa.array(h, pa.int32()), pa.nulls(n, pa.string()) if item is None else item, pa.array(value, pa.int64())],
            names=["lang", "part", "g", "h", "item", "value"])

    def sums(held: dict[str, PairSums]) -> Iterator[pa.RecordBatch]:
        for lang, pairs in held.items():
            np.fill_diagonal(pairs.sums, 0)
            g, h = np.nonzero(pairs.sums)
            for i in range(0, len(g), 100_000):
                part = slice(i, i + 100_000)
                yield batch_of(lang, "pair", g[part], h[part], None, pairs.sums[g[part], h[part]])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, PairSums] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            edges = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1]), len(langs)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                part, lang = batch.slice(a, b - a), langs[a]
                names, n = part.column("names")[0].values, part.column("totals")[0].values.to_numpy()
                v = part.column("v")[0].as_py()
                if lang not in held:
                    held[lang] = PairSums(n, v)
                lists = part.column("sources")
                row = pc.list_parent_indices(lists).to_numpy()
                site = pc.index_in(lists.flatten(), names).to_numpy()
                count = part.column("counts").flatten().to_numpy()
                p = share(count, (n + v)[site])
                whole = np.add.reduceat(count, np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])))
                q = share(whole, np.full_like(whole, int(n.sum()) + v))[row]
                above = p > q
                if above.any():
                    yield batch_of(lang, "term", site[above], None, part.column("term").take(pa.array(row[above])).cast(pa.string()), apart(p[above], q[above]))
                held[lang].add(row, site, p, count)
            if sum(pairs.size**2 for pairs in held.values()) > CELLS:
                yield from sums(held)
                held = {}
        yield from sums(held)

    return in_batches(met, emit, schema)


def _thousandths(total: Column) -> Column:
    """The share of a term that a group lacks."""
    out, rest = F.lit(0).cast("long"), F.lit(1).cast("long")
    for _ in range(3):
        rest = rest * 1000
        left = F.pmod(rest, total)
        out, rest = out * 1000 + F.round((rest - left) / total).cast("long"), left
    return out + 1


def source_divergences(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                       min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``."""
    stripes = merged_stripes(partial_stripes(docs, text, lang, source), min_docs)
    totals = language_totals(docs, stripes, lang, source)
    found = staged(stripe_divergences(stripes, totals), "divergences")
    sums = found.where("part = 'pair'").groupBy("lang", "g", "h").agg(F.sum("value").alias("sum"))
    one = totals.select("lang", "v", "names", "totals", F.posexplode("names").alias("g", "source"))
    both = one.select("lang", "v", "g", "source", (F.get("totals", F.col("g")) + F.col("v")).alias("own"), "totals", F.posexplode("names").alias("h", "item")).where("g <> h")
    p, q = (_thousandths(F.greatest(c, F.lit(1))) for c in (F.col("own"), F.get("totals", F.col("h")) + F.col("v")))
    lacked = F.col("v") * F.expr("(p - q) * (p - q) div q")
    pairs = both.withColumn("p", p).withColumn("q", q).join(sums, ["lang", "g", "h"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.when(F.col("v") == 0, F.lit(0)).otherwise(lacked + F.coalesce("sum", F.lit(0))).alias("value"))
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = found.where("part = 'term'").withColumn("rank", F.row_number().over(Window.partitionBy("lang", "g").orderBy(F.desc("value"), "item"))).where(F.col("rank") <= top)
    names = one.select("lang", "g", "source")
    used = ranked.join(names, ["lang", "g"]).select("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("rank", F.row_number().over(place)).unionByName(used)


SQL = f"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT lang, source, r, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {MIN_DOCS}),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, sum(n)::BIGINT AS n FROM c GROUP BY ALL),
f AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + ({SCALE} * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0) + v.v) AS p,
         1 + ({SCALE} * (kept.n + 1)) // (v.n + v.v) AS q
  FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
x AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM f WHERE n > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM k WHERE part = 'pair' OR rank <= {TOP}
"""
