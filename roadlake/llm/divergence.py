"""How the sources of a language differ in their words, by single-pass in-memory indexing.

Tasks read documents into a block: the terms of each document, by source. When the block is full it becomes a run:
postings sorted by term, dealt to shards by a hash of the term, cut into pages, and spilled to a table in the shared
folder. A shard's pages are read in the order of their first terms and merged through a heap; a term is
complete once the next page begins beyond it, so the heap holds about a page of each run. Many runs are merged
group by group first. Whole frequencies give shares in whole numbers.

Pairs of sources are compared over all terms without listing them: for two sources that lack a term its contribution is
a constant, and terms that one of them has are summed up from the histogram of its shares. What is left, terms that
both have, is a correction, streamed over the postings and summed up in bounded buffers.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlake.session import scratch_path

#: Runs of ASCII letters and of characters beyond ASCII.
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_CUT = re.compile("[\x00-\x40\x5b-\x60\x7b-\x7f]")
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Documents of a language that a kept term occurs in.
MIN_DOCS = 3
SHARE = 1_000_000_000
TOP_TERMS = 200
#: A block is full at so many occurrences or so many terms. Bounds of memory.
BLOCK_TOKENS, BLOCK_TERMS = 2_000_000, 400_000
#: Characters of a text that are cut into terms together.
AT_ONCE = 1_000_000
#: Terms of a page, and runs that are merged at once.
PAGE, FAN_IN = 256, 4096
#: Entries of pairs that are held before they are summed up, and sums that are held before they are handed on.
HELD = 1_000_000

_PAGES_DDL = (
    "run long, shard int, lang string, first string, terms array<string>, sizes array<int>, sources array<string>, "
    "counts array<long>, docs array<long>"
)
_PAGES = ["run", "shard", "lang", "first", "terms", "sizes", "sources", "counts", "docs"]
_POSTINGS_DDL = "lang string, term string, sources array<string>, counts array<long>"
#: Pages of an Arrow batch that a task hands on, and postings that come in before those that are complete are merged.
AT_A_TIME, GATHERED = 100, 200_000


class _Numbers(dict):
    """Numbers in the order in which things are first asked for."""

    def __missing__(self, thing: object) -> int:
        self[thing] = number = len(self)
        return number


class _Block:
    """Occurrences of terms, by document, until memory is full."""

    def __init__(self) -> None:
        self.written, self.groups = _Numbers(), _Numbers()
        self.ids, self.sizes, self.group = [], [], []
        self.tokens = 0

    def full(self) -> bool:
        return self.tokens >= BLOCK_TOKENS or len(self.written) >= BLOCK_TERMS

    def add(self, lang: str, source: str, text: str) -> None:
        size, at = 0, self.written.__getitem__
        for part in _parts(text):
            found = TERM.findall(part)
            self.ids.append(np.fromiter(map(at, found), np.int32, len(found)))
            size += len(found)
        self.sizes.append(size)
        self.group.append(self.groups[lang, source])
        self.tokens += size

    def pages(self, run: int, shards: int) -> Iterator[pa.RecordBatch]:
        """Term-sorted pages of every shard."""
        if not self.tokens:
            return
        small = pa.array([w.lower() if w.isascii() else w.translate(_SMALL) for w in self.written], pa.string()).dictionary_encode()
        terms, rank = _sorted(small)
        ranks = rank[np.concatenate(self.ids)].astype(np.int64)
        doc = np.repeat(np.arange(len(self.sizes), dtype=np.int64), self.sizes)
        per_doc, n = np.unique(doc * len(terms) + ranks, return_counts=True)
        del ranks, doc
        names, languages = list(self.groups), _Numbers()
        language = np.array([languages[lang] for lang, _ in names], dtype=np.int64)
        group, term = np.array(self.group, dtype=np.int64)[per_doc // len(terms)], per_doc % len(terms)
        shard_of = np.fromiter((zlib.crc32(t.encode()) % shards for t in terms.to_pylist()), np.int64, len(terms))
        order = np.lexsort((group, term, language[group], shard_of[term]))
        group, term, n = group[order], term[order], n[order]
        # One posting per shard, language, term and source; one entry per shard, language and term.
        new = np.flatnonzero(_changes(group) | _changes(term))
        counts, docs = np.add.reduceat(n, new), np.diff(np.append(new, len(n)))
        group, term = group[new], term[new]
        lang, shard = language[group], shard_of[term]
        heads = np.flatnonzero(_changes(term) | _changes(lang))
        yield from _paged(
            np.full(len(heads), run), shard[heads], pa.array(list(languages)).take(lang[heads]), terms.take(term[heads]),
            np.append(heads, len(term)), pa.array([source for _, source in names]).take(group), counts, docs,
            _changes(lang[heads]) | _changes(shard[heads]),
        )


def _changes(values: np.ndarray) -> np.ndarray:
    """Where an array differs from the value before."""
    return np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)


def _sorted(encoded: pa.DictionaryArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct strings in order, and the place of each value among them."""
    order = pc.sort_indices(encoded.dictionary)
    place = np.empty(len(order), dtype=np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return encoded.dictionary.take(order), place[encoded.indices.to_numpy()]


def _paged(
    run: np.ndarray, shard: np.ndarray, lang: pa.Array, terms: pa.Array, heads: np.ndarray,
    sources: pa.Array, counts: np.ndarray, docs: np.ndarray, begins: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """Entries as pages; ``heads`` has their first postings and the end, ``begins`` is true where a new page must begin."""
    index = np.arange(len(terms))
    since = index - np.maximum.accumulate(np.where(begins, index, 0))
    first = np.flatnonzero(since % PAGE == 0)
    entries, postings = np.append(first, len(terms)).astype(np.int32), heads[np.append(first, len(terms))].astype(np.int32)
    lists = lambda at, values: pa.ListArray.from_arrays(pa.array(at), values)
    batch = pa.RecordBatch.from_arrays([
        pa.array(run[first], pa.int64()), pa.array(shard[first], pa.int32()), lang.take(pa.array(first)), terms.take(pa.array(first)),
        lists(entries, terms), lists(entries, pa.array(np.diff(heads), pa.int32())), lists(postings, sources),
        lists(postings, pa.array(counts, pa.int64())), lists(postings, pa.array(docs, pa.int64())),
    ], _PAGES)
    for i in range(0, len(first), AT_A_TIME):
        yield batch.slice(i, AT_A_TIME)


def _parts(text: str) -> Iterator[str]:
    """A text in stretches that end between terms."""
    at = 0
    while at < len(text):
        end = at + AT_ONCE
        cut = _CUT.search(text, end) if end < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _runs(batches: Iterable[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a task's documents as pages of runs."""
    run, block = TaskContext.get().partitionId() << 32, _Block()
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            block.add(lang, source, text)
            if block.full():
                yield from block.pages(run, shards)
                run, block = run + 1, _Block()
    yield from block.pages(run, shards)


class _Page:
    """A page of which the terms from ``at`` on have not been merged yet."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.terms, sizes, self.sources, self.counts, self.docs = (batch.column(k)[i].values for k in range(4, 9))
        self.ends = np.concatenate([[0], np.cumsum(sizes.to_numpy())])
        self.at = 0

    def below(self, bound: str | None) -> int:
        """The first term that is not below the bound."""
        low, high = self.at, len(self.terms)
        while bound is not None and low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self.terms[middle].as_py() < bound else (low, middle)
        return high

    def take(self, to: int) -> tuple:
        """Terms up to ``to`` with their sizes and postings."""
        a, b, i, j = self.at, to, self.ends[self.at], self.ends[to]
        self.at = to
        return (self.terms[a:b], np.diff(self.ends[a : b + 1]), self.sources[i:j], self.counts[i:j].to_numpy(), self.docs[i:j].to_numpy())


class _Merged(NamedTuple):
    """Terms of a shard and language in order; ``heads`` has their first postings and the end."""

    run: int
    shard: int
    lang: str
    terms: pa.Array
    heads: np.ndarray
    sources: pa.Array
    counts: np.ndarray
    docs: np.ndarray


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[_Merged]:
    """Each term of a shard once, from pages in the order of their first terms.

    Open pages lie in a heap by their last terms. Terms below the first one of the page that comes next are complete: whole pages
    are taken off the heap, and from the others the part below.
    """
    heap: list[tuple[str, int, _Page]] = []
    place, number, gathered = None, 0, 0

    def complete(bound: str | None) -> Iterator[_Merged]:
        parts = []
        while heap and (bound is None or heap[0][0] < bound):
            page = heapq.heappop(heap)[2]
            parts.append(page.take(len(page.terms)))
        parts += [page.take(page.below(bound)) for _, _, page in heap]
        if any(len(p[0]) for p in parts):
            yield _Merged(*place, *_united(parts))

    for batch in batches:
        for i in range(batch.num_rows):
            run, shard, lang, first = (batch.column(k)[i].as_py() for k in range(4))
            if (run, shard, lang) != place:
                yield from complete(None)
                place, gathered = (run, shard, lang), 0
            elif gathered >= GATHERED:
                yield from complete(first)
                gathered = 0
            page = _Page(batch, i)
            number, gathered = number + 1, gathered + int(page.ends[-1])
            heapq.heappush(heap, (page.terms[-1].as_py(), number, page))
    yield from complete(None)


def _united(parts: list[tuple]) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Terms of several pages in order, with the postings of equal ones summed up by source."""
    terms, sizes, sources, counts, docs = zip(*parts)
    terms, place = _sorted(pa.concat_arrays(terms).dictionary_encode())
    sources = pa.concat_arrays(sources).dictionary_encode()
    key = np.repeat(place, np.concatenate(sizes)) * len(sources.dictionary) + sources.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(_changes(key))
    term, source = np.divmod(key[new], len(sources.dictionary))
    counts, docs = (np.add.reduceat(np.concatenate(x)[order], new) for x in (counts, docs))
    return terms, np.append(np.flatnonzero(_changes(term)), len(term)), sources.dictionary.take(source), counts, docs


def _merged_pages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a group as pages of one run."""
    for m in _merged(batches):
        n = len(m.terms)
        lang = pa.array([m.lang]).take(pa.array(np.zeros(n, np.int64)))
        yield from _paged(np.full(n, m.run), np.full(n, m.shard), lang, m.terms, m.heads, m.sources, m.counts, m.docs, np.arange(n) == 0)


def _frequencies(batches: Iterable[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Terms that enough documents have, with their count in each source."""
    for m in _merged(batches):
        kept = np.flatnonzero(np.add.reduceat(m.docs, m.heads[:-1]) >= min_docs)
        at = pa.array(m.heads.astype(np.int32))
        lists = [pa.ListArray.from_arrays(at, values).take(pa.array(kept)) for values in (m.sources, pa.array(m.counts, pa.int64()))]
        lang = pa.array([m.lang]).take(pa.array(np.zeros(len(kept), np.int64)))
        if len(kept):
            yield pa.RecordBatch.from_arrays([lang, m.terms.take(pa.array(kept)), *lists], ["lang", "term", "sources", "counts"])


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, shards: int | None = None) -> DataFrame:
    """``lang``, ``term`` and its ``sources`` and ``counts`` of every term that ``min_docs`` documents of a language have.

    ``docs`` has ``lang``, ``source`` and ``text`` without nulls; every row is a document. The result is read from a table.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = lambda label: scratch_path(spark, f"divergence-{label}")
    path = at("runs")
    docs.select("lang", "source", "text").mapInArrow(lambda x: _runs(x, shards), _PAGES_DDL).write.parquet(path)
    pages = spark.read.schema(_PAGES_DDL).parquet(path)
    runs = pages.agg(F.count_distinct("run")).first()[0]
    while runs > FAN_IN:
        runs = -(-runs // FAN_IN)
        grouped = pages.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(runs)))
        dealt = grouped.repartition("shard", "run").sortWithinPartitions("run", "shard", "lang", "first")
        dealt.mapInArrow(_merged_pages, _PAGES_DDL).write.parquet(path := at("runs"))
        pages = spark.read.schema(_PAGES_DDL).parquet(path)
    one = pages.withColumn("run", F.lit(0).cast("long")).repartitionById(shards, "shard")
    merged = one.sortWithinPartitions("run", "shard", "lang", "first").mapInArrow(lambda x: _frequencies(x, min_docs), _POSTINGS_DDL)
    merged.write.parquet(path := at("postings"))
    return spark.read.schema(_POSTINGS_DDL).parquet(path)


def _share(count: Column | str, total: str, terms: str) -> Column:
    """1 + floor(SHARE * (count + 1) / (total + terms)), exact at any size."""
    count = F.col(count) if isinstance(count, str) else count
    top = F.lit(SHARE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return (F.call_function("div", top, (F.col(total) + F.col(terms)).cast("decimal(20,0)")) + 1).cast("long")


def _gap(p: str, q: str) -> Column:
    """floor((p - q)^2 / q)."""
    apart = F.col(p) - F.col(q)
    return F.call_function("div", apart * apart, F.col(q))


def divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    shards: int | None = None,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: how far a source is from others of its language.

    Terms are those that ``min_docs`` documents of the language have; a term's share in a source or language is
    ``1 + floor(SHARE * (count + 1) / (total + terms))``, and the distance of shares p from q is ``floor((p - q)^2 / q)``. Part ``pair`` has
    each other source of the language, with the distances from its shares summed over all terms; part ``term`` the
    ``top_terms`` terms whose share is most above the language's. The greatest value has rank 1; ties go to the smaller item by UTF-8.

    Null languages, sources and texts are empty ones. Every row counts as a document, repeated ones too. Sources without a
    term take part; a source alone in its language has no pair, and no documents give no rows.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), empty(text_col).alias("text"))
    postings = frequencies(docs, min_docs, shards)
    pairs = F.explode(F.arrays_zip("sources", "counts"))
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    single = postings.select("lang", "term", total.alias("total"), F.size("sources").alias("n_sources"), pairs.alias("x")).select(
        "lang", "term", "total", "n_sources", F.col("x.sources").alias("source"), F.col("x.counts").alias("count")
    )
    groups = _groups(docs, postings, single)
    rated = single.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n_sources", "p0", _share("count", "n", "v").alias("p"), _share("total", "n_lang", "v").alias("q")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda part, df: df.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by_value).alias("rank")
    )
    terms = ranked("term", rated.where("p > q").select("lang", "source", F.col("term").alias("item"), _gap("p", "q").alias("value")))
    return ranked("pair", _pairs(groups, rated)).unionByName(terms.where(F.col("rank") <= top_terms))


def _groups(docs: DataFrame, postings: DataFrame, single: DataFrame) -> DataFrame:
    """Every source with the terms and totals of its language (``v``, ``n_lang``), its own total ``n`` and the share ``p0`` of an absent term."""
    sizes = single.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    languages = postings.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    known = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(languages, "lang", "left")
    filled = known.join(totals, "lang", "left").na.fill(0, ["n", "v", "n_lang"])
    groups = filled.withColumn("p0", F.when(F.col("v") > 0, _share(F.lit(0), "n", "v")))
    groups.write.parquet(path := scratch_path(docs.sparkSession, "divergence-groups"))
    return docs.sparkSession.read.schema(groups.schema).parquet(path)


def _pairs(groups: DataFrame, rated: DataFrame) -> DataFrame:
    """Sum of the distances of every source from each other one of its language."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    both = groups.select("lang", "source", "p0", "v").join(other, "lang").where("source <> item")
    absent = both.select("lang", "source", "item", F.coalesce(F.col("v") * _gap("p0", "q0"), F.lit(0)).alias("value"))
    # Shares that a source has, with how many terms: what changes where one of the two has a term.
    shares = rated.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("terms"))
    met = shares.join(other, "lang").where("source <> item")
    change = lambda now, before: F.col("terms") * (now - before)
    here = met.groupBy("lang", "source", "item").agg(F.sum(change(_gap("p", "q0"), _gap("p0", "q0"))).alias("value"))
    there = met.groupBy("lang", F.col("item").alias("source"), F.col("source").alias("item")).agg(
        F.sum(change(_gap("q0", "p"), _gap("q0", "p0"))).alias("value")
    )
    shared = rated.where("n_sources > 1").groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("x"))
    columns = shared.select("lang", "x.source", "x.p", "x.p0")
    corrected = columns.mapInArrow(_corrections, "lang string, source string, item string, value long")
    return (
        absent.unionByName(here).unionByName(there).unionByName(corrected)
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    )


class _Sums:
    """Whole-number sums by a pair of numbers, in sorted arrays."""

    def __init__(self) -> None:
        self.keys, self.values, self.held = [], [], 0

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys.append(keys)
        self.values.append(values)
        self.held += len(keys)

    def shrink(self) -> None:
        if self.held:
            keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
            sums = np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, at, np.concatenate(self.values))
            self.keys, self.values, self.held = [keys], [sums], len(keys)


def _corrections(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What terms that two sources share add to their distance beside what each has alone, summed up by pair."""
    names, sums = _Numbers(), _Sums()

    def flushed() -> Iterator[pa.RecordBatch]:
        nonlocal sums
        sums.shrink()
        if sums.held:
            known = list(names)
            a, b = np.divmod(sums.keys[0], 1 << 31)
            columns = [[known[i][0] for i in a], [known[i][1] for i in a], [known[i][1] for i in b], sums.values[0]]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["lang", "source", "item", "value"])
        sums = _Sums()

    for batch in batches:
        sizes = batch.column(1).value_lengths().to_numpy()
        languages = batch.column(0).to_pylist()
        starts = np.cumsum(np.concatenate([[0], sizes]))
        flat = [batch.column(k).flatten() for k in (1, 2, 3)]
        language_of = np.repeat(np.arange(len(languages)), sizes)
        names_of = flat[0].to_pylist()
        codes = np.fromiter((names[languages[i], s] for i, s in zip(language_of.tolist(), names_of)), np.int64, len(names_of))
        p, p0 = flat[1].to_numpy(), flat[2].to_numpy()
        for k in np.unique(sizes):
            rows = starts[:-1][sizes == k]
            # Slices of bounded size, whatever the number of sources of a term.
            step = max(1, HELD // (k * k))
            for low in range(0, len(rows), step):
                at = rows[low : low + step, None] + np.arange(k)
                for i in range(0, k, max(1, HELD // k)):
                    mine = at[:, i : i + max(1, HELD // k)]
                    value = _gaps(p, p, mine, at) - _gaps(p, p0, mine, at) - _gaps(p0, p, mine, at) + _gaps(p0, p0, mine, at)
                    key = (codes[mine][:, :, None] << 31) | codes[at][:, None, :]
                    apart = codes[mine][:, :, None] != codes[at][:, None, :]
                    sums.add(key[apart], value[apart])
                    if sums.held > 2 * HELD:
                        sums.shrink()
                        if sums.held > HELD:
                            yield from flushed()
    yield from flushed()


def _gaps(p: np.ndarray, q: np.ndarray, mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    apart = p[mine][:, :, None] - q[other][:, None, :]
    return apart * apart // q[other][:, None, :]
