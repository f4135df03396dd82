"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact confirmation.

Documents with equal shingle sets form a class and are represented by their smallest id. Signatures of the
representatives are cut into bands; representatives that agree in a band share a bucket. Pairs within buckets are
compared signature batch by signature batch and dropped as soon as the posterior chance that their similarity
reaches the threshold falls below the chosen miss probability; what survives is confirmed on the
full shingle sets.

Buckets are worked off without listing all their pairs. First each member is paired with its bucket's
smallest id; the confirmed links join most members of a group of copies. Only buckets whose members then still
belong to different components are compared pair by pair, across components, in tiles of bounded size that hold the
texts, so that no pair leaves its task before it is confirmed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from roadlake.llm.common import components, cut, free_name
from roadlake.llm.encoding import runs

#: Words in a shingle.
WORDS = 5
#: Values of a signature, the most of them in a band, and the chance with which a pair at the threshold may share no band.
HASHES, ROWS, UNSEEN = 125, 5, 1e-6
#: Signature values compared at a time, and the posterior chance at which a pair is dropped.
BATCH, MISS = 25, 1e-7
#: Members of a bucket compared in one task with those of another such tile, on average.
TILE = 1024
#: Shingles of the members of a tile, on average at most.
TILE_SHINGLES = 1_000_000
#: Pairs of one document confirmed in one group.
CONFIRM = 64
#: Ids that are broadcast at most (8 bytes each); more are joined by a shuffle.
SMALL = 1_000_000
#: Characters of the texts hashed together.
AT_ONCE = 1_000_000

_draw = np.random.default_rng(20240607)
_PLACES = _draw.integers(1, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
_TIMES = _draw.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_PLUS = _draw.integers(0, 2**63, HASHES, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each whole text.

    A-Z are lower-cased, words end at ASCII blanks; fewer words than a shingle are one shingle, none are no shingle.
    """
    for a, b in runs([len(t or "") for t in texts], AT_ONCE):
        words = [(t or "").encode().lower().split() for t in texts[a:b]]
        counts = [len(w) for w in words]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, sum(counts))
        rolled = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
        for i in range(WORDS):
            rolled += hashes[i : i + len(rolled)] * _PLACES[i]
        rolled = _mixed(rolled)
        at = 0
        for n in counts:
            if n >= WORDS:
                own = np.sort(rolled[at : at + n - WORDS + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif n:
                yield _mixed((hashes[at : at + n] * _PLACES[:n]).sum(keepdims=True) + np.uint64(n))
            else:
                yield np.empty(0, np.uint64)
            at += n


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values; 32 bits of each, as more are not needed to tell them apart."""
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 1024):  # small enough to stay in a cache
        np.minimum(least, (hashes[at : at + 1024, None] * _TIMES + _PLUS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def least_matches(threshold: float, compared: int, miss: float) -> int:
    """Fewest equal values among ``compared`` with which the similarity may still reach ``threshold``.

    With a flat prior the similarity after m matches of n follows Beta(m + 1, n - m + 1), and its chance of
    reaching t is that of at most m successes in n + 1 draws with chance t.
    """
    chance = 0.0
    for m in range(compared + 1):
        chance += math.comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if chance >= miss:
            return m
    return compared


def surviving(left: np.ndarray, right: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Indices of the pairs of signatures (row by row) that no batch of values rules out."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for at in range(0, HASHES, BATCH):
        columns = slice(at, at + BATCH)
        matches = matches + (left[alive, columns] == right[alive, columns]).sum(axis=1)
        stays = matches >= least_matches(threshold, at + BATCH, miss)
        alive, matches = alive[stays], matches[stays]
    return alive


def _signatures(column: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u4").reshape(-1, HASHES)


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, signatures = [], [], []
        for own in shingle_sets(batch.column(1).to_pylist()):
            sizes.append(len(own))
            digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
            signatures.append(signature(own).tobytes() if len(own) else None)
        columns = pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_shingles", "digest", "sig"])


def _prune(batches: Iterable[pa.RecordBatch], threshold: float, miss: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sigs = [_signatures(batch.column(name).to_pylist()) for name in ("sig_u", "sig_v")]
            yield batch.select(["u", "v"]).take(pa.array(surviving(*sigs, threshold, miss)))


def layout(percent: int) -> tuple[int, int]:
    """Number of bands and their length: the longest bands of which a pair at the threshold shares one almost surely.

    At 0.85, 25 bands of 5 miss a pair with probability (1 - 0.85^5)^25 = 4e-7; at 0.8, 31 of 4 miss (1 - 0.8^4)^31 = 8e-8.
    """
    fits = [r for r in range(1, ROWS + 1) if (1 - (percent / 100) ** r) ** (HASHES // r) <= UNSEEN]
    rows = max(fits, default=1)
    return HASHES // rows, rows


def first_shared_band(left: np.ndarray, right: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """First band in which pairs of signatures agree, row by row; 0 also where none does."""
    return (left == right)[:, : bands * rows].reshape(-1, bands, rows).all(axis=2).argmax(axis=1)


def _tile_links(rows: pd.DataFrame, percent: int, miss: float) -> pd.DataFrame:
    """Links between two tiles of a bucket that join different components; a forest of them.

    A pair is looked at in the first bucket that it shares only.
    """
    rows = rows.sort_values("id", ignore_index=True)
    ids, group, sizes, first = (rows[c].to_numpy().copy() for c in ("id", "component", "n_shingles", "tile"))
    sigs, sets = _signatures(rows["sig"]), list(shingle_sets(rows["text"].tolist()))
    hub, band, a, b = (rows[c].iat[0] for c in ("hub", "band", "a", "b"))
    links = []
    for i in np.flatnonzero(first == a):
        if ids[i] == hub:  # compared before
            continue
        j = np.flatnonzero((first == b) & (group != group[i]) & (ids != hub))
        if a == b:
            j = j[j > i]
        # Neither set can share more than its own size.
        j = j[100 * np.minimum(sizes[j], sizes[i]) >= percent * np.maximum(sizes[j], sizes[i])]
        same = np.broadcast_to(sigs[i], (len(j), HASHES))
        j = j[first_shared_band(same, sigs[j], *layout(percent)) == band]
        j = j[surviving(same[: len(j)], sigs[j], percent / 100, miss)]
        while len(j):
            some, j = j[:CONFIRM], j[CONFIRM:]
            linked = some[similar(sets[i], [sets[k] for k in some], percent)]
            others, at = np.unique(group[linked], return_index=True)
            links += [(ids[i], ids[linked[k]]) for k in at]
            group[np.isin(group, others)] = group[i]
            j = j[group[j] != group[i]]
    return pd.DataFrame(links, columns=["u", "v"], dtype="int64")


def similar(own: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """For each other set whether it shares ``percent`` hundredths of the union with one set."""
    sizes = np.array([len(x) for x in others])
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
    common = np.add.reduceat((own[at] == joined).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * common >= percent * (len(own) + sizes - common)


def _confirm(hubs: pd.DataFrame, members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    if hubs.empty or members.empty:
        return pd.DataFrame({"u": pd.Series(dtype="int64"), "v": pd.Series(dtype="int64")})
    (own,) = shingle_sets([hubs["hub_text"].iat[0]])
    return members.loc[similar(own, list(shingle_sets(members["text"].tolist())), percent), ["u", "v"]]


def _limited(ids: DataFrame) -> DataFrame:
    """A table of ids, to be broadcast if it is small."""
    ids = cut(ids)
    return F.broadcast(ids) if ids.count() <= SMALL else ids


def _texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """``id`` and ``text`` of some ids, once each."""
    return texts.join(_limited(ids.distinct()), "id", "left_semi").dropDuplicates(["id"])


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (u, v) that are links; ``texts`` has ``id`` and ``text``. Written and read again."""
    texts = _texts_of(pairs.select(F.explode(F.array("u", "v")).alias("id")), texts)
    chunks = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / CONFIRM).alias("chunks"))
    dealt = pairs.join(chunks, "u").select("u", "v", F.pmod(F.xxhash64("v"), "chunks").alias("chunk"))
    members = dealt.join(texts.withColumnRenamed("id", "v"), "v")
    hubs = chunks.select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    hubs = hubs.join(texts.withColumnRenamed("id", "u"), "u")
    hubs = hubs.select(F.col("u").alias("hub"), F.col("chunk").alias("part"), F.col("text").alias("hub_text"))
    return cut(
        hubs.groupBy("hub", "part").cogroup(members.groupBy("u", "chunk"))
        .applyInPandas(lambda a, b: _confirm(a, b, percent), "u long, v long")
    )


def near_duplicates(
    docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", miss: float = MISS, tile: int = TILE
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` and ``kept``.

    Documents link when their sets of five-word shingles share at least ``percent`` hundredths of their union; ids are
    longs. Texts without a word, null ones too, link with nothing. Rows without an id link with nothing and
    have neither component nor ``kept``. Rows that repeat an id are one document and are answered each.
    """
    threshold = percent / 100
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = cut(texts.mapInArrow(_described, "id long, n_shingles long, digest binary, sig binary"))
    usable = described.where("digest is not null and id is not null")
    classes = cut(
        usable.groupBy("digest").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    )
    n_bands, n_rows = layout(percent)
    bands = classes.select("id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(n_bands - 1)),
        lambda b: F.xxhash64(b, F.substring("sig", b * (4 * n_rows) + 1, F.lit(4 * n_rows))),
    )).alias("band", "bucket"))
    shared = bands.groupBy("band", "bucket").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(bands.join(shared, ["band", "bucket"]).select("band", "bucket", "hub", "n", "id"))

    sigs = classes.select("id", "sig")
    pairs = members.where("id <> hub").select(F.col("hub").alias("u"), F.col("id").alias("v")).distinct()
    pairs = pairs.join(sigs.toDF("u", "sig_u"), "u").join(sigs.toDF("v", "sig_v"), "v")
    links = confirmed(cut(pairs.mapInArrow(lambda x: _prune(x, threshold, miss), "u long, v long")), texts, percent)

    # Buckets whose members the links to the hub have not joined yet.
    groups = cut(components(links)).toDF("id", "component")
    placed = members.where("n > 2").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = cut(placed.join(classes.select("id", "n_shingles"), "id"))
    amount = F.greatest(F.count(F.lit(1)) / tile, F.sum("n_shingles") / TILE_SHINGLES)
    mixed = placed.groupBy("band", "bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(amount).alias("tiles")
    )
    rest = placed.join(mixed.where("low < high").drop("low", "high"), ["band", "bucket"])
    rest = rest.join(sigs, "id").join(_texts_of(rest.select("id"), texts), "id")
    rest = rest.withColumn("tile", F.pmod(F.xxhash64("id"), "tiles"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rest = rest.withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")})
    found = rest.groupBy("band", "bucket", "a", "b").applyInPandas(lambda x: _tile_links(x, percent, miss), "u long, v long")
    links = cut(links.union(found))
    groups = components(links).toDF("id", "component")
    ends = classes.select("digest", "id").join(groups, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    has = described.select("id", "n_shingles", "digest").where("digest is not null").join(ends, "digest", "left")
    has = has.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))
    none = described.where("digest is null").select("id", "n_shingles", F.col("id").alias("component"))
    return has.union(none).select(
        F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; same columns.

    Of rows that repeat an id one stays; rows without an id all stay.
    """
    answer = near_duplicates(docs, percent, id_col, text_col).where(F.col(id_col).isNotNull())
    key = free_name(docs, "seen_id")
    ids = cut(answer.groupBy(F.col(id_col).alias(key)).agg(F.min("kept").alias("stays"), F.count(F.lit(1)).alias("n")))
    same = F.col(id_col).cast("long") == F.col(key)
    single = docs.join(ids.where("not stays or n > 1").select(key), same, "left_anti")
    repeated = docs.join(ids.where("stays and n > 1").select(key), same, "left_semi").dropDuplicates([id_col])
    return single.unionByName(repeated)
