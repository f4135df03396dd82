"""Toxicity scores of whole texts that see through disguised spelling.

A noisy channel explains disguised words: somebody meant plain letters, and the channel replaced some by
look-alikes, set them apart or repeated them. Each suspicious stretch of a text becomes a lattice of what its
characters may stand for, and Viterbi decoding picks the likeliest reading under a character trigram
model of the whole corpus. (Where a character has one reading only, the lattice has one path, so
other words are left as they are.) The restored text is then scored.

Evidence of a word is the largest log odds among it and its stems, learned from labelled
documents and shrunk where few support it; a stem is judged by the words that are not evidence
themselves. A document's strongest words go into a logistic model, fitted to evidence
from the other half of the training documents, so that chance finds do not count.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadlake.llm.common import cut, free_name, held_out, kept

#: Labelled documents the classifier is fitted on, the first by a hash of their id. A bound on purpose: more
#: hardly change the few weights, and it keeps the fit's cost fixed. All other statistics cover every document.
LABELLED = 20_000
#: Words and as many stems that the classifier keeps, and the toxic documents that must hold one.
GROUPS, SEEN = 50_000, 3
#: Evidence seen in this many documents is believed half; words of this evidence lend none to their stems.
BELIEF, STRONG = 10.0, 1.5
#: Letters in a stem.
STEMS = (3, 4, 5, 6, 7)
#: Words and stretches a worker remembers.
REMEMBERED = 700_000

# What look-alike characters may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y",
}
#: Costs in nats of a look-alike, of one more of a repeated letter, of a gap inside a word, and of
#: a character without a blank around it, or a blank between single characters, that ends a word. A look-alike that a word
#: begins with costs more to pass over, as it spares no letter.
REPLACED, REPEATED, APART, ENDED, PASSED = 1.5, 0.3, 0.2, 1.5, 6.0

#: Symbols of the language model: the gap between words, a to z, any other letter.
SYMBOLS = 28
_GAP, _OTHER = 0, 27
_LETTER = r"[^\W\d_]"
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
# One character that may be a letter, and such characters set apart.
_ATOM = "(?:[^\\W_]|[" + re.escape("".join(c for c in LOOKALIKES if not c.isalnum())) + "])"
_DOTTED = re.compile(rf"{_ATOM}(?:[.\-_*~]+{_ATOM}){{2,}}")
_RUN = re.compile(r"(" + _LETTER + r")\1\1")
_PAIR = re.compile(r"(" + _LETTER + r")\1")
_EDGE = ".,;:?\"'`()[]{}<>«»“”…-_*~#/\\"


def _symbol_table() -> np.ndarray:
    """Symbol of each code point of the first plane."""
    table = np.zeros(0x10000, np.uint8)
    for code in range(0xAA, 0x10000):
        if chr(code).isalpha():
            table[code] = _OTHER
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return table


_SYMBOL = _symbol_table()


def _symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _SYMBOL[np.minimum(codes, 0xFFFF)]


def _symbol(letter: str) -> int:
    return int(_SYMBOL[min(ord(letter), 0xFFFF)])


def _count_trigrams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                s = _symbols(f" {text.lower()} ").astype(np.int32)
                counts += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["trigram", "n"])


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities of a symbol after two others, counted over every text; at most 28^3 rows reach the driver."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    rows = texts.mapInArrow(_count_trigrams, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(SYMBOLS**3)
    for row in rows:
        counts[row.trigram] = row.n
    counts = counts.reshape((SYMBOLS,) * 3)
    one = (counts.sum((0, 1)) + 1) / (counts.sum() + SYMBOLS)
    two = counts.sum(0)
    two = (two + 10 * one) / (two.sum(1, keepdims=True) + 10)
    return np.log((counts + 10 * two[None]) / (counts.sum(2, keepdims=True) + 10))


def _readings(shown: str, joined: bool) -> list[list[tuple[str, float]]]:
    """Per character what it may stand for, with costs; a blank stands for the gap, nothing for no symbol."""
    lattice, before = [], ""
    for i, c in enumerate(shown):
        if c.isalpha():
            ways = [(c, 0.0)]
        else:
            leads = i == 0 and c in LOOKALIKES and any(x.isalpha() for x in shown)
            gap = PASSED if leads else ENDED if joined or c in LOOKALIKES else 0.0
            ways = [(" ", gap)] + [(x, REPLACED) for x in LOOKALIKES.get(c, "")]
        if c == before and (c.isalpha() or c in LOOKALIKES):
            ways.append(("", REPEATED))
        if joined and not c.isalnum() and c not in LOOKALIKES:
            ways.append(("", APART))
        elif not c.isspace():
            before = c
        lattice.append(ways)
    return lattice


def decode(shown: str, model: np.ndarray, joined: bool = False) -> str:
    """Likeliest plain reading of a stretch of lower-case text; ``joined`` if it may be one word set apart."""
    states = {(_GAP, _GAP): (0.0, None)}  # last two symbols: cost so far, and the path as a linked list
    for ways in _readings(shown, joined):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in states.items():
            for letter, price in ways:
                if letter == "":
                    state, total, way = (a, b), cost + price, path
                elif letter == " ":
                    if b == _GAP:
                        state, total, way = (a, b), cost + price, path
                    else:
                        state, total, way = (b, _GAP), cost + price - model[a, b, _GAP], (path, " ")
                else:
                    s = _symbol(letter)
                    state, total, way = (b, s), cost + price - model[a, b, s], (path, letter)
                if state not in after or total < after[state][0]:
                    after[state] = (total, way)
        states = after
    _, path = min(((c - (model[a, b, _GAP] if b != _GAP else 0.0), p) for (a, b), (c, p) in states.items()), key=lambda x: x[0])
    letters = []
    while path is not None:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters)).strip()


def suspicious(word: str) -> bool:
    """True for a lower-case word with a look-alike beside a letter, a long run, or mostly doubled letters."""
    if _RUN.search(word) or 3 * len(_PAIR.findall(word)) >= max(6, len(word)):
        return True
    return not word.isalpha() and any(c in LOOKALIKES for c in word) and any(c.isalpha() for c in word)


class Restorer:
    """Plain readings of words and stretches, remembered."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def word(self, word: str) -> str:
        """Reading of a lower-case word without blanks."""
        word = word.strip(_EDGE)
        if not word:
            return ""
        dotted = bool(_DOTTED.fullmatch(word))
        # A mark at the end of a sentence is no letter.
        bare = word if dotted else word.rstrip("!") or word
        if dotted or suspicious(bare):
            return decode(bare, self.model, joined=dotted)
        return bare

    def stretch(self, shown: str) -> str:
        """Reading of single characters with blanks between them."""
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if shown not in self.known:
            self.known[shown] = decode(shown, self.model, joined=True)
        return self.known[shown]

    def text(self, text: str) -> str:
        """A whole text in lower case with its disguised words restored."""
        lower = _SPACED.sub(lambda m: self.stretch(m[0]), text.lower())
        return re.sub(r"\S+", lambda m: self.word(m[0]) or m[0], lower)


_PARTS = re.compile(_LETTER + "+")


def words_of(reading: str) -> list[str]:
    """Words of a restored reading, their ends marked."""
    return [f"^{part}$" for part in _PARTS.findall(reading)]


def stems_of(word: str) -> list[str]:
    """Beginnings of a marked word."""
    return [word[: n + 1] for n in STEMS if n + 2 < len(word)]


class Evidence(dict):
    """Evidence of each word, worked out once and remembered."""

    def __init__(self, restorer: Restorer, weights: dict[str, float]):
        super().__init__()
        self.restorer, self.weights = restorer, weights

    def of_reading(self, reading: str) -> float:
        weight = self.weights.get
        return max((weight(g, 0.0) for w in words_of(reading) for g in (w, *stems_of(w))), default=0.0)

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self.of_reading(self.restorer.word(word))
        if value == 0 and _PAIR.search(word):
            # A letter too many: worth decoding where the word without it would be evidence.
            bare = word.strip(_EDGE)
            if self.of_reading(_PAIR.sub(r"\1", bare)) > 0:
                value = self.of_reading(decode(bare, self.restorer.model))
        self[word] = value
        return value

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Largest and second largest evidence of a text's distinct words, and the log of the sum."""
        lower = (text or "").lower()
        found = list(map(self.__getitem__, set(lower.split())))
        found += [self.of_reading(self.restorer.stretch(m)) for m in set(_SPACED.findall(lower))]
        found = sorted((e for e in found if e > 0), reverse=True)
        return (found[0] if found else 0.0, found[1] if len(found) > 1 else 0.0, math.log1p(sum(found)))


def _count_groups(batches: Iterable[pa.RecordBatch], model: np.ndarray, strong: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    """Documents of each half and label that hold a word, or given ``strong`` words, a stem of any other word.

    The group "" counts the documents themselves.
    """
    restorer, known = Restorer(model), {}
    counts: dict[tuple[int, int], Counter] = {(h, y): Counter() for h in (0, 1) for y in (0, 1)}

    def groups(reading: str) -> tuple[str, ...]:
        words = words_of(reading)
        return tuple(words if strong is None else {g for w in words if w not in strong for g in stems_of(w)})

    for batch in batches:
        for row in batch.to_pylist():
            lower, own = (row["text"] or "").lower(), {""}
            for word in set(lower.split()):
                if word not in known:
                    known[word] = groups(restorer.word(word))
                own.update(known[word])
            for stretch in set(_SPACED.findall(lower)):
                own.update(groups(restorer.stretch(stretch)))
            counts[row["half"], row["toxic"]].update(own)
    for (half, toxic), own in counts.items():
        names, n = list(own), list(own.values())
        for at in range(0, len(names), 100_000):
            some = pa.array(names[at : at + 100_000], pa.string())
            same = [pa.array([x] * len(some), pa.int32()) for x in (half, toxic)]
            yield pa.RecordBatch.from_arrays([some, *same, pa.array(n[at : at + 100_000], pa.int64())], ["grp", "half", "toxic", "n"])


def _group_table(rows: DataFrame, model: np.ndarray, strong: frozenset[str] | None) -> pd.DataFrame:
    """Counts of the groups that enough toxic documents hold; ``LABELLED`` documents bound them."""
    counted = rows.mapInArrow(partial(_count_groups, model=model, strong=strong), "grp string, half int, toxic int, n long")
    sums = counted.groupBy("grp").agg(*(
        F.sum(F.when((F.col("toxic") == y) & (F.col("half") == h), F.col("n")).otherwise(0)).alias(f"{name}{h}")
        for y, name in ((1, "toxic"), (0, "clean")) for h in (0, 1)
    ))
    return sums.where((F.col("toxic0") + F.col("toxic1") >= SEEN) | (F.col("grp") == "")).toPandas()


def _weights(counts: pd.DataFrame) -> dict[str, float]:
    """Shrunk log odds of words and stems from columns grp, clean and toxic; the group "" has the totals."""
    total = counts[counts["grp"] == ""]
    if total.empty or total["toxic"].iat[0] == 0:
        return {}
    rows = counts[(counts["grp"] != "") & (counts["toxic"] >= SEEN)]
    toxic, clean = rows["toxic"].to_numpy(float), rows["clean"].to_numpy(float)
    odds = np.log((toxic + 0.5) / (total["toxic"].iat[0] + 1)) - np.log((clean + 0.5) / (total["clean"].iat[0] + 1))
    worth = odds * toxic / (toxic + BELIEF)
    best = np.argsort(-worth, kind="stable")[:GROUPS]
    return {g: float(w) for g, w in zip(rows["grp"].to_numpy()[best], worth[best]) if w > 0}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic model, the constant last, by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w, keep = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fold_features(batches: Iterable[pd.DataFrame], model: np.ndarray, weights: list[dict[str, float]]) -> Iterator[pd.DataFrame]:
    """Features of training documents by the weights of the half they are not in."""
    evidence = [Evidence(Restorer(model), w) for w in weights]
    for pdf in batches:
        rows = [evidence[1 - half].features(text) for text, half in zip(pdf["text"], pdf["half"])]
        yield pd.DataFrame(rows, columns=["a", "b", "c"]).assign(toxic=pdf["toxic"].to_numpy())


class Model:
    """What scoring needs: the character model, the evidence of words and stems and the final weights."""

    def __init__(self, characters: np.ndarray, groups: dict[str, float], final: np.ndarray):
        self.characters, self.groups, self.final = characters, groups, final


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", limit: int = LABELLED) -> Model:
    """Character model of all ``docs``, classifier of the labelled ones that ``allowed``, a condition on ids, admits.

    ``labels`` has the id and ``toxic`` (1 or 0; others and nulls are ignored; of several labels of an id the larger counts).
    Without toxic examples every document is clean.
    """
    characters = language_model(docs, text_col)
    known = labels.where(F.col("toxic").isin(0, 1) & allowed).groupBy(F.col(id_col).alias("key")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where("key is not null").orderBy(F.xxhash64("key"), "key").limit(limit)
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    half = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(2)).cast("int").alias("half")
    # One text per id, so that ``limit`` bounds the rows as well; of several, the least by a hash.
    found = texts.join(F.broadcast(known), "key").groupBy("key").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"), F.first("toxic").alias("toxic")
    )
    rows = cut(found.select("x.text", "toxic", half))
    words = _group_table(rows, characters, None)
    both = lambda t: t.assign(toxic=t["toxic0"] + t["toxic1"], clean=t["clean0"] + t["clean1"])
    of_half = lambda t, h: t.assign(toxic=t[f"toxic{h}"], clean=t[f"clean{h}"])
    strong = frozenset(w for w, worth in _weights(both(words)).items() if worth >= STRONG)
    stems = _group_table(rows, characters, strong)
    weigh = lambda part: _weights(part(words)) | _weights(part(stems))
    groups = weigh(both)
    if not groups:
        return Model(characters, {}, np.array([0.0, 0.0, 0.0, -10.0]))
    send = docs.sparkSession.sparkContext.broadcast((characters, [weigh(lambda t: of_half(t, 0)), weigh(lambda t: of_half(t, 1))]))
    schema = "a double, b double, c double, toxic int"
    seen = rows.mapInPandas(lambda x: _fold_features(x, *send.value), schema).toPandas()  # at most ``limit`` rows
    return Model(characters, groups, _logistic(seen[["a", "b", "c"]].to_numpy(), seen["toxic"].to_numpy(float)))


def scored(spark: SparkSession, model: Model, text: Column) -> Column:
    """Score (0 to 1) of a whole text; a null text counts as empty."""
    send = spark.sparkContext.broadcast(model)
    name = hash((len(model.groups), model.final.tobytes()))

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        own = send.value
        evidence = kept(("evidence", name), lambda: Evidence(Restorer(own.characters), own.groups))
        x = np.array([(*evidence.features(t), 1.0) for t in texts]).reshape(-1, 4)
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ own.final, -30, 30))))

    return of(text)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` and ``predicted`` (1 from a score of 0.5 on) of every row.

    Ids, null and repeated ones too, are passed through.
    """
    rows = docs.select(F.col(id_col).alias("row_id"), scored(docs.sparkSession, model, F.col(text_col)).alias("score"))
    return rows.select(F.col("row_id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those whose score is 0.5 or more; same columns."""
    model = fit(docs, labels, ~held_out(F.col(id_col), folds, fold), id_col, text_col)
    name = free_name(docs, "score")
    return docs.withColumn(name, scored(docs.sparkSession, model, F.col(text_col))).where(F.col(name) < 0.5).drop(name)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all ``docs`` by a model that learned no label of the held-out fold; adds ``held_out``."""
    aside = held_out(F.col(id_col), folds, fold)
    scores = score(docs, fit(docs, labels, ~aside, id_col, text_col), id_col, text_col)
    return scores.select(id_col, aside.alias("held_out"), "score", "predicted")


def restore(docs: DataFrame, characters: np.ndarray, text_col: str = "text", out_col: str = "restored") -> DataFrame:
    """``docs`` with ``out_col``, the text in lower case with disguised words spelled out; null stays null."""
    send = docs.sparkSession.sparkContext.broadcast(characters)

    @F.pandas_udf("string")
    def restored(texts: pd.Series) -> pd.Series:
        own = Restorer(send.value)
        return pd.Series([None if t is None else own.text(t) for t in texts], dtype=object)

    return docs.withColumn(out_col, restored(text_col))
