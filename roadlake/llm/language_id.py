"""Language of whole texts by a bidirectional recurrent network over bytes.

Two gated recurrent units read the bytes of a window, one from each end; at every byte their states give a
probability per language, and a document's probabilities are the means over its letter bytes. Texts
are cut into windows, so that a long text is many short rows of one matrix and its memory is bounded; every byte is
read. The network is trained on the driver, in numpy, by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlake.llm.common import held_out
from roadlake.llm.encoding import runs

#: Bytes in a window, and units of each direction.
WINDOW, UNITS = 64, 8
#: Documents trained on, the first by a hash of their id, and windows of each. A bound on purpose: it keeps training at a fixed cost.
TRAINED, WINDOWS = 2_000, 8
#: Passes over the windows, windows in a step, and the first step size.
PASSES, STEP, RATE = 4, 128, 0.01
#: Windows read at once, and characters of the texts taken together.
ROWS, AT_ONCE = 1024, 1_000_000
#: Answer for texts without a letter.
UNDETERMINED = "und"

_BLANK = 0x20
#: Bytes of letters: a to z, and those of characters beyond ASCII.
_IS_LETTER = np.array([0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


@dataclass
class Network:
    """Weights. Each direction has per byte the input to its three gates, and what its own state adds to them."""

    languages: list[str]
    forward: tuple[np.ndarray, np.ndarray]
    backward: tuple[np.ndarray, np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [*self.forward, *self.backward, self.out, self.bias]


def new_network(languages: list[str], units: int = UNITS, seed: int = 7) -> Network:
    draw = np.random.default_rng(seed)
    direction = lambda: (
        draw.normal(0, 0.3, (256, 3 * units)).astype(np.float32),
        (draw.normal(0, 1, (units, 3 * units)) / np.sqrt(units)).astype(np.float32),
    )
    out = draw.normal(0, 0.3, (2 * units, len(languages))).astype(np.float32)
    return Network(languages, direction(), direction(), out, np.zeros(len(languages), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(windows: np.ndarray, weights: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, list]:
    """States after each byte (time, row, unit), and what backpropagation needs."""
    table, state_to = weights
    units = len(state_to)
    h, states, kept = np.zeros((windows.shape[1], units), np.float32), [], []
    for column in windows:
        x, s = table[column], h @ state_to
        gates = _sigmoid(x[:, : 2 * units] + s[:, : 2 * units])
        r, z = gates[:, :units], gates[:, units:]
        n = np.tanh(x[:, 2 * units :] + r * s[:, 2 * units :])
        kept.append((h, r, z, n, s[:, 2 * units :]))
        h = n + z * (h - n)
        states.append(h)
    return np.stack(states), kept


def _read_back(windows: np.ndarray, weights: tuple[np.ndarray, np.ndarray], kept: list, d_states: np.ndarray) -> list[np.ndarray]:
    """Gradients of one direction's weights."""
    table, state_to = weights
    units = len(state_to)
    d_table, d_state_to = np.zeros_like(table), np.zeros_like(state_to)
    d_h = np.zeros_like(d_states[0])
    for t in range(len(windows) - 1, -1, -1):
        h, r, z, n, s = kept[t]
        d_h = d_h + d_states[t]
        d_n = d_h * (1 - z) * (1 - n * n)
        d_z = d_h * (h - n) * z * (1 - z)
        d_r = d_n * s * r * (1 - r)
        d_x = np.concatenate([d_r, d_z, d_n], axis=1)
        d_s = np.concatenate([d_r, d_z, d_n * r], axis=1)
        np.add.at(d_table, windows[t], d_x)
        d_state_to += h.T @ d_s
        d_h = d_h * z + d_s @ state_to.T
    return [d_table, d_state_to]


def gradients(network: Network, windows: np.ndarray, truth: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over the letter bytes of windows (time, row) and its gradients."""
    ahead, kept_ahead = _read(windows, network.forward)
    behind, kept_behind = _read(windows[::-1], network.backward)
    states = np.concatenate([ahead, behind[::-1]], axis=2)
    logits = states @ network.out + network.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    letters = _IS_LETTER[windows].astype(np.float32)
    letters /= max(1.0, letters.sum())
    rows = np.arange(windows.shape[1])
    loss = -float((np.log(p[:, rows, truth] + 1e-12) * letters).sum())
    p[:, rows, truth] -= 1
    p *= letters[:, :, None]
    d_out = np.tensordot(states, p, ((0, 1), (0, 1)))
    d_states = p @ network.out.T
    units = network.out.shape[0] // 2
    first = _read_back(windows, network.forward, kept_ahead, d_states[:, :, :units])
    second = _read_back(windows[::-1], network.backward, kept_behind, d_states[::-1, :, units:])
    return loss, [*first, *second, d_out, p.sum((0, 1))]


def train(windows: np.ndarray, truth: np.ndarray, languages: list[str], passes: int = PASSES, seed: int = 7) -> Network:
    """Network fitted to windows (row, time) of bytes and the index of their language, with Adam."""
    network, draw = new_network(languages, seed=seed), np.random.default_rng(seed)
    weights = network.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    steps, total = 0, passes * max(1, -(-len(windows) // STEP))
    for _ in range(passes):
        order = draw.permutation(len(windows))
        for at in range(0, len(order), STEP):
            some = order[at : at + STEP]
            _, grads = gradients(network, windows[some].T, truth[some])
            steps += 1
            size = min(1.0, 1.0 / (1e-9 + np.sqrt(sum(float((g * g).sum()) for g in grads))))
            rate = RATE * (1 - steps / (total + 1)) * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            for w, g, m, v in zip(weights, grads, first, second):
                g = g * size
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return network


class Reader:
    """Applies a network to texts."""

    def __init__(self, network: Network):
        self.languages, self.units = network.languages, network.out.shape[0] // 2
        # Gates come from tanh(x / 2), so half of their input is stored.
        halve = np.repeat(np.array([0.5, 0.5, 1.0], np.float32), self.units)
        self.ways = [(np.ascontiguousarray(t * halve), np.ascontiguousarray(s * halve)) for t, s in (network.forward, network.backward)]
        self.out, self.bias = network.out, network.bias

    def _states(self, windows: np.ndarray, way: int, into: np.ndarray) -> None:
        table, state_to = self.ways[way]
        u, rows = self.units, windows.shape[1]
        h = np.zeros((rows, u), np.float32)
        x, s = np.empty((rows, 3 * u), np.float32), np.empty((rows, 3 * u), np.float32)
        gates, n = np.empty((rows, 2 * u), np.float32), np.empty((rows, u), np.float32)
        for t in range(len(windows)) if way == 0 else range(len(windows) - 1, -1, -1):
            np.take(table, windows[t], axis=0, out=x)
            np.matmul(h, state_to, out=s)
            np.add(x[:, : 2 * u], s[:, : 2 * u], out=gates)
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            np.multiply(gates[:, :u], s[:, 2 * u :], out=n)
            n += x[:, 2 * u :]
            np.tanh(n, out=n)
            h -= n
            h *= gates[:, u:]
            h += n
            into[t, :, way * u : (way + 1) * u] = h

    def window_sums(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per window (row, time) the summed probabilities of its letter bytes, and their number."""
        letters = _IS_LETTER[windows]
        sums = np.zeros((len(windows), len(self.languages)))
        for at in range(0, len(windows), ROWS):
            some = np.ascontiguousarray(windows[at : at + ROWS].T)
            states = np.empty((*some.shape, 2 * self.units), np.float32)
            self._states(some, 0, states)
            self._states(some, 1, states)
            p = np.exp(np.clip(states @ self.out + self.bias, -60, 60))
            p *= (letters[at : at + ROWS].T / p.sum(axis=2))[:, :, None]
            sums[at : at + ROWS] = p.sum(axis=0)
        return sums, letters.sum(axis=1)

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and its probability of each whole text."""
        data = [(t or "").encode().lower() for t in texts]
        counts = np.array([-(-len(d) // WINDOW) for d in data], np.int64)
        joined = np.frombuffer(b"".join(d.ljust(n * WINDOW) for d, n in zip(data, counts)), np.uint8).reshape(-1, WINDOW)
        sums, letters = self.window_sums(joined)
        ends = np.cumsum(counts)
        total = np.vstack([np.zeros(len(self.languages)), np.cumsum(sums, axis=0)])
        seen = np.r_[0, np.cumsum(letters)]
        out = []
        for text, start, end in zip(texts, ends - counts, ends):
            if seen[end] == seen[start] or not any(c.isalpha() for c in text):
                out.append((UNDETERMINED, 0.0))
            else:
                p = (total[end] - total[start]) / (seen[end] - seen[start])
                best = int(p.argmax())
                out.append((self.languages[best], min(1.0, float(p[best]))))
        return out


def _training_windows(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Windows of each document, spread evenly over it, that hold a letter."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            data = (row["text"] or "").encode().lower()
            starts = np.unique(np.linspace(0, max(0, len(data) - WINDOW), most).astype(int)) if data else []
            for start in starts:
                window = data[start : start + WINDOW].ljust(WINDOW)
                if _IS_LETTER[np.frombuffer(window, np.uint8)].any():
                    rows.append((row["key"], int(start), row["lang"], window))
        columns = zip(*rows) if rows else ([],) * 4
        types = pa.string(), pa.int32(), pa.string(), pa.binary()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["key", "start", "lang", "window"])


def fit(
    docs: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limit: int = TRAINED
) -> Network | None:
    """Network trained on documents with a language that ``allowed``, a condition on ids, admits; None without any."""
    rows = docs.where(allowed & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    # Drawn in turns from every language, so that a rare one is learned as well: the first of each by a hash, then the second, and so on.
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key"))
    known = rows.select("key", "lang").distinct().withColumn("turn", turn).where(F.col("turn") <= limit)
    keys = known.orderBy("turn", F.xxhash64("key"), "key", "lang").limit(limit).select("key", "lang")
    # One text per id and language, so that ``limit`` bounds the rows as well; of several, the least by a hash.
    chosen = rows.join(F.broadcast(keys), ["key", "lang"]).groupBy("key", "lang").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")
    ).select(F.col("key").cast("string").alias("key"), "lang", "x.text")
    windows = chosen.mapInArrow(
        partial(_training_windows, most=WINDOWS), "key string, start int, lang string, window binary"
    ).distinct()
    seen = windows.orderBy("key", "start", "lang", "window").toPandas()  # ``limit * WINDOWS`` rows at most
    if seen.empty:
        return None
    languages = sorted(seen["lang"].unique())
    data = np.frombuffer(b"".join(seen["window"]), np.uint8).reshape(-1, WINDOW)
    return train(data, np.searchsorted(languages, seen["lang"]), languages)


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` of every row.

    Null texts and texts without a letter are "und" with score 0, and so is every text without a network.
    Ids, null and repeated ones too, are passed through.
    """
    send = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("lang_pred string, score double")
    def read(texts: pd.Series) -> pd.DataFrame:
        texts = texts.tolist()
        if send.value is None:
            return pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": 0.0})
        reader = Reader(send.value)
        found = [x for a, b in runs([len(t or "") for t in texts], AT_ONCE) for x in reader(texts[a:b])]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("row_id"), read(text_col).alias("found"))
    return rows.select(F.col("row_id").alias(id_col), "found.*")


def languages(docs: DataFrame, folds: int = 4, fold: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predictions for all ``docs`` by a network that learned nothing of the held-out fold; adds ``held_out``."""
    aside = held_out(F.col(id_col), folds, fold)
    found = predict(docs, fit(docs, ~aside, id_col, text_col, lang_col), id_col, text_col)
    return found.select(id_col, aside.alias("held_out"), "lang_pred", "score")
