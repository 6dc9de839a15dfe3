"""Quality classifier: a factorisation machine over a text.

Inputs are hashed words (their counts scaled to unit length), structure statistics of the
text and its sizes, the latter two in one-hot bins. Every pair of inputs interacts
through low-rank factors; the sum over pairs is half of (sum)^2 - (sum of squares) for
each factor, so a score takes time linear in the number of inputs.
"""

from __future__ import annotations

from copy import deepcopy
from dataclasses import dataclass
from itertools import groupby
from math import log2
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import by_size, give_back, remainder_of_id, strings, whole_text
from eddyline.llm.training import KEYS, KEYS_DDL, averaged, labelled, packed, packs_of, totals
from eddyline.llm.wordhash import words_of

WORD_BITS = 15
TEXT_BITS = 20
BINS = 12
STATISTICS = 9
RANK = 6
WIDTH = (1 << WORD_BITS) + BINS * STATISTICS
CHUNK_CHARS = 1 << 18
#: Per byte: blank or control 0, digit 1, capital 2, small letter 3, beyond ASCII 4, mark 5.
KIND = np.array([
    0 if b <= 32 else 4 if b >= 128 else 1 if chr(b).isdigit() else 2 if chr(b).isupper() else 3 if chr(b).islower() else 5
    for b in range(256)
], np.uint8)


def statistics(text: str, n_words: int, distinct: int, top: int) -> list[float]:
    """Each between 0 and 1; an empty text has zeros."""
    if not text:
        return [0.0] * STATISTICS
    view = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    blanks, digits, upper, small, high, marks = np.bincount(KIND[view], minlength=6).tolist()
    size, words = len(view), max(n_words, 1)
    return [
        upper / max(upper + small, 1), marks / size, digits / size, blanks / size, high / size,
        distinct / words, top / words, min(1.0, size / words / 24), min(1.0, log2(1 + size) / 24),
    ]


def inputs(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slots, values) of each text. Equal texts have equal inputs."""
    hashes, _, n_words = words_of(texts, blank_separated=True)
    text_of = np.repeat(np.arange(len(texts), dtype=np.uint64), n_words)
    # Text, slot and rest of the hash in one number: one sort counts words and slots.
    rest = np.uint64(64 - TEXT_BITS)
    words, counts = np.unique(text_of << rest | hashes >> np.uint64(TEXT_BITS), return_counts=True)
    ends = np.searchsorted(words >> rest, np.arange(len(texts) + 1))
    slots = words >> (rest - np.uint64(WORD_BITS))
    first = np.flatnonzero(np.diff(slots, prepend=np.uint64(2**63)) != 0) if len(slots) else np.zeros(0, np.int64)
    values = np.log1p(np.add.reduceat(counts, first)) if len(first) else np.zeros(0)
    slots = slots[first].astype(np.int64)
    bounds = np.searchsorted(slots >> WORD_BITS, np.arange(len(texts) + 1))
    out = []
    for i, text in enumerate(texts):
        own = counts[ends[i] : ends[i + 1]]
        shown = statistics(text, int(n_words[i]), len(own), int(own.max()) if len(own) else 0)
        bins = np.minimum((np.array(shown) * BINS).astype(np.int64), BINS - 1)
        ones = (1 << WORD_BITS) + np.arange(STATISTICS) * BINS + bins
        used, scaled = slots[bounds[i] : bounds[i + 1]] & ((1 << WORD_BITS) - 1), values[bounds[i] : bounds[i + 1]]
        scaled = scaled / max(np.sqrt((scaled**2).sum()), 1e-12)
        out.append((np.concatenate([used, ones]), np.concatenate([scaled, np.full(STATISTICS, 0.5)]).astype(np.float32)))
    return out


@dataclass
class FactorMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One value per text; ``starts`` are the texts' first positions in ``slots``."""
        v = self.factors[slots] * values[:, None]
        linear = np.add.reduceat(self.weights[slots] * values, starts)
        sums = np.add.reduceat(v, starts)
        squares = np.add.reduceat((v * v).sum(1), starts)
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares)


def start(share: float, rank: int = RANK, seed: int = 42) -> FactorMachine:
    """A model that has learned nothing."""
    factors = (np.random.default_rng(seed).standard_normal((WIDTH, rank)) * 0.05).astype(np.float32)
    return FactorMachine(float(np.log(share / (1 - share))), np.zeros(WIDTH, np.float32), factors)


@dataclass
class Squares:
    """Sums of squared gradients."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray


def learn(model: FactorMachine, seen: Squares, rows: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, rng, rate: float = 0.15, decay: float = 2e-5) -> None:
    """One epoch in place: log loss, minibatches, step sizes by the sum of squared gradients
    (all in numpy)."""
    rank = model.factors.shape[1]
    order = rng.permutation(len(rows))
    for a in range(0, len(order), 32):
        batch = order[a : a + 32]
        slots = np.concatenate([rows[i][0] for i in batch])
        values = np.concatenate([rows[i][1] for i in batch])
        sizes = np.array([len(rows[i][0]) for i in batch])
        starts = np.cumsum(sizes) - sizes
        error = (1 / (1 + np.exp(-model.logits(slots, values, starts))) - targets[batch]) / len(batch)
        own = np.repeat(error, sizes).astype(np.float32) * values
        v = model.factors[slots]
        sums = np.repeat(np.add.reduceat(v * values[:, None], starts), sizes, axis=0)
        used, place = np.unique(slots, return_inverse=True)
        gw, gv = np.zeros(len(used), np.float32), np.zeros((len(used), rank), np.float32)
        np.add.at(gw, place, own)
        np.add.at(gv, place, own[:, None] * (sums - v * values[:, None]))
        gw += decay * model.weights[used]
        gv += decay * model.factors[used]
        seen.weights[used] += gw * gw
        seen.factors[used] += gv * gv
        model.weights[used] -= rate * gw / np.sqrt(seen.weights[used])
        model.factors[used] -= rate * 0.3 * gv / np.sqrt(seen.factors[used])
        seen.bias += error.sum() ** 2
        model.bias -= rate * error.sum() / np.sqrt(seen.bias)


def _inputs_of(batches):
    for batch in batches:
        texts = strings(batch, "text")
        found = [pair for a, b in by_size([len(t) for t in texts], CHUNK_CHARS) for pair in inputs(texts[a:b])]
        slots = pa.array([s.astype(np.int32) for s, _ in found], pa.list_(pa.int32()))
        values = pa.array([v for _, v in found], pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in KEYS), slots, values], names=[*KEYS, "slots", "values"])
    give_back()


def _learner(seed: int):
    """What each shard learns in an epoch that begins with ``model``: slots, then the bias;
    each with the roots of its squared gradients."""

    def body(batches, model, seen):
        found = packs_of(batches, slots=np.int32, values=np.float32)
        for shard, packs in groupby(found, itemgetter(0)):
            own, held, rng = deepcopy(model), deepcopy(seen), np.random.default_rng([seed, shard])
            for _, targets, slots, values in packs:
                learn(own, held, list(zip(slots, values)), targets.astype(np.float64), rng)
            used = np.flatnonzero((held.weights != seen.weights) | (held.factors != seen.factors).any(1))
            bias = np.zeros((1, 2 * (RANK + 1)))
            bias[0, 0], bias[0, RANK + 1] = own.bias, np.sqrt(held.bias)
            learned = np.hstack([
                own.weights[used, None], own.factors[used], np.sqrt(held.weights[used, None]), np.sqrt(held.factors[used])
            ])
            yield np.append(used, WIDTH), np.concatenate([learned, bias])
            give_back()

    return body


def fit_quality(docs: DataFrame, labels: DataFrame, epochs: int = 8, seed: int = 42) -> FactorMachine:
    """Fitted on all labelled rows outside the held-out fold.

    Tasks turn texts into inputs and train on shards of them; the driver holds one model,
    their mean. Without both classes there is nothing to tell apart: every text then scores
    the share of label 1, or 0.5 without labels.
    """
    rows, shards = labelled(docs, labels, "quality", 3, 1)
    rows = rows.mapInArrow(_inputs_of, f"{KEYS_DDL}, slots array<int>, values array<float>")
    packs = packed(rows, shards, ["slots", "values"], "quality")
    n, ones = totals(packs)
    model = start((ones + 0.5) / (n + 1), seed=seed)
    if not 0 < ones < n:
        model.factors[:] = 0
        return model
    seen = Squares(1e-6, np.full(WIDTH, 1e-6, np.float32), np.full((WIDTH, RANK), 1e-6, np.float32))
    for epoch in range(epochs):
        at, values = averaged(packs, (model, seen), _learner(seed + epoch), 2 * (RANK + 1))
        learned, roots = values[:, : RANK + 1], values[:, RANK + 1 :]
        bias, own = at == WIDTH, at != WIDTH
        model.bias, seen.bias = float(learned[bias][0, 0]), float(roots[bias][0, 0] ** 2)
        model.weights[at[own]], model.factors[at[own]] = learned[own, 0], learned[own, 1:]
        seen.weights[at[own]], seen.factors[at[own]] = roots[own, 0] ** 2, roots[own, 1:] ** 2
    return model


def scorer(model: FactorMachine):
    def score(texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in by_size([len(t) for t in texts], CHUNK_CHARS):
            found = inputs(texts[a:b])
            sizes = np.array([len(s) for s, _ in found])
            logits = model.logits(np.concatenate([s for s, _ in found]), np.concatenate([v for _, v in found]), np.cumsum(sizes) - sizes)
            out[a:b] = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        give_back()
        return out

    return score


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good text likelier) and ``predicted``.

    Only the text is looked at: NULL is scored as '', a very long text whole, repeated
    rows alike. Columns of these two names are replaced; all others stay.
    """
    score = scorer(fit_quality(docs, labels))

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        return pd.Series(score(texts.tolist()))

    with_score = docs.withColumn("score", scored(whole_text()))
    return with_score.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(column: str = "doc_id"):
    return (remainder_of_id(column, 3) == 1).alias("held_out")
