"""Toxicity: a small convolutional text classifier, trained and run in numpy by tasks.

Words, and the beginnings of longer words, are hashed to embeddings that add up; filters
of widths 1, 2 and 3 slide over them, each keeps its largest and second largest distinct
response in the whole text, and a logistic layer reads those. The cut between
toxic and not is calibrated for each language the text itself shows, and the score is
shifted so that the cut is 0.5.
"""

from __future__ import annotations

from copy import deepcopy
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import by_size, give_back, remainder_of_id, strings, whole_text
from eddyline.llm.training import KEYS, KEYS_DDL, averaged, labelled, packed, packs_of, totals
from eddyline.llm.wordhash import words_of

HASH_BITS = 20  # bounds the model: a million embeddings
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
STEM = 5
PEAKS = 2
DIMS = 8
BINS = 256  # of logits in a unit, by which texts are counted for the cuts
FLOOR = np.float32(-1e4)
CHUNK_CHARS = 1 << 18
#: Frequent short words by which a text shows its language.
MARKERS = {
    "en": "the of and to in is that for with was this are it",
    "de": "der die und das ist nicht ein von den mit für auf",
    "fr": "le les la de des et une est du que dans pour",
    "es": "el los las de que y en una por con del para",
}
UNKNOWN = len(MARKERS)


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Per text (2, words): the hash of each word and of its first ``STEM`` characters."""
    hashes, stems, counts = words_of([t.lower() for t in texts], stem=STEM)
    both = (np.stack([hashes, stems]) >> np.uint64(64 - HASH_BITS)).astype(np.int32)
    return np.split(both, np.cumsum(counts)[:-1], axis=1)


def _marker_table() -> np.ndarray:
    table = np.zeros((1 << HASH_BITS, len(MARKERS)), bool)
    for i, words in enumerate(MARKERS.values()):
        for w in words.split():
            table[int(word_hashes([w])[0][0, 0]), i] = True
    return table


def language_of(hashes: np.ndarray, table: np.ndarray) -> int:
    """The language with most marker words; ties and none: unknown."""
    hits = table[hashes[0]].sum(0)
    best = int(hits.argmax())
    return best if hits[best] and (hits == hits[best]).sum() == 1 else UNKNOWN


@dataclass
class TextFilters:
    known: np.ndarray          # sorted hashes that have an embedding; row 0 is all others
    embeddings: np.ndarray     # (1 + known, dims); row 0 stays zero
    filters: list[np.ndarray]  # per width: (width, dims, filters)
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray  # one number
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(UNKNOWN + 1))
    table: np.ndarray | None = None  # hash to row, made where it is used

    def __getstate__(self):
        return self.__dict__ | {"table": None}

    def parameters(self) -> list[np.ndarray]:
        return [self.embeddings, self.out, self.bias, *self.filters, *self.shifts]

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(hashes.shape, np.int32)
        if self.table is None:
            self.table = np.zeros(1 << HASH_BITS, np.int32)
            self.table[self.known] = np.arange(1, len(self.known) + 1)
        return self.table[hashes]

    def taps(self) -> list[list[np.ndarray]]:
        """Embeddings already multiplied by each filter tap: scoring only looks up and adds."""
        return [[(self.embeddings @ f[k]).astype(np.float32) for k in range(len(f))] for f in self.filters]

    def logits(self, texts: list[np.ndarray], taps) -> np.ndarray:
        sizes = np.array([t.shape[1] for t in texts])
        starts = np.cumsum(sizes + PAD + 1) - (sizes + PAD + 1)
        flat = np.zeros((2, int((sizes + PAD + 1).sum()) + PAD), np.int64)
        for at, t in zip(starts, texts):
            flat[:, at : at + t.shape[1]] = self.rows(t)
        n = flat.shape[1] - PAD
        # A text's windows start at its words (an empty one has one window of padding).
        edges = np.stack([starts, starts + np.maximum(sizes, 1)], 1).reshape(-1)
        lengths = np.diff(np.append(starts, n))
        total = np.full(len(texts), self.bias[0])
        place = 0
        for shift, own in zip(self.shifts, taps):
            response = own[0][flat[0, :n]] + own[0][flat[1, :n]]
            for k in range(1, len(own)):
                response += own[k][flat[0, k : k + n]] + own[k][flat[1, k : k + n]]
            for _ in range(PEAKS):
                peak = np.maximum.reduceat(response, edges)[::2]
                total += np.maximum(peak + shift, 0) @ self.out[place : place + len(shift)]
                place += len(shift)
                response[response == np.repeat(peak, lengths, axis=0)] = FLOOR
        return total


def start(known: np.ndarray, share: float, dims: int = DIMS, per_width: int = 6, seed: int = 42) -> tuple[TextFilters, list[np.ndarray]]:
    """A model that has learned nothing, and its sums of squared gradients."""
    rng = np.random.default_rng(seed)
    filters = [rng.standard_normal((w, dims, per_width)) * 0.3 for w in WIDTHS]
    model = TextFilters(
        known, rng.standard_normal((len(known) + 1, dims)) * 0.1, filters, [np.zeros(per_width) for _ in WIDTHS],
        rng.standard_normal(per_width * len(WIDTHS) * PEAKS) * 0.3, np.full(1, np.log(share / (1 - share))),
    )
    model.embeddings[0] = 0
    return model, [np.full(p.shape, 1e-6) for p in model.parameters()]


def constant(share: float) -> TextFilters:
    """Without both classes every text gets the share of label 1."""
    none = [np.zeros((w, DIMS, 1)) for w in WIDTHS]
    return TextFilters(np.zeros(0, np.int32), np.zeros((1, DIMS)), none, [np.zeros(1)] * len(WIDTHS), np.zeros(len(WIDTHS) * PEAKS), np.full(1, np.log(share / (1 - share))))


def calibrating(n: int) -> np.ndarray:
    """Which rows of a pack are kept from training and used for the cuts: a fifth."""
    return np.arange(n) % 5 == 0


def learn(model: TextFilters, squares: list[np.ndarray], texts: list[np.ndarray], targets: np.ndarray, share: float, rng, rate: float = 0.08) -> None:
    """One epoch over these texts, in place."""
    held_of = dict(zip(map(id, model.parameters()), squares))

    def step(parameter, gradient, at=slice(None)):
        held = held_of[id(parameter)]
        held[at] += gradient**2
        parameter[at] -= rate * gradient / np.sqrt(held[at])

    dims = model.embeddings.shape[1]
    weight = np.where(targets == 1, np.sqrt((1 - share) / share), 1.0)
    for i in rng.permutation(len(texts)):
        row = np.concatenate([model.rows(texts[i]), np.zeros((2, PAD + 1), np.int32)], 1)
        n = max(row.shape[1] - PAD - 1, 1)
        x = model.embeddings[row[0]] + model.embeddings[row[1]]
        peaks, places = [], []
        for f, shift in zip(model.filters, model.shifts):
            z = x[:n] @ f[0]
            for k in range(1, len(f)):
                z += x[k : k + n] @ f[k]
            for _ in range(PEAKS):
                at = z.argmax(0)
                peak = z[at, np.arange(z.shape[1])]
                places.append(at)
                peaks.append(peak + shift)
                z[z == peak] = FLOOR
        peak = np.concatenate(peaks)
        hidden = np.maximum(peak, 0)
        error = (1 / (1 + np.exp(-(hidden @ model.out + model.bias))) - targets[i]) * weight[i]
        back = error * model.out * (peak > 0)
        step(model.out, error * hidden + 1e-4 * model.out)
        step(model.bias, error)
        touched, moves = [], []
        for w, at in enumerate(places):
            f, shift = model.filters[w // PEAKS], model.shifts[w // PEAKS]
            g = back[w * len(shift) : (w + 1) * len(shift)]
            if not g.any():
                continue
            gradient = np.empty_like(f)
            for k in range(len(f)):
                gradient[k] = x[at + k].T * g
                for kind in row:
                    touched.append(kind[at + k])
                    moves.append((f[k] * g).T)
            step(f, gradient)
            step(shift, g)
        if touched:
            at, place = np.unique(np.concatenate(touched), return_inverse=True)
            moved = np.zeros((len(at), dims))
            np.add.at(moved, place, np.concatenate(moves))
            moved[at == 0] = 0
            step(model.embeddings, moved, at)


def as_rows(parameters: list[np.ndarray]) -> np.ndarray:
    """All but the first of the parameters, the embeddings, as rows as wide as these."""
    flat = np.concatenate([p.reshape(-1) for p in parameters[1:]])
    return np.pad(flat, (0, -len(flat) % DIMS)).reshape(-1, DIMS)


def take_rows(parameters: list[np.ndarray], rows: np.ndarray) -> None:
    flat, at = rows.reshape(-1), 0
    for p in parameters[1:]:
        p[...] = flat[at : at + p.size].reshape(p.shape)
        at += p.size


def _logits(model, texts, taps):
    out = [model.logits(texts[a:b], taps) for a, b in by_size([t.shape[1] for t in texts], 1 << 18)]
    return np.concatenate(out) if out else np.zeros(0)


def best_cut(bins: np.ndarray) -> float:
    """The middle of the gap at which precision and recall are best together. ``bins`` are
    rows of (least logit, greatest logit, texts, texts of label 1), the highest first."""
    least, greatest, n, ones = bins.T
    if not ones.sum():
        return 0.0
    f1 = 2 * ones.cumsum() / (n.cumsum() + ones.sum())
    best = int(f1.argmax())
    below = greatest[best + 1] if best + 1 < len(bins) else least[best] - 2
    return float((least[best] + below) / 2)


def _hashes_of(batches):
    for batch in batches:
        texts = strings(batch, "text")
        found = [h for a, b in by_size([len(t) for t in texts], CHUNK_CHARS) for h in word_hashes(texts[a:b])]
        hashes = pa.array([h.reshape(-1) for h in found], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in KEYS), hashes], names=[*KEYS, "words"])
    give_back()


def _packs_of(batches):
    """(shard, word hashes of each text, targets) of each pack."""
    for shard, targets, words in packs_of(batches, words=np.int32):
        yield shard, [w.reshape(2, -1) for w in words], targets.astype(np.float64)


def _counted(batches):
    """mapInArrow body: in how many training texts of a task each hash is."""
    docs = np.zeros(1 << HASH_BITS, np.int64)
    for _, texts, _ in _packs_of(batches):
        for i in np.flatnonzero(~calibrating(len(texts))):
            docs[np.unique(texts[i])] += 1
    hashes = np.flatnonzero(docs)
    yield pa.RecordBatch.from_arrays([pa.array(hashes.astype(np.int32)), pa.array(docs[hashes])], names=["hash", "docs"])


def _learner(share, seed):
    """What each shard learns in an epoch that begins with ``model``: embeddings by their
    place, then all other parameters; each with the roots of its squared gradients."""

    def body(batches, model, squares):
        for shard, packs in groupby(_packs_of(batches), itemgetter(0)):
            own, held, rng = deepcopy(model), [p.copy() for p in squares], np.random.default_rng([seed, shard])
            for _, texts, targets in packs:
                at = np.flatnonzero(~calibrating(len(texts)))
                learn(own, held, [texts[i] for i in at], targets[at], share, rng)
            # Embeddings that met no gradient are as they were, and not learned.
            used = np.flatnonzero((held[0] != squares[0]).any(1))
            rest, roots = as_rows(own.parameters()), np.sqrt(as_rows(held))
            yield (
                np.concatenate([used, len(own.embeddings) + np.arange(len(rest))]),
                np.concatenate([np.hstack([own.embeddings[used], np.sqrt(held[0][used])]), np.hstack([rest, roots])]),
            )
            give_back()

    return body


def _binned(model):
    """mapInArrow body: the calibrating texts of each pack counted by language and logit."""

    def body(batches):
        # The taps are as many as the words a model knows: made once, not for each pack.
        taps = table = None
        for _, texts, targets in _packs_of(batches):
            if taps is None:
                taps, table = model.taps(), _marker_table()
            at = np.flatnonzero(calibrating(len(texts)))
            logits = _logits(model, [texts[i] for i in at], taps)
            languages = np.array([language_of(texts[i], table) for i in at], np.int32)
            bins = np.floor(np.clip(logits, -30, 30) * BINS).astype(np.int32)
            columns = [languages, bins, logits, targets[at].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["language", "bin", "logit", "target"])

    return body


def _calibrate(model: TextFilters, packs: DataFrame) -> None:
    rows = packs.mapInArrow(_binned(model), "language int, bin int, logit double, target bigint")
    bins = rows.groupBy("language", "bin").agg(
        F.min("logit").alias("least"), F.max("logit").alias("greatest"), F.count("logit").alias("n"), F.sum("target").alias("ones")
    ).toArrow().to_pandas().sort_values("bin", ascending=False)
    cut = lambda some: best_cut(some[["least", "greatest", "n", "ones"]].to_numpy(np.float64)) if some.ones.sum() >= 10 else None
    # Each of a language's bins by itself: bins of one place are put together for the cut of all.
    together = bins.groupby("bin").agg({"least": "min", "greatest": "max", "n": "sum", "ones": "sum"}).sort_index(ascending=False)
    overall = cut(together) or 0.0
    for language in range(UNKNOWN + 1):
        own = cut(bins[bins.language == language])
        model.cuts[language] = overall if own is None else own


def fit_toxicity(docs: DataFrame, labels: DataFrame, epochs: int = 5, least_docs: int = 4, seed: int = 42) -> TextFilters:
    """Fitted on all labelled rows outside the held-out fold, as word hashes of whole texts.

    Tasks train on shards of rows and the driver holds one model, their mean. A fifth of the
    rows is kept from training and used for the cuts. Hashes seen in fewer than
    ``least_docs`` training texts share the zero embedding, so words of a single text cannot
    be learned by heart. Without both classes the model gives every text the share of label 1.
    """
    rows, shards = labelled(docs, labels, "toxic", 5, 0)
    rows = rows.mapInArrow(_hashes_of, f"{KEYS_DDL}, words array<int>")
    packs = packed(rows, shards, ["words"], "toxicity")
    n, ones = totals(packs)
    share = (ones + 0.5) / (n + 1)
    if not 0 < ones < n:
        return constant(share)
    counts = packs.mapInArrow(_counted, "hash int, docs bigint").groupBy("hash").agg(F.sum("docs").alias("docs"))
    known = counts.filter(F.col("docs") >= least_docs).select("hash").toArrow()["hash"].to_numpy()
    model, squares = start(np.sort(known).astype(np.int32), share, seed=seed)
    for epoch in range(epochs):
        at, values = averaged(packs, (model, squares), _learner(share, seed + epoch), 2 * DIMS)
        words = at < len(model.embeddings)
        model.embeddings[at[words]], squares[0][at[words]] = values[words, :DIMS], values[words, DIMS:] ** 2
        others = values[~words][np.argsort(at[~words])]
        take_rows(model.parameters(), others[:, :DIMS])
        take_rows(squares, others[:, DIMS:] ** 2)
    _calibrate(model, packs)
    return model


def _score(model: TextFilters):
    def body(batches):
        taps, table = model.taps(), _marker_table()
        for batch in batches:
            texts, scores = strings(batch, "text"), np.zeros(batch.num_rows)
            for a, b in by_size([len(t) for t in texts], CHUNK_CHARS):
                hashes = word_hashes(texts[a:b])
                cuts = model.cuts[[language_of(h, table) for h in hashes]]
                scores[a:b] = 1 / (1 + np.exp(-np.clip(model.logits(hashes, taps) - cuts, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])
        give_back()

    return body


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Only the text enters the score: NULL counts as '', texts of any length are read whole,
    repeated rows score alike, and a language is guessed from the words, never from a
    column. An empty table gives an empty result.
    """
    model = fit_toxicity(docs, labels)
    scored = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).mapInArrow(_score(model), "doc_id bigint, score double")
    return scored.select(
        "doc_id", (remainder_of_id("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
