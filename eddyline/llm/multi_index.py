"""Near-duplicate vectors by an inverted multi-index.

Each half of a vector has a codebook of its own; a pair of codes is a cell of the product
grid. A vector lies in its nearest cell, its home, and visits the next nearest ones in the
order of the multi-sequence. How many cells it visits is set so that a few hundred query
vectors, compared with all rows, find the wanted share of their neighbours. Pairs met in a
cell are verified by their cosine.

The first code is the key of the shuffle and the second is looked up inside the task, so a
vector travels once for its home and once for each further first code that it visits. It
only visits cells above its home, so no pair is met twice. A group that holds very many
rows is cut into blocks, and every two blocks meet once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import written
from eddyline.llm.components import smallest_reachable

SAMPLE = 16_384  # vectors, at most about this many, that codebooks are fitted on
QUERIES = 256  # vectors that are compared with all rows to set the number of visits
PER_CELL = 256  # vectors of one label that a cell holds on average
MOST_CODES = 256
MOST_VISITS = 512
BLOCK = 1 << 15  # vectors that a task holds at once
TILE = 1024
ROUNDS = 8
TARGET, HOME, COPY, PROBE = range(4)  # held rows; those of earlier blocks; copies; visits from lower codes


def _fits(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def comparable(vectors: DataFrame) -> DataFrame:
    """``id, label, dim, vector``: the rows that can link."""
    wide = dict(vectors.dtypes)["embedding"] == "array<double>"
    vector = F.col("embedding").cast("array<double>" if wide else "array<float>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), vector.alias("vector"))
    able = F.forall("vector", _fits) & F.exists("vector", lambda x: x != 0)
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(able, F.lit(False))).select(
        "id", "label", F.size("vector").alias("dim"), "vector"
    )


def _matrix(column, dims: np.ndarray, width: int) -> np.ndarray:
    """Vectors as rows of doubles, zeros behind shorter ones."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (dims == width).all():
        return flat.reshape(len(dims), width).astype(np.float64)
    out = np.zeros((len(dims), width))
    out[np.arange(width) < dims[:, None]] = flat
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares stay in range."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def codebook(rows: np.ndarray, k: int) -> np.ndarray:
    """``k`` centres of ``rows``."""
    centres = rows[np.random.default_rng(k).choice(len(rows), k, replace=False)]
    for _ in range(ROUNDS):
        near = distances(rows, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        n = np.bincount(near, minlength=k)[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return centres


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, less the squared lengths of the rows."""
    return (centres * centres).sum(1) - 2 * rows @ centres.T


class Grid:
    """Two codebooks and the cells that a vector visits."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.left, self.right = left, right

    def halves(self, rows: np.ndarray):
        cut = self.left.shape[1]
        return distances(rows[:, :cut], self.left), distances(rows[:, cut:], self.right)

    def nearest(self, rows: np.ndarray, visits: int):
        """(first codes, second codes) of each row's ``visits`` nearest cells, nearest first.

        The cell of the a-th nearest first code and the b-th nearest second code has
        (a + 1)(b + 1) - 1 cells before it, so only cells with few enough are weighed.
        """
        if len(rows) > TILE:
            tiles = [self.nearest(rows[s : s + TILE], visits) for s in range(0, len(rows), TILE)]
            return tuple(np.concatenate(part) for part in zip(*tiles))
        d1, d2 = self.halves(rows)
        o1, o2 = np.argsort(d1, 1, kind="stable"), np.argsort(d2, 1, kind="stable")
        a, b = np.divmod(np.arange(o1.shape[1] * o2.shape[1]), o2.shape[1])
        few = (a + 1) * (b + 1) <= visits
        a, b = a[few], b[few]
        cost = np.take_along_axis(d1, o1, 1)[:, a] + np.take_along_axis(d2, o2, 1)[:, b]
        best = np.argsort(cost, 1, kind="stable")[:, :visits]
        return np.take_along_axis(o1[:, a], best, 1), np.take_along_axis(o2[:, b], best, 1)

    def rank(self, rows: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """How many cells are nearer to each row than the cell (first, second)."""
        d1, d2 = self.halves(rows)
        at = np.arange(len(rows))
        value = d1[at, first] + d2[at, second]
        d2 = np.sort(d2, 1)
        return np.array([np.searchsorted(d2[k], value[k] - d1[k] - 1e-12).sum() for k in at], np.int64)

    def homes(self, rows: np.ndarray):
        d1, d2 = self.halves(rows)
        return d1.argmin(1), d2.argmin(1)


def _fit(rows: DataFrame, n: int, typical: float, width: int):
    """A grid from a sample, the sample's labels, dimensions, unit vectors and first codes."""
    sample = rows.sample(min(1.0, SAMPLE / n), seed=7) if n > SAMPLE else rows
    table = sample.toArrow()
    dims = table["dim"].to_numpy().astype(np.int64)
    vectors = unit(_matrix(table["vector"].combine_chunks(), dims, width)) if len(dims) else np.zeros((0, width))
    k = int(min(max(round((typical / PER_CELL) ** 0.5), 1), MOST_CODES, max(len(dims) // 8, 1)))
    cut = max(width // 2, 1)
    empty = not len(dims)
    left = np.zeros((1, cut)) if empty else codebook(vectors[:, :cut], k)
    right = np.zeros((1, width - cut)) if empty or width == cut else codebook(vectors[:, cut:], k)
    grid = Grid(left, right)
    return grid, table["id"].to_numpy(), table["label"].to_numpy(), dims, vectors


def _ranks(shared, width: int, least: float):
    """mapInArrow body: for pairs of a query and a row that link, the place of the higher
    home in the order in which the vector of the lower home visits cells."""

    def body(batches):
        grid, ids, labels, dims, queries = shared.value
        for batch in batches:
            dim = batch.column("dim").to_numpy().astype(np.int64)
            rows = unit(_matrix(batch.column("vector"), dim, width)) if len(dim) else np.zeros((0, width))
            same = (batch.column("label").to_numpy()[:, None] == labels) & (dim[:, None] == dims) & (batch.column("id").to_numpy()[:, None] != ids)
            r, q = np.nonzero(same & (rows @ queries.T >= least))
            if len(r) > 16 * len(ids):  # a dense group: some of its pairs show the same
                some = np.sort(np.random.default_rng(0).choice(len(r), 16 * len(ids), replace=False))
                r, q = r[some], q[some]
            if not len(r):
                continue
            pairs = np.concatenate([rows[r], queries[q]])
            i, j = grid.homes(pairs)
            home = i * len(grid.right) + j
            n = len(r)
            swap = home[:n] > home[n:]
            low = np.where(swap, np.arange(n) + n, np.arange(n))
            high = np.where(swap, np.arange(n), np.arange(n) + n)
            found, times = np.unique(np.minimum(grid.rank(pairs[low], i[high], j[high]), MOST_VISITS), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)], names=["rank", "n"])

    return body


def visits_for(rows: DataFrame, shared, width: int, least: float, recall: float) -> tuple[int, float]:
    """(cells to visit, share of the queries' links that so many visits find)."""
    counted = sorted(map(tuple, rows.mapInArrow(_ranks(shared, width, least), "rank bigint, n bigint").groupBy("rank").agg(F.sum("n")).collect()))
    total = sum(n for _, n in counted)
    met, visits = 0, 1
    for rank, n in counted:
        if total and met >= recall * total:
            break
        if rank < MOST_VISITS:
            met, visits = met + n, rank + 1
    return visits, met / total if total else 1.0


SHUFFLED = "label bigint, dim int, code int, block int, kind int, id bigint, weight bigint, copy_of bigint, own int, visits array<int>, vector binary"
NAMES = [c.split()[0] for c in SHUFFLED.split(", ")]


def _copies(key: np.ndarray, raw: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of a batch the row that stands for it: the one with the smallest id
    among those with the same bytes."""
    order = np.lexsort((ids, key))
    stands = np.arange(len(ids))
    ordered = key[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ids) else np.array([], np.int64)
    first = np.repeat(order[starts], np.diff(np.append(starts, len(ids))))
    equal = (raw[order] == raw[first]).all(1)
    stands[order[equal]] = first[equal]
    return stands


def _assign(shared, width: int, visits: int, blocks: dict):
    """mapInArrow body: one row per task group that a vector has to be in."""

    def body(batches):
        grid = shared.value[0]
        for batch in batches:
            if not batch.num_rows:
                continue
            label, ids = batch.column("label").to_numpy(), batch.column("id").to_numpy()
            dims = batch.column("dim").to_numpy()
            column = batch.column("vector")
            cells = column.flatten().to_numpy(zero_copy_only=False)
            rows = _matrix(column, dims.astype(np.int64), width)
            noise = np.random.default_rng(1).integers(1, 1 << 62, width, dtype=np.uint64) | np.uint64(1)
            key = (np.ascontiguousarray(rows).view(np.uint64) * noise).sum(1) ^ (label.view(np.uint64) << np.uint64(8)) ^ dims.astype(np.uint64)
            stands = _copies(key, np.column_stack([rows, label, dims]), ids)
            weight = np.bincount(stands, minlength=len(ids))
            firsts, seconds = grid.nearest(unit(rows), visits)
            ends = np.cumsum(dims)
            out = []
            for r in range(len(ids)):
                group = (int(label[r]), int(dims[r]))
                home = int(firsts[r, 0])
                if stands[r] != r:
                    if ids[stands[r]] != ids[r]:
                        out.append((*group, home, 0, COPY, ids[r], 0, ids[stands[r]], 0, [], b""))
                    continue
                vector = cells[ends[r] - dims[r] : ends[r]].tobytes()
                own = int(seconds[r, 0])
                n = blocks.get((*group, home), 1)
                block = int(ids[r]) * 0x9E3779B1 % (1 << 32) % n
                here = seconds[r][(firsts[r] == home) & (seconds[r] > own)].tolist()
                for b in range(block, n):
                    out.append((*group, home, b, TARGET if b == block else HOME, ids[r], weight[r], None, own, here, vector))
                for code in set(firsts[r][firsts[r] > home].tolist()):
                    there = seconds[r][firsts[r] == code].tolist()
                    for b in range(blocks.get((*group, code), 1)):
                        out.append((*group, code, b, PROBE, ids[r], weight[r], None, -1, there, vector))
            for a in range(0, len(out), 1 << 14):
                yield _rows(out[a : a + (1 << 14)])

    return body


TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary()]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], names=NAMES)


class _Block:
    """The vectors whose home is one group, or one block of it, and what links to them."""

    def __init__(self, ids, weights, own, visits, rows, least):
        order = np.argsort(own, kind="stable")
        self.ids, self.weights, self.own, self.rows, self.least = ids[order], weights[order], own[order], rows[order], least
        self.visits = [visits[k] for k in order]
        self.n = self.weights - 1
        self.root = np.arange(len(ids))
        codes = np.unique(self.own)
        self.cells = {int(c): (int(a), int(b)) for c, a, b in zip(codes, np.searchsorted(self.own, codes), np.searchsorted(self.own, codes, "right"))}
        self.coming = _by_code(self.visits)

    def among(self):
        """Compares the vectors with each other."""
        for code, (a, b) in self.cells.items():
            for s in range(a, b, TILE):
                part = np.arange(s, min(s + TILE, b))
                self._meet(part, self.rows[part], self.ids[part], self.weights[part], s, b, upper=True)
            visiting = self.coming.get(code, ())
            for s in range(0, len(visiting), TILE):
                part = visiting[s : s + TILE]
                self._meet(part, self.rows[part], self.ids[part], self.weights[part], a, b)

    def against(self, ids, weights, own, visits, rows):
        """Links of vectors from elsewhere: (number, id of a linked vector or -1) for each."""
        n, to = np.zeros(len(ids), np.int64), np.full(len(ids), -1)
        wanted = [v if o < 0 else [o, *v] for o, v in zip(own.tolist(), visits)]
        tasks = [(part, *self.cells[code]) for code, part in _by_code(wanted).items() if code in self.cells]
        for part, a, b in tasks:
            self._count(part, np.arange(a, b), ids, weights, rows, n, to)
        for code, part in _by_code([[o] if o >= 0 else [] for o in own.tolist()]).items():
            if code in self.coming:  # vectors of lower second codes that visit this one
                self._count(part, self.coming[code], ids, weights, rows, n, to)
        return n, np.where(to < 0, -1, self.ids[np.maximum(to, 0)])

    def _count(self, part, targets, ids, weights, rows, n, to):
        for s in range(0, len(targets), TILE * 8):
            some = targets[s : s + TILE * 8]
            for p in range(0, len(part), TILE):
                q = part[p : p + TILE]
                hit = (rows[q] @ self.rows[some].T >= self.least) & (ids[q][:, None] != self.ids[some])
                n[q] += hit @ self.weights[some]
                self.n[some] += weights[q] @ hit
                for k in np.flatnonzero(hit.any(1)):
                    low = self._join(self.root[some[hit[k]]], to[q[k]])
                    to[q[k]] = low

    def _meet(self, part, rows, ids, weights, a, b, upper=False):
        for s in range(a, b, TILE * 8):
            e = min(s + TILE * 8, b)
            hit = (rows @ self.rows[s:e].T >= self.least) & (ids[:, None] != self.ids[s:e])
            if upper:
                hit &= part[:, None] < np.arange(s, e)
            self.n[part] += hit @ self.weights[s:e]
            self.n[s:e] += weights @ hit
            for k in np.flatnonzero(hit.any(1)):
                self._join(self.root[s:e][hit[k]], part[k])

    def _join(self, roots: np.ndarray, other: int) -> int:
        """Makes one group of the linked vectors' groups and that of vector ``other``
        (-1: none); its root."""
        low = roots.min()
        if other >= 0:
            low = min(low, self.root[other])
        if (roots != low).any() or (other >= 0 and self.root[other] != low):
            gone = np.unique(roots if other < 0 else np.append(roots, self.root[other]))
            self.root[np.isin(self.root, gone)] = low
        return int(low)


def _by_code(lists) -> dict[int, np.ndarray]:
    found: dict[int, list[int]] = {}
    for k, codes in enumerate(lists):
        for code in codes:
            found.setdefault(int(code), []).append(k)
    return {code: np.array(rows) for code, rows in found.items()}


LINKS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("to", pa.int64()), ("copy_of", pa.int64())])


def _compare(least: float, dtype: str):
    """mapInArrow body over rows in order of group, block and kind: a block's own vectors
    are held, and those that visit it pass by."""

    def values(batch, a, b):
        part = batch.slice(a, b - a)
        get = lambda name: part.column(name).to_numpy(zero_copy_only=False)
        rows = np.array([np.frombuffer(v, dtype) for v in part.column("vector").to_pylist()], np.float64)
        return get("id"), get("weight"), get("own"), part.column("visits").to_pylist(), unit(rows)

    def closed(block):
        root = block.root
        keep = (block.n > 0) | (root != np.arange(len(root)))
        to = pa.array(block.ids[root][keep], pa.int64(), mask=(root == np.arange(len(root)))[keep])
        return pa.RecordBatch.from_arrays([pa.array(block.ids[keep]), pa.array(block.n[keep]), to, pa.nulls(int(keep.sum()), pa.int64())], schema=LINKS)

    def body(batches):
        held, targets, block = None, [], None

        def ready():
            nonlocal block, targets
            if block is None and targets:
                ids, weights, own, rows = (np.concatenate([t[k] for t in targets]) for k in (0, 1, 2, 4))
                block = _Block(ids, weights, own, [v for t in targets for v in t[3]], rows, least)
                block.among()
                targets = []
            return block

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(n).to_numpy().astype(np.int64) for n in ("label", "dim", "code", "block", "kind")])
            cuts = np.append(np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])), len(keys))
            for a, b in zip(cuts[:-1], cuts[1:]):
                key, kind = tuple(keys[a, :4].tolist()), int(keys[a, 4])
                if key != held:
                    if ready() is not None:
                        yield closed(block)
                    held, targets, block = key, [], None
                if kind == TARGET:
                    targets.append(values(batch, a, b))
                elif kind == COPY:
                    part = batch.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.nulls(b - a, pa.int64()), pa.nulls(b - a, pa.int64()), part.column("copy_of")], schema=LINKS)
                elif ready() is not None:
                    for s in range(a, b, 2048):
                        ids, weights, own, visits, rows = values(batch, s, min(s + 2048, b))
                        n, to = block.against(ids, weights, own, visits, rows)
                        linked = n > 0
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[linked]), pa.array(n[linked]), pa.array(to[linked]), pa.nulls(int(linked.sum()), pa.int64())], schema=LINKS
                        )
        if ready() is not None:
            yield closed(block)

    return body


def near_vectors(vectors: DataFrame, least: float = 0.93, recall: float = 0.99) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of
    ``vectors(vec_id, label, embedding)``.

    Two vectors link if their labels are equal and their cosine, in double precision, is
    ``least`` or more. Nothing links with vectors that are NULL, empty or zero, hold NULL or
    non-finite cells, have no label or no vec_id (for such rows component_id is NULL), or
    with vectors of another length. ``recall`` is the share of links that the visited cells
    are to find, measured with ``QUERIES`` vectors against all rows. Copies within a batch
    travel as one. A vec_id of several rows is one vector whose links add up; others count
    it once for each row. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = comparable(vectors)
    sizes = rows.groupBy("label", "dim").count().agg(
        F.sum("count").alias("n"), F.sum(F.col("count").cast("double") ** 2).alias("squares"), F.max("dim").alias("dim")
    ).first()
    n, width = sizes["n"] or 0, sizes["dim"] or 2
    grid, ids, labels, dims, sample = _fit(rows, n, (sizes["squares"] or 0) / max(n, 1), width)
    step = max(len(ids) // QUERIES, 1)
    some = slice(0, step * QUERIES, step)
    shared = spark.sparkContext.broadcast((grid, ids[some], labels[some], dims[some], sample[some]))
    visits, _ = visits_for(rows, shared, width, least, recall)
    blocks = {}
    if len(ids):
        groups, seen = np.unique(np.column_stack([labels, dims, grid.homes(sample)[0]]), axis=0, return_counts=True)
        expected = np.ceil(seen * (n / len(ids)) / BLOCK).astype(int)
        blocks = {tuple(g): int(b) for g, b in zip(groups.tolist(), expected) if b > 1}

    dtype = "<f8" if dict(rows.dtypes)["vector"] == "array<double>" else "<f4"
    group = ["label", "dim", "code", "block"]
    met = rows.mapInArrow(_assign(shared, width, visits, blocks), SHUFFLED).repartition(*group).sortWithinPartitions(*group, "kind")
    found = written(met.mapInArrow(_compare(least, dtype), "id bigint, n bigint, to bigint, copy_of bigint"), "vector-links")
    counts = found.filter("copy_of IS NULL").groupBy(F.col("id").alias("node")).agg(F.sum("n").alias("n_links"))
    reached = smallest_reachable(found.filter("to IS NOT NULL").select(F.col("id").alias("a"), F.col("to").alias("b")))
    copies = found.filter("copy_of IS NOT NULL").groupBy(F.col("id").alias("vec_id")).agg(F.min("copy_of").alias("copy_of"))
    node = F.coalesce("copy_of", "vec_id").alias("node")
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id")).join(copies, "vec_id", "left").select("vec_id", node)
        .join(counts, "node", "left").join(reached, "node", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
