"""Merge-type subword encoding with seeded merge-dropout, and its exact inverse.

Without dropout the pieces are those the ``sentencepiece`` library gives for a merge
model with byte fallback. With dropout, a candidate merge that comes off the agenda is
skipped when its keyed hash falls under ``dropout``. The key holds the seed, the document
and the place of the unit in it, so every word of every document is drawn anew; the same
seed gives the same pieces on any cluster, another seed gives others, and all of them
decode to the same text.
"""

from __future__ import annotations

import re
import sys
from array import array
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import by_size, give_back, slices, strings, whole_text

SPACE = "▁"  # Fixed value: how a blank is written inside pieces.
CACHE_ENTRIES = 120_000  # that stay when twice as many are there
BATCH_BYTES = 1 << 19
BATCH_IDS = 1 << 17
CELLS = 1 << 18
LONG_UNIT = 512
SLOT_BITS = 20
NEVER = np.iinfo(np.int32).max


def fine_units(pieces) -> re.Pattern:
    """A run of letters, of digits or of other characters with the blanks before it.
    Numerals such as superscripts count as other characters."""
    numerals = "".join(sorted({c for p in pieces for c in p if c.isalnum() and not c.isalpha() and not c.isdecimal()}))
    other = f"\\W_{re.escape(numerals)}"
    return re.compile(rf"{SPACE}*(?:[^\d{other}]+|\d+|(?:(?!{SPACE})[{other}])+)|{SPACE}+")


COARSE = re.compile(rf"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def ragged(flat: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of runs of these ``sizes``, back to back in ``flat``, those of ``rows``, back to back."""
    wanted = sizes[rows]
    shift = (np.cumsum(sizes) - sizes)[rows] - (np.cumsum(wanted) - wanted)
    return flat[np.arange(wanted.sum()) + np.repeat(shift, wanted)]


@dataclass
class Cuts:
    """Cuts of units, back to back, and the codes of the merges that lead to them."""

    ids: np.ndarray
    sizes: np.ndarray
    codes: np.ndarray
    steps: np.ndarray

    @staticmethod
    def joined(some: list[Cuts]) -> Cuts:
        none = Cuts(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64))
        every = [none, *some]
        return Cuts(*(np.concatenate([getattr(c, n) for c in every]) for n in ("ids", "sizes", "codes", "steps")))

    def of(self, rows: np.ndarray) -> Cuts:
        return Cuts(ragged(self.ids, self.sizes, rows), self.sizes[rows], ragged(self.codes, self.steps, rows), self.steps[rows])

    def tuples(self) -> list[tuple[int, ...]]:
        flat, ends = self.ids.tolist(), self.sizes.cumsum().tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]


class MergeCodec:
    """A skip is a pure function of a unit's key, the place and the length of the union, so
    working off the agenda means: merge the best pair that is not skipped until none is
    left. Many units take these steps together, as rows of arrays.

    Kept for the next time, as arrays, is only what no draw decides: a unit's plain cut, and
    the merges that lead to it. Where none of these is skipped the plain cut is the result, as skips of
    other candidates change nothing; any other unit is merged with its own draws.
    """

    def __init__(self, path: str, dropout: float, seed: int, cache_entries: int = CACHE_ENTRIES):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        self.spellings = spellings_of(model)
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(pieces) if model.is_byte(i)}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.symbol = {pieces[i]: i for i in plain}
        if not self.byte_id or model.normalize("ﬁ  x\n") != f"{SPACE}ﬁ{SPACE}{SPACE}x\n":
            raise ValueError("needs a model with byte fallback that leaves texts as they are")
        # Units may be cut apart only where no piece of the vocabulary reaches across.
        fine = fine_units(self.symbol)
        self.unit = fine if all(fine.fullmatch(p) for p in self.symbol) else COARSE
        self.n_pieces = n
        for c in sorted({c for i in plain for c in pieces[i]} - self.symbol.keys()):
            self.symbol[c] = n + len(self.symbol) - len(plain)
        # Code points outside the vocabulary share a code above all others and never merge.
        self.by_point = np.full(sys.maxunicode + 1, n + len(self.symbol), np.int32)
        for p, i in self.symbol.items():
            if len(p) == 1:
                self.by_point[ord(p)] = i
        self._pair_table({pieces[i]: (i, -model.get_score(i)) for i in plain})
        self.byte_ids = np.array([self.byte_id[b] for b in range(256)], np.int32)
        self.limit = int(dropout * 2**32)
        self.seed, self.cache_entries = seed, cache_entries
        # What is kept of units without draws, by their numbers. Number 0 is no unit, but the
        # mark of a blank in a text itself.
        self.number = {"": 0}
        blank = self.byte_ids[list(SPACE.encode())]
        self.known = Cuts(blank, np.array([len(blank)]), np.zeros(0, np.uint32), np.zeros(1, np.int64))
        self.salts, self.uses, self.always = np.zeros(1, np.uint32), np.zeros(1, np.int64), np.zeros(1, bool)

    def _pair_table(self, scored) -> None:
        """Pairs of symbols whose union is a piece, sorted for lookup; ranks by score."""
        order = {cost: r for r, cost in enumerate(sorted({c for _, c in scored.values()}))}
        self.rank = np.full(self.n_pieces, NEVER, np.int32)
        self.length = np.zeros(self.n_pieces, np.uint32)
        keys, unions = [], []
        for p, (i, cost) in scored.items():
            self.rank[i], self.length[i] = order[cost], len(p)
            for k in range(1, len(p)):
                left, right = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    unions.append(i)
        by_key = np.argsort(np.array(keys, np.int64))
        self.pairs, self.unions = np.array(keys, np.int64)[by_key], np.array(unions, np.int32)[by_key]
        # Where a pair would be by its hash: its place, or -1 where several are.
        slots = self._slot(self.pairs >> 32, self.pairs & 0xFFFFFFFF)
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)
        self.slots[slots] = np.arange(len(self.pairs))
        alone = np.bincount(slots, minlength=1 << SLOT_BITS)
        self.slots[alone > 1] = -1

    @staticmethod
    def _slot(left, right):
        mixed = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def _skipped(self, key, code):
        """Whether draws under ``key`` skip the candidates of these codes."""
        x = key ^ code
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        return x < self.limit

    def _code(self, place, union):
        return place * np.uint32(0x9E3779B1) + self.length[union] * np.uint32(0x85EBCA77)

    def _candidates(self, key, place, left, right):
        """(union, rank) of neighbours; NEVER where no piece or a skipped one. Without a
        key none is skipped."""
        wanted = left.astype(np.int64) << 32 | right
        at = self.slots[self._slot(left, right)]
        several = at < 0
        if several.any():
            at[several] = np.minimum(np.searchsorted(self.pairs, wanted[several]), len(self.pairs) - 1)
        found = (self.pairs[at] == wanted) & (left >= 0) & (right >= 0)
        union = np.where(found, self.unions[at], 0)
        if key is not None and self.limit:
            found &= ~self._skipped(key, self._code(place, union))
        return union, np.where(found, self.rank[union], NEVER)

    def merge(self, units: list[str], variant: int) -> list[tuple[int, ...]]:
        """Cuts of units outside any document, each drawn by itself and ``variant``."""
        start = (self.seed * 0x9E3779B1 + variant * 0xC2B2AE35) & 0xFFFFFFFF
        return self._merge(units, np.array([crc32(u.encode(), start) for u in units], np.uint32))

    def _merge(self, units: list[str], keys) -> list[tuple[int, ...]]:
        """Cuts by each unit's key, plain ones if ``keys`` is None."""
        return self._merged(units, keys).tuples()

    def _merged(self, units: list[str], keys) -> Cuts:
        """The same as arrays. Codes are given without keys only, and none of long units."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        by_length = np.argsort(sizes, kind="stable")
        short = int((sizes <= LONG_UNIT).sum())
        found = []
        for a, b in by_size(sizes[by_length[:short]].tolist(), CELLS):
            rows = by_length[a:b]
            found.append(self._merge_block(list(map(units.__getitem__, rows.tolist())), sizes[rows], None if keys is None else keys[rows]))
        for i in by_length[short:].tolist():
            ids = np.array(self._merge_long(units[i], None if keys is None else keys[i]), np.int32)
            found.append(Cuts(ids, np.array([len(ids)]), np.zeros(0, np.uint32), np.zeros(1, np.int64)))
        return Cuts.joined(found).of(np.argsort(by_length))

    def _merge_long(self, unit: str, key) -> tuple[int, ...]:
        """The same for one long run of letters, by an agenda of candidates."""
        parts = [self.symbol.get(c, -1) for c in unit]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        union_of = dict(zip(self.pairs.tolist(), self.unions.tolist()))
        agenda: list = []

        def consider(i, j):
            union = union_of.get(parts[i] << 32 | parts[j]) if parts[i] >= 0 <= parts[j] else None
            if union is not None:
                heappush(agenda, (int(self.rank[union]), i, parts[i], parts[j], union))

        for i in range(n - 1):
            consider(i, i + 1)
        gone = bytearray(n)
        while agenda:
            _, i, left, right, union = heappop(agenda)
            j = after[i]
            if gone[i] or j >= n or parts[i] != left or parts[j] != right:
                continue
            if key is not None and self.limit and self._skipped(key, self._code(np.array([i], np.uint32), np.array([union])))[0]:
                continue
            parts[i], gone[j] = union, 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                consider(i, after[i])
            if before[i] >= 0:
                consider(before[i], i)
        out: list[int] = []
        for i, part in enumerate(parts):
            if not gone[i]:
                known = 0 <= part < self.n_pieces
                out += [part] if known else [self.byte_id[b] for b in unit[i].encode()]
        return tuple(out)

    def _merge_block(self, units: list[str], lengths: np.ndarray, key) -> Cuts:
        """Units are rows of cells, all rows as wide as the longest unit and an end."""
        n, width = len(units), int(lengths.max()) + 1
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        first, begins = np.arange(n) * width, np.cumsum(lengths) - lengths
        cells = np.arange(len(points)) + np.repeat(first - begins, lengths)
        sym = np.full(n * width, -1, np.int32)
        sym[cells] = self.by_point[points]
        union, rank = np.zeros_like(sym), np.full_like(sym, NEVER)
        # A unit's last symbol has no neighbour.
        inner = np.ones(len(points), bool)
        inner[(begins + lengths - 1)[lengths > 0]] = False
        left = cells[inner]
        row = left // width
        union[left], rank[left] = self._candidates(
            None if key is None else key[row], (left - first[row]).astype(np.uint32), sym[left], sym[left + 1]
        )
        # Symbols stay where they begin and know the cells of their neighbours; -1 in ``sym``
        # is the end, and a cell that a merge has taken.
        after = np.arange(1, n * width + 1)
        before = np.arange(-1, n * width - 1)
        before[first] = -1
        live, by_row, made_codes, steps = np.arange(n), rank.reshape(n, width), [], np.zeros(n, np.int64)
        while len(live):
            at = first[live] + (by_row[live] if len(live) < n else by_row).argmin(1)
            going = rank[at] < NEVER
            live, at = live[going], at[going]
            if not len(live):
                break
            made, gone, start = union[at], after[at], first[live]
            if key is None:
                made_codes.append((live, self._code((at - start).astype(np.uint32), made)))
                steps[live] += 1
            beyond, earlier = after[gone], before[at]
            sym[at], sym[gone], rank[gone] = made, -1, NEVER
            after[at], before[beyond] = beyond, at
            has = earlier >= 0
            left, right = np.concatenate([earlier[has], at]), np.concatenate([at[has], beyond])
            place = left - np.concatenate([start[has], start])
            own = None if key is None else np.concatenate([key[live[has]], key[live]])
            union[left], rank[left] = self._candidates(own, place.astype(np.uint32), sym[left], sym[right])
        used = np.flatnonzero(sym >= 0)
        ids, row = sym[used], used // width
        sizes = np.bincount(row, minlength=n)
        unknown = ids >= self.n_pieces
        if unknown.any():
            # Spelled in UTF-8.
            letters = points[(used - first[row] + begins[row])[unknown]]
            times = np.ones(len(ids), np.int64)
            times[unknown] += (letters > 0x7F).astype(np.int64) + (letters > 0x7FF) + (letters > 0xFFFF)
            ids, spelled = np.repeat(ids, times), np.repeat(unknown, times)
            ids[spelled] = self.byte_ids[np.frombuffer(letters.tobytes().decode("utf-32-le").encode(), np.uint8)]
            sizes = np.bincount(np.repeat(row, times), minlength=n)
        # A unit that is merged at all is merged in every step until its last.
        codes, starts = np.zeros(int(steps.sum()), np.uint32), np.cumsum(steps) - steps
        for step, (rows, code) in enumerate(made_codes):
            codes[starts[rows] + step] = code
        return Cuts(ids, sizes, codes, steps)

    def encode_many(self, texts: list[str], streams: list[int]) -> list[array]:
        ids, ends = self.encode_flat(texts, streams)
        return [array("i", ids[a:b].tobytes()) for a, b in zip(ends, ends[1:])]

    def encode_flat(self, texts: list[str], streams: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their ends with a 0 before them). The mark of a blank itself,
        should a text hold it, goes as bytes, so that it stays apart from a blank when
        decoded."""
        units, counts = [], []
        for text in texts:
            n = len(units)
            for k, run in enumerate(text.split(SPACE) if text else ()):
                if k:
                    units.append("")
                units += self.unit.findall(((SPACE if k == 0 else "") + run).replace(" ", SPACE))
            counts.append(len(units) - n)
        ids, sizes = self._cut(units, np.array(counts, np.int64), streams)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *counts])]
        return ids, ends

    def _cuts(self, runs, streams) -> list[tuple[int, ...]]:
        """The cut of every unit of texts in runs, one after the other."""
        units = [list(chain.from_iterable(of_text)) for of_text in runs]
        ids, sizes = self._cut(list(chain.from_iterable(units)), np.array(list(map(len, units))), streams)
        return Cuts(ids, sizes, ids, sizes).tuples()

    def _cut(self, units: list[str], counts: np.ndarray, streams) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of them each unit has) for units of texts, ``counts`` in each."""
        at = self._numbers(units)
        cuts = self.known
        if self.limit and len(units):
            of_text = np.repeat(np.arange(len(counts)), counts)
            own = at > 0
            before = np.cumsum(own) - own
            begins = np.append(before, 0)[np.cumsum(counts) - counts]
            place = (before - begins[of_text]).astype(np.uint64)
            keys = self._keys(np.array(streams, np.int64).view(np.uint64)[of_text], place) ^ self.salts[at]
            # Long units have no path: they are always drawn.
            n, drawn = cuts.steps[at], self.always[at]
            skipped = np.flatnonzero(self._skipped(np.repeat(keys, n), ragged(cuts.codes, cuts.steps, at)))
            drawn[np.searchsorted(np.cumsum(n), skipped, "right")] = True
            again = np.flatnonzero(drawn)
            new = self._merged(list(map(units.__getitem__, again.tolist())), keys[again])
            cuts = Cuts.joined([cuts, new])
            at[again] = len(self.known.sizes) + np.arange(len(again))
        return ragged(cuts.ids, cuts.sizes, at), cuts.sizes[at]

    def _keys(self, stream, place):
        """32 bits from the seed, a document's stream and the place of a unit in it."""
        x = (stream ^ np.uint64(self.seed * 0xD6E8FEB86659FD93 & (1 << 64) - 1)) + (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))).astype(np.uint32)

    def _numbers(self, units: list[str]) -> np.ndarray:
        """The numbers of units, of which new ones are cut without draws. Of too many the less
        used go: memory is bounded."""
        if len(self.number) >= 2 * self.cache_entries:
            self._forget()
        at = np.fromiter(map(self.number.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            there = list(map(units.__getitem__, missing.tolist()))
            new = sorted(set(there))
            self.known = Cuts.joined([self.known, self._merged(new, None)])
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            at[missing] = np.fromiter(map(self.number.__getitem__, there), np.int64, len(there))
            self.salts = np.append(self.salts, np.array([crc32(u.encode()) for u in new], np.uint32))
            self.always = np.append(self.always, np.array([len(u) > LONG_UNIT for u in new]))
            self.uses = np.append(self.uses, np.zeros(len(new), np.int64))
        self.uses += np.bincount(at, minlength=len(self.uses))
        return at

    def _forget(self) -> None:
        """Keeps the blank and the most used, whose uses count half from then on."""
        order = 1 + np.argsort(-self.uses[1:], kind="stable")
        kept = np.append(0, np.sort(order[: max(self.cache_entries - 1, 0)]))
        names = list(self.number)
        self.number = {names[i]: k for k, i in enumerate(kept.tolist())}
        self.known = self.known.of(kept)
        self.salts, self.always, self.uses = self.salts[kept], self.always[kept], self.uses[kept] // 2

    def encode(self, text: str, stream: int = 0) -> array:
        return self.encode_many([text], [stream])[0]

    def decode(self, ids) -> str:
        return decoded(self.spellings, np.asarray(ids, np.int64), [0, len(ids)])[0]


def spellings_of(model) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): what each id of a model stands for, back to back."""
    spelled = [
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) or model.is_unknown(i)
        else p.replace(SPACE, " ").encode()
        for i, p in enumerate(map(model.id_to_piece, range(model.get_piece_size())))
    ]
    return np.frombuffer(b"".join(spelled), np.uint8), np.cumsum([0, *map(len, spelled)])


def decoded(spellings, ids: np.ndarray, ends) -> list[str]:
    """Texts of consecutive runs of ids; the blank before the first word is no part."""
    letters, offsets = spellings
    lengths = (offsets[1:] - offsets[:-1])[ids]
    stops = np.concatenate([[0], np.cumsum(lengths)])
    flat = letters[np.arange(stops[-1]) + np.repeat(offsets[ids] - stops[:-1], lengths)].tobytes()
    texts = [flat[stops[a] : stops[b]].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
    return [t[1:] if t.startswith(" ") else t for t in texts]


def _encoder(path, dropout, seed):
    def body(batches):
        codec = None
        for whole in batches:
            codec = codec or MergeCodec(path, dropout, seed)
            for batch in slices(whole, "text", BATCH_BYTES):
                ids, ends = codec.encode_flat(strings(batch, "text"), batch.column("stream").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), lists], names=["doc_id", "text", "ids"])
            give_back()

    return body


def encode_pieces(docs: DataFrame, model_path: str, dropout: float = 0.1, seed: int = 42) -> DataFrame:
    """``doc_id, text, ids`` for every row; one narrow pass.

    NULL and empty texts have no pieces. A row's draws depend on the seed, its id, its
    words and their places: repeated rows are cut alike, rows with a NULL id share one
    stream. Of other columns nothing is read. ``model_path`` is a file every executor has.
    """
    stream = F.xxhash64(F.lit(seed), F.col("doc_id").cast("bigint")).alias("stream")
    rows = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"), stream)
    return rows.mapInArrow(_encoder(model_path, dropout, seed), "doc_id bigint, text string, ids array<int>")


def _decoder(path):
    def body(batches):
        import sentencepiece

        spellings = None
        for whole in batches:
            spellings = spellings or spellings_of(sentencepiece.SentencePieceProcessor(model_file=path))
            for batch in slices(whole, "ids", BATCH_IDS):
                lists = batch.column("ids")
                ends = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(np.int64)
                texts = decoded(spellings, ids, (ends - ends[0]).tolist())
                names = [n for n in batch.schema.names if n != "ids"]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(texts, pa.string())], names=[*names, "decoded"])
            give_back()

    return body


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """``ids`` back to text, as column ``decoded`` in its place; other columns stay, but
    for one of that name.

    NULL or no ids give ''. Control and unknown ids stand for nothing.
    """
    encoded = encoded.drop("decoded")
    rows = encoded.withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "ids"]
    return rows.mapInArrow(_decoder(model_path), ", ".join([*fields, "decoded string"]))
