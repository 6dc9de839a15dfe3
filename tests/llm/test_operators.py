"""Each operator on small inputs: brute force, round trips and the awkward rows."""

import re
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eddyline.llm import queries as q
from eddyline.session import fresh_folder

BPE, PIECES = q.vocabulary(q.BYTE_BPE), q.vocabulary(q.PIECE_BPE)


def pairs(df, key, value):
    return sorted(((r[key], r[value]) for r in df.collect()), key=str)


def test_tables_of_large_rows_have_small_pages(spark):
    from eddyline.llm.common import prepare, written

    prepare(spark)
    rows = written(spark.range(64, numPartitions=1).select(F.expr("repeat(sha2(string(id), 512), 2048)").alias("bytes")), "large-rows")
    parquet, hadoop = spark._jvm.org.apache.parquet.hadoop, spark._jvm.org.apache.hadoop
    file = hadoop.fs.Path(rows.inputFiles()[0])
    reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(file, spark._jsc.hadoopConfiguration()))
    pages = reader.readOffsetIndex(reader.getFooter().getBlocks().get(0).getColumns().get(0)).getPageCount()
    reader.close()
    assert pages >= 8 and int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 64


# -- 1: token counts


def test_counts_are_stored_once_and_reused(spark, odd, nothing):
    from tokenizers import Tokenizer

    from eddyline.llm.token_counts import count_tokens, stored_counts, tokenizer_digest

    cache = fresh_folder(spark, "cache")
    first = count_tokens(odd, BPE, cache)
    tokenizer = Tokenizer.from_file(BPE)
    expected = [(r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect()]
    assert pairs(first, "doc_id", "n_tokens") == sorted(expected, key=str)
    path = f"{cache}/tokenizer={tokenizer_digest(BPE)}"
    rows = spark.read.parquet(path).count()
    assert pairs(count_tokens(odd, BPE, cache), "doc_id", "n_tokens") == sorted(expected, key=str)
    assert spark.read.parquet(path).count() == rows  # nothing was encoded again
    assert stored_counts(spark, cache, "another").count() == 0
    assert count_tokens(nothing, BPE, cache).count() == 0


def test_long_texts_are_counted_in_pieces():
    from eddyline.llm import token_counts as t

    counter = t.JsonCounter(BPE)
    text = ("It's 12 o'clock,\n\n  so: go!  <|endoftext|> \t x\n" * 600)
    whole = len(counter.tokenizer.encode(text, add_special_tokens=False).ids)
    was, t.LONG_TEXT = t.LONG_TEXT, 1000
    try:
        assert len(counter._pieces(text)) > 10 and counter.counts([text, ""]) == [whole, 0]
    finally:
        t.LONG_TEXT = was


def test_words_met_before_are_not_encoded_again():
    from eddyline.llm import token_counts as t

    class Seen:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, []

        def encode_batch_fast(self, texts, **options):
            self.texts += texts
            return self.tokenizer.encode_batch_fast(texts, **options)

    counter = t.JsonCounter(BPE)
    counter.tokenizer = seen = Seen(counter.tokenizer)
    texts = ["one word, one more word. " * 50, "x" * 200]
    assert counter.counts(texts) == counter._encoded(texts)
    seen.texts.clear()
    counter.counts(texts)
    assert seen.texts == ["x" * 200]  # too long to be kept


def test_counts_add_up_over_units():
    import random

    from eddyline.llm import token_counts as t

    counter, draw = t.JsonCounter(BPE), random.Random(5)
    some = [*"ab'Z09.,;:!?  \n\n\t\r\x0b\x1c\x85\xa0\u2003\u3000é\u0301中²½_<|>()ªº×\u200b\u0600", "'s", "'ll", "<|endoftext|>", "<|end", " the"]
    texts = ["".join(draw.choices(some, k=draw.randrange(60))) for _ in range(4000)]
    assert counter.splits and counter.counts(texts) == counter._encoded(texts)
    assert all("".join(t.UNIT.findall(x)) == x for x in texts)
    stripping = {"content": "<|x|>", "lstrip": True, "rstrip": False}
    before = {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False}
    assert not t._splits({"pre_tokenizer": before, "normalizer": None, "model": {}, "added_tokens": [stripping]})


def test_model_files_are_counted_by_their_library(spark, odd):
    import sentencepiece

    from eddyline.llm.token_counts import count_tokens

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = [(r.doc_id, len(model.encode(r.text or ""))) for r in odd.collect()]
    found = count_tokens(odd, PIECES, fresh_folder(spark, "cache"))
    assert pairs(found, "doc_id", "n_tokens") == sorted(expected, key=str)


# -- 2: line dedup


def brute_lines(docs, min_docs=3, min_chars=20):
    holders = {}
    for i, text in docs.items():
        for line in (text or "").split("\n"):
            key = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add(i)
    out = {}
    for i, text in docs.items():
        kept = []
        for line in (text or "").split("\n"):
            key = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
            held = holders.get(key, ())
            if len(held) < min_docs or max(held) == i:
                kept.append(line)
        out[i] = "\n".join(kept)
    return out


def test_line_index_is_reversible(spark):
    from eddyline.llm.line_dedup import LineIndex

    shared = ["A line that many documents share.", "another line shared by some of them", "É capital outside ASCII stays apart"]
    docs = {i: "\n".join([f"own line number {i} of this text", *[("  " + s.upper() if i % 2 else s) for s in shared[: i % 4]], "short"]) for i in range(12)}
    frame = lambda d: spark.createDataFrame(sorted(d.items()), "doc_id bigint, text string")
    text_of = lambda index, d: {r.doc_id: r.text for r in index.dedupe(frame(d)).collect()}
    index = LineIndex(spark, fresh_folder(spark, "lines"), keys_per_shard=1)
    first = {i: t for i, t in docs.items() if i < 5}
    second = {i: t for i, t in docs.items() if i >= 5}
    index.insert(frame(first))
    assert text_of(index, first) == brute_lines(first)
    counts = sorted(map(tuple, index.counts().collect()))
    index.insert(frame(second))
    assert text_of(index, docs) == brute_lines(docs)
    index.delete(frame(second))
    assert text_of(index, first) == brute_lines(first)
    assert sorted(map(tuple, index.counts().collect())) == counts
    index.delete(frame(first))
    assert index.counts().count() == 0 and text_of(index, first) == first


def test_line_index_survives_repeated_inserts_and_restarts(spark):
    from eddyline.llm.line_dedup import LineIndex

    line = "a line that is long enough to count"
    frame = lambda *ids: spark.createDataFrame([(i, f"{line}\nown line of document number {i}") for i in ids], "doc_id bigint, text string")
    shown = lambda index: sorted((r.doc_id, r.n_dropped) for r in index.dedupe(frame(1, 2, 3)).collect())
    folder = fresh_folder(spark, "again")
    index = LineIndex(spark, folder)
    index.insert(frame(1, 2))
    index.insert(frame(2))  # a retried batch: two documents hold the line, not three
    assert shown(index) == [(1, 0), (2, 0), (3, 0)]
    again = LineIndex(spark, folder)
    assert sorted(map(tuple, again.counts().collect())) == sorted(map(tuple, index.counts().collect()))
    again.insert(frame(3))
    assert shown(again) == [(1, 1), (2, 1), (3, 0)] == shown(LineIndex(spark, folder))
    third = LineIndex(spark, folder)
    third.delete(frame(2))
    third.delete(frame(2))
    assert shown(LineIndex(spark, folder)) == [(1, 0), (2, 0), (3, 0)] and third.counts().filter("n_docs > 2").count() == 0
    third.insert(frame(2))
    # A change that was cut off before its state was written has not happened.
    spark.range(3).selectExpr("id AS hi", "id AS lo", "id AS doc_id", "1 AS delta").write.parquet(f"{folder}/references/change={third.changes}")
    assert shown(LineIndex(spark, folder)) == [(1, 1), (2, 1), (3, 0)]


def test_each_distinct_text_is_encoded_once(spark):
    from eddyline.llm.queries import BYTE_BPE, vocabulary
    from eddyline.llm.token_counts import count_tokens

    rows = [(7, "same text")] * 40 + [(None, "text of rows without an id")] * 30 + [(None, "same text")] * 5 + [(k % 3, "another") for k in range(20)]
    cache = fresh_folder(spark, "cache")
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert count_tokens(table, vocabulary(BYTE_BPE), cache).count() == len(rows)
    assert spark.read.parquet(cache).count() == 3


def test_line_index_on_awkward_rows(spark, odd, nothing):
    from eddyline.llm.line_dedup import LineIndex

    index = LineIndex(spark, fresh_folder(spark, "lines"), min_docs=2, min_chars=1)
    index.insert(odd)
    found = index.dedupe(odd, ("mark",)).collect()
    assert len(found) == odd.count() and {r.mark for r in found} == {"x"}
    assert {r.n_lines for r in found if r.doc_id in (1, 2)} == {1}
    empty = LineIndex(spark, fresh_folder(spark, "lines"))
    empty.insert(nothing)
    assert empty.dedupe(nothing).count() == 0
    assert [r.text for r in empty.dedupe(odd.filter("doc_id = 4")).collect()] == ["one"]


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.data())
def test_cuckoo_filter(keys, data):
    from eddyline.llm.cuckoo import CuckooFilter, built

    keys = sorted(keys)
    gone = data.draw(st.sets(st.sampled_from(keys)))
    kept = np.array([k for k in keys if k not in gone], np.uint64)
    filled = built(np.array(keys, np.uint64))
    assert filled.contains(np.array(keys, np.uint64)).all()
    filled.delete(np.array(sorted(gone), np.uint64))
    again = CuckooFilter.from_bytes(filled.to_bytes())
    assert again.contains(kept).all()
    assert (again.table != 0).sum() == len(kept)


# -- 3: pieces


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80), st.integers(0, 5))
def test_pieces_round_trip(text, stream):
    codec = _codec(0.3)
    assert codec.decode(codec.encode(text, stream)) == text


def _codec(dropout, cache={}):
    from eddyline.llm.piece_codec import MergeCodec

    if dropout not in cache:
        cache[dropout] = MergeCodec(PIECES, dropout, 42, 2)
    return cache[dropout]


@settings(max_examples=60, deadline=None)
@given(st.text(st.characters(exclude_characters="▁\x00", exclude_categories=["Cs"]), max_size=60))
def test_pieces_without_dropout_are_the_librarys(text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert list(_codec(0.0).encode(text)) == model.encode(text)


def test_merge_agenda_by_hand():
    """The array form against an agenda worked off one candidate at a time."""
    from heapq import heapify, heappop, heappush
    from zlib import crc32

    codec = _codec(0.3)
    scores = {p: codec.rank[i] for p, i in codec.symbol.items() if i < codec.n_pieces}

    def skipped(key, place, size):
        x = (key ^ ((place * 0x9E3779B1 + size * 0x85EBCA77) & 0xFFFFFFFF)) & 0xFFFFFFFF
        x = ((x ^ x >> 16) * 0x7FEB352D) & 0xFFFFFFFF
        x = ((x ^ x >> 15) * 0x846CA68B) & 0xFFFFFFFF
        return (x ^ x >> 16) < codec.limit

    def agenda(unit, variant):
        key = crc32(unit.encode(), (codec.seed * 0x9E3779B1 + variant * 0xC2B2AE35) & 0xFFFFFFFF)
        parts = {i: c for i, c in enumerate(unit)}
        todo = [(scores[unit[i : i + 2]], i, unit[i : i + 2]) for i in range(len(unit) - 1) if unit[i : i + 2] in scores]
        heapify(todo)
        while todo:
            _, i, union = heappop(todo)
            j = i + len(parts.get(i, ""))
            if i not in parts or j not in parts or parts[i] + parts[j] != union or skipped(key, i, len(union)):
                continue
            del parts[j]
            parts[i] = union
            after = i + len(union)
            before = max((k for k in parts if k < i), default=None)
            for a, b in ((i, after), (before, i)):
                if a is not None and b in parts and parts[a] + parts[b] in scores:
                    heappush(todo, (scores[parts[a] + parts[b]], a, parts[a] + parts[b]))
        return [parts[i] for i in sorted(parts)]

    units = ["▁thinking", "▁wonderfully", "entgegengesetzt", "▁a", "▁▁▁▁the", "internationalization"]
    varied = set()
    for variant in (0, 1):
        for unit, cut in zip(units, codec.merge(units, variant)):
            expected = agenda(unit, variant)
            assert list(cut) == [codec.symbol[p] for p in expected]
            varied.add(tuple(expected))
    assert len(varied) > len(units)


def test_long_runs_of_letters():
    """The agenda and the array form agree, and one long run takes no square time."""
    from eddyline.llm import piece_codec as p

    run = "".join(np.random.default_rng(4).choice(list("etaoinshrdlué日"), 400))
    for dropout in (0.0, 0.3):
        codec = _codec(dropout)
        by_array = codec.merge([run], 1)
        was, p.LONG_UNIT = p.LONG_UNIT, 10
        try:
            assert codec.merge([run], 1) == by_array
        finally:
            p.LONG_UNIT = was
        assert codec.decode(codec.encode(run * 100)) == run * 100


def test_draws_of_every_document_and_place():
    """Words differ from document to document and place to place, at the rate dropout says,
    and the kept plain cuts change no result."""
    codec, plain = _codec(0.3), _codec(0.0)
    text = "internationalization is thinking wonderfully " * 5 + "of things"
    cuts = [tuple(codec.encode(text, stream)) for stream in range(300)]
    assert len(set(cuts)) > 290 and cuts == [tuple(c) for c in codec.encode_many([text] * 300, list(range(300)))]
    units = codec.unit.findall("▁" + text.replace(" ", "▁"))
    drawn = [codec._cuts([[units]], [stream]) for stream in range(300)]
    for place in (0, 4):
        assert len({cut[place] for cut in drawn}) > 20
    assert sum(cut[0] != cut[4] for cut in drawn) > 200
    unit = "▁of"
    union, n = codec.symbol[unit], sum(1 for cut in drawn if cut[units.index(unit)] == (codec.symbol[unit],))
    # The whole word is kept, and not both of the ways to it are skipped.
    assert plain.encode("of").tolist() == [union] and abs(n / 300 - 0.7 * (1 - 0.3**2)) < 0.1
    place = units.index("▁thinking")
    stream = np.arange(300, dtype=np.uint64)
    from zlib import crc32

    keys = codec._keys(stream, np.full(300, place, np.uint64)) ^ np.uint32(crc32("▁thinking".encode()))
    assert codec._merge(["▁thinking"] * 300, keys) == [cut[place] for cut in drawn]


def test_known_words_take_no_python_call_each():
    """Words met before are looked up, drawn and put together as arrays; and a cache that
    forgets changes no cut and stays bounded."""
    import cProfile
    import pstats

    from eddyline.llm.piece_codec import MergeCodec

    codec, small = MergeCodec(PIECES, 0.1, 42), MergeCodec(PIECES, 0.1, 42, 50)
    words = ["".join(w) for w in np.random.default_rng(3).choice(list("etaoinshrdlu"), (4000, 7))]
    texts = [" ".join(words[a : a + 1000]) + " é ▁ 日本 😀" for a in range(0, 4000, 1000)]
    first = codec.encode_many(texts, [1, 2, 3, 4])
    profile = cProfile.Profile()
    again = profile.runcall(codec.encode_many, texts, [1, 2, 3, 4])
    assert again == first and pstats.Stats(profile).total_calls < 4000
    one_by_one = [small.encode(text, stream) for stream, text in enumerate(texts, 1)]
    assert one_by_one == first and len(small.number) <= 100 + 1004
    assert [codec.decode(ids) for ids in first] == texts


def test_copies_under_other_ids_are_cut_anew(spark):
    from eddyline.llm.piece_codec import encode_pieces

    copies = spark.range(200).selectExpr("id as doc_id", "'an ordinary sentence about internationalization' as text")
    assert encode_pieces(copies, PIECES).select("ids").distinct().count() > 20


def test_pieces_on_awkward_rows(spark, odd, nothing):
    from eddyline.llm.piece_codec import decode_pieces, encode_pieces

    encoded = encode_pieces(odd, PIECES)
    back = decode_pieces(encoded.withColumn("decoded", F.lit("old")), PIECES).collect()
    assert len(back) == odd.count() and all(r.text == r.decoded for r in back)
    again = encode_pieces(odd.repartition(3), PIECES)
    assert pairs(encoded, "doc_id", "ids") == pairs(again, "doc_id", "ids")
    other = encode_pieces(odd, PIECES, seed=7)
    assert pairs(encoded, "doc_id", "ids") != pairs(other, "doc_id", "ids")
    assert decode_pieces(encode_pieces(nothing, PIECES), PIECES).count() == 0


def test_pair_lookup_finds_what_the_sorted_table_holds():
    """Pairs whose hashes meet are looked up in the sorted table; none is lost or made up."""
    from eddyline.llm.piece_codec import NEVER, MergeCodec

    codec = MergeCodec(PIECES, 0.0, 42)
    left, right = (codec.pairs >> 32).astype(np.int32), (codec.pairs & 0xFFFFFFFF).astype(np.int32)
    assert (codec.slots[codec._slot(left, right)] < 0).any()
    union, rank = codec._candidates(None, np.zeros(len(left), np.uint32), left, right)
    assert np.array_equal(union, codec.unions) and np.array_equal(rank, codec.rank[codec.unions]) and (rank < NEVER).any()
    known = set(codec.pairs.tolist())
    other = np.array([not (int(a) << 32 | int(b)) in known for a, b in zip(right, left)])
    assert (codec._candidates(None, np.zeros(other.sum(), np.uint32), right[other], left[other])[1] == NEVER).all()
    # No place of a pair, and the one code of all characters outside the vocabulary.
    assert codec._candidates(None, np.zeros(2, np.uint32), np.array([-1, int(codec.by_point[0x10FFFF])]), np.array([5, 5]))[1].tolist() == [NEVER, NEVER]


# -- 4, 5: classifiers


@pytest.mark.parametrize("build", ["toxicity", "quality"])
def test_classifiers_on_awkward_rows(spark, odd, nothing, labels, build):
    from eddyline.llm.fm_quality import score_quality
    from eddyline.llm.toxicity import score_toxicity

    score = score_toxicity if build == "toxicity" else score_quality
    for known in (labels, labels.limit(0)):
        found = score(odd, known).collect()
        assert len(found) == odd.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
        assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1
        assert len({r.score for r in found if r.doc_id == 5}) == 1
    assert score(nothing, labels).count() == 0


def test_factor_machine_sum_of_squares():
    from eddyline.llm import fm_quality as f

    rng = np.random.default_rng(0)
    model = f.FactorMachine(0.3, rng.standard_normal(f.WIDTH).astype(np.float32), rng.standard_normal((f.WIDTH, 4)).astype(np.float32))
    slots, values = f.inputs(["Some WORDS, and words | again 12"])[0]
    direct = 0.3 + (model.weights[slots] * values).sum()
    for i in range(len(slots)):
        for j in range(i):
            direct += model.factors[slots[i]] @ model.factors[slots[j]] * values[i] * values[j]
    assert model.logits(slots, values, np.array([0]))[0] == pytest.approx(direct, rel=1e-4)


@pytest.mark.parametrize("build", ["toxicity", "quality"])
def test_classifiers_are_fitted_on_every_labelled_row(spark, build, monkeypatch):
    """More rows than any sample was bounded to, repeated ones once; the model does not
    depend on how the tables are dealt."""
    from eddyline.llm import training
    from eddyline.llm.fm_quality import fit_quality
    from eddyline.llm.toxicity import fit_toxicity

    monkeypatch.setattr(training, "SHARD_ROWS", 1000)
    label, fold, folds = ("toxic", 0, 5) if build == "toxicity" else ("quality", 1, 3)
    rows = [(i, "vile nasty words of a toxic row" if i % 4 == 0 else "calm and friendly talk about rivers") for i in range(9600)]
    docs = spark.createDataFrame([*rows, *rows[:50]], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(9600)], f"doc_id bigint, {label} int")
    known, _ = training.labelled(docs, marks, label, folds, fold)
    seen = []
    real = training.totals
    module = sys.modules["eddyline.llm." + ("toxicity" if build == "toxicity" else "fm_quality")]
    monkeypatch.setattr(module, "totals", lambda packs: seen.append((real(packs), packs.select("shard").distinct().count())) or seen[-1][0])
    fit = fit_toxicity if build == "toxicity" else fit_quality
    first, second = fit(docs, marks), fit(docs.repartition(3), marks.repartition(5))
    wanted = [i for i in range(9600) if zlib.crc32(str(i).encode()) % folds != fold]
    assert known.select("doc_id").distinct().count() == len(wanted) > 6000
    (n, ones), shards = seen[0]
    assert (n, ones) == (len(wanted), sum(i % 4 == 0 for i in wanted)) and shards == -(-len(wanted) // 1000)
    held = first.embeddings if build == "toxicity" else first.factors
    assert np.array_equal(held, second.embeddings if build == "toxicity" else second.factors)


def test_toxicity_multiplies_its_embeddings_once_for_all_packs(monkeypatch):
    """A task that counts the calibrating texts makes the taps once, however many packs it
    has, and the logits are those of each pack by itself."""
    import pyarrow as pa

    from eddyline.llm import toxicity as t

    hashes = t.word_hashes([f"some words {i} of a pack" for i in range(30)])
    model, _ = t.start(np.unique(np.concatenate([h.reshape(-1) for h in hashes])), 0.3)
    packs = []
    for k in range(3):
        own = hashes[10 * k : 10 * k + 10]
        flat = [np.zeros(10, np.int32), np.array([h.size for h in own], np.int32), np.concatenate([h.reshape(-1) for h in own])]
        packs.append(pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), *(pa.array([f.tobytes()]) for f in flat)], names=["shard", "targets", "sizes", "words"]))
    calls, real = [], t.TextFilters.taps
    monkeypatch.setattr(t.TextFilters, "taps", lambda self: calls.append(1) or real(self))
    found = [x for b in t._binned(model)(iter(packs)) for x in b.column("logit").to_pylist()]
    assert len(calls) == 1 and len(found) == 6
    alone = [x for p in packs for b in t._binned(model)(iter([p])) for x in b.column("logit").to_pylist()]
    assert found == alone and not list(t._binned(model)(iter([])))


def test_word_hashes_do_not_depend_on_the_place():
    from eddyline.llm.wordhash import words_of

    texts = ["alpha beta", "", "beta", "x alpha"]
    hashes, _, counts = words_of(texts)
    assert counts.tolist() == [2, 0, 1, 2]
    assert hashes[1] == hashes[2] and hashes[0] == hashes[4] and len(set(hashes.tolist())) == 3


# -- 6: SimHash


def test_links_in_dense_groups_lose_no_component(spark):
    from eddyline.llm.components import smallest_reachable
    from eddyline.llm.simhash import class_links

    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 6, dtype=np.int64)
    marks = {int(c) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 6), replace=False)) for c in centres for _ in range(60)}
    classes = [(m, i) for i, m in enumerate(sorted(marks))]
    links = class_links(spark.createDataFrame(classes, "mark bigint, doc_id bigint"))
    found = {r.node: r.component for r in smallest_reachable(links).collect()}
    assert links.count() < 12 * len(classes)
    group = {i: i for _, i in classes}
    for m, i in classes:
        for n, j in classes:
            if (m ^ n).bit_count() <= 4 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert {i: found.get(i, i) for i in group} == group


def test_components_of_a_long_chain(spark):
    from eddyline.llm.components import smallest_reachable

    chain = [(i, i + 1) for i in range(200)] + [(500, 300), (500, 500), (300, 400)]
    found = {r.node: r.component for r in smallest_reachable(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert all(found[i] == 0 for i in range(201)) and {found[i] for i in (300, 400, 500)} == {300}
    assert smallest_reachable(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_simhash_on_awkward_rows(spark, odd, nothing):
    from eddyline.llm.simhash import near_duplicates

    found = near_duplicates(odd).collect()
    assert len(found) == odd.count()
    blank = [r for r in found if r.mark == 0]
    assert len(blank) == 4 and {r.component_id for r in blank} == {1}
    assert near_duplicates(nothing).count() == 0


# -- 7: edit embedding


def test_neighbours_on_awkward_rows(spark, odd, nothing):
    from eddyline.llm.edit_embedding import compare_with_next

    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd.collect()))
    texts = [t for _, _, t in rows]
    expected = []
    for a, b in zip(texts, texts[1:] + texts[:1]):
        expected.append(a[: len(a) - len(a) // 4] + b[: len(a) // 4])
    import hashlib

    digests = sorted(hashlib.sha256(e.encode()).hexdigest() for e in expected)
    for pieces in (1, 4, 50):
        found = compare_with_next(odd, pieces).collect()
        assert sorted(r.edited_sha256 for r in found) == digests
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert compare_with_next(nothing).count() == 0
    alone = compare_with_next(odd.filter("doc_id = 4")).first()
    assert alone.near_next == 1.0 and alone.n_chars == 3


def test_walk_step_by_step():
    from eddyline.llm import edit_embedding as e

    one = lambda v, k: int(e._mix(np.array([v], np.uint64), e.SEED + k)[0])
    for text in ("", "a", "A longer text, read step by step. " * 40):
        level = e.level_of(len(text))
        sampled, bits, i, j = set(e.sampled_steps(level).tolist()), [], 0, 0
        kinds = [one(ord(c), 0) & (e.KINDS - 1) for c in text]
        while i < len(text):
            if j in sampled:
                bits.append(one(j, 2) >> kinds[i] & 1)
            i += one(j % e.PERIOD, 1) >> kinds[i] & 1
            j += 1
        assert e.fingerprints([text]) == [f"{level:x}:{len(bits):x}:{np.packbits(np.array(bits, np.uint8)).tobytes().hex()}"]


def test_short_texts_keep_every_step_and_walks_are_read_to_their_end():
    from itertools import product

    from eddyline.llm import edit_embedding as e

    short = ["".join(t) for t in product("abcdef", repeat=4)]
    assert len(set(e.fingerprints(short))) > 60
    assert all(int(m.split(":")[1], 16) >= 4 for m in e.fingerprints(short))
    assert not set(e.fingerprints([c for c in "abcdefgh"])) & set(e.fingerprints([""]))
    walk, beyond = e._walk(e.SEED), 0
    for c in map(chr, range(97, 123)):
        text = c * 1023
        level, bits = walk.bits(text + "a")
        steps, state = 0, walk.first
        for kind in walk.kind_of[[*map(ord, text + "a")]].tolist():
            after = state[kind]
            steps, state = steps + (after[e.KINDS] - state[e.KINDS] - 1) % e.PERIOD + 1, after
        beyond += steps > 2048
        assert len(bits) == (e.sampled_steps(level) < steps).sum() and e.sampled_steps(level + 1)[-1] >= steps
        assert e.BITS << (level - e.LOWEST) >= steps
    assert beyond


def test_edited_pairs(spark, odd, nothing):
    from eddyline.llm.edit_embedding import edited_pairs

    rng = np.random.default_rng(3)
    words = lambda n: " ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(n))
    texts = [words(120) for _ in range(12)]
    rows = list(enumerate(texts)) + [(100 + i, t[:-40] + words(4)) for i, t in enumerate(texts)] + [(200, texts[0])]
    found = {(r.a, r.b) for r in edited_pairs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {(i, 100 + i) for i in range(12)} == found
    assert all(r.likeness >= 0.8 for r in edited_pairs(odd).collect()) and edited_pairs(nothing).count() == 0


def test_pairs_beside_a_smaller_class_of_their_bucket(spark):
    """Alike texts are linked though texts of smaller ids, less alike, share their bands."""
    from eddyline.llm.edit_embedding import edited_pairs, fingerprints, likeness

    rng = np.random.default_rng(11)
    words = lambda n: " ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(n))
    base = words(120)
    pair = [base, base[:-30] + words(4)]
    ends = fingerprints(pair)
    decoys = [base[: len(base) * 6 // 10] + words(48) for _ in range(500)]
    decoys = [t for t, m in zip(decoys, fingerprints(decoys)) if all(likeness(m, e) < 0.8 for e in ends)]
    rows = list(enumerate(decoys)) + [(900, pair[0]), (901, pair[1])]
    marks = dict(zip((i for i, _ in rows), fingerprints([t for _, t in rows])))
    assert likeness(*ends) >= 0.8 and len(decoys) > 450
    found = {(r.a, r.b): r.likeness for r in edited_pairs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (900, 901) in found
    assert all(x == likeness(marks[a], marks[b]) >= 0.8 for (a, b), x in found.items())


# -- 8: WARC


def capture(record_id, kind, url, ts, **headers):
    return (record_id, kind, 200 if kind == "response" else 304, url, ts, {k.replace("_", "-"): v for k, v in headers.items()})


CAPTURES = "record_id bigint, warc_type string, status int, url string, ts bigint, headers map<string,string>"


def test_revisits_by_hand(spark):
    from eddyline.llm.warc_revisits import resolve_revisits

    rows = [
        capture(1, "response", "http://WWW.Site.org:80/a/?utm_source=x&b=2&a=1#f", 100, etag='"1"', last_modified="m", content_length="5", server="s"),
        capture(2, "response", "https://site.org/a?a=1&b=2", 100, etag='"2"', content_length="6"),
        capture(3, "revisit", "site:80", 150), capture(4, "revisit", "https://site.org/a?b=2&a=1", 100, etag='"2"'),
        capture(5, "revisit", "https://site.org/a.html?b=2&a=1", 10**7, etag='W/"2"', content_length="0", server="new"),
        capture(6, "revisit", "https://site.org/a?b=2&a=1", 200, etag='"1"'), capture(7, "revisit", "https://site.org/a?b=2&a=1", 300),
        capture(8, "revisit", None, 300), capture(9, "revisit", "https://site.org/a?b=2&a=1", None), (10, None, None, None, None, None),
        (11, "revisit", 304, "https://site.org/a?b=2&a=1", 400, None),
    ]
    found = {r.record_id: r for r in resolve_revisits(spark.createDataFrame(rows, CAPTURES)).collect()}
    seen = {i: (r.outcome, r.original_id) for i, r in found.items()}
    assert seen == {
        3: ("no_original", None), 4: ("no_original", None), 5: ("resolved", 2), 6: ("stale", 2), 7: ("resolved", 2),
        8: ("no_original", None), 9: ("no_original", None), 11: ("resolved", 2),
    }
    assert found[5].headers == {"etag": 'W/"2"', "content-length": "6", "server": "new"} and found[6].headers is None
    assert resolve_revisits(spark.createDataFrame([], CAPTURES)).count() == 0


def test_a_busy_url_over_many_spans(spark):
    from eddyline.llm.warc_revisits import resolve_revisits

    rng = np.random.default_rng(1)
    times = rng.choice(100_000, 400, replace=False).tolist()
    rows = [capture(i, "response" if i % 5 == 0 else "revisit", "http://a.org/", t) for i, t in enumerate(times)]
    found = {r.record_id: r.original_id for r in resolve_revisits(spark.createDataFrame(rows, CAPTURES), span=500).collect()}
    full = sorted((t, i) for i, t in enumerate(times) if i % 5 == 0)
    for i, t in enumerate(times):
        if i % 5:
            assert found[i] == max(((u, j) for u, j in full if u < t), default=(None, None))[1]


# -- 9: hosts


def test_rules_and_hosts(spark):
    from eddyline.llm.host_reputation import judge

    urls = {
        1: "http://x.Com/", 2: "http://www.example.com/en/1", 3: "http://a.example.com/en/1", 4: "http://aexample.com/en/1", 5: "http://n.net/es/",
        6: "http://n.net/fr", 7: None, 8: "no scheme", 9: "http://x.com?q=/", 10: "http://a.org/?://b.com/", 11: "://com/#x", 12: "http://bad.org:80/x", 13: "http://bad.org:80/y",
    }
    pages = spark.createDataFrame([(i, u, "c") for i, u in urls.items()], "page_id bigint, url string, verdict string")
    outcomes = spark.createDataFrame([("bad.org:80", 1)] * 40 + [("a.org", 0)] * 60 + [(None, 1), ("a.org", None), ("", 1)], "host string, bad int")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(pages, outcomes).collect()}
    assert found[1] == ("x.com", "/", "com/", "allow") and found[2][2:] == ("www.example.com/en/", "allow")
    assert found[3][2:] == ("example.com/en/", "block") and found[4][2:] == ("com/", "allow") and found[5][2:] == ("net/es/", "block")
    assert found[6] == ("n.net", "/fr", None, "allow") and found[7] == found[8] == ("", "", None, "allow")
    assert found[9] == ("x.com", "", None, "allow") and found[10] == ("a.org", "/", None, "allow") and found[11][:3] == ("com", "/", "com/")
    assert found[12][3] == found[13][3] == "block"
    assert {r.verdict for r in judge(pages.filter("page_id > 11"), outcomes.limit(0)).collect()} == {"allow"}
    assert judge(pages.limit(0), outcomes).count() == 0


# -- 10: benchmark


def test_leaks_by_brute_force(spark, odd, nothing):
    from eddyline.llm.decontamination import leaks

    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(300)]
    say = lambda n: [vocabulary[i] for i in rng.integers(0, 300, n)]
    items = {i: say(int(n)) for i, n in enumerate(rng.integers(5, 60, 25))} | {90: ["two", "words"], 91: []}
    docs = {}
    for i in range(60):
        words, item = say(200), list(items[i % 25])
        for k in range(i % 4):
            item[int(rng.integers(len(item)))] = "changed"
        words[50:50] = item if i % 3 else item[: len(item) // 2]
        docs[i] = " ".join(w.upper() if i % 2 else w + "," for w in words)
    docs |= {100: "Two words!", 101: None, 102: "two words more"}
    gram = lambda t: {tuple(w[k : k + 5]) for w in [re.findall(r"[^\W_]+", (t or "").lower())] for k in range(max(len(w) - 4, 1))} - {()}
    expected = set()
    for d, text in docs.items():
        for i, item in items.items():
            own = gram(" ".join(item))
            if own and len(own & gram(text)) >= 0.8 * len(own) - 1e-9:
                expected.add((d, i))
    of_docs = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    of_items = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(None, "x"), (92, None)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in leaks(of_docs, of_items).collect()}
    assert found == expected and len(found) > 20
    assert leaks(odd, of_items).count() == 0 and leaks(nothing, of_items).count() == 0 and leaks(of_docs, of_items.limit(0)).count() == 0
    itself = odd.select(F.col("doc_id").alias("item_id"), "text")
    assert {(5, 5), (6, 6), (4, 4)} <= {(r.doc_id, r.item_id) for r in leaks(odd, itself).collect()}


def test_native_operators_run_no_python(spark):
    from eddyline.llm.decontamination import leaks
    from eddyline.llm.host_reputation import judge

    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id bigint, text string")
    for df in (judge(pages, spark.createDataFrame([("a.org", 1)], "host string, bad int")), leaks(docs, docs.withColumnRenamed("doc_id", "item_id"))):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|InArrow|Cartesian|BroadcastNestedLoop", plan)


def test_the_decoder_is_not_given_the_texts(spark, odd):
    from eddyline.llm.queries import piece_digests

    found = piece_digests(odd)
    assert all(r.lossless for r in found.collect())
    plan = [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "MapInArrow" in line]
    assert len(plan) == 2 and "text#" not in plan[0]
