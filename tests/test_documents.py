import numpy as np
import pytest
from pyspark.sql import functions as F

from eddyline.functions.encoders import md5_encoder
from eddyline.operators import quality
from eddyline.operators.encoder import encode_texts, split_encode_errors
from eddyline.operators.sets import union_batches
from eddyline.operators.tfidf import svd_vectors, term_weights
from eddyline.schemas import DLQ_STATE, DOCUMENT
from eddyline.session import fresh_folder
from eddyline.sinks.json_files import write_json
from eddyline.sources.documents import list_files, pending_files, read_documents
from eddyline.sources.kafka import dead_letter_records, kafka_options


def contents(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, content string")


def test_content_filters_at_the_edges(spark):
    df = contents(spark, None, "", " ", "  ", "x" * 10, "x" * 11)
    ids = lambda condition: [r.id for r in df.filter(condition).orderBy("id").collect()]
    assert ids(quality.has_content()) == [3, 4, 5]
    assert ids(quality.has_long_content()) == [5]


def test_quality_counts_ride_on_a_write(spark):
    from pyspark.sql import Observation

    df, seen = contents(spark, None, "", " ", "  ", "x" * 10, "x" * 11), Observation()
    quality.observe_quality(df, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == quality.quality_counts(df).first().asDict()
    assert seen.get == {"total_rows": 6, "standard_rows": 3, "strict_rows": 1, "over_cap_rows": 0}


def test_cap_at_the_edges(spark):
    df = quality.cap_content(contents(spark, "x" * 32768, "x" * 32769, "é" * 40000))
    assert [r[0] for r in df.select(F.length("content")).collect()] == [32768] * 3


def test_missing_content_column(spark):
    with pytest.raises(ValueError, match="content"):
        quality.clean_documents(spark.range(1))


def test_defaults_only_where_absent(spark):
    plain = quality.clean_documents(spark.createDataFrame([("hello",), ("world",)], "content string"))
    rows = plain.collect()
    assert len({r.id for r in rows}) == 2 and all(r.id.startswith("doc_") for r in rows)
    assert all(r.timestamp is not None for r in rows)
    given = spark.createDataFrame([("a", "hello", "t")], "id string, content string, timestamp string")
    assert quality.clean_documents(given).first().asDict() == {"id": "a", "content": "hello", "timestamp": "t"}


def test_one_content_with_most_of_the_rows(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.col("id").cast("string")).alias("content")
    )
    kept = quality.drop_duplicate_content(df)
    assert kept.count() == 2001
    assert kept.filter("content = 'same text'").first().id == 0


def test_dedupe_is_a_choice_and_compares_whole_contents(spark):
    df = contents(spark, *["same content here"] * 5, "x" * 40000 + "a", "x" * 40000 + "b")
    assert quality.clean_documents(df).count() == 7
    kept = quality.clean_documents(df, dedupe=True).collect()
    assert sorted(r.id for r in kept) == [0, 5, 6] and max(len(r.content) for r in kept) == 40001
    cut = quality.clean_documents(df, dedupe=True, max_chars=100)
    assert cut.count() == 3 and cut.agg(F.max(F.length("content"))).first()[0] == 100


def test_repeated_rows_of_one_id_collapse(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b"), (3, None), (4, None)], "id int, content string")
    assert sorted(map(tuple, quality.drop_duplicate_content(df).collect()), key=str) == sorted([(1, "a"), (None, "b"), (3, None)], key=str)


def test_vectors_of_an_epoch_are_judged_once(spark, monkeypatch):
    """No output goes through the cells of the vectors again, and the letters of documents
    that fit do not read them."""
    from eddyline.sinks.epoch_log import read_log
    from eddyline.sinks.points import read_points
    from eddyline.sources.documents import stream_documents
    from eddyline.streaming import documents

    plans = {}

    def seen(name):
        real = getattr(documents, name)

        def call(df, path, *rest, **options):
            plans[path.split("/")[-1].split("=")[0]] = df._jdf.queryExecution().executedPlan().toString()
            return real(df, path, *rest, **options)

        monkeypatch.setattr(documents, name, call)

    for name in ("write_json", "upsert_points", "write_epoch"):
        seen(name)
    folder = fresh_folder(spark, "judged-once")
    spark.createDataFrame([("a", "first document"), ("b", "second document")], "id string, content string").write.json(f"{folder}/in")
    cells = lambda text, width: F.when(text.startswith("first"), F.array_repeat(F.lit(1.0), width)).otherwise(F.array(F.lit(1.0)))
    stream = documents.with_file(stream_documents(spark, f"{folder}/in", DOCUMENT))
    documents.start_document_stream(
        stream, f"{folder}/p", f"{folder}/j", f"{folder}/l", f"{folder}/c", vector=cells, every=None,
    ).awaitTermination()
    assert set(plans) == {"epoch_id", "p", "l", "l-letters"} and not any("forall" in plan for plan in plans.values())
    assert "NOT fits" in plans["l-letters"] and "vector#" not in plans["l-letters"] and "vector:" not in plans["l-letters"]
    assert [r.id for r in read_points(spark, f"{folder}/p").collect()] == ["a"]
    assert [(r.original_key, r.failure_reason) for r in read_log(spark, f"{folder}/l-letters").collect()] == [("b", "validation_error")]


def test_document_files_with_odd_names_and_broken_lines(spark):
    from eddyline.sinks.epoch_log import read_log
    from eddyline.sinks.points import read_points
    from eddyline.sources.documents import stream_documents
    from eddyline.streaming.documents import read_ledger, start_document_stream, with_file

    folder = fresh_folder(spark, "odd-files")
    lines = {"a b": ['{"id": "1", "content": "first document"}', "{broken"], "100% ü": ['{"content": "no id"}'], "bad": ["{", "["]}
    for name, rows in lines.items():
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(f"{folder}/in/{name}")
    short = lambda: (lambda texts: [np.ones(2)] * len(texts))
    for run in range(2):
        stream = with_file(stream_documents(spark, f"{folder}/in", DOCUMENT, glob="*.txt", recursiveFileLookup="true"))
        start_document_stream(
            stream, f"{folder}/p", f"{folder}/j", f"{folder}/l{run}", f"{folder}/c{run}", encoder=md5_encoder if run == 0 else short,
            every=None, generation=run,
        ).awaitTermination()
        files = list_files(spark, f"{folder}/in", "*.txt")
        ledger = read_ledger(spark, f"{folder}/l{run}", files)
        shown = {r.file.split("/")[-2]: (r.status, r.record_count) for r in ledger.collect()}
        assert shown == {"a%20b": ("partial", 1), "100%25%20ü": ("success", 1), "bad": ("error", 0)}
        assert {r.path.split("/")[-2] for r in pending_files(files, ledger).collect()} == {"a%20b", "bad"}
        reasons = [r.failure_reason for r in read_log(spark, f"{folder}/l{run}-letters").collect()]
        assert sorted(reasons) == ["embedding_error"] * (2 * run) + ["parse_error"] * 3
    assert read_points(spark, f"{folder}/p").count() == 2


def test_union_of_many_batches(spark):
    parts = [spark.range(i, i + 1).withColumn(f"c{i % 2}", F.lit(i)) for i in range(5)]
    assert union_batches(parts).count() == 5
    with pytest.raises(ValueError):
        union_batches([])


def test_pending_files_by_size_and_full_path(spark):
    folder = fresh_folder(spark, "files")
    write_json(contents(spark, "x" * 500).coalesce(1), f"{folder}/big")
    write_json(contents(spark, "x").coalesce(1), f"{folder}/small")
    files = list_files(spark, folder)
    paths = [r.path for r in pending_files(files, spark.createDataFrame([], "file string, status string")).collect()]
    assert ["small" in paths[0], "big" in paths[1]] == [True, True]
    ledger = spark.createDataFrame([(paths[0], "success"), (paths[1], "error")], "file string, status string")
    assert [r.path for r in pending_files(files, ledger).collect()] == [paths[1]]


def test_streamed_files_are_read_once(spark):
    from eddyline.sources.documents import stream_documents
    from eddyline.streaming.pipeline import start
    from eddyline.sinks.epoch_log import read_log, write_epoch

    folder, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    docs = spark.createDataFrame([("a", "one", None)], DOCUMENT)
    for expected in (1, 2, 2):
        if expected != 2 or read_log(spark, out).count() == 1:
            write_json(docs, folder, mode="append")
        stream = stream_documents(spark, folder, DOCUMENT)
        start(stream, lambda b, e: write_epoch(b, out, e), f"{out}/checkpoint", every=None).awaitTermination()
        assert read_log(spark, out).count() == expected


def test_corrupt_state_lines_go_to_a_side_output(spark):
    from eddyline.operators.deadletters import split_corrupt_state

    lines = [('{"id": "1", "attempt_count": 2}',), ("{broken",), ('{"id": "2", "attempt_count": 1}',)]
    rows, bad = split_corrupt_state(spark.createDataFrame(lines, "value string"), DLQ_STATE)
    assert sorted(r.id for r in rows.collect()) == ["1", "2"]
    assert [r.line for r in bad.collect()] == ["{broken"]
    assert "_corrupt" not in DLQ_STATE.names


def test_json_schema_read(spark):
    folder = fresh_folder(spark, "json")
    write_json(contents(spark, "a", "b").withColumn("id", F.col("id").cast("string")), folder, compression="gzip")
    assert read_documents(spark, folder).columns == ["content", "id"]
    assert read_documents(spark, folder, DOCUMENT).columns == ["id", "content", "timestamp"]


def test_kafka_options():
    options = kafka_options("host:9092", "events", group_id="g")
    assert options["subscribe"] == "events" and options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "true" and "maxOffsetsPerTrigger" not in options
    assert kafka_options("h", "e", max_offsets_per_trigger=5, failOnDataLoss="false")["maxOffsetsPerTrigger"] == "5"
    assert options["kafka.group.id"] == "g"


def test_dead_letter_records(spark):
    df = spark.createDataFrame([("k", "boom")], "original_key string, error_message string")
    row = dead_letter_records(df).first()
    assert row.topic == "dead-letter-queue" and row.key == "k" and '"boom"' in row.value


def test_one_bad_text_costs_only_itself(spark):
    def fragile():
        inner = md5_encoder()

        def encode(texts):
            if "bad" in texts:
                raise RuntimeError("cannot encode")
            return inner(texts)

        return encode

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "  "), (4, None), (5, "fine")], "id int, t string").coalesce(1)
    good, failed = split_encode_errors(encode_texts(df, "t", fragile))
    vectors = {r.id: r.vector for r in good.collect()}
    assert set(vectors) == {1, 3, 4, 5}
    assert vectors[3] == [0.0] * 384 and vectors[4] == [0.0] * 384
    assert np.allclose(vectors[1], md5_encoder()(["good"])[0])
    row = failed.first()
    assert row.id == 2 and row.failure_reason == "embedding_error" and "cannot encode" in row.encode_error


TEXTS = ["the red cat sat", "red cat red dog", "a dog", "", None, "blue bird; red cat!"]


def text_frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id long, t string")


def brute_weights(texts, stop, limit):
    import re
    from collections import Counter

    bags = []
    for t in texts:
        words = [w for w in re.findall(r"\b\w\w+\b", (t or "").lower()) if w not in stop]
        bags.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    total = sum(bags, Counter())
    vocabulary = sorted(total, key=lambda w: (-total[w], w))[:limit]
    df = {w: sum(w in b for b in bags) for w in vocabulary}
    idf = {w: np.log((1 + len(texts)) / (1 + df[w])) + 1 for w in vocabulary}
    rows = {}
    for i, bag in enumerate(bags):
        raw = {w: bag[w] * idf[w] for w in vocabulary if w in bag}
        length = np.sqrt(sum(x * x for x in raw.values()))
        rows.update({(i, w): x / length for w, x in raw.items()})
    return vocabulary, rows


@pytest.mark.parametrize("limit", [4, 100])
def test_term_weights_against_brute_force(spark, limit):
    got = term_weights(text_frame(spark), "id", "t", stop_words=["the", "a"], max_features=limit).collect()
    _, expected = brute_weights(TEXTS, {"the", "a"}, limit)
    assert {(r.id, r.term) for r in got} == set(expected)
    for r in got:
        assert r.weight == pytest.approx(expected[(r.id, r.term)])


@pytest.mark.parametrize("sizes", [(1, 1), (3, 3), (1, 64), (1 << 17, 1 << 21)])
def test_vocabulary_by_summaries_equals_exact_counts(spark, monkeypatch, sizes):
    """Summaries too small to tell terms apart, ones that need larger ones or a recount, and
    ones that lose nothing all give the same terms, counts and order of ties."""
    import random
    from collections import Counter

    from eddyline.operators import tfidf

    monkeypatch.setattr(tfidf, "SUMMARY_TERMS", sizes[0])
    monkeypatch.setattr(tfidf, "MOST_SUMMARY_TERMS", sizes[1])
    draw = random.Random(4)
    words = ["É", "les", "über", "日本", "x9", "a_b", *[f"w{i}" for i in range(80)]]
    texts = [" ".join(draw.choices(words, [100 / (i + 1) for i in range(len(words))], k=draw.randrange(60))) for _ in range(120)] + [None, "", "the a"]
    for limit in (1, 7, 40, 5000):
        got = tfidf.vocabulary(text_frame(spark, texts).repartition(5), "t", ["the", "w3"], limit)
        tf, df = Counter(), Counter()
        import re

        for t in texts:
            kept = [w for w in re.findall(r"\w\w+", (t or "").lower()) if w not in ("the", "w3")]
            terms = kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])]
            tf.update(terms)
            df.update(set(terms))
        expected = sorted(tf, key=lambda w: (-tf[w], w.encode()))[:limit]
        assert got == [(w, tf[w], df[w]) for w in expected]


def test_frequent_directions_keep_their_bounds_however_rows_are_split(spark):
    from eddyline.operators import tfidf

    rng = np.random.default_rng(8)
    dense = (rng.normal(size=(600, 12)) * 3.0 ** -np.arange(12)) @ rng.normal(size=(12, 90)) + 0.02 * rng.normal(size=(600, 90))
    dense[np.abs(dense) < 0.3] = 0.0
    rows = spark.createDataFrame(
        [(i, np.flatnonzero(r).tolist(), r[r != 0].tolist()) for i, r in enumerate(dense)], "id long, slots array<int>, values array<double>"
    )
    squares = np.linalg.svd(dense, compute_uv=False) ** 2
    k = 5
    best = squares[k:].sum()
    for parts, spare, tasks in ((1, 8, 256), (7, 8, 256), (40, 8, 3), (23, 128, 256)):
        tfidf.SPARE_DIRECTIONS, tfidf.SKETCH_TASKS, held = spare, tasks, (tfidf.SPARE_DIRECTIONS, tfidf.SKETCH_TASKS)
        try:
            found = tfidf.principal_directions(rows.repartition(parts), 90, k)
        finally:
            tfidf.SPARE_DIRECTIONS, tfidf.SKETCH_TASKS = held
        assert np.allclose(found.T @ found, np.eye(k), atol=1e-5)
        left = (dense**2).sum() - ((dense @ found) ** 2).sum()
        assert best - 1e-3 <= left <= best * (1 + k / spare) + 1e-3


def test_a_sketch_stays_within_its_error(spark):
    from eddyline.functions.blocks import Directions

    rng = np.random.default_rng(9)
    dense = rng.normal(size=(500, 40)) * 1.3 ** -np.arange(40)
    sketches = [Directions(40, 12) for _ in range(3)]
    for i, part in enumerate(np.array_split(dense, 20)):
        sketches[i % 3].put(part)
    for other in sketches[1:]:
        other.shrink()
        sketches[0].put(other.rows[: other.filled])
    sketches[0].shrink()
    b = sketches[0].rows[:12].astype(np.float64)
    gap = np.linalg.eigvalsh(dense.T @ dense - b.T @ b)
    squares = np.linalg.svd(dense, compute_uv=False) ** 2
    assert gap.min() >= -1e-3 and gap.max() <= min(squares[k:].sum() / (12 - k) for k in range(12)) * 1.001


def test_svd_keeps_the_geometry(spark):
    """With as many components as the rank, inner products equal those of the weights."""
    vocabulary, expected = brute_weights(TEXTS, {"the", "a"}, 100)
    dense = np.zeros((len(TEXTS), len(vocabulary)))
    for (i, w), x in expected.items():
        dense[i, vocabulary.index(w)] = x
    made = svd_vectors(text_frame(spark), "id", "t", components=6, stop_words=["the", "a"])
    got = np.array([r.vector for r in made.orderBy("id").collect()])
    assert np.allclose(got @ got.T, dense @ dense.T, atol=1e-6)


def test_svd_finds_the_leading_directions(spark):
    # Three topics with words of their own: three directions well apart from the rest.
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(60)])
    texts = [" ".join(rng.choice(words[i % 3 * 20 : i % 3 * 20 + 20], 30)) for i in range(80)]
    vocabulary, expected = brute_weights(texts, set(), 50)
    dense = np.zeros((len(texts), len(vocabulary)))
    for (i, w), x in expected.items():
        dense[i, vocabulary.index(w)] = x
    made = svd_vectors(text_frame(spark, texts), "id", "t", components=3, stop_words=[], max_features=50)
    got = np.array([r.vector for r in made.orderBy("id").collect()])
    u, s, _ = np.linalg.svd(dense, full_matrices=False)
    exact = u[:, :3] * s[:3]
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    assert np.allclose(got @ got.T, exact @ exact.T, atol=1e-2)
    assert np.allclose(np.linalg.norm(got, axis=1), 1.0)


def test_no_terms_gives_zero_vectors(spark):
    made = svd_vectors(text_frame(spark, ["a", "", None]), "id", "t", components=8, stop_words=[])
    assert [r.vector for r in made.collect()] == [[0.0] * 8] * 3
    assert term_weights(text_frame(spark, ["a"]), "id", "t", stop_words=[]).count() == 0


def test_archive_ledger_and_pending_files_agree(spark, tmp_path):
    import gzip

    from eddyline.sinks.points import read_points
    from eddyline.sources.documents import pending_files, stream_documents, unreadable_files
    from eddyline.streaming import documents

    source, root = tmp_path / "in", fresh_folder(spark, "archive")
    source.mkdir()
    packed = lambda *ids: gzip.compress("".join(f'{{"id": "{i}", "content": "text of {i}"}}\n' for i in ids).encode())
    put = lambda name, content: (source / f".{name}").write_bytes(content) and (source / f".{name}").rename(source / name)
    put("a.json.gz", packed("a", "b"))
    put("b.json.gz", packed("never", *map(str, range(3000)))[:-200])
    put("c.json.gz", packed("c") + packed("d"))  # two packed parts
    put("d.json.gz", b"not packed at all")

    def drain():
        stream = stream_documents(spark, str(source), DOCUMENT, "*.gz", archive=str(tmp_path / "done"))
        documents.start_document_stream(
            documents.with_file(stream), f"{root}/points", f"{root}/json", f"{root}/ledger", f"{root}/checkpoint", every=None
        ).awaitTermination()

    found = {r.file.split("/")[-1]: r.error for r in unreadable_files(spark, [r.path for r in list_files(spark, str(source), "*.gz").collect()]).collect()}
    assert set(found) == {"b.json.gz", "d.json.gz"} and "too early" in found["b.json.gz"]
    drain()
    files = list_files(spark, str(source), "*.gz").unionByName(list_files(spark, str(tmp_path / "done"), "*.gz")) if (tmp_path / "done").exists() else list_files(spark, str(source), "*.gz")
    ledger = documents.read_ledger(spark, f"{root}/ledger", files)
    name = lambda path: path.split("/")[-1]
    got = {name(r.file): (r.status, r.record_count) for r in ledger.filter("status <> 'empty'").collect()}
    assert got == {"a.json.gz": ("success", 2), "b.json.gz": ("error", 0), "c.json.gz": ("success", 2), "d.json.gz": ("error", 0)}
    assert sorted(r.id for r in read_points(spark, f"{root}/points").collect()) == ["a", "b", "c", "d"]
    put("e.json.gz", packed("e"))
    drain()
    done = {p.name for p in (tmp_path / "done").rglob("*.gz")}
    assert done >= {"a.json.gz", "b.json.gz", "c.json.gz", "d.json.gz"}
    left = {name(r.path) for r in pending_files(list_files(spark, str(source), "*.gz"), documents.read_ledger(spark, f"{root}/ledger")).collect()}
    assert left == set() and {p.name for p in source.glob("*.gz")} | done == {f"{c}.json.gz" for c in "abcde"}


def test_document_stream_ledger_and_outputs(spark):
    from eddyline.operators.ledger import run_summary
    from eddyline.sinks.points import read_points
    from eddyline.sources.documents import stream_documents
    from eddyline.streaming import documents

    root = fresh_folder(spark, "docs")
    write_json(spark.createDataFrame([("a", "first text"), ("b", " ")], "id string, content string").coalesce(1), f"{root}/in/good")
    write_json(spark.createDataFrame([("c", 1)], "id string, other int").coalesce(1), f"{root}/in/bad")
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{root}/in/none")
    empty = spark.read.text(f"{root}/in/none").count()
    assert empty == 0

    def drain():
        stream = documents.with_file(stream_documents(spark, f"{root}/in", DOCUMENT, recursiveFileLookup="true"))
        documents.start_document_stream(
            stream, f"{root}/points", f"{root}/json", f"{root}/ledger", f"{root}/checkpoint", every=None
        ).awaitTermination()

    drain()
    files = list_files(spark, f"{root}/in", "*.{json,txt}")
    ledger = documents.read_ledger(spark, f"{root}/ledger", files)
    got = {r.file.split("/")[-2]: (r.status, r.record_count) for r in ledger.collect()}
    assert got["good"] == ("success", 2) and got["bad"] == ("error", 0)
    assert run_summary(ledger).first().status == "partial_success"
    assert [r.id for r in read_points(spark, f"{root}/points").collect()] == ["a"]
    assert spark.read.json(f"{root}/json").count() == 1
    # A second scheduled run finds only the new file.
    write_json(spark.createDataFrame([("a", "newer text")], "id string, content string").coalesce(1), f"{root}/in/more")
    drain()
    points = read_points(spark, f"{root}/points").collect()
    assert [(r.id, r.payload.content, r.epoch_id) for r in points] == [("a", "newer text", 1)]


def test_terms_are_counted_in_portions_of_tokens():
    import pyarrow as pa

    from eddyline.functions import terms

    words = [["a"] * n for n in (5, 0, terms.TOKENS, 3, terms.TOKENS - 4, 2, 2 * terms.TOKENS, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(words, pa.list_(pa.string()))], names=["id", "words"])
    found = list(terms.portions([batch]))
    assert pa.Table.from_batches(found) == pa.Table.from_batches([batch])
    sizes = [sum(len(w or []) for w in part.column("words").to_pylist()) for part in found]
    assert len(found) >= 4 and all(n <= terms.TOKENS or part.column("words").value_lengths().drop_null().to_pylist().count(0) < len(part) <= 3 for n, part in zip(sizes, found))
    counted = list(terms.count_terms([], pa.array(["aa"]))(iter([batch])))
    assert counted[0].num_rows == 0


def test_summaries_stay_small():
    from eddyline.operators import tfidf

    assert tfidf.MOST_SUMMARY_TERMS <= 1 << 17
