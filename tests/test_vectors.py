import numpy as np
import pytest
from pyspark.sql import functions as F

from eddyline.operators.vectors import cosine_top_k, search_similar, split_missing
from eddyline.session import fresh_folder
from eddyline.sinks.epoch_log import epochs
from eddyline.sinks.points import compact, read_points, split_by_width, upsert_points, with_payload, with_point_ids


def frame(spark, matrix, kind="long"):
    rows = [(i if kind == "long" else f"id{i:04d}", v) for i, v in enumerate(matrix.tolist())]
    return spark.createDataFrame(rows, f"id {kind}, vector array<double>")


def brute(queries, corpus, k):
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    scores = np.round(unit(queries) @ unit(corpus).T, 9)
    return {q: sorted(range(len(corpus)), key=lambda i: (-scores[q, i], i))[:k] for q in range(len(queries))}


def ranked(df, number=int):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(number(r.query_id), []).append(number(r.id))
    return got


@pytest.mark.parametrize("block_bytes", [1 << 20, 8 * 8 * 7])
def test_top_k_against_brute_force_with_many_ties(spark, block_bytes):
    rng = np.random.default_rng(5)
    corpus = rng.integers(-1, 2, (700, 8)).astype(float)
    queries = rng.integers(-1, 2, (30, 8)).astype(float)
    got = cosine_top_k(frame(spark, queries), frame(spark, corpus).repartition(5), 7, 8, block_bytes)
    assert ranked(got) == brute(queries, corpus, 7)


def test_string_ids(spark):
    corpus = np.random.default_rng(6).integers(-1, 2, (300, 4)).astype(float)
    got = cosine_top_k(frame(spark, corpus[:3], "string"), frame(spark, corpus, "string").repartition(3), 4, 4)
    assert ranked(got, lambda s: int(s[2:])) == brute(corpus[:3], corpus, 4)


def test_parallel_vectors_tie_and_the_lower_id_wins(spark):
    corpus = np.array([[0.1] * 384, [0.2] * 384, [0.3] * 384])
    rows = search_similar(frame(spark, corpus), [0.15] * 384, limit=2).collect()
    assert [r.id for r in rows] == [0, 1] and rows[0].score == pytest.approx(1.0)


def test_zero_short_and_missing_vectors(spark):
    rows = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [1.0, None])]
    corpus = spark.createDataFrame(rows, "id long, vector array<double>")
    found = search_similar(corpus, [1.0, 0.0], limit=5).collect()
    assert [(r.id, r.score) for r in found] == [(1, 1.0), (0, 0.0)]
    good, bad = split_missing(corpus)
    assert (good.count(), bad.count()) == (4, 1)
    fitting, others = split_by_width(corpus, 2)
    assert (fitting.count(), others.count()) == (2, 3)


def test_vectors_that_are_no_numbers_are_refused(spark):
    nan, inf = float("nan"), float("inf")
    odd = spark.createDataFrame([(0, [nan, 1.0]), (1, [1.0, 0.0]), (2, [inf, 0.0]), (3, [1.0])], "id long, vector array<double>")
    assert [r.id for r in search_similar(odd, [1.0, 0.0]).collect()] == [1]
    found = cosine_top_k(odd, odd, 3, 2).collect()
    assert sorted((r.query_id, r.id) for r in found if r.id is not None) == [(1, 1)]
    assert sorted(r.query_id for r in found if r.id is None) == [0, 2, 3]


def test_repeated_query_ids_in_many_blocks(spark):
    many = spark.createDataFrame([(7, [1.0, 0.0])] * 40, "id long, vector array<double>")
    assert cosine_top_k(many, many.limit(1), 1, 2, block_bytes=2 * 8 * 4).count() >= 1


def test_no_corpus_and_no_queries(spark):
    empty = spark.createDataFrame([], "id long, vector array<double>")
    some = frame(spark, np.ones((2, 2)))
    assert cosine_top_k(some, empty, 3, 2).count() == 0
    assert cosine_top_k(empty, some, 3, 2).count() == 0


def clustered(rng, n, width=24, centres=40):
    middle = rng.normal(size=(centres, width))
    return middle[rng.integers(centres, size=n)] + 0.03 * rng.normal(size=(n, width))


@pytest.mark.parametrize("pivots, cells", [(1, 1 << 18), (40, 60), (300, 1 << 18)])
def test_pruned_search_equals_brute_force(spark, monkeypatch, pivots, cells):
    from eddyline.operators import pivot_search

    monkeypatch.setattr(pivot_search, "BLOCK_CELLS", cells)
    rng = np.random.default_rng(12)
    corpus = np.concatenate([rng.integers(-1, 2, (400, 6)).astype(float), np.tile([1.0, 2, 3, 4, 5, 6], (30, 1)), np.zeros((9, 6))])
    queries = np.concatenate([rng.integers(-1, 2, (40, 6)).astype(float), corpus[400:402], np.zeros((1, 6))])
    index = pivot_search.PivotIndex.build(frame(spark, corpus).repartition(4), width=6, pivots=pivots)
    for k in (1, 7, 60):
        assert ranked(index.search(frame(spark, queries), k)) == brute(queries, corpus, k)


def test_pruned_search_skips_what_cannot_be_near(spark):
    from eddyline.operators.pivot_search import PivotIndex

    rng = np.random.default_rng(13)
    corpus = clustered(rng, 4000)
    queries = corpus[rng.integers(4000, size=50)] + 0.01 * rng.normal(size=(50, 24))
    index = PivotIndex.build(frame(spark, corpus, "string"), width=24, pivots=120)
    got = index.search(frame(spark, queries, "string"), 5)
    assert ranked(got, lambda s: int(s[2:])) == brute(queries, corpus, 5)
    share = index.share_read(frame(spark, queries, "string"), 5)
    print("share of pairs compared:", round(share, 3))
    assert share < 0.25


def test_pruned_search_of_odd_rows(spark):
    from eddyline.operators.pivot_search import PivotIndex

    nan = float("nan")
    odd = spark.createDataFrame([(0, [nan, 1.0]), (1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 0.0])], "id long, vector array<double>")
    found = PivotIndex.build(odd, width=2).search(odd, 3).collect()
    assert sorted((r.query_id, r.id) for r in found if r.id is not None) == [(1, 1), (1, 4), (4, 1), (4, 4)]
    assert sorted(r.query_id for r in found if r.id is None) == [0, 2, 3]
    assert PivotIndex.build(odd.limit(0), width=2).search(odd, 3).filter("id IS NOT NULL").count() == 0
    assert PivotIndex.build(odd, width=2).search(odd.limit(0), 3).count() == 0
    zeros = PivotIndex.build(odd.filter("id = 4"), width=2)
    assert [tuple(r) for r in zeros.search(odd.filter("id = 1"), 2).collect()] == [(1, 4, 0.0, 1)]


def points(spark, rows):
    return spark.createDataFrame(rows, "id string, vector array<float>, payload map<string,string>, offset long")


def shown(spark, path):
    return {r.id: (r.payload["v"], r.generation, r.epoch_id) for r in read_points(spark, path).collect()}


def test_upsert_replay_compaction_and_generations(spark):
    path = fresh_folder(spark, "points")
    upsert_points(points(spark, [("a", [1.0], {"v": "0"}, 0), ("b", [1.0], {"v": "0"}, 1)]), path, 0)
    upsert_points(points(spark, [("a", [2.0], {"v": "1"}, 2), ("a", [3.0], {"v": "1b"}, 3)]), path, 1)
    expected = {"a": ("1b", 0, 1), "b": ("0", 0, 0)}
    assert shown(spark, path) == expected
    # A replayed epoch replaces itself.
    upsert_points(points(spark, [("a", [2.0], {"v": "1"}, 2), ("a", [3.0], {"v": "1b"}, 3)]), path, 1)
    assert shown(spark, path) == expected
    compact(spark, path)
    assert shown(spark, path) == expected
    # Replayed after folding, with another outcome: the newest write of an epoch wins.
    upsert_points(points(spark, [("a", [7.0], {"v": "1c"}, 2)]), path, 1)
    assert shown(spark, path) == {"a": ("1c", 0, 1), "b": ("0", 0, 0)}
    upsert_points(points(spark, [("b", [9.0], {"v": "2"}, 4), ("c", [9.0], {"v": "2"}, 5)]), path, 2)
    expected = {"a": ("1c", 0, 1), "b": ("2", 0, 2), "c": ("2", 0, 2)}
    assert shown(spark, path) == expected
    compact(spark, path, retire=True)
    assert epochs(spark, path) == [(0, 2)] and shown(spark, path) == expected
    # A restarted query begins at epoch 0 again, in a new generation.
    upsert_points(points(spark, [("a", [4.0], {"v": "3"}, 0)]), path, 0, generation=1)
    assert shown(spark, path) == expected | {"a": ("3", 1, 0)}


def test_a_finished_epoch_is_folded_when_asked(spark):
    path = fresh_folder(spark, "finished")
    upsert_points(points(spark, [("a", [1.0], {"v": "0"}, 0), ("a", [2.0], {"v": "0b"}, 1), ("b", [1.0], {"v": "0"}, 2)]), path, 0)
    compact(spark, path)
    assert not any("/base/" in f for f in read_points(spark, path).inputFiles())  # its replay may come
    compact(spark, path, keep=0)
    expected = {"a": ("0b", 0, 0), "b": ("0", 0, 0)}
    assert shown(spark, path) == expected
    assert all("/base/" in f for f in read_points(spark, path).inputFiles())
    upsert_points(points(spark, [("b", [9.0], {"v": "1"}, 3), ("c", [9.0], {"v": "1"}, 4)]), path, 1)
    expected |= {"b": ("1", 0, 1), "c": ("1", 0, 1)}
    assert shown(spark, path) == expected and read_points(spark, path).count() == 3
    compact(spark, path, retire=True, keep=0)
    assert epochs(spark, path) == [] and shown(spark, path) == expected
    compact(spark, path, keep=0)
    assert shown(spark, path) == expected


def test_a_base_is_written_by_tasks_of_a_fixed_number_of_rows(spark, monkeypatch):
    from eddyline import session

    monkeypatch.setattr(session, "ROWS_PER_TASK", 20)
    path, rows = fresh_folder(spark, "dense"), spark.range(0, 400, 1, 1).selectExpr("cast(id as string) id", "array(1f) vector", "map('v', 'a') payload", "id offset")
    upsert_points(rows.coalesce(1), path, 0)
    compact(spark, path, keep=0)
    read = read_points(spark, path)
    sizes = [r["count"] for r in read.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 60 and len(sizes) > 10
    assert shown(spark, path) == {str(k): ("a", 0, 0) for k in range(400)}


def test_the_compacted_query_reads_its_first_epoch_from_the_base(spark, tmp_path):
    from eddyline.plans.vector_queries import upserted, upserted_compacted

    kinds = ["view", "purchase", "signup", None]
    spark.range(40).selectExpr(
        "id event_id", "timestamp '2024-01-01' + make_interval(0, 0, 0, 0, 0, id) ts", "id % 7 user_id",
        f"array({', '.join('null' if k is None else repr(k) for k in kinds)})[cast(id % 4 as int)] event_type", "1.5D value", "'{}' props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(5).selectExpr(
        "id p_partkey", "concat('name ', id) p_name", "'brand' p_brand", "'type' p_type", "cast(id as int) p_size", "2.5D p_retailprice"
    ).write.parquet(f"{tmp_path}/part.parquet")
    table = upserted_compacted(spark, str(tmp_path))
    read = [f for f in table.inputFiles() if "/points-" in f]
    assert any("/base/" in f for f in read) and any("epoch_id=1" in f for f in read)
    assert not any("epoch_id=0" in f for f in read)
    rows = sorted(map(tuple, table.collect()))
    # 15 and 35 have neither kind nor product, so no text.
    assert {int(r[0]): r[1] for r in rows} == {k: int(k % 4 == 1) for k in range(40) if k not in (15, 35)} and len(rows) == 38
    assert rows == sorted(map(tuple, upserted(spark, str(tmp_path)).collect()))


def test_reading_points_sorts_no_vectors(spark):
    path = fresh_folder(spark, "narrow")
    for epoch in range(3):
        upsert_points(points(spark, [(f"p{i}", [float(epoch)], {"v": str(epoch)}, i) for i in range(epoch * 10, epoch * 10 + 15)]), path, epoch)
    table = read_points(spark, path)
    assert {r.id: r.epoch_id for r in table.collect()} == {f"p{i}": min(i // 10, 2) for i in range(35)}
    plan = table._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.split("\n") if "Sort [" in line or "Exchange hashpartitioning" in line]
    assert sorts and not any("vector" in line or "payload" in line for line in sorts)
    assert "BroadcastHashJoin" in plan  # the beaten rows are few


def test_missing_ids_are_stable(spark):
    rows = [(None, {"k": "v"}), (None, {"k": "v"}), (None, {"k": "w"}), ("x", None)]
    df = spark.createDataFrame(rows, "id string, metadata map<string,string>")
    filled = with_point_ids(with_payload(df)).collect()
    assert filled[0].id == filled[1].id != filled[2].id
    assert filled[3].id == "x" and filled[3].payload == {}


def test_many_beaten_rows_are_dealt_and_heavy_rows_not_sorted(spark, monkeypatch):
    from eddyline.sinks import points

    def sorted_whole(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.split("\n") if "Sort [" in line and ("payload" in line or "_file" in line.split("Sort [")[1][:4])] + ["x"] * ("SortMergeJoin" in plan)

    monkeypatch.setattr(points, "FEW_BEATEN", 3)
    path = fresh_folder(spark, "many-beaten")
    rows = lambda low, high, text: spark.range(low, high).selectExpr("cast(id as string) id", "array(1f) vector", f"'{text}' payload", "id offset")
    for epoch, part in enumerate([rows(0, 40, "a"), rows(10, 20, "b"), rows(15, 45, "c")]):
        points.upsert_points(part, path, epoch)
    expected = {**{str(k): "a" for k in range(40)}, **{str(k): "b" for k in range(10, 20)}, **{str(k): "c" for k in range(15, 45)}}
    read = points.read_points(spark, path)
    assert {r.id: r.payload for r in read.collect()} == expected and read.count() == 45
    assert not sorted_whole(read)
    points.compact(spark, path)
    read = points.read_points(spark, path)
    assert {r.id: r.payload for r in read.collect()} == expected and read.count() == 45
    assert not sorted_whole(read)


def test_tasks_grow_with_the_rows(spark):
    from eddyline.session import ROWS_PER_TASK, spread

    assert spread(spark.range(0, 12 * ROWS_PER_TASK, 1, 2)).rdd.getNumPartitions() == 12
    assert spread(spark.range(0, 10, 1, 2)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
