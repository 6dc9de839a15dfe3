import pytest

LONG = "the quick brown fox jumps over a lazy dog near the river bank. " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """NULL ids and texts, empty, blank and very long texts, ties and repeated rows, and
    columns whose names operators use inside."""
    rows = [
        (None, "a text without an id, long enough for shingles and lines"), (None, None), (1, None), (2, ""), (3, " \t\n \n"),
        (4, "one"), (5, "same text here for both rows of one id"), (5, "same text here for both rows of one id"),
        (6, LONG), (7, "né ▁ 日本語 😀 <|endoftext|> <s>"), (8, "a\r\nb\x00c"),
    ]
    clash = "0 as hi, 'x' as mark, 1 as part, 2 as ids, 'y' as score, 3 as shard, 4 as hash, 5 as n, 6 as digest, 'z' as drop_id, 7 as component_id"
    return spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", *clash.split(", "))


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(6, 1, 0), (6, 0, 1), (4, 0, 1), (99, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
