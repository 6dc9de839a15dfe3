"""Queries over batch documents: scans, cleaning, sinks, term weights, encoders."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from eddyline.functions.encoders import md5_encoder
from eddyline.operators import quality
from eddyline.operators.encoder import encode_texts, split_encode_errors
from eddyline.operators.sets import union_batches
from eddyline.operators.tfidf import svd_vectors, term_weights
from eddyline.plans import tables
from eddyline.plans.catalog import hash_vector_columns, plain_time, query, rounded
from eddyline.plans.tables import EVENT_COLUMNS, hash_vector_sql, with_sql
from eddyline.schemas import DOCUMENT, EVENT, MAX_CONTENT_CHARS
from eddyline.session import fresh_folder
from eddyline.sinks.json_files import write_json
from eddyline.sources.documents import list_files, pending_files, read_documents

STD = "text IS NOT NULL AND text <> '' AND text <> ' '"
STRICT = STD + " AND length(text) > 10"
DOCS_PER_FILE = 256


@query("json_scan", "SELECT CAST(doc_id AS VARCHAR) AS id, text AS content FROM documents")
def json_scan(spark, sf_dir):
    folder = fresh_folder(spark, "json-scan")
    write_json(tables.documents(spark, sf_dir).select("id", "content"), folder)
    return read_documents(spark, folder, DOCUMENT).select("id", "content")


@query("json_multiline", "SELECT CAST(doc_id AS VARCHAR) AS id, text AS content FROM documents")
def json_multiline(spark, sf_dir):
    """Files that hold one pretty-printed array each, of a bounded number of documents."""
    folder = fresh_folder(spark, "json-multiline")
    docs = tables.documents(spark, sf_dir)
    arrays = docs.groupBy(F.floor(F.col("doc_id") / DOCS_PER_FILE).alias("file")).agg(
        F.to_json(F.collect_list(F.struct("id", "content")), {"pretty": "true"}).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return read_documents(spark, folder, DOCUMENT, multi_line=True, glob="*.txt").select("id", "content")


@query("json_sink_split", """
SELECT CAST(doc_id AS VARCHAR) AS id, text AS content, true AS within_cap FROM documents""")
def json_sink_split(spark, sf_dir):
    """Compressed output, at most 100 records per file, read back with a check of the cap."""
    folder = fresh_folder(spark, "json-split")
    write_json(
        tables.documents(spark, sf_dir).select("id", "content"), folder,
        compression="gzip", max_records_per_file=100,
    )
    back = read_documents(spark, folder, DOCUMENT).select("id", "content", F.input_file_name().alias("file"))
    sizes = back.groupBy("file").agg((F.count("*") <= 100).alias("within_cap"))
    return back.join(sizes, "file").select("id", "content", "within_cap")


@query("json_roundtrip", with_sql("ev", body="""
SELECT event_id, event_type, product_id, product_description, product_price, search_query, quantity, total_amount
FROM ev"""))
def json_roundtrip(spark, sf_dir):
    folder = fresh_folder(spark, "json-roundtrip")
    write_json(tables.events(spark, sf_dir).select(*EVENT_COLUMNS), folder)
    back = read_documents(spark, folder, EVENT)
    return back.select(
        "event_id", "event_type", F.col("product.id").alias("product_id"),
        F.col("product.description").alias("product_description"),
        F.col("product.price").alias("product_price"), "search_query", "quantity", "total_amount",
    )


@query("pending_files", """
WITH f AS (SELECT source, sum(strlen(text) + 1) AS n_bytes FROM documents WHERE text IS NOT NULL GROUP BY source)
SELECT source, row_number() OVER (ORDER BY n_bytes, source) AS place FROM f
WHERE CAST(substr(source, 4) AS INTEGER) % 2 = 0""")
def pending(spark, sf_dir):
    """One file of texts per source, in folders with a space in their names. The ledger
    knows every second one from reading it; the others wait, small ones first."""
    folder = fresh_folder(spark, "pending")
    docs = tables.documents(spark, sf_dir).filter("content IS NOT NULL")
    # A file of one source is what is listed here; the sort keeps each in one task's hands.
    named = docs.select(F.concat(F.lit("from "), "source").alias("origin"), F.col("content").alias("value"))
    named.repartition("origin").sortWithinPartitions("origin").write.partitionBy("origin").option("lineSep", "\n").text(folder)
    files = list_files(spark, folder, "*.txt")
    number = F.regexp_extract("file", "src(\\d+)/", 1).cast("int")
    read = spark.read.text(folder, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file")).distinct()
    done = read.filter(number % 2 == 1).withColumn("status", F.lit("success"))
    todo = pending_files(files, done)
    # The order is a result too: a file's place among those that wait.
    place = F.row_number().over(Window.orderBy("length", "path"))
    return todo.select(F.regexp_extract("path", "(src\\d+)/", 1).alias("source"), place.alias("place"))


@query("content_filter_std", f"SELECT doc_id FROM documents WHERE {STD}")
def content_filter_std(spark, sf_dir):
    return tables.documents(spark, sf_dir).filter(quality.has_content()).select("doc_id")


@query("content_filter_strict", f"SELECT doc_id FROM documents WHERE {STRICT}")
def content_filter_strict(spark, sf_dir):
    return tables.documents(spark, sf_dir).filter(quality.has_long_content()).select("doc_id")


@query("default_id", """
SELECT count(*) AS n_rows, count(*) AS n_ids, true AS all_prefixed FROM documents""")
def default_id(spark, sf_dir):
    """The ids depend on the splits, so what must hold for any of them is shown."""
    docs = quality.with_default_id(tables.documents(spark, sf_dir).select("doc_id"))
    return docs.agg(
        F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"),
        F.every(F.col("id").startswith("doc_")).alias("all_prefixed"),
    )


@query("default_ts", "SELECT doc_id, TIMESTAMP '2024-02-01 00:00:00' AS timestamp FROM documents")
def default_ts(spark, sf_dir):
    docs = tables.documents(spark, sf_dir).select("doc_id")
    stamped = quality.with_default_timestamp(docs, F.lit("2024-02-01").cast("timestamp"))
    return stamped.select("doc_id", plain_time("timestamp"))


@query("content_cap", f"""
SELECT doc_id, length(text) > {MAX_CONTENT_CHARS} AS was_longer,
  substr(text, 1, {MAX_CONTENT_CHARS}) AS content FROM documents""")
def content_cap(spark, sf_dir):
    docs = tables.documents(spark, sf_dir).withColumn("was_longer", F.length("content") > MAX_CONTENT_CHARS)
    return quality.cap_content(docs).select("doc_id", "was_longer", "content")


@query("quality_counts", f"""
SELECT count(*) AS total_rows, count(*) FILTER ({STD}) AS standard_rows, count(*) FILTER ({STRICT}) AS strict_rows,
  count(*) FILTER (length(text) > {MAX_CONTENT_CHARS}) AS over_cap_rows FROM documents""")
def quality_counts(spark, sf_dir):
    return quality.quality_counts(tables.documents(spark, sf_dir))


@query("dedupe_content", """
SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, md5(text) AS content_md5
FROM documents GROUP BY text""")
def dedupe_content(spark, sf_dir):
    docs = tables.documents(spark, sf_dir).select("doc_id", "source", "content")
    kept = quality.drop_duplicate_content(docs, "doc_id")
    return kept.select("doc_id", "source", F.md5(F.col("content").cast("binary")).alias("content_md5"))


@query("clean_documents", f"""
SELECT CAST(min(doc_id) AS VARCHAR) AS id, md5(content) AS content_md5, TIMESTAMP '2024-02-01 00:00:00' AS timestamp
FROM (SELECT doc_id, text AS content FROM documents WHERE {STRICT}) GROUP BY content""")
def clean_documents(spark, sf_dir):
    docs = tables.documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "content")
    cleaned = quality.clean_documents(docs, strict=True, dedupe=True, now=F.lit("2024-02-01").cast("timestamp"))
    return cleaned.select(
        F.col("id").cast("string").alias("id"), F.md5(F.col("content").cast("binary")).alias("content_md5"),
        plain_time("timestamp"),
    )


@query("union_batches", "SELECT doc_id, lang FROM documents")
def union_of_batches(spark, sf_dir):
    docs = tables.documents(spark, sf_dir).select("doc_id", "lang")
    part = F.pmod("doc_id", F.lit(4))
    return union_batches([docs.filter(part == i) for i in range(4)])


_ENCODED = f"""
SELECT doc_id, {hash_vector_sql('content')} FROM (
  SELECT doc_id, CASE WHEN trim(text) = '' THEN '' ELSE text END AS content FROM documents)"""


@query("encode_udf", _ENCODED)
def encode_udf(spark, sf_dir):
    docs = tables.documents(spark, sf_dir).select("doc_id", "content")
    good, _ = split_encode_errors(encode_texts(docs, "content", md5_encoder))
    return good.select("doc_id", *hash_vector_columns())


@query("batched_embedding", _ENCODED)
def batched_embedding(spark, sf_dir):
    """Fixed-size batches without grouping: the batch is a slice of an Arrow batch."""
    docs = tables.documents(spark, sf_dir).select("doc_id", "content")
    encoded = encode_texts(docs, "content", md5_encoder, batch_size=32)
    return encoded.select("doc_id", *hash_vector_columns())


# The stop words of the two term queries (a parameter of the operator).
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it",
    "its", "of", "on", "or", "that", "the", "this", "to", "was", "were", "will", "with",
)


@query("tfidf_weights", """
WITH tok AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'),
    lambda w: NOT list_contains([STOPS], w)) AS w FROM documents),
terms AS (
  SELECT doc_id, unnest(list_concat(w, CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)),
    lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END)) AS term FROM tok),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
voc AS (SELECT term, count(*) AS df FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 10000),
raw AS (
  SELECT doc_id, term, tf, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS x
  FROM tf JOIN voc USING (term))
SELECT doc_id, term, tf, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw
""".replace("STOPS", ", ".join(f"'{w}'" for w in STOP_WORDS)))
def tfidf_weights(spark, sf_dir):
    docs = tables.spread_table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = term_weights(docs, "doc_id", "text", stop_words=list(STOP_WORDS))
    return weights.select("doc_id", "term", "tf", rounded("weight"))


@query("tfidf_svd", """
WITH tok AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'),
    lambda w: NOT list_contains([STOPS], w)) AS w FROM documents),
terms AS (
  SELECT doc_id, unnest(list_concat(w, CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)),
    lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END)) AS term FROM tok),
voc AS (SELECT term FROM terms GROUP BY term ORDER BY count(*) DESC, term LIMIT 10000)
SELECT doc_id, 384 AS width, CASE WHEN doc_id IN (SELECT doc_id FROM terms JOIN voc USING (term)) THEN 1.0::DOUBLE ELSE 0.0 END AS length,
  true AS in_bounds FROM documents
""".replace("STOPS", ", ".join(f"'{w}'" for w in STOP_WORDS)))
def tfidf_svd(spark, sf_dir):
    """What must hold for the vectors whatever basis spans their directions: the width,
    unit length wherever a document has a term, and no component beyond it. Tests compare
    the directions with an exact decomposition."""
    docs = tables.spread_table(spark, sf_dir, "documents").select("doc_id", "text")
    made = svd_vectors(docs, "doc_id", "text", stop_words=list(STOP_WORDS))
    squares = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x)
    return made.select(
        F.col("id").alias("doc_id"), F.size("vector").alias("width"), F.round(F.sqrt(squares), 6).alias("length"),
        F.forall("vector", lambda x: F.abs(x) <= 1.000001).alias("in_bounds"),
    )
