"""Token counts behind a cache keyed by content digest and tokenizer digest.

A text is encoded once per tokenizer version, however many documents hold it and however
often the counts are asked for: digests meet the stored counts in a join, one document
per unseen digest lends its text to the encoder, and the new counts are appended.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm.common import by_size, slices, strings, whole_text, written

SCHEMA = "digest binary, n_tokens bigint, tokenizer string"
LONG_TEXT = 1 << 20
BATCH_CHARS = 1 << 19
# A blank after a visible character always starts a new pre-token of the byte-level
# pattern, so counts on both sides of it add up.
SEAM = re.compile(r"(?<=[A-Za-z0-9.,;:!?])(?=[ \n])")
# So does a mark after a Latin letter or digit. A unit runs from one such place to the next:
# a word with the white space before it, or marks.
MARKS = ".,;:!?"
UNIT = re.compile(rf"\s*\S(?:[^\s{MARKS}]+|(?<![A-Za-z0-9À-ÖØ-öø-ÿ])[{MARKS}]|[^\S \n]\s*)*|\s+")
KEPT_UNITS = 1 << 18
KEPT_CHARS = 64  # longer units are counted, but not kept


class JsonCounter:
    """Counts with the ``tokenizers`` library: no added, begin or end tokens, no
    truncation, no padding; strings of special tokens inside a text as its default."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.splits = _splits(json.loads(self.tokenizer.to_str()))
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def _pieces(self, text: str):
        """Long texts in pieces that cannot share a token, so memory stays bounded."""
        if len(text) <= LONG_TEXT or not self.splits:
            return [text]
        pieces, start = [], 0
        while len(text) - start > LONG_TEXT:
            seam = SEAM.search(text, start + LONG_TEXT)
            if seam is None:
                break
            pieces.append(text[start : seam.start()])
            start = seam.start()
        return [*pieces, text[start:]]

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_unit(self, texts: list[str]) -> list[int]:
        """Counts of units met before are kept, in two generations: what was not used for a
        while goes, memory is bounded."""
        units = [UNIT.findall(text) for text in texts]
        if len(self.young) >= KEPT_UNITS // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = set(chain.from_iterable(units)).difference(young)
        young.update((u, old[u]) for u in missing & old.keys())
        new = list(missing - old.keys())
        young.update(zip(new, self._encoded(new)))
        out = [sum(map(young.__getitem__, own)) for own in units]
        for unit in new:
            if len(unit) > KEPT_CHARS:
                del young[unit]
        return out

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        flat = [(i, piece) for i, text in enumerate(texts) for piece in self._pieces(text)]
        for a, b in by_size([len(p) for _, p in flat], BATCH_CHARS):
            pieces = [p for _, p in flat[a:b]]
            for (i, _), n in zip(flat[a:b], self._by_unit(pieces) if self.splits else self._encoded(pieces)):
                out[i] += n
        return out


def _splits(tokenizer: dict) -> bool:
    """Whether counts add up over seams: the byte-level pattern decides alone where tokens
    may end, and no added token reaches over white space or marks."""
    before = tokenizer["pre_tokenizer"] or {}
    return (
        before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
        and tokenizer["normalizer"] is None and not tokenizer["model"].get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or re.search(rf"[\s{MARKS}]", t["content"]) for t in tokenizer["added_tokens"])
    )


class ModelCounter:
    """Counts with the ``sentencepiece`` library."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        out = []
        for a, b in by_size([len(t) for t in texts], BATCH_CHARS):
            out += [len(ids) for ids in self.model.encode(texts[a:b], num_threads=1)]
        return out


def tokenizer_digest(path: str) -> str:
    """Identifies the version of a vocabulary: the SHA-256 of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


@lru_cache(maxsize=1)
def _counter(path: str, version: str):
    """Stays in its worker, as do the counts it has kept, for the tasks that follow."""
    return JsonCounter(path) if path.endswith(".json") else ModelCounter(path)


def _encode(path: str, version: str):
    def body(batches):
        for batch in (part for whole in batches for part in slices(whole, "text", 1 << 20)):
            counts = _counter(path, version).counts(strings(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return body


def stored_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """One row per digest; a digest appended twice (a retried run) has equal counts."""
    fields = SCHEMA.replace(", tokenizer string", "")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/tokenizer={tokenizer}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], fields)
    rows = spark.read.schema(fields).parquet(path.toString())
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str) -> DataFrame:
    """``doc_id, digest, n_bytes, n_tokens`` for every row of ``docs(doc_id, text)``.

    ``cache`` is a folder all executors reach; ``tokenizer_path`` a file that every one of
    them has. Normalised content is the text with NULL as '' and nothing else changed, as
    any other change could change the count. NULL and empty texts have no tokens. Repeated
    rows and NULL ids give one row each; of other columns nothing is read. An empty table
    gives an empty result.

    Only digests shuffle, and the text of one row per unseen digest. A digest that a
    large part of the rows share collapses before the shuffle; in the last join, which
    carries no text, adaptive execution splits it.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    text = whole_text()
    keyed = docs.select(
        "doc_id", text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    wanted = written(keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "digests")
    missing = wanted.join(stored_counts(spark, cache, version), "digest", "left_anti")
    # A digest whose rows all lack an id has no row to borrow from by id: those few
    # go by digest instead. A digest has one id here, so its rows are together after the
    # join, and one of them stays.
    by_id = keyed.join(missing, ["digest", "doc_id"], "left_semi").select("digest", "text", "doc_id")
    without = keyed.filter("doc_id IS NULL").join(missing.filter("doc_id IS NULL"), "digest", "left_semi")
    once = by_id.dropDuplicates(["digest", "doc_id"])
    texts = once.unionByName(without.select("digest", "text", "doc_id").dropDuplicates(["digest"]))
    new = texts.select("digest", "text").mapInArrow(_encode(tokenizer_path, version), "digest binary, n_tokens bigint")
    new.write.mode("append").parquet(f"{cache}/tokenizer={version}")
    # As a table of its own, so that the join below shuffles both sides and can be split.
    counts = written(stored_counts(spark, cache, version).join(wanted, "digest", "left_semi"), "counts")
    return keyed.drop("text").join(counts, "digest", "left").select("doc_id", "digest", "n_bytes", "n_tokens")
