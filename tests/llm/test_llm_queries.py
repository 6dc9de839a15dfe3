"""The registered queries against SQL or against brute force over the smallest tables."""

import hashlib
import zlib

import pandas as pd
import pytest
from check import compare, duck, run

from eddyline.llm import queries as q

SF = "/root/testdata/sf0.001"
DOCS = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_against_sql(spark, name):
    columns, _, rows = run(duck(SF), q.ORACLES[name])
    assert compare(q.QUERIES[name](spark, SF), columns, rows) > 0


def test_token_counts(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(q.vocabulary(q.BYTE_BPE))
    found = {r.doc_id: r for r in q.QUERIES["op1_token_counts"](spark, SF).collect()}
    assert len(found) == len(DOCS)
    for doc_id, text in zip(DOCS.doc_id, DOCS.text):
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (found[doc_id].n_bytes, found[doc_id].n_tokens, found[doc_id].over_limit) == (len(text.encode()), n, n > 1024)


def test_pieces(spark):
    found = {r.doc_id: r for r in q.QUERIES["op3_sentencepiece"](spark, SF).collect()}
    assert len(found) == len(DOCS) and all(r.lossless for r in found.values())
    for doc_id, text in zip(DOCS.doc_id, DOCS.text):
        assert found[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name, label, folds, fold, least", [("op4_toxicity", "toxic", 5, 0, 0.9), ("op5_quality", "quality", 3, 1, 0.95)])
def test_held_out_accuracy(spark, name, label, folds, fold, least):
    sf = "/root/testdata/sf0.1"
    found = q.QUERIES[name](spark, sf).toPandas()
    assert found.score.between(0, 1).all() and ((found.score >= 0.5) == (found.predicted == 1)).all()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % folds == fold for i in found.doc_id]).all()
    known = found[found.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    right = known.predicted == known[label]
    rare = known[known[label] == known[label].value_counts().idxmin()]
    assert right.mean() > 0.97 and (rare.predicted == rare[label]).mean() > least - 0.1


def test_simhash(spark):
    import re

    import xxhash

    found = {r.doc_id: r for r in q.QUERIES["op6_simhash"](spark, SF).collect()}
    marks = {}
    for doc_id, text in zip(DOCS.doc_id, DOCS.text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        k = min(4, len(words))
        h = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), seed=42) for i in range(len(words) - k + 1)]
        marks[doc_id] = sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))
    group = {d: d for d in marks}
    for a in marks:
        for b in marks:
            if (marks[a] ^ marks[b]).bit_count() <= 4:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    for d in marks:
        assert found[d].fingerprint == f"{marks[d]:016x}" and found[d].component_id == group[d]


def test_edit_fingerprints(spark):
    found = {r.doc_id: r for r in q.QUERIES["op7_edit_fingerprints"](spark, SF).collect()}
    texts = dict(zip(DOCS.doc_id, DOCS.text))
    ids = sorted(texts)
    near = far = 0
    for a, b in zip(ids, ids[1:] + ids[:1]):
        k = len(texts[a]) // 4
        edited = texts[a][: len(texts[a]) - k] + texts[b][:k]
        assert found[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and found[a].n_chars == len(texts[a])
        near, far = near + found[a].near_edited, far + (found[a].near_next if texts[a] != texts[b] else 0)
        if texts[a] == texts[b]:
            assert found[a].near_next == 1.0 and found[a].fingerprint == found[b].fingerprint
    assert near / len(ids) > 0.65 and far / len(ids) < 0.2
