"""The pipeline against the same stages done by hand on the same documents."""

import corpus_pipeline as cp
import pandas as pd
from test_operators import brute_lines

from eddyline.llm.common import read_table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    documents = read_table(spark, SF, "documents")
    kept, docs = [], documents
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF).toPandas()
        assert list(out.columns) == documents.columns, name
        kept.append(out.set_index("doc_id"))
        docs = spark.createDataFrame(out, documents.schema)
    good, lines, alone, clean = kept
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    known = labels[labels.index.isin(documents.toPandas().doc_id)]
    assert (known.index.isin(good.index) == (known == 1)).mean() > 0.9
    assert lines.text.to_dict() == brute_lines(good.text.to_dict())
    assert (lines.n_chars == lines.text.str.len()).all() and set(lines.index) == set(good.index)
    assert set(clean.index) <= set(alone.index) <= set(lines.index) and len(alone) < len(lines)
    assert (alone.text == lines.text[alone.index]).all()
    final = {r.doc_id: r for r in cp.run(spark, SF).collect()}
    assert set(final) == set(clean.index) and all(r.lossless for r in final.values())


def test_stages_on_awkward_rows(spark, odd):
    docs = odd.selectExpr("doc_id", "text", "cast(null as string) as lang", "'s' as source", "0L as n_chars", "score", "part")
    for frame in (docs, docs.limit(0)):
        rows = frame
        for _, stage in cp.STAGES:
            rows = stage(spark, rows, SF)
        assert rows.count() <= frame.count()
