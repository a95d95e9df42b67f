"""The pipeline at the smallest scale, stage by stage against plain Python."""

from conftest_llm import brute_classes

import corpus_pipeline as cp
from logloom.llm import pieces
from logloom.llm.work import staged


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in cp.STAGES:
        made = staged(stage(spark, docs, sf_dir), "test-stage")
        seen.append((docs.collect(), made.collect()))
        if name != cp.STAGES[-1][0]:
            assert made.columns == columns and made.count() > 0
        docs = made
    before, after = seen[0]
    kept = {r.doc_id for r in after}
    assert all(len(r.text.split()) >= 10 for r in after) and len(kept) == len(after) < len(before)
    before, after = seen[1]
    assert {r.doc_id for r in after} == {d for d, _, c, keep in brute_classes([(r.doc_id, r.text) for r in before]) if keep}
    before, after = seen[2]
    assert {tuple(r) for r in after} < {tuple(r) for r in before}
    before, after = seen[3]
    texts = {r.doc_id: r.text for r in before}
    v = pieces.vocabulary(pieces.read_model(pieces.MODEL))
    assert {(r.doc_id, r["sample"]) for r in after} == {(d, s) for d in texts for s in (1, 2)}
    import numpy as np
    assert all(pieces.decode_ids(np.array(r.ids), v).decode() == texts[r.doc_id] for r in after)


def test_run_and_empty(spark, sf_dir, no_docs):
    assert cp.run(spark, sf_dir).count() > 0
    for _, stage in cp.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0


def test_columns_of_the_input_stay(spark, sf_dir, docs):
    """Columns named as those that stages add, nulls and repeated rows pass the stages unchanged."""
    from pyspark.sql import functions as F
    rows = docs.withColumns({"weight": F.lit("w"), "tokens": F.concat(F.lit("t"), F.col("doc_id").cast("string")),
                             "own_kept": F.lit(1), "n_words": F.lit(None).cast("string")})
    before = {tuple(r) for r in rows.collect()}
    for _, stage in cp.STAGES[:-1]:
        made = stage(spark, rows, sf_dir)
        assert made.dtypes == rows.dtypes
        got = made.collect()
        assert got and {tuple(r) for r in got} <= before
    encoded = cp.STAGES[-1][1](spark, rows, sf_dir)
    assert {r.doc_id for r in encoded.collect()} <= {r.doc_id for r in rows.collect()}
