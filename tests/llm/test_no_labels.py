"""Without a usable label no document counts as toxic."""

from conftest_rows import ROWS
from fluxmill.llm import toxicity


def test_no_usable_label(spark, docs):
    ids = [r[0] for r in ROWS if r[0] is not None]
    known = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    held_out = [r.doc_id for r in toxicity.with_fold(known).where("held_out").collect()]
    for rows in ([], [(i, None) for i in ids], [(i, 1) for i in held_out], [(9999, 1), (None, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        assert toxicity.without_toxic(docs, labels).count() == len(ROWS)
        scores = toxicity.toxicity_scores(docs, labels).collect()
        assert len(scores) == len(ROWS) and all(r.predicted == 0 and 0 <= r.score < 1e-9 for r in scores)
