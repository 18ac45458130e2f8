import corpus_pipeline
from pyspark.sql import functions as F
from marketlane.llm import quality
from marketlane.llm.common import table
from marketlane.llm.packing import CAPACITY
from tests.llm.frames import ODD, documents
from tests.llm.test_decontamination import plain_hits
from tests.llm.test_packing import check_layout, expected_pieces, plain_best_fit
from tests.llm.test_simhash_wide import plain_first
from tests.llm.test_substring import plain


def test_run_equals_plain_stages(spark, small):
    docs, labels, items = (table(spark, small, n) for n in ("documents", "labels", "benchmark"))
    good = {r["doc_id"] for r in quality.quality_scores(docs, labels).collect() if r["score"] >= 0.5}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in good]
    assert 0 < len(rows) < docs.count()
    rows = plain_first(rows)
    rows = [(i, t) for (i, _), t in plain(rows).items()]
    bad = {h[0] for h in plain_hits(rows, [(r["item_id"], r["text"]) for r in items.collect()])}
    want = list(expected_pieces([r for r in rows if r[0] not in bad]))
    got = corpus_pipeline.run(spark, small).collect()
    assert bad and sorted(tuple(r)[:5] for r in got) == sorted(want)
    assert check_layout(got, CAPACITY) == plain_best_fit([w[3] for w in want], CAPACITY)


def test_stages_keep_columns_and_bear_odd_rows(spark, small):
    docs = documents(spark, ODD)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).columns == docs.columns
        assert stage(spark, docs.limit(0), small).count() == 0
    wide = docs.withColumn("a.b", F.lit(1)).withColumn("m", F.create_map(F.lit("k"), F.lit(2)))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, wide, small).columns == wide.columns
        assert stage(spark, wide, small).count() > 0
    done = docs
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, done, small)
    assert done.count() > 0
