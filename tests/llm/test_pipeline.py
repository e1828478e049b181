"""The pipeline's stages on a small input, each against what its operator says."""

import corpus_pipeline as P
from stormlake.llm import decontaminate, jaccard_join, quality
from stormlake.llm.common import pick, table
from tests.llm.data import empty, messy

SF = "/root/testdata/sf0.001"


def _ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    stages = dict(P.STAGES)

    kept = stages["quality"](spark, docs, SF)
    narrow = pick(docs, doc_id="doc_id", text="text")
    scores = quality.quality_scores(narrow, pick(table(spark, SF, "labels"), doc_id="doc_id", quality="quality"))
    assert kept.columns == columns and _ids(kept) == _ids(scores.where("predicted = 1"))

    once = stages["near_duplicates"](spark, kept, SF)
    classes = jaccard_join.jaccard_join(pick(kept, doc_id="doc_id", text="text"))
    assert once.columns == columns and _ids(once) == _ids(classes.where("doc_id = class_id"))

    clean = stages["decontaminate"](spark, once, SF)
    marks = decontaminate.contamination(pick(once, doc_id="doc_id", text="text"),
                                        pick(table(spark, SF, "benchmark"), item_id="item_id", text="text"))
    assert clean.columns == columns and _ids(clean) == _ids(marks.where("NOT contaminated"))

    mixed = stages["mix"](spark, clean, SF)
    assert mixed.columns == columns and set(_ids(mixed)) <= set(_ids(clean))
    sharded = stages["shard"](spark, mixed, SF)
    assert _ids(sharded) == _ids(mixed)


def test_run(spark):
    got = P.run(spark, SF)
    assert {"doc_id", "shard", "slot"} <= set(got.columns) and got.count() > 0


def test_stages_take_messy_and_empty_documents(spark):
    for name, stage in P.STAGES:
        docs = messy(spark)
        out = stage(spark, docs, SF)
        assert out.count() <= 3 * docs.count()
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        assert stage(spark, empty(spark), SF).count() == 0, name
