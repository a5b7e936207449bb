"""The stages on the smallest tables: columns, what goes and what stays."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from areastats.llm import decontamination  # noqa: E402
from areastats.llm.common import stored  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    results = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
        results[name] = docs
    return results


def test_columns_and_counts(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert stages[name].dtypes == stages[""].dtypes
    counts = [stages[n].count() for n in ("", *names[:-1])]
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] == counts[4]
    assert counts[3] > 0.7 * counts[0]


def test_no_exact_copies_stay(stages):
    kept = [" ".join((r.text or "").split()).lower() for r in stages["near_duplicates"].collect()]
    assert len(kept) == len(set(kept))


def test_no_passage_stays(stages):
    items = [(r.item_id, r.text) for r in stages[""].sparkSession.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    plain = [decontamination.normal(t) for _, t in items]
    for r in stages["decontamination"].collect():
        text = decontamination.normal(r.text or "")
        assert not any(p in text for p in plain)


def test_run_is_the_last_stage_and_reruns_agree(spark, stages):
    again = corpus_pipeline.run(spark, SF_DIR)
    columns = ["doc_id", "mix_copy", "mix_taken"]
    assert sorted(map(tuple, again.select(columns).collect())) == sorted(map(tuple, stages["mixing"].select(columns).collect()))


def test_empty_and_odd_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, "text without id", "en", "a", 15), (90_001, None, None, None, None), (90_002, "", "en", "a", 0), (90_003, "same words here", "en", "a", 15), (90_003, "same words here", "en", "a", 15)],
        docs.schema,
    )
    for rows in (odd, docs.limit(0)):
        now = rows
        for _, stage in corpus_pipeline.STAGES:
            now = stored(stage(spark, now, SF_DIR), "odd")
        assert now.count() <= 2 * rows.count()
