"""Arrow batches are bounded by bytes, whoever read the documents."""

import corpus_pipeline as P
import pytest
from moodlake.llm import common


@pytest.fixture()
def unbounded(spark):
    old = spark.conf.get(common.BATCH)
    spark.conf.set(common.BATCH, str(64 << 20))
    yield
    spark.conf.set(common.BATCH, old)


def test_written_tables(spark, unbounded, monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 1 << 20)

    def rows(batches):
        for pdf in batches:
            yield pdf.assign(text=pdf["text"].str[:1], n=len(pdf))

    texts = spark.createDataFrame([("x" * 500_000,)] * 20, "text string").coalesce(1)
    sizes = [r.n for r in common.materialize(texts.mapInPandas(rows, "text string, n long"), "sizes").collect()]
    assert len(sizes) == 20 and max(sizes) <= 4
    assert spark.conf.get(common.BATCH) == str(64 << 20)


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES])
def test_stages(spark, odd_docs, unbounded, stage):
    out = stage(spark, odd_docs, "")
    assert spark.conf.get(common.BATCH) == str(common.BATCH_BYTES) and out.columns
