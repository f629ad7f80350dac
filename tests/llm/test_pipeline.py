import corpus_pipeline as P
from moodlake.llm import jaccard_join, quality

from tests.conftest import SF_SMALL
from tests.llm.test_jaccard_join import brute
from tests.llm.test_pii import brute as brute_pii
from tests.llm.test_tokens_packing import check_packing, ids_of


def test_stages_one_by_one(spark):
    """Each stage against its brute force, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in P.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF_SMALL).cache()
        assert kept.columns == columns, name
        old, new = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in kept.collect()}
        assert 0 < len(new) == kept.count() and new.keys() <= old.keys()
        if name == "quality_rules":
            assert {r.doc_id for r in quality.quality_report(before).where("kept").collect()} == set(new)
        if name == "near_duplicates":
            ids = sorted(old)
            _, roots = brute([old[i].text for i in ids])
            assert set(new) == {ids[r] for r in roots}
        if name == "personal_data":
            assert new.keys() == old.keys()
            assert all(brute_pii(r.text) == [] for r in new.values())
            assert all(new[i].text == old[i].text for i in old if not brute_pii(old[i].text) and new[i].text == old[i].text)
        if name == "mixture":
            assert all(new[i] == old[i] for i in new)
    rows = P.STAGES[-1][1](spark, kept, SF_SMALL).collect()
    assert check_packing(rows, {i: ids_of(r.text) for i, r in new.items()}) < 0.3
    assert sorted(map(tuple, P.run(spark, SF_SMALL).drop("sequence_id", "offset").collect())) == sorted(
        (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        kept = docs
        for _, stage in P.STAGES:
            kept = stage(spark, kept, SF_SMALL)
        assert kept.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        kept.collect()
    assert jaccard_join.PERCENT == 75 and jaccard_join.SIZE == 5
