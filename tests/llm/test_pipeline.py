import corpus_pipeline as cp
from tapework.llm import decontaminate, language, secrets
from tests.llm.test_llm import plain_components

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120).persist()
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    seen = {r.doc_id: r for r in language.identified(docs, language.learned_from(docs)).collect()}
    one = cp.identify_language(spark, docs, SF).persist()
    assert one.columns == docs.columns
    assert {r.doc_id for r in one.collect()} == {i for i, r in seen.items() if r.lang_pred != "und" and r.score >= cp.LEAST_SCORE}
    two = cp.drop_near_duplicates(spark, one, SF).persist()
    plain = plain_components([(r.doc_id, r.text) for r in one.collect()])
    assert {r.doc_id for r in two.collect()} == {i for i, (_, c) in plain.items() if i == c}
    three = cp.decontaminate_benchmark(spark, two, SF).persist()
    bad = {r.doc_id for r in decontaminate.contamination(two, benchmark).filter("contaminated").collect()}
    assert {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect()} - bad
    four = cp.mask_secrets(spark, three, SF).persist()
    assert four.schema == docs.schema and four.count() == three.count()
    forest = secrets.trained()
    left = [f for r in secrets.scanned(four, forest).collect() for f in r.findings]
    assert left == []
    for r in four.collect():
        assert r.text == before[r.doc_id].text or "<secret>" in r.text and r.n_chars == len(r.text)
    assert {r.doc_id for r in cp.pack(spark, four, SF).collect()} == {r.doc_id for r in four.collect()}
