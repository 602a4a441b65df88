"""Columns that clash with names of the stages' own come through as they were, with the values that go with them."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"
NAMES = ["score", "Lang_Pred", "masked_text", "findings", "n_candidates", "d", "h", "_id", "__component", "component_id", "text_hash", "contaminated", "parts", "words", "rep", "key"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").limit(3).select((F.monotonically_increasing_id() + 9000).alias("doc_id"), "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    more = [(8001, 'the value is token = "269b1cea0846965f2d3ecb5cdb87c0edc7a7a587" and more of the words', "en", None, 5), (8002, None, None, None, None), (8003, "", "en", "s", 0), (None, "some text of no id that is here", "en", "s", 3), (8004, " ".join(f"w{k} the word" for k in range(40_000)), "en", "s", 1)]
    rows = real.select(*bench.columns).unionByName(bench).unionByName(spark.createDataFrame(more, SCHEMA)).unionByName(spark.createDataFrame(more[:1] * 2, SCHEMA))
    return spark.createDataFrame(rows.collect(), SCHEMA).persist()


@pytest.mark.parametrize("k", range(4))
def test_clashing_columns(spark, docs, k):
    name, stage = cp.STAGES[k]
    plain = stage(spark, docs, SF)
    clash = docs.withColumns({n: F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in NAMES})
    got = stage(spark, clash, SF)
    assert got.columns == clash.columns and [f.dataType for f in got.schema] == [f.dataType for f in clash.schema]
    rows = [r.asDict() for r in got.collect()]
    assert all(r[n] == f"{n} {'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for n in NAMES)
    assert sorted(repr([r[c] for c in docs.columns]) for r in rows) == sorted(repr(list(r)) for r in plain.collect())
    assert stage(spark, clash.limit(0), SF).isEmpty()
    ids = {r["doc_id"] for r in rows}
    if name == "secret scans":
        assert all("269b1cea" not in (r["text"] or "") for r in rows) and len(rows) == docs.count()
    if name == "benchmark decontamination":
        assert not ids & {9000, 9001, 9002} and {8002, 8003, None} <= ids
    if name == "n-gram Jaccard join":
        assert sum(r["doc_id"] == 8001 for r in rows) == 1 and {8002, 8003, None} <= ids
    if name == "language ID":
        assert not ids & {8002, 8003}


def test_packing_of_clashing_columns(spark, docs):
    few = docs.filter("n_chars < 2000 OR n_chars IS NULL").select(*docs.columns)
    clash = few.withColumns({n: F.lit("x") for n in ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]})
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got, want = (sorted(map(repr, cp.pack(spark, x, SF).select(*key).collect())) for x in (clash, few))
    assert got == want
