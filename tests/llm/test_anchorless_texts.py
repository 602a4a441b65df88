from pyspark.sql import functions as F

from tapework.llm import spotsigs

DOC = "doc_id long, text string"


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_the_whole_of_a_text_without_anchors_counts(spark):
    start = "zwei wörter "
    texts = [start + words("k", 200), start + words("q", 200), start + words("k", 3), start + words("q", 3), "wir of " + words("k", 100), "wir of " + words("k", 60) + " " + words("q", 40)]
    sets = [set(r.signatures) for r in spotsigs.fingerprints(spark.createDataFrame(list(enumerate(texts)), DOC)).orderBy("doc_id").collect()]
    assert len(sets[0]) == 200 + 1 and len(sets[0] & sets[1]) <= 2
    assert len(sets[2]) == len(sets[3]) == 1 and sets[2] != sets[3]
    assert sets[4] != sets[5] and 0.3 < len(sets[4] & sets[5]) / len(sets[4] | sets[5]) < 0.7


def test_any_changed_word_changes_the_fingerprint(spark):
    base = [f"k{i}" for i in range(30)]
    rows = [(-1, " ".join(base))] + [(i, " ".join([*base[:i], "other", *base[i + 1 :]])) for i in range(30)]
    got = spotsigs.fingerprints(spark.createDataFrame(rows, DOC)).select(F.countDistinct(spotsigs.printed(F.col("signatures"))).alias("n")).first()
    assert got.n == len(rows)
