from pyspark.sql import functions as F

from tapework.llm import language


def test_copies_take_no_places(spark, monkeypatch):
    """10,000 copies of the text with the smallest hash leave every language its own texts."""
    rows = [(f"{name} text {i} words", name) for name in ("aa", "bb", "cc") for i in range(30)]
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("h", F.xxhash64("text"))
    hot = df.filter("lang = 'aa'").orderBy("h").first()
    copies = spark.range(10_000).select(F.lit(hot.text).alias("text"), F.lit("aa").alias("lang"))
    seen = {}

    def fit(self, texts, labels, **settings):
        seen[len(seen)] = (list(self.languages), sorted(zip(texts, labels)))
        return self

    monkeypatch.setattr(language.Network, "fit", fit)
    plain = df.select("text", "lang")
    language.learned(plain, per_language=40, characters=64)
    language.learned(plain.unionByName(copies), per_language=40, characters=64)
    assert seen[0][0] == ["aa", "bb", "cc"] and len(seen[0][1]) == 90
    assert seen[1] == seen[0]
