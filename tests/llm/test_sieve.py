from pyspark.sql import functions as F

from tapework.llm.common import sifted


def test_sieve_keeps_every_id_and_few_others(spark):
    big = 2**60
    df = spark.range(40_000).select((F.col("id") + big).alias("rep"), F.lit("t").alias("text"))
    df = df.unionByName(spark.createDataFrame([(None, "null"), (-5, "negative"), (-6, "other"), (-5, "again")], "rep long, text string"))
    ids = df.filter((F.col("rep") % 97 == 0) | (F.col("rep") == -5)).select("rep").unionByName(spark.createDataFrame([(None,), (-5,)], "rep long"))
    got = sifted(df, ids, "rep")
    assert got.columns == ["rep", "text"]
    wanted = df.join(ids.distinct(), "rep", "left_semi")
    assert wanted.exceptAll(got).count() == 0
    assert got.count() - wanted.count() < 20
    assert got.filter("rep IS NULL").count() == 0
    assert sifted(df, ids.limit(0), "rep").count() == 0
