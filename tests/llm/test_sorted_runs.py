"""Runs are merged in the order in which they were written."""

import re

import numpy as np
from pyspark.sql import functions as F

from tapework.llm import substrings


def test_no_sort_over_the_scan_of_a_run(spark, tmp_path, monkeypatch):
    r = np.random.default_rng(5)
    texts = [" ".join(map(str, r.integers(0, 30, 60))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "d long, text string").select("d", F.lit(0).cast("long").alias("r"), "text")
    plans, stored = [], substrings.stored

    def seen(df, *more):
        plans.append(df._jdf.queryExecution().sparkPlan().toString() if not plans else df._jdf.queryExecution().executedPlan().toString())
        return stored(df, *more)

    monkeypatch.setattr(substrings, "stored", seen)
    index = substrings.SubstringIndex(spark, str(tmp_path / "index"))
    for k in range(2):
        index.add(docs.filter(f"d >= {20 * k} AND d < {20 * k + 20}"))
    lines = [re.sub(r"^[\s:+\-*]*(\(\d+\) )?", "", x) for x in plans[-1].split("\n")]
    over = [above for above, below in zip(lines, lines[1:], strict=False) if below.startswith("FileScan parquet")]
    assert sum("Bucketed: true" in x for x in lines) >= 3
    # Between a run's scan and its merge stand only filters, projections and codegen's columns-to-rows.
    for i, x in enumerate(lines):
        if x.startswith("FileScan parquet") and "Bucketed: true" in x:
            above = [y.split(" ")[0] for y in lines[max(i - 4, 0) : i]]
            assert "Sort" not in above[-3:], plans[-1]
    assert over
    index.drop()
