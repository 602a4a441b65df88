"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Benchmark items are cut into windows of consecutive words. Each window's shingles are ordered by their rarity in the
corpus; a document that holds the window must hold its rarest shingle, so only that one (the necessary prefix) is joined. A
candidate passes if the window fits between the document's ends around the shingle's position, and is then
compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapework.llm.common import ascii_lower, stored

#: What stands between words; upper case is still there.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 13, 3
#: Prefix shingles are broadcast up to this number of windows (some 400 bytes each); beyond it, joins shuffle.
BROADCAST_WINDOWS = 50_000


def _parts(text: str = "text") -> Column:
    """The words of a text as they are written; the first and last part may be empty, which shifts places alike and matches nothing."""
    return F.split(F.coalesce(text, F.lit("")), GAP)


def _n_words(parts: Column) -> Column:
    return F.size(parts) - (F.get(parts, F.lit(0)) == "").cast("int") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")


def _shingle(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.lower(F.get(words, at + i)) for i in range(k)])


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """window (its words), offset-free shingles and the items that hold it, one row for each distinct window."""
    words = items.select("item_id", F.filter(F.split(ascii_lower(F.col("text")), GAP), lambda x: x != "").alias("words")).filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - width, F.lit(0))
    cut = words.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, width))).alias("window"))
    return cut.groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))


def _shingles(windows: DataFrame) -> DataFrame:
    """A row for each window and place in it: the shingle of k words there; k is 3, or less for shorter windows."""
    k = F.least(F.size("window"), F.lit(SHINGLE))
    at = windows.withColumn("k", k).select("*", F.explode(F.sequence(F.lit(0), F.size("window") - F.col("k"))).alias("at"))
    return at.select("window", "items", "k", "at", _by_k(F.col("window"), F.col("at"), F.col("k")).alias("shingle"))


def _by_k(words: Column, at: Column, k: Column) -> Column:
    made = F.when(k == 1, _shingle(words, at, 1))
    for n in range(2, SHINGLE + 1):
        made = made.when(k == n, _shingle(words, at, n))
    return made


def occurrences(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, start, length, items: every place where a document holds a window of an item."""
    spark = docs.sparkSession
    shingles = stored(_shingles(windows(items, width)))
    n_windows = shingles.select("window").distinct().count()
    sent = F.broadcast if n_windows <= BROADCAST_WINDOWS else (lambda df: df)
    ks = [r.k for r in shingles.select("k").distinct().collect()]  # at most three values
    texts = docs.filter("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_hash"), _parts().alias("words"))

    def placed(k: int) -> DataFrame:
        every = texts.select("doc_id", "text_hash", "words", F.posexplode("words").alias("pos", "word"))
        hashes = [F.lower("word"), *[F.lower(F.get("words", F.col("pos") + i)) for i in range(1, k)]]
        return every.select("doc_id", "text_hash", "words", "pos", F.xxhash64(*hashes).alias("shingle"))

    # Rarity over the whole corpus; map tasks count first, so that common shingles do not meet in one task.
    counts = None
    for k in ks:
        wanted = shingles.filter(F.col("k") == k).select("shingle").distinct()
        part = placed(k).select("shingle").join(sent(wanted), "shingle").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(k))
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        return spark.createDataFrame([], "doc_id bigint, text_hash bigint, start int, length int, items array<string>")
    counts = stored(counts)
    # A window with a shingle that no document holds is nowhere; each other one is joined by its rarest shingle.
    ranked = shingles.join(counts, ["k", "shingle"], "left").groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "shingle", "k", "items")).alias("rarest"))
    prefix = stored(ranked.filter("rarest.n > 0").select("window", F.array_join("window", " ").alias("window_text"), "rarest.at", "rarest.shingle", "rarest.k", "rarest.items"))
    found = None
    for k in ks:
        start = F.col("pos") - F.col("at")
        fits = (start >= 0) & (start + F.size("window") <= F.size("words"))
        near = placed(k).join(sent(prefix.filter(F.col("k") == k)), "shingle").filter(fits)
        # Shingles are compared in lower case; windows exactly, with only A-Z lowered. As text, since a lambda here would end
        # code generation, and each generated row would then be a copy of all the document's words.
        text = ascii_lower(F.array_join(F.slice("words", start + 1, F.size("window")), " "))
        part = near.filter(text == F.col("window_text")).select("doc_id", "text_hash", start.alias("start"), F.size("window").alias("length"), "items")
        found = part if found is None else found.unionByName(part)
    return found


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, share: int = 20) -> DataFrame:
    """docs' rows as doc_id, text_hash, n_words, n_hit, items (sorted), contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated if at least one in `share` of its words is.
    Null or wordless texts have no words and are never contaminated; items without words have no window. Rows that repeat a
    doc_id are told apart by their text; equal rows are judged alike and all kept. Null doc_ids are judged like others.
    """
    found = occurrences(docs, items, width)
    # A document's own occurrences only: no more rows meet than it has words.
    spans = found.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit"))

    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(s["start"] + s["length"], acc["end"])
        return F.struct(end.alias("end"), (acc["hit"] + end - F.greatest(s["start"], acc["end"])).alias("hit"))

    hits = spans.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.aggregate("spans", zero, step, lambda acc: acc["hit"]).alias("n_hit"), "items")
    rows = docs.withColumn("parts", _parts()).select("doc_id", F.xxhash64("text").alias("text_hash"), _n_words(F.col("parts")).cast("long").alias("n_words"))
    joined = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select("doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contamination(docs, items).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark WHERE text IS NOT NULL),
w AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS size, array_to_string(words[i : i + 12], ' ') AS win
  FROM b, unnest(range(1, greatest(len(words) - 13, 0) + 2)) AS t(i) WHERE len(words) > 0),
places AS (
  SELECT doc_id, i, size, array_to_string(words[i : i + size - 1], ' ') AS win
  FROM d, (SELECT DISTINCT size FROM w) AS s, unnest(range(1, len(words) - size + 2)) AS t(i)),
hits AS (SELECT p.doc_id, p.i, p.size, w.item_id FROM places p JOIN w USING (size, win)),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hits, unnest(range(i, i + size)) AS t(k) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
