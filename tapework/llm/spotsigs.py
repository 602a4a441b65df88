"""SpotSigs document fingerprints, in DataFrame functions only.

A signature is an anchor (a very common word) and the chain of the next content words after it. Where no anchor is near, as in
other languages, code and lists, every word is one, so no stretch of a text stays out of its fingerprint.
A document's fingerprint is the sorted set of its signatures' 32-bit hashes. Sets are partitioned by
their length, and only sets whose lengths allow the wanted Jaccard similarity are compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapework.llm.common import partitions, stored

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from has have he in is it its of on or that the this to was were will with "
    "als auf aus das dem den der des die ein eine er es für ist mit nicht sich sie und von war zu "
    "au aux avec ce dans du elle en est et il la le les ne pas par pour que qui sa se son sur un une "
    "como con de del el las lo los más no o para pero por su sus y"
)
MARK = "\u0001"
#: A word with no anchor in so many words before and behind it is an anchor itself.
NEAR = 8


def fingerprints(df: DataFrame, text: str = "text", out: str = "signatures", anchors: str = ANCHORS) -> DataFrame:
    """df and one more column, array<int>: the sorted set of a text's signature hashes, from chains of two content words.

    Of anchors in a row, the last counts. The start of a text is an anchor too, so that every text with a
    word has a signature; a text of at most NEAR words without another anchor has one of all its words. Null, empty and wordless texts have none. Case and punctuation are ignored.
    """
    by_letter = {x[0]: sorted({y[1:] for y in anchors.split() if y[0] == x[0]}) for x in anchors.split()}
    some = "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in by_letter.items())
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    marked = F.regexp_replace(F.concat(F.lit(" "), plain, F.lit(" ")), f" ({some})(?= )", f"{MARK}$1")
    # The parts are a column of their own: inside the expression below, Spark would split the text again for every part.
    bare = F.rlike(F.col("__marked"), F.lit(f"(?:(?:^| )[^{MARK} ]+(?=[ {MARK}])){{{NEAR + 1}}}"))
    dealt = df.withColumn("__marked", marked).withColumns({"__parts": F.split("__marked", " "), "__bare": bare})
    return dealt.withColumn(out, _chains(F.col("__parts"), F.col("__bare"))).drop("__marked", "__parts", "__bare")


def _chains(parts: Column, bare: Column) -> Column:
    # An element is a content word and, behind a mark, the anchor that follows it; the first and last may be empty.
    word = lambda i: F.substring_index(F.get(parts, i), MARK, 1)
    marked = lambda x: F.contains(x, F.lit(MARK))
    spots = F.filter(
        F.transform(
            parts,
            lambda x, i: F.when(
                ((i == 0) & (F.size(parts) > 1) & (F.concat(x, F.get(parts, i + 1)) != "")) | (marked(x) & (i < F.size(parts) - 3)),
                F.hash(F.substring_index(x, MARK, -1), word(i + 1), word(i + 2)),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    # A chain of three words in a stretch without anchors; the end of a text cuts none off that the chain before it does not hold.
    alone = F.filter(
        F.transform(
            parts,
            lambda x, i: F.when(
                (i > 0) & (i < F.size(parts) - 3) & ~F.exists(F.slice(parts, F.greatest(i - NEAR, F.lit(0)) + 1, F.least(i, F.lit(NEAR)) + (NEAR + 1)), marked),
                F.hash(F.lit(MARK), x, word(i + 1), word(i + 2)),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    short = (F.size(parts) > 2) & (F.size(parts) <= NEAR + 2) & ~F.exists(parts, marked)
    found = F.when(short, F.array(F.hash(parts))).when(bare, F.concat(spots, alone)).otherwise(spots)
    return F.sort_array(F.array_distinct(found))


def printed(signature_set: Column) -> Column:
    """The fingerprint as text: each signature as eight hexadecimal digits, in ascending order of signed value."""
    return F.array_join(F.transform(signature_set, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets, 0 to 1; two empty sets are alike. Sets that cannot overlap are not compared."""
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(shared / (F.size(a) + F.size(b) - shared))
    )


def length_partition(n: Column, threshold: float) -> Column:
    """Sets of this partition can be similar only to sets of the same or a neighbouring one."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(threshold)) + F.lit(1e-9)).cast("int")


def near_duplicates(df: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, pairs): every document with the smallest id of its fingerprint's class, and the similar pairs of such representatives.

    Equal fingerprints collapse before anything is paired. Similar sets share one of the first signatures, in
    hash order, of either (prefix filter), and lie in the same or neighbouring length partitions. Documents
    without signatures are each on their own. Null ids are kept as members and pair with nothing.
    """
    sets = stored(fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "signatures"))
    keyed = sets.withColumn("print", F.sha2(printed(F.col("signatures")), 256))
    classes = keyed.filter(F.size("signatures") > 0).groupBy("print").agg(F.min("doc_id").alias("class_id"), F.first("signatures").alias("signatures"))
    members = keyed.select("doc_id", "print").join(classes.select("print", "class_id"), "print", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    n = F.size("signatures")
    ranked = classes.filter("class_id IS NOT NULL").select("class_id", "signatures", n.alias("n"), length_partition(n, threshold).alias("part"))
    prefix = F.slice("signatures", 1, F.greatest(n - F.ceil(n * threshold - 1e-9) + 1, F.lit(1)).cast("int"))
    keys = ranked.select("class_id", "n", "part", F.explode(prefix).alias("signature"))
    other = keys.select(F.col("class_id").alias("other_id"), F.col("n").alias("m"), F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"), "signature")
    # The other side is the shorter set, or as long with the smaller id; it is offered to its own partition and the next.
    near = keys.join(other, ["part", "signature"]).filter(((F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("other_id") < F.col("class_id")))) & (F.col("m") >= F.col("n") * threshold - 1e-9))
    pairs = near.select("class_id", "other_id").distinct()
    pairs = pairs.join(ranked.select("class_id", F.col("signatures").alias("a")), "class_id").join(ranked.select(F.col("class_id").alias("other_id"), F.col("signatures").alias("b")), "other_id")
    return members, pairs.withColumn("similarity", likeness(F.col("a"), F.col("b"))).filter(F.col("similarity") >= threshold).select("class_id", "other_id", "similarity")


def with_next(df: DataFrame, doc_id: str, carried: list[str], blocks_per_partition: int = 4) -> DataFrame:
    """df with next_<column> for each carried column: its value in the next row by doc_id; after the last row, in the first.

    Ids are dealt into ranges cut at approximate percentiles, which are values of the table. The row that
    starts a range also goes, marked, to the range before, so no single task sees all rows. Null ids come first; ties
    are ordered by the hash of the carried columns.
    """
    n = partitions(df.sparkSession) * blocks_per_partition
    ends = df.select(F.percentile_approx(doc_id, [i / n for i in range(1, n)], 10 * n).alias("cuts"), F.min(doc_id).alias("least"), F.count_if(F.col(doc_id).isNull()).alias("nulls")).first()
    cuts = sorted({x for x in ends.cuts or [] if ends.nulls or x != ends.least})
    first = None if ends.nulls else ends.least
    cut_list = F.array(*[F.lit(x).cast("long") for x in cuts]) if cuts else F.array().cast("array<long>")
    block = F.coalesce(F.size(F.filter(cut_list, lambda x: x <= F.col(doc_id))), F.lit(0))
    block = F.when(F.col(doc_id).isNull(), F.lit(0)).otherwise(block)
    starts = F.array_contains(cut_list, F.col(doc_id)) if cuts else F.lit(False)
    is_first = F.col(doc_id).eqNullSafe(F.lit(first).cast("long"))
    places = F.when(is_first, F.array(F.lit(0), F.lit(-1) - len(cuts))).when(F.coalesce(starts, F.lit(False)), F.array(block, -block)).otherwise(F.array(block))
    # A negative place is the halo of range |place| - 1.
    dealt = df.withColumn("__place", F.explode(places)).withColumns({"__halo": F.col("__place") < 0, "__block": F.when(F.col("__place") < 0, -F.col("__place") - 1).otherwise(F.col("__place"))}).drop("__place")
    dealt = dealt.repartition(partitions(df.sparkSession), "__block")
    return dealt, W.partitionBy("__block").orderBy("__halo", F.col(doc_id).asc_nulls_first(), F.xxhash64(*carried))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside that of its edited text (its last quarter replaced by the start of the next document) and the next document's."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    dealt, order = with_next(rows, "doc_id", ["text"])
    dealt = fingerprints(dealt)
    dealt = dealt.select("*", F.lead("text").over(order).alias("next_text"), F.lead("signatures").over(order).alias("next_signatures")).filter(~F.col("__halo"))
    n, quarter = F.char_length("text"), F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    both = fingerprints(dealt.select("doc_id", "signatures", "next_signatures", n.cast("long").alias("n_chars"), edited.alias("edited")), "edited", "edited_signatures")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        printed(F.col("signatures")).alias("fingerprint"),
        printed(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
        F.size("signatures").alias("n_signatures"),
    )
