"""Sets of word shingles, and links that are confirmed on the full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapework.llm.common import FEW_TEXTS, partitions, setting, sifted, stored
from tapework.llm.wordhash import Words, batches, mix

#: Sets that are compared with one other set in one task, about.
ROOM = 500


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct hashes of its k-word shingles; of the whole text, if it has fewer words but any."""
    words = Words(texts, lower=True)
    runs, whole = words.runs(k), words.whole(k)
    order = np.flatnonzero(whole)
    doc, value = words.doc[order], runs[order]
    by = np.lexsort((value, doc))
    doc, value = doc[by], value[by]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])] if len(doc) else np.zeros(0, bool)
    doc, value = doc[new], value[new]
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    for i, n in enumerate(words.n):
        if 0 < n < k:
            h = np.uint64(n)
            for w in words.hash[words.first[i] : words.first[i] + n]:
                h = mix(np.array([h], np.uint64) * np.uint64(31) + w)[0]
            yield np.array([h], np.uint64)
        else:
            yield value[cut[i] : cut[i + 1]]


def linked_sets(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets that are not empty."""
    small, large = (p, q) if len(p) <= len(q) else (q, p)
    if not len(small):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return both > 0 and 100 * both >= percent * (len(p) + len(q) - both)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs (a, b) whose full sets are linked; sets are made anew from the texts (rep, text) of the documents in question. A rep may have several texts.

    A text travels once for each a that it is compared with, not once for each pair; those of one a arrive in slices of about ROOM, each behind a copy of a's own.
    Pairs and texts meet as rows, so a document that very many others are compared with is spread like any other skewed key.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / ROOM).cast("int").alias("slices"))
    rooms = pairs.join(sizes, "a").select("a", "b", F.pmod(F.hash("b"), F.col("slices")).alias("s"))
    # A document waits in each room where it is b, and as a in every slice of its own that has a b.
    asks = rooms.select(F.col("b").alias("rep"), "a", "s", F.lit(1).alias("later")).unionByName(rooms.select(F.col("a").alias("rep"), "a", "s", F.lit(0).alias("later")).distinct())

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, own = None, []
        for frame in frames:
            found = []
            a, s, later, rep = (frame.column(i).to_pylist() for i in range(4))
            for first, group in batches(frame.column(4).to_pylist()):
                for i, q in enumerate(shingle_sets(group, k), first):
                    if room != (a[i], s[i]):
                        room, own = (a[i], s[i]), []
                    if not later[i]:
                        own.append(q)
                    elif any(linked_sets(p, q, percent) for p in own):
                        found.append((a[i], rep[i]))
            yield pa.RecordBatch.from_arrays([pa.array([f[x] for f in found], pa.int64()) for x in (0, 1)], names=["a", "b"])

    # Few documents are in question: a sieve keeps the other texts out of the shuffle.
    either = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
    dealt = sifted(texts, either, "rep").join(asks, "rep").select("a", "s", "later", "rep", "text")
    dealt = dealt.repartition(partitions(texts.sparkSession), "a", "s").sortWithinPartitions("a", "s", "later")
    with setting(texts.sparkSession, FEW_TEXTS):
        return stored(dealt.mapInArrow(run, "a long, b long").distinct())
