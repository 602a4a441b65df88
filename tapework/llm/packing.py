"""Best-fit packing of tokenized documents into sequences, with certified repacking.

Pieces are packed partition by partition with best-fit decreasing. Dual-feasible functions give each
partition a lower bound for its number of sequences. Partitions above their bound give up the documents of their
sequences that are not full; those meet in fewer partitions and are packed again.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapework.llm.common import stored, worker_memo

VOCABULARY = "word_bpe_49k.json"
LIMIT, END = 2048, 0
#: Words whose ids a Python worker remembers; others are encoded each time they occur.
REMEMBERED = 700_000
#: Marks that may end a word and are encoded apart from it.
MARKS = ".,;:!?*#$%&|)\""
#: Pieces that are packed together at first, about; and how often partitions with gaps exchange documents.
PIECES_PER_PARTITION, EXCHANGES = 50_000, 2


def encoder(path: str, remembered: int = REMEMBERED):
    """text -> its ids as little-endian 32-bit bytes, as the tokenizer file gives them.

    Words between white space are encoded apart and remembered, which gives the same ids: no rule of the vocabulary spans white space.
    Texts beyond Latin-1, with special tokens or with control characters that count as white space only in Python take the plain path.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
    known: dict[str, bytes] = {}

    def plain(text: str) -> bytes:
        return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn(words: list[str]) -> dict[str, bytes]:
        found = {}
        tails = [(w, core, w[len(core) :]) for w in words if (core := w.rstrip(MARKS)) and core.isalpha()]
        # Words of letters alone end where a token ends a word, so one call encodes them all.
        new = [c for c in dict.fromkeys(c for _, c, _ in tails) if c not in known]
        ids = np.asarray(tokenizer.encode(" ".join(new), add_special_tokens=False).ids, dtype="<u4")
        cut = np.flatnonzero(ends[ids]) + 1
        found.update((w, x.tobytes()) for w, x in zip(new, np.split(ids, cut[:-1]), strict=True)) if new else None
        for w, core, tail in tails:
            if tail:
                if tail not in found and tail not in known:
                    found[tail] = plain(tail)
                found[w] = (found.get(core) or known[core]) + (found.get(tail) or known[tail])
        for w in words:
            if w not in found:
                found[w] = plain(w)
        return found

    def ids(text: str) -> bytes:
        if "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return plain(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return plain(text)
        words = text.lower().split()
        parts = list(map(known.get, words))
        if None in parts:
            found = learn(list(dict.fromkeys(w for w, x in zip(words, parts, strict=True) if x is None)))
            parts = [found[w] if x is None else x for w, x in zip(words, parts, strict=True)]
            if len(known) < remembered:
                known.update(found)
        return b"".join(parts)

    return ids


def pieces(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and a closing 0, cut only where longer than limit."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary
        if path is None:
            import public_tokenizers  # where this executor has it

            path = str(public_tokenizers.path(VOCABULARY))
        memo = worker_memo()
        encode = memo.get(path) or memo.setdefault(path, encoder(path))
        end = np.asarray([END], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
            of, *columns = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else [[]] * 5))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(columns[0].astype(np.int32)), *[pa.array(c) for c in columns[1:]]], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the room left in each bin. Longest first, each into the fullest bin that takes it."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # the distinct rooms there are, ascending: at most limit
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        k = bisect_left(rooms, n)
        if k < len(rooms):
            r = rooms[k]
            b = by_room[r].pop()
            if not by_room[r]:
                del by_room[r], rooms[k]
        else:
            r, b = limit, len(room)
            room.append(limit)
        bins[i], offsets[i] = b, limit - r
        room[b] = left = r - n
        if left:
            if left not in by_room:
                by_room[left] = []
                insort(rooms, left)
            by_room[left].append(b)
    return bins, offsets, np.asarray(room, np.int64)


def bins_needed(counts: np.ndarray, limit: int = LIMIT) -> int:
    """A lower bound for the bins of items, counts[n] of length n, by two families of dual-feasible functions.

    One drops items of at most e and counts those above limit - e as whole bins. The other rounds the share of an item
    k + 1 times as large down to whole parts of 1 / k, where it isn't whole already.
    """
    n = np.arange(limit + 1)
    best = -(-int((n * counts).sum()) // limit)
    mass, number = np.cumsum(n * counts), np.cumsum(counts)
    for e in range(1, limit // 2 + 1):
        whole = number[-1] - number[limit - e]
        middle = mass[limit - e] - mass[e - 1]  # items of e to limit - e keep their length
        best = max(best, int(whole) - (-int(middle) // limit))
    for k in range(1, 33):
        scaled = (k + 1) * n
        parts = np.where(scaled % limit == 0, n * k, (scaled // limit) * limit)  # in units of 1 / (k * limit)
        best = max(best, -(-int((parts * counts).sum()) // (k * limit)))
    return best


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, bin long, offset long, room long, gap long"


def _packed(df: DataFrame, limit: int) -> DataFrame:
    def pack(rows: pa.Table) -> pa.Table:
        lengths = rows["length"].to_numpy().astype(np.int64)
        bins, offsets, room = best_fit_decreasing(lengths, limit)
        gap = len(room) - bins_needed(np.bincount(lengths, minlength=limit + 1), limit)
        for name, values in (("bin", bins), ("offset", offsets), ("room", room[bins]), ("gap", np.full(len(bins), gap, np.int64))):
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        return rows.select([c.split()[0] for c in PACKED.split(", ")])

    return df.groupBy("part").applyInArrow(pack, PACKED)


def packed(pieces: DataFrame, limit: int = LIMIT, per_partition: int = PIECES_PER_PARTITION, exchanges: int = EXCHANGES) -> DataFrame:
    """pieces and sequence_id, offset: where each lies. pieces is read more than once: give a stored table.

    Pieces are dealt evenly by a hash of their row and place, so neither a hot source nor equal rows meet in one partition. Each exchange packs what partitions
    gave up in partitions of at most some four times as many pieces. Repeated rows are packed each for itself. An empty table gives none.
    """
    n = pieces.count()
    parts = max(1, round(n / per_partition))
    base = ["doc_id", "piece", "start", "length", "ids_crc32"]
    dealt = pieces.select(*base, F.pmod(F.xxhash64(*base, F.monotonically_increasing_id()), F.lit(parts)).alias("part"))
    now = stored(_packed(dealt, limit))
    kept = []
    for turn in range(exchanges):
        # Full sequences are done; so are well filled ones of partitions that meet their bound.
        free = ((F.col("gap") > 0) & (F.col("room") > 0)) | (F.col("room") > limit // 8)
        left = now.filter(free).count()
        if not left or parts == 1:
            break
        parts = max(1, round(left / (4 * per_partition)))
        kept.append(now.filter(~free).withColumn("turn", F.lit(turn)))
        now = stored(_packed(now.filter(free).select(*base, F.pmod(F.xxhash64("part", "bin"), F.lit(parts)).alias("part")), limit))
    result = now.withColumn("turn", F.lit(len(kept)))
    for df in kept:
        result = result.unionByName(df)
    number = F.col("turn").cast("long") * F.lit(1 << 58) + F.col("part") * F.lit(1 << 32) + F.col("bin")
    return result.select(*base, number.alias("sequence_id"), "offset")


def packed_documents(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """docs tokenized, cut and packed: null text is empty and is one piece of the closing token."""
    return packed(stored(pieces(docs, vocabulary, limit)), limit)
