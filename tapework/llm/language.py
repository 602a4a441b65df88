"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time, labels every byte of a text and pools the labels'
probabilities over the document. Texts are read whole, in segments of a fixed number of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapework.llm.common import made_from

#: Bytes of a segment, units of each direction, and segments that run side by side.
SEGMENT, UNITS, SIDE_BY_SIDE = 64, 8, 2048
#: Training reads so many labelled documents of a language at most, of each this many characters from a place drawn by hash.
DOCUMENTS_PER_LANGUAGE, CHARACTERS = 400, 256
STEPS, BATCH, RATE, SEED = 350, 128, 0.02, 11
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


@dataclass
class Network:
    """weights: per direction d, input table Wd (256 x 3H), recurrence Ud (H x 3H), bias bd (H) of the inner candidate; output V (2H x K), c (K)."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @staticmethod
    def new(languages: list[str], units: int = UNITS, seed: int = SEED) -> Network:
        r = np.random.default_rng(seed)
        w = {"V": r.normal(0, 0.3, (2 * units, len(languages))), "c": np.zeros(len(languages))}
        for d in "fb":
            w |= {f"W{d}": r.normal(0, 0.3, (256, 3 * units)), f"U{d}": r.normal(0, 0.4, (units, 3 * units)), f"b{d}": np.zeros(units)}
        return Network(languages, {k: v.astype(np.float32) for k, v in w.items()})

    def _forward(self, data: np.ndarray, d: str, tape: list | None = None) -> np.ndarray:
        """States (T x B x H) of one direction over data (T x B bytes); tape gets what backpropagation needs."""
        W, U, b = self.weights[f"W{d}"], self.weights[f"U{d}"], self.weights[f"b{d}"]
        units = len(b)
        states = np.empty((*data.shape, units), np.float32)
        h = np.zeros((data.shape[1], units), np.float32)
        for t in range(len(data)) if d == "f" else range(len(data) - 1, -1, -1):
            x, u = W[data[t]], h @ U
            gates = _sigmoid(x[:, : 2 * units] + u[:, : 2 * units])
            z, r = gates[:, :units], gates[:, units:]
            inner = u[:, 2 * units :] + b
            n = np.tanh(x[:, 2 * units :] + r * inner)
            if tape is not None:
                tape.append((t, h, z, r, inner, n))
            h = n + z * (h - n)
            states[t] = h
        return states

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """For every byte (T x B): the probabilities of the languages."""
        return self._softmax(self._forward(data, "f"), self._forward(data, "b"))

    def _softmax(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        units = forward.shape[-1]
        V = self.weights["V"]
        y = forward @ V[:units]
        y += backward @ V[units:]
        y += self.weights["c"]
        y -= y.max(-1, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(-1, keepdims=True)
        return y

    def gradients(self, data: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for data (T x B), the label of each column and the weight of each byte."""
        tapes: dict[str, list] = {"f": [], "b": []}
        states = {d: self._forward(data, d, tapes[d]) for d in "fb"}
        p = self._softmax(states["f"], states["b"])
        total = max(float(weight.sum()), 1.0)
        columns = np.arange(data.shape[1])
        loss = float(-(np.log(np.maximum(p[:, columns, labels], 1e-9)) * weight).sum() / total)
        p[:, columns, labels] -= 1
        p *= weight[..., None] / total
        V, units = self.weights["V"], len(self.weights["bf"])
        g = {"V": np.concatenate([np.einsum("tbh,tbk->hk", states[d], p) for d in "fb"]), "c": p.sum((0, 1))}
        for d, rows in (("f", V[:units]), ("b", V[units:])):
            W, U = np.zeros_like(self.weights[f"W{d}"]), np.zeros_like(self.weights[f"U{d}"])
            bias, carried = np.zeros(units, np.float32), np.zeros_like(states[d][0])
            out = p @ rows.T
            for t, h, z, r, inner, n in reversed(tapes[d]):
                dh = out[t] + carried
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * inner * r * (1 - r)
                through = np.concatenate([dz, dr, dn * r], 1)
                np.add.at(W, data[t], np.concatenate([dz, dr, dn], 1))
                U += h.T @ through
                bias += (dn * r).sum(0)
                carried = dh * z + through @ self.weights[f"U{d}"].T
            g |= {f"W{d}": W, f"U{d}": U, f"b{d}": bias}
        return loss, g

    def fit(self, texts: list[bytes], labels: list[int], steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> Network:
        """Adam on batches with as many texts of each language; every text gives a segment from a random place."""
        r = np.random.default_rng(seed)
        by = [np.flatnonzero(np.asarray(labels) == k) for k in range(len(self.languages))]
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        s = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            y = r.integers(0, len(by), batch)
            data, weight = np.zeros((SEGMENT, batch), np.uint8), np.zeros((SEGMENT, batch), np.float32)
            for j, k in enumerate(y):
                text = texts[r.choice(by[k])]
                at = int(r.integers(0, max(1, len(text) - SEGMENT + 1)))
                part = np.frombuffer(text[at : at + SEGMENT], np.uint8)
                data[: len(part), j], weight[: len(part), j] = part, 1
            _, g = self.gradients(data, y, weight)
            lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, v in g.items():
                v = np.clip(v, -1, 1)
                m[k] += 0.1 * (v - m[k])
                s[k] += 0.005 * (v * v - s[k])
                self.weights[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.995**step)) + 1e-8)).astype(np.float32)
        return self

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """For each text, which must not be empty, the mean probabilities over all its bytes."""
        total = np.zeros((len(texts), len(self.languages)))
        sizes = [-(-len(t) // SEGMENT) for t in texts]
        # Segments of many texts run side by side, so many at a time that memory stays bounded.
        group: list[tuple[int, bytes]] = []
        for i, (t, n) in enumerate(zip(texts, sizes, strict=True)):
            for a in range(0, n, SIDE_BY_SIDE):
                group.append((i, t[a * SEGMENT : (a + SIDE_BY_SIDE) * SEGMENT]))
                if sum(-(-len(x) // SEGMENT) for _, x in group) >= SIDE_BY_SIDE:
                    self._pool(group, total)
                    group = []
        if group:
            self._pool(group, total)
        return total / np.maximum(np.array([[len(t)] for t in texts]), 1)

    def _pool(self, group: list[tuple[int, bytes]], total: np.ndarray) -> None:
        owner = np.concatenate([np.full(-(-len(t) // SEGMENT), i) for i, t in group])
        data = np.frombuffer(b"".join(t + bytes(-len(t) % SEGMENT) for _, t in group), np.uint8).reshape(-1, SEGMENT)
        length = np.concatenate([np.minimum(SEGMENT, len(t) - SEGMENT * np.arange(-(-len(t) // SEGMENT))) for _, t in group])
        p = self.probabilities(np.ascontiguousarray(data.T))
        p *= (np.arange(SEGMENT)[:, None] < length)[..., None]
        sums = p.sum(0, dtype=np.float64)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        total[owner[starts]] += np.add.reduceat(sums, starts, axis=0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learned(labelled: DataFrame, per_language: int = DOCUMENTS_PER_LANGUAGE, characters: int = CHARACTERS, **settings: int) -> Network | None:
    """A network from rows with text and lang, at most per_language documents of each language; None if there is none.

    Every row is read, copies of a text in a language count once; those that are learned have the smallest hashes of the texts
    drawn by hash, for each language on its own, so the same table gives the same network.
    """
    usable = labelled.select("text", "lang", F.xxhash64("text").alias("h")).filter(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN))
    counts = {r["lang"]: r["n"] for r in usable.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2.0 * per_language / n))])
    h = F.col("h")
    drawn = F.pmod(h, F.lit(1_000_003)) / 1_000_003.0 < F.element_at(share, F.col("lang"))
    at = F.pmod(F.shiftright(h, 20), F.greatest(F.char_length("text") - characters, F.lit(0)) + 1) + 1
    # About 2 * per_language rows of each language, as copies fall together before they are sent.
    parts = usable.filter(drawn).select("lang", "h", F.substring(F.col("text"), at.cast("int"), F.lit(characters)).alias("part"))
    rows = parts.groupBy("lang", "h").agg(F.min("part").alias("part")).orderBy("h", "lang").collect()
    languages, taken = sorted(counts), dict.fromkeys(counts, 0)
    texts, labels = [], []
    for r in rows:
        if r["part"] and taken[r["lang"]] < per_language:
            taken[r["lang"]] += 1
            texts.append(r["part"].encode())
            labels.append(languages.index(r["lang"]))
    present = sorted(set(labels))
    return Network.new([languages[k] for k in present]).fit(texts, [present.index(k) for k in labels], **settings)


def identified(docs: DataFrame, network: Network | None) -> DataFrame:
    """docs and lang_pred, score: the language of each whole text and its pooled probability.

    Null texts, texts without a letter and all texts where nothing was learned are `und` with score 0. All rows and columns of docs stay.
    """

    def make(texts: list[str | None]) -> dict[str, pa.Array]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        where = [i for i, t in enumerate(texts) if network and t and LETTER.search(t)]
        if where:
            p = network.pooled([texts[i].encode("utf-8", "replace") for i in where])
            for i, k, s in zip(where, p.argmax(1), p.max(1), strict=True):
                names[i], scores[i] = network.languages[k], min(1.0, float(s))
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}

    return made_from(docs, "text", make, "lang_pred string, score double")


def learned_from(docs: DataFrame, **settings: int) -> Network | None:
    """A network from the documents that are not held out."""
    return learned(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), **settings)


def language_report(docs: DataFrame) -> DataFrame:
    """The columns of op4 for documents (doc_id, text, lang). A null doc_id is not held out and not learned from; repeated rows stay, an empty table gives none."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return identified(rows, learned_from(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
