"""Secret scans: candidates by pattern, false positives removed by a random forest.

The forest sees a candidate's length, its character transitions, how much of it known words cover, and the path and words beside
it. It is trained from labelled findings; without any at hand, from findings written by fixed rules below.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapework.llm.common import made_from


#: What may be a secret, words that point to one, words that point away, and common word parts.
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_.\-]{16,}")
KEY_START = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----")
KEY_END = re.compile(r"-----(?:(END) (?:[A-Z0-9]+ )*|BEGIN (?:[A-Z0-9]+ )*)PRIVATE KEY-----")
#: What stands in a key block that has no end: headers, lines of base64, and a shorter last line.
KEY_LINES = re.compile(r"(?:(?:\s|\\[nr])*(?:Proc-Type|DEK-Info):[^\n\\]*)*(?:(?:\s|\\[nr])*[A-Za-z0-9+/=]{20,})+(?:[ \t\r]*(?:\n|\\n)[A-Za-z0-9+/=]+(?=[ \t\r]*(?:\n|\\n|$)))?")
NAMED = re.compile(r"[A-Za-z0-9+/_.\-]*=+(?=[^=])")
KNOWN = r"(?:AKIA|ASIA)[0-9A-Z]{16}{0}|gh[pousr]_[A-Za-z0-9]{30,}{0}|xox[abpr]-[A-Za-z0-9-]{10,}{0}|sk_live_[A-Za-z0-9]{16,}{0}|eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]{8,}{0}|AIza[\w-]{30,}{0}"
KNOWN_FORM = re.compile(KNOWN.replace("{0}", "$"))
KNOWN_INSIDE = re.compile(f"(?<![A-Za-z0-9])(?:{KNOWN.replace('{0}', '')})(?![A-Za-z0-9])")
POINTING = "token secret password passwd pwd api_key apikey api-key access_key auth credential credentials private_key client_secret bearer key".split()
AWAY = "example sample dummy placeholder test fake changeme your sha sha1 sha256 md5 commit revision checksum digest hash uuid guid integrity etag version build id cid".split()
#: A name that points to a secret, and the unbroken value behind it: to the closing quote, or to a space, a mark of the next name or ##.
_NAMES = "token secret password passwd passphrase pwd api[_-]?key access_?key auth credentials? private_?key client_?secret bearer key".split()
POINTED = re.compile(
    rf"(?:(?<![A-Za-z0-9])(?i:{'|'.join(_NAMES)})|(?<=[a-z])(?:{'|'.join(x.capitalize() for x in _NAMES)}))(?![A-Za-z0-9])[\"'`\]]*[ \t]*(?:=>|:=|={{1,3}}|:)[ \t]*"
    r"(?:\"([^\s\"]{8,})\"|'([^\s']{8,})'|`([^\s`]{8,})`|[\"'`]?((?:(?!##|[,;&]\s*[\w.\-]+[\"']?\s*[=:])[^\s\"'`<>]){8,}))"
)
PARTS = "the and ing tion ation ment able port name user data file path test main index value string object class function return import export config service manager controller handler request response example sample http https www com org html json page image style script button header footer content table list item default public static final window document element event listener component module package version build release error message".split()
#: An address of mail or a host name: the words in it point nowhere.
ADDRESS = re.compile(r"[\w.+-]+@[\w.-]+|(?:[\w-]+\.)+(?:com|org|net|io|edu|gov|info|de|fr|es)\b")
FILE_END = re.compile(r"\.(?:com|org|net|io|html?|php|js|css|json|png|jpe?g|gif|svg|md|py|java|txt|xml|pdf|zip)(?:[/?#]|$)", re.I)
#: Labelled findings that training reads at most; trees, their depth, and candidates per leaf at least.
MOST_FINDINGS, TREES, DEPTH, LEAF, SEED = 20_000, 25, 9, 5, 7
BESIDE = 48

FEATURES = ("length", "distinct", "entropy", "transitions", "digits", "upper", "letters_run", "hex", "covered", "slashes", "dots", "dashes", "path", "known_form", "assigned", "quoted", "pointing", "away", "digits_only", "repeats")


def features(value: str, before: str, after: str) -> list[float]:
    n = len(value)
    low, left = value.lower(), before.lower()
    counts = [low.count(c) for c in set(low)]
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in value]
    covered = np.zeros(n, bool)
    for part in PARTS:
        at = low.find(part)
        while at >= 0:
            covered[at : at + len(part)] = True
            at = low.find(part, at + 1)
    runs = [len(x) for x in re.findall(r"[A-Za-z]+", value)]
    tail = left[-BESIDE:]
    near = re.split(r"[^a-z0-9_-]+", tail)[-5:]
    plain = re.split(r"[^a-z0-9_-]+", ADDRESS.sub(" ", tail))[-5:]
    return [
        n, len(counts) / n, -sum(c / n * math.log2(c / n) for c in counts), sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1),
        kinds.count("d") / n, kinds.count("u") / n, max(runs, default=0) / n, float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))), covered.mean(),
        value.count("/"), value.count("."), value.count("-"), float(bool(FILE_END.search(value)) or tail.endswith(("://", "/", "\\")) or value.startswith("/")), float(bool(KNOWN_FORM.match(value))),
        float(bool(re.search(r"[\w\]\"'-]\s*(?:=|:|=>|:=)\s*[\"'`]?$", before))), float(before[-1:] in "\"'`" and before != "" and after[:1] in "\"'`"),
        float(any(w in POINTING or any(w.endswith((f"_{p}", f"-{p}")) for p in POINTING) for w in near)), float(any(w in AWAY for w in plain) or any(w in low for w in AWAY if len(w) > 4)),
        float(value.isdigit()), max(counts) / n,
    ]


def _key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Private key blocks; one without an end goes to its last line of base64."""
    at = 0
    while m := KEY_START.search(text, at):
        at, end = m.end(), KEY_END.search(text, m.end())
        if end and end[1]:
            at = end.end()
        elif lines := KEY_LINES.match(text, m.end()):
            at = lines.end()
        else:
            continue
        yield m.start(), at


def _pieces(text: str, start: int, end: int, pointed: bool) -> Iterator[tuple[int, int, str]]:
    """A run as it is, or the keys of a known form inside it and what is left beside them."""
    value = text[start:end]
    if KNOWN_FORM.match(value):
        yield start, end, "form"
        return
    at = start
    for a, b in [*(m.span() for m in KNOWN_INSIDE.finditer(text, start, end)), (end, end)]:
        rest = text[at:a].rstrip(".-")
        if len(rest) >= (8 if pointed else 16) and (pointed or any(c.isdigit() for c in rest)):
            yield at, at + len(rest), "string"
        if b > a:
            yield a, b, "form"
        at = b


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of what may be a secret, without overlaps: key blocks, values of 8 or more characters behind a pointing name, long runs with a digit."""
    blocks = list(_key_blocks(text)) if "-----BEGIN" in text else []
    yield from ((a, b, "private_key") for a, b in blocks)
    taken = list(blocks)
    for m in POINTED.finditer(text):
        quoted = m[1] or m[2] or m[3]
        start = m.start(m.lastindex)
        value = quoted or m[4].rstrip(".,;:)]}-")
        end = start + len(value)
        if len(value) >= 8 and not any(a < end and start < b for a, b in blocks):
            taken.append((start, end))
            yield from _pieces(text, start, end, True)
    taken.sort()
    k = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        # What stands before a taken value is its name; what stands behind it is a run of its own.
        j = k
        while j < len(taken) and taken[j][0] < end:
            start, j = max(start, taken[j][1]), j + 1
        if end - start < 16:
            continue
        if name := NAMED.match(text, start, end):  # name=value: the value counts
            start = name.end()
        end = start + len(text[start:end].rstrip(".-"))
        if end - start >= 16:
            yield from _pieces(text, start, end, False)


class Forest:
    """Binary classification trees on bootstrap samples, each split chosen by Gini impurity among a random subset of features."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, seed: int = SEED):
        self.n_trees, self.depth, self.leaf, self.random = trees, depth, leaf, np.random.default_rng(seed)
        self.trees: list[tuple[np.ndarray, ...]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        for _ in range(self.n_trees):
            own = self.random.integers(0, len(y), len(y))
            nodes: list[list[float]] = []
            self._grow(x[own], y[own].astype(float), self.depth, nodes)
            self.trees.append(tuple(np.array(c) for c in zip(*nodes, strict=True)))
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, nodes: list[list[float]]) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y.mean())])
        if depth and 0 < y.mean() < 1 and len(y) >= 2 * self.leaf:
            best = (math.inf, -1, 0.0)
            for f in self.random.choice(x.shape[1], max(1, math.isqrt(x.shape[1])), replace=False):
                order = np.argsort(x[:, f], kind="stable")
                v, positive = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(y))
                left, right = positive[:-1], positive[-1] - positive[:-1]
                impurity = left * (1 - left / n) + right * (1 - right / (len(y) - n))
                impurity[(v[1:] == v[:-1]) | (n < self.leaf) | (len(y) - n < self.leaf)] = math.inf
                k = int(np.argmin(impurity))
                if impurity[k] < best[0]:
                    best = (impurity[k], int(f), (v[k] + v[k + 1]) / 2)
            if best[1] >= 0:
                goes = x[:, best[1]] <= best[2]
                nodes[at][:4] = [best[1], best[2], self._grow(x[goes], y[goes], depth - 1, nodes), self._grow(x[~goes], y[~goes], depth - 1, nodes)]
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The mean over the trees of the share of secrets in the leaf that a row falls into."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[at].astype(np.int64)
                at = np.where(f < 0, at, np.where(x[rows, np.maximum(f, 0)] <= cut[at], left[at], right[at]).astype(np.int64))
            total += share[at]
        return total / max(len(self.trees), 1)


def written_findings(n: int = 3000, seed: int = SEED) -> list[tuple[str, str, str, int]]:
    """(value, text before, text after, 1 for a secret): findings as they occur in code, prose and pages, by fixed rules."""
    r = random.Random(seed)
    alphabet = {"hex": "0123456789abcdef", "b64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-", "low": "abcdefghijklmnopqrstuvwxyz0123456789", "up": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"}
    of = lambda kind, k: "".join(r.choice(alphabet[kind]) for _ in range(k))
    syllable = lambda k: "".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve"]) for _ in range(k))
    prose = lambda: " ".join(syllable(r.randint(1, 4)) for _ in range(r.randint(2, 6))) + " "
    found = []
    for _ in range(n // 2):
        kind = r.choice(["hex", "b64", "url", "low", "up"])
        form = r.choice(["AKIA" + of("up", 16), "ghp_" + of("low", 36), "xoxb-" + of("low", 24), "sk_live_" + of("low", 24), "AIza" + of("url", 35)])
        value = of(kind, r.choice([20, 24, 32, 40, 40, 48, 64]))
        name = r.choice(POINTING + ["token", "db_password", "github_token", "aws_secret", "x-api-key"])
        quote = r.choice(['"', '"', "'", ""])
        if r.random() < 0.35:  # keys of a known form need no name beside them
            found.append((form, r.choice(["", prose(), prose() + "key "]), r.choice(["", " ", ".", "###"]) + prose(), 1))
            found.append((form[:-8] + r.choice(["EXAMPLE1", "example2", "SAMPLE99"]), prose() + r.choice(["", "example ", "key = \""]), " " + prose(), 0))
        else:
            found.append((r.choice([value, value, value, form]), prose() + name + r.choice([" = ", "=", ": ", " : ", " is "]) + quote, quote + r.choice(["", " ", "###", ";", ","]) + prose(), 1))
        plain = r.choice(
            [
                ("-".join([of("hex", 8), of("hex", 4), of("hex", 4), of("hex", 4), of("hex", 12)]), prose() + r.choice(["uuid: ", "id=", "guid ", ""]), ""),
                (of("hex", 40), prose() + r.choice(["commit ", "sha1: ", "revision ", "sha256-", "md5 ", "checksum: ", "etag: "]), ""),
                ("/".join([syllable(2), syllable(3), syllable(2) + r.choice([".html", ".js", ".png", "/" + of("hex", 6)])]), prose() + r.choice(["https://", "src=/", "see ", "href=\"/"]), ""),
                ("".join(r.choice("0123456789") for _ in range(r.choice([16, 16, 17, 20]))), prose(), ""),
                (syllable(9) + str(r.randint(1, 999)), prose(), ""),
                ("_".join(r.choice(PARTS) for _ in range(4)) + str(r.randint(0, 99)), prose() + r.choice(["key = ", "name: ", "token_type = "]), ""),
                (r.choice(["your-api-key-goes-here-1", "example_token_1234567890", "changeme1234567890", "test-placeholder-00001", "0" * 32, "x1" * 12, "1234567890abcdef1234567890"]), prose() + r.choice(POINTING) + " = \"", "\""),
                (".".join(str(r.randint(0, 255)) for _ in range(4)) + "." + str(r.randint(1000, 99999)), prose() + "version ", ""),
                (syllable(3) + "." + str(r.randint(1, 99)) + "." + syllable(4) + r.choice([".example.com", ".mail.org"]), prose(), ""),
                ("-".join(syllable(r.randint(1, 3)) for _ in range(5)) + "-" + str(r.randint(1, 2030)), prose(), ""),
                (of("b64", 64), prose() + "integrity sha256 ", ""),
                ("2024-0" + str(r.randint(1, 9)) + "-11T10-22-33." + str(r.randint(100, 999)), prose(), ""),
            ]
        )
        found.append((*plain[:2], plain[2] + " " + prose(), 0))
    # Values behind a pointing name that no length or digit gives away.
    r = random.Random(seed + 1)
    marks = "!#$%&*+-/?@^_~"
    for _ in range(n // 4):
        name, sign, quote = r.choice([*POINTING, "db_password", "admin_pwd", "client-secret"]), r.choice([" = ", "=", ": ", "\": "]), r.choice(['"', '"', "'", ""])
        k = r.randint(8, 15)
        mixed = "".join(r.sample(of("low", k - 3) + r.choice(alphabet["up"][:26]) + r.choice("0123456789") + r.choice(marks), k))
        value = r.choice([mixed, mixed, of("low", k), of("url", k), "".join(r.choice(alphabet["b64"][:52]) for _ in range(r.randint(12, 40)))])
        value = r.choice([value, value, value, r.choice(["-", "_", "", "."]).join(syllable(r.randint(2, 4)) for _ in range(4))])
        found.append((value, prose() + name + sign + quote, quote + r.choice(["", " ", ";", ","]) + prose(), 1))
        word, part = syllable(r.randint(4, 5)), r.choice(PARTS)
        code = r.choice([f"{part}.{r.choice(PARTS)}.{name}", f"get_{part}({word[:4]})", f"{part}[{word[:5]}]", f"{part}_{r.choice(PARTS)}", f"${{{word[:6].upper()}_{part.upper()}}}", f"{part}({word[:3]}.{r.choice(PARTS)})", f"self._{part}_{name}", f"process.env.{part.upper()}"])
        value, before = r.choice([(word[:14], r.choice([": ", " : ", " = "])), (code, r.choice([" = ", "=", ": "])), (code, r.choice([" = ", "="])), (r.choice(["changeme", "your-password", "undefined", "example-token", "placeholder", "xxxxxxxx", "********", "required", "optional", "password"]), r.choice([" = \"", ": \"", "="]))])
        if len(value) >= 8:
            found.append((value, prose() + name + before, r.choice(["", "\"", ";", ","]) + " " + prose(), 0))
    return found


def trained(findings: list[tuple[str, str, str, int]] | DataFrame | None = None, most: int = MOST_FINDINGS, **settings: int) -> Forest:
    """A forest from labelled findings (value, before, after, secret), of which at most `most` are read: those with the smallest hashes."""
    if isinstance(findings, DataFrame):
        c = ["value", "before", "after", "secret"]
        findings = [tuple(r) for r in findings.select(*c).dropna().orderBy(F.xxhash64(*c)).limit(most).collect()]
    findings = findings if findings is not None else written_findings()
    x = np.array([features(v, a, b) for v, a, b, _ in findings])
    return Forest(**settings).fit(x, np.array([y for *_, y in findings]))


FINDINGS = "array<struct<start:int,end:int,kind:string,score:double,value_sha256:string>>"


def scanned(docs: DataFrame, forest: Forest | None = None, threshold: float = 0.5, mask: str = "<secret>") -> DataFrame:
    """docs and findings (places in code points, scores, hashes of the values, never the values), n_candidates, masked_text.

    A candidate is a secret if the forest's score reaches the threshold; private key blocks always are. masked_text has the mask for each secret and is
    null for a null text. Every row of docs stays, with all its columns. An empty text has no findings.
    """
    forest = forest or trained()
    kind_of_findings = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64()), ("value_sha256", pa.string())]))

    def make(texts: list[str | None]) -> dict[str, pa.Array]:
        spots = [list(candidates(t)) if t else [] for t in texts]
        rows = [features(t[a:b], t[max(0, a - 2 * BESIDE) : a], t[b : b + 2]) for t, s in zip(texts, spots, strict=True) for a, b, _ in s]
        scores = iter(forest.predict(np.array(rows)) if rows else ())
        found, masked = [], []
        for t, s in zip(texts, spots, strict=True):
            kept = [(a, b, kind, 1.0 if kind == "private_key" else float(p)) for (a, b, kind), p in zip(s, scores, strict=False)]
            kept = sorted(x for x in kept if x[3] >= threshold)
            found.append([{"start": a, "end": b, "kind": kind, "score": p, "value_sha256": hashlib.sha256(t[a:b].encode()).hexdigest()} for a, b, kind, p in kept])
            parts, at = [], 0
            for a, b, _, _ in kept:
                parts += [t[at:a], mask]
                at = b
            masked.append(t if not kept else "".join([*parts, t[at:]]))
        return {"findings": pa.array(found, kind_of_findings), "n_candidates": pa.array([len(s) for s in spots], pa.int32()), "masked_text": pa.array(masked, pa.string())}

    return made_from(docs, "text", make, f"findings {FINDINGS}, n_candidates int, masked_text string")


def secret_report(docs: DataFrame) -> DataFrame:
    """A row for each finding of each document; none for null and empty texts. Repeated rows give their findings each."""
    rows = scanned(docs.select(F.col("doc_id").cast("long"), "text"))
    return rows.select("doc_id", "n_candidates", F.posexplode("findings").alias("finding", "f")).select("doc_id", "n_candidates", "finding", "f.start", "f.end", "f.kind", "f.score", "f.value_sha256")
