"""Secret scans: patterns and random-looking strings are candidates, a character convolutional network scores each one.

Basic findings (``assign``, ``access``, ``hex``) always stay. A further candidate is any run of 16 or more characters of
the token alphabet, of one class of characters or of several, which does not lie wholly inside a basic finding. The network scores basic findings and further candidates alike; a further one becomes a span of kind
``model`` if the calibrated probability reaches the threshold.

The network reads ``BEFORE`` characters in front of a candidate, ``INSIDE`` ones of it and ``AFTER`` behind it. A longer
candidate is read in windows of ``INSIDE`` characters that overlap by half, the last one at its end, and has the highest
score of them. Each character is read as a class of character (a random string and prose differ in the order of classes, not in single letters) with a flag for
the part it lies in: embedding, convolutions of three widths, maximum over positions, logistic output; Adam, all numpy.
It is trained on labelled findings (``before``, ``inside``, ``after``, ``label``). Part of them, by hash, is held back:
on it Platt's scaling turns scores into probabilities. The threshold lies between the highest one that still recalls
``RECALL`` of the labelled secrets and the best scored finding below it that is none, and never below one half.

Null and empty texts have no spans; very long texts are searched whole, every pattern in linear time; equal rows get
equal results; an empty table gives an empty table; with findings of one label only there is nothing to learn and no
``model`` span is given. Other columns, whatever their names, are not read. Offsets count code points.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "model")
BEFORE, INSIDE, AFTER = 24, 48, 8
RECALL = 0.95
#: Bound of the labelled findings of each label that the network is fitted on.
MOST_FINDINGS = 4000
#: Of the groups of four words of a text, one in this many, by hash, is joined to a labelled finding that is no secret.
JOINED_EVERY = 32
LOWER_LETTERS, UPPER_LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets that labelled secrets are drawn from.
ALPHABETS = (LOWER_LETTERS + UPPER_LETTERS + DIGITS, LOWER_LETTERS + UPPER_LETTERS + DIGITS + "+/-_", UPPER_LETTERS + "234567",
             LOWER_LETTERS + DIGITS, UPPER_LETTERS + DIGITS, DIGITS + "ABCDEF", LOWER_LETTERS, UPPER_LETTERS)
SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LONG_WORD = re.compile(r"[A-Za-z]{3,}")
LETTERS_ONLY = re.compile(r"[A-Za-z.-]+")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")

#: Classes of characters: vowels and consonants apart, since words alternate them; hexadecimal letters fall into both.
CLASSES = ("", "aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ", "0123456789", "+/", "_-", "=", ".",
           "\"'`", ":", " \t\n", ",;!?()[]{}<>|", "#$%&*@^~\\")
OTHER = len(CLASSES)
CLASS_OF = {c: k for k, members in enumerate(CLASSES) for c in members}
LENGTH = BEFORE + INSIDE + AFTER


def base_findings(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def value_of(text: str, kind: str, start: int, end: int) -> str:
    """What is secret in a basic finding: for ``assign`` what stands behind the sign."""
    return ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]


def candidates(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    for m in CANDIDATE.finditer(text):
        if not any(start <= m.start() and m.end() <= end for _, start, end in taken):
            yield m.start(), m.end()


def parts(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[max(0, start - BEFORE):start], text[start:end], text[end:end + AFTER]


def windows(text: str, start: int, end: int) -> Iterator[tuple[str, str, str]]:
    """What the network reads of one candidate, part by part: all of its characters."""
    last = max(start, end - INSIDE)
    for at in (*range(start, last, INSIDE // 2), last):
        yield parts(text, at, min(at + INSIDE, end))


def encode(findings) -> np.ndarray:
    """Rows of character codes: class and part of each position, 0 where nothing stands."""
    rows = np.zeros((len(findings), LENGTH), np.int64)
    for row, (before, inside, after) in zip(rows, findings):
        for part, (offset, text) in enumerate(((BEFORE - len(before[-BEFORE:]), before[-BEFORE:]),
                                               (BEFORE, inside[:INSIDE]), (BEFORE + INSIDE, after[:AFTER]))):
            codes = [CLASS_OF.get(c, OTHER) + part * (OTHER + 1) for c in text]
            row[offset:offset + len(codes)] = codes
    return rows


class Network:
    """Embedding, convolutions with maximum over positions, logistic output."""

    def __init__(self, seed: int = 7, dim: int = 8, filters: int = 12, widths=(2, 3, 5)):
        rng = np.random.default_rng(seed)
        self.widths, self.filters = widths, filters
        self.p = {"embed": rng.normal(0, 0.3, (3 * (OTHER + 1), dim)), "out": rng.normal(0, 0.2, filters * len(widths)),
                  "bias": np.zeros(1)}
        for w in widths:
            self.p[f"w{w}"] = rng.normal(0, (w * dim) ** -0.5, (w * dim, filters))
            self.p[f"b{w}"] = np.zeros(filters)
        self.scale, self.shift, self.threshold = 1.0, 0.0, 1.1

    def forward(self, codes: np.ndarray):
        x = self.p["embed"][codes]
        x[codes == 0] = 0
        kept, pooled = {}, []
        for w in self.widths:
            windows = np.concatenate([x[:, i:LENGTH - w + 1 + i] for i in range(w)], axis=2)
            z = windows @ self.p[f"w{w}"] + self.p[f"b{w}"]
            top = z.argmax(axis=1)
            best = np.take_along_axis(z, top[:, None], 1)[:, 0]
            kept[w] = windows, top, best
            pooled.append(np.maximum(best, 0))
        features = np.concatenate(pooled, axis=1)
        return features @ self.p["out"] + self.p["bias"][0], features, kept

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        logits, features, kept = self.forward(codes)
        error = (1 / (1 + np.exp(-logits)) - labels) / len(labels)
        g = {"out": features.T @ error, "bias": np.array([error.sum()]), "embed": np.zeros_like(self.p["embed"])}
        back, dim, n = np.outer(error, self.p["out"]), self.p["embed"].shape[1], np.arange(len(labels))
        for k, w in enumerate(self.widths):
            windows, top, best = kept[w]
            d = back[:, k * self.filters:(k + 1) * self.filters] * (best > 0)
            chosen = windows[n[:, None], top]
            g[f"w{w}"] = np.einsum("nfi,nf->if", chosen, d)
            g[f"b{w}"] = d.sum(0)
            into = (d[:, :, None] * self.p[f"w{w}"].T[None]).reshape(len(n), self.filters, w, dim)
            at = codes[n[:, None, None], top[:, :, None] + np.arange(w)]
            np.add.at(g["embed"], at[at > 0], into[at > 0])
        return g

    def fit(self, codes: np.ndarray, labels: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.01, seed: int = 7):
        rng, first, second, step = np.random.default_rng(seed), {}, {}, 0
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for s in range(0, len(order), batch):
                step += 1
                for k, g in self.gradients(codes[order[s:s + batch]], labels[order[s:s + batch]]).items():
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                    second[k] = 0.999 * second.get(k, 0) + 0.001 * g * g
                    self.p[k] -= rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def calibrate(self, codes: np.ndarray, labels: np.ndarray, recall: float):
        """Platt's scaling by Newton steps on smoothed labels, then the threshold: halfway from the highest one that has the
        recall down to the next finding that is none."""
        z, n1, n0 = self.forward(codes)[0], labels.sum(), (1 - labels).sum()
        goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            v, e = p * (1 - p) + 1e-9, p - goal
            h = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-3]])
            step = np.linalg.solve(h, [(e * z).sum(), e.sum()])
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        self.scale, self.shift = max(a, 1e-3), b
        p = self.probability(codes)
        hits, misses = np.sort(p[labels == 1]), p[labels == 0]
        highest = hits[int(np.floor((1 - recall) * len(hits)))]
        self.threshold = max(0.5, (float(highest) + float(misses[misses < highest].max(initial=0.0))) / 2)
        return self

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.forward(codes)[0] + self.shift, -30, 30)))


def train(findings: pd.DataFrame, recall: float = RECALL, seed: int = 7) -> Network | None:
    """Fit on four fifths of the labelled findings, calibrate on the rest (every fifth row of each label)."""
    findings = findings.sort_values(["label", "inside", "before", "after"], ignore_index=True)
    labels = findings["label"].to_numpy(float)
    if len(set(labels)) < 2:
        return None
    codes = encode(list(zip(findings["before"], findings["inside"], findings["after"])))
    held = np.arange(len(labels)) % 5 == 0
    if len(set(labels[held])) < 2 or len(set(labels[~held])) < 2:
        held = np.ones(len(labels), bool)
        return Network(seed).fit(codes, labels, seed=seed).calibrate(codes, labels, recall)
    return Network(seed).fit(codes[~held], labels[~held], seed=seed).calibrate(codes[held], labels[held], recall)


def words_in(text: str, rng: np.random.Generator) -> str:
    """A word of the text at a random place, or none."""
    found = LONG_WORD.search(text, int(rng.integers(0, len(text))))
    return found[0][:INSIDE // 4].lower() if found else ""


def labelled_findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_FINDINGS) -> DataFrame:
    """Findings labelled by rule, for corpora without labels of people: at most ``most`` of each label, by hash.

    Label 1: the value of a basic finding (the part after the sign for ``assign``), as it stands, and a string drawn from
    each of ``ALPHABETS``, some behind a name, a number or a word, in its place or between other words of the text, since
    leaked keys differ in alphabet and form. Label 0:
    joined words of the prose, paths and names with separators, candidates that hold letters, dots and hyphens only, and
    identifiers of 8, 4, 4, 4 and 12 hexadecimal digits.
    """
    schema = "before string, inside string, after string, label int"

    @F.pandas_udf(f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
    def label(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            rows, text = [], text or ""
            base = base_findings(text)
            for kind, start, end in base:
                start = end - len(value_of(text, kind, start, end))
                before, inside, after = parts(text, start, end)
                rng = np.random.default_rng(len(text) + start)
                rows.append((before, inside, after, 1))
                digits = "".join(rng.choice(list("0123456789abcdef"), 32))
                made = [("".join(rng.choice(list(letters), rng.integers(20, 64))), 1) for letters in ALPHABETS]
                name, signs = "".join(rng.choice(list(LOWER_LETTERS), rng.integers(2, 6))), rng.choice(list("_-"), 2)
                number = "".join(rng.choice(list(DIGITS), rng.integers(6, 14)))
                made += [(name + signs[0] + made[0][0], 1), (name + signs[0] + number + signs[0] + made[0][0], 1),
                         (name + signs[0] + words_in(text, rng) + signs[1] + made[0][0], 1)]
                made.append(("-".join(digits[i:j] for i, j in ((0, 8), (8, 12), (12, 16), (16, 20), (20, 32))), 0))
                for k, (string, what) in enumerate(made):
                    at = text.find(" ", int(rng.integers(0, len(text)))) + 1
                    around = parts(text, at, at) if (k + start) % 2 else (before, "", after)
                    rows.append((around[0], string, " " + around[2] if (k + start) % 2 else after, what))
            words = list(LONG_WORD.finditer(text))
            for k in range(0, len(words) - 3, 4):
                four = [m[0] for m in words[k:k + 4]]
                code = zlib.crc32(" ".join(four).encode())
                if code % JOINED_EVERY == 0:
                    sign, way = "-_./"[code >> 8 & 3], (code >> 10) % 3
                    before, _, after = parts(text, words[k].start(), words[k].start())
                    rows.append((before, (sign.join(four), "".join(w.capitalize() for w in four), sign.join(four[:3]) + str(code >> 12 & 3))[way],
                                 " " + after, 0))
            apart = [(s, e) for s, e in candidates(text, base) if not any(b < e and s < d for _, b, d in base)]
            rows += [(before, inside[:INSIDE], after, 0) for before, inside, after in (parts(text, s, e) for s, e in apart)
                     if LETTERS_ONLY.fullmatch(inside)]
            out.append([dict(zip(("before", "inside", "after", "label"), r)) for r in rows])
        return pd.Series(out, dtype=object)

    # texts are read once for both labels
    rows = stored(docs.select(F.explode(label(F.col(f"`{text_col}`"))).alias("f")).select("f.*"), "findings").dropDuplicates()
    # the lowest hashes of each label: a top-k, kept small in every task
    order = F.xxhash64("before", "inside", "after")
    chosen = [rows.where(F.col("label") == k).orderBy(order, "before", "inside", "after").limit(most) for k in (0, 1)]
    return chosen[0].unionByName(chosen[1])


def find_secrets(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 recall: float = RECALL) -> DataFrame:
    """One row per document: the id and ``spans``. ``findings`` is a bounded table of labelled findings (see above)."""
    network = train(findings.toPandas(), recall)

    @F.pandas_udf(SPAN)
    def find(texts: pd.Series) -> pd.Series:
        spans, block = [[] for _ in texts], []
        proposed, best = [], []

        def scored():
            if network and block:
                for (k, _), p in zip(block, network.probability(encode([b[1] for b in block]))):
                    best[k] = max(best[k] or 0.0, float(p))
            block.clear()

        for k, text in enumerate(texts):
            base = base_findings(text) if text else []
            found = [(kind, s, e, e - len(value_of(text, kind, s, e))) for kind, s, e in base]
            found += [("model", s, e, s) for s, e in (candidates(text, base) if text else ())]
            for kind, start, end, value in found:
                proposed.append((k, kind, start, end))
                best.append(None)
                for window in windows(text, value, end):
                    block.append((len(best) - 1, window))
                    if len(block) == 1024:
                        scored()
        scored()
        for (k, kind, start, end), p in zip(proposed, best):
            if kind in BASE or p is not None and p >= network.threshold:
                spans[k].append((kind, start, end, None if p is None else round(p, 6)))
        return pd.Series([[dict(zip(("kind", "start", "end", "score"), s))
                           for s in sorted(row, key=lambda s: (s[1], KINDS.index(s[0])))] for row in spans], dtype=object)

    return docs.select(F.col(f"`{id_col}`").alias(id_col), find(F.col(f"`{text_col}`")).alias("spans"))
