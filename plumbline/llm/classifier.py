"""Quality classifier from weak labels.

Several heuristic labellers vote good, bad or nothing on every text; they overlap and none is right always. Votes are
counted by pattern over all documents, and expectation-maximisation on these counts estimates how often each labeller
votes what for a good and for a bad text, and the share of good ones; it knows no label. Every pattern then has a
posterior probability of being good. A linear scorer over hashed words, word pairs and word shapes is trained to give
these posteriors, so that it also judges what no labeller speaks about, and scores every text.

All documents are counted; the scorer is fitted on the driver on a bounded sample: texts of at most ``MOST_CHARS``
characters whose id's hash falls under a share that makes about ``MOST_ROWS`` of them, and never more than twice as many.

Null and empty texts get one bad vote and score 0; very long texts are read whole; equal rows get equal
results; an empty table gives an empty table; if all texts show one pattern its posterior is what the start says. Other
columns, whatever their names, stay untouched in ``filter_classified`` and are not read elsewhere.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import fresh

MOST_ROWS = 6000
MOST_CHARS = 20_000
BUCKETS = 1 << 16
#: Below one half: a document goes only where the scorer is fairly sure.
THRESHOLD = 0.3
GOOD, BAD, NONE = "g", "b", "-"
#: Frequent words of several languages, a fixed list.
COMMON = frozenset("the of and to in a is that for it as was with be by on not he his but at are this have from or an "
                   "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es "
                   "le la les de et des en un une du que est dans qui par pour sur au pas "
                   "el los las y que en por con para una se del no lo su".split())
LABELLERS = ("letters", "repeats", "symbols", "word_length", "common_words", "capitals", "separators", "variety", "sentences")


def vote(value: float, good, bad) -> str:
    """Good and bad are tests of the value."""
    return GOOD if good(value) else BAD if bad(value) else NONE


def votes_of(text: str | None) -> str:
    """One letter per labeller."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return BAD + NONE * (len(LABELLERS) - 1)
    letters = sum(map(len, words))
    lower = [w.lower() for w in words]
    runs = set(zip(lower, lower[1:], lower[2:])) if n > 2 else ()
    symbols = sum(text.count(c) for c in "#*$%&<>{}[]\\^~|=_")
    capitals = sum(map(str.isupper, words)) / n
    lines = [line for line in text.split("\n") if line.strip()]
    ended = sum(line.rstrip()[-1:] in ".!?\"'»”:" for line in lines) / len(lines)
    return "".join((
        vote(sum(map(str.isalpha, text)) / letters, lambda x: x > 0.85, lambda x: x < 0.6),
        vote(1 - len(runs) / (n - 2), lambda x: x < 0.1, lambda x: x > 0.3) if n > 20 else NONE,
        vote(symbols / letters, lambda x: x < 0.005, lambda x: x > 0.05),
        vote(letters / n, lambda x: 3.5 <= x <= 8, lambda x: x < 2.5 or x > 11),
        vote(sum(map(COMMON.__contains__, lower)) / n, lambda x: x > 0.12, lambda x: x < 0.02) if n > 20 else NONE,
        vote(capitals, lambda x: x < 0.1, lambda x: x > 0.3),
        vote(sum(len(w) == 1 and not w.isalnum() for w in words) / n, lambda x: x < 0.02, lambda x: x > 0.15),
        vote(len(set(lower)) / n ** 0.9, lambda x: x > 0.6, lambda x: x < 0.25) if n > 20 else NONE,
        vote(ended, lambda x: x > 0.6, lambda x: x < 0.2) if lines else NONE,
    ))


def votes(text: Column) -> Column:

    @F.pandas_udf("string")
    def cast(texts: pd.Series) -> pd.Series:
        return pd.Series([votes_of(t) for t in texts], dtype=object)

    return cast(text)


class LabelModel:
    """Two classes; given the class, labellers vote independently of each other. To say nothing tells nothing."""

    def __init__(self, counts: dict[str, float], rounds: int = 200, prior: float = 1.0):
        patterns = sorted(counts)
        n = np.array([counts[p] for p in patterns], float)
        seen = np.array([[[c == v for v in (GOOD, BAD, NONE)] for c in p] for p in patterns], float)
        labellers = len(patterns[0]) if patterns else len(LABELLERS)
        seen = seen.reshape(len(patterns), labellers, 3)
        self.share, self.accuracy = 0.5, np.full((2, labellers, 2), 0.5)  # what is known without documents
        # the start is the majority of the votes; it also says which class is the good one
        good, bad = seen[:, :, 0].sum(1), seen[:, :, 1].sum(1)
        posterior = (good + 0.5) / (good + bad + 1)
        for _ in range(rounds if patterns else 0):
            weight = np.stack([posterior, 1 - posterior]) * n
            self.share = (weight[0].sum() + prior) / (n.sum() + 2 * prior)
            table = np.einsum("cp,plv->clv", weight, seen[:, :, :2]) + prior
            self.accuracy = table / table.sum(axis=2, keepdims=True)
            told = np.einsum("plv,clv->cp", seen[:, :, :2], np.log(self.accuracy))
            odds = np.log(self.share / (1 - self.share)) + told[0] - told[1]
            new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            done = np.abs(new - posterior).max(initial=0) < 1e-6
            posterior = new
            if done:
                break
        self.posteriors = dict(zip(patterns, posterior.tolist()))


def shape(word: str) -> str:
    """Classes of characters, runs shortened: Xx. for a capitalised word with a full stop."""
    body, end = (word, "") if word.isalpha() else (word[:-1], word[-1])
    # plain words, with a mark behind them or not, need no search
    if body.isalpha() and not end.isalnum():
        if body.islower():
            return "x" + end
        if body[0].isupper() and body[1:].islower():
            return "Xx" + end
        if body.isascii() and body.isupper():
            return "X" + end
    return long_shape(word)


def long_shape(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", re.sub(r"\d", "0", word)))


def features(text: str | None, shapes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their weights, the square roots of their shares, so that length does not matter."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    crc, found = zlib.crc32, []
    for w in words:
        code = shapes.get(w)
        if code is None:
            if len(shapes) > 200_000:
                shapes.clear()
            code = shapes[w] = crc(shape(w[:64]).encode()) % BUCKETS
        found.append(code)
    marks = np.array(found)
    plain = np.fromiter((crc(w.lower().encode(), 1) % BUCKETS for w in words), np.int64, len(words))
    pairs = (marks[1:] * 31 + marks[:-1] * 17 + 7) % BUCKETS
    repeats = np.sort(plain)
    again = int((repeats[1:] == repeats[:-1]).sum() * 10 // len(words))  # tenths of the words that stood before
    codes, counts = np.unique(np.concatenate([marks, pairs, plain, np.full(len(words), (again * 7919 + 3) % BUCKETS)]), return_counts=True)
    return codes, np.sqrt(counts / counts.sum())


def train(rows: list[tuple[np.ndarray, np.ndarray]], goals: np.ndarray, epochs: int = 15, rate: float = 0.5, l2: float = 1e-5,
          seed: int = 8) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by AdaGrad; both labels have the same total weight."""
    weights, bias, squares, bias_square = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-6), 1e-6
    balance = (0.5 / max(goals.mean(), 1e-3), 0.5 / max(1 - goals.mean(), 1e-3)) if len(goals) else (1, 1)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            codes, values = rows[i]
            p = 1 / (1 + np.exp(-np.clip(weights[codes] @ values + bias, -30, 30)))
            e = (p - goals[i]) * (balance[0] * goals[i] + balance[1] * (1 - goals[i]))
            g = e * values + l2 * weights[codes]
            squares[codes] += g * g
            weights[codes] -= rate * g / np.sqrt(squares[codes]) * 0.2
            bias_square += e * e
            bias -= rate * e / np.sqrt(bias_square) * 0.2
    return weights, bias


def label_model(docs: DataFrame, text_col: str = "text") -> LabelModel:
    """Counts the vote patterns of all documents (three to the power of the labellers at most) and fits the model."""
    rows = docs.select(votes(F.col(f"`{text_col}`")).alias("votes")).groupBy("votes").agg(F.count("*").alias("n")).collect()
    return LabelModel({r["votes"]: r["n"] for r in rows})


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
             most: int = MOST_ROWS, most_chars: int = MOST_CHARS) -> tuple[Column, LabelModel]:
    """A column with ``votes``, ``posterior``, ``score`` and ``kept`` for the texts of ``docs``, and the label model."""
    text = F.col(f"`{text_col}`")
    model = label_model(docs, text_col)
    eligible = docs.where(F.length(F.coalesce(text, F.lit(""))) <= most_chars)
    share = min(1.0, most / max(1, eligible.count()))
    draw = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string")), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = eligible.where(draw).select(text.alias("text")).limit(2 * most).toPandas()["text"].tolist()
    sample.sort(key=lambda t: t or "")
    shapes: dict[str, int] = {}
    weights, bias = train([features(t, shapes) for t in sample], np.array([model.posteriors[votes_of(t)] for t in sample]))
    weights = weights.astype(np.float32)
    posteriors = model.posteriors

    @F.pandas_udf("votes string, posterior double, score double, kept boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        cache: dict[str, int] = {}
        rows = []
        for t in texts:
            codes, values = features(t, cache)
            score = float(1 / (1 + np.exp(-np.clip(weights[codes] @ values + bias, -30, 30)))) if len(codes) else 0.0
            pattern = votes_of(t)
            rows.append((pattern, posteriors[pattern], score, score >= threshold))
        return pd.DataFrame(rows, columns=["votes", "posterior", "score", "kept"])

    return judge(text), model


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **limits) -> DataFrame:
    """One row per document: the id, ``votes``, ``posterior``, ``score`` (0 to 1) and ``kept``."""
    judged, _ = classify(docs, id_col, text_col, threshold, **limits)
    return docs.select(F.col(f"`{id_col}`").alias(id_col), judged.alias("j")).select(id_col, "j.*")


def filter_classified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **limits) -> DataFrame:
    """The documents that are kept, with all their columns."""
    judged, _ = classify(docs, id_col, text_col, threshold, **limits)
    name = fresh("judged", docs)
    return docs.withColumn(name, judged).where(F.col(name)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
