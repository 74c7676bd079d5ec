"""Toxicity: a convolutional text classifier in numpy.

Words, lower-cased, are hashed into ``BUCKETS`` buckets; filters of several widths run over their embeddings in the whole
text, each keeps its highest answer (one word or phrase is enough, however long the text), and a logistic layer adds them
up. Buckets that fewer than ``MIN_TEXTS`` training texts hold share one embedding, and only the others are stored, so there
can be so many buckets that two words hardly ever meet in one. In training a part of the words, drawn anew each time, is
read as rare, weights decay, and of all epochs the one with the lowest loss on the rows held back is kept: no text is
learnt by heart.

The network is fitted on all labelled rows. It is brought near its end on a bounded part of them: at most ``MOST_ROWS`` of
each label, the lowest hashes of their ids, among texts of at most ``MOST_CHARS`` characters. Where there are more, epochs
over all of them follow, one Spark job a step, and the weights kept come from one of these. Which words have embeddings is
counted over all rows. A fifth of them, by hash, is held back for
calibration: Platt's scaling, weighted to the share of toxic rows among all labelled ones, makes scores probabilities;
then, for each language, the threshold with the best F1 is taken, drawn towards one half where few rows speak. Scores
depend on the text alone; the language only chooses the threshold of ``flagged``.

Null and empty texts have a score like any other (that of no word); very long texts are scored whole; rows without a
label, with a null label or a null id are not learnt from; of several labels of an id the highest counts; without rows
of both labels the score is the share of toxic labels, or 0; an empty table gives an empty table; an unknown or null
language has the threshold one half. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.plans.sums import DIRECT_VALUES

MOST_ROWS = 2000
MOST_CHARS = 20_000
MIN_TEXTS = 8
BUCKETS = 1 << 24
#: Share of the words of a training text that are read as rare, and decay of the weights in a step.
DROPPED, DECAY = 0.2, 1e-2
DIM, FILTERS, WIDTHS = 16, 8, (1, 2, 3)
#: Epochs over all rows after the fit on a part, steps of an epoch, their rate, and rows of a task.
EPOCHS, STEPS, RATE, LANE_ROWS = 4, 16, 0.004, 20_000
#: Tasks of a step at most, or as many as the cluster has cores; embeddings whose slopes travel in one row.
STEP_TASKS, SLOPE_ROWS = 64, 1024
#: Bits of the bitmap of labelled ids, two to the power of, at most; with more ids it leaves out fewer texts.
MOST_BITS = 26
#: Logits of the rows held back are counted in steps of this size.
LOGIT_STEP = 1 / 256
#: Words of a block that is scored at once.
BLOCK_WORDS = 1 << 17
WORD = re.compile(r"\w+")
RARE, PAD, NO_BUCKET = 0, 1, -1


def word_ids(text: str | None) -> np.ndarray:
    crc = zlib.crc32
    return np.fromiter((crc(w.encode()) % BUCKETS for w in WORD.findall((text or "").lower())), np.int64)


class TextNetwork:
    """Embeddings, convolutions, maximum over the text, logistic output; plus calibration."""

    def __init__(self, known: np.ndarray, seed: int = 9):
        """``known``: the buckets that have embeddings of their own, rising."""
        rng = np.random.default_rng(seed)
        self.known = known
        self.p = {"embed": rng.normal(0, 0.1, (len(known) + 2, DIM)).astype(np.float32),
                  "out": rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), "bias": np.zeros(1, np.float32)}
        self.p["embed"][PAD] = 0
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, (w * DIM) ** -0.5, (w * DIM, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.scale, self.shift, self.thresholds = 1.0, 0.0, {}

    def rows(self, ids: np.ndarray) -> np.ndarray:
        """Rows of the embeddings that belong to the buckets of a text."""
        if not len(self.known):
            return np.full(len(ids), RARE)
        at = np.minimum(np.searchsorted(self.known, ids), len(self.known) - 1)
        return np.where(self.known[at] == ids, at + 2, RARE)

    def laid_out(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One line of word ids with padding behind each text; starts and lengths of the texts (an empty one is a pad)."""
        pad, pieces = np.full(max(WIDTHS) - 1, PAD), []
        for ids in texts:
            pieces += [self.rows(ids) if len(ids) else np.array([PAD]), pad]
        lengths = np.array([max(1, len(t)) for t in texts])
        starts = np.concatenate([[0], np.cumsum(lengths + len(pad))[:-1]])
        return np.concatenate(pieces), starts, lengths

    def answers(self, x: np.ndarray, w: int) -> np.ndarray:
        n = len(x) - max(WIDTHS) + 1
        return sum(x[j:j + n] @ self.p[f"w{w}"][j * DIM:(j + 1) * DIM] for j in range(w)) + self.p[f"b{w}"]

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        ids, starts, lengths = self.laid_out(texts)
        x = self.p["embed"][ids]
        # reduceat takes the even entries: from a text's start to its end, leaving out the padding
        edges = np.stack([starts, starts + lengths], axis=1).ravel()[:-1]
        pooled = [np.maximum.reduceat(self.answers(x, w), edges, axis=0)[::2] for w in WIDTHS]
        return np.maximum(np.concatenate(pooled, axis=1), 0) @ self.p["out"] + self.p["bias"][0]

    def gradients(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        ids, starts, lengths = self.laid_out(texts)
        x = self.p["embed"][ids]
        tops, bests, columns = {}, [], np.arange(FILTERS)
        for w in WIDTHS:
            z = self.answers(x, w)
            tops[w] = np.stack([z[s:s + n].argmax(axis=0) + s for s, n in zip(starts, lengths)])
            bests.append(z[tops[w], columns])
        best = np.concatenate(bests, axis=1)
        features = np.maximum(best, 0)
        error = (1 / (1 + np.exp(-(features @ self.p["out"] + self.p["bias"][0]))) - labels) * weights / weights.sum()
        g = {"out": features.T @ error, "bias": np.array([error.sum()]), "embed": np.zeros_like(self.p["embed"])}
        back = error[:, None] * self.p["out"][None] * (best > 0)
        for k, w in enumerate(WIDTHS):
            d, kernel = back[:, k * FILTERS:(k + 1) * FILTERS], self.p[f"w{w}"].reshape(w, DIM, FILTERS)
            g[f"b{w}"], gw = d.sum(axis=0), np.zeros_like(kernel)
            for j in range(w):
                at = ids[tops[w] + j]
                gw[j] = np.einsum("nfd,nf->df", self.p["embed"][at], d)
                np.add.at(g["embed"], at, d[:, :, None] * kernel[j].T[None])
            g[f"w{w}"] = gw.reshape(w * DIM, FILTERS)
        g["embed"][PAD] = 0
        return g

    def loss(self, texts: list[np.ndarray], labels: np.ndarray) -> float:
        """Logistic loss with both labels of equal weight."""
        z = np.concatenate([self.logits(block) for block in blocks(texts)])
        return sum(0.5 * np.logaddexp(0, np.where(labels == k, -z if k else z, 0))[labels == k].mean() for k in (0, 1))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, held: tuple[list[np.ndarray], np.ndarray] | None = None,
            epochs: int = 12, batch: int = 32, rate: float = 0.004, seed: int = 9):
        """Adam; with ``held``, texts and labels of both kinds held back, the epoch with the lowest loss on them is kept."""
        rng, first, second, step = np.random.default_rng(seed), {}, {}, 0
        weights = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
        best, least = self.p, np.inf
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for s in range(0, len(order), batch):
                rows, step = order[s:s + batch], step + 1
                drawn = [np.where(rng.random(len(texts[i])) < DROPPED, NO_BUCKET, texts[i]) for i in rows]
                for k, g in self.gradients(drawn, labels[rows], weights[rows]).items():
                    g = g + DECAY * self.p[k]
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                    second[k] = 0.999 * second.get(k, 0) + 0.001 * g * g
                    change = rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                    self.p[k] = (self.p[k] - change).astype(np.float32)
            self.p["embed"][PAD] = 0
            now = self.loss(*held) if held else -step
            if now < least:
                best, least = {k: v.copy() for k, v in self.p.items()}, now
        self.p = best
        return self

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, langs: np.ndarray, share: float, counts: np.ndarray | None = None):
        """Platt's scaling with rows weighted to the share of ones, then a threshold for each language. ``counts``: how many
        rows each entry stands for, one unless given."""
        counts = np.ones(len(labels)) if counts is None else counts
        n, ones = counts.sum(), (counts * labels).sum()
        weights = counts * np.where(labels == 1, share / max(ones / n, 1e-9), (1 - share) / max(1 - ones / n, 1e-9))
        goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (n - ones + 2))
        a, b = 1.0, 0.0
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
            v, e = weights * (p * (1 - p) + 1e-9), weights * (p - goal)
            h = np.array([[(v * logits * logits).sum() + 1e-3, (v * logits).sum()], [(v * logits).sum(), v.sum() + 1e-3]])
            move = np.linalg.solve(h, [(e * logits).sum(), e.sum()])
            a, b = max(1e-3, a - np.clip(move[0], -1, 1)), b - np.clip(move[1], -1, 1)
        self.scale, self.shift = float(a), float(b)
        scores = self.probabilities(logits)
        for lang in sorted({x for x in langs if isinstance(x, str)}):
            here = langs == lang
            tries = np.linspace(0.05, 0.95, 19)
            hits = np.array([(weights * labels * (scores >= t))[here].sum() for t in tries])
            said = np.array([(weights * (scores >= t))[here].sum() for t in tries])
            f1 = 2 * hits / np.maximum(said + (weights * labels)[here].sum(), 1e-9)
            best = np.flatnonzero(f1 >= f1.max() - 1e-12)
            trust = counts[here].sum() / (counts[here].sum() + 50)
            self.thresholds[lang] = float(trust * tries[best].mean() + (1 - trust) * 0.5)
        return self

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))


def train(sample: pd.DataFrame, share: float, seed: int = 9, known: np.ndarray | None = None) -> TextNetwork | None:
    """``sample`` has text, label, lang and held (for calibration), in a fixed order. ``known``: the buckets to embed, those
    that enough texts of the sample hold unless given."""
    labels, held = sample["label"].to_numpy(float), sample["held"].to_numpy(bool)
    if len(set(labels[~held])) < 2:
        held = np.zeros(len(labels), bool)
    if len(set(labels)) < 2:
        return None
    texts = [word_ids(t) for t in sample["text"]]
    buckets, counts = np.unique(np.concatenate([np.unique(t) for t, h in zip(texts, held) if not h]), return_counts=True)
    known = buckets[counts >= MIN_TEXTS] if known is None else known
    network, learnt = TextNetwork(known, seed), [t for t, h in zip(texts, held) if not h]
    back = [t for t, h in zip(texts, held) if h]
    if len(set(labels[held])) < 2:  # too few rows to hold any back
        network.fit(learnt, labels[~held], seed=seed)
        back, held = texts, np.ones(len(labels), bool)
    else:
        network.fit(learnt, labels[~held], (back, labels[held]), seed=seed)
    logits = np.concatenate([network.logits(block) for block in blocks(back)])
    return network.calibrate(logits, labels[held], sample["lang"].to_numpy(object)[held], share)


def blocks(texts: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    block, n = [], 0
    for ids in texts:
        block.append(ids)
        n += len(ids)
        if n >= BLOCK_WORDS:
            yield block
            block, n = [], 0
    if block:
        yield block


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, lang_col: str,
                  label_col: str, most: int, most_chars: int) -> tuple[DataFrame, pd.DataFrame, float]:
    """The words of all labelled rows, persisted in the lanes of the training, the bounded part that training starts on, and
    the share of ones among all usable labels.

    Texts are cut where they are read, and a bitmap of the labelled ids' hashes, of bounded size, leaves out most others
    before; so little more than the words of the labelled rows is shuffled, to their labels and to their lanes, at any size.
    """
    kind = docs.select(F.col(f"`{id_col}`").alias("id")).union(labels.select(F.col(f"`{id_col}`").alias("id"))).schema["id"].dataType
    ident, order = F.col(f"`{id_col}`").cast(kind).alias("id"), F.xxhash64(F.col("id").cast("string"))
    known = (labels.select(ident, F.col(f"`{label_col}`").cast("double").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isNotNull()).where(usable)
             .groupBy("id").agg(F.max("label").alias("label")).withColumn("order", order).persist())
    n, share = known.agg(F.count("*"), F.avg("label")).first()
    texts = (docs.select(ident, F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
             .where(F.col("id").isNotNull()).withColumn("order", order))
    chosen = [known.where(F.col("label") == k).orderBy("order", "id").limit(most) for k in (0, 1)]
    few = F.broadcast(chosen[0].unionByName(chosen[1]).select("id", "label"))
    sample = texts.where(F.length(F.coalesce("text", F.lit(""))) <= most_chars).join(few, "id").select("order", "id", "text", "lang", "label").toPandas()
    sample = sample.sort_values(["order", "id", "text"], ignore_index=True)
    sample["held"] = sample["order"] // 7 % 5 == 0

    place = F.shiftrightunsigned("order", 64 - min(MOST_BITS, max(15, int(n * 8).bit_length())))
    cells = known.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("cell")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    likely = texts.withColumn("cell", F.bitmap_bucket_number(place)).join(F.broadcast(cells), "cell").where(
        F.getbit(byte, (at % 8).cast("int")) == 1)

    @F.pandas_udf("binary")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([word_ids(t).astype(np.int32).tobytes() for t in texts], dtype=object)

    tasks = max(4, n // LANE_ROWS)
    words = likely.select("id", "lang", cut("text").alias("words"))
    # a broadcast on small tables would leave the shuffle of all words behind on large ones
    rows = words.join(known.hint("merge"), "id")
    rows = rows.withColumn("held", F.expr("pmod(`order` div 7 - if(`order` < 0 and `order` % 7 != 0, 1, 0), 5) = 0"))
    return rows.repartition(tasks, "order", "words").sortWithinPartitions("order", "words", "lang").persist(), sample, float(share or 0.0)


def common_buckets(rows: DataFrame) -> np.ndarray:
    """The buckets that enough of the texts learnt from hold; the driver keeps one number of each, as the network does."""
    @F.pandas_udf("array<int>")
    def held_by(words: pd.Series) -> pd.Series:
        return pd.Series([np.unique(np.frombuffer(w, np.int32)) for w in words], dtype=object)

    found = rows.where(~F.col("held")).select(F.explode(held_by("words")).alias("bucket")).groupBy("bucket").count()
    return np.sort(np.array([r["bucket"] for r in found.where(F.col("count") >= MIN_TEXTS).select("bucket").collect()], np.int64))


def step_sums(rows: DataFrame, tasks: int, measure: Callable[[Iterator[pd.DataFrame]], tuple[np.ndarray, np.ndarray]],
              embeddings: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all lanes of what ``measure`` gives for a lane: a vector, and a matrix with ``embeddings`` rows of which few
    differ from zero.

    A lane is measured by itself; the lanes of a task are added up there, so what leaves the tasks grows with ``tasks``, not
    with the lanes, and of the matrix only rows that the task touched leave it. Where all tasks together are few enough
    values, the driver takes them in order and nothing is shuffled; otherwise one shuffle adds them up by their place.
    """
    def places(array: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        touched = np.flatnonzero(array.any(axis=1)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(touched // SLOPE_ROWS)) + 1
        for some in np.split(touched, cuts) if len(touched) else ():
            yield int(some[0]) // SLOPE_ROWS, some, array[some]

    def packed(found: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
        found = list(found)
        return pd.DataFrame({"place": [f[0] for f in found], "at": [f[1].tobytes() for f in found], "s": [f[2].tobytes() for f in found]})

    def lane(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vector, matrix = measure(batches)
        yield packed([(-1, np.zeros(0, np.int32), vector), *places(matrix)])

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, at, s in zip(batch["place"], batch["at"], batch["s"]):
                at, s = np.frombuffer(at, np.int32) % SLOPE_ROWS, np.frombuffer(s)
                if place < 0:
                    sums[place] = sums[place] + s if place in sums else s
                else:
                    sums.setdefault(place, np.zeros((SLOPE_ROWS, DIM)))[at] += s.reshape(-1, DIM)
        vectors = [(-1, np.zeros(0, np.int32), sums.pop(-1))] if -1 in sums else []
        for place in sorted(sums):
            at = np.flatnonzero(sums[place].any(axis=1))
            vectors.append((place, (at + place * SLOPE_ROWS).astype(np.int32), sums[place][at]))
        yield packed(vectors)

    schema = "place int, at binary, s binary"
    parts = rows.mapInPandas(lane, schema)
    if rows.rdd.getNumPartitions() > tasks:
        parts = parts.coalesce(tasks).mapInPandas(added, schema)
    if tasks * embeddings * DIM // 4 > DIRECT_VALUES:
        parts = parts.repartition(tasks, "place").mapInPandas(added, schema)
    vector, matrix = np.zeros(0), np.zeros((embeddings, DIM))
    for r in parts.collect():
        at, s = np.frombuffer(r["at"], np.int32), np.frombuffer(r["s"])
        if r["place"] < 0:
            vector = vector + s if len(vector) else s
        else:
            matrix[at] += s.reshape(-1, DIM)
    return vector, matrix


def train_on_all(network: TextNetwork, dealt: DataFrame, share: float, seed: int = 9) -> TextNetwork:
    """Epochs over all labelled rows from where the network stands; of these the one with the lowest loss on all rows held
    back is kept, and calibrated on them. Lanes, batches and dropped words follow from the rows, not from files or cores; a
    step's tasks are handed the rows of its batch only."""
    counts = {(r["held"], r["label"]): r["count"] for r in dealt.groupBy("held", "label").count().collect()}
    of = {k: counts.get((False, float(k)), 0) for k in (0, 1)}
    context = dealt.sparkSession.sparkContext
    tasks = max(4, min(sum(counts.values()) // LANE_ROWS, max(STEP_TASKS, context.defaultParallelism)))
    names, best, least, first, second, step = [k for k in network.p if k != "embed"], network.p, np.inf, {}, {}, 0
    ends = np.cumsum([0] + [network.p[k].size for k in names])
    for epoch in range(EPOCHS + 1):
        # the first step of an epoch also measures the loss of the weights as they are; a last one only that
        for at in range(STEPS if epoch < EPOCHS else 1):
            learning, sent = epoch < EPOCHS, context.broadcast((network.known, network.p))
            turn = F.crc32(F.concat(F.lit(f"{seed} {epoch} "), F.col("order").cast("string")).cast("binary")) % STEPS
            wanted = (F.col("held") & F.lit(at == 0)) | (~F.col("held") & F.lit(learning) & (turn == at))

            def measure(batches: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray]:
                network = TextNetwork(np.zeros(0, np.int64))
                network.known, network.p = sent.value
                total, lost, embed = np.zeros(ends[-1] + 1), np.zeros(4), np.zeros(network.p["embed"].shape)
                for batch in batches:
                    orders, label = batch["order"].to_numpy(), batch["label"].to_numpy(float)
                    held = batch["held"].to_numpy(bool)
                    pick = np.flatnonzero(~held)
                    for s in range(0, len(pick), 128):
                        some = pick[s:s + 128]
                        drawn = []
                        for i in some:
                            ids, rng = np.frombuffer(batch["words"][i], np.int32), np.random.default_rng([seed, epoch, int(orders[i]) & 0xFFFFFFFF])
                            drawn.append(np.where(rng.random(len(ids)) < DROPPED, NO_BUCKET, ids))
                        weights = 0.5 / np.where(label[some] == 1, of[1], of[0])
                        g = network.gradients(drawn, label[some], weights)
                        total[:-1] += np.concatenate([np.ravel(g[k]) for k in names]) * weights.sum()
                        total[-1] += weights.sum()
                        embed += g["embed"] * weights.sum()
                    if held.any():
                        places = np.flatnonzero(held)
                        z = np.concatenate([network.logits(block) for block in blocks([np.frombuffer(batch["words"][i], np.int32) for i in places])])
                        for k in (0, 1):
                            mine = z[label[places] == k]
                            lost[2 * k:2 * k + 2] += np.logaddexp(0, -mine if k else mine).sum(), len(mine)
                return np.concatenate([total, lost]), embed

            sums, slope = step_sums(dealt.where(wanted).select("order", "label", "held", "words"), tasks, measure, len(network.p["embed"]))
            sent.destroy()
            if at == 0 and epoch:
                now = sum(0.5 * sums[-4 + 2 * k] / max(1.0, sums[-3 + 2 * k]) for k in (0, 1))
                if now < least:
                    best, least = {k: v.copy() for k, v in network.p.items()}, now
            if learning and sums[-5]:
                step += 1
                slopes = {k: sums[b:e].reshape(network.p[k].shape) for k, b, e in zip(names, ends, ends[1:])}
                for k, slope in {**slopes, "embed": slope}.items():
                    g = (slope / sums[-5] + DECAY * network.p[k]).astype(np.float32)
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                    second[k] = 0.999 * second.get(k, 0) + 0.001 * g * g
                    change = RATE * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                    network.p[k] = (network.p[k] - change).astype(np.float32)
                network.p["embed"][PAD] = 0
    network.p = best

    @F.pandas_udf("bigint")
    def place_of(words: pd.Series) -> pd.Series:
        found = [network.logits(block) for block in blocks([np.frombuffer(w, np.int32) for w in words])]
        return pd.Series(np.round(np.concatenate(found) / LOGIT_STEP).astype(np.int64) if found else [], dtype="int64")

    cells = dealt.where("held").select(place_of("words").alias("place"), "label", "lang").groupBy("place", "label", "lang").count().toPandas()
    cells = cells.sort_values(["place", "label", "lang"], ignore_index=True)
    return network.calibrate(cells["place"].to_numpy() * LOGIT_STEP, cells["label"].to_numpy(float), cells["lang"].to_numpy(object), share,
                             cells["count"].to_numpy(float))


def score_toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
                   text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", most: int = MOST_ROWS,
                   most_chars: int = MOST_CHARS) -> DataFrame:
    """One row per document: the id, ``score``, ``threshold`` of its language and ``flagged``. ``usable`` restricts, by
    column ``id``, the labels that may be learnt from."""
    rows, sample, share = training_rows(docs, labels, F.lit(True) if usable is None else usable, id_col, text_col, lang_col,
                                        label_col, most, most_chars)
    n = rows.count()
    more = n > len(sample) and len(set(sample["label"][~sample["held"]])) == len(set(sample["label"][sample["held"]])) == 2
    network = train(sample, share, known=common_buckets(rows) if more else None)
    if more:
        network = train_on_all(network, rows, share)
    rows.unpersist()

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if network is None:
            return pd.Series(np.full(len(texts), share))
        found, block, n = [], [], 0
        for text in texts:
            block.append(word_ids(text))
            n += len(block[-1])
            if n >= BLOCK_WORDS:
                found.append(network.logits(block))
                block, n = [], 0
        if block:
            found.append(network.logits(block))
        return pd.Series(network.probabilities(np.concatenate(found)) if found else [], dtype=float)

    threshold = F.lit(0.5)
    for lang, t in (network.thresholds if network else {}).items():
        threshold = F.when(F.col(f"`{lang_col}`") == lang, t).otherwise(threshold)
    return (docs.select(F.col(f"`{id_col}`").alias(id_col), score(F.col(f"`{text_col}`")).alias("score"), threshold.alias("threshold"))
            .withColumn("flagged", F.col("score") >= F.col("threshold")))
