"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has a bit where over half of the hashes of a text's word shingles have it. Texts are linked if their
fingerprints differ in at most ``MAX_BITS`` bits, and groups are the connected components of the links.

1. Equal fingerprints collapse first; from then on every distinct fingerprint is one row, so copies cost nothing.
2. Bits that are correlated over all fingerprints share a partition of the 64 bits, so that the partitions are as
   independent of each other as they can be.
3. If thresholds t of the partitions add up so that the sum of (t + 1) is MAX_BITS + 1, a linked pair differs in at most t
   bits of at least one partition. Dynamic programming gives each partition its threshold (-1: not probed) for the least
   sum of estimated candidate pairs (or points, see 5) and probe rows: collisions are counted over all fingerprints, what
   further bits add is estimated from the share of ones in each bit. Two to four partitions are compared.
4. Probe: a fingerprint has one key per partition with threshold 0, one key per left-out bit with threshold 1, and so on.
   Fingerprints that share a key are candidates, and in keys of at most ``BUCKET`` members every pair is verified.
5. Members of larger keys are linked exactly without pairs: each one goes to the 65 points at most one bit away. Two
   fingerprints are at most two bits apart if, and only if, they share such a point, and a point has 65 members at most;
   all members of a point are linked to the smallest.

Null and empty texts have the fingerprint zero and are linked like any other; texts shorter than a shingle are one
shingle; very long texts are hashed whole; an empty table gives an empty table; rows with equal ids each get a row. Other
columns, whatever their names, stay untouched in ``drop_near_duplicates`` and are not read elsewhere.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LOWER, UPPER, fresh, stored
from plumbline.llm.components import components

BITS = 64
SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Members of a key up to which all its pairs are verified; larger keys take the exact way without pairs.
BUCKET = 48
#: Partitions of the bits that are compared.
PARTS = (2, 3, 4)
#: A fingerprint with more than this share of the rows (at most 512 can have it) is looked up by broadcast.
HOT_SHARE = 1 / 512
LOWERING = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """As a signed 64-bit number."""
    words = (text or "").encode().translate(LOWERING).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(ends))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return hashed(text)


def together(prints: DataFrame) -> tuple[np.ndarray, int]:
    """How many fingerprints have both of two bits (on the diagonal: one bit), over all of them."""

    def counted(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            raw = batch["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8)
            for at in range(0, len(raw), 1 << 14):
                bits = np.unpackbits(raw[at:at + (1 << 14)], axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
            n += len(raw)
        i, j = np.indices((BITS, BITS))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "both": total.ravel(), "n": n})

    rows = (prints.select("fp").mapInPandas(counted, "i int, j int, both double, n long")
            .groupBy("i", "j").agg(F.sum("both").alias("both"), F.sum("n").alias("n")).collect())
    table = np.zeros((BITS, BITS))
    for r in rows:
        table[r["i"], r["j"]] = r["both"]
    return table, rows[0]["n"] if rows else 0


def partitions(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits dealt into parts of near equal width, correlated ones together: each part grows by the bit that is most
    correlated with what it holds already."""
    ones = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.outer(ones * (1 - ones), ones * (1 - ones)))
    tied = np.abs(np.divide(both / max(n, 1) - np.outer(ones, ones), spread, out=np.zeros_like(both), where=spread > 0))
    np.fill_diagonal(tied, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        free = sorted(left)
        part = [free[int(tied[np.ix_(free, free)].sum(1).argmax())]]
        left.discard(part[0])
        while len(part) < width:
            free = sorted(left)
            part.append(free[int(tied[np.ix_(free, part)].sum(1).argmax())])
            left.discard(part[-1])
        out.append(sorted(part))
    return out


def mask_of(bits) -> int:
    """Signed 64-bit number with these bits."""
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def key_masks(part: list[int], threshold: int) -> list[int]:
    """Masks under which two numbers that differ in at most ``threshold`` bits of the part agree at least once."""
    if threshold < 0:
        return []
    return [mask_of(set(part) - set(out)) for out in combinations(part, min(threshold, len(part)))]


def allocate(costs: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost with the sum of (t + 1) equal to max_bits + 1. ``costs[i][t + 1]``: of part i at t."""
    best = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, more in enumerate(part, -1):
                total = used + t + 1
                if total <= max_bits + 1 and (total not in step or cost + more < step[total][0]):
                    step[total] = cost + more, [*chosen, t]
        best = step
    return best[max_bits + 1]


def plan(prints: DataFrame, max_bits: int = MAX_BITS, parts=PARTS, bucket: int = BUCKET) -> list[int]:
    """The masks of all keys."""
    both, n = together(prints)
    if not n:
        return []
    ones = np.diag(both) / n
    equal = ones ** 2 + (1 - ones) ** 2
    choices = [(m, k, part) for m in parts for k, part in enumerate(partitions(both, n, m))]
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(mask_of(p))).alias("v"))
                     for i, (_, _, p) in enumerate(choices)])
    # what a key costs later: its pairs, or the points of its members where it is too large for pairs
    pairs = F.when(F.col("c") <= bucket, F.col("c").cast("double") * (F.col("c") - 1) / 2).otherwise(F.col("c") * (BITS + 1.0))
    collisions = {r["i"]: r["pairs"] for r in prints.select(F.explode(keys).alias("k")).groupBy("k.i", "k.v")
                  .agg(F.count("*").alias("c")).groupBy("i").agg(F.sum(pairs).alias("pairs")).collect()}
    found = []
    for m in parts:
        costs = []
        for i, (_, _, part) in ((i, c) for i, c in enumerate(choices) if c[0] == m):
            row, grown, ways = [0.0], [1.0], 1.0
            for bit in part:  # elementary symmetric sums of the odds that a bit differs
                odds = (1 - equal[bit]) / equal[bit]
                grown = [a + odds * b for a, b in zip([*grown, 0.0], [0.0, *grown])][:max_bits + 1]
            for t in range(max_bits + 1):
                ways = ways * (len(part) - t + 1) / t if t else 1.0
                row.append(collisions[i] * sum(grown[:t + 1]) + n * ways)
            costs.append(row)
        cost, thresholds = allocate(costs, max_bits)
        found.append((cost, [mask for (_, _, part), t in zip([c for c in choices if c[0] == m], thresholds)
                             for mask in key_masks(part, t)]))
    return min(found)[1]


def links(prints: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Verified links that connect what all links connect: columns ``a`` and ``b``. ``prints`` has each ``fp`` once."""
    if max_bits not in (0, 2):
        raise ValueError("the exact way for large keys needs max_bits 0 or 2")
    masks = plan(prints, max_bits, bucket=bucket)
    if not masks or not max_bits:
        return prints.sparkSession.createDataFrame([], "a long, b long")
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(masks)])
    keyed = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.i", "k.v")
    sizes = keyed.groupBy("i", "v").agg(F.count("*").alias("c")).where("c > 1")
    members = stored(keyed.join(sizes, ["i", "v"]), "members")
    lists = members.where(F.col("c") <= bucket).groupBy("i", "v").agg(F.array_sort(F.collect_list("fp")).alias("fps"))
    pairs = (lists.select("fps", F.posexplode("fps").alias("k", "a"))
             .select("a", F.explode(F.slice("fps", F.col("k") + 2, F.lit(bucket))).alias("b"))
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    points = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(mask_of([b]))) for b in range(BITS)])
    balls = (members.where(F.col("c") > bucket).select("fp").distinct().select("fp", F.explode(points).alias("point"))
             .groupBy("point").agg(F.array_sort(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
             .select(F.explode(F.slice("fps", 2, BITS + 1)).alias("a"), F.element_at("fps", 1).alias("b")))
    return pairs.unionByName(balls).distinct()


def components_of(rows: DataFrame, first: Column, max_bits: int) -> DataFrame:
    """Each ``fp`` with its number of rows ``n``, their ``first`` and its ``component``, stored."""
    distinct = stored(rows.groupBy("fp").agg(F.count("*").alias("n"), first.alias("first")), "distinct")
    nodes = components(links(distinct, max_bits)).select(F.col("node").alias("fp"), "component")
    return stored(distinct.join(nodes, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "placed")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: the id, ``fingerprint`` (long) and ``component_id``, the smallest id of its group."""
    rows = stored(docs.select(F.col(f"`{id_col}`").alias("id"), fingerprint(F.col(f"`{text_col}`"), shingle).alias("fp")), "prints")
    placed = components_of(rows, F.min("id"), max_bits)
    firsts = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    groups = stored(placed.join(firsts, "component").select("fp", "n", "component_id"), "groups")
    many = groups.agg(F.sum("n")).first()[0] or 0
    hot = groups.where(F.col("n") > many * HOT_SHARE).select(F.col("fp").alias("hot_fp"), F.col("component_id").alias("hot_id"))
    # rows of hot fingerprints have their answer from the broadcast and are dealt anywhere in the join of the others
    key = F.when(F.col("hot_fp").isNull(), F.col("fp")).otherwise(F.xxhash64("id"))
    others = groups.select(F.col("fp").alias("key"), F.col("component_id").alias("other_id"))
    return (rows.join(F.broadcast(hot), F.col("fp") == F.col("hot_fp"), "left").withColumn("key", key)
            .join(others, "key", "left")
            .select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"),
                    F.when(F.col("hot_fp").isNull(), F.col("other_id")).otherwise(F.col("hot_id")).alias("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group, with all columns: the one with the smallest id, a null id only where the group has no
    other; among equal ids the text with the smallest hash stays, and of rows with equal ids and texts any one."""
    name = fresh("row_key", docs)
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    # 64 bits of the id and the text name a row; rows of equal texts are always in the same group
    key = F.xxhash64(ident.isNull(), ident, text)
    rows = stored(docs.select(ident.alias("id"), key.alias("key"), fingerprint(text, shingle).alias("fp")), "prints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    kept = components_of(rows, first, max_bits).groupBy("component").agg(F.min("first").alias("first"))
    kept = stored(kept.select(F.col("first.key").alias(name)), "survivors")
    return docs.withColumn(name, key).join(kept, name, "left_semi").dropDuplicates([name]).drop(name)
