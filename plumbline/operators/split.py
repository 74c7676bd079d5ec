"""Label encoding, train/test splits and folds.

Splits follow a hash of the row key, so they do not depend on partitioning and
survive recomputation.  Exact sizes come from an order statistic of the hash
(``plans.hashes``): the split itself is then a filter, with no ranking and no
shuffle of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.association import levels
from plumbline.operators.bins import edges_below
from plumbline.operators.describe import literal_rows
from plumbline.plans.hashes import HASH_DIGITS, fold_ends, ranked, split_and_folds
from plumbline.plans.order import order_statistics

# up to so many classes each is a literal in the expressions; more meet their rows in joins, with the same result
LITERAL_CLASSES = 32
HASH_BINS = 4_096


class PortableKeys(list):
    """Key columns hashed by md5 over their text, so that another engine can repeat a split.

    A plain list of keys uses xxhash64, which is many times faster.
    """


#: Columns of the two hashes where they are worked out beforehand.
HASHES = ("first hash of the key", "second hash of the key")


class HashedKeys(list):
    """The columns ``HASHES``, worked out with the seed in use."""


def key_hash(keys: Sequence[str], seed: int, part: int = 0) -> Column:
    """A uniform number below 16 ** 13 from the key and seed; ``part`` 0 or 1 picks independent ones."""
    if isinstance(keys, HashedKeys):
        return F.col(keys[part])
    if not isinstance(keys, PortableKeys):
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(part), *keys), 12).cast("double")
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1 + part * HASH_DIGITS, HASH_DIGITS), 16, 10).cast("double")


def label_codes(df: DataFrame, label: str) -> dict:
    """Sorted categories numbered from 0."""
    return {v: i for i, v in enumerate(levels(df, label))}


def label_encode(df: DataFrame, label: str, name: str, codes: dict | None = None) -> DataFrame:
    codes = codes or label_codes(df, label)
    if len(codes) <= LITERAL_CLASSES:
        pairs = [v for k, i in codes.items() for v in (F.lit(k), F.lit(i))]
        return df.withColumn(name, F.create_map(*pairs)[F.col(label)].cast("int"))
    known = literal_rows(df.sparkSession, list(codes.items()), f"`code of` {df.schema[label].dataType.simpleString()}, `{name}` int")
    return df.drop(name).join(known, F.col(label) == F.col("code of"), "left").drop("code of")


def target_kind(df: DataFrame, target: str) -> DataFrame:
    """Categorical when distinct values are under 10 % of the rows; counted exactly only
    when the estimate is too close to that line to decide."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(target, 0.01).alias("d")).first()
    distinct = row["d"]
    if 0.8 * 0.1 * row["rows"] <= distinct <= 1.25 * 0.1 * row["rows"]:
        distinct = df.select(target).distinct().count()
    kind = "categorical" if distinct < 0.1 * row["rows"] else "continuous"
    return df.sparkSession.createDataFrame([(row["rows"], kind)], "rows bigint, kind string")


def _numbered(predicates: Sequence[Column]) -> Column:
    number = F.lit(None).cast("int")
    for i, inside in enumerate(predicates):
        number = F.when(inside, F.lit(i)).otherwise(number)
    return number


def _lowest(df: DataFrame, groups: Sequence[Column], sizes: Callable[[dict[int, int]], dict[int, int]], keys: Sequence[str],
            seed: int) -> Column:
    """Predicate for the rows of lowest hash in each group; ``sizes`` says how many from the groups' numbers of rows."""
    first, second = key_hash(keys, seed), key_hash(keys, seed, 1)
    wanted: dict[int, int] = {}

    def ranks(rows: dict[int, int]) -> dict[int, list[int]]:
        wanted.update({g: n for g, n in sizes(rows).items() if n > 0})
        return {g: [n - 1] for g, n in wanted.items()}

    cuts, _ = ranked(df, len(groups), _numbered(groups), first, ranks)
    chosen = F.lit(False)
    for (g, rank), cut in cuts.items():
        below = first < F.lit(float(cut.value))
        same = first == F.lit(float(cut.value))
        room = rank + 1 - cut.below
        if cut.at > room:
            # several keys share the cutting hash: the second half of the digest decides
            last = order_statistics(df.select(F.when(groups[g] & same, second).alias("h")), {"h": [room - 1]})["h"][room - 1]
            same = same & (second <= F.lit(float(last)))
        chosen = F.when(groups[g], below | same).otherwise(chosen)
    return F.coalesce(chosen, F.lit(False))


def _binned(df: DataFrame, label: str, h: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with hash and bin, and for each class and bin its rows ``n`` and those of the bins before it."""
    rows = df.withColumn("hash", h).withColumn("hash bin", F.floor(F.col("hash") / 16.0 ** HASH_DIGITS * HASH_BINS).cast("int"))
    counts = rows.filter(F.col(label).isNotNull()).groupBy(label, "hash bin").agg(F.count(F.lit(1)).alias("n"))
    # at most HASH_BINS rows of a class reach this window
    through = Window.partitionBy(label).orderBy("hash bin").rowsBetween(Window.unboundedPreceding, -1)
    return rows, counts.withColumn("before", F.coalesce(F.sum("n").over(through), F.lit(0)))


def _lowest_of_many(df: DataFrame, label: str, sizes: dict, keys: Sequence[str], seed: int) -> DataFrame:
    """``split`` for any number of classes: the bin in which a class's cut lies comes from counts, and only the
    rows of that bin are ordered."""
    kind = df.schema[label].dataType.simpleString()
    wanted = literal_rows(df.sparkSession, list(sizes.items()), f"`cut class` {kind}, size bigint")
    rows, counts = _binned(df, label, key_hash(keys, seed))
    rows = rows.withColumn("hash 2", key_hash(keys, seed, 1))
    ends = counts.join(wanted, F.col(label) == F.col("cut class")).filter(
        (F.col("before") < F.col("size")) & (F.col("size") <= F.col("before") + F.col("n"))).select(
        "cut class", F.col("hash bin").alias("cut bin"), (F.col("size") - F.col("before")).alias("room"))
    order = Window.partitionBy("cut class").orderBy("hash", "hash 2")
    cuts = rows.join(ends, (F.col(label) == F.col("cut class")) & (F.col("hash bin") == F.col("cut bin"))).select(
        "cut class", "room", F.col("hash").alias("cut"), F.col("hash 2").alias("cut 2"), F.row_number().over(order).alias("place")).filter(
        F.col("place") == F.col("room")).drop("room", "place")
    inside = (F.col("hash") < F.col("cut")) | ((F.col("hash") == F.col("cut")) & (F.col("hash 2") <= F.col("cut 2")))
    return rows.join(cuts, F.col(label) == F.col("cut class"), "left").withColumn(
        "split", F.when(F.coalesce(inside, F.lit(False)), "test").otherwise("train")).select(*df.columns, "split")


def _folds_of_many(df: DataFrame, label: str, h: Column, folds: int, name: str) -> DataFrame:
    """Folds within any number of classes: a row's rank is its place in its bin after the bins before it."""
    rows, counts = _binned(df, label, h)
    totals = counts.groupBy(label).agg(F.sum("n").alias("class rows")).withColumnRenamed(label, "total class")
    offsets = counts.select(F.col(label).alias("bin class"), F.col("hash bin").alias("bin"), "before").join(
        totals, F.col("bin class") == F.col("total class"))
    rank = F.row_number().over(Window.partitionBy(label, "hash bin").orderBy("hash")) - 1 + F.col("before")
    # the first ``rows mod folds`` folds have one row more
    short, longer = F.floor(F.col("class rows") / folds), F.col("class rows") % folds
    fold = F.when(F.col("rank") < longer * (short + 1), F.floor(F.col("rank") / (short + 1))).otherwise(
        longer + F.floor(F.try_divide(F.col("rank") - longer * (short + 1), short)))
    joined = rows.join(offsets, (F.col(label) == F.col("bin class")) & (F.col("hash bin") == F.col("bin")), "left")
    return joined.withColumn("rank", rank).withColumn(name, fold.cast("int")).select(*df.columns, name)


def train_test_split(df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` (train or test) with exactly ceil(test_size * n) test rows."""
    chosen = _lowest(df, [F.lit(True)], lambda rows: {0: math.ceil(test_size * rows[0])}, keys, seed)
    return df.withColumn("split", F.when(chosen, "test").otherwise("train"))


def split_with_folds(df: DataFrame, keys: Sequence[str], test_size: float = 0.2, folds: int = 5, seed: int = 42) -> DataFrame:
    """``train_test_split`` and, over its training rows, ``hash_folds`` (null for test rows), found together.

    Reads the table three times; give it few columns, persisted.
    """
    first, second = F.col("first hash"), F.col("second hash")
    hashed = df.withColumns({"first hash": key_hash(keys, seed), "second hash": key_hash(keys, seed, 1)})
    cuts = split_and_folds(hashed, first, second, test_size, folds)
    if cuts is None:
        parted = train_test_split(df, keys, test_size, seed)
        train = hash_folds(parted.filter("split = 'train'"), keys, folds, seed)
        return train.unionByName(parted.filter("split = 'test'").withColumn("fold", F.lit(None).cast("int")))
    is_test = cuts.is_test(first, second)
    return hashed.withColumns({"split": F.when(is_test, "test").otherwise("train"),
                               "fold": F.when(~is_test, edges_below(second, cuts.ends)).cast("int")}).drop("first hash", "second hash")


def shares(sizes: dict, total: int) -> dict:
    """``total`` divided in proportion to the sizes, largest remainders first."""
    everything = sum(sizes.values())
    exact = {g: n * total / everything for g, n in sizes.items()}
    out = {g: math.floor(v) for g, v in exact.items()}
    order = sorted(sizes, key=lambda g: (out[g] - exact[g], g))
    for g in order[:total - sum(out.values())]:
        out[g] += 1
    return out


def label_counts(df: DataFrame, label: str) -> dict:
    """Rows of each category, in sorted order; the driver holds one row of each."""
    found = df.filter(F.col(label).isNotNull()).groupBy(label).count().collect()
    return dict(sorted((r[0], r[1]) for r in found))


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], test_size: float = 0.3, seed: int = 42,
                     counts: dict | None = None) -> DataFrame:
    """Adds ``split``; every class keeps its share of the ceil(test_size * n) test rows."""
    counts = counts or label_counts(df, label)
    sizes = shares(counts, math.ceil(test_size * sum(counts.values())))
    if len(sizes) > LITERAL_CLASSES:
        return _lowest_of_many(df, label, sizes, keys, seed)
    chosen = _lowest(df, [F.col(label) == F.lit(g) for g in sizes], lambda _: dict(enumerate(sizes.values())), keys, seed)
    return df.withColumn("split", F.when(chosen, "test").otherwise("train"))


def contiguous_folds(df: DataFrame, key: str, folds: int = 5, name: str = "fold") -> DataFrame:
    """Adds fold 0..folds-1: runs of equal length in the order of a unique key."""
    n = df.count()
    sizes = [n // folds + (i < n % folds) for i in range(folds)]
    ends = [sum(sizes[:i + 1]) - 1 for i in range(folds - 1)]
    place = F.col(key).cast("double")
    found = order_statistics(df.select(place.alias("place")), {"place": ends})["place"]
    return df.withColumn(name, edges_below(place, [found[e] for e in ends]))


def hash_folds(df: DataFrame, keys: Sequence[str], folds: int = 5, seed: int = 42, label: str | None = None,
               name: str = "fold") -> DataFrame:
    """Adds random folds of equal size, within each class when a label is given."""
    h = key_hash(keys, seed, 1)
    classes = levels(df, label) if label else [0]
    if len(classes) > LITERAL_CLASSES:
        return _folds_of_many(df, label, h, folds, name)
    groups = [F.col(label) == F.lit(g) for g in classes] if label else [F.lit(True)]
    cuts, sizes = ranked(df, len(groups), _numbered(groups), h, lambda rows: {g: fold_ends(n, folds) for g, n in rows.items()})
    fold = F.lit(None).cast("int")
    for g, inside in enumerate(groups):
        ends = [cuts[g, e].value for e in fold_ends(sizes[g], folds)]
        fold = F.when(inside, edges_below(F.col("fold hash"), ends)).otherwise(fold)
    return df.withColumn("fold hash", h).withColumn(name, fold.cast("int")).drop("fold hash")
