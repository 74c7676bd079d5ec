"""Mixing sources to target weights by Pareto order sampling. DataFrame operations only.

Sources, sorted by code point with null last, take weights in turn and share a budget of words by weight. A target stops
at ``max_copies`` times its source's size; what it leaves goes to the others by weight. A source whose target is m times
its size gives floor(m) certain whole copies of each document, and each document is in a further sample with the
probability p = m - floor(m). The sample follows Pareto's order: with one random number u per document, documents rank by
(u / (1 - u)) / (p / (1 - p)), and the first ones go in until the words that are missing to the target are reached; the
last one goes in if more than half of it is missing. So a source's words miss its target by half a document at most.

The ranking needs no sort of a source: words are summed per source and bucket of the rank, the bucket in which the target
lies is found from these sums, and only its rows (a few thousandths of the source) are ordered. Every document is then
decided by comparing its rank with the cut of its source, on the row itself.

``u`` comes from the md5 of id and seed, so reruns agree and SQL can repeat it. Null or empty texts have size 0 and take
nothing; null is a source of its own; a null id counts as an empty one; rows with equal ids share their random number and
are ordered by 64 bits of their text, so only rows equal in both go in or stay out together; an empty table gives an empty
table. All input columns stay, whatever their names; the columns that the operator adds
replace those of the same name. The table of sources has one row each and is the only thing ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import SPACED, fresh, row_key, stored

WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MAX_COPIES = 2
SEED = 10
#: Buckets of the rank per source; only the rows of one of them are ordered.
BUCKETS = 4096
ADDED = ("size", "source_size", "target", "copies", "taken")


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED)), F.lit(0)).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """Between 0 and 1, both excluded, from the first 52 bits of an md5."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"|{seed}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def source_targets(sized: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE,
                   max_copies: float = MAX_COPIES) -> DataFrame:
    """Per source: its size, its target, and the certain copies, probability and sampled words that follow from it.

    Sources reach their cap in the order of cap by weight. With the first k at their caps the others share the rest of the
    budget by weight; the smallest k whose share leaves the next one below its cap, which is the largest such share, solves it.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    share = (F.col("budget") - F.col("caps_before")) / F.col("weights_rest")
    return (totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
            .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(budget_share)))
            .withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            .withColumn("weights_rest", F.sum("weight").over(rest))
            .withColumn("level", F.max(F.when(share * F.col("weight") <= F.col("cap"), share)).over(everything))
            .withColumn("target", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")))
            .withColumn("multiple", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
            .select("source", "source_size", "target", F.floor("multiple").alias("whole"),
                    (F.col("multiple") - F.floor("multiple")).alias("p"),
                    (F.col("target") - F.floor("multiple") * F.col("source_size")).alias("missing")))


def rank(u: Column, p: Column) -> Column:
    """Random odds by inclusion odds; null where nothing is sampled."""
    return F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))


def bucket(q: Column, buckets: int) -> Column:
    return F.floor(q / (1 + q) * buckets)


def cut_table(sized: DataFrame, targets: DataFrame, seed: int, buckets: int) -> DataFrame:
    """The targets with the place in the order at which each source's sample ends: a bucket and, in it, a rank and row key."""
    of = targets.select(F.col("source").alias("of"), "p", "missing")
    ranked = (sized.join(of, F.col("source").eqNullSafe(F.col("of"))).withColumn("q", rank(uniform(F.col("id"), seed), F.col("p")))
              .where(F.col("q").isNotNull()).withColumn("bucket", bucket(F.col("q"), buckets)))
    filled = ranked.groupBy("of", "bucket", "missing").agg(F.sum("size").alias("words"))
    through = F.sum("words").over(Window.partitionBy("of").orderBy("bucket"))
    ends = (filled.withColumn("before", through - F.col("words"))
            .where((F.col("before") <= F.col("missing")) & (F.col("missing") < F.col("before") + F.col("words")))
            .select(F.col("of").alias("end_of"), F.col("bucket").alias("end_bucket"), "before"))
    edge = (ranked.join(ends, F.col("of").eqNullSafe(F.col("end_of")) & (F.col("bucket") == F.col("end_bucket")))
            .groupBy("of", "end_bucket", "before", "missing", "q", "key").agg(F.sum("size").alias("words")))
    order = Window.partitionBy("of").orderBy("q", "key").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("words").over(order), F.lit(0)) + F.col("words") / 2
    # max gives the last one taken
    cuts = (edge.withColumn("taken", middle <= F.col("missing")).groupBy(F.col("of").alias("cut_of"), F.col("end_bucket"))
            .agg(F.max(F.when(F.col("taken"), F.struct("q", "key"))).alias("last")))
    return (targets.join(cuts, F.col("source").eqNullSafe(F.col("cut_of")), "left")
            .select(F.col("source").alias("of"), "source_size", "target", "whole", "p", "end_bucket", "last"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights=WEIGHTS, budget_share: float = BUDGET_SHARE, max_copies: float = MAX_COPIES, seed: int = SEED,
                buckets: int = BUCKETS) -> DataFrame:
    """Every document with its size, its source's size and target, its copies in the mix and the words these hold."""
    ident, source, text = (F.col(f"`{c}`") for c in (id_col, source_col, text_col))
    size, key = words_in(text), row_key(ident, text)
    sized = stored(docs.select(ident.alias("id"), key.alias("key"), source.alias("source"), size.alias("size")), "sizes")
    targets = stored(source_targets(sized, weights, budget_share, max_copies), "targets")
    cuts = stored(cut_table(sized, targets, seed, buckets), "cuts")
    name = fresh("mixing_plan", docs)
    plan = cuts.select(F.struct("*").alias(name))
    q = rank(uniform(ident, seed), F.col(f"{name}.p"))
    last, end = F.col(f"{name}.last"), F.col(f"{name}.end_bucket")
    # no end: the words of all ranks together do not reach what is missing, so all go in (or none are sampled: q is null)
    inside = (end.isNull() | (bucket(q, buckets) < end)
              | ((bucket(q, buckets) == end) & last.isNotNull() & ((q < last["q"]) | ((q == last["q"]) & (key <= last["key"])))))
    copies = (F.col(f"{name}.whole") + F.coalesce((q.isNotNull() & inside).cast("long"), F.lit(0))).cast("long")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ADDED]
    return (docs.join(plan, source.eqNullSafe(F.col(f"{name}.of")))
            .select(*kept, size.alias("size"), F.col(f"{name}.source_size").alias("source_size"),
                    F.col(f"{name}.target").alias("target"), copies.alias("copies"))
            .withColumn("taken", F.col("size") * F.col("copies")))


#: The same mix in DuckDB's SQL, with one global order per source.
MIX_SQL = r"""WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE
    WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap,
    CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget FROM totals),
shares AS (SELECT *, (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
    FROM weighted WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST)),
levels AS (SELECT *, max(CASE WHEN share * weight <= cap THEN share END) OVER () AS level FROM shares),
targets AS (SELECT source, source_size, coalesce(least(cap, level * weight), cap) AS target FROM levels),
multiples AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS multiple FROM targets),
plan AS (SELECT *, CAST(floor(multiple) AS BIGINT) AS whole, multiple - floor(multiple) AS p,
    target - floor(multiple) * source_size AS missing FROM multiples),
draws AS (SELECT s.doc_id, s.size, p.*, (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|10'), 1, 13) AS BIGINT) AS DOUBLE)
    + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
ranked AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM draws),
summed AS (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY q, doc_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) - size / 2.0::DOUBLE AS middle
    FROM ranked),
decided AS (SELECT *, whole + CASE WHEN q IS NOT NULL AND middle <= missing THEN 1 ELSE 0 END AS copies FROM summed)
SELECT doc_id, size, source_size, target, CAST(copies AS BIGINT) AS copies, CAST(size * copies AS BIGINT) AS taken FROM decided"""
