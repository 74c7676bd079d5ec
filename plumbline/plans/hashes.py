"""Ranks of uniform hashes: the exact cuts that make splits and folds of exact sizes.

One pass counts the hashes by bin, and with that gives the number of rows, so wanted ranks may follow from it. A rank lies in
one bin; bins of up to ``BUFFER`` rows are read out by value in a second pass, larger ones are counted by finer bins first.
Two passes serve some hundred million rows, three some trillion, whatever the number of groups and ranks.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_DIGITS = 13  # hexadecimal digits (52 bits) that a double holds exactly
SPACE = 1 << 4 * HASH_DIGITS
#: Bins of a pass over all groups together, a power of two, and rows of a bin that are read out by value.
BINS = 4_096
BUFFER = 20_000


@dataclass(frozen=True)
class Span:
    """Hashes of a group from ``low`` on, ``width`` of them, with the rows of the group that lie below and inside."""

    group: int
    low: int
    width: int
    below: int = 0
    rows: int = 0

    def holds(self, group: Column, h: Column) -> Column:
        return (group == self.group) & (h >= float(self.low)) & (h < float(self.low + self.width))


@dataclass(frozen=True)
class Cut:
    """The hash at a rank, the rows of the group with a lower one, and those with the same."""

    value: float
    below: int
    at: int


def bin_of(h: Column, low: int, width: int, bins: int) -> Column:
    """Powers of two, so nothing is rounded."""
    return F.floor((h - F.lit(float(low))) / F.lit(float(max(1, width // bins)))).cast("int")


def _counted(df: DataFrame, group: Column, h: Column, spans: Sequence[Span], bins: int) -> dict[int, Counter]:
    """For each span the rows of each of its bins."""
    # group and hash are columns first, so each is worked out once a row; a filter would be moved before them
    place, at = F.lit(None).cast("bigint"), F.col("h")
    for i, s in enumerate(spans):
        place = F.when(s.holds(F.col("g"), at), F.lit(i * bins).cast("bigint") + bin_of(at, s.low, s.width, bins)).otherwise(place)
    rows = df.select(group.alias("g"), h.alias("h")).select(place.alias("place")).groupBy("place").count().collect()
    out: dict[int, Counter] = {i: Counter() for i in range(len(spans))}
    for number, n in rows:
        if number is not None:
            out[number // bins][number % bins] = n
    return out


def narrowed(span: Span, counts: Mapping[int, int], ranks: Sequence[int], bins: int) -> dict[Span, list[int]]:
    """The bins of a span in which ranks of its group lie, as spans."""
    order = sorted(counts)
    ends = [span.below + e for e in accumulate(counts[b] for b in order)]
    width, out = max(1, span.width // bins), {}
    for rank in ranks:
        k = bisect_right(ends, rank)
        found = Span(span.group, span.low + order[k] * width, width, ends[k] - counts[order[k]], counts[order[k]])
        out.setdefault(found, []).append(rank)
    return out


def cuts_in(df: DataFrame, group: Column, h: Column, wanted: Mapping[Span, Sequence[int]]) -> dict[tuple[int, int], Cut]:
    """The cuts at ranks that are known to lie in these spans."""
    wanted, out = dict(wanted), {}
    while large := [s for s in wanted if s.rows > BUFFER and s.width > 1]:
        bins = _share(len(large))
        for i, counts in _counted(df, group, h, large, bins).items():
            wanted |= narrowed(large[i], counts, wanted.pop(large[i]), bins)
    spans = list(wanted)
    if spans:
        which = F.lit(None).cast("int")
        for i, s in enumerate(spans):
            which = F.when(s.holds(F.col("g"), F.col("h")), F.lit(i)).otherwise(which)
        found: dict[int, Counter] = {i: Counter() for i in range(len(spans))}
        # the rows of no span count as one value
        placed = df.select(group.alias("g"), h.alias("h")).select(which.alias("span"), "h").select(
            "span", F.when(F.col("span").isNotNull(), F.col("h")).alias("h"))
        for i, value, n in placed.groupBy("span", "h").count().collect():
            if i is not None:
                found[i][value] = n
        for i, s in enumerate(spans):
            values = sorted(found[i])
            ends = [s.below + e for e in accumulate(found[i][v] for v in values)]
            for rank in wanted[s]:
                k = bisect_right(ends, rank)
                out[s.group, rank] = Cut(values[k], ends[k] - found[i][values[k]], found[i][values[k]])
    return out


def _share(groups: int) -> int:
    """Bins of one of so many spans, a power of two."""
    return max(64, 1 << int(math.log2(max(1, BINS // max(1, groups)))))


def ranked(df: DataFrame, groups: int, group: Column, h: Column,
           ranks: Callable[[dict[int, int]], Mapping[int, Sequence[int]]]) -> tuple[dict[tuple[int, int], Cut], dict[int, int]]:
    """Cuts by (group, rank) for 0-based ranks that ``ranks`` names from the groups' sizes, and these sizes. Rows whose
    ``group`` is null are left out."""
    bins = _share(groups)
    spans = [Span(g, 0, SPACE) for g in range(groups)]
    counts = _counted(df, group, h, spans, bins)
    sizes = {g: sum(c.values()) for g, c in counts.items()}
    wanted: dict[Span, list[int]] = {}
    for g, places in ranks(sizes).items():
        wanted |= narrowed(spans[g], counts[g], sorted(set(places)), bins) if sizes[g] else {}
    return cuts_in(df, group, h, wanted), sizes


def fold_ends(rows: int, folds: int) -> list[int]:
    """Last ranks of all folds but the last; the first ``rows mod folds`` folds have one row more."""
    lengths = [rows // folds + (i < rows % folds) for i in range(folds)]
    return [e - 1 for e in list(accumulate(lengths))[:-1] if e > 0]


@dataclass(frozen=True)
class SplitCuts:
    """Test rows have hashes (first, second) up to ``last``; the others' folds end at the second hashes ``ends``."""

    last: tuple[float, float]
    ends: list[float]
    rows: int
    test_rows: int

    def is_test(self, first: Column, second: Column) -> Column:
        value, tie = (F.lit(float(x)) for x in self.last)
        return (first < value) | ((first == value) & (second <= tie))


def split_and_folds(df: DataFrame, first: Column, second: Column, test_size: float, folds: int) -> SplitCuts | None:
    """Where a split into ceil(test_size * n) test rows by ``first`` (ties by ``second``) and folds of the others by
    ``second`` end, from three passes; None where a bin is too large to be read out at once.

    The second pass reads the rows of the bin that holds the test cut and, for the rows above it, counts the second hash;
    with the rows of that bin added, the fold ends are known to a bin, which the third pass reads out.
    """
    everything, whole = F.lit(0), Span(0, 0, SPACE)
    counts = _counted(df, everything, first, [whole], BINS)[0]
    n = sum(counts.values())
    test = math.ceil(test_size * n)
    if not 0 < test < n:
        return None
    (edge,) = narrowed(whole, counts, [test - 1], BINS)
    if edge.rows > BUFFER:
        return None
    inside = edge.holds(everything, first)
    above = df.where(first >= float(edge.low)).select(
        F.when(inside, first).alias("first"), F.when(inside, second).otherwise(bin_of(second, 0, SPACE, BINS).cast("double")).alias("second"))
    found = above.groupBy("first", "second").count().collect()
    border = sorted((a, b) for a, b, k in found if a is not None for _ in range(k))
    last, train = border[test - 1 - edge.below], border[test - edge.below:]
    train = [pair for pair in train if pair > last]  # equal pairs stay together
    binned = Counter({int(b): k for a, b, k in found if a is None})
    binned.update(int(b) // (SPACE // BINS) for _, b in train)
    rows = sum(binned.values())
    wanted = narrowed(whole, binned, fold_ends(rows, folds), BINS) if rows else {}
    cut = SplitCuts(last, [], n, n - rows)
    is_train = F.when(~cut.is_test(first, second), 0)
    cuts = cuts_in(df, is_train, second, wanted)
    return SplitCuts(last, [cuts[0, e].value for e in fold_ends(rows, folds)], n, n - rows)
