"""Substring dedup: words covered by a window of words that occurs twice or more anywhere go.

1. Every task reads its documents in blocks of about ``BLOCK_WORDS`` words and computes a rolling 64-bit hash of each
   window. Windows that repeat inside a block are known to be repeated at once, and one entry stands for them from here
   on: a passage that is in a third of all documents travels once a block.
2. The other windows are only counted. The columns of one count-min sketch are dealt over shards, as many as keep each at
   about ``SHARD_WINDOWS`` windows, so the sketch grows with the input and no task with it. A window's shard follows from
   the smallest hash of the ``ANCHOR``-word sequences inside it: equal windows have equal ones, and neighbours mostly the
   same, so a block sends each shard runs of neighbouring windows, packed: their hashes and, for each run, where it is. A
   sequence that very many windows would follow (a line shared by unlike texts) is found beforehand by counts over all
   texts; its windows go where their own hash says. A shard adds up the partial sketches of all blocks; a sum of counters is never below a window's true count.
3. A second pass over the shard's own parts exactly groups only the windows whose estimate is two or more. Those found
   twice go back, as runs of places, to the block they came from and from there to its documents. None is lost, since
   estimates are never too low.

Only these frequent sequences travel to all tasks, at most ``BLOCK_WORDS / LEAST_HOT`` of them. A block's work follows from its
windows, not from the number of shards. Windows are compared by all 64 bits of the hash, and only within a shard: n windows
in shards of S make n * S / 2**65 false matches in the mean (0.00001 for 130 million, 0.9 for 100 TB of text).

Null and empty texts have no words; texts shorter than a window lose nothing; very long texts are read whole; equal rows
are repetitions of each other; rows are told apart by 64 bits of id and text, so null or equal ids do not matter; an empty
table gives an empty table; other columns, whatever their names, stay untouched in ``drop_repeats`` and are not read elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import fresh, row_key

WINDOW = 35
BLOCK_WORDS = 1 << 20
SHARD_WINDOWS = 1 << 21
ANCHOR = 8
#: A sequence is frequent if it stands for half a shard's windows, but at least for twice this many in the mean of all blocks.
LEAST_HOT = 64
#: Rows of the sketch; each has at least four counters per window of its shard.
DEPTH = 2
SEED = 6
#: Base of the rolling hash, odd, and its inverse modulo 2**64; multipliers that spread bits.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to 0 ... n - 1 and their inverses."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return tuple(out)


def window_hashes(words: np.ndarray, window: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Hash of the window at each place, from differences of prefix sums brought to the same power; bits spread after."""
    n = len(words)
    if n < window:
        return np.zeros(0, np.uint64)
    up, down = table
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=sums[1:])
    h = (sums[window:] - sums[:-window]) * down[:n - window + 1]
    for shift, factor in ((30, MIX[0]), (27, MIX[1])):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def cells(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    """Counters of one row of the sketch; a multiplication gives each row bits of its own."""
    return ((hashes * np.uint64(MIX[row % 2] + 2 * row)) >> np.uint64(32)).astype(np.int64) & (width - 1)


def anchors(words: np.ndarray, window: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each window the smallest hash of the shorter sequences inside it."""
    width = min(ANCHOR, window)
    least, span, wanted = window_hashes(words, width, table), 1, window - width + 1
    while span < wanted:
        step = min(span, wanted - span)
        least, span = np.minimum(least[:-step], least[step:]), span + step
    return least * np.uint64(MIX[0])  # minima are small numbers; the product has all its leading bits again


def runs_of(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows, in order, as runs of neighbours: rows of owner, first place and length; and where each run begins."""
    if not len(place):
        return np.zeros((0, 3), np.uint32), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(owner) != 0)]))
    length = np.diff(np.append(first, len(place)))
    return np.stack([owner[first], place[first], length], axis=1).astype(np.uint32), first


def localized(runs: np.ndarray, ids: list) -> tuple[list, bytes]:
    """Only the ids that own runs, and the runs with owners counted among these."""
    owners, runs[:, 0] = np.unique(runs[:, 0], return_inverse=True)
    return [ids[k] for k in owners], runs.tobytes()


def block_rows(ids: list, hashes: list[np.ndarray], keys: list[np.ndarray], home: int, shards: int):
    """Of one block: a row with the runs repeated in it, and a row per shard with the other windows and one entry for
    each repeated one."""
    joined, key = np.concatenate(hashes), np.concatenate(keys)
    lengths = np.array([len(h) for h in hashes])
    owner = np.repeat(np.arange(len(ids)), lengths)
    place = np.arange(len(joined)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    shard = (key >> np.uint64(65 - shards.bit_length())).astype(np.int64) if shards > 1 else np.zeros(len(key), np.int64)
    order = np.argsort(joined, kind="stable")
    ranked = joined[order]
    same = np.concatenate([[False], ranked[1:] == ranked[:-1], [False]])
    repeated = np.zeros(len(joined), bool)
    repeated[order[same[1:] | same[:-1]]] = True
    stands = order[same[1:] & ~same[:-1]]  # the first of each repeated window
    at = np.flatnonzero(repeated)
    if len(at):
        yield -1 - home % shards, home, *localized(runs_of(owner[at], place[at])[0], ids), b"", b""
    single = np.flatnonzero(~repeated)
    single = single[np.argsort(shard[single], kind="stable")]
    stands = stands[np.argsort(shard[stands], kind="stable")]
    present = np.union1d(shard[single], shard[stands])
    ends = [(np.searchsorted(shard[x], present), np.searchsorted(shard[x], present, "right"), x) for x in (single, stands)]
    for k, s in enumerate(present.tolist()):
        part, strong = (x[first[k]:last[k]] for first, last, x in ends)
        yield s, home, *localized(runs_of(owner[part], place[part])[0], ids), joined[part].tobytes(), joined[strong].tobytes()


def numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint64)


def repeats_in_shard(rows: pd.DataFrame) -> Iterator[tuple[int, list, bytes]]:
    """Per block its ids and runs of windows that occur twice or more over all blocks of one shard."""
    singles, heavies = [numbers(x) for x in rows["hashes"]], [numbers(x) for x in rows["heavy"]]
    width = 1 << max(10, (4 * sum(map(len, singles + heavies))).bit_length())
    estimate, joined = None, np.concatenate(singles)
    for row in range(DEPTH):
        merged = np.zeros(width, np.int32)
        for part, strong in zip(singles, heavies):  # the partial sketches of the blocks
            np.add.at(merged, cells(part, row, width), 1)
            np.add.at(merged, cells(strong, row, width), 2)
        count = merged[cells(joined, row, width)]
        estimate = count if estimate is None else np.minimum(estimate, count)
    maybe = np.flatnonzero(estimate >= 2)
    values, inverse, counts = np.unique(joined[maybe], return_inverse=True, return_counts=True)
    found = maybe[((counts >= 2) | np.isin(values, np.concatenate(heavies)))[inverse]]
    done = 0
    for home, ids, packed, part in zip(rows["home"], rows["ids"], rows["runs"], singles):
        here = found[np.searchsorted(found, done):np.searchsorted(found, done + len(part))] - done
        done += len(part)
        if len(here):
            runs = np.frombuffer(packed, np.uint32).reshape(-1, 3).astype(np.int64)
            starts = np.cumsum(runs[:, 2]) - runs[:, 2]
            run = np.searchsorted(starts, here, "right") - 1
            again, _ = runs_of(runs[run, 0], runs[run, 1] + here - starts[run])
            yield home, *localized(again, list(ids))


def of_documents(rows: pd.DataFrame) -> Iterator[tuple[object, bytes]]:
    """Per id of a block its runs, first place and length."""
    found: dict[object, list[bytes]] = {}
    for ids, packed in zip(rows["ids"], rows["runs"]):
        runs = np.frombuffer(packed, np.uint32).reshape(-1, 3)
        cuts = np.searchsorted(runs[:, 0], np.arange(len(ids) + 1)) if (np.diff(runs[:, 0].astype(np.int64)) >= 0).all() else None
        for k, i in enumerate(ids):
            own = runs[cuts[k]:cuts[k + 1]] if cuts is not None else runs[runs[:, 0] == k]
            found.setdefault(i, []).append(own[:, 1:].tobytes())
    for i, packed in found.items():
        yield i, b"".join(packed)


def hashed_blocks(batches: Iterator[pd.DataFrame], window: int) -> Iterator[tuple[list, list[np.ndarray], list[np.ndarray], int]]:
    """Ids, hashes of windows and their anchors, and the number of words, of about ``BLOCK_WORDS`` words at a time."""
    table = powers(1 << 12)
    ids, hashes, keys, n = [], [], [], 0
    for batch in batches:
        for i, text in zip(batch["id"].astype(object), batch["text"]):
            words = (text or "").encode().split()
            if len(words) < window:
                continue
            if len(words) > len(table[0]):
                table = powers(1 << len(words).bit_length())
            codes = word_hashes(words)
            ids.append(None if i is pd.NA or i != i else i)
            hashes.append(window_hashes(codes, window, table))
            keys.append(anchors(codes, window, table))
            n += len(words)
            if n >= BLOCK_WORDS:
                yield ids, hashes, keys, n
                ids, hashes, keys, n = [], [], [], 0
    if ids:
        yield ids, hashes, keys, n


def frequent_anchors(rows: DataFrame, n_words: int, window: int) -> np.ndarray:
    """The anchors of very many windows, rising. Blocks leave out anchors that are rare in them, half of what is asked in all."""
    n_blocks = n_words // BLOCK_WORDS + 1
    wanted = max(SHARD_WINDOWS // 2, 2 * LEAST_HOT * n_blocks)
    least = wanted // (2 * n_blocks)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, keys, _ in hashed_blocks(batches, window):
            values, counts = np.unique(np.concatenate(keys), return_counts=True)
            often = counts >= least
            yield pd.DataFrame({"anchor": values[often].view(np.int64), "n": counts[often]})

    found = (rows.mapInPandas(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= wanted // 2).select("anchor").toPandas())
    return np.sort(found["anchor"].to_numpy(np.int64).view(np.uint64))


def sent_windows(rows: DataFrame, window: int) -> DataFrame:
    """Rows of ``id`` and ``text`` as packed rows for the shards."""
    # words of five letters and a space behind them
    n_words = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    shards = 1 << max(0, n_words // SHARD_WINDOWS - 1).bit_length()
    frequent = frequent_anchors(rows, n_words, window) if shards > 1 else np.zeros(0, np.uint64)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, hashes, keys, n in hashed_blocks(batches, window):
            if len(frequent):
                keys = [np.where(np.isin(k, frequent), h * np.uint64(MIX[1]), k) for k, h in zip(keys, hashes)]
            home = xxhash.xxh64_intdigest(repr((ids[0], ids[-1], n))) >> 1
            yield pd.DataFrame(list(block_rows(ids, hashes, keys, home, shards)),
                               columns=["shard", "home", "ids", "runs", "hashes", "heavy"])

    return rows.mapInPandas(blocks, T.StructType([
        T.StructField("shard", T.IntegerType()), *places(rows), *[T.StructField(c, T.BinaryType()) for c in ("hashes", "heavy")]]))


def places(rows: DataFrame) -> list[T.StructField]:
    return [T.StructField("home", T.LongType()), T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
            T.StructField("runs", T.BinaryType())]


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """``id`` and ``runs``: first places and lengths of the runs of windows that occur twice or more, packed."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("runs", T.BinaryType())])

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        # negative shards carry what blocks have settled themselves, dealt as evenly as the others
        if rows["shard"].iloc[0] < 0:
            return rows[["home", "ids", "runs"]]
        return pd.DataFrame(list(repeats_in_shard(rows)), columns=["home", "ids", "runs"])

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(of_documents(rows)), columns=["id", "runs"])

    return (sent_windows(rows, window).groupBy("shard").applyInPandas(group, T.StructType(places(rows)))
            .groupBy("home").applyInPandas(gather, found))


def keep(text: str | None, repeated: list[bytes] | None, window: int) -> tuple[list[bytes], np.ndarray]:
    """The words of a text and which of them stay: a run of windows covers its places and a window's length behind them."""
    words = (text or "").encode().split()
    stay = np.ones(len(words), bool)
    for packed in repeated if repeated is not None else ():
        for start, length in np.frombuffer(packed, np.uint32).reshape(-1, 2).tolist():
            stay[start:start + length + window - 1] = False
    return words, stay


def with_repeats(docs: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, str]:
    """The documents with their packed runs of repeated windows in a new column, whose name is returned too."""
    name, key = fresh("repeated", docs), fresh("repeated_id", docs)
    named = row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    rows = docs.select(named.alias("key"), F.col(f"`{text_col}`").alias("text"))
    lists = repeated_windows(rows, "key", "text", window).groupBy(F.col("id").alias(key)).agg(F.collect_list("runs").alias(name))
    return docs.join(lists, named == F.col(key), "left"), name


def mark_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: the id, ``n_words``, ``n_removed`` and ``kept_sha256`` of the words that stay."""
    joined, name = with_repeats(docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias(text_col)),
                                id_col, text_col, window)

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def digest(texts: pd.Series, repeats: pd.Series) -> pd.DataFrame:
        rows = []
        for text, repeated in zip(texts, repeats):
            words, stay = keep(text, repeated, window)
            kept = words if stay.all() else [w for w, s in zip(words, stay.tolist()) if s]
            rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])

    return joined.select(id_col, digest(F.col(f"`{text_col}`"), F.col(name)).alias("d")).select(id_col, "d.*")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents, each text without its repeated words (joined by one space if any went); all columns stay."""
    joined, name = with_repeats(docs, id_col, text_col, window)

    @F.pandas_udf("string")
    def shortened(texts: pd.Series, repeats: pd.Series) -> pd.Series:
        out = []
        for text, repeated in zip(texts, repeats):
            words, stay = keep(text, repeated, window)
            out.append(text if stay.all() else b" ".join(w for w, s in zip(words, stay.tolist()) if s).decode())
        return pd.Series(out, dtype=object)

    text = shortened(F.col(f"`{text_col}`"), F.col(name)).alias(text_col)
    return joined.select(*[text if c == text_col else F.col(f"`{c}`") for c in docs.columns])


#: The same in DuckDB's SQL, windows compared as texts.
SUBSTRING_SQL = r"""WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
windows AS (SELECT doc_id, start, md5(array_to_string(words[start:start + 34], ' ')) AS sequence
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS start FROM docs WHERE len(words) >= 35)),
repeated AS (SELECT doc_id, start FROM windows WHERE sequence IN (SELECT sequence FROM windows GROUP BY 1 HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 35)) AS place FROM repeated),
places AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS word FROM docs),
kept AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM places p ANTI JOIN gone g
    ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY 1)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(k.text, '')) AS kept_sha256 FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id"""
