"""Ranked lexical search: the documents with the highest term-weight scores for each query, found by Bloom signatures.

Index. A task counts the terms of its documents and gives each a Bloom signature. A term that occurs tf times is entered
once for every level of ``levels()`` up to tf, so a signature overestimates how often a term occurs, never underestimates
it. Documents with about as many entries share a width and are laid out together, bit-sliced: a row for each bit of the
signature, a column for each document. Short and very long documents thus cost the same share of their own length.

Search. For a term and a level, the AND of its slices marks the documents that may hold the term that often. Slices,
weighted by the query terms' weights, are summed over the terms; each level's sum counts with what that level can add to a
score at the document's length. That is an upper bound of the score, equal to it but for false marks and the width of the
levels. The documents with the highest bounds are scored exactly, which gives each query a score that its results must
reach; a second pass over the slices names every document whose bound reaches it, and these are scored exactly from their
texts. No other document can be among the results.

A score is the sum, over the query's terms with repeats, of w * ((10**9 * tf) div (1000 * tf + 8 * m)), with
w = floor(1000 * ln((2N + 2) / (2 df + 1))) and m = 25 + (75 * n * N) div L; N counts the documents with a term, L all terms.

Queries are a stated set. They are read in blocks of about ``QUERY_TERMS`` terms, and equal texts are searched once; all
documents meet a block as a small table in the task. Documents are named between steps by 64 bits of id and text; a name
that two documents shared would only be scored once more than needed.

Null and empty texts have no terms, as documents and as queries, and are in no result; very long texts are read whole;
documents with equal ids, or null ones, are documents of their own and may both be results; equal scores go by ascending
id, null last; each row of the queries gets its results, also where ids repeat; an empty table on either side gives no
rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import LETTERED, LOWER, UPPER, lowered, stored

TOP = 10
#: Bits of a signature for each entry, at least, and slices for each entry: one false mark in 10,000.
ENTRY_BITS, HASHES = 18, 9
#: Bits and documents of a block of the index, and characters of texts that are counted at once.
BLOCK_BITS, BLOCK_DOCS = 1 << 22, 1 << 12
BLOCK_CHARS = 1 << 21
MEMO_TERMS = 1 << 17
QUERY_TERMS = 20_000
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

#: Bytes of terms, A-Z lower-cased; all others part terms. Every byte beyond ASCII belongs to a term.
TERM_BYTES = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def levels() -> np.ndarray:
    """Numbers of occurrences that are told apart: all up to 8, then four to each doubling."""
    return np.array([*range(1, 8), *[(4 + k % 4) << k // 4 for k in range(4, 136)]], np.int64)


LEVELS = levels()


class Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def counted(texts: list[str | None], number: Numbers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of each text; text, term and occurrences of each different term of each text, by text."""
    cut = [terms_of(t) for t in texts]
    sizes = np.array([len(c) for c in cut], np.int64)
    codes = np.fromiter((number[w] for words in cut for w in words), np.int64, int(sizes.sum()))
    pairs, tf = np.unique(np.repeat(np.arange(len(texts)), sizes) << 40 | codes, return_counts=True)
    return sizes, pairs >> 40, pairs & ((1 << 40) - 1), tf


def part(texts: list[str | None]) -> Iterator[slice]:
    """Neighbouring texts of about BLOCK_CHARS characters, one text at least."""
    begin = total = 0
    for end, text in enumerate(texts, 1):
        total += len(text or "")
        if total >= BLOCK_CHARS or end == len(texts):
            yield slice(begin, end)
            begin, total = end, 0


def entry_hashes(terms: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    h = (terms + np.asarray(level).astype(np.uint64) * np.uint64(MIX[0])) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(29))


def bits_of(entries: np.ndarray, width: int) -> np.ndarray:
    """The bits of each entry, one column for each hash: steps of one hash from another, brought into the width."""
    first, step = entries >> np.uint64(32), entries * np.uint64(MIX[2]) >> np.uint64(32) | np.uint64(1)
    spread = (first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)
    return (spread * np.uint64(width) >> np.uint64(32)).astype(np.int64)


def class_width(entries: int) -> int:
    """Bits of a signature with so many entries: four widths to each doubling."""
    shift = max(0, entries.bit_length() - 3)
    return ENTRY_BITS * (-(-entries >> shift) << shift)


def term_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, 13) for w in words], np.uint64)


def sliced(width: int, docs: list[tuple[int, int, np.ndarray]]) -> dict:
    """A block: names and sizes of its documents and a row of packed bits for each bit of their signatures."""
    table = np.zeros((width, -(-len(docs) // 8) * 8), bool)
    entries = np.concatenate([d[2] for d in docs])
    table[bits_of(entries, width), np.repeat(np.arange(len(docs)), [len(d[2]) for d in docs])[:, None]] = True
    return {"width": width, "names": [d[0] for d in docs], "sizes": [d[1] for d in docs],
            "slices": np.packbits(table, axis=1).tobytes()}


INDEX = pa.schema([("width", pa.int32()), ("names", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("slices", pa.binary())])


def named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and a name of 64 bits for each document."""
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(ident.alias("id"), text.alias("text"), F.xxhash64(ident.isNull(), ident, text).alias("name"))


def signature_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The blocks of the index, stored in the shared folder; documents without terms are in none."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, hashes, waiting = Numbers(), np.zeros(0, np.uint64), {}

        def block(width: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([sliced(width, waiting.pop(width))], INDEX)

        for batch in batches:
            names, all_texts = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for rows in part(all_texts):
                sizes, doc, code, tf = counted(all_texts[rows], number)
                if len(number) > len(hashes):
                    hashes = np.concatenate([hashes, term_hashes(list(number)[len(hashes):])])
                reached = np.searchsorted(LEVELS, tf, "right")
                level = np.arange(reached.sum()) - np.repeat(np.cumsum(reached) - reached, reached)
                entries = entry_hashes(np.repeat(hashes[code], reached), level)
                ends = np.cumsum(np.bincount(doc, reached, len(sizes)).astype(np.int64))
                for k, (name, size, end) in enumerate(zip(names[rows], sizes.tolist(), ends.tolist())):
                    begin = int(ends[k - 1]) if k else 0
                    if end > begin:
                        width = class_width(end - begin)
                        waiting.setdefault(width, []).append((name, size, entries[begin:end].copy()))
                        if len(waiting[width]) >= max(8, min(BLOCK_DOCS, BLOCK_BITS // width)):
                            yield block(width)
                if len(number) > MEMO_TERMS:
                    number, hashes = Numbers(), np.zeros(0, np.uint64)
        for width in list(waiting):
            yield block(width)

    blocks = named(docs, id_col, text_col).select("text", "name").mapInArrow(
        build, "width int, names array<bigint>, sizes array<bigint>, slices binary")
    return stored(blocks, "signatures")


def collection_size(index: DataFrame) -> tuple[int, int]:
    """Documents with terms, and all their terms."""
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    n, length = index.agg(F.sum(F.size("names")), F.sum(total)).first()
    return n or 0, length or 0


def document_frequencies(docs: DataFrame, vocabulary: list[bytes], text_col: str = "text") -> np.ndarray:
    """For each term the number of documents that hold it, added up in the tasks first."""
    place = {w: k for k, w in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = place.keys(), np.zeros(len(place), np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = known & set(terms_of(text.as_py()))
                held[[place[w] for w in found]] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["term", "held"])

    out = np.zeros(len(vocabulary), np.int64)
    counts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "term bigint, held bigint")
    for term, held in counts.groupBy("term").agg(F.sum("held")).collect():
        out[term] = held
    return out


class Queries:
    """A block of query texts: their terms, the weights of these, and the search functions that run in the tasks."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        bags = [Counter(terms_of(t)) for t in texts]
        self.vocabulary = sorted(set().union(*bags))
        self.place = {w: k for k, w in enumerate(self.vocabulary)}
        self.bags = [(np.array([self.place[w] for w in b], np.int64), np.array(list(b.values()), np.int64)) for b in bags]

    def weigh(self, held: np.ndarray, n: int, length: int) -> None:
        self.n, self.length = n, length
        self.weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in held], np.int64)

    def norms(self, sizes: np.ndarray) -> np.ndarray:
        if len(sizes) and 75 * int(sizes.max()) * self.n >= 1 << 63:
            return np.array([25 + 75 * s * self.n // self.length for s in sizes.tolist()], np.int64)
        return 25 + 75 * sizes * self.n // max(1, self.length)

    def bounds(self, width: int, sizes: np.ndarray, slices: np.ndarray) -> np.ndarray:
        """For each document of a block and each query, a number that the score does not exceed."""
        matrix = np.zeros((len(self.vocabulary), len(self.texts)))
        for q, (terms, times) in enumerate(self.bags):
            matrix[terms, q] = self.weights[terms] * times
        alive = np.flatnonzero(self.weights > 0)
        hashes = term_hashes([self.vocabulary[k] for k in alive])
        marks = np.full((len(alive), slices.shape[1]), 255, np.uint8)
        out, reached = np.zeros((len(sizes), len(self.texts))), np.zeros(len(sizes), np.int64)
        norms = self.norms(sizes)
        for level in range(len(LEVELS)):
            rows = bits_of(entry_hashes(hashes, level), width)
            for k in range(HASHES):
                marks &= slices[rows[:, k]]
            some = marks.any(axis=1)
            alive, hashes, marks = alive[some], hashes[some], marks[some]
            if not len(alive):
                break
            most = sizes if level + 1 == len(LEVELS) else np.minimum(LEVELS[level + 1] - 1, sizes)
            value = 1_000_000_000 * most // (1000 * most + 8 * norms)
            marked = np.unpackbits(marks, axis=1, count=len(sizes)).T.astype(np.float64)
            out += (marked @ matrix[alive]) * np.maximum(value - reached, 0)[:, None]
            reached = np.maximum(value, reached)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The value of each term of the queries in each text, weights included."""
        cut = [terms_of(t) for t in texts]
        sizes = np.array([len(c) for c in cut], np.int64)
        tf = np.zeros((len(texts), len(self.vocabulary)), np.int64)
        for k, words in enumerate(cut):
            at = [self.place[w] for w in words if w in self.place]
            np.add.at(tf[k], at, 1)
        return self.weights * (1_000_000_000 * tf // np.maximum(1, 1000 * tf + 8 * self.norms(sizes)[:, None]))


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in range(batch.num_rows):
            width, names, sizes, slices = (c[row] for c in batch.columns)
            names = names.values.to_numpy()
            table = np.frombuffer(slices.as_buffer(), np.uint8).reshape(width.as_py(), -1)
            yield width.as_py(), names, sizes.values.to_numpy(), table


def highest_bounds(index: DataFrame, queries: Queries, top: int) -> DataFrame:
    """(name, queries): the documents with the highest bounds for each query."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, len(queries.texts)))
        owners = np.zeros((0, len(queries.texts)), np.int64)
        for width, names, sizes, slices in blocks_of(batches):
            best = np.concatenate([best, queries.bounds(width, sizes, slices)])
            owners = np.concatenate([owners, np.broadcast_to(names[:, None], (len(names), owners.shape[1]))])
            if len(best) > top:
                keep = np.argpartition(-best, top - 1, axis=0)[:top]
                best, owners = np.take_along_axis(best, keep, 0), np.take_along_axis(owners, keep, 0)
        row, query = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(owners[row, query]), pa.array(best[row, query])],
                                         ["query", "name", "bound"])

    found = index.mapInArrow(search, "query int, name bigint, bound double")
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "name")
    first = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    return first.groupBy("name").agg(F.collect_set("query").alias("queries"))


def reaching(index: DataFrame, queries: Queries, least: np.ndarray) -> DataFrame:
    """(name, queries): every document whose bound reaches what a query asks for."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for width, names, sizes, slices in blocks_of(batches):
            doc, query = np.nonzero(queries.bounds(width, sizes, slices) >= least)
            which, counts = np.unique(doc, return_counts=True)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(query, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(names[which]), lists], ["name", "queries"])

    found = index.mapInArrow(search, "name bigint, queries array<int>")
    # equal documents share a name; of their lists one will do, and a name given to two documents serves both
    return found.groupBy("name").agg(F.array_distinct(F.flatten(F.collect_set("queries"))).alias("queries"))


def best_scores(docs: DataFrame, wanted: DataFrame, queries: Queries, top: int) -> DataFrame:
    """(query, id, score, rank): exact scores of the wanted documents, the best of each query. Every task gives only its
    own best ones."""
    id_field = docs.schema["id"]
    schema = T.StructType([T.StructField("query", T.IntegerType()), id_field, T.StructField("score", T.LongType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {}
        id_type = None
        for batch in batches:
            ids, all_texts, asked = (c.to_pylist() for c in batch.columns)
            id_type = batch.schema.field(0).type
            for rows in part(all_texts):
                for at in range(rows.start, rows.stop, 256):
                    some = slice(at, min(at + 256, rows.stop))
                    values = queries.scores(all_texts[some])
                    by_query: dict[int, list[int]] = {}
                    for k, qs in enumerate(asked[some]):
                        for q in qs:
                            by_query.setdefault(q, []).append(k)
                    for q, members in by_query.items():
                        terms, times = queries.bags[q]
                        totals = values[np.ix_(members, terms)] @ times
                        known = best.setdefault(q, [])
                        floor = known[-1][0] if len(known) >= top else 1
                        known += [(int(s), ids[at + k]) for k, s in zip(members, totals) if s >= floor]
                        known.sort(key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1]))
                        del known[top:]
        if best:
            rows = [(q, i, s) for q, known in best.items() for s, i in known]
            q, i, s = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(i, id_type), pa.array(s, pa.int64())],
                                             ["query", "id", "score"])

    found = docs.join(wanted, "name").select("id", "text", "queries").mapInArrow(score, schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def query_blocks(queries: DataFrame, text_col: str) -> Iterator[list[str]]:
    """Different texts of the queries, in blocks of about QUERY_TERMS terms."""
    texts = queries.select(F.col(f"`{text_col}`").alias("text")).where(F.regexp_like(lowered(F.col("text")), F.lit(LETTERED))).distinct()
    terms = texts.agg(F.sum(F.regexp_count(lowered(F.col("text")), F.lit(LETTERED)))).first()[0] or 0
    blocks = math.ceil(terms / QUERY_TERMS)
    for b in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()
        if rows:
            yield sorted(r["text"] for r in rows)


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id",
           query_text: str = "text", top: int = TOP) -> DataFrame:
    """(query_id, rank, id, score) of the best documents for every row of the queries."""
    rows, index, results = named(docs, id_col, text_col), None, None
    for texts in query_blocks(queries, query_text):
        index = signature_index(docs, id_col, text_col) if index is None else index
        block = Queries(texts)
        block.weigh(document_frequencies(docs, block.vocabulary, text_col), *collection_size(index))
        seeds = best_scores(rows, stored(highest_bounds(index, block, top), "seeds"), block, top)
        least = np.ones(len(texts))
        for query, score in seeds.where(F.col("rank") == top).select("query", "score").collect():
            least[query] = score
        found = best_scores(rows, stored(reaching(index, block, least), "candidates"), block, top)
        numbered = docs.sparkSession.createDataFrame(list(enumerate(texts)), "query int, query_text string")
        found = stored(found.join(numbered, "query").drop("query"), "ranked")
        results = found if results is None else results.unionByName(found)
    asked = queries.select(F.col(f"`{query_id}`").alias("query_id"), F.col(f"`{query_text}`").alias("asked"))
    if results is None:
        results = rows.limit(0).select(F.lit("").alias("query_text"), "id", F.lit(0).cast("long").alias("score"), F.lit(0).alias("rank"))
    return asked.join(results, F.col("asked") == F.col("query_text")).select("query_id", "rank", "id", "score")


_CUT = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{LETTERED}')"
SEARCH_SQL = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS d, doc_id, {_CUT} AS words FROM documents WHERE len({_CUT}) > 0),
 size AS (SELECT count(*) AS n, sum(len(words))::BIGINT AS l FROM docs),
 terms AS MATERIALIZED (
  SELECT d, word, count(*) AS tf FROM (SELECT d, unnest(words) AS word FROM docs) GROUP BY d, word),
 asked AS MATERIALIZED (
  SELECT i, item_id, word, count(*) AS times
  FROM (SELECT row_number() OVER () AS i, item_id, unnest({_CUT}) AS word FROM benchmark) GROUP BY i, item_id, word),
 weights AS (
  SELECT word, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT word, count(*) AS df FROM terms SEMI JOIN asked USING (word) GROUP BY word), size),
 norms AS (SELECT d, doc_id, 25 + (75 * len(words) * n) // l AS m FROM docs, size),
 scored AS (
  SELECT i, item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (word) JOIN terms USING (word) JOIN norms USING (d) GROUP BY i, item_id, d, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= {TOP}
"""
