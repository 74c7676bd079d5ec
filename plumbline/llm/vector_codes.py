"""Vector code compression: vectors become a few bytes each, the index of the nearest codebook entry for each part.

Components are taken as the integers floor(``SCALE`` * x), so all sums and distances are exact and every rerun, on any
number of executors, gives the same codebooks. A round is one pass: tasks assign the parts and add up, per codebook entry,
what is assigned to it; Spark adds the tasks' sums; the driver divides. It never holds more than the codebooks.

Most distances are never computed. A part lies in a cell of a coarse grid, whose coordinates are hashed. For a cell that a
task has not met, the least and the greatest distance from each entry to the cell's box are computed once; an entry whose
least distance exceeds another one's greatest is nearest to no point of the box. The other entries are remembered for the
cell, and only these are evaluated for its points. Coordinates are compared after the hash: a point whose cell shares a
hash with another cell is evaluated against all entries. The memory of a task is emptied when it holds ``MEMO_CELLS``.

Rows whose vector is null or empty or holds a null, NaN or infinite component are dropped, and so are rows whose vector's
length is no multiple of the number of parts, or not that of the first kept row. Rows are ordered by id (null last) and
vector for the first codebook; rows with equal ids, or null ones, are rows like any other; of fewer rows than entries, each
is an entry; equal entries: the first one gets the parts, the others stay as they are. An empty table gives an empty table.
Components of 32,768 or more in size raise an error, since squared distances would leave 64 bits. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import stored

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
LARGEST = 1 << 27
#: Cells across the range of the entries in each direction.
ACROSS = 128
MEMO_CELLS = 1 << 15
#: Points whose distances are computed at once.
BLOCK = 1 << 12
#: Labels of more rows than this have their total broadcast: of n rows, n / HOT_ROWS labels at most.
HOT_ROWS = 1_000_000


class Cells:
    """Nearest entries of one codebook, with a memory of the entries that matter in each cell of a coarse grid."""

    def __init__(self, book: np.ndarray):
        self.book = book
        spread = int((book.max(axis=0) - book.min(axis=0)).max(initial=1))
        self.shift = max(0, (max(1, spread // ACROSS)).bit_length() - 1)
        self.factors = (np.arange(book.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        self.evaluated = self.points = 0
        self.forget()

    def forget(self) -> None:
        self.places: dict[int, int] = {}
        self.corners = np.zeros((0, self.book.shape[1]), np.int64)
        self.wanted = np.zeros((0, len(self.book)), bool)

    def undominated(self, corners: np.ndarray) -> np.ndarray:
        """For each cell the entries that can be nearest to a point of it; equal distances do not exclude."""
        low = (corners << self.shift)[:, None, :]
        high = low + ((1 << self.shift) - 1)
        near = np.maximum(np.maximum(low - self.book, self.book - high), 0)
        far = np.maximum(np.abs(self.book - low), np.abs(high - self.book))
        return (near * near).sum(axis=2) <= (far * far).sum(axis=2).min(axis=1)[:, None]

    def candidates(self, points: np.ndarray) -> np.ndarray:
        cells = points >> self.shift
        hashes = (cells.astype(np.uint64) * self.factors).sum(axis=1)
        hashes ^= hashes >> np.uint64(29)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.places) + len(distinct) > MEMO_CELLS:
            self.forget()
        new = [i for i, h in enumerate(distinct.tolist()) if h not in self.places]
        if new:
            corners = cells[first[new]]
            self.places.update(zip(distinct[new].tolist(), range(len(self.corners), len(self.corners) + len(new))))
            self.corners = np.concatenate([self.corners, corners])
            self.wanted = np.concatenate([self.wanted, self.undominated(corners)])
        place = np.array([self.places[h] for h in distinct.tolist()], np.int64)[back]
        wanted = self.wanted[place]
        wanted[(self.corners[place] != cells).any(axis=1)] = True
        return wanted

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lower one of equals, and its squared distance, for each point."""
        codes, errors = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        for at in range(0, len(points), BLOCK):
            block = points[at:at + BLOCK]
            row, entry = np.nonzero(self.candidates(block))
            away = block[row] - self.book[entry]
            distance = (away * away).sum(axis=1)
            begin = np.searchsorted(row, np.arange(len(block)))
            least = np.minimum.reduceat(distance, begin)
            best = np.flatnonzero(distance == least[row])
            best = best[np.concatenate([[True], np.diff(row[best]) != 0])]
            codes[at:at + BLOCK], errors[at:at + BLOCK] = entry[best], least
            self.evaluated, self.points = self.evaluated + len(row), self.points + len(block)
        return codes, errors


def whole_vectors(vector: Column) -> Column:
    """Neither null nor empty, without null, NaN or infinite components."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & sound, F.lit(False))


def integers(vectors: pa.Array, length: int) -> np.ndarray:
    values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(-1, length)
    if len(values) and np.abs(values).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST // SCALE} or more in size have no 64-bit distances")
    return values.astype(np.int64)


def summed(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round's sums of the parts assigned to each entry, and their counts in the last place."""
    parts, entries, width = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book) for book in books]
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            values = integers(batch.column(0), parts * width).reshape(-1, parts, width)
            for p in range(parts):
                codes, _ = cells[p].nearest(values[:, p])
                np.add.at(sums[p, :, :width], codes, values[:, p])
                sums[p, :, width] += np.bincount(codes, minlength=entries)
        slots = np.flatnonzero(sums.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(sums.ravel()[slots], pa.int64())], ["slot", "total"])

    rows = kept.select("vector").mapInArrow(assign, "slot bigint, total bigint")
    totals = np.zeros(books.size + parts * entries, object)
    for slot, total in rows.groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        totals[slot] = int(total)
    return totals.reshape(parts, entries, width + 1)


def fit_codebooks(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS,
                  entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """The codebooks, parts x entries x width; None where no row is kept."""
    kept = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    kept = kept.where(whole_vectors(F.col("vector")) & (F.size("vector") % parts == 0))
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*order).first()
    if first is None:
        return None
    length = len(first["vector"])
    kept = kept.where(F.size("vector") == length)
    start = [r["vector"] for r in kept.orderBy(*order).limit(entries).collect()]
    books = np.floor(np.array(start, np.float64) * SCALE).astype(np.int64)
    books = books.reshape(len(start), parts, length // parts).transpose(1, 0, 2)
    for _ in range(rounds):
        totals = summed(kept, books)
        counts = totals[:, :, -1:]
        means = totals[:, :, :-1] // np.where(counts == 0, 1, counts)
        books = np.where(counts == 0, books, means).astype(np.int64)
    return books


def encode_vectors(df: DataFrame, books: np.ndarray, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """(id, label, code, error) of every kept row: two hex digits a part, and the squared distance to what they stand for."""
    parts, _, width = books.shape
    vector = F.col(f"`{vector_col}`")
    kept = df.where(whole_vectors(vector) & (F.size(vector) == parts * width)).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), vector.alias("vector"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book) for book in books]
        for batch in batches:
            values = integers(batch.column(2), parts * width).reshape(-1, parts, width)
            codes, errors = zip(*[cells[p].nearest(values[:, p]) for p in range(parts)])
            digits = np.stack(codes, axis=1).astype(np.uint8).tobytes().hex()
            code = [digits[at:at + 2 * parts] for at in range(0, len(digits), 2 * parts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()),
                                              pa.array(np.sum(errors, axis=0), pa.int64())], ["id", "label", "code", "error"])

    schema = T.StructType([kept.schema["id"], kept.schema["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    return kept.mapInArrow(encode, schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the sum of ``error`` over the rows of the same label. The few labels of very many rows get
    their total from a broadcast, and their rows are spread in the join that serves the others."""
    totals = stored(coded.groupBy("label").agg(F.sum("error").alias("total"), F.count(F.lit(1)).alias("n")), "label-totals")
    hot = totals.where(F.col("n") > HOT_ROWS).select(F.col("label").alias("hot_label"), F.col("total").alias("hot_total"))
    rest = totals.where(F.col("n") <= HOT_ROWS).select(F.col("label").alias("rest_label"), F.col("total").alias("rest_total"),
                                                       F.lit(0).cast("long").alias("rest_spread"))
    rows = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("hot_label")), "left")
    rows = rows.withColumn("spread", F.when(F.col("hot_total").isNull(), 0).otherwise(
        1 + F.pmod(F.xxhash64("id", "code"), F.lit(1 << 20))))
    rows = rows.join(rest, F.col("label").eqNullSafe(F.col("rest_label")) & (F.col("spread") == F.col("rest_spread")), "left")
    return rows.select("id", "label", "code", "error", F.coalesce("hot_total", "rest_total").alias("label_error"))


def decode_codes(coded: DataFrame, books: np.ndarray, code: str = "code") -> DataFrame:
    """Adds ``approximation``: the vector that a code stands for."""
    parts = books.shape[0]
    tables = F.array(*[F.array(*[F.array(*[F.lit(float(x) / SCALE) for x in entry]) for entry in book]) for book in books])
    digits = [F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int") for p in range(parts)]
    return coded.withColumn("approximation", F.concat(*[tables[p][digits[p]] for p in range(parts)]))


def compress_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codebooks, and one row (id, label, code, error, label_error) per kept row."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    books = fit_codebooks(df, id_col, vector_col, parts, entries, rounds)
    if books is None:
        books = np.zeros((parts, 0, 0), np.int64)
        types = [df.schema[id_col].dataType.simpleString(), df.schema[label_col].dataType.simpleString()]
        schema = f"id {types[0]}, label {types[1]}, code string, error bigint, label_error bigint"
        return df.sparkSession.createDataFrame([], schema), books
    return with_label_error(stored(encode_vectors(df, books, id_col, vector_col, label_col), "vector-codes")), books


def _round_sql(r: int) -> str:
    """One assignment in SQL and, from it, the next codebook; floor of a quotient of integers without rounding."""
    mean = "(t - ((t % n) + n) % n) // n"
    return f"""
 near{r} AS MATERIALIZED (
  SELECT v, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
   SELECT p.v, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
   FROM parts p JOIN book{r} b USING (part)) GROUP BY v, part),
 book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN (
   SELECT part, entry, list(({mean})::BIGINT ORDER BY place) AS x FROM (
    SELECT part, entry, place, sum(c) AS t, count(*) AS n FROM (
     SELECT p.part, near{r}.entry, unnest(p.x) AS c, unnest(range(len(p.x))) AS place FROM parts p JOIN near{r} USING (v, part))
    GROUP BY part, entry, place) GROUP BY part, entry) m USING (part, entry)),"""


VECTOR_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS v, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
 parts AS MATERIALIZED (
  SELECT v, part, list_transform(embedding[part * len(embedding) // {PARTS} + 1:(part + 1) * len(embedding) // {PARTS}],
                                 lambda e: floor(e::DOUBLE * {SCALE})::BIGINT) AS x FROM kept, range({PARTS}) t(part)),
 book0 AS (SELECT part, v - 1 AS entry, x FROM parts WHERE v <= {ENTRIES}),{"".join(map(_round_sql, range(ROUNDS + 1)))}
 coded AS (
  SELECT v, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY v),
 digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (v), digest
"""
