"""Quality rules: base counts of words, lines and repeats, and compression bands.

A text that zstandard shrinks far below what prose of its length allows repeats itself; one that it hardly shrinks is
noise (encoded bytes, random characters). Both limits depend on the length, since short inputs give the compressor
little to refer back to. The same limits are asked of every fixed chunk, so that a repetitive or random stretch inside a
text shows although the whole is inconspicuous. The last chunk is judged by its own length; a rest of under
``LEAST_BYTES`` bytes, too short to be told apart, belongs to the chunk before it.

Null and empty texts have no words: all counts are 0, the ratio is null, and ``base_failed`` rejects them. Very long
texts are compressed whole; repeated rows are judged one by one; an empty table gives an empty table; other columns of
the input, whatever their names, are not read by ``measure`` and stay untouched in ``filter_quality``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import fresh

#: From so many bytes on, the lowest and highest allowed ratio of compressed to plain size.
#: Upper limits lie between what prose reaches (sf0.1, all four languages, whole texts and chunks, from 128 bytes on: 0.93,
#: 0.86, 0.77, 0.70, 0.61, 0.48, 0.43) and the least of random base64 (0.94, 0.90, 0.84, 0.79, 0.76, 0.75, 0.75). Below
#: 128 bytes the two overlap, so there is no limit.
BANDS = ((0, 0.0, 9.9), (128, 0.0, 0.94), (192, 0.0, 0.89), (256, 0.20, 0.82), (512, 0.20, 0.75), (1024, 0.20, 0.70),
         (4096, 0.18, 0.65), (16384, 0.15, 0.65))
CHUNK_BYTES = 1024
#: A shorter rest makes no chunk of its own.
LEAST_BYTES = 128
#: A text goes if more than this share of its bytes lies in chunks below the band, or in chunks above it.
CHUNK_SHARE = 0.3
LEVEL = 3
SYMBOLS = tuple(bytes([c]) for c in b"#*$%&|<>")
SPACES = tuple(" \t\n\v\f\r")
FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_bytes long, ratio double, n_chunks long, n_low_chunks long, n_high_chunks long, compression_verdict string")


def band(size: int, bands) -> tuple[float, float]:
    return next((low, high) for start, low, high in reversed(bands) if size >= start)


def duplicate_lines(data: bytes) -> int:
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that stand in a window of ``width`` words found twice or more."""
    grams = list(zip(*(words[i:] for i in range(width))))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    covered = bytearray(len(words))
    mark = b"\1" * width
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            covered[i:i + width] = mark
    return sum(covered)


def compression(data: bytes, press, bands, chunk_bytes: int, chunk_share: float):
    """Ratio of the whole, chunk counts and the verdict (null: inside the bands)."""
    if not data:
        return None, 0, 0, 0, None
    ratio = len(press(data)) / len(data)
    low, high = band(len(data), bands)
    verdict = "repetitive" if ratio < low else "incompressible" if ratio > high else None
    starts = range(0, max(1, len(data) - LEAST_BYTES + 1), chunk_bytes)
    chunks = [data[s:e] for s, e in zip(starts, [*starts[1:], len(data)])]
    ratios = [len(press(c)) / len(c) for c in chunks] if len(chunks) > 1 else [ratio]
    limits = [band(len(c), bands) for c in chunks]
    under = [len(c) for c, r, (low, _) in zip(chunks, ratios, limits) if r < low]
    over = [len(c) for c, r, (_, high) in zip(chunks, ratios, limits) if r > high]
    if verdict is None:
        if sum(under) > chunk_share * len(data):
            verdict = "repetitive chunks"
        elif sum(over) > chunk_share * len(data):
            verdict = "incompressible chunks"
    return ratio, len(ratios), len(under), len(over), verdict


def measured(text: Column, bands=BANDS, chunk_bytes: int = CHUNK_BYTES, chunk_share: float = CHUNK_SHARE) -> Column:
    """All counts of one text as a struct."""

    @F.pandas_udf(FIELDS)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=LEVEL).compress
        for texts in batches:
            rows = []
            for text in texts:
                text = text or ""
                data = text.encode()
                words = data.split()
                rows.append((len(words), len(text) - sum(map(text.count, SPACES)), sum(map(data.count, SYMBOLS)),
                             duplicate_lines(data), repeated_words(words), len(data),
                             *compression(data, press, bands, chunk_bytes, chunk_share)))
            yield pd.DataFrame(rows, columns=[part.split()[0] for part in FIELDS.split(", ")])

    return measure(text)


def failed(m: Column) -> Column:
    """The base rule: too few words, or over a fifth of them in repeated windows."""
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def measure_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per document: the id, all counts, ``base_failed`` and ``kept``."""
    m = F.col("m")
    return (docs.select(F.col(f"`{id_col}`").alias("id"), measured(F.col(f"`{text_col}`"), **limits).alias("m"))
            .select(F.col("id").alias(id_col), "m.*", failed(m).alias("base_failed"),
                    (~failed(m) & m["compression_verdict"].isNull()).alias("kept")))


def filter_quality(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The documents that pass, with all their columns."""
    m, name = measured(F.col(f"`{text_col}`"), **limits), fresh("quality", docs)
    kept = ~failed(F.col(name)) & F.col(name)["compression_verdict"].isNull()
    return docs.withColumn(name, m).where(kept).select(*[F.col(f"`{c}`") for c in docs.columns])
