"""Byte-level BPE: texts to token ids and back, from the merge list of a tokenizer file.

Texts are cut into words by the tokenizer's pattern. A task numbers the different words of a block of texts and encodes
those it has not met, all at once: the symbols of all words lie in one flat array. A round looks up the pairs in the sorted
pair keys by binary search, takes the lowest rank in each word, merges all places of that pair from the left, and looks up
only the pairs beside them anew; words without a known pair leave. A pair's rank is always above the ranks that made its
two symbols (checked on loading), so merging all places of the lowest pair at once gives what merging one by one gives.
The words' ids are remembered by the task up to ``MEMO_SYMBOLS``, then forgotten; texts of a block are gathered from them.

Texts are whole however long; blocks are bounded by characters, and one text is the least block. Null and empty texts have
no ids and decode to the empty text. Rows stay rows: repeated ids and texts, null ids and an empty table need nothing
special. Special tokens written in a text become their ids. Ids unknown to the tokenizer decode to nothing. Bytes that are
not UTF-8 decode to U+FFFD. Other columns stay untouched; ``ids`` or ``decoded`` already there raises an error.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# fixed value: how the byte-level tokenizers of this family cut a text into words
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as Unicode has it; the separators U+001C to U+001F are none, unlike in some regular expressions.
SPACE = r"\p{White_Space}"

BLOCK_CHARS = 1 << 19
MEMO_SYMBOLS = 1 << 20
NONE = np.int64(1) << np.int64(62)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable in Latin-1, else the next one from U+0100 on."""
    out, spare = [], 0x100
    for b in range(256):
        shown = 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD
        out.append(chr(b) if shown else chr(spare))
        spare += not shown
    return out


class Merges:
    """Tables of a tokenizer file: sorted pair keys with ranks and results, bytes of each id, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            tokenizer = json.load(f)
        model, cut = tokenizer["model"], tokenizer["pre_tokenizer"] or {}
        if (model.get("type") != "BPE" or tokenizer["normalizer"] or cut.get("type") != "ByteLevel"
                or cut.get("add_prefix_space") or not cut.get("use_regex", True)):
            raise ValueError("not a plain byte-level BPE tokenizer")
        vocabulary, letters = model["vocab"], byte_letters()
        self.bytes = np.array([vocabulary[c] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, result = (np.array(x, np.int64) for x in zip(
            *[(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]))
        rank = np.arange(len(merges), dtype=np.int64)
        made = np.full(max(vocabulary.values()) + 1, -1, np.int64)
        made[result] = rank
        if len(np.unique(result)) < len(result) or (np.maximum(made[left], made[right]) >= rank).any():
            raise ValueError("a merge comes before the merges that make its symbols")
        order = np.argsort(left << 32 | right)
        self.keys, self.ranks, self.results = (left << 32 | right)[order], rank[order], result[order]
        self.special = {t["content"]: t["id"] for t in tokenizer["added_tokens"] if t["special"]}
        back = {c: b for b, c in enumerate(letters)}
        written = {i: bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
                   for token, i in vocabulary.items()}
        written |= {i: content.encode() for content, i in self.special.items()}
        whole = [written.get(i, b"") for i in range(max(written) + 1)]
        self.lengths = np.array([len(w) for w in whole], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(whole), np.uint8)

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; NONE where the pair is not known."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.results[at]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbol = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        rank, result = np.full(len(symbol), NONE), np.zeros(len(symbol), np.int64)

        def look_up(places: np.ndarray) -> None:
            """Rank and result of the pairs that begin at these places; a word's last symbol begins none."""
            rank[places] = NONE
            places = places[places < len(symbol) - 1]
            places = places[owner[places] == owner[places + 1]]
            rank[places], result[places] = self.ranked(symbol[places], symbol[places + 1])

        look_up(np.arange(len(symbol)))
        finished = []
        while len(symbol):
            begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            length = np.diff(np.append(begin, len(symbol)))
            least = np.minimum.reduceat(rank, begin)
            if (least == NONE).any():
                over = np.repeat(least == NONE, length)
                finished.append((owner[over], symbol[over]))
                symbol, owner, rank, result = (x[~over] for x in (symbol, owner, rank, result))
                if not len(symbol):
                    break
                length, least = length[least < NONE], least[least < NONE]
            place = np.flatnonzero(rank == np.repeat(least, length))
            # in a run of one symbol the places overlap: every second one counts, from the left
            apart = np.concatenate([[True], np.diff(place) != 1])
            run = np.flatnonzero(apart)[np.cumsum(apart) - 1]
            place = place[(np.arange(len(place)) - run) % 2 == 0]
            symbol[place] = result[place]
            keep = np.ones(len(symbol), bool)
            keep[place + 1] = False
            symbol, owner, rank, result = (x[keep] for x in (symbol, owner, rank, result))
            place -= np.arange(len(place))
            look_up(np.concatenate([place[place > 0] - 1, place]))
        owners = np.concatenate([o for o, _ in finished]) if finished else np.zeros(0, np.int64)
        ids = np.concatenate([s for _, s in finished]) if finished else np.zeros(0, np.int64)
        return ids[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all elements of stretches that lie anywhere in a flat array, one stretch after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Encodes blocks of texts, remembering words. Numbers of special tokens are keys of their own type: bytes."""

    class Numbers(dict):
        def __missing__(self, word):
            self[word] = n = len(self)
            return n

    def __init__(self, merges: Merges):
        self.merges = merges
        self.pattern = regex.compile(PATTERN.replace(r"\s", SPACE).replace(r"\S", rf"[^{SPACE}]"))
        names = sorted(merges.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.forget()

    def forget(self) -> None:
        self.number = Encoder.Numbers({name.encode(): k for k, name in enumerate(self.merges.special)})
        self.ids = np.array(list(self.merges.special.values()), np.int64)
        self.lengths = np.ones(len(self.ids), np.int64)

    def words(self, text: str) -> list:
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text)
        out = []
        for k, piece in enumerate(self.special.split(text)):
            out += [piece.encode()] if k % 2 else self.pattern.findall(piece)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        if len(self.ids) > MEMO_SYMBOLS:
            self.forget()
        cut = [self.words(t) for t in texts]
        counts = np.array([len(c) for c in cut], np.int64)
        number = np.fromiter((self.number[w] for words in cut for w in words), np.int64, int(counts.sum()))
        known = len(self.lengths)
        if len(self.number) > known:
            fresh = list(self.number)[known:]
            ids, lengths = self.merges.merge([w.encode() for w in fresh])
            self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        starts, lengths = np.cumsum(self.lengths) - self.lengths, self.lengths[number]
        ids = self.ids[gathered(starts[number], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        return ids, np.diff(ends, prepend=0)


def in_blocks(sizes: Iterable[int], most: int) -> Iterator[slice]:
    """Neighbouring rows of about ``most`` in sum, one row at least."""
    begin = total = end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield slice(begin, end)
            begin, total = end, 0
    if begin < end:
        yield slice(begin, end)


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has a column {name}")
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode_texts(df: DataFrame, path: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds ``ids``, the token ids of each text; without ``keep_text`` the text itself goes."""
    merges = Merges(path)
    schema = _with(df, "ids", T.ArrayType(T.IntegerType()))
    place = df.columns.index(text_col)
    if not keep_text:
        schema = T.StructType([f for k, f in enumerate(schema.fields) if k != place])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges)
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(place)), 0).to_pylist()
            for rows in in_blocks(sizes, BLOCK_CHARS):
                part = batch.slice(rows.start, rows.stop - rows.start)
                ids, counts = encoder.encode([t or "" for t in part.column(place).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                                                 pa.array(ids, pa.int32()))
                others = [c for k, c in enumerate(part.columns) if keep_text or k != place]
                yield pa.RecordBatch.from_arrays([*others, lists], schema.names)

    return df.mapInArrow(encode, schema)


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the token ids of each row; null ids count as none."""
    merges = Merges(path)
    schema, place = _with(df, "decoded", T.StringType()), df.columns.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.list_value_length(batch.column(place)), 0).to_pylist()
            for rows in in_blocks(sizes, BLOCK_CHARS):
                part = batch.slice(rows.start, rows.stop - rows.start)
                counts = np.array(sizes[rows], np.int64)
                ids = pa.compute.fill_null(part.column(place).flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(len(counts)), counts)
                known = (ids >= 0) & (ids < len(merges.lengths))
                ids, owner = ids[known], owner[known]
                lengths = merges.lengths[ids]
                written = merges.flat[gathered(merges.starts[ids], lengths)].tobytes()
                ends = np.cumsum(np.bincount(owner, lengths, len(counts)).astype(np.int64)).tolist()
                texts = [written[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], schema.names)

    return df.mapInArrow(decode, schema)
