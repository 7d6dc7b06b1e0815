"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

Texts are cut into pieces as whole arrays: each code point gets a class (letter, number, space,
other), and where a piece starts follows from the classes of neighbours. Equal pieces of a chunk
are encoded once, and a bounded store keeps pieces already seen. New pieces are merged together:
the symbols of all of them lie in one flat array; in each round the ranks of all neighbouring pairs
are found by binary search over the sorted pair keys, and every piece merges the occurrences of its
own lowest-ranked pair. Pieces without a known pair leave the round.

Defined cases: null and empty texts have no tokens and decode to the empty text; a special token's
string in a text becomes its one id; texts of any length are encoded whole; repeated rows are
encoded one by one; an empty table gives an empty result. Columns that are passed on may have any
name but ``token_ids`` and ``decoded``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import ready
from .textarrays import chunks, ragged, span_hashes

#: Bytes of text encoded at once (temporaries are some 60 times that), and pieces kept between chunks (about 10 MB).
CHUNK = 1 << 18
KEPT_PIECES = 1 << 18
LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
_NONE = np.iinfo(np.int32).max


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(shown))
    return [table[b] for b in range(256)]


class Vocabulary:
    """Tables of a byte-level BPE file of the tokenizers library, given as its JSON text."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normaliser and prefix space is needed")
        ids = model["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        names = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        spelled = [names.get(i, b"") for i in range(max(names) + 1)]
        self.byte_ids = np.array([ids[c] for c in byte_alphabet()], np.int64)
        self.lengths = np.array([len(t) for t in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.size = len(spelled)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        self.pair_ids = np.array([ids[a + b] for a, b in pairs], np.int64)  # by rank

    def merge(self, symbols: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over the byte symbols of many words: all ids in word order, ids per word."""
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            rank = np.full(len(symbols), _NONE, np.int32)
            inner = np.flatnonzero(word[1:] == word[:-1])
            if len(inner):
                key = symbols[inner] * self.size + symbols[inner + 1]
                at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
                rank[inner] = np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE)
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(symbols)]))
            done = lowest == _NONE
            if done.any():
                ended.append((word[done], symbols[done]))
            pick = (rank == lowest) & ~done
            # Of overlapping occurrences (a a a), every second one merges.
            places = np.flatnonzero(pick)
            run = np.cumsum(np.r_[True, np.diff(places) != 1]) if len(places) else places
            begins = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(places) else places
            odd = (np.arange(len(places)) - np.repeat(begins, np.diff(np.r_[begins, len(places)]))) % 2 == 1
            places = places[~odd]
            symbols = symbols.copy()
            symbols[places] = self.pair_ids[rank[places]]
            keep = ~done
            keep[places + 1] = False
            symbols, word = symbols[keep], word[keep]
        if not ended:
            return np.zeros(0, np.int64), np.zeros(n_words, np.int64)
        words, ids = (np.concatenate(x) for x in zip(*ended, strict=True))
        return ids[np.argsort(words, kind="stable")], np.bincount(words, minlength=n_words)

    def encode_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = ends - starts
        return self.merge(self.byte_ids[data[ragged(starts, lengths)]], np.repeat(np.arange(len(starts)), lengths), len(starts))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that the ids spell, and the rows' offsets into them."""
        lengths = self.lengths[ids]
        ends = np.r_[0, np.cumsum(lengths)]
        return self.spelling[ragged(self.starts[ids], lengths)], ends[offsets]


class Classes:
    """The class of each code point, asked of the installed library once, so its Unicode version decides."""

    def __init__(self) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        self.split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.table = np.zeros(0x110000, np.uint8)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        out = self.table[points]
        if len(out) and not out.all():
            for p in np.unique(points[out == 0]):
                c = chr(int(p))
                self.table[p] = next((k for k, with_ in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.split(with_ + c)) == 1), SPACE)
            out = self.table[points]
        return out


def piece_starts(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray, classes: Classes) -> np.ndarray:
    """Where pieces start. ``offsets`` cut the bytes into segments; those marked ``whole`` are one piece."""
    if not len(data):
        return np.zeros(0, np.int64)
    if data.max() < 128:
        points, at, cuts = data, None, offsets
    else:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        cuts = np.searchsorted(at, offsets)
    n = len(points)
    kind = classes(points)
    border = np.zeros(n + 4, bool)
    border[cuts] = True
    border[n:] = True
    before = np.r_[np.uint8(0), kind[:-1]]
    before[border[:n]] = 0
    blank_before = np.r_[False, points[:-1] == 0x20] & ~border[:n]
    space = kind == SPACE
    text_next = np.r_[~space[1:], False] & ~border[1 : n + 1]
    # A single blank joins what follows; of longer space the last character stands alone or joins.
    start = border[:n] | (~space & (kind != before) & ~blank_before) | (space & ((before != SPACE) | text_next))
    quote = np.flatnonzero((points == 0x27) & start)
    if len(quote):
        padded = np.r_[points, np.zeros(3, points.dtype)]
        one, two = padded[quote + 1], padded[quote + 2]
        in_1 = ~border[quote + 1]
        in_2 = in_1 & ~border[quote + 2]
        short = in_1 & np.isin(one, [ord(c) for c in "stmd"])
        long = in_2 & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        ahead = np.r_[start, np.zeros(4, bool)]
        for hit, size in ((quote[short], 2), (quote[long], 3)):
            for j in range(1, size):
                ahead[hit + j] = False
            ahead[hit + size] = True
        start = ahead[:n]
    for s, e in zip(cuts[:-1][whole], cuts[1:][whole], strict=True):
        start[s + 1 : e] = False
    places = np.flatnonzero(start)
    return places if at is None else at[places]


class Encoder:
    """Encodes chunks of rows; keeps a bounded store of pieces."""

    def __init__(self, vocabulary: Vocabulary, encode_new: Callable | None = None) -> None:
        self.vocabulary, self.classes = vocabulary, Classes()
        self.encode_new = encode_new or vocabulary.encode_pieces
        self.clear()

    def clear(self) -> None:
        self.known, self.lengths, self.places, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        at = np.searchsorted(self.known, hashes)
        self.places = np.insert(self.places, at, len(self.ids) + np.cumsum(lengths) - lengths)
        self.known, self.lengths = np.insert(self.known, at, hashes), np.insert(self.lengths, at, lengths)
        self.ids = np.r_[self.ids, ids.astype(np.uint32)]

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """Row offsets cut further around special tokens, which segments are special, and those tokens' bytes."""
        raw, found = data.tobytes(), []
        for token in self.vocabulary.special:
            p = raw.find(token)
            while p >= 0:
                inside = p + len(token) <= offsets[np.searchsorted(offsets, p, side="right")]
                if inside:
                    found.append((p, p + len(token)))
                p = raw.find(token, p + (len(token) if inside else 1))
        cuts = np.unique(np.r_[offsets, np.array(found, np.int64).ravel()]) if found else np.unique(offsets)
        whole = np.isin(cuts[:-1], [s for s, _ in found])
        return cuts, whole, found

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows (uint32) and the rows' offsets into them."""
        cuts, whole, found = self.segments(data, offsets)
        starts = piece_starts(data, cuts, whole, self.classes)
        ends = np.r_[starts[1:], len(data)] if len(starts) else starts
        pieces, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > KEPT_PIECES:
            self.clear()
        at = np.searchsorted(self.known, pieces)
        new = np.ones(len(pieces), bool)
        seen = at < len(self.known)
        new[seen] = self.known[at[seen]] != pieces[seen]
        if new.any():
            s, e = starts[first[new]], ends[first[new]]
            ids, lengths = self.encode_new(data, s, e)
            if found:  # a special token is one piece with its own id
                ids, lengths = self.with_special(data, s, e, ids, lengths)
            self.learn(pieces[new], ids, lengths)
        at = np.searchsorted(self.known, pieces)[back]
        lengths = self.lengths[at]
        counts = np.r_[0, np.cumsum(lengths)]
        return self.ids[ragged(self.places[at], lengths)], counts[np.searchsorted(starts, offsets)]

    def with_special(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        each = np.split(ids, np.cumsum(lengths)[:-1])
        for i in range(len(s)):
            token = self.vocabulary.special.get(data[s[i] : e[i]].tobytes())
            if token is not None:
                each[i] = np.array([token])
        return np.concatenate(each), np.array([len(x) for x in each])


def binary_rows(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of numbers as little-endian bytes."""
    places = (offsets * flat.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(flat))])


def text_rows(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes as text; bytes that are no UTF-8 become the replacement character."""
    raw = data.tobytes()
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return pa.array([raw[s:e].decode("utf-8", "replace") for s, e in zip(offsets[:-1], offsets[1:], strict=True)], pa.large_string())
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, text_col: str, names: list[str], decode: bool) -> Iterator[pa.RecordBatch]:
    """The batches' rows with their ids and, if asked, the ids' text, a chunk at a time."""
    encoder = Encoder(vocabulary)
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_col))
        for lo, hi, data, offsets in chunks(column, CHUNK):
            ids, places = encoder(data, offsets)
            out = [*batch.slice(lo, hi - lo).columns, binary_rows(ids, places).cast(pa.binary())]
            if decode:
                out.append(text_rows(*vocabulary.decode(ids, places)).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=names)
        pa.default_memory_pool().release_unused()  # else a worker keeps it


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", decode: bool = False) -> DataFrame:
    """Adds token_ids (binary, little-endian uint32) for the text and, if asked, decoded: the ids' text.

    ``tokenizer`` is the path of the vocabulary file on the driver; the file's text (its size is that
    of the vocabulary) goes to the tasks as a broadcast variable.
    """
    spark = ready(docs.sparkSession)
    spec = spark.sparkContext.broadcast(read_text(tokenizer))
    shape = T.StructType([*docs.schema.fields, T.StructField("token_ids", T.BinaryType()), *([T.StructField("decoded", T.StringType())] if decode else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(batches, Vocabulary(spec.value), text_col, shape.names, decode)

    return docs.mapInArrow(run, shape)
