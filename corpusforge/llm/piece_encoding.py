"""SentencePiece encoding and decoding with byte spans in the original text.

A text is normalised by the longest prefixes that the model's compiled character
map knows, and every normalised byte keeps the offset of the original byte it
comes from. The normalised text is merged into pieces; a piece's span in the
original is what its first and last byte point to. A character no piece covers
becomes one piece a byte.

A text of words with single spaces between them is taken word by word: no piece
of the vocabulary goes on past the start of a word, so a word's pieces never
depend on its neighbours and can be kept. Anything else is merged as a whole.
"""

from __future__ import annotations

import heapq
import struct
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from corpusforge.llm.common import parts, require

SPACE = "▁"
#: Words whose ids a worker keeps in each of two generations: when the younger
#: is full, it becomes the older one, and words that are used move up again.
KEPT = 300_000
NONE = 1 << 60
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field number and value of each field of a serialized message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        elif kind == 5:
            value, at = struct.unpack_from("<f", data, at)[0], at + 4
        else:
            value, at = data[at:at + 8], at + 8
        yield key >> 3, value


class CharacterMap:
    """A compiled character map: a double-array trie and the texts it leads to."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.texts = compiled[4 + size:]
        #: Bytes that can start a key; others need no walk through the trie.
        self.starts = {b for b in range(256) if self.units and self._step(self._child(0), b) is not None}

    def _child(self, node: int) -> int:
        unit = self.units[node]
        return node ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    def _step(self, base: int, byte: int) -> int | None:
        at = base ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that starts at `at`, and its replacement."""
        if not self.units or data[at] not in self.starts:
            return None
        best, base = None, self._child(0)
        for end in range(at, len(data)):
            node = self._step(base, data[end])
            if node is None:
                break
            base = self._child(node)
            if self.units[node] >> 8 & 1:
                start = self.units[base] & 0x7FFFFFFF
                best = end + 1 - at, self.texts[start:self.texts.index(0, start)]
        return best


def _width(byte: int) -> int:
    return 1 if byte < 0xC0 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4


class PieceModel:
    """A byte-pair model of the SentencePiece library, read from its file."""

    def __init__(self, data: bytes):
        self.pieces, self.kinds, merges, compiled = [], [], {}, b""
        trainer: dict[int, object] = {}
        self.dummy_prefix, self.trim, self.escape = True, True, True
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.kinds.append(piece.get(3, NORMAL))
                if self.kinds[-1] == NORMAL:
                    merges[self.pieces[-1]] = (-piece[2], len(self.pieces) - 1)
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                spec = dict(_fields(value))
                compiled = spec.get(2, b"")
                self.dummy_prefix, self.trim, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        self.map = CharacterMap(compiled)
        if trainer.get(3, 1) != 2 or not self.escape or trainer.get(24, 0) or set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only byte-pair models with escaped spaces, a leading space mark and plain pieces")
        if self.kinds.count(BYTE) != 256:
            raise ValueError("only models that spell unknown characters in bytes")
        self.rank, self.id = {p: r for p, (r, _) in merges.items()}, {p: i for p, (_, i) in merges.items()}
        self.by_kind = {k: [i for i, x in enumerate(self.kinds) if x == k] for k in (UNKNOWN, CONTROL, BYTE)}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in self.by_kind[BYTE]}
        named = {p: i for i, p in enumerate(self.pieces)}
        self.begin, self.end = named.get("<s>"), named.get("</s>")
        #: No piece has a space mark after another character: words can be taken one by one.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.plain = not compiled and self.dummy_prefix and not self.trim and self.by_word
        self.bytes_of = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else
                         " ⁇ ".encode() if k == UNKNOWN else p.replace(SPACE, " ").encode()
                         for p, k in zip(self.pieces, self.kinds, strict=True)]
        #: Bytes of normalised text that each id covers.
        self.widths = np.array([1 if k == BYTE else len(p.encode()) for p, k in zip(self.pieces, self.kinds, strict=True)])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # Normalising

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the
        offset of the original byte."""
        data = text.encode("utf-8", "surrogatepass")
        if not self.map.units and not self.trim:
            wide = np.where(np.frombuffer(data, np.uint8) == 32, 3, 1)
            lead = [0, 0, 0] if self.dummy_prefix and data else []
            align = np.concatenate([lead, np.repeat(np.arange(len(data)), wide), [len(data)]]).astype(np.int64)
            return (SPACE if lead else "") + text.replace(" ", SPACE), align
        out, align, at = [], [], 0
        while at < len(data):
            size, new = self.map.longest(data, at) or (_width(data[at]), data[at:at + _width(data[at])])
            for part in [new[i:i + 1] for i in range(len(new))]:
                out.append(part)
                align.append(at)
            at += size
        align.append(len(data))
        flat = b"".join(out)
        keep = np.ones(len(flat), bool)
        if self.trim:  # no space at either end, and none after another
            space = np.frombuffer(flat, np.uint8) == 32
            keep = ~space | (np.append(False, ~space[:-1]) if flat else space)
            last = len(flat)
            while last and space[last - 1]:
                last -= 1
            align = align[:last] + [align[last]] if last < len(flat) else align
            flat, keep = flat[:last], keep[:last]
        kept, lead = np.flatnonzero(keep), []
        values = np.frombuffer(flat, np.uint8)[kept]
        if self.dummy_prefix and values.size:
            lead = [align[kept[0]]] * 3
        wide = np.where(values == 32, 3, 1)
        where = np.concatenate([lead, np.repeat(np.asarray(align)[kept], wide), [align[len(flat)]]]).astype(np.int64)
        return (SPACE if lead else "") + values.tobytes().decode("utf-8", "surrogatepass").replace(" ", SPACE), where

    # Merging

    def merge(self, text: str) -> list[str]:
        """The pair of neighbours with the best score is joined, the leftmost
        first, until no neighbours make a piece."""
        rank, parts = self.rank, list(text)
        if len(parts) > 48:
            return self._merge_long(parts)
        get, pairs = rank.get, [NONE]  # the last part has no pair
        pairs[:0] = [get(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while (best := min(pairs)) < NONE:
            i = pairs.index(best)
            parts[i] += parts[i + 1]
            del parts[i + 1], pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], NONE)
            if i < len(parts) - 1:
                pairs[i] = get(parts[i] + parts[i + 1], NONE)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        rank, n = self.rank, len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := rank.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if j < 0 or not parts[i] or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j], after[i] = joined, "", after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := rank.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a, parts[a] + parts[b]))
        return [p for p in parts if p]

    def _ids(self, text: str) -> bytes:
        """Ids of a normalised text."""
        parts = self.merge(text)
        try:
            return array("I", [self.id[p] for p in parts]).tobytes()
        except KeyError:  # characters that no piece covers
            spelt = ([self.id[p]] if p in self.id else [self.byte_ids[b] for b in p.encode("utf-8", "surrogatepass")]
                     for p in parts)
            return array("I", [i for ids in spelt for i in ids]).tobytes()

    def _word(self, word: str) -> bytes:
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {}
        ids = self.young[word] = self.old.get(word) or self._ids(SPACE + word)
        return ids

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Ids and spans of a whole text (NULL counts as empty), with begin and
        end ids: unsigned 32-bit ids, and start and end of each id's bytes in
        the original as unsigned 32-bit pairs; little-endian."""
        text = text or ""
        if self.plain and text and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            word = self._word
            ids = b"".join([self.young.get(w) or word(w) for w in text.split(" ")])
            align = self.normalise(text)[1]
        else:
            normal, align = self.normalise(text)
            ids = self._ids(normal)
        ends = np.cumsum(self.widths[np.frombuffer(ids, np.uint32)], dtype=np.int64)
        spans = np.zeros((ends.size + 2, 2), np.uint32)
        spans[1:-1, 0], spans[1:-1, 1] = align[np.append(0, ends[:-1])] if ends.size else [], align[ends]
        spans[-1] = align[-1] if len(align) else 0
        if self.end is None:
            spans = spans[:-1]
        if self.begin is None:
            spans = spans[1:]
        edge = lambda i: b"" if i is None else struct.pack("<I", i)
        return edge(self.begin) + ids + edge(self.end), spans.tobytes()

    def decode(self, ids: bytes) -> str:
        """The text of ids: control ids say nothing, a first space mark that the
        encoder put there goes, bytes that form no character become U+FFFD."""
        table = self.bytes_of
        numbers = np.frombuffer(ids, np.uint32)
        kinds = self._kind_array()[numbers]
        first = numbers[kinds != CONTROL][:1]
        data = b"".join([table[i] for i in numbers.tolist()])
        if first.size and self.pieces[first[0]].startswith(SPACE) and self.kinds[first[0]] == NORMAL:
            data = data.lstrip(b" ") if self.trim else data[1:] if self.dummy_prefix else data
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return _lenient(data)

    @cache  # noqa: B019 - a model lives as long as its worker
    def _kind_array(self) -> np.ndarray:
        return np.array(self.kinds, np.uint8)


def _lenient(data: bytes) -> str:
    """Each byte that starts no character becomes U+FFFD by itself."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at:at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@cache
def load(path: str) -> PieceModel:
    """The model of a file every node has; read once a worker."""
    with open(path, "rb") as file:
        return PieceModel(file.read())


def encode(docs: DataFrame, model: str, text: str = "text") -> Column:
    """Column of struct(ids binary, spans binary) for a text column; see
    `PieceModel.encode`. `model` is a path to a model file on every node."""
    require(docs, [text])

    @pandas_udf("ids binary, spans binary")
    def encoded(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = load(model)
        for batch in parts(texts):
            yield pd.DataFrame([own.encode(t) for t in batch], columns=["ids", "spans"])

    return encoded(F.col(text))


def decode(ids: Column, model: str) -> Column:
    """Text column for a column of ids as `encode` gives them; NULL for NULL."""

    @pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = load(model)
        for batch in parts(batches):
            yield pd.Series([None if b is None else own.decode(b) for b in batch], dtype=object)

    return decoded(ids)
