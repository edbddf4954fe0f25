"""SentencePiece encoding and decoding that keep the place of every piece.

Encoding has three steps, and each hands on where its output came from:

1. Normalisation replaces, from left to right, the longest prefix that the
   model's compiled character map (a double-array trie) knows, and copies a
   character that it doesn't know.  Every byte of the result remembers the byte
   of the source at which its replacement began.
2. Merging joins, again and again, the neighbours whose joint piece has the best
   score (the leftmost of equals).  A merge can't span two characters that stand
   side by side in no piece, so words are merged for themselves and remembered.
3. Projection turns a piece's bytes of normalised text into a span of source
   bytes through the places of step 1.  A character that no piece holds becomes
   byte pieces; the last of them has its span, the others are empty.

Decoding joins the pieces, turns the space symbol into spaces, drops the space
that encoding put in front, and gathers byte pieces into characters; a byte that
belongs to none becomes U+FFFD.

The model file is a parameter.  Models of another kind than BPE, with unused or
user-defined pieces, or with the space symbol behind words are refused.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometer.llm.common import arrow_map

SPACE_SYMBOL = "▁"
CACHE_WORDS = 120_000
#: Longer words are neither remembered nor merged by scanning.
LONG_WORD = 64
#: Normalised text is cut into words in stretches of about so many characters.
STRETCH = 1 << 18

# Fixed values of the model format: kinds of piece, and field numbers.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
MODEL_TYPE, SPACE_AS_SUFFIX, BYTE_FALLBACK, UNK_ID, BOS_ID, EOS_ID, UNK_SURFACE = 3, 24, 35, 40, 41, 42, 44
CHARS_MAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
BPE = 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def message(data: bytes) -> dict[int, list]:
    """The fields of one protocol-buffer message: numbers, or raw bytes."""
    out: dict[int, list] = {}
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        field, kind = key >> 3, key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError(f"unknown wire type {kind}")
            value, at = data[at : at + size], at + size
        out.setdefault(field, []).append(value)
    return out


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes whose values are
    places in a block of zero-ended replacements.  An empty map knows nothing."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = array("I", blob[4 : 4 + size])
        self.texts = blob[4 + size :]
        self.starts: dict[int, bool] = {}

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest known prefix of ``data[at:]`` and
        that prefix's length."""
        units, found, length = self.units, None, 0
        if not units:
            return None
        node = self._child(units[0])
        for i in range(at, len(data)):
            byte = data[i]
            node ^= byte
            if node >= len(units) or units[node] & 0x800000FF != byte:
                break
            unit = units[node]
            node ^= self._child(unit)
            if unit & 0x100:
                found, length = units[node] & 0x7FFFFFFF, i + 1 - at
        if not length:
            return None
        return self.texts[found : self.texts.index(b"\0", found)], length


#: Bytes of a UTF-8 character by its first byte.
WIDTH = bytes([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10)


class Codec:
    """Encoder and decoder of one model file (``path``), or of its bytes."""

    def __init__(self, path: str | bytes):
        if isinstance(path, str):
            with open(path, "rb") as file:
                path = file.read()
        model = message(path)
        trainer, rules = (message(model.get(f, [b""])[0]) for f in (TRAINER, NORMALIZER))

        def option(fields: dict[int, list], field: int, default):
            return fields.get(field, [default])[-1]

        self.map = CharacterMap(option(rules, CHARS_MAP, b""))
        self.dummy = bool(option(rules, DUMMY_PREFIX, 1))
        self.remove_extra = bool(option(rules, REMOVE_EXTRA, 1))
        self.space = SPACE_SYMBOL if option(rules, ESCAPE, 1) else " "
        self.byte_fallback = bool(option(trainer, BYTE_FALLBACK, 0))
        self.unknown = option(trainer, UNK_ID, 0)
        self.bos, self.eos = option(trainer, BOS_ID, 1), option(trainer, EOS_ID, 2)
        self.unknown_text = option(trainer, UNK_SURFACE, " ⁇ ".encode()).decode()
        if model.get(PIECES) and option(trainer, MODEL_TYPE, 1) != BPE:
            raise ValueError("only BPE models")
        if option(trainer, SPACE_AS_SUFFIX, 0):
            raise ValueError("the space symbol behind words isn't supported")
        self._read_pieces(model.get(PIECES, []))
        self._cut()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _read_pieces(self, pieces: list[bytes]) -> None:
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        #: What each id stands for; None: dropped when decoding.
        self.text: list[bytes | None] = []
        self.unknowns: set[int] = set()
        for i, fields in enumerate(map(message, pieces)):
            text = fields[PIECE_TEXT][0].decode()
            kind = fields.get(PIECE_KIND, [NORMAL])[-1]
            if kind in (USER_DEFINED, UNUSED):
                raise ValueError("models with user-defined or unused pieces aren't supported")
            if kind == NORMAL:
                self.ids[text] = i
                self.scores[text] = struct.unpack("<f", fields.get(PIECE_SCORE, [bytes(4)])[-1])[0]
                self.text.append(text.replace(SPACE_SYMBOL, " ").encode())
            elif kind == BYTE:
                byte = int(text[1:-1], 16)
                self.byte_ids[byte] = i
                self.text.append(bytes([byte]))
            elif kind == UNKNOWN:
                self.unknowns.add(i)
                self.text.append(self.unknown_text.encode())
            else:
                self.text.append(None)
        self.is_byte = set(self.byte_ids.values())

    def _cut(self) -> None:
        """The word pattern.  Characters that stand side by side in some piece,
        directly or by way of others, are one class, and no piece spans two
        classes; so a word is a run of one class with the space symbols before
        it.  The classes of the first 256 characters are told apart, all others
        are one; a character that is in no longer piece is a word.  Where a
        piece has a space symbol behind another character, texts aren't cut."""
        longer = [t for t in self.ids if len(t) > 1]
        if any(self.space in t.lstrip(self.space) for t in longer):
            self.words = re.compile(r"(?s).+")
            self.cuts = None
            return
        leader = {c: c for t in longer for c in t}

        def find(c: str) -> str:
            while leader[c] != c:
                leader[c] = c = leader[leader[c]]
            return c

        for t in longer:
            body = t.lstrip(self.space)
            for x, y in zip(body, body[1:]):
                leader[find(x)] = find(y)
        classes: dict[str, list[str]] = {}
        for c in leader:
            if c != self.space:
                classes.setdefault(find(c), []).append(c)

        def chars(cs: Iterable[str]) -> str:
            return "".join(re.escape(c) for c in sorted(cs))

        low = [chr(i) for i in range(256) if chr(i) != self.space]
        near = sorted((m for m in classes.values() if len(m) > 1 and any(c in low for c in m)), key=len, reverse=True)
        alone = chars(c for c in low if c not in leader)
        s = re.escape(self.space)
        runs = [f"[{chars(m)}]+" for m in near] + [f"[^{s}{alone}{chars(c for m in near for c in m)}]+"]
        self.words = re.compile(f"{s}*(?:{'|'.join(runs)})|{s}+" + (f"|[{alone}]" if alone else ""))
        self.cuts = re.compile(f"(?<!{s}){s}")

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its UTF-8 bytes (and its end) the
        byte of ``text`` where it came from."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.remove_extra:
            raw = np.frombuffer(data, np.uint8)
            mark = len(self.space.encode())
            places = np.repeat(np.arange(len(raw)), np.where(raw == 0x20, mark, 1))
            front = mark if self.dummy else 0
            return (
                (self.space if self.dummy else "") + text.replace(" ", self.space),
                np.concatenate([np.zeros(front, np.int64), places, [len(raw)]]),
            )
        return self._by_prefixes(data)

    def _prefixes(self, data: bytes) -> Iterator[tuple[bytes, int, int]]:
        """(replacement, source place, source length), longest prefix first."""
        at, starts = 0, self.map.starts
        while at < len(data):
            width = WIDTH[data[at]]
            char = data[at : at + width]
            found = None
            # Whether anything known begins with this character is remembered.
            if starts.get(char, True):
                found = self.map.longest(data, at)
                if found is None and char not in starts:
                    starts[char] = self._begins(char)
            new, width = found or (char, width)
            yield new, at, width
            at += width

    def _begins(self, char: bytes) -> bool:
        units = self.map.units
        if not units:
            return False
        node = CharacterMap._child(units[0])
        for byte in char:
            node ^= byte
            if node >= len(units) or units[node] & 0x800000FF != byte:
                return False
            node ^= CharacterMap._child(units[node])
        return True

    def _by_prefixes(self, data: bytes) -> tuple[str, np.ndarray]:
        mark = self.space.encode()
        out, places, end = bytearray(), array("q"), 0
        after_space = self.remove_extra
        pending = self.dummy
        leading = self.remove_extra
        for new, at, width in self._prefixes(data):
            if leading and new == b" ":
                end = at + width
                continue
            leading = False
            if pending:
                out += mark
                places.extend([end] * len(mark))
                pending = False
            while after_space and new.startswith(b" "):
                new = new[1:]
            if new:
                shown = new.replace(b" ", mark)
                out += shown
                places.extend([at] * len(shown))
                after_space = self.remove_extra and new.endswith(b" ")
            end = at + width
        if not out:
            return "", np.zeros(1, np.int64)
        if self.remove_extra:
            while out.endswith(mark):
                end = places[len(out) - len(mark)]
                del out[-len(mark) :], places[-len(mark) :]
        places.append(end)
        return out.decode(), np.array(places, np.int64)

    def merge(self, symbols: list[str]) -> list[str]:
        """All merges of one word, best score first, leftmost of equals."""
        score = self.scores.get
        none = float("-inf")
        pairs = [score(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            i = pairs.index(best)
            new = symbols[i] + symbols[i + 1]
            symbols[i : i + 2] = [new]
            del pairs[i]
            if i:
                pairs[i - 1] = score(symbols[i - 1] + new, none)
            if i < len(pairs):
                pairs[i] = score(new + symbols[i + 1], none)
        return symbols

    def merge_long(self, symbols: list[str]) -> list[str]:
        """``merge`` for a word of any length, with a heap of pairs."""
        n = len(symbols)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap: list[tuple[float, int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left] if left >= 0 else -1
            if right >= 0 and (s := self.scores.get(symbols[left] + symbols[right])) is not None:
                heapq.heappush(heap, (-s, left, len(symbols[left]), len(symbols[right])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, a, b = heapq.heappop(heap)
            right = after[left]
            if right < 0 or len(symbols[left]) != a or len(symbols[right]) != b:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            # An empty symbol has length 0, which no offered pair has.
            after[right] = -1
            offer(before[left])
            offer(left)
        return [s for s in symbols if s]

    def word(self, word: str) -> bytes:
        """(id, normalised bytes) of each piece of a word, as pairs of
        little-endian 32-bit integers."""
        found = self.old.get(word)
        if found is None:
            long = len(word) > LONG_WORD
            out: list[int] = []
            for piece in (self.merge_long if long else self.merge)(list(word)):
                raw = piece.encode()
                if (known := self.ids.get(piece)) is not None:
                    out += (known, len(raw))
                elif self.byte_fallback:
                    for byte in raw[:-1]:
                        out += (self.byte_ids[byte], 0)
                    out += (self.byte_ids[raw[-1]], len(raw))
                else:
                    out += (self.unknown, len(raw))
            found = np.array(out, "<i4").tobytes()
            if long:
                return found
        if len(self.young) >= CACHE_WORDS:
            self.old = dict(self.young)
            self.young.clear()
        self.young[word] = found
        return found

    def _stretches(self, text: str) -> Iterator[str]:
        start = 0
        while self.cuts and len(text) - start > STRETCH:
            cut = self.cuts.search(text, start + STRETCH)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, text: str | None, begin: bool = False, end: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, and the first byte and the end of each piece in the UTF-8 bytes
        of ``text`` (null: empty).  ``begin`` and ``end`` add the marks of a
        text's begin and end, with empty spans."""
        text = text or ""
        normal, places = self.normalise(text)
        known, word = self.young.get, self.word
        parts = [b"".join([known(w) or word(w) for w in self.words.findall(part)]) for part in self._stretches(normal)]
        pairs = np.frombuffer(b"".join(parts), "<i4").reshape(-1, 2)
        ids, ends = pairs[:, 0], np.cumsum(pairs[:, 1], dtype=np.int64)
        if not self.byte_fallback and len(ids):
            # Neighbours that are unknown are one piece.
            last = ~((ids == self.unknown) & (np.append(ids[1:], -1) == self.unknown))
            ids, ends = ids[last], ends[last]
            starts = np.concatenate([[0], ends[:-1]])
        else:
            starts = ends - pairs[:, 1]
            # Byte pieces before a character's last one are empty, at its begin.
        firsts, lasts = places[starts], places[ends]
        if begin or end:
            size = len(text.encode())
            front, back = [self.bos] * begin, [self.eos] * end
            ids = np.concatenate([front, ids, back])
            firsts = np.concatenate([[0] * begin, firsts, [size] * end])
            lasts = np.concatenate([[0] * begin, lasts, [size] * end])
        return ids.astype("<u4"), firsts.astype(np.int64), lasts.astype(np.int64)

    def decode(self, ids: Iterable[int]) -> str:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        pieces = [self.text[i] for i in ids]
        marked = None in pieces
        if marked:
            while pieces and pieces[0] is None:
                del ids[0], pieces[0]
            while pieces and pieces[-1] is None:
                del ids[-1], pieces[-1]
            marked = None in pieces
        if self.dummy or self.remove_extra:
            for n, p in enumerate(pieces):
                if p is None:
                    continue
                if ids[n] in self.is_byte or ids[n] in self.unknowns or not p.startswith(b" "):
                    break
                pieces[n] = p[1:]
                if pieces[n] or not self.remove_extra:
                    break
        if not marked:
            try:
                return b"".join(pieces).decode()
            except UnicodeDecodeError:
                pass
        return "".join(self._runs(ids, pieces))

    def _runs(self, ids: list[int], pieces: list[bytes | None]) -> Iterator[str]:
        """Each run of byte pieces for itself: whole characters, and U+FFFD for
        every byte that is in none."""
        held = bytearray()

        def characters() -> Iterator[str]:
            at = 0
            while at < len(held):
                for width in (1, 2, 3, 4):
                    try:
                        yield bytes(held[at : at + width]).decode()
                        at += width
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    yield "�"
                    at += 1
            held.clear()

        for i, p in zip(ids, pieces):
            if i in self.is_byte:
                held += p
                continue
            yield from characters()
            yield (p or b"").decode()
        yield from characters()


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, read once in each worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def encode_documents(docs: DataFrame, path: str, begin: bool = True, end: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, ids (binary:
    little-endian unsigned 32-bit integers), spans (binary: begin and end of
    each piece in the text's UTF-8 bytes, as little-endian 64-bit integers) and
    decoded (the text that the ids stand for).

    A null text is empty; an empty text has no pieces but the begin and end
    marks.  A text of any length is taken whole.  Rows that repeat are encoded
    each; an empty table gives no rows; other columns are ignored.  ``path``
    names the model file on every machine.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        ids, spans, decoded = [], [], []
        for text in batch.column(1).to_pylist():
            found, firsts, lasts = c.encode(text, begin, end)
            ids.append(found.tobytes())
            spans.append(np.stack([firsts, lasts], axis=1).astype("<i8").tobytes())
            decoded.append(c.decode(found))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), _binary(ids), _binary(spans), pa.array(decoded, pa.string())], ["doc_id", "ids", "spans", "decoded"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return arrow_map(rows, run, f"doc_id {kind}, ids binary, spans binary, decoded string", "text", 1 << 20)


def piece_rows(encoded: DataFrame) -> DataFrame:
    """One row per piece of ``encode_documents``: doc_id, place (from 0), id,
    first and last (its span of source bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                ids = np.frombuffer(batch.column(1)[n].as_py(), "<u4").astype(np.int32)
                spans = np.frombuffer(batch.column(2)[n].as_py(), "<i8").reshape(-1, 2)
                owner = batch.column(0).slice(n, 1).take(pa.array(np.zeros(len(ids), np.int64)))
                parts = [owner, *map(pa.array, (np.arange(len(ids)), ids, spans[:, 0].copy(), spans[:, 1].copy()))]
                yield pa.RecordBatch.from_arrays(parts, ["doc_id", "place", "id", "first", "last"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids", "spans").mapInArrow(run, f"doc_id {kind}, place long, id int, first long, last long")


def piece_digests(encoded: DataFrame) -> DataFrame:
    """n_tokens, and SHA-256 of the ids, of the decoded text and of the spans."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.sha2("spans", 256).alias("spans_sha256"),
    )
