"""BPE encoding and decoding as streaming transducers.

Encoding.  Merges apply in the order of the merge list, so what lies to the
right of a position can change the tokens left of it only through a chain of
merges of rising rank, each reaching further left.  ``MergeList.lookahead``
computes, over the whole merge list, the largest number of symbols such a chain
can span.  The encoder therefore keeps a window: tokens that end at least that
many symbols before the window's end are stable and are emitted at once,
whatever follows, and memory stays constant however long a piece is.  A piece
of text that fits the window is one step of it, and its tokens are remembered
in a cache of bounded size.

Decoding is a state machine from ids over bytes to text that holds back the
bytes of an unfinished UTF-8 character.

The tokenizer file is a parameter (JSON of the ``tokenizers`` library: NFC,
lower case, words split by the file's pattern, byte-level alphabet, BPE with a
word-end suffix).  Unicode data are Python's: code points that a newer Unicode
version than the library's has added may be split or lower-cased differently.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometer.llm.common import arrow_map

CACHE_WORDS = 120_000
#: The usual word pattern, and its equal for the faster standard matcher on text
#: without the characters of ``_odd``.
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
USUAL_FAST = r"[^\W\d_]+|\d|'(?:s|t|re|ve|m|ll|d)|(?:[^\w\s]|_)+"
#: Text is taken in stretches of about so many characters, cut at white space.
STRETCH = 1 << 18


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(plain)))
    return out


def _odd() -> frozenset[str]:
    """Characters that the standard matcher classes differently: numbers that
    are not decimal digits, and separators that are not white space."""
    numbers = (c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl"))
    return frozenset(["\x1c", "\x1d", "\x1e", "\x1f", *numbers])


class MergeList:
    """Merges by rank over integer symbols."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.base = len(vocab)
        #: left * base + right: rank and product.
        self.rank: dict[int, int] = {}
        self.product: list[int] = []
        self.rules: list[tuple[int, int, int]] = []
        for left, right in pairs:
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.rank[a * self.base + b] = len(self.rules)
            self.product.append(c)
            self.rules.append((a, b, c))
        #: Symbols (bytes) of each token.
        self.width: dict[int, int] = {}
        for a, b, c in self.rules:
            self.width[c] = self.width.get(a, 1) + self.width.get(b, 1)
        self.longest = max(self.width.values(), default=1)
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int | None:
        """Symbols beyond a token's end that settle it; None if the merge list
        isn't ordered (a merge before one that makes its parts, or one product
        of two merges), where no bound is claimed.

        Let reach(r) bound how far right of its start the reason can lie why a
        merge r = (u, v) happens or not, if it isn't settled by what is known.
        Either r itself overlaps the unknown, at most |u| + |v| symbols on, or
        an earlier unsettled merge begins where v begins.  That one merged some
        prefix token s of v (v, its left part, the left part of that, ...), so
        reach(r) = |u| + max(|v|, reach(r') of earlier r' = (s, ...)).
        """
        made_at: dict[int, int] = {}
        for i, (_, _, c) in enumerate(self.rules):
            if c in made_at:
                return None
            made_at[c] = i
        furthest: dict[int, int] = {}
        most = 1
        for i, (a, b, _) in enumerate(self.rules):
            if made_at.get(a, -1) >= i or made_at.get(b, -1) >= i:
                return None
            reach, s = self.width.get(b, 1), b
            while True:
                reach = max(reach, furthest.get(s, 0))
                if s not in made_at:
                    break
                s = self.rules[made_at[s]][0]
            reach += self.width.get(a, 1)
            furthest[a] = max(furthest.get(a, 0), reach)
            most = max(most, reach)
        return most

    def merge(self, symbols: list[int]) -> list[int]:
        """All merges, lowest rank first, leftmost first among equal ranks."""
        rank, base, product = self.rank.get, self.base, self.product
        none = len(product)
        ranks = [rank(a * base + b, none) for a, b in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            symbols[i : i + 2] = [new := product[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(symbols[i - 1] * base + new, none)
            if i < len(ranks):
                ranks[i] = rank(new * base + symbols[i + 1], none)
        return symbols

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """The tokens of a symbol stream, each as soon as it is stable."""
        full = None if self.lookahead is None else 2 * self.lookahead + 2 * self.longest
        window: list[int] = []
        for s in symbols:
            window.append(s)
            if full is not None and len(window) >= full:
                stable, taken = len(window) - self.lookahead, 0
                for token in self.merge(window[:]):
                    if taken + self.width.get(token, 1) > stable:
                        break
                    taken += self.width.get(token, 1)
                    yield token
                window = window[taken:]
        yield from self.merge(window)


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges = MergeList(vocab, model["merges"])
        letters = byte_alphabet()
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.final = [vocab[letters[b] + self.suffix] for b in range(256)]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = added
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        splits = [s["pattern"]["Regex"] for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split"]
        # In the file's pattern language, \s is Unicode's White_Space.
        self.words = regex.compile(splits[0].replace(r"\s", r"\p{White_Space}"))
        self.fast = re.compile(USUAL_FAST) if splits[0] == USUAL else None
        self.odd = _odd()
        self.tokens = {i: t for t, i in (vocab | added).items()}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _symbols(self, word: str) -> Iterable[int]:
        """A list for a word that is one window, else a stream."""
        if len(word) <= 64:
            raw = word.encode()
            return [*map(self.inner.__getitem__, raw[:-1]), self.final[raw[-1]]]
        return self._long_symbols(word)

    def _long_symbols(self, word: str) -> Iterator[int]:
        held = None
        for at in range(0, len(word), 1 << 12):
            for b in word[at : at + (1 << 12)].encode():
                if held is not None:
                    yield self.inner[held]
                held = b
        if held is not None:
            yield self.final[held]

    def word(self, word: str) -> bytes:
        """The ids of one word as little-endian 32-bit integers."""
        found = self.old.get(word)
        if found is None:
            symbols = self._symbols(word)
            tokens = self.merges.merge(symbols) if isinstance(symbols, list) else self.merges.stream(symbols)
            found = array("i", tokens).tobytes()
        if len(word) <= 64:
            if len(self.young) >= CACHE_WORDS:
                # The dictionary itself stays, as the encoder holds it.
                self.old = dict(self.young)
                self.young.clear()
            self.young[word] = found
        return found

    def _stretches(self, text: str) -> Iterator[str]:
        """Cut at ASCII white space, over which no word, composed character or
        special token reaches."""
        start = 0
        while len(text) - start > STRETCH:
            cut = regex.compile(r"[ \t-\r]").search(text, start + STRETCH)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, text: str | None) -> Iterator[bytes]:
        """The ids of a text, in pieces; null is empty."""
        for stretch in self._stretches(text or ""):
            for i, part in enumerate(self.special.split(stretch) if self.special else [stretch]):
                if i % 2:
                    yield np.array([self.added[part]], "<i4").tobytes()
                    continue
                # Sigma: letter by letter, without a form for the word's end.
                low = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                words = self.fast if self.fast and self.odd.isdisjoint(low) else self.words
                known, word = self.young.get, self.word
                yield b"".join([known(w) or word(w) for w in words.findall(low)])

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(self.encode(text)), "<i4")

    def decode(self, ids: Iterable[int], spaced: bool = True) -> Iterator[str]:
        """Text of a stream of ids, as far as its characters are complete.
        ``spaced``: the tokens' own strings with a space between them, as the
        library gives for a file without a decoder.  Otherwise the original
        bytes: the alphabet undone, the word-end suffix a space."""
        if spaced:
            piece = {i: t.encode() for i, t in self.tokens.items()}
        else:
            back = {c: bytes([b]) for b, c in byte_alphabet().items()}
            piece = {}
            for i, t in self.tokens.items():
                if t in self.added:
                    piece[i] = t.encode()
                    continue
                end = self.suffix and t.endswith(self.suffix)
                body = t[: len(t) - len(self.suffix)] if end else t
                piece[i] = b"".join(back[c] for c in body) + (b" " if end else b"")
        state = codecs.getincrementaldecoder("utf-8")("replace")
        between = b" " if spaced else b""
        first, held = True, []
        for i in ids:
            held.append(piece[i])
            if len(held) == 1 << 14:
                yield state.decode((b"" if first else between) + between.join(held))
                first, held = False, []
        yield state.decode((b"" if first or not held else between) + between.join(held), final=True)

    def decode_all(self, ids: np.ndarray) -> str:
        """``decode`` of many ids with the table kept; equal to joining it."""
        if not hasattr(self, "_pieces"):
            self._pieces = {i: t.encode() for i, t in self.tokens.items()}
        state, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        for at in range(0, len(ids), 1 << 16):
            part = b" ".join(map(self._pieces.__getitem__, ids[at : at + (1 << 16)].tolist()))
            out.append(state.decode(b" " + part if at else part))
        return "".join([*out, state.decode(b"", final=True)])


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, read once in each worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, ids (array of int)
    and decoded (the text that the ids stand for).  Null and empty texts have no
    ids and decode to the empty string.  ``path`` names the tokenizer file on
    every machine.  An empty table gives no rows; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        ids = [c.ids(t) for t in batch.column(1).to_pylist()]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, "<i4")]).astype(np.int32)))
        decoded = pa.array([c.decode_all(x) for x in ids], pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), lists, decoded], ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return arrow_map(rows, run, f"doc_id {kind}, ids array<int>, decoded string", "text")


def token_digests(encoded: DataFrame, *more: str) -> DataFrame:
    """n_tokens, and SHA-256 of the ids in decimal and of the decoded text;
    ``more`` names further columns to return."""
    return encoded.select(
        "doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
