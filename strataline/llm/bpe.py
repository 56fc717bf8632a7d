"""Encoding with a public byte-level BPE vocabulary, exactly and in linear time.

The encoder never merges pairs one after the other. An Aho-Corasick automaton finds the longest
vocabulary entry at each position of a piece; entries are tried from the longest to shorter
prefixes and taken when they are *compatible* with the entry before, that is when merging would
not cross the border between them. If nothing fits at a position, the position is dead and the
search steps back. A sequence of entries whose neighbours are all compatible is what the merge
rules give, and each position is given up at most once.

Compatibility of two entries follows from the merge rules alone and is kept in a table as it is
found. Decoding joins slices of one byte string by an offset table.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "byte_bpe_50k.json"
#: Pieces whose ids a worker remembers before it starts anew; bounds memory, never results.
REMEMBERED = 200_000
# How byte-level BPE cuts a text into pieces.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_path(name: str = VOCABULARY, folder: str | None = None) -> str:
    """Where a public tokenizer's file lies: in ``folder``, else with the installed package."""
    if folder is None:
        try:
            import public_tokenizers

            return public_tokenizers.path(name)
        except ImportError:
            folder = "/opt/tokenizers"
    return os.path.join(folder, name)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in vocabulary files: printable ones for themselves, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes and decodes with one vocabulary, given as the bytes of its JSON file."""

    def __init__(self, content: bytes):
        import ahocorasick
        import regex

        model = json.loads(content)["model"]
        letters = _byte_letters()
        self.ids = {bytes(letters[c] for c in text): i for text, i in model["vocab"].items() if all(c in letters for c in text)}
        size = max(self.ids.values()) + 1
        entries: list[bytes] = [b""] * size
        for entry, i in self.ids.items():
            entries[i] = entry
        self.offsets = array("I", [0])
        for entry in entries:
            self.offsets.append(self.offsets[-1] + len(entry))
        self.bytes = b"".join(entries)
        self.length = [len(entry) for entry in entries]
        # Merge rules: order of each rule, and the two halves of each entry (itself for single bytes).
        self.order: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(size)]
        made: list[int] = [-1] * size
        of_letters = {text: i for text, i in model["vocab"].items()}
        for at, rule in enumerate(model["merges"]):
            left, right = rule.split(" ") if isinstance(rule, str) else rule
            a, b, whole = of_letters[left], of_letters[right], of_letters[left + right]
            self.order.setdefault((a, b), at)
            if made[whole] < 0:
                made[whole], self.halves[whole] = at, (a, b)
        self.made = made
        self.shorter: list[int] = [-1] * size
        for entry, i in self.ids.items():
            for n in range(len(entry) - 1, 0, -1):
                if (j := self.ids.get(entry[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.automaton = ahocorasick.Automaton()
        for entry, i in self.ids.items():
            if len(entry) > 1:
                self.automaton.add_word(entry.decode("latin-1"), (len(entry), i))
        self.automaton.make_automaton()
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, list[int]] = {}
        self.pieces = regex.compile(PIECES).findall

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both entries leaves the border between them."""
        key = (left, right)
        if (answer := self.compatible.get(key)) is None:
            answer = self.compatible[key] = self._border_holds(left, right)
        return answer

    def _border_holds(self, left: int, right: int) -> bool:
        # Undo the younger of the two entries step by step. At each step the two parts that touch
        # the border would have been merged if their rule came before the one that is undone.
        until = len(self.order) + 1
        made, halves, order = self.made, self.halves, self.order
        while True:
            rule = order.get((left, right))
            if rule is not None and rule < until:
                return False
            if made[left] < 0 and made[right] < 0:
                return True
            if made[left] > made[right]:
                # The rule of the left part came last: a crossing rule of the same age would have
                # been applied after it, as merging goes from left to right.
                until, left = made[left], halves[left][1]
            else:
                until, right = made[right] + 1, halves[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ids.get(piece)
        n = len(piece)
        if n == 1:
            return [whole]
        longest = [self.single[b] for b in piece]
        reach = [1] * n
        for end, (size, i) in self.automaton.iter(piece.decode("latin-1")):
            start = end - size + 1
            if size > reach[start]:
                reach[start], longest[start] = size, i
        length, shorter, fits = self.length, self.shorter, self.fits
        out: list[int] = []
        dead = bytearray(n + 1)
        at, entry = 0, longest[0]
        while at < n:
            before = out[-1] if out else -1
            while entry >= 0 and (dead[at + length[entry]] or (before >= 0 and not fits(before, entry))):
                entry = shorter[entry]
            if entry >= 0:
                out.append(entry)
                at += length[entry]
                entry = longest[at] if at < n else -1
            else:
                # Nothing continues from here: give the position up and shorten the entry before.
                dead[at] = 1
                entry = out.pop()
                at -= length[entry]
        return out

    def encode(self, text: str | None) -> list[int]:
        """The ids of ``text``, without special tokens; null and empty texts have no ids."""
        if not text:
            return []
        known = self.known
        out: list[int] = []
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                ids = self.encode_piece(piece.encode())
                if len(piece) <= 64:
                    known[piece] = ids
            out += ids
        if len(self.compatible) > 4 * REMEMBERED:
            self.compatible.clear()
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; the round trip of any text is exact."""
        return b"".join([self.bytes[self.offsets[i] : self.offsets[i + 1]] for i in ids]).decode("utf-8", errors="replace")


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(content: bytes) -> Encoder:
    """One encoder per vocabulary and worker process."""
    key = hash(content)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(content)
    return _ENCODERS[key]


def _content(path: str | None) -> bytes:
    with open(path or tokenizer_path(), "rb") as f:
        return f.read()


def encoded(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (array of int) of every row.

    A null or empty text has an empty list; whole texts are encoded, however long. The vocabulary
    (about 1 MB) is sent to the workers with a broadcast.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(_content(path))
    source = df.select(f"`{key}`", f"`{text}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(vocabulary.value).encode
        for batch in batches:
            flat, ends = array("i"), array("i", [0])
            for value in batch.column(1):
                flat.extend(encode(value.as_py()))
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(memoryview(ends), pa.int32()), pa.array(memoryview(flat), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["k", "ids"])

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def token_counts(df: DataFrame, key: str, text: str, head: str | None = None, path: str | None = None) -> DataFrame:
    """``key``, ``n_tokens`` and ``n_head`` of every row: tokens of ``text`` and of its prefix ``head``.

    ``head`` is a column with the part of the text that bears no loss; null counts as none.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(_content(path))
    source = df.select(f"`{key}`", f"`{text}`", *([f"`{head}`"] if head else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(vocabulary.value).encode
        for batch in batches:
            n = [len(encode(v.as_py())) for v in batch.column(1)]
            h = [min(a, len(encode(v.as_py()))) for a, v in zip(n, batch.column(2))] if head else [0] * len(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(h, pa.int32())], names=["k", "n_tokens", "n_head"])

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"k {kind}, n_tokens int, n_head int").withColumnRenamed("k", key)
