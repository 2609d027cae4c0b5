"""Sub-word encoding and decoding with a merge-type piece vocabulary, exact by backtracking."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import mapped

SPACE = "▁"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that may be merged, with their ids and scores, and the ids of the 256 bytes."""

    pieces: dict[str, tuple[int, float]]
    bytes_: tuple[int, ...]
    size: int


def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file: merge type, byte fallback, no normalization but spaces and one space put in front."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = " Aﬁ  b\né "
    if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError(f"{path} normalizes texts in a way that is not supported")
    ids = range(model.vocab_size())
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    if any(model.is_unused(i) for i in plain):
        raise ValueError(f"{path} has unused pieces, which are not supported")
    of_bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
    if len(of_bytes) != 256:
        raise ValueError(f"{path} has no piece for every byte")
    return Vocabulary({model.id_to_piece(i): (i, model.get_score(i)) for i in plain}, tuple(of_bytes[b] for b in range(256)), len(ids))


class Encoder:
    """Encodes texts as merging the best-scored pair of neighbours, leftmost first, again and again would.

    Such an encoding is the only split into pieces of which every piece merges to
    itself and every two neighbours merge to themselves.  So pieces are taken
    longest first from the matches of an Aho-Corasick automaton, each is checked with the one
    before it by merging the two again, and a position from which no piece goes on is marked in a bit
    field and never tried again.  Texts are cut first where no piece reaches over; the units between cuts
    repeat, and their encodings are remembered (at most twice ``remembered`` units, the
    oldest go first, and as many pairs).
    """

    def __init__(self, vocabulary: Vocabulary, remembered: int = 1 << 17):
        self.vocabulary, self.remembered = vocabulary, remembered
        self.score = {p: s for p, (_, s) in vocabulary.pieces.items()}
        whole = {p for p in self.score if len(p) > 1 and self.merge(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p in whole:
            self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        #: The next shorter piece that a piece begins with; a single letter is the last one.
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 1, -1) if p[:n] in whole), p[0]) for p in whole}
        inside = {c for p in self.score if len(p) > 1 for c in p}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside)
        joined = any(SPACE in p.lstrip(SPACE) for p in self.score)  # pieces go on behind a word
        self.id_of = {p: i for p, (i, _) in vocabulary.pieces.items()}
        self.units = re.compile(r"[\s\S]+") if joined else re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        self._pairs: dict[tuple[str, str], bool] = {}
        self._known: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces that are left when no two neighbours make a piece; only for short texts."""
        parts, score, none = list(text), self.score.get, float("-inf")
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether the two pieces stay apart when their letters are merged again."""
        key = (left, right)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= 2 * self.remembered:
                self._pairs.clear()
            known = self._pairs[key] = self.merge(left + right) == [left, right]
        return known

    def split(self, unit: str) -> list[str]:
        """The pieces of a text, single letters without a piece among them."""
        longest, n = list(unit), len(unit)
        for end, (more, piece) in self.automaton.iter(unit):
            longest[end - more] = piece  # a later end is a longer match
        failed, out, before, at = None, [], "", 0
        piece, pairs = longest[0] if unit else "", self._pairs
        while at < n:
            end = at + len(piece)
            if not (failed and failed[end >> 3] >> (end & 7) & 1):
                fit = pairs.get((before, piece)) if before else True
                if fit or (fit is None and self.fits(before, piece)):
                    out.append(piece)
                    at, before = end, piece
                    piece = longest[end] if end < n else ""
                    continue
            while len(piece) == 1:  # no piece goes on from here: step back
                failed = failed or bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
            before = out[-1] if out else ""
            piece = self.shorter[piece]
        return out

    def unit_ids(self, unit: str) -> tuple[int, ...]:
        known = self._known.get(unit) or self._older.get(unit)
        if known is None:
            parts = self.split(unit)
            try:
                known = tuple([self.id_of[p] for p in parts])
            except KeyError:  # letters without a piece are written as their bytes
                known = tuple(i for p in parts for i in ((self.id_of[p],) if p in self.id_of else [self.vocabulary.bytes_[b] for b in p.encode()]))
        if len(unit) <= 64:
            if len(self._known) >= self.remembered:
                self._older, self._known = self._known, {}
            self._known[unit] = known
        return known

    def encode(self, text: str) -> list[int]:
        """The ids of a text, without begin and end."""
        if not text:
            return []
        out: list[int] = []
        for unit in self.units.findall(SPACE + text.replace(" ", SPACE)):
            out += self._known.get(unit) or self.unit_ids(unit)
        return out


class Decoder:
    """Texts of ids: pieces joined, bytes read as UTF-8, the space in front taken off."""

    def __init__(self, vocabulary: Vocabulary):
        self.text: list[str | None] = [None] * vocabulary.size
        for p, (i, _) in vocabulary.pieces.items():
            self.text[i] = p.replace(SPACE, " ")
        self.byte = {i: b for b, i in enumerate(vocabulary.bytes_)}

    def decode(self, ids: list[int]) -> str:
        parts = [self.text[i] for i in ids]
        if None in parts:
            raw = bytearray()
            joined: list[str] = []
            for i, part in zip(ids, parts):
                if part is None and i in self.byte:
                    raw.append(self.byte[i])
                    continue
                if raw:
                    joined.append(_letters(raw))
                    raw = bytearray()
                joined.append(part or "")
            parts = [*joined, _letters(raw)]
        text = "".join(parts)
        return text[1:] if text.startswith(" ") and self.text[ids[0]] is not None else text

    def texts(self, rows: pa.Array) -> pa.Array:
        """The text of each list of ids, null for null; one row's ids at a time are Python numbers, made of a plain buffer at once."""
        return pa.array([self.decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else None for x in rows], pa.string())


def _letters(raw: bytearray) -> str:
    """UTF-8 letters of bytes; each byte that begins none is one replacement character."""
    out, at = [], 0
    while at < len(raw):
        lead = raw[at]
        size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
        try:
            out.append(raw[at : at + size].decode())
        except UnicodeDecodeError:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the piece ids of every whole text under the model file at ``path``.

    The vocabulary (bounded by the model) is read by the driver and broadcast, so
    executors need no file.  A null or empty text has no ids; repeated rows are encoded
    one by one, an empty table gives no row, and other columns are kept, but a column
    named ``ids`` is an error.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(vocabulary.value)
            found = [np.array(encoder.encode(t), np.int32) if t else np.empty(0, np.int32) for t in batch.column(at).to_pylist()]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.empty(0, np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return mapped(docs, run, "ids array<int>")


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of the ids in ``into``; null ids give a null text, ids of control pieces none of it."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for batch in batches:
            decoder = decoder or Decoder(vocabulary.value)
            texts = decoder.texts(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, into])

    return mapped(encoded, run, f"{into} string")
