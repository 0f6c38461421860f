"""SentencePiece encoding and decoding for models of the merge type.

A text is encoded exactly as merging its characters would, without merging it:
an Aho-Corasick automaton gives the longest piece at every position, pieces are
taken from left to right, and a piece may follow another only if merging the
two together again gives just these two. If no piece fits, the position is
marked in a bitfield of failed positions and the search steps back. Every
position fails at most once, so long texts without any space stay linear.

Two facts of the vocabulary, checked when it is loaded, allow to encode a text
in parts that are remembered: no piece goes on after a space mark that follows
another character, and line ends are in no piece.

Defined results: a NULL text counts as empty; an empty text has the begin and
end ids only; characters without a piece become their UTF-8 bytes; any id
sequence decodes, stray bytes become U+FFFD; repeated rows give repeated rows;
columns named like a result are replaced, all others are kept.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Sequence
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyspark.llm.common import with_new_columns

SPACE = "▁"
# Fixed values of the model file format: piece types, and the merge model type.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_MODEL = 2
# What is remembered per worker at most: parts of texts, and pairs of pieces.
PARTS_KEPT, PAIRS_KEPT, PART_LENGTH = 250_000, 250_000, 48
ROWS_AT_ONCE = 512


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    """Field numbers and values of a message in the model file."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class _Parts(dict):
    """Packed ids by part of a text; forgets everything when it is full."""

    def __init__(self, codec: Codec, lead: str):
        super().__init__()
        self.codec, self.lead = codec, lead

    def __missing__(self, part: str) -> bytes:
        codec = self.codec
        if len(part) > PART_LENGTH:  # any length, like a paragraph without spaces: no recursion
            cuts = codec.safe_cuts(part)
            if cuts:
                rest = map(codec.bare.__getitem__, map(part.__getitem__, map(slice, cuts, [*cuts[1:], None])))
                return self[part[: cuts[0]]] + b"".join(rest)
        else:
            cut = codec.safe_cut(part)
            if cut:  # ends in a mark that no piece joins to a letter, like a full stop
                return self[part[:cut]] + codec.bare[part[cut:]]
        ids = codec.packed_part(self.lead + part)
        if len(part) <= PART_LENGTH:
            if len(self) >= PARTS_KEPT:
                self.clear()
            self[part] = ids
        return ids


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        pieces: list[str] = []
        scores: list[float] = []
        kinds: list[int] = []
        kind, dummy, squeeze, escape, charsmap, fallback, suffix = 1, True, True, True, b"", False, False
        special = {"unk": 0, "bos": 1, "eos": 2}
        for number, value in _fields(model):
            if number == 1:
                entry = dict(_fields(value))
                pieces.append(entry[1].decode())
                scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
                kinds.append(entry.get(3, NORMAL))
            elif number == 2:
                entry = dict(_fields(value))
                kind, fallback, suffix = entry.get(3, 1), bool(entry.get(35)), bool(entry.get(24))
                special = {"unk": entry.get(40, 0), "bos": entry.get(41, 1), "eos": entry.get(42, 2)}
                self.unknown_surface = entry.get(44, b" \xe2\x81\x87 ")
            elif number == 3:
                entry = dict(_fields(value))
                charsmap, dummy = entry.get(2, b""), bool(entry.get(3, 1))
                squeeze, escape = bool(entry.get(4, 1)), bool(entry.get(5, 1))
        plain = dummy and not squeeze and escape and not charsmap and not suffix
        if kind != MERGE_MODEL or not plain or not fallback or not {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merge models with byte fallback and without text normalisation are supported")
        self.pieces, self.kinds, self.special = pieces, kinds, special
        normal = [i for i, k in enumerate(kinds) if k == NORMAL]
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in normal}, reverse=True))}
        self.rank = {pieces[i]: order[scores[i]] for i in normal}
        self.control = [i for i, k in enumerate(kinds) if k == CONTROL]
        self.byte_ids = [0] * 256
        for i, k in enumerate(kinds):
            if k == BYTE:
                self.byte_ids[int(pieces[i][3:5], 16)] = i
        # Only pieces that merging their own characters can reach take part.
        usable = [i for i in normal if self.merge(pieces[i]) == [pieces[i]]]
        self.usable = {pieces[i]: i for i in usable}
        self.characters = {c for p in self.usable for c in p}
        self.joined = {p[i : i + 2] for p in self.usable for i in range(len(p) - 1)}
        self.length = [len(p) for p in pieces]
        self.longest = max(map(len, self.usable), default=1)
        self.shorter = [-1] * len(pieces)
        self.automaton = ahocorasick.Automaton()
        for text, i in self.usable.items():
            self.automaton.add_word(text, i)
            for size in range(len(text) - 1, 0, -1):
                if text[:size] in self.usable:
                    self.shorter[i] = self.usable[text[:size]]
                    break
        self.automaton.make_automaton()
        self.can_cut_at_spaces = not any(b == SPACE and a != SPACE for a, b in self.joined)
        self.can_cut_at_lines = "\n" not in self.characters
        self.compatible: dict[int, bool] = {}
        self.bare, self.spaced = _Parts(self, ""), _Parts(self, SPACE)
        self.line_end = self.packed_part("\n")
        self.begin, self.end = (struct.pack("<I", special[k]) for k in ("bos", "eos"))
        self.surface = [
            b"" if k == CONTROL else self.unknown_surface if k == UNKNOWN else bytes([int(p[3:5], 16)])
            if k == BYTE else p.replace(SPACE, " ").encode()
            for p, k in zip(pieces, kinds, strict=True)
        ]

    def merge(self, text: str) -> list[str]:
        """Pieces that merging gives: best score first, leftmost of equals."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            ranks = [rank.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == 1 << 30:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the text of both pieces again gives just the two."""
        key = left << 32 | right
        known = self.compatible.get(key)
        if known is None:
            a, b = self.pieces[left], self.pieces[right]
            if len(self.compatible) >= PAIRS_KEPT:
                self.compatible.clear()
            known = self.compatible[key] = self.merge(a + b) == [a, b]
        return known

    def safe_cut(self, part: str) -> int:
        """Where a short tail begins that no piece joins to what is before; 0 if nowhere."""
        if len(part) > 1 and part[-2:] not in self.joined and part[-2] != SPACE:
            return len(part) - 1
        return 0

    def safe_cuts(self, part: str) -> list[int]:
        """All places where no piece joins a character to the one before."""
        joined = self.joined
        return [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in joined and part[i - 1] != SPACE]

    def encode_known(self, text: str) -> list[int]:
        """Ids of a text whose characters all have pieces."""
        # Each search gets a window that holds any piece: the automaton copies what it is given.
        n, length, shorter, matches, window = len(text), self.length, self.shorter, self.automaton.iter_long, self.longest
        known, fits = self.compatible.get, self.fits
        failed = bytearray(n + 1)
        ids: list[int] = []
        at, piece = 0, next(matches(text[:window]))[1]
        while at < n:
            last = ids[-1] if ids else -1
            while piece >= 0:
                end = at + length[piece]
                if not failed[end]:
                    good = last < 0 or known(last << 32 | piece)
                    if good is None:
                        good = fits(last, piece)
                    if good:
                        break
                piece = shorter[piece]
            if piece >= 0:
                ids.append(piece)
                at = end
                if at < n:  # every character is a piece, so the longest match starts right here
                    piece = next(matches(text[at : at + window]))[1]
            elif last < 0:
                raise ValueError("no sequence of pieces fits")
            else:  # nothing fits after the last piece: mark the place, try a shorter last piece
                failed[at] = 1
                ids.pop()
                at -= length[last]
                piece = last
        return ids

    def packed_part(self, text: str) -> bytes:
        """Ids of any text without begin, end and leading space mark."""
        ids: list[int] = []
        start, characters = 0, self.characters
        for at, c in enumerate(text):
            if c not in characters:
                if start < at:
                    ids += self.encode_known(text[start:at])
                ids += [self.byte_ids[b] for b in c.encode()]
                start = at + 1
        if start < len(text):
            ids += self.encode_known(text[start:] if start else text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """All ids with begin and end, as little-endian 32-bit integers."""
        if not text:
            return self.begin + self.end
        out = [self.begin]
        if not (self.can_cut_at_spaces and self.can_cut_at_lines):
            out.append(self.packed_part((" " + text).replace(" ", SPACE)))
        else:
            bare, spaced = self.bare, self.spaced
            for place, line in enumerate(text.split("\n")):
                if place:
                    out.append(self.line_end)
                words = line.split(" ")
                if "" in words or SPACE in line:  # several spaces in a row, at an edge, or marks in the text
                    out.append(self._spaces((line if place else " " + line).replace(" ", SPACE)))
                    continue
                out.append(bare[words[0]] if place else spaced[words[0]])
                out += map(spaced.__getitem__, words[1:])
        out.append(self.end)
        return b"".join(out)

    def _spaces(self, line: str) -> bytes:
        """A line with runs of space marks, cut before each run."""
        out, start = [], 0
        for at in range(1, len(line)):
            if line[at] == SPACE and line[at - 1] != SPACE:
                out.append(self.packed_part(line[start:at]))
                start = at
        out.append(self.packed_part(line[start:]))
        return b"".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        """Text of any sequence of ids."""
        surface = self.surface
        head, at = b"", 0
        for i in ids:  # the first mark of the text is the one that encoding put there
            at += 1
            if self.kinds[i] == CONTROL:
                continue
            head = surface[i]
            if self.kinds[i] == NORMAL and head[:1] == b" ":
                head = head[1:]
            break
        body = ids[at:]
        while body and self.kinds[body[-1]] == CONTROL:
            body = body[:-1]
        if not any(i in body for i in self.control):  # a control id ends a run of bytes
            try:
                return (head + b"".join(map(surface.__getitem__, body))).decode()
            except UnicodeDecodeError:
                pass
        return self._stray(head, ids, at)

    def _stray(self, head: bytes, ids: Sequence[int], at: int) -> str:
        """Bytes that are no character become U+FFFD, each by itself."""
        out: list[str] = []
        run = b""
        if at and self.kinds[ids[at - 1]] == BYTE:
            run = head
        else:
            out.append(head.decode())
        for i in ids[at:]:
            if self.kinds[i] == BYTE:
                run += self.surface[i]
            else:
                out += [_characters(run), self.surface[i].decode()]
                run = b""
        out.append(_characters(run))
        return "".join(out)


def _characters(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_CODECS: dict[str, Codec] = {}


def codec_of(model: bytes) -> Codec:
    """The codec of a model, built once per process."""
    name = hashlib.sha256(model).hexdigest()
    if name not in _CODECS:
        _CODECS[name] = Codec(model)
    return _CODECS[name]


def _slices(column: pa.Array) -> Iterable[list]:
    for start in range(0, len(column), ROWS_AT_ONCE):
        yield column.slice(start, ROWS_AT_ONCE).to_pylist()


def round_trip(
    docs: DataFrame, model_path: str, text: str = "text", keep_text: bool = True, packed: bool = True
) -> DataFrame:
    """Add ``ids`` (with begin and end) and ``decoded``, the text they decode to.

    ``ids`` is binary, little-endian 32-bit integers, or an array of integers.
    The model file (a few MB at most) is read here and sent to the executors.
    """
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    base = with_new_columns(docs, "ids", "decoded")
    kept = [c for c in base.columns if keep_text or c != text]
    place = docs.columns.index(text)
    places = [docs.columns.index(c) for c in kept]
    id_type = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([base.schema[c] for c in kept]).add("ids", id_type).add("decoded", "string")

    def run(batches):
        codec = codec_of(model.value)
        for batch in batches:
            all_ids, decoded = [], []
            for texts in _slices(batch.column(place)):
                for value in texts:
                    ids = codec.encode(value)
                    all_ids.append(ids if packed else np.frombuffer(ids, "<i4"))
                    decoded.append(codec.decode(np.frombuffer(ids, "<u4").tolist()))
            new = [
                pa.array(all_ids, pa.binary() if packed else pa.list_(pa.field("element", pa.int32(), False))),
                pa.array(decoded, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in places] + new, names=[*kept, "ids", "decoded"])

    return docs.mapInArrow(run, schema)
