"""Operator 12: SentencePiece encoding and decoding that keeps source offsets.

A text is brought to normal form first: at each place the longest rule of the
model's compiled character map that fits is applied (one character stands for
itself where none fits), blanks become the model's blank mark, and for every
character of the normal form the byte of the original text it came from is
recorded. The library merges pieces of the normal form, with its own rewriting
switched off. A piece's span of the normal form is projected through the recorded alignment to
bytes of the original text, so for every piece the original text can be cut out.
Bytes of a character that no piece holds get empty spans but for the last, which
has the character's.

Merges never cross from a character to a blank mark where no piece of the model
holds such a pair, so there the normal form is cut into chunks, and a task codes
each distinct chunk once (at most `KNOWN_CHUNKS` at a time). Spark deals out the
documents; nothing is shuffled or collected. The model file is read on the driver
and sent to the tasks (its size is that of a vocabulary).

Null text: encoded as empty. Empty text: no ids, empty decoded text. Repeated rows:
each gives its own row. Other columns pass through, whatever their names; those
called like a result are replaced.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granulake.llm.chunk_codes import ChunkCodes
from granulake.llm.common import pieces

#: The blank mark of normal forms.
BLANK = "▁"
#: Bytes of text handled at a time.
PIECE_BYTES = 2_000_000

# one mark for each byte that is no character
codecs.register_error("each-byte", lambda error: ("\ufffd", error.start + 1))


def character_map(blob: bytes) -> dict[str, str]:
    """Rules of a compiled character map: what is replaced, and by what.

    The blob holds the size of a double-array trie, the trie, and the
    replacements, each ended by a zero byte; a key's value is the place of its
    replacement. A unit of the array holds its label in the low byte, a flag for
    a value, and the offset to its children, which lie at offset XOR label.
    """
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob[4 : 4 + size], dtype="<u4")
    texts = blob[4 + size :]
    offsets = (units >> 10) << ((units & 512) >> 6)
    labels = units & 0x800000FF
    letters = np.arange(1, 256, dtype=np.uint32)
    rules: dict[str, str] = {}
    waiting = [(int(offsets[0]), b"")]
    while waiting:
        base, key = waiting.pop()
        children = base ^ letters
        inside = children < len(units)
        hits = letters[inside][labels[children[inside]] == letters[inside]]
        for letter in hits.tolist():
            unit = base ^ letter
            longer = key + bytes([letter])
            below = unit ^ int(offsets[unit])
            if int(units[unit]) >> 8 & 1:
                start = int(units[below]) & 0x7FFFFFFF
                rules[longer.decode()] = texts[start : texts.index(b"\0", start)].decode()
            waiting.append((below, longer))
    return rules


class PieceModel:
    """A BPE model with its normal form, read from a model file's bytes."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE:
            raise ValueError("only models that merge pairs are read")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with blanks at the end of words are not read")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("models with pieces of the user's or without use are not read")
        self.spec = sentencepiece_model_pb2.NormalizerSpec()
        self.spec.CopyFrom(proto.normalizer_spec)
        self.rules = character_map(self.spec.precompiled_charsmap)
        self.longest: dict[str, int] = {}
        for key in self.rules:
            self.longest[key[0]] = max(len(key), self.longest.get(key[0], 0))
        self.plain = not self.rules and not self.spec.remove_extra_whitespaces
        self.blank = BLANK if self.spec.escape_whitespaces else " "
        self.strips = self.spec.add_dummy_prefix or self.spec.remove_extra_whitespaces
        self.unknown = proto.trainer_spec.unk_id
        self.surfaces = [p.piece.replace(BLANK, " ") if p.type == kinds.NORMAL else "" for p in proto.pieces]
        self.surfaces[self.unknown] = proto.trainer_spec.unk_surface
        self.byte_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        #: What each piece adds to a text.
        self.said = [bytes([self.byte_of[i]]) if i in self.byte_of else s.encode() for i, s in enumerate(self.surfaces)]
        self.mute = {i for i, said in enumerate(self.said) if not said}
        self.byte_values = np.full(len(proto.pieces), -1, dtype=np.int64)
        self.byte_values[list(self.byte_of)] = list(self.byte_of.values())
        #: Characters of the normal form that each piece takes.
        self.sizes = np.array([len(p.piece) if p.type == kinds.NORMAL else 1 for p in proto.pieces], dtype=np.int64)
        crossing = re.compile(f"[^{self.blank}]{self.blank}")
        cut = f"{self.blank}*[^{self.blank}]+|{self.blank}+"
        self.chunk = re.compile("(?s).+" if any(crossing.search(p.piece) for p in proto.pieces) else cut)
        # merges alone: the text is in normal form already
        proto.normalizer_spec.precompiled_charsmap = b""
        proto.normalizer_spec.add_dummy_prefix = proto.normalizer_spec.remove_extra_whitespaces = False
        merger = SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.codes = ChunkCodes(lambda chunks: merger.encode(chunks, num_threads=1))

    # --- normal form ----------------------------------------------------------
    def _rewritten(self, text: str) -> Iterator[tuple[str, int]]:
        """Replacement and number of characters taken, from left to right."""
        at, rules, longest = 0, self.rules, self.longest
        while at < len(text):
            for size in range(min(longest.get(text[at], 0), len(text) - at), 0, -1):
                if (found := rules.get(text[at : at + size])) is not None:
                    yield found, size
                    at += size
                    break
            else:
                yield text[at], 1
                at += 1

    def normal(self, text: str) -> tuple[str, np.ndarray]:
        """The normal form, and for each of its characters, and its end, the byte of the text it came from."""
        if not text:
            return "", np.zeros(1, dtype=np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        sizes = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        bytes_at = np.concatenate([[0], np.cumsum(sizes)])
        if self.plain:
            form = text.replace(" ", self.blank)
            if not self.spec.add_dummy_prefix:
                return form, bytes_at
            return self.blank + form, np.concatenate([[0], bytes_at])
        squeeze = self.spec.remove_extra_whitespaces
        form: list[str] = []
        origin: list[int] = []
        taken, after_blank, started = 0, squeeze, False
        for part, size in self._rewritten(text):
            if squeeze and not started and part == " ":
                taken += size
                continue
            if not started:
                started = True
                if self.spec.add_dummy_prefix:
                    form.append(self.blank)
                    origin.append(taken)
            if after_blank:
                part = part.lstrip(" ")
            if part:
                form.append(part.replace(" ", self.blank))
                origin.extend([taken] * len(part))
                after_blank = squeeze and part.endswith(" ")
            taken += size
        if not started:
            return "", np.zeros(1, dtype=np.int64)
        whole = "".join(form)
        if squeeze:
            short = whole.rstrip(self.blank)
            if len(short) < len(whole):
                taken = origin[len(short)]
                whole, origin = short, origin[: len(short)]
        return whole, bytes_at[np.array([*origin, taken], dtype=np.int64)]

    # --- pieces ---------------------------------------------------------------
    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, first and past-last byte of each piece in its text, and where the pieces of each text end."""
        forms = [self.normal(t) for t in texts]
        ids, ends = self.codes.tokens([self.chunk.findall(form) for form, _ in forms])
        sizes = self.sizes[ids]
        # a character's bytes: all but the last are of no size
        byte = self.byte_values[ids]
        sizes[:-1][(byte[:-1] >= 0) & (byte[1:] >= 0x80) & (byte[1:] < 0xC0)] = 0
        # all normal forms one after the other, each with one more place for its end
        places = np.cumsum([0, *[len(origin) for _, origin in forms]])
        origins = np.concatenate([origin for _, origin in forms]) if forms else np.zeros(0, dtype=np.int64)
        stop = np.cumsum(sizes)
        taken = np.concatenate([[0], stop])[ends[:-1]]
        stop = stop + np.repeat(places[:-1] - taken, np.diff(ends))
        return ids, origins[stop - sizes], origins[stop], ends

    def decode(self, ids: list[int]) -> str:
        """The text of ids: blank marks are blanks, bytes are read together, the leading blank goes."""
        lead, at = "", 0
        if self.strips:
            # piece by piece as long as nothing is said
            while at < len(ids) and not lead and ids[at] not in self.byte_of:
                surface = self.surfaces[ids[at]]
                at += 1
                gone = surface.startswith(" ") and ids[at - 1] != self.unknown
                lead = surface[gone:]
                if gone and not self.spec.remove_extra_whitespaces:
                    break
        # no surface starts inside a character, so bytes and surfaces can be read as one; a piece that says nothing parts bytes
        rest = ids[at:]
        runs = [rest] if self.mute.isdisjoint(rest) else [[*run] for _, run in groupby(rest, self.mute.__contains__)]
        return lead + "".join([b"".join(map(self.said.__getitem__, run)).decode("utf-8", "each-byte") for run in runs])


@lru_cache(maxsize=2)
def piece_model(model: bytes) -> PieceModel:
    """One per Python worker."""
    return PieceModel(model)


SPANS = [
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("starts", T.ArrayType(T.IntegerType())),
    T.StructField("stops", T.ArrayType(T.IntegerType())),
    T.StructField("decoded", T.StringType()),
]


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Each row with `ids` of its text, `starts` and `stops` of each piece in bytes of it, and `decoded`."""
    names = [f.name for f in SPANS]
    kept = [f for f in docs.schema if f.name not in names or f.name == text]
    kept_names = [f.name for f in kept]
    if text in names:
        raise ValueError(f"the text column cannot be called {text}")
    model = Path(path).read_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_model(model)
        for batch in batches:
            for piece in pieces(batch, text, PIECE_BYTES):
                ids, starts, stops, ends = coder.encode([t or "" for t in piece.column(text).to_pylist()])
                offsets = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (ids, starts, stops)]
                flat, at = ids.tolist(), ends.tolist()
                decoded = [coder.decode(flat[a:b]) for a, b in zip(at, at[1:], strict=False)]
                columns = [*[piece.column(n) for n in kept_names], *lists, pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*kept_names, *names])

    return docs.select(*[F.col(f"`{n}`") for n in kept_names]).mapInArrow(run, T.StructType([*kept, *SPANS]))
