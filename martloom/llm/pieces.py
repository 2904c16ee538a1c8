"""SentencePiece encoding with byte offsets into the source text, and decoding.

The normaliser is followed on its own: at each place the longest prefix that the model's compiled
character map knows is replaced, else one character is kept, and the source place of every byte
of the result is recorded. A text is segmented by the sentencepiece library; its pieces lie end to
end in the normalised text, so their lengths give the span of each piece in source bytes. If they
do not add up to the normalised text, that is an error, not a guess.

Edge cases: a NULL or empty text has no ids and decodes to the empty text. Rows are independent
of each other; an empty table gives an empty result. Columns besides the named ones are kept by
``encoded`` unless they have the name of a result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from martloom.functions.names import quoted, quoted_name
from martloom.llm.common import text_blocks, texts_of

SPACE = "▁".encode()
REPLACEMENT = "�".encode()
RESULTS = ("ids", "begins", "ends", "decoded")


class CharacterMap:
    """A compiled character map: a double-array trie whose values are places of replacements."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4) if size else np.zeros(0, "<u4")
        self.replacements = compiled[4 + size :]

    def __bool__(self) -> bool:
        return len(self.units) > 0

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``text[at:]``."""
        found, node = None, self._first(int(self.units[0]))
        for place in range(at, len(text)):
            node ^= text[place]
            if node >= len(self.units):
                break
            unit = int(self.units[node])
            if unit & 0x800000FF != text[place]:
                break
            node ^= self._first(unit)
            if unit >> 8 & 1:
                found = place + 1 - at, int(self.units[node]) & 0x7FFFFFFF
        if found is None:
            return None
        end = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1] : end]

    @staticmethod
    def _first(unit: int) -> int:
        """What to combine a unit's place with to reach the unit of a following byte."""
        return unit >> 10 << ((unit & 1 << 9) >> 6)


@dataclass(frozen=True)
class Aligned:
    text: bytes
    # Source place of each byte of ``text``, and at the end the length of the source.
    source: np.ndarray


class Normaliser:
    def __init__(self, model: model_pb2.ModelProto):
        spec = model.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.trim = spec.remove_extra_whitespaces
        self.space = SPACE if spec.escape_whitespaces else b" "
        self.prefix = spec.add_dummy_prefix and not model.trainer_spec.treat_whitespace_as_suffix
        self.suffix = spec.add_dummy_prefix and model.trainer_spec.treat_whitespace_as_suffix
        kind = model_pb2.ModelProto.SentencePiece.USER_DEFINED
        defined = [p.piece.encode() for p in model.pieces if p.type == kind]
        self.defined = sorted(defined, key=len, reverse=True)

    def __call__(self, text: bytes) -> Aligned:
        if self.map or self.trim or self.defined or self.suffix:
            return self._stepwise(text)
        return self._spaces_only(np.frombuffer(text, np.uint8))

    def _spaces_only(self, raw: np.ndarray) -> Aligned:
        """Without a character map only spaces change, all of them alike."""
        if not len(raw):
            return Aligned(b"", np.zeros(1, np.int64))
        blank = raw == 0x20
        lengths = np.where(blank, len(self.space), 1)
        lead = len(self.space) if self.prefix else 0
        source = np.concatenate([np.zeros(lead, np.int64), np.repeat(np.arange(len(raw)), lengths)])
        text = (b" " + raw.tobytes() if self.prefix else raw.tobytes()).replace(b" ", self.space)
        return Aligned(text, np.append(source, len(raw)))

    def _stepwise(self, text: bytes) -> Aligned:
        steps: list[tuple[bytes, int]] = []
        at = 0
        while at < len(text):
            length, put = self._step(text, at)
            steps.append((put, at))
            at += length
        out, source = bytearray(), []
        last_blank = self.trim

        def add(put: bytes, place: int) -> None:
            out.extend(put)
            source.extend([place] * len(put))

        if self.trim:
            while steps and not steps[0][0].strip(b" "):
                steps.pop(0)
        if not steps:
            return Aligned(b"", np.array([len(text)]))
        if self.prefix:
            add(self.space, steps[0][1])
        for put, place in steps:
            if self.trim and last_blank:
                put = put.lstrip(b" ")
            if not put:
                continue
            add(put.replace(b" ", self.space), place)
            last_blank = put.endswith(b" ")
        if self.trim:
            while out.endswith(self.space):
                del out[-len(self.space) :], source[-len(self.space) :]
        if self.suffix:
            add(self.space, len(text))
        return Aligned(bytes(out), np.array([*source, len(text)], np.int64))

    def _step(self, text: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.defined:
            if text.startswith(symbol, at):
                return len(symbol), symbol
        found = self.map.longest(text, at) if self.map else None
        if found:
            return found
        first = text[at]
        length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        piece = text[at : at + length]
        try:
            piece.decode()
        except UnicodeDecodeError:
            return 1, REPLACEMENT
        return length, piece


class PieceEncoder:
    """Ids, source spans and decoded texts, by one model file."""

    def __init__(self, path: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        model = model_pb2.ModelProto()
        model.ParseFromString(self.processor.serialized_model_proto())
        self.normaliser = Normaliser(model)
        kinds = model_pb2.ModelProto.SentencePiece
        self.lengths = np.array(
            [1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in model.pieces], np.int64
        )
        self.unknown = [at for at, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN]
        self.names = [str(at) for at in range(len(model.pieces))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.processor.decode(ids, num_threads=1) if ids else []

    def spans(self, raw: bytes, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and last source byte (exclusive) of each piece of ``raw``."""
        aligned = self.normaliser(raw)
        lengths = self.lengths[ids] if ids else np.zeros(0, np.int64)
        if any(one in ids for one in self.unknown):
            found = self.processor.encode(raw.decode(), out_type=str)
            lengths = np.array([len(piece.encode()) for piece in found], np.int64)
            known = ~np.isin(ids, self.unknown)
            lengths[known] = self.lengths[ids][known]
        ends = np.cumsum(lengths)
        if (ends[-1] if len(ends) else 0) != len(aligned.text):
            raise ValueError("pieces that do not add up to the normalised text")
        return aligned.source[ends - lengths], aligned.source[ends]


@lru_cache(1)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per worker process."""
    return PieceEncoder(path)


def digests(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, covered`` per document, and its ``ids``.

    ``covered`` is how many bytes of the text the pieces' spans cover.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_path)
        for block, data, offsets in text_blocks(batches, "text"):
            ids = encoder.encode(texts_of(block))
            joined = [",".join(map(encoder.names.__getitem__, one)) for one in ids]
            covered = []
            for one, a, b in zip(ids, offsets, offsets[1:], strict=False):
                begins, ends = encoder.spans(data[a:b].tobytes(), one)
                covered.append(int(ends[-1] - begins[0]) if len(ends) else 0)
            columns = {
                "doc_id": block.column("doc_id"),
                "n_tokens": pa.array([len(one) for one in ids], pa.int64()),
                "ids_sha256": pa.array(map(_sha256, joined), pa.string()),
                "decoded_sha256": pa.array(map(_sha256, encoder.decode(ids)), pa.string()),
                "covered": pa.array(covered, pa.int64()),
            }
            if with_ids:
                columns["ids"] = _lists(ids, np.int32)
            yield pa.RecordBatch.from_pydict(columns)

    out = "n_tokens long, ids_sha256 string, decoded_sha256 string, covered long"
    out += ", ids array<int>" if with_ids else ""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {out}")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _lists(rows: list, kind: type) -> pa.ListArray:
    """Lists of numbers, on end in one buffer."""
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate([*map(np.asarray, rows), np.zeros(0)]).astype(kind)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ``ids``, ``begins`` and ``ends`` (source bytes of each id) and ``decoded``."""
    kept = docs.select(*[quoted(name) for name in docs.columns if name not in RESULTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_path)
        for block, data, offsets in text_blocks(batches, "text"):
            ids = encoder.encode(texts_of(block))
            spans = [
                encoder.spans(data[a:b].tobytes(), one)
                for one, a, b in zip(ids, offsets, offsets[1:], strict=False)
            ]
            columns = [
                _lists(ids, np.int32),
                _lists([begins for begins, _ in spans], np.int64),
                _lists([ends for _, ends in spans], np.int64),
                pa.array(encoder.decode(ids), pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*block.columns, *columns], [*block.schema.names, *RESULTS]
            )

    added = "ids array<int>, begins array<long>, ends array<long>, decoded string"
    fields = ", ".join(f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, {added}")
