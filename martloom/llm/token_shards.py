"""Token ids of a corpus as wavelet matrices, one compressed file per shard.

Documents are ordered by id and encoded; each task fills shards of about ``SHARD_TOKENS`` ids and
never splits a document. A shard's file holds its ids as bit planes with rank counts, so that a
token is read, counted or found from the planes alone, and the documents it holds. The files are
the ``blob`` cells of a table with one row per shard, as Spark has no other sink for bytes that
executors can write; a cell saved under any name is a file that ``WaveletShard`` reads.

Layout, little endian: ``MWM1``, then a zstd frame of: ids, documents and planes (3 long), zeros
per plane (long each), document ids (long each, with a byte for NULL), ids per document (long
each), planes (8 bits to a byte, most significant bit of the ids first), and for each plane the
count of ones before every 512th bit (long each).

Edge cases: a NULL text is empty and has the end id only; rows without a doc_id come first; rows
that share one keep the order in which they are read. An empty table gives no shard.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martloom.llm.common import filled_texts, text_blocks
from martloom.sinks.scratch import staged

SHARD_TOKENS = 1 << 18
END_ID = 2
MAGIC = b"MWM1"
RANK_BITS = 512
CACHED_CHUNKS = 400_000
# Larger blocks repeat more of their chunks.
BLOCK_BYTES = 12 << 20

# With the usual pattern of byte-level vocabularies, a unit always begins at a space or line end
# that no white space follows, and at a full stop or comma after a Latin letter or digit. So a
# text may be cut there and the parts encoded on their own. Texts are cut at marked spaces: a chunk
# that begins with a line end, stop or comma had no space before it. Texts with a space that
# could be confused with a mark go to the library whole; in those with other line ends, stops or
# commas only spaces are cuts.
BLANK = r"\s\x0b\x1c-\x1f\x85\pZ"
UNCUT = rf" ([{BLANK}.,]|$)"
ONLY_SPACES = rf"(^|[^A-Za-z0-9À-ÖØ-öø-ÿ])[.,]|\n([{BLANK}]|$)"
MARKED = ("\n", ".", ",")
JOINED_CHARS = 1 << 13


class ChunkEncoder:
    """Encodes with the ``tokenizers`` library, each distinct chunk between cuts once.

    New chunks of a block are encoded on end; as every id stands for a known number of bytes, the
    ids of each chunk are told by its length. Only for byte-level vocabularies without a
    normaliser; others, and texts that hold a special token (next to which the pattern cuts
    otherwise), go to the library whole. Chunks are kept in two generations, so that those that
    come again are still known when the older generation is dropped.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        unit = repr(self.tokenizer.pre_tokenizer)
        self.in_chunks = (
            self.tokenizer.normalizer is None
            and self.tokenizer.post_processor is None
            and unit.startswith("ByteLevel(add_prefix_space=False")
            and "use_regex=True" in unit
        )
        # Byte-level tokens are written with one character for each byte.
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, at in vocabulary.items():
            self.lengths[at] = len(token)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def __call__(self, rows: pa.Array) -> list[np.ndarray]:
        """The ids of each text. Chunks are told apart by Arrow, and Python sees each one once."""
        plain = self._cuttable(rows)
        kept, others = rows, rows[:0]
        if not pc.all(plain).as_py():
            kept, others = rows.filter(plain), rows.filter(pc.invert(plain))
        marked = kept
        for sign in MARKED:
            marked = pc.replace_substring(marked, sign, f" {sign}")
        only_spaces = pc.match_substring_regex(kept, ONLY_SPACES)
        if pc.any(only_spaces).as_py():
            marked = pc.if_else(only_spaces, kept, marked)
        cut = pc.split_pattern(marked, " ")
        chunks, bounds = cut.flatten(), cut.offsets.to_numpy()
        leads = chunks.take(pa.array(bounds[:-1])).to_pylist()
        others = iter(self.whole(others.to_pylist()))
        first = iter(self.whole(leads))
        coded = chunks.dictionary_encode()
        joined, ends = self._joined(coded)
        # The first chunk of a text has no space before it, so it was encoded on its own.
        rest = iter([joined[ends[a + 1] : ends[b]] for a, b in zip(bounds, bounds[1:], strict=False)])
        return [
            np.concatenate([np.frombuffer(next(first), "<u4"), next(rest)])
            if whole
            else np.frombuffer(next(others), "<u4")
            for whole in plain.to_pylist()
        ]

    def _cuttable(self, rows: pa.Array) -> pa.Array:
        if not self.in_chunks:
            return pa.array(np.zeros(len(rows), bool))
        uncut = pc.or_(pc.match_substring_regex(rows, UNCUT), pc.equal(rows, ""))
        for token in self.special:
            uncut = pc.or_(uncut, pc.match_substring(rows, token))
        return pc.invert(uncut)

    def _joined(self, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks on end, and where each chunk's begin (one more than chunks)."""
        parts = self._known(coded.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(parts), "<u4")
        lengths = np.fromiter(map(len, parts), np.int32, len(parts)) // 4
        starts = np.cumsum(lengths, dtype=np.int32) - lengths
        at = coded.indices.to_numpy()
        counts = lengths[at]
        ends = np.concatenate([[0], np.cumsum(counts)])
        # Each chunk's ids lie on end: one step to the next id, a jump from chunk to chunk.
        steps = np.ones(ends[-1], np.int32)
        full = np.flatnonzero(counts)
        steps[ends[full]] = np.diff(starts[at[full]], prepend=0)
        steps[ends[full][1:]] -= counts[full][:-1] - 1
        return ids[np.cumsum(steps, dtype=np.int32)], ends

    def _known(self, chunks: list[str]) -> list[bytes]:
        found = list(map(self.known.get, chunks))
        late = [at for at, part in enumerate(found) if part is None]
        names = [chunks[at] for at in late]
        parts = list(map(self.older.get, names))
        learned = self._learned([n for n, part in zip(names, parts, strict=True) if part is None])
        parts = [learned[n] if part is None else part for n, part in zip(names, parts, strict=True)]
        for at, part in zip(late, parts, strict=True):
            found[at] = part
        self.known.update(zip(names, parts, strict=True))
        if len(self.known) > CACHED_CHUNKS:
            self.older, self.known = self.known, {}
        return found

    def _learned(self, chunks: list[str]) -> dict[str, bytes]:
        signs, lines, spaced = [], [], []
        by_first = {MARKED[0]: lines} | dict.fromkeys(MARKED[1:], signs)
        for chunk in chunks:
            by_first.get(chunk[:1], spaced).append(chunk)
        learned = dict(zip(signs, self.whole(signs), strict=True))
        # Lines are joined with lines: after white space they would not be units of their own.
        return learned | self._encoded_on_end(lines, "") | self._encoded_on_end(spaced, " ")

    def _encoded_on_end(self, chunks: list[str], before: str) -> dict[str, bytes]:
        at, learned = 0, {}
        while at < len(chunks):
            size, first = 0, at
            while at < len(chunks) and size < JOINED_CHARS:
                size += len(chunks[at]) + 1
                at += 1
            joined = [before + chunk for chunk in chunks[first:at]]
            ids = np.frombuffer(self.whole(["".join(joined)])[0], "<u4")
            ends = np.cumsum([len(chunk) for chunk in map(str.encode, joined)])
            places = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
            raw, stops = ids.tobytes(), (places * 4).tolist()
            parts = [raw[a:b] for a, b in zip([0, *stops], stops)]
            learned.update(zip(chunks[first:at], parts, strict=True))
        return learned


@lru_cache(1)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process, so that tasks share what it has learned."""
    return ChunkEncoder(path)


def zeros_first(ones: np.ndarray) -> np.ndarray:
    """Places of the zeros, then of the ones, each in order."""
    return np.concatenate([np.flatnonzero(~ones), np.flatnonzero(ones)])


class WaveletShard:
    """One shard's file: the ids of its documents, on end, with rank and select."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a token shard")
        raw = zstandard.ZstdDecompressor().decompress(blob[4:])
        self.length, documents, planes = struct.unpack_from("<3q", raw)
        at = 24
        take = lambda kind, n: np.frombuffer(raw, kind, n, at)
        self.zeros = take("<i8", planes)
        at += 8 * planes
        self.doc_ids = take("<i8", documents)
        at += 8 * documents
        self.missing = take("u1", documents).astype(bool)
        at += documents
        self.doc_lengths = take("<i8", documents)
        at += 8 * documents
        width = -(-self.length // 8)
        self.planes = take("u1", planes * width).reshape(planes, width)
        at += planes * width
        blocks = self.length // RANK_BITS + 1
        self.ranks = take("<i8", planes * blocks).reshape(planes, blocks)
        if at + 8 * planes * blocks != len(raw):
            raise ValueError("a token shard of the wrong length")

    @staticmethod
    def build(ids: np.ndarray, doc_ids: list[int | None], doc_lengths: list[int]) -> bytes:
        n, planes = len(ids), max(1, int(ids.max(initial=0)).bit_length())
        row = ids.astype(np.uint16 if planes <= 16 else np.uint32)
        zeros, packed, ranks = [], [], []
        for plane in range(planes - 1, -1, -1):
            ones = (row & row.dtype.type(1 << plane)) != 0
            bits = np.packbits(ones)
            zeros.append(n - int(np.count_nonzero(ones)))
            packed.append(bits.tobytes())
            held = np.zeros(n // RANK_BITS * (RANK_BITS // 8), np.uint8)
            held[:] = bits[: len(held)]
            per_block = np.bitwise_count(held).reshape(-1, RANK_BITS // 8).sum(1, dtype=np.int64)
            ranks.append(np.concatenate([[0], np.cumsum(per_block)]).astype("<i8").tobytes())
            row = row.take(zeros_first(ones)) if plane else row
        raw = [
            struct.pack("<3q", n, len(doc_ids), planes),
            np.array(zeros, "<i8").tobytes(),
            np.array([name or 0 for name in doc_ids], "<i8").tobytes(),
            np.array([name is None for name in doc_ids], "u1").tobytes(),
            np.array(doc_lengths, "<i8").tobytes(),
            *packed,
            *ranks,
        ]
        return MAGIC + zstandard.ZstdCompressor(level=1).compress(b"".join(raw))

    def _ones(self, plane: int, place: int) -> int:
        """Ones of a plane before ``place``."""
        block = place // RANK_BITS
        first, last = block * RANK_BITS // 8, place // 8
        count = int(self.ranks[plane, block])
        count += int(np.bitwise_count(self.planes[plane, first:last]).sum())
        if place % 8:
            count += int(self.planes[plane, last] >> (8 - place % 8)).bit_count()
        return count

    def _bit(self, plane: int, place: int) -> int:
        return int(self.planes[plane, place // 8] >> (7 - place % 8) & 1)

    def access(self, place: int) -> int:
        """The id at ``place``."""
        if not 0 <= place < self.length:
            raise IndexError(place)
        token = 0
        for plane in range(len(self.zeros)):
            bit, ones = self._bit(plane, place), self._ones(plane, place)
            token = token << 1 | bit
            place = int(self.zeros[plane]) + ones if bit else place - ones
        return token

    def _range(self, token: int, place: int) -> tuple[int, int]:
        """Where, below the last plane, the occurrences before ``place`` begin and end."""
        low, high = 0, place
        if token >> len(self.zeros):
            return 0, 0
        for plane, zeros in enumerate(self.zeros):
            a, b = self._ones(plane, low), self._ones(plane, high)
            if token >> (len(self.zeros) - 1 - plane) & 1:
                low, high = int(zeros) + a, int(zeros) + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, place: int) -> int:
        """How often ``token`` occurs before ``place``."""
        low, high = self._range(token, place)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.length)

    def select(self, token: int, nth: int) -> int:
        """Where ``token`` occurs for the ``nth`` time, counted from 0."""
        low, high = self._range(token, self.length)
        if not 0 <= nth < high - low:
            raise IndexError(nth)
        place = low + nth
        for plane in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - plane) & 1
            place = self._find(plane, bit, place - int(self.zeros[plane]) if bit else place)
        return place

    def _find(self, plane: int, bit: int, nth: int) -> int:
        """Where a plane has its ``nth`` one (or zero), counted from 0."""
        starts = np.arange(self.ranks.shape[1]) * RANK_BITS
        before = self.ranks[plane] if bit else starts - self.ranks[plane]
        block = int(np.searchsorted(before, nth, "right")) - 1
        first = block * RANK_BITS // 8
        bits = np.unpackbits(self.planes[plane, first : first + RANK_BITS // 8])
        return int(starts[block] + np.flatnonzero(bits == bit)[nth - int(before[block])])

    def tokens(self) -> np.ndarray:
        """All ids in order. Planes are undone from the last to the first."""
        row = np.zeros(self.length, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for plane in range(len(self.zeros) - 1, -1, -1):
            ones = np.unpackbits(self.planes[plane], count=self.length).astype(bool)
            row[self.zeros[plane] :] |= row.dtype.type(1 << (len(self.zeros) - 1 - plane))
            above = np.empty_like(row)
            above[zeros_first(ones)] = row
            row = above
        return row


def shards(docs: DataFrame, vocabulary: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``part, number, n_tokens, blob``: the shards' files, ordered by part and number."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = chunk_encoder(vocabulary), TaskContext.get().partitionId()
        ids, names, lengths, number, held = [], [], [], itertools.count(), 0
        end = np.array([END_ID], "<u4")

        def shard() -> pa.RecordBatch:
            blob = WaveletShard.build(np.concatenate(ids), names, lengths)
            row = {"part": part, "number": next(number), "n_tokens": held, "blob": blob}
            return pa.RecordBatch.from_pylist([row], schema)

        for block, _, _ in text_blocks(batches, "text", BLOCK_BYTES):
            encoded = encode(filled_texts(block))
            for name, found in zip(block.column("doc_id").to_pylist(), encoded, strict=True):
                ids += [found, end]
                names.append(name)
                lengths.append(len(found) + 1)
                held += lengths[-1]
                if held >= shard_tokens:
                    yield shard()
                    ids, names, lengths, held = [], [], [], 0
        if names:
            yield shard()

    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("number", pa.int64()),
            ("n_tokens", pa.int64()),
            ("blob", pa.binary()),
        ]
    )
    # The read position parts rows that share a doc_id, which may be many.
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.monotonically_increasing_id().alias("row"),
    )
    ordered = keyed.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    return ordered.select("doc_id", "text").mapInArrow(
        fill, "part int, number long, n_tokens long, blob binary"
    )


def shard_starts(files: DataFrame) -> DataFrame:
    """``files`` with ``start``: the ids of all shards before.

    Sums run within parts, and over one row per part, never over all shards in one task.
    """
    per_part = files.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = per_part.select(
        "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("earlier")
    )
    inside = Window.partitionBy("part").orderBy("number")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select(
        "part", "number", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inner")
    ).join(parts, "part")
    start = (F.col("earlier") + F.col("inner")).alias("start")
    return files.join(placed.select("part", "number", start), ["part", "number"])


def document_digests(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the shards' files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, blob in zip(batch.column("start"), batch.column("blob"), strict=True):
                shard = WaveletShard(blob.as_py())
                ids = shard.tokens().astype("<u4")
                ends = np.cumsum(shard.doc_lengths)
                begins = ends - shard.doc_lengths
                crcs = [zlib.crc32(ids[a:b].data) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, mask=shard.missing),
                        pa.array(begins + start.as_py()),
                        pa.array(shard.doc_lengths),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    out = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return files.select("start", "blob").mapInArrow(read, out)


def written(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the shards below the shared folder and read the files back, with their starts."""
    files = staged(shards(docs, vocabulary), "token-shards")
    starts = staged(shard_starts(files.drop("blob")), "token-starts")
    return files.join(starts.select("part", "number", "start"), ["part", "number"])
