"""Token-id files: texts to ids in id order, written as entropy-coded segments and read back.

A file set is a Parquet folder of segments, one per row. A segment holds whole documents in order: a magic number, a
directory (documents and their lengths, one frequency table shared by all its blocks, each block's length, checkpoints and
checksum) and the blocks' words (see `ans`). Segments are closed at SEGMENT ids, so a writer's and a reader's memory is
bounded by it and by the longest document. Segments decode on their own, so reading is as parallel as the table is long.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.llm import ans
from broadsheet.llm.words import slices

MAGIC = b"BSTK0001"
SEGMENT = 2_000_000
END = 0
# The words into which a byte-level vocabulary of this kind splits a text before it merges (a fixed value).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|"
           r"\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
LAST_LATIN = "ɏ"  # beyond it, Unicode versions may differ on what a letter is, and the library itself splits

SCHEMA = "part int, segment int, n_docs long, n_ids long, payload binary"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is printable, else 256 and up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


class _Remembered(dict):
    """What `make` gives for a key. When REMEMBERED keys are held, they become the older half, from which those still in use
    come back; so memory is bounded, and common keys are never made again."""

    REMEMBERED = 400_000

    def __init__(self):
        super().__init__()
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.make(key)
        if len(self) >= self.REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = ids
        return ids


class _Words(_Remembered):
    """Packed ids of single words (in the sense of PATTERN), merged by the library's model."""

    def __init__(self, merge, kind: str):
        super().__init__()
        self.merge, self.kind = merge, kind
        self.letters = str.maketrans(_byte_letters())
        self.blank = " ".translate(self.letters)

    def make(self, word: str) -> bytes:
        letters = word.translate(self.letters) if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return packed(self.kind, [t.id for t in self.merge(letters)])


class _Pieces(_Remembered):
    """Packed ids of a blank and what follows it up to the next blank."""

    def __init__(self, words: _Words, split):
        super().__init__()
        self.words, self.split = words, split

    def make(self, rest: str) -> bytes:
        if rest.isascii() or max(rest) <= LAST_LATIN:
            if rest.isalpha():  # remembered here alone; ASCII letters stand for themselves
                if rest.isascii():
                    return packed(self.words.kind, [t.id for t in self.words.merge(self.words.blank + rest)])
                return self.words.make(" " + rest)
            if rest[-1:] in {".", ","} and rest[:-1].isalpha():
                return self[rest[:-1]] + self.words[rest[-1]]
        return self.split(" " + rest)


def packed(kind: str, ids: list[int]) -> bytes:
    made = array(kind, ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


class Encoder:
    """Ids of whole texts as little-endian unsigned 16- or 32-bit integers, equal to `Tokenizer.encode(text,
    add_special_tokens=False)`.

    Merging never crosses the tokenizer's own word splits, and such a split always lies before a blank that another
    character than white space follows. So texts are cut there, and each distinct piece is merged once by the library's
    model and remembered. Pieces that hold a special token or letters beyond Latin are encoded by the library as they are.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 65_536 else "I"
        self.dtype = np.dtype("<u2" if self.kind == "H" else "<u4")
        self.words = _Words(self.tokenizer.model.tokenize, self.kind)
        self.pieces = _Pieces(self.words, self._split)

    def _whole(self, text: str) -> bytes:
        return packed(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _split(self, piece: str) -> bytes:
        if not piece.isascii() and max(piece) > LAST_LATIN or any(s in piece for s in self.special):
            return self._whole(piece)
        return b"".join(map(self.words.__getitem__, _WORD(piece)))

    def encode(self, text: str) -> bytes:
        if any(" " in s and s in text for s in self.special):
            return self._whole(text)
        if "  " in text or _SPACE_AFTER_BLANK(text) or text.endswith(" "):
            return b"".join(map(self._split, _CUT(text)))
        first, *rest = text.split(" ")  # every blank has another character than white space behind it
        return self._split(first) + b"".join(map(self.pieces.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker, with what it remembers."""
    return Encoder(path)


_WORD = regex.compile(PATTERN).findall
_SPACE_AFTER_BLANK = re.compile(r" \s").search
_CUT = re.compile(r"(?= \S)").split


# --- segments -------------------------------------------------------------------------------------------------------

def pack(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """One segment's bytes."""
    symbols, share = ans.frequencies(ids)
    blocks = ans.encode(ids, symbols, share)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = [struct.pack("<qqqq", len(doc_ids), len(ids), len(symbols), len(blocks)), known.tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(counts, "<i8").tobytes(),
            symbols.astype("<u4").tobytes(), share.astype("<u4").tobytes()]
    for block in blocks:
        head.append(struct.pack("<qqIq", block["n"], len(block["words"]), block["crc"], len(block["checkpoints"])))
        for offset, states in block["checkpoints"]:
            head.append(struct.pack("<q", offset) + states.astype("<u8").tobytes())
    directory = zlib.compress(b"".join(head), 1)
    return b"".join([MAGIC, struct.pack("<qI", len(directory), zlib.crc32(directory)), directory, *(b["words"] for b in blocks)])


def unpack(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, numbers of ids, all ids). Raises ValueError where a checksum does not fit."""
    if payload[:8] != MAGIC:
        raise ValueError("not a token segment")
    size, crc = struct.unpack_from("<qI", payload, 8)
    if zlib.crc32(payload[20:20 + size]) != crc:
        raise ValueError("the directory is damaged")
    head, at = zlib.decompress(payload[20:20 + size]), 32
    n_docs, n_ids, n_symbols, n_blocks = struct.unpack_from("<qqqq", head)

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(head, kind, n, at)
        at += got.nbytes
        return got

    known, doc_ids, counts = take("u1", n_docs), take("<i8", n_docs), take("<i8", n_docs)
    symbols, share = take("<u4", n_symbols), take("<u4", n_symbols).astype(np.int64)
    blocks, words = [], 20 + size
    for _ in range(n_blocks):
        n, length, crc, n_checkpoints = struct.unpack_from("<qqIq", head, at)
        at += struct.calcsize("<qqIq")
        checkpoints = [(int(take("<i8", 1)[0]), take("<u8", ans.LANES)) for _ in range(n_checkpoints)]
        blocks.append({"n": n, "words": payload[words:words + length], "crc": crc, "checkpoints": checkpoints})
        words += length
    ids = ans.decode(blocks, symbols, share)
    return [int(d) if k else None for k, d in zip(known, doc_ids)], counts, ids


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, segment: int = SEGMENT,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every text's ids and the end id, in ascending order of (id, hash of the text), nulls first; null texts are
    empty. Documents of one id may fall into several parts, which keep that order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        closing = np.array([end], coder.dtype).tobytes()
        part, number = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        counts: list[int] = []
        chunks: list[bytes] = []
        total = 0

        def segment_row() -> pa.RecordBatch:
            payload = pack(names, counts, np.frombuffer(b"".join(chunks), coder.dtype))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(names)], pa.int64()),
                 pa.array([total], pa.int64()), pa.array([payload], pa.binary())], ["part", "segment", "n_docs", "n_ids", "payload"])

        for piece in slices(batches):
            for name, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                ids = coder.encode(text or "") + closing
                names.append(name)
                counts.append(len(ids) // coder.dtype.itemsize)
                chunks.append(ids)
                total += counts[-1]
                if total >= segment:
                    yield segment_row()
                    names, counts, chunks, total, number = [], [], [], 0, number + 1
        if names:
            yield segment_row()

    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(run, SCHEMA).write.option("compression", "none").parquet(path))


def read(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every document of a file set: the ids of all documents before it, the
    number of its own, their checksum as little-endian unsigned 32-bit integers, and the ids. All ids are decoded in any
    case; without `with_ids` they stay in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "segment", "payload"))):
                names, counts, ids = unpack(payload)
                ends = np.cumsum(counts)
                wide = ids.astype("<u4")
                crcs = [zlib.crc32(wide[e - n:e]) for e, n in zip(ends.tolist(), counts.tolist())]
                rows = len(names)
                columns = [pa.array([part] * rows, pa.int32()), pa.array([number] * rows, pa.int32()), pa.array(names, pa.int64()),
                           pa.array(ends - counts), pa.array(counts), pa.array(crcs, pa.int64())]
                if with_ids:
                    edges = pa.array(np.concatenate(([0], ends)), pa.int32())
                    columns.append(pa.ListArray.from_arrays(edges, pa.array(wide.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [*fields, *extra])

    fields, extra = ["part", "segment", "id", "at", "n_tokens", "ids_crc32"], ["ids"] * with_ids
    files = spark.read.schema(SCHEMA).parquet(path)
    within = Window.partitionBy("part").orderBy("segment")
    sizes = files.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("all"))  # one row for each written part
    parts = parts.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("base"))
    starts = (sizes.withColumn("before", F.sum("n_ids").over(within) - F.col("n_ids")).join(parts, "part")
              .select("part", "segment", (F.col("base") + F.col("before")).alias("offset")))
    decoded = files.select("part", "segment", "payload").mapInArrow(
        run, "part int, segment int, id long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return (decoded.join(starts, ["part", "segment"])
            .select(F.col("id").alias(id_col), (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *extra))
