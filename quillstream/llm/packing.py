"""Best-fit packing of tokenised documents into sequences, with certified bin counts.

Each document's ids (by the tokenizers library) are cut into pieces of at most ``capacity`` tokens;
a document that is longer than that has its short piece first. Full pieces are sequences of their
own. The others are dealt over partitions by a hash and packed best-fit decreasing; a lower bound
from dual feasible functions certifies partitions that use the fewest sequences possible. Those with
a gap put their unfilled sequences' pieces into a pool, the pool is dealt anew and packed again. A
round that saves sequences takes the place of the one before; the rounds end when every partition is
certified, one partition holds the pool, or a round saves less than ``LEAST_GAIN`` of its sequences.
``certified`` tells of each piece whether its sequence is full or its partition has no gap.

Defined cases: null text is empty and gives one piece with the end id alone; repeated rows are
packed each; an empty table gives no rows; only ``doc_id`` and ``text`` are read, so further columns
with any names are harmless. Rows whose doc_id is null are packed too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunkcodec import ChunkTable, crc32, pack as packed_ids
from .common import bounded_batches, stored

CAPACITY = 2048
END_ID = 0
#: Pieces of one packing task, on average.
PIECES = 20_000
#: Share of its sequences that a round of exchange must save for another to follow.
LEAST_GAIN = 1e-4
#: Bits of a sequence's number within its partition and of the partition's; the round's are above.
BIN_BITS, PART_BITS = 24, 33

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECE_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
#: A blank that follows white space. The blank comes first in the pattern so that the search leaps
#: from blank to blank.
AFTER_SPACE = re.compile(r" (?<=\s )")
#: White space to Python only; the tokenizer takes it for symbols.
SEPARATORS = "\x1c", "\x1d", "\x1e", "\x1f"

_coders: dict[str, ChunkTable] = {}


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: itself where it is
    printable in Latin-1, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


def coder(path: str) -> ChunkTable:
    """This worker's chunk table for the byte-level tokenizer file at ``path``."""
    if path in _coders:
        return _coders[path]
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # Added tokens may stand anywhere in a text.
    marks = [*SEPARATORS, *(x.content for x in tokenizer.get_added_tokens_decoder().values())]
    model, letters = tokenizer.model, byte_letters()
    split = regex.compile(public_tokenizers.PATTERN)
    packed = [packed_ids([k]) for k in range(max(tokenizer.get_vocab().values()) + 1)]

    def unsafe(text: str) -> bool:
        """Whether a blank follows white space or white space begins or ends the text: the
        pre-tokenizer's white-space runs then reach over a blank. Marks are beyond the pieces."""
        return text[0].isspace() or text[-1].isspace() or any(m in text for m in marks) or AFTER_SPACE.search(text) is not None

    def whole(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    def parts(chunk: str) -> tuple[str, list[str]]:
        if chunk.isalpha():
            return chunk, []
        if chunk[-1:] in {".", ","} and chunk[:-1].isalpha():
            return chunk[:-1], [chunk[-1]]
        first, *rest = split.findall(" " + chunk)
        return first[1:], rest

    def encode(piece: str) -> bytes:
        return b"".join([packed[x.id] for x in model.tokenize(piece.encode("utf-8").decode("latin-1").translate(letters))])

    _coders[path] = ChunkTable(whole, parts, encode, unsafe)
    return _coders[path]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; all but the first of a long document are full."""
    head = total % capacity
    starts = ([(0, head)] if head else []) + [(k, capacity) for k in range(head, total, capacity)]
    return starts


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = coder(tokenizer)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packed = table.encode_text(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(packed) // 4, capacity)):
                    rows.append((doc, k, start, length, crc32(packed[4 * start : 4 * (start + length)])))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECE_ARROW)], schema=PIECE_ARROW)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECE)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size by best-fit decreasing. ``free`` has a bit for each free space
    that some bin has; the lowest bit at or above a size is the fullest bin that takes it."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    made = 0
    for k in order.tolist():
        size = int(sizes[k])
        fits = free >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                free &= ~(1 << room)
        else:
            room, at = capacity, made
            made += 1
        bins[k], offsets[k] = at, capacity - room
        room -= size
        if room:
            open_bins[room].append(at)
            free |= 1 << room
    return bins, offsets


def bin_bound(sizes: np.ndarray, capacity: int) -> int:
    """A lower bound of the bins that ``sizes`` need: the largest over dual feasible functions.

    The classes are the identity; u_k, which maps x to floor((k + 1) x / C) / k unless (k + 1) x / C
    is whole, then to x / C; and v_t, which maps x above C - t to 1, x below t to 0, others to x / C.
    """
    if not len(sizes):
        return 0
    counts = np.bincount(sizes, minlength=capacity + 1)
    x = np.arange(capacity + 1)
    best = -(-int((counts * x).sum()) // capacity)
    for k in range(1, 31):
        whole = ((k + 1) * x) % capacity == 0
        # over the common denominator k * capacity
        value = np.where(whole, k * x, ((k + 1) * x // capacity) * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    mass = np.concatenate([[0], np.cumsum(counts * x)])
    amount = np.concatenate([[0], np.cumsum(counts)])
    t = np.arange(1, capacity // 2 + 1)
    large = amount[capacity + 1] - amount[capacity - t + 1]
    middle = mass[capacity - t + 1] - mass[t]
    return max(best, int((large + -(-middle // capacity)).max()))


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, certified boolean, gap int"


def _packed(pdf: pd.DataFrame, capacity: int, base: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
    sizes = pdf["length"].to_numpy(np.int64)
    bins, offsets = best_fit(sizes, capacity)
    used = int(bins.max()) + 1 if len(bins) else 0
    gap = used - bin_bound(sizes, capacity)
    filled = np.bincount(bins, weights=sizes, minlength=used) == capacity
    pdf["sequence_id"] = base + bins
    pdf["offset"] = offsets
    pdf["certified"] = filled[bins] | (gap == 0)
    pdf["gap"] = gap
    return pdf


def _packer(capacity: int, number: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _packed(pdf, capacity, (number << (BIN_BITS + PART_BITS)) + (int(key[0]) << BIN_BITS)).drop(columns="part")

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, pieces_per_task: int = PIECES) -> DataFrame:
    """Add sequence_id, offset and certified to the rows of ``token_pieces``."""
    pieces = stored(pieces)
    full = pieces.where(F.col("length") == capacity)
    open_ = pieces.where(F.col("length") < capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    done: list[DataFrame] = []
    number, before, last = 0, None, None
    n = open_.count()
    while n:
        # Dealt by place in the stored table, so equal rows are parted.
        tasks = -(-n // pieces_per_task)
        part = F.pmod(F.xxhash64(F.lit(number), F.monotonically_increasing_id()), F.lit(tasks)).cast("int")
        placed = stored(open_.select(*columns, part.alias("part")).groupBy("part").applyInPandas(_packer(capacity, number), PLACED))
        used = placed.agg(F.countDistinct("sequence_id")).first()[0]
        if last is not None and used >= before:
            done.append(last)  # what it was made from stays
            break
        left = placed.where("not certified")
        gaps = left.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("sequence_id").alias("used"), F.countDistinct(F.shiftright("sequence_id", BIN_BITS)).alias("parts")).first()
        if gaps["parts"] < 2 or (last is not None and before - used < LEAST_GAIN * before) or number == 63:
            done.append(placed)  # one partition's rest packed alone again would give the same
            break
        done.append(placed.where("certified"))
        open_, last, before, n, number = left.select(*columns), left, gaps["used"], gaps["n"], number + 1
    own = full.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    for placed in done:
        own = own.unionByName(placed.drop("gap"))
    return own


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), capacity), capacity)
