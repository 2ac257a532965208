"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is parsed here; from it the normaliser (character map, extra white space,
the marker for blanks, the marker in front), the model (unigram scores, or merges ranked by the
scores of what they make) and byte fallback are rebuilt as a tokenizers pipeline. Texts are encoded
by blank-separated chunks in multithreaded batches of the chunks a worker has not met, where no piece
of the vocabulary reaches over a blank and the normaliser changes nothing; else whole. Every batch of
chunks and every whole text is also encoded by the sentencepiece library; ``parity`` tells whether
all of a text's parts agreed. That is the whole text's parity: where no piece reaches over a blank,
neither library can merge over one, so each gives a text the ids of its chunks.

Every text's ids are decoded as a whole: the decoder's steps work on the bytes of the pieces, stated
once for each piece. Ids whose bytes are no UTF-8 (broken runs of byte pieces) or that the vocabulary
does not have are decoded by the tokenizers library, whose rules these are.

Defined cases: null text is empty, with no ids; texts with several blanks in a row, blanks at an end
or the marker itself are encoded whole; repeated rows are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunkcodec import crc32, pack
from .common import bounded_batches

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
#: Texts in which blanks make runs or stand at an end, or that hold the marker itself, which merges with that of a blank.
RUNS = re.compile(rf"  |^ | $|{MARK}")
#: Pieces that the tokenizers library's byte fallback decodes to a byte, whatever their kind.
BYTE_PIECE = re.compile("<0x[+0-9A-Fa-f][0-9A-Fa-f]>")
#: Chunks that a worker keeps, some 250 bytes each, 175 MB.
CHUNKS = 700_000
KEPT_CHARS = 48


def wire(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; numbers for varints, bytes for the rest."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class ModelFile:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    character_map: bytes = b""
    dummy_prefix: bool = True
    collapse: bool = True
    escape: bool = True

    @staticmethod
    def parse(data: bytes) -> ModelFile:
        out = ModelFile()
        for number, value in wire(data):
            if number == 1:
                piece = dict(wire(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                out.pieces.append((piece[1].decode("utf-8"), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(wire(value))
                out.kind = trainer.get(3, UNIGRAM)
                out.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                normaliser = dict(wire(value))
                out.character_map = normaliser.get(2, b"")
                out.dummy_prefix = bool(normaliser.get(3, 1))
                out.collapse = bool(normaliser.get(4, 1))
                out.escape = bool(normaliser.get(5, 1))
        out.unknown = next((k for k, p in enumerate(out.pieces) if p[2] == UNKNOWN), 0)
        return out

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, best score first."""
        rank = {piece: k for k, (piece, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        found = []
        for piece, k in rank.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in rank and right in rank:
                    found.append((-self.pieces[k][1], rank[left], rank[right], left, right))
        return [(left, right) for *_, left, right in sorted(found)]

    def reaches_over_blank(self) -> bool:
        return any(MARK in piece.lstrip(MARK) for piece, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED))

    def tokenizer(self):
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        if self.kind == BPE:
            vocabulary = {piece: k for k, (piece, _, _) in enumerate(self.pieces)}
            model = models.BPE(vocabulary, self.merges(), unk_token=self.pieces[self.unknown][0], fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            model = models.Unigram([(piece, score) for piece, score, _ in self.pieces], self.unknown, self.byte_fallback)
        tokenizer = Tokenizer(model)
        steps = []
        if self.character_map:
            steps.append(normalizers.Precompiled(self.character_map))
        if self.collapse:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        tokenizer.normalizer = normalizers.Sequence(steps)
        ends = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        tokenizer.decoder = decoders.Sequence(ends + ([decoders.Strip(" ", 1, 0)] if self.dummy_prefix else []))
        return tokenizer


def piece_bytes(piece: str | None) -> bytes:
    """What the decoder makes of a piece before the marker in front goes: a byte, or its text with blanks for markers."""
    if piece and BYTE_PIECE.fullmatch(piece):
        return bytes([int(piece[3:5], 16)])
    return (piece or "").replace(MARK, " ").encode()


class Codec:
    """Encoder and decoder of one model file, with the chunks it has met."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as source:
            self.file = ModelFile.parse(source.read())
        self.tokenizer = self.file.tokenizer()
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self.by_chunk = self.file.dummy_prefix and not self.file.character_map and not self.file.collapse and not self.file.reaches_over_blank()
        self.known: dict[str, tuple[bytes, bool]] = {}
        self.pieces = [piece_bytes(self.tokenizer.id_to_token(k)) for k in range(len(self.file.pieces))]
        self.front = b" " if self.file.dummy_prefix else b""

    def batch(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """(ids, parity) of whole texts, by the library's threads."""
        got = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [(pack(a), a == b) for a, b in zip(got, self.reference.encode(texts, num_threads=1))]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """(ids as little-endian unsigned 32-bit numbers, parity) of each text."""
        whole = [k for k, x in enumerate(texts) if x and (not self.by_chunk or RUNS.search(x))]
        out: list = [(b"", True)] * len(texts)
        for k, found in zip(whole, self.batch([texts[k] for k in whole]) if whole else []):
            out[k] = found
        rest = sorted({*range(len(texts))} - {*whole})
        chunks = {k: texts[k].split(" ") for k in rest if texts[k]}
        known = self.known
        # A chunk in the text is the marker and itself, and so is a text that is that chunk alone.
        missing = list({x: 0 for parts in chunks.values() for x in parts if x not in known})
        fresh = dict(zip(missing, self.batch(missing))) if missing else {}
        for k, parts in chunks.items():
            found = [known.get(x) or fresh[x] for x in parts]
            out[k] = (b"".join([x[0] for x in found]), all([x[1] for x in found]))
        if len(known) < CHUNKS:
            known.update((x, v) for x, v in fresh.items() if len(x) <= KEPT_CHARS)
        return out

    def decode(self, packed: list[bytes]) -> list[str]:
        ids = [np.frombuffer(x, "<u4").tolist() for x in packed]
        out, rest = [""] * len(ids), []
        for k, own in enumerate(ids):
            try:
                out[k] = b"".join(map(self.pieces.__getitem__, own)).removeprefix(self.front).decode()
            except (UnicodeDecodeError, IndexError):
                rest.append(k)
        for k, text in zip(rest, self.tokenizer.decode_batch([ids[k] for k in rest], skip_special_tokens=False) if rest else []):
            out[k] = text
        return out


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``docs`` with ids (binary: little-endian unsigned 32-bit) and parity."""
    bounded_batches(docs.sparkSession)
    path = model or default_model()

    @F.pandas_udf("ids binary, parity boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(codec(path).encode(texts.fillna("").tolist()), columns=["ids", "parity"])

    return docs.drop("ids", "parity").withColumn("_e", run(F.col("text").cast("string"))).select("*", "_e.ids", "_e.parity").drop("_e")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` with decoded, the text of its ids."""
    bounded_batches(encoded.sparkSession)
    path = model or default_model()

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        return pd.Series(codec(path).decode([x or b"" for x in ids]))

    return encoded.drop("decoded").withColumn("decoded", run("ids"))


def summary(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, parity, round_trip (decoding gives the text back), in one pass."""
    bounded_batches(docs.sparkSession)
    path = model or default_model()
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("parity", pa.bool_()), ("round_trip", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                texts = [x or "" for x in part.column(1).to_pylist()]
                found = own.encode(texts)
                packed = [x for x, _ in found]
                same = [x == y for x, y in zip(own.decode(packed), texts)]
                columns = [part.column(0), [len(x) // 4 for x in packed], [crc32(x) for x in packed], [y for _, y in found], same]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean")
