"""Removal of repeated word windows by repeated-phrase automata.

1. A window is keyed by the least hash of the ``ANCHOR``-word runs in it; consecutive windows with
   the same key are a stretch. Keys of one stretch alone cannot belong to a repeated window and are
   left out from here on, by a Bloom filter of bounded size; others that pass it cost work, not results.
2. Stretches are counted whole, and the windows of distinct stretches are counted one by one, both
   aggregated before the shuffle: what stands twice or more, in whatever texts, is confirmed.
3. Texts are dealt over shards by a hash. Each shard gets one place in its own texts of every
   confirmed stretch; these places form passages, which are cut into aligned blocks of about half a
   window and compiled into the shard's Aho-Corasick automaton over words (pyahocorasick). Blocks with the same
   words around them, a window's reach to either side, count once, so texts that repeat a phrase over
   and over stay linear.
4. Every text of the shard streams through the automaton. A hit is extended along its passage as far
   as the words agree, within a window's reach; agreement over a whole window or more is a repeat, and
   its words are removed. A window inside a passage holds a whole block, so no repeat is missed.

Windows are confirmed by 64-bit hashes: of n different windows about n * n / 2^65 pairs collide, for
10^13 some millions, and are taken for repeats. Windows are judged on the input. Defined cases: null and empty texts have no words and give an empty
text; texts shorter than a window lose nothing; repeated rows repeat each other's windows; rows
without a doc_id are treated like others; an empty table gives no rows; further columns are passed on
(a column named n_words or n_removed is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bloom import holds, key_filter
from .common import bounded_batches, spans, stored, utf8
from .textkernels import STEP, Words, mix, rolling, whole_starts

WIDTH = 35
ANCHOR = 8
#: Windows of one stretch at most; a longer one is cut, which changes no result.
STRETCH = 2048
#: Bytes of a shard's texts, on average; a longer text has a shard with little else.
SHARD_BYTES = 4 << 20
#: Windows at most in a stretch whose key stands in it once.
NEAR = WIDTH - ANCHOR + 1
SPAN = 1 << 20
U = np.uint64


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Stretches:
    """Stretches of the texts of a batch: their keys, texts, positions and windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int):
        words = Words(data, offsets)
        h = words.hashes()
        starts = whole_starts(words, width)
        anchor = min(ANCHOR, width)
        least = sliding_min(rolling(h, anchor), width - anchor + 1)[starts] if len(starts) else np.zeros(0, np.uint64)
        self.window = rolling(h, width)[starts]
        edge = np.ones(len(starts), bool)
        edge[1:] = (starts[1:] != starts[:-1] + 1) | (least[1:] != least[:-1])
        first = np.flatnonzero(edge)
        if len(first):
            since = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
            first = np.flatnonzero(since % STRETCH == 0)
        self.first = np.append(first, len(starts))
        self.key = least[first]
        self.text = np.searchsorted(words.first, starts[first], side="right") - 1
        self.pos = starts[first] - words.first[self.text]

    def weights(self) -> np.ndarray:
        """2 for a stretch in which a window stands twice, else 1."""
        size = np.diff(self.first)
        twice = np.zeros(len(size), bool)
        of = np.repeat(np.arange(len(size)), size)
        near = int(min(NEAR, size.max(initial=0)))
        for d in range(1, near):
            at = np.flatnonzero(self.window[:-d] == self.window[d:])
            twice[of[at[of[at] == of[at + d]]]] = True
        for k in np.flatnonzero(size > NEAR):  # longer than one place of the key allows
            part = self.window[self.first[k] : self.first[k + 1]]
            twice[k] |= len(np.unique(part)) < len(part)
        return 1 + twice.astype(np.int32)

    def identities(self) -> np.ndarray:
        """A hash of all windows of each stretch, in order."""
        if not len(self.key):
            return self.key
        size = np.diff(self.first)
        place = np.arange(len(self.window), dtype=np.uint64) - np.repeat(self.first[:-1], size).astype(np.uint64)
        return mix(np.add.reduceat(mix(self.window + place * STEP), self.first[:-1]) ^ size.astype(np.uint64))


def each_span(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, Stretches]]:
    data, offsets = utf8(batch.column(column))
    for a, b in spans(offsets, SPAN):
        yield a, Stretches(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)


def stretch_keys(texts: DataFrame, width: int) -> DataFrame:
    """key, weight of every stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, s in each_span(batch, 0, width):
                yield pa.RecordBatch.from_arrays([pa.array(s.key.view(np.int64)), pa.array(s.weights())], names=["key", "weight"])

    return texts.select("text").mapInArrow(run, "key long, weight int")


def stretch_rows(texts: DataFrame, width: int, packed: np.ndarray | None, with_windows: bool) -> DataFrame:
    """stretch (identity), row, shard, pos, n (windows) of the stretches whose keys the filter holds;
    their windows too, if asked for."""
    shared = texts.sparkSession.sparkContext.broadcast(packed)  # of at most 2 bytes for each of bloom.MOST keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, shard = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for a, s in each_span(batch, 0, width):
                use = np.arange(len(s.key)) if shared.value is None else np.flatnonzero(holds(shared.value, s.key))
                size = np.diff(s.first)[use]
                columns = [
                    pa.array(s.identities()[use].view(np.int64)),
                    pa.array(row[a + s.text[use]]),
                    pa.array(shard[a + s.text[use]]),
                    pa.array(s.pos[use].astype(np.int32)),
                    pa.array(size.astype(np.int32)),
                ]
                names = ["stretch", "row", "shard", "pos", "n"]
                if with_windows:
                    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                    take = np.repeat(s.first[:-1][use] - ends[:-1], size) + np.arange(ends[-1])
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(s.window[take].view(np.int64))))
                    names.append("windows")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "stretch long, row long, shard int, pos int, n int" + (", windows array<long>" if with_windows else "")
    return texts.select("text", "row", "shard").mapInArrow(run, schema)


def confirmed(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each shard and stretch with a repeated window: one place (row, pos), n, and which of its
    windows are repeated (``some``: their numbers, null: all)."""
    keys = stored(stretch_keys(texts, width).groupBy("key").agg(F.sum("weight").alias("w")).where("w > 1").select("key"))
    packed = key_filter(keys)
    found = stretch_rows(texts, width, packed, True).groupBy("stretch").agg(F.count(F.lit(1)).alias("times"), F.first("windows").alias("windows"))
    found = stored(found)
    counts = found.select("times", F.explode("windows").alias("window")).groupBy("window").agg(F.sum("times").alias("times")).where("times > 1")
    once = found.where("times = 1").select("stretch", F.posexplode("windows").alias("at", "window"))
    # Stored on both sides of the join, so that a window in very many stretches can be split among tasks.
    marked = stored(once.join(stored(counts.select("window")), "window").select("stretch", "at"))
    partly = marked.groupBy("stretch").agg(F.collect_list("at").alias("some"))
    whole = found.where("times > 1").select("stretch", F.lit(None).cast("array<int>").alias("some"))
    places = stretch_rows(texts, width, packed, False).groupBy("shard", "stretch").agg(F.min(F.struct("row", "pos", "n")).alias("p"))
    return stored(places.join(stored(whole.unionByName(partly)), "stretch").select("shard", "p.row", "p.pos", "p.n", "some"))


class Shard:
    """The texts of a shard, the automaton of its confirmed passages, and what to remove."""

    def __init__(self, words: Words, width: int):
        self.words, self.width = words, width
        self.h = words.hashes()
        self.letters = (self.h >> U(32)).astype(np.int64)
        self.block = (width + 1) // 2

    def compile(self, starts: np.ndarray) -> None:
        """Take the sorted numbers of repeated windows' first words and build the automaton."""
        cut = np.flatnonzero(np.diff(starts) > 1) + 1
        before = self.width - self.block
        self.places: list[list[tuple[int, int, int]]] = []  # by phrase: (at, words before it, words from it on)
        known: dict[tuple, int] = {}
        seen: set[tuple] = set()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for own in np.split(starts, cut):
            begin, end = int(own[0]), int(own[-1]) + self.width
            letters = self.letters[begin:end].tolist()
            for at in range(0, end - begin - self.block + 1, self.block):
                phrase = tuple(letters[at : at + self.block])
                back, ahead = min(at, before), min(end - begin - at, self.width)
                around = (back, self.h[begin + at - back : begin + at + ahead].tobytes())
                if around in seen:
                    continue
                seen.add(around)
                if phrase not in known:
                    known[phrase] = len(self.places)
                    self.places.append([])
                    self.automaton.add_word(phrase, known[phrase])
                self.places[known[phrase]].append((begin + at, back, ahead))
        self.automaton.make_automaton()

    def repeats(self, begin: int, end: int) -> list[tuple[int, int]]:
        """Spans of repeated words in the text whose words are ``begin:end``."""
        out: list[tuple[int, int]] = []
        h, block = self.h, self.block
        for last, phrase in self.automaton.iter(tuple(self.letters[begin:end].tolist())):
            p = begin + last - block + 1
            for at, back, ahead in self.places[phrase]:
                back, ahead = min(back, p - begin), min(ahead, end - p)
                if back + ahead < self.width:
                    continue
                same = h[p - back : p + ahead] == h[at - back : at + ahead]
                if same.all():
                    out.append((p - back, p + ahead))
                    continue
                left = back - 1 - int(np.flatnonzero(~same[:back])[-1]) if not same[:back].all() else back
                differ = np.flatnonzero(~same[back:])
                right = int(differ[0]) if len(differ) else ahead
                if left + right >= self.width and right >= block:
                    out.append((p - left, p + right))
        return out


def _remove(width: int, schema: T.StructType, untouched: bool):
    names = [f.name for f in schema]

    def run(key: tuple, docs: pa.Table, places: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        column = docs.column("text").combine_chunks() if docs.num_rows else pa.array([], pa.string())
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
        data, offsets = utf8(column)
        words = Words(data, offsets)
        gone = np.zeros(len(words), bool)
        if places.num_rows and docs.num_rows:
            at = {row: k for k, row in reversed(list(enumerate(docs.column(ROW).to_pylist())))}
            starts = []
            for row, pos, n, some in zip(*(places.column(c).to_pylist() for c in ("row", "pos", "n", "some"))):
                base = int(words.first[at[row]]) + pos
                starts.append(base + (np.arange(n) if some is None else np.array(some, np.int64)))
            shard = Shard(words, width)
            shard.compile(np.unique(np.concatenate(starts)))
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                if b - a >= width:
                    for x, y in shard.repeats(a, b):
                        gone[x:y] = True
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[words.first[1:]] - total[words.first[:-1]]
        kept = []
        for k, text in enumerate(column):
            text = text.as_py()
            if untouched and not removed[k]:
                kept.append(text)
            else:
                own = (text or "").encode("utf-8").split()
                if removed[k]:
                    own = [w for w, x in zip(own, gone[words.first[k] : words.first[k + 1]].tolist()) if not x]
                kept.append(b" ".join(own).decode("utf-8"))
        new = {"text": pa.array(kept, pa.string()), "n_words": pa.array(np.diff(words.first).astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64))}
        return pa.table([new[c] if c in new else docs.column(c) for c in names], names=names)

    return run


ROW, SHARD = "_repeats_row", "_repeats_shard"


def remove_repeats(docs: DataFrame, width: int = WIDTH, untouched: bool = False, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with the kept words of ``text``, joined by one blank, and n_words and n_removed.
    ``untouched``: a text that loses nothing stays as it is, white space included."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.drop("n_words", "n_removed").withColumn("text", F.col("text").cast("string"))
    shards = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes
    own = "doc_id" if "doc_id" in docs.columns else F.lit(0)
    row = F.xxhash64(own, "text")
    dealt = docs.withColumns({ROW: row, SHARD: F.pmod(row, F.lit(shards)).cast("int")})
    places = confirmed(dealt.select("text", F.col(ROW).alias("row"), F.col(SHARD).alias("shard")), width)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return dealt.groupBy(SHARD).cogroup(places.groupBy("shard")).applyInArrow(_remove(width, schema, untouched), schema)
