"""Word-shingle Jaccard join by T-occurrence search with DivideSkip, and its components.

1. Documents with the same shingles are one class. Classes are posted under the contents of parts of
   their shingle sets, such that similar ones share a post (``agreement``). Posts are gathered by
   signature; what several documents of one Python task post is gathered before the shuffle, so a
   signature that very many copies post does not grow with them there.
2. Classes under one signature are compared by sketches, which rule out what cannot be similar;
   components of what is left are candidate families. Signatures with the same classes count once.
3. In a family every class is searched for in the inverted lists of the others: lists are divided
   into the longest, which are probed by binary search, and the rest, which are heap-merged with
   skips; what reaches the required overlap is compared exactly, and links are merged at once.
   A family beyond ``block`` shingles is dealt over blocks, each with the family's least class; then
   the classes outside the family's largest component so far are searched for in all its blocks.
4. Components of the links give each document the least doc_id that it reaches.

Defined cases: null and empty texts and texts without a word have no shingles and link with nothing;
texts of fewer words than a shingle have one shingle, all of their words; a row without a doc_id gets
its count and no component; rows that share a doc_id are one node; an empty table gives no rows;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .agreement import Scheme
from .chunkcodec import empty_tables
from .common import bounded_batches, release, spans, stored, utf8
from .components import components, connect_lists, union_find
from .textkernels import LOWER, Words, mix, windows

WIDTH = 3
#: Similarity in hundredths.
PERCENT = 90
SPAN = 1 << 20
#: Posts that a task gathers before it hands them on, and posts of a bucket, on average.
POSTS = 1_000_000
#: Classes of one signature that a task compares.
LIST = 50_000
#: Signatures with no more classes than this are compared together, pair by pair.
SHORT = 48
#: Shingles of a block of a family and of a search task, on average.
BLOCK = 500_000
#: DivideSkip's constant that balances probes against merges.
MU = 0.0085


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its shingles, A-Z lower-cased."""
    words = Words(LOWER[data], offsets)
    h = words.hashes()
    starts, values = windows(words, h, width)
    cuts = np.searchsorted(starts, words.first)
    sizes = np.diff(words.first)
    out = []
    for k, size in enumerate(sizes.tolist()):
        if size >= width:
            out.append(np.unique(values[cuts[k] : cuts[k + 1]]))
        elif size:
            whole = np.zeros(1, np.uint64)
            for x in h[words.first[k] : words.first[k + 1]]:
                whole = mix(whole + x)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def each_span(batch: pa.RecordBatch | pa.Table, column: str, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, shingle sets) of runs of rows."""
    texts = batch.column(column)
    for chunk_start, chunk in zip(np.cumsum([0, *map(len, texts.chunks)]), texts.chunks) if isinstance(texts, pa.ChunkedArray) else [(0, texts)]:
        data, offsets = utf8(chunk)
        for a, b in spans(offsets, SPAN):
            yield int(chunk_start) + a, shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)


def identity(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signed_sets(docs: DataFrame, scheme: Scheme, width: int) -> DataFrame:
    """doc_id, n (shingles), key (of the whole set, null if it is empty), halved (see ``Scheme``) and
    the sketches, with their bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, sets in each_span(batch, "text", width):
                sketches = scheme.sketches(sets)
                ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in sketches])]).astype(np.int32))
                flat = [x for row in sketches for x in row]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([identity(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array(scheme.needs(sets)),
                        pa.ListArray.from_arrays(ends, pa.array([x[0] for x in flat], pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array([x[1] for x in flat], pa.binary())),
                    ],
                    names=["doc_id", "n", "key", "halved", "bands", "sketches"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, key binary, halved int, bands array<int>, sketches array<binary>")


POSTED = pa.schema([("bucket", pa.int32()), ("known", pa.bool_()), ("n", pa.int32()), ("width", pa.int32()), ("base", pa.int64()), ("posts", pa.binary())])
MET = pa.schema([("signature", pa.int64()), ("band", pa.int32()), ("doc_id", pa.int64())])


def packed(bucket: int, known: bool, signature: np.ndarray, band: np.ndarray, doc: np.ndarray) -> tuple:
    """A row of ``POSTED``: signatures, bands and ids (over the least one, in as many bytes as they need)."""
    base = int(doc.min())
    over = (doc - base).astype("<u8")
    width = max(1, (int(over.max()).bit_length() + 7) // 8)
    ids = np.ascontiguousarray(over.view(np.uint8).reshape(-1, 8)[:, :width])
    return bucket, known, len(doc), width, base, signature.astype("<u8").tobytes() + band.tobytes() + ids.tobytes()


def unpacked(n: int, width: int, base: int, posts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    signature = np.frombuffer(posts, "<u8", n)
    band = np.frombuffer(posts, np.uint8, n, 8 * n)
    ids = np.zeros((n, 8), np.uint8)
    ids[:, :width] = np.frombuffer(posts, np.uint8, n * width, 9 * n).reshape(n, width)
    return signature, band, ids.view("<i8").ravel() + base


def posted(docs: DataFrame, scheme: Scheme, halved: dict[int, int], width: int, buckets: int) -> DataFrame:
    """The posts of all sets, gathered by ranges of signatures. Of the documents that post a signature
    in one go, the first is handed on to be met by others; all are marked as known to have met."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        signature, band, doc = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(signature, kind="stable")
        signature, band, doc = signature[order], band[order], doc[order]
        first = np.ones(len(signature), bool)
        first[1:] = signature[1:] != signature[:-1]
        run = np.cumsum(first) - 1
        several = (np.bincount(run) > 1)[run]
        own = ((signature[first] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(own)) + 1
        lead = (signature[first], band[first], doc[first])
        rows = [packed(int(own[a]), False, *(x[a:b] for x in lead)) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)])]
        signature, band, doc = signature[several], band[several], doc[several]
        to = (mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)  # any even deal does
        order = np.argsort(to, kind="stable")
        to, signature, band, doc = to[order], signature[order], band[order], doc[order]
        cuts = np.flatnonzero(np.diff(to)) + 1
        if len(to):
            rows += [packed(int(to[a]), True, signature[a:b], band[a:b], doc[a:b]) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(to)])]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), POSTED)], schema=POSTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_tables()
        held: list[tuple] = []
        size = 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, sets in each_span(batch, "text", width):
                signature, band, at = scheme.posts(sets, halved)
                if len(at):
                    held.append((signature, band, ids[a + at]))
                    size += len(at)
                if size >= POSTS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return docs.mapInArrow(run, "bucket int, known boolean, n int, width int, base long, posts binary")


def _meet(rows: pa.Table) -> pa.Table:
    """The posts of a bucket whose signature several documents have."""
    known, open_ = [], []
    for row in rows.to_pylist():
        (known if row["known"] else open_).append(unpacked(row["n"], row["width"], row["base"], row["posts"]))
    out = known
    if open_:
        signature, band, doc = (np.concatenate(x) for x in zip(*open_))
        order = np.argsort(signature, kind="stable")
        signature, band, doc = signature[order], band[order], doc[order]
        first = np.ones(len(signature), bool)
        first[1:] = signature[1:] != signature[:-1]
        at = np.flatnonzero(first)
        met = (np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at))[np.cumsum(first) - 1]
        out = [*known, (signature[met], band[met], doc[met])]
    signature, band, doc = (np.concatenate(x) for x in zip(*out))
    return pa.table([pa.array(signature.view(np.int64)), pa.array(band.astype(np.int32)), pa.array(doc)], schema=MET)


def _sketched(percent: int):
    """Pairs of classes of one signature that sketches do not part, as links that connect the same."""

    def run(rows: pa.Table) -> pa.Table:
        scheme = Scheme(percent)
        a_all, b_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        band_of = rows.column("band").to_numpy()
        for band in np.unique(band_of).tolist():
            part = rows.filter(pa.array(band_of == band)).sort_by("signature")
            node, n = part.column("rep").to_numpy(), part.column("n").to_numpy()
            sketch = np.frombuffer(b"".join(part.column("sketch").to_pylist()), "<u8").reshape(len(node), -1)
            near = lambda x, y: scheme.may_link(sketch[x], sketch[y], n[x], n[y])
            x, y = connect_lists(part.column("signature").to_numpy(), near, SHORT, max(1, (4 << 20) // sketch.shape[1]))
            a_all.append(node[x])
            b_all.append(node[y])
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        apart = a != b
        node, root = union_find(a[apart], b[apart])
        return pa.table({"a": node[node != root], "b": root[node != root]})

    return run


class Lists:
    """Inverted lists over some sets: by shingle the sorted numbers of the sets that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        shingle = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(shingle, kind="stable")
        shingle, owner = shingle[order], owner[order]
        self.keys, first = np.unique(shingle, return_index=True)
        self.first = np.append(first, len(shingle))
        self.owner = owner.tolist()
        self.sizes = [len(x) for x in sets]

    def search(self, query: np.ndarray, below: int | None, percent: int, known=lambda s: False) -> Iterator[int]:
        """Numbers (under ``below``, if given) of the sets whose Jaccard with ``query`` is enough;
        those that are ``known`` are passed over."""
        n = len(query)
        need = -(-percent * n // 100)
        at = np.searchsorted(self.keys, query)
        inside = at < len(self.keys)
        at, query = at[inside], query[inside]
        at = at[self.keys[at] == query]  # an absent shingle is placed at the next key
        owner = self.owner
        lists = []  # (length, begin, end) in self.owner
        for a, b in zip(self.first[at].tolist(), self.first[at + 1].tolist()):
            if below is not None:
                b = bisect_left(owner, below, a, b)
            if a < b:
                lists.append((b - a, a, b))
        if len(lists) < need:
            return
        lists.sort(reverse=True)
        long = min(need - 1, int(need / (MU * log2(lists[0][0] + 1) + 1)))
        probed, merged = lists[:long], lists[long:]
        short = need - long
        ends = [b for _, _, b in merged]
        place = [a for _, a, _ in merged]
        heap = [(owner[a], k) for k, a in enumerate(place)]
        heapify(heap)
        while heap:
            s = heap[0][0]
            popped = []
            while heap and heap[0][0] == s:
                popped.append(heappop(heap)[1])
            if len(popped) >= short:
                if not known(s):
                    m = self.sizes[s]
                    total = -(-percent * (n + m) // (100 + percent))  # the overlap that this pair needs
                    seen, left = len(popped), len(probed)
                    for _, a, b in probed:
                        if seen + left < total:
                            break
                        left -= 1
                        p = bisect_left(owner, s, a, b)
                        seen += p < b and owner[p] == s
                    if seen + left >= total and 100 * seen >= percent * (n + m - seen):
                        yield s
                for k in popped:
                    place[k] += 1
            else:
                while heap and len(popped) < short - 1:
                    popped.append(heappop(heap)[1])
                if not heap:
                    return
                for k in popped:
                    place[k] = bisect_left(owner, heap[0][0], place[k], ends[k])
            for k in popped:
                if place[k] < ends[k]:
                    heappush(heap, (owner[place[k]], k))


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int = PERCENT, known: tuple[list, list] | None = None) -> list[tuple[int, int]]:
    """Links that join what similarity joins: among ``left``, or between it and ``right`` if given;
    numbers of ``right`` count on from those of ``left``. Sets with the same ``known`` are joined already."""
    lists = Lists(left)
    total = len(left) + len(right or [])
    up = list(range(total))
    if known:
        first: dict = {}
        up = [first.setdefault(x, k) for k, x in enumerate([*known[0], *known[1]])]

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for k, query in enumerate(left if right is None else right):
        me = k if right is None else len(left) + k
        for s in lists.search(query, k if right is None else None, percent, lambda s: root(s) == root(me)):
            out.append((s, me))
            up[root(me)] = root(s)
    return out


def _own_sets(rows: pa.Table, width: int) -> tuple[list[np.ndarray], pa.Table]:
    """Sets and rows of each class once; a row whose text isn't that of its class is left out."""
    rows = rows.sort_by([("rep", "ascending"), ("key", "ascending")])
    keys, reps = rows.column("key").to_pylist(), rows.column("rep").to_pylist()
    sets, take, seen = [], [], set()
    for a, some in each_span(rows, "text", width):
        for k, s in enumerate(some, a):
            if (reps[k], keys[k]) not in seen and identity(s) == keys[k]:
                seen.add((reps[k], keys[k]))
                sets.append(s)
                take.append(k)
    return sets, rows.take(pa.array(take, pa.int64()))


def _families(rows: pa.Table) -> Iterator[pa.Table]:
    family = rows.column("family").to_numpy()
    for one in np.unique(family).tolist():
        yield rows.filter(pa.array(family == one))


def _search(width: int, percent: int):
    def run(rows: pa.Table) -> pa.Table:
        a, b = [], []
        for family in _families(rows):
            sets, own = _own_sets(family, width)
            node = own.column("rep").to_pylist()
            for x, y in linked(sets, None, percent):
                a.append(node[x])
                b.append(node[y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _search_others(width: int, percent: int):
    def run(rows: pa.Table) -> pa.Table:
        asked = rows.column("asked").to_numpy(zero_copy_only=False)
        (left, one), (right, two) = (_own_sets(rows.filter(pa.array(side)), width) for side in (~asked, asked))
        if not left or not right:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        node = one.column("rep").to_pylist() + two.column("rep").to_pylist()
        found = linked(left, right, percent, (one.column("joined").to_pylist(), two.column("joined").to_pylist()))
        return pa.table({"a": pa.array([node[x] for x, _ in found], pa.int64()), "b": pa.array([node[y] for _, y in found], pa.int64())})

    return run


def candidates(docs: DataFrame, signed: DataFrame, classes: DataFrame, scheme: Scheme, width: int, paths: list[str]) -> DataFrame:
    """(node, component): candidate families of class representatives."""
    spark = docs.sparkSession
    size = signed.agg(F.sum("n")).first()[0] or 0
    own_band = signed.where("halved > 0").groupBy(F.element_at("bands", 1).alias("band")).agg(F.max("halved").alias("times"))
    halved = {r["band"]: r["times"] for r in own_band.collect()}  # a row for a band at most
    buckets = int(size // (2 * POSTS)) + 1
    posts = posted(docs.where("doc_id is not null"), scheme, halved, width, buckets)
    met = posts.groupBy("bucket").applyInArrow(_meet, "signature long, band int, doc_id long")
    reps = signed.where("key is not null and doc_id is not null").select("doc_id", "key").join(classes.select("key", "rep"), "key").select("doc_id", "rep")
    met = stored(met.join(reps, "doc_id").select("signature", "band", "rep").distinct(), paths)
    place = ["signature", "band"]
    lists = met.groupBy(*place).agg(F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("rep")).alias("h"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("g"))
    lists = stored(lists.where("members > 1").groupBy("band", "members", "h", "g").agg(F.min("signature").alias("signature")), paths)
    sketch = classes.select("rep", "n", F.explode(F.arrays_zip("bands", "sketches")).alias("s")).select("rep", "n", F.col("s.bands").alias("band"), F.col("s.sketches").alias("sketch"))
    rows = met.join(lists.select(*place, "members"), place).join(sketch, ["rep", "band"])
    blocks = F.ceil(F.col("members") / LIST).cast("int")
    tasks = max(1, int((lists.agg(F.sum("members")).first()[0] or 0) // LIST))
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"large": F.col("blocks") > 1, "i": F.least("block", "with"), "j": F.greatest("block", "with")})
    rows = rows.withColumn("task", F.when(F.col("large"), F.col("signature")).otherwise(F.pmod(F.xxhash64("signature"), F.lit(tasks))))
    key = ["large", "task", "i", "j"]
    pairs = rows.select(*key, *place, "rep", "n", "sketch").groupBy(*key).applyInArrow(_sketched(scheme.percent), "a long, b long")
    return components(pairs)


def links_of(docs: DataFrame, classes: DataFrame, families: DataFrame, width: int, percent: int, block: int, paths: list[str]) -> DataFrame:
    """Links (a, b) between class representatives that connect all similar ones."""
    members = stored(families.select(F.col("node").alias("rep"), F.col("component").alias("family")).join(classes.select("rep", "key", "n"), "rep"), paths)
    sizes = members.groupBy("family").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"), F.sum("n").alias("size"))
    tasks = max(1, int((members.agg(F.sum("n")).first()[0] or 0) // block))
    members = members.join(stored(sizes, paths), "family").withColumn("block", F.pmod(F.xxhash64("rep", "key"), F.col("blocks")).cast("int"))
    members = members.withColumn("task", F.when(F.col("blocks") > 1, F.col("family")).otherwise(F.pmod(F.xxhash64("family"), F.lit(tasks))))
    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(members.select("rep").distinct(), "rep").dropDuplicates(["rep", "text"])
    held = stored(members.join(texts, "rep"), paths)
    # The least class of a family of several blocks goes to all of them.
    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = held.withColumn("block", F.explode(F.when(F.col("rep") == F.col("family"), all_blocks).otherwise(F.array("block"))))
    group = [(F.col("blocks") > 1).alias("large"), "task", "block"]
    links = stored(dealt.groupBy(*group).applyInArrow(_search(width, percent), "a long, b long"), paths)
    several = held.where("blocks > 1")
    if several.isEmpty():
        return links
    joined = components(links).select(F.col("node").alias("rep"), "component")
    several = stored(several.join(joined, "rep", "left").withColumn("joined", F.coalesce("component", "rep")).drop("component"), paths)
    parts = several.groupBy("family", "joined").agg(F.sum("n").alias("part"))
    base = parts.groupBy("family").agg(F.max_by("joined", F.struct("part", "joined")).alias("base"), F.sum("part").alias("whole"), F.max("part").alias("most"))
    base = stored(base.where("whole > most").select("family", "base", F.ceil((F.col("whole") - F.col("most")) / block).cast("int").alias("turns")), paths)
    rows = several.join(base, "family")
    asked = rows.where("joined <> base").withColumn("turn", F.pmod(F.xxhash64("key"), F.col("turns")).cast("int")).withColumn("block", F.explode(all_blocks)).withColumn("asked", F.lit(True))
    held_in = rows.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).withColumn("asked", F.lit(False))
    columns = ["family", "block", "turn", "asked", "rep", "key", "joined", "text"]
    more = asked.select(columns).unionByName(held_in.select(columns)).groupBy("family", "block", "turn").applyInArrow(_search_others(width, percent), "a long, b long")
    return links.unionByName(stored(more, paths))


def join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scheme, paths = Scheme(percent), []
    signed = stored(signed_sets(docs, scheme, width))
    known = signed.where("key is not null and doc_id is not null")
    # All rows of a class have the same sketches.
    classes = stored(known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketches").alias("sketches")), paths)
    links = links_of(docs, classes, candidates(docs, signed, classes, scheme, width, paths), width, percent, block, paths)
    nodes = signed.select("doc_id", "n", "key")
    rows = stored(nodes.where("key is not null").join(classes.select("key", "rep"), "key", "left"))
    # A doc_id with several texts joins their classes.
    twice = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most").select("doc_id")
    same = rows.join(twice, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    joined = stored(components(links.unionByName(same)).withColumnRenamed("node", "rep"))
    release(docs.sparkSession, paths)
    out = rows.join(joined, "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"))
    return out.unionByName(nodes.where("key is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
