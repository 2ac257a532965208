"""Connected components of a link table, by randomised contraction."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Link tables of at most this many distinct links are finished in one task.
SMALL = 10_000


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b) and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = list(range(len(nodes)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)  # the smaller index is the smaller node
    return nodes, nodes[[root(x) for x in range(len(nodes))]]


def connect_lists(key: np.ndarray, near: Callable[[np.ndarray, np.ndarray], np.ndarray], short: int, at_once: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the same ``key`` (sorted) that connect what all near pairs of the key connect.
    ``near`` compares rows by their numbers, ``at_once`` of them in a call. Keys of up to ``short`` rows
    are compared pair by pair, together; in others each row is compared with those not reached yet, so
    a cluster costs about its size."""
    cuts = np.flatnonzero(np.diff(key)) + 1
    starts, ends = np.append(0, cuts)[: len(key)], np.append(cuts, len(key))[: len(key)]
    size = ends - starts
    a_all, b_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def compare(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.concatenate([near(a[k : k + at_once], b[k : k + at_once]) for k in range(0, len(b), at_once)] or [np.zeros(0, bool)])

    left = np.repeat(ends, size) - np.arange(len(key)) - 1  # rows of the same key that follow
    left[np.repeat(size > short, size)] = 0
    for d in range(1, int(left.max(initial=0)) + 1):
        x = np.flatnonzero(left >= d)
        x = x[compare(x, x + d)]
        a_all.append(x)
        b_all.append(x + d)
    for s, e in zip(starts[size > short].tolist(), ends[size > short].tolist()):
        todo, free = [], np.arange(s, e)
        while len(free) or todo:
            if not todo:
                todo, free = [int(free[0])], free[1:]
            q = todo.pop()
            found = compare(np.full(len(free), q), free)
            a_all.append(np.full(int(found.sum()), q))
            b_all.append(free[found])
            todo += free[found].tolist()
            free = free[~found]
    return np.concatenate(a_all), np.concatenate(b_all)


def _finish(links: pd.DataFrame) -> pd.DataFrame:
    nodes, least = union_find(links["a"].to_numpy(), links["b"].to_numpy())
    return pd.DataFrame({"node": nodes, "root": least})


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node of ``links`` the smallest node it reaches.

    Each round every node moves to the neighbour (or itself) with the least hash under that round's
    seed, which contracts any graph, chains and stars included, by a constant factor on average.
    Minima are aggregated before the shuffle, so hubs do not gather in a task. Once few links are
    left, one task ends the work. Null ends and loops are ignored; repeated links count once.
    """
    edges = stored(
        links.select(F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b"))
        .where("a is not null and b is not null and a < b")
        .distinct()
    )
    moves: list[DataFrame] = []
    last: DataFrame | None = None
    seed = 0
    while True:
        n = edges.count()
        if n <= SMALL:
            last = stored(edges.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(lambda pdf: _finish(pdf), "node long, root long"))
            break
        seed += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), F.col(c)).alias("h"), F.col(c).alias("id"))
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = stored(
            both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", rank("a")).getField("id").alias("to"))
        )
        moves.append(move)
        left = move.select(F.col("node").alias("a"), F.col("to").alias("p"))
        right = move.select(F.col("node").alias("b"), F.col("to").alias("q"))
        edges = stored(
            edges.join(left, "a").join(right, "b").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).where("a < b").distinct()
        )
    # Back through the rounds: where a node's successor ended is where the node ended.
    for move in reversed(moves):
        ended = last.select(F.col("node").alias("to"), F.col("root"))
        last = move.join(ended, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
        last = stored(last)
    least = stored(last.groupBy("root").agg(F.min("node").alias("least")))  # stored: the join below can then split a hot root
    return last.join(least, "root").select("node", F.least("least", "root").alias("component"))
