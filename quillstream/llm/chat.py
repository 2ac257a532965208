"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn and then user and assistant in turn, ending with the
assistant. A dynamic programme over that automaton chooses for every turn the role it gets (another
than its own costs ``RELABEL``, an unknown one ``UNKNOWN_ROLE``) and whether it continues the turn
before it (``MERGE``) or follows it, with an empty turn in between where the automaton asks for one
(``INSERT``). Among repairs of least cost, the one that is least in (cost, role order) from the end
backwards is used, so results are the same wherever a conversation is cut.

A conversation of any length is spread over tasks: turns are ranged by conversation and turn, a part
of a conversation yields its 4 x 4 table of least costs from state to state, tables of a conversation
are chained (one row for each part), and each part is then traced back between the states it got.

Output, one row per input turn: conv_id, turn, role, new_role, action (keep, relabel, merge,
merge_relabel), inserted (empty turns put before it, and after it at the end), cost, and ``piece``:
the pieces of a conversation in (turn, role, text) order, joined, are its rendered text.

Defined cases: a null text renders as empty; null and other roles than the three (after trimming and
lower-casing) are unknown; rows with a null conv_id form one conversation; turns with the same number
are ordered by role, then text; repeated rows are turns of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

ROLES = ("system", "user", "assistant")
NONE, SYSTEM, USER, ASSISTANT = range(4)
MERGE, UNKNOWN_ROLE, RELABEL, INSERT = 1, 1, 2, 3
INF = 1 << 40
#: From a state, the states that may follow.
NEXT = {NONE: {SYSTEM, USER}, SYSTEM: {USER}, USER: {ASSISTANT}, ASSISTANT: {USER}}
#: Turns of a part, on average.
PART = 5000


def bridge(state: int, role: int) -> tuple[int, tuple[int, ...]] | None:
    """Cost and empty turns with which ``role`` follows ``state`` as a new turn."""
    if role in NEXT[state]:
        return 0, ()
    for between in sorted(NEXT[state]):
        if role in NEXT[between] and between != SYSTEM:
            return INSERT, (between,)
    return None


def _moves() -> dict[int, list[tuple[int, int, int, str, tuple[int, ...]]]]:
    """By role number (0: unknown): (from, to, cost, action, empty turns)."""
    out: dict[int, list] = {}
    for own in range(4):
        out[own] = []
        for state in range(4):
            for role in (SYSTEM, USER, ASSISTANT):
                change = 0 if own == role else UNKNOWN_ROLE if own == 0 else RELABEL
                if role == state:
                    out[own].append((state, role, change + MERGE, "merge_relabel" if change else "merge", ()))
                found = bridge(state, role)
                if found:
                    out[own].append((state, role, change + found[0], "relabel" if change else "keep", found[1]))
    return out


MOVES = _moves()


def table_of(own: int) -> np.ndarray:
    t = np.full((4, 4), INF, np.int64)
    for a, b, cost, _, _ in MOVES[own]:
        t[a, b] = min(t[a, b], cost)
    return t


TABLES = [table_of(k) for k in range(4)]
#: Cost of ending in a state: a user or system turn that ends a conversation gets empty turns after it.
ENDING = {NONE: (0, ()), SYSTEM: (2 * INSERT, (USER, ASSISTANT)), USER: (INSERT, (ASSISTANT,)), ASSISTANT: (0, ())}


def chained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (min, +) product of two tables."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), INF)


def role_number(role: object) -> int:
    name = role.strip().lower() if isinstance(role, str) else ""
    return ROLES.index(name) + 1 if name in ROLES else 0


def _runs(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Consecutive rows of the same (part, conv_id), over batches."""
    held: list[pd.DataFrame] = []
    at: tuple | None = None
    for pdf in batches:
        conv = pdf["conv_id"].astype("Int64")
        key = pd.DataFrame({"p": pdf["part"].to_numpy(), "c": conv.fillna(0).to_numpy(np.int64), "n": conv.isna().to_numpy()})
        cut = np.flatnonzero((key != key.shift()).any(axis=1).to_numpy())
        for a, b in zip(cut, [*cut[1:], len(pdf)]):
            own = (int(key["p"].iloc[a]), None if key["n"].iloc[a] else int(key["c"].iloc[a]))
            if own != at and held:
                yield at, pd.concat(held, ignore_index=True)[columns]
                held = []
            at = own
            held.append(pdf.iloc[a:b])
    if held:
        yield at, pd.concat(held, ignore_index=True)[columns]


def _tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = []
    for (part, conv), pdf in _runs(batches, ["role"]):
        costs = np.where(np.eye(4, dtype=bool), 0, INF)
        for role in pdf["role"]:
            costs = chained(costs, TABLES[role_number(role)])
        rows.append((conv, part, costs.ravel().tolist()))
        if len(rows) == 2000:
            yield pd.DataFrame(rows, columns=["conv_id", "part", "costs"]).astype({"conv_id": "Int64"})
            rows = []
    yield pd.DataFrame(rows, columns=["conv_id", "part", "costs"]).astype({"conv_id": "Int64"})


def _forward(pdf: pd.DataFrame) -> pd.DataFrame:
    """Least costs at the start of each part, and the state in which its conversation ends."""
    out = []
    for conv, own in pdf.groupby("conv_id", dropna=False, sort=False):
        own = own.sort_values("part")
        reach = [np.array([0, INF, INF, INF], np.int64)]
        for x in own["costs"]:
            reach.append(np.minimum((reach[-1][:, None] + np.array(x, np.int64).reshape(4, 4)).min(axis=0), INF))
        end = int((reach[-1] + np.array([ENDING[s][0] for s in range(4)])).argmin())
        n = len(own)
        out += [(conv, int(part), reach[k].tolist(), n, k == n - 1, end) for k, part in enumerate(own["part"])]
    return pd.DataFrame(out, columns=["conv_id", "part", "reach", "parts", "last", "end"]).astype({"conv_id": "Int64"})


def _backward(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state in which each part ends, from the last part to the first."""
    out = []
    for conv, own in pdf.groupby("conv_id", dropna=False, sort=False):
        own = own.sort_values("part", ascending=False)
        state = int(own["end"].iloc[0])
        for part, begins in zip(own["part"], own["begins"]):
            out.append((conv, int(part), state))
            state = int(begins[state])
    return pd.DataFrame(out, columns=["conv_id", "part", "finish"]).astype({"conv_id": "Int64"})


def trace(roles: list[int], reach: list[int], finish: int) -> tuple[int, list[tuple[int, int, str, tuple[int, ...]]]]:
    """The state before the turns, and (role, cost, action, empty turns before it) of each, on the path
    of least cost to ``finish``. Of equals the least state is taken, from the last turn back."""
    costs = [list(reach)]
    for own in roles:
        now = [INF] * 4
        for a, b, cost, _, _ in MOVES[own]:
            now[b] = min(now[b], costs[-1][a] + cost)
        costs.append(now)
    out, state = [], finish
    for k in range(len(roles) - 1, -1, -1):
        a, _, cost, action, between = min((m for m in MOVES[roles[k]] if m[1] == state), key=lambda m: (costs[k][m[0]] + m[2], m[0]))
        out.append((state, cost, action, between))
        state = a
    return state, out[::-1]


def _begins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each part and each state it may end in, the state it then begins in."""
    rows = []
    for (part, conv), pdf in _runs(batches, ["role", "reach"]):
        roles = [role_number(r) for r in pdf["role"]]
        rows.append((conv, part, [trace(roles, pdf["reach"].iloc[0], s)[0] if s != NONE else NONE for s in range(4)]))
    yield pd.DataFrame(rows, columns=["conv_id", "part", "begins"]).astype({"conv_id": "Int64"})


def head(role: int) -> str:
    return f"<|{ROLES[role - 1]}|>\n"


END = "<|end|>\n"


def _render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for (_, conv), pdf in _runs(batches, ["turn", "role", "text", "reach", "finish", "last"]):
        state, chosen = trace([role_number(r) for r in pdf["role"]], pdf["reach"].iloc[0], int(pdf["finish"].iloc[0]))
        rows = []
        for k, (role, cost, action, between) in enumerate(chosen):
            text = pdf["text"].iloc[k]
            piece, inserted = "", len(between)
            for empty in between:
                piece += (END if state != NONE else "") + head(empty)
                state = empty
            if action.startswith("merge"):
                piece += "\n"
            else:
                piece += (END if state != NONE else "") + head(role)
            piece += text if isinstance(text, str) else ""
            state = role
            if k == len(chosen) - 1 and pdf["last"].iloc[0]:
                extra, after = ENDING[role]
                piece += "".join(END + head(x) for x in after) + END
                cost, inserted = cost + extra, inserted + len(after)
            rows.append((conv, pdf["turn"].iloc[k], pdf["role"].iloc[k], ROLES[role - 1], action, inserted, cost, piece))
        yield pd.DataFrame(rows, columns=["conv_id", "turn", "role", "new_role", "action", "inserted", "cost", "piece"]).astype({"conv_id": "Int64", "turn": "Int64"})


def repair(turns: DataFrame, part: int = PART) -> DataFrame:
    """The repaired and rendered turns of the conversations in ``turns``."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    n = max(1, -(-rows.count() // part))
    # Rows that are alike may be parted too: which of them goes where changes nothing.
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, *order, "tie").drop("tie")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()))
    by_part = lambda df: df.repartition(n, "part").sortWithinPartitions("part", *[c for c in order if c in df.columns])
    costs = by_part(ranged.select("conv_id", "turn", "role", "part")).mapInPandas(_tables, "conv_id long, part int, costs array<long>")
    bundle = F.pmod(F.xxhash64("conv_id"), F.lit(n)).alias("bundle")
    states = stored(costs.groupBy(bundle).applyInPandas(_forward, "conv_id long, part int, reach array<long>, parts int, last boolean, end int"))

    def with_states(df: DataFrame, more: DataFrame) -> DataFrame:
        more = more.withColumnRenamed("conv_id", "_c").withColumnRenamed("part", "_p")
        return df.join(more, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p"))).drop("_c", "_p")

    # Only conversations in several parts need to know in which state each of these ends.
    several = states.where("parts > 1")
    begins = by_part(with_states(ranged.select("conv_id", "turn", "role", "part"), several.select("conv_id", "part", "reach"))).mapInPandas(_begins, "conv_id long, part int, begins array<int>")
    ends = with_states(several.select("conv_id", "part", "end"), begins).groupBy(bundle).applyInPandas(_backward, "conv_id long, part int, finish int")
    once = states.where("parts = 1").select("conv_id", "part", F.col("end").alias("finish"))
    finish = with_states(states.select("conv_id", "part", "reach", "last"), once.unionByName(ends))
    joined = with_states(ranged, stored(finish))
    return by_part(joined).mapInPandas(_render, "conv_id long, turn long, role string, new_role string, action string, inserted int, cost int, piece string")

