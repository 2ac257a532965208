"""Operators whose result depends on choices made before: one document or page at a time in pandas,
but for ``two_columns``, which is windows. Groups are documents or pages, never whole tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _squeeze(text: str | None) -> str:
    return re.sub(r"\s+", " ", (text or "").strip())


def equal_streaks(keys: list[str], lag: int) -> np.ndarray:
    """For each position, how many positions from it on equal (and are not blank) those ``lag`` later."""
    n = len(keys) - lag
    same = np.array([keys[k] != "" and keys[k] == keys[k + lag] for k in range(n)] + [False])
    stop = np.where(same, n, np.arange(n + 1))
    return (np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n + 1))[:n]


def repeated_runs(keys: list[str]) -> np.ndarray:
    """Which blocks repeat the run of two or more right before them; longest runs first."""
    n, known = len(keys), {}
    code = np.array([known.setdefault(k, len(known)) for k in keys], np.int64)
    gone, shown = np.zeros(n, bool), code != known.get("", -1)
    if len(known) == n:
        return gone
    for size in range(n // 2, 1, -1):
        same = (code[:-size] == code[size:]) & shown[:-size]
        if np.count_nonzero(same) < size:  # no run of this size
            continue
        stop = np.where(same, n, np.arange(n - size))
        streak = np.minimum(np.minimum.accumulate(stop[::-1])[::-1], n - size) - np.arange(n - size)
        before = np.concatenate([[0], np.cumsum(gone)])
        at = np.flatnonzero(streak >= size)
        at = at[before[at + 2 * size] == before[at]]
        k = 0
        while k < len(at):
            gone[at[k] + size : at[k] + 2 * size] = True
            k = np.searchsorted(at, at[k] + 2 * size)
    return gone


def drop_repeated_runs(blocks: DataFrame) -> DataFrame:
    """Blocks (doc_id, block_no, text) without immediate repeats of runs of two blocks or more. Rows stream
    by in order, a document at a time."""
    schema = blocks.schema

    def kept(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        docs, mask, first = rows.column("doc_id").to_pylist(), [], 0
        keys = [_squeeze(x) for x in rows.column("text").to_pylist()]
        for k in range(1, len(docs) + 1):
            if k == len(docs) or docs[k] != docs[first]:
                mask.extend((~repeated_runs(keys[first:k])).tolist() if k - first >= 4 else [True] * (k - first))
                first = k
        yield from rows.filter(pa.array(mask, pa.bool_())).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the last document, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            docs = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            if held and docs[-1] == held[0].column("doc_id")[0].as_py():
                held.append(batch)
                continue
            begin = next((k + 1 for k in range(len(docs) - 1, -1, -1) if docs[k] != docs[-1]), 0)
            done = [*held, batch.slice(0, begin)]
            if sum(x.num_rows for x in done):
                yield from kept(pa.Table.from_batches(done))
            held = [batch.slice(begin)]
        if held:
            yield from kept(pa.Table.from_batches(held))

    return blocks.repartition("doc_id").sortWithinPartitions("doc_id", "block_no").mapInArrow(run, schema)


def page_repeat(lines: list[str], least: int = 3, least_chars: int = 200) -> tuple[int, int] | None:
    """(first, size) of the largest block of lines that repeats right after itself, or None."""
    for size in range(len(lines) // 2, least - 1, -1):
        streak = equal_streaks(lines, size)
        for k in np.flatnonzero(streak >= size):
            if sum(map(len, lines[k : k + size])) >= least_chars:
                return int(k), size
    return None


def drop_page_repeats(lines: DataFrame) -> DataFrame:
    """Lines (doc_id, page, line_no, line) without the second copy of a page's largest repeated block
    (three lines, 200 characters or more); blank lines around the cut become one."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("line_no").reset_index(drop=True)
        text = pdf["line"].fillna("").str.strip()
        shown = np.flatnonzero((text != "").to_numpy())
        found = page_repeat(text.iloc[shown].tolist()) if len(shown) >= 6 else None
        if found is None:
            return pdf
        first, size = found
        begin, end = shown[first + size], shown[first + 2 * size - 1] + 1
        while begin > 0 and text.iloc[begin - 1] == "":
            begin -= 1
        while end < len(pdf) and text.iloc[end] == "":
            end += 1
        kept = [pdf.iloc[:begin]]
        if end < len(pdf) and begin:
            gap = pdf.iloc[[begin]].copy()
            gap["line"] = ""
            kept.append(gap)
        return pd.concat([*kept, pdf.iloc[end:]])

    return lines.groupBy("doc_id", "page").applyInPandas(run, lines.schema)


def reprinted_run(keys: list[str], least: int = 3, least_chars: int = 400, reach: int = 60) -> tuple[int, int] | None:
    """(first, size) of the run with most characters whose blocks all have, in order, an equal block
    before the run's start and at most ``reach`` before it.

    All starts advance together, a block at a time: positions are sorted by key, so one search finds for
    every run still going the next equal block."""
    n = len(keys)
    _, code = np.unique(np.array(keys, object).astype(str), return_inverse=True)
    places, length = np.sort(code * n + np.arange(n)), np.array([len(x) for x in keys], np.int64)
    going, met = np.arange(n), np.maximum(np.arange(n) - reach - 1, -1)
    size, chars, step = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    while len(going := going[going + step < n]):
        base = code[going + step] * n
        slot = np.searchsorted(places, base + met[going] + 1)
        equal = np.where(slot < n, places[np.minimum(slot, n - 1)] - base, n)
        on = equal < going  # an equal block is among those before the start, others are n or more away
        going, equal = going[on], equal[on]
        met[going], size[going], chars[going] = equal, size[going] + 1, chars[going] + length[going + step]
        step += 1
    chars[(size < least) | (chars < least_chars)] = 0
    first = int(chars.argmax()) if n else 0
    return (first, int(size[first])) if n and chars[first] else None


def drop_reprints(blocks: DataFrame, marker: str = "doc") -> DataFrame:
    """Blocks without the best reprinted run of body blocks; a marker says how many went."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block_no").reset_index(drop=True)
        text = pdf["text"].fillna("").str.strip()
        body = np.flatnonzero(~text.str.match(r"^$|!\[|<!--|\||-{3,}$").to_numpy())
        found = reprinted_run([_squeeze(x) for x in text.iloc[body]])
        if found is None:
            return pdf
        drop = body[found[0] : found[0] + found[1]]
        pdf.loc[drop[0], "text"] = f"<!-- {marker}:reprint-dropped {found[1]} blocks -->"
        return pdf.drop(index=drop[1:])

    return blocks.groupBy("doc_id").applyInPandas(run, blocks.schema)


def merged_clusters(boxes: np.ndarray, gap: float) -> tuple[np.ndarray, np.ndarray]:
    """Boxes (n x 4) merged while any two are within ``gap`` in both directions; with how many each holds."""
    count = np.ones(len(boxes), np.int64)
    while len(boxes) > 1:
        dx = np.maximum(boxes[:, None, 0], boxes[None, :, 0]) - np.minimum(boxes[:, None, 2], boxes[None, :, 2])
        dy = np.maximum(boxes[:, None, 1], boxes[None, :, 1]) - np.minimum(boxes[:, None, 3], boxes[None, :, 3])
        near = (dx <= gap) & (dy <= gap)
        label = np.arange(len(boxes))
        while True:
            new = np.where(near, label[None, :], len(boxes)).min(axis=1)
            if (new == label).all():
                break
            label = new
        groups, member = np.unique(label, return_inverse=True)
        if len(groups) == len(boxes):
            break
        low = np.full((len(groups), 2), np.inf)
        high = np.full((len(groups), 2), -np.inf)
        np.minimum.at(low, member, boxes[:, :2])
        np.maximum.at(high, member, boxes[:, 2:])
        count = np.bincount(member, weights=count).astype(np.int64)
        boxes = np.hstack([low, high])
    return boxes, count


def figure_clusters(boxes: DataFrame, gap: float = 28.0, least: int = 6, cover: float = 0.02, most: float = 0.95) -> DataFrame:
    """Drawings (doc_id, page, x0, y0, x1, y1, pw, ph) → figure boxes: clusters of enough drawings or
    enough of the page, and not nearly all of it."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found, count = merged_clusters(pdf[["x0", "y0", "x1", "y1"]].to_numpy(float), gap)
        share = (found[:, 2] - found[:, 0]) * (found[:, 3] - found[:, 1]) / (pdf["pw"].iloc[0] * pdf["ph"].iloc[0])
        keep = ((count >= least) | (share >= cover)) & (share < most)
        out = pd.DataFrame(found[keep], columns=["x0", "y0", "x1", "y1"]).assign(doc_id=key[0], page=key[1], drawings=count[keep])
        return out.sort_values(["y0", "x0", "y1", "x1"])[["doc_id", "page", "x0", "y0", "x1", "y1", "drawings"]]

    fields = {f.name: f.dataType.simpleString() for f in boxes.schema}
    return boxes.groupBy("doc_id", "page").applyInPandas(run, f"doc_id {fields['doc_id']}, page {fields['page']}, x0 double, y0 double, x1 double, y1 double, drawings long")


def _key(cells: list[str]) -> str:
    return re.sub(r"[^a-z0-9]+", "", "".join(c or "" for c in cells).lower())


def assign_tables(first_rows: list[str], grid_rows: list[set[str]]) -> dict[int, int]:
    """Block → grid: by the key of a block's first data row where exactly one grid not taken before has
    it; what is left is paired in order if as many blocks as grids are left."""
    out: dict[int, int] = {}
    for block, key in enumerate(first_rows):
        fits = [g for g, rows in enumerate(grid_rows) if key and key in rows and g not in out.values()]
        if len(fits) == 1:
            out[block] = fits[0]
    blocks = [b for b in range(len(first_rows)) if b not in out]
    grids = [g for g in range(len(grid_rows)) if g not in out.values()]
    if len(blocks) == len(grids):
        out |= dict(zip(blocks, grids))
    return out


def match_tables(blocks: DataFrame, grids: DataFrame) -> DataFrame:
    """Blocks (doc_id, page, block_no, rows: array of rows) and grids (doc_id, page, grid_no, rows) of a
    page → doc_id, page, block_no, grid_no."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, right = left.sort_values("block_no"), right.sort_values("grid_no")
        keys = [_key(list(rows[1])) if len(rows) > 1 else "" for rows in left["rows"]]
        held = [{_key(list(r)) for r in list(rows)[1:5]} - {""} for rows in right["rows"]]
        found = assign_tables(keys, held)
        b, g = left["block_no"].tolist(), right["grid_no"].tolist()
        doc = left if len(left) else right
        rows = [(doc["doc_id"].iloc[0], doc["page"].iloc[0], b[x], g[y]) for x, y in found.items()]
        return pd.DataFrame(rows, columns=["doc_id", "page", "block_no", "grid_no"])

    kind = blocks.schema["doc_id"].dataType.simpleString()
    return blocks.groupBy("doc_id", "page").cogroup(grids.groupBy("doc_id", "page")).applyInPandas(run, f"doc_id {kind}, page int, block_no int, grid_no int")


def migrate_fragments(tables: DataFrame, joint: str = "<br>") -> DataFrame:
    """Tables in page order (doc_id, tbl, continues, rows): fragments that begin a continuation move into
    the last row of the table before it, if that row's first cell isn't blank; chains work too."""

    def fragment(row: list[str]) -> bool:
        cells = [(c or "").strip() for c in row]
        return len(cells) >= 3 and not cells[0] and not cells[1] and any(cells[2:])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tbl").reset_index(drop=True)
        grids = [[list(r) for r in rows] for rows in pdf["rows"]]
        for k in range(1, len(grids)):
            target = next((grids[j][-1] for j in range(k - 1, -1, -1) if grids[j]), None)
            if not pdf["continues"].iloc[k] or not target or not (target[0] or "").strip():
                continue
            while grids[k] and fragment(grids[k][0]):
                row = grids[k].pop(0)
                target.extend([""] * (len(row) - len(target)))
                for j, cell in enumerate(row):
                    if (cell or "").strip():
                        target[j] = joint.join(x for x in ((target[j] or "").strip(), cell.strip()) if x)
        pdf["rows"] = grids
        return pdf

    return tables.groupBy("doc_id").applyInPandas(run, tables.schema)


#: Points between which starts of lines count as one, and the share of a page's width that the second
#: column lies in at least.
GRAIN, INDENT = 3.0, 0.3


def two_columns(lines: DataFrame) -> DataFrame:
    """Vector lines (doc_id, page, x0, y0, x1, y1, text) with column: R, L, F (full width) or O; null for
    pages without a second column (four starts or more near one x, 30 % of the width in), and where more
    than 15 % are O. Windows by page and by start within a page share one exchange."""
    page = Window.partitionBy("doc_id", "page")
    left, width = F.min("x0").over(page), F.max("x1").over(page) - F.min("x0").over(page)
    out = lines.withColumns({"_left": left, "_width": width, "_lines": F.count(F.lit(1)).over(page)})
    out = out.withColumn("_start", F.when(F.col("x0") > F.col("_left") + 0.25 * F.col("_width"), F.bround(F.col("x0") / GRAIN) * GRAIN))
    often = F.count("_start").over(Window.partitionBy("doc_id", "page", "_start")) >= 4
    out = out.withColumn("_fit", F.when(often & (F.col("_start") - F.col("_left") >= INDENT * F.col("_width")), F.col("_start")))
    out = out.withColumn("_second", F.when((F.col("_lines") >= 6) & (F.col("_width") > 50), F.min("_fit").over(page)))
    short = F.col("x1") <= F.col("_second") - 6.0
    by_place = F.when(F.col("x0") >= F.col("_second") - 4.5, "R").when(F.col("x0") > F.col("_left") + 0.1 * F.col("_width"), "O").when(short, "L").otherwise("F")
    out = out.withColumn("_column", F.when(F.col("_second").isNotNull(), by_place))
    stray = F.avg(F.when(F.col("_column") == "O", 1.0).otherwise(0.0)).over(page)
    out = out.withColumn("column", F.when(stray <= 0.15, F.col("_column")))
    return out.select(*lines.columns, "column")


SKIP = re.compile(r"\s*|\s*(-{3,}|\*{3,}|_{3,})\s*|\s*<!--.*-->\s*")
TABLE_CAPTION = re.compile(r"\s*(?:#{1,6}\s*)?\*{0,2}\s*table\s+(\d+)\s*[:.]\s*(.*)", re.IGNORECASE)
FIGURE_CAPTION = re.compile(r"\s*(?:#{1,6}\s*)?\*{0,2}\s*figure\s+(\d+)\s*[:.]\s*(.*)", re.IGNORECASE)


def _cells(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def _header(line: str) -> list[str]:
    return [re.sub(r"\s+", " ", c.strip("*").strip()).lower() for c in _cells(line)]


def _named(kind: str, found: re.Match) -> str:
    title = re.sub(r"\s*\(continued\)\s*$", "", found[2].strip().rstrip("*").strip(), flags=re.IGNORECASE)
    return f"**{kind} {found[1]}{': ' + title if title else ''} (continued)**"


def continuation(before: list[str], after: list[str]) -> tuple[int, list[str]] | None:
    """Where in a page's lines, and which lines, a caption of the page before goes on: its last table with
    a caption against a first table of as many columns without one, or its last figure against a first
    image."""
    shown = [k for k, x in enumerate(before) if not SKIP.fullmatch(x)]
    first = next((k for k, x in enumerate(after) if not SKIP.fullmatch(x)), None)
    if not shown or first is None:
        return None
    top = after[first].lstrip()
    if before[shown[-1]].lstrip().startswith("|") and top.startswith("|"):
        begin = shown[-1]
        while begin > 0 and before[begin - 1].lstrip().startswith("|"):
            begin -= 1
        above = [k for k in shown if k < begin]
        found = TABLE_CAPTION.match(before[above[-1]]) if above else None
        own, other = _header(before[begin]), _header(after[first])
        if not found or len(own) < 2 or len(own) != len(other):
            return None
        lines = [_named("Table", found), ""]
        return first, lines if own == other else [*lines, before[begin], "| " + " | ".join([":---"] * len(own)) + " |"]
    found = FIGURE_CAPTION.match(before[shown[-1]])
    if found is None and before[shown[-1]].lstrip().startswith("![") and len(shown) > 1:
        found = FIGURE_CAPTION.match(before[shown[-2]])
    return (first, [_named("Figure", found), ""]) if found and top.startswith("![") else None


def continue_captions(lines: DataFrame) -> DataFrame:
    """Lines (doc_id, line_no, sub_no, line, page) with continued captions where a page goes on with the
    table or figure that ends the page before."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["line_no", "sub_no"]).reset_index(drop=True)
        pages = {p: own for p, own in pdf[pdf["page"].notna()].groupby("page")}
        extra = []
        for page, own in pages.items():
            held = pages.get(page - 1)
            found = continuation(held["line"].fillna("").tolist()[1:], own["line"].fillna("").tolist()[1:]) if held is not None else None
            if found:
                at = own.iloc[found[0] + 1]
                n = len(found[1])
                extra += [(at["doc_id"], at["line_no"], at["sub_no"] - n + k, x, page) for k, x in enumerate(found[1])]
        more = pd.DataFrame(extra, columns=["doc_id", "line_no", "sub_no", "line", "page"])
        return pd.concat([pdf[more.columns], more]).sort_values(["line_no", "sub_no"]) if extra else pdf[more.columns]

    kind = lines.schema["doc_id"].dataType.simpleString()
    return lines.groupBy("doc_id").applyInPandas(run, f"doc_id {kind}, line_no int, sub_no int, line string, page int")
