"""Matching by equality, nearness, intervals and coverage. Theta conditions always come with an equal
key (document or page), so no join is global; nearest matches are aggregates, not sorts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import circuits as C
from ..functions import geometry as G
from ..functions import text as T


def asof_backward(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, take: list[str], strict: bool = False) -> DataFrame:
    """Each left row with the columns of the latest right row at or before it (before it, if strict).

    Both sides go into one timeline, ordered by time within the keys; the last right row seen so far is
    carried on, so there is one shuffle and no pair is made. Of right rows at one time the greatest
    tuple of taken values is used. A hot key is one window partition: add a time bucket to the keys
    where a key can be large.
    """
    names = [f"_r_{c}" for c in take]
    at = left.schema[left_at].dataType
    r = right.select(*keys, F.col(right_at).cast(at).alias("_at"), F.lit(1 if strict else 0).alias("_side"), F.struct(*[F.col(c).alias(n) for c, n in zip(take, names)]).alias("_r"))
    own = F.struct(*[F.col(c) for c in left.columns])
    lt = left.select(*keys, F.col(left_at).alias("_at"), F.lit(0 if strict else 1).alias("_side"), own.alias("_l"))
    w = Window.partitionBy(*keys).orderBy("_at", "_side", F.col("_r").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    line = r.unionByName(lt, allowMissingColumns=True).withColumn("_seen", F.last("_r", ignorenulls=True).over(w)).where("_l is not null")
    return line.select("_l.*", *[F.col(f"_seen.{n}").alias(c) for n, c in zip(names, take)])


def nearest(left: DataFrame, right: DataFrame, keys: list[str], left_key: str, score: Column, take: str, allow: Column | None = None) -> DataFrame:
    """Of the right rows with the same keys (and allowed), the one of least score: keys, left_key, take.
    Ties go to the least ``take``."""
    pairs = left.join(right, keys)
    pairs = pairs.where(allow) if allow is not None else pairs
    best = pairs.groupBy(*keys, left_key).agg(F.min(F.struct(score.alias("score"), F.col(take).alias(take))).alias("b"))
    return best.select(*keys, left_key, f"b.{take}", "b.score")


def uncovered(lines: DataFrame, body: DataFrame, keys: list[str], least: float = 0.6) -> DataFrame:
    """Rows of ``lines`` (keys, line) whose significant tokens the body (keys, text) lacks: fewer than
    the share, counting repeats. Lines of less than two tokens are covered."""
    words = body.groupBy(*keys).agg(F.array_distinct(F.flatten(F.collect_set(T.tokens(F.col("text"))))).alias("_words"))
    joined = lines.join(words, keys, "left").withColumn("_words", F.coalesce("_words", F.array().cast("array<string>")))
    return joined.where(~T.covered(F.col("line"), F.col("_words"), least)).drop("_words")


def absent_runs(lines: DataFrame, body: DataFrame, least: float = 0.6, tokens: int = 3) -> DataFrame:
    """Runs of consecutive uncovered lines (doc_id, page, line_no, line) with one line of three tokens
    or more; a label line (ending in a colon) right above joins; repeated runs are given once."""
    keys = ["doc_id", "page"]
    gone = uncovered(lines, body, keys, least).select(*keys, "line_no", F.lit(True).alias("_gone"))
    w = Window.partitionBy(*keys).orderBy("line_no")
    all_ = lines.join(gone, [*keys, "line_no"], "left").withColumn("_gone", F.coalesce("_gone", F.lit(False)))
    all_ = all_.withColumn("_gone", F.col("_gone") | (T.strip(F.col("line")).endswith(":") & F.coalesce(F.lead("_gone").over(w), F.lit(False))))
    all_ = all_.withColumn("_run", F.sum((~F.col("_gone")).cast("int")).over(w)).where("_gone")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    runs = all_.groupBy(*keys, "_run").agg(F.min("line_no").alias("line_no"), text.alias("text"), F.max(F.size(T.tokens(F.col("line")))).alias("_most")).where(F.col("_most") >= tokens)
    rank = F.row_number().over(Window.partitionBy(*keys, T.present_key(F.col("text"))).orderBy("line_no"))
    return runs.withColumn("_n", rank).where("_n = 1").select(*keys, "line_no", "text")


def best_forward(lines: DataFrame, body: DataFrame, least: float = 0.6) -> DataFrame:
    """For each source line (doc_id, page, src_no, text, after_pos) the later body line (body_no, line)
    that holds most of its tokens, at least the share; the first of equals."""
    left = lines.withColumn("_own", T.tokens(F.col("text"))).where(F.size("_own") > 0)
    pairs = left.join(body.withColumn("_set", F.array_distinct(T.tokens(F.col("line")))), ["doc_id", "page"]).where("body_no > after_pos")
    pairs = pairs.withColumn("overlap", T.set_overlap(F.col("_own"), F.col("_set"))).where(F.col("overlap") >= least)
    best = pairs.groupBy("doc_id", "page", "src_no").agg(F.max(F.struct("overlap", (-F.col("body_no")).alias("at"))).alias("b"))
    return best.select("doc_id", "page", "src_no", (-F.col("b.at")).alias("body_no"), "b.overlap")


def place_blocks(blocks: DataFrame, body: DataFrame) -> DataFrame:
    """Each block (doc_id, page, block_no, y) goes before the first body line (body_no, y) that is lower;
    without one, at the end (null)."""
    lower = blocks.alias("k").join(body.select("doc_id", "page", F.col("body_no"), F.col("y").alias("_y")), ["doc_id", "page"]).where("_y > y")
    first = lower.groupBy("doc_id", "page", "block_no").agg(F.min("body_no").alias("body_no"))
    return blocks.join(first, ["doc_id", "page", "block_no"], "left")


def box_hits(lines: DataFrame, boxes: DataFrame, band: float = 2.0) -> DataFrame:
    """Lines (doc_id, page, line_no, box) that lie in any box of their page (closed, widened)."""
    b = boxes.select("doc_id", "page", F.col("box").alias("_box"))
    inside = G.overlap(F.col("box"), F.col("_box"), band, strict=False)
    return lines.join(b, ["doc_id", "page"]).where(inside).select(*[F.col(c) for c in lines.columns]).distinct()


#: Boxes of one page that are compared at once: larger pages are cut into blocks, each pair of which is a group of its own.
BLOCK = 2048


def _best_of(a: np.ndarray, b: np.ndarray, step: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """For each box of ``a`` the first of ``b`` (n x 4 each) of greatest IoU, and that IoU, as ``geometry.iou`` has it:
    NaN is greater than all numbers."""
    area = lambda x: np.maximum(0.0, x[:, 2] - x[:, 0]) * np.maximum(0.0, x[:, 3] - x[:, 1])
    at, value, areas = np.zeros(len(a), np.int64), np.zeros(len(a)), area(b)
    with np.errstate(all="ignore"):
        for k in range(0, len(a), step):
            p = a[k : k + step]
            w, h = (np.maximum(0.0, np.fmin(p[:, j + 2, None], b[:, j + 2]) - np.maximum(p[:, j, None], b[:, j])) for j in (0, 1))
            common = w * h
            whole = area(p)[:, None] + areas - common
            iou = np.where((common <= 0) | (whole <= 0), 0.0, common / whole)
            at[k : k + step] = iou.argmax(1)
            value[k : k + step] = np.take_along_axis(iou, at[k : k + step, None], 1)[:, 0]
    return at, value


def block_bests(left: DataFrame, right: DataFrame, order: list[str], take: list[str]) -> DataFrame:
    """For each left box (doc_id, page, id, box) and each block of its page's right boxes (box, order, take) the right
    one of largest positive IoU, the first by ``order`` (ascending) of equals: doc_id, page, id, iou, order, take
    (columns of ``right``, or _x0, _y0, _x1, _y1 of its box).

    Pairs are made in arrays of a block each; a page of many boxes is many groups, which may be anywhere. A
    box without one of its corners fits nothing."""
    key = ["doc_id", "page"]
    corners = [F.col(f"box.{c}").alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")]
    whole = [f"_{c}" for c in ("x0", "y0", "x1", "y1")]
    le = left.select(*key, "id", *corners).dropna(subset=[*key, *whole])
    taken = list(dict.fromkeys([*order, *take]))
    r = right.select(*key, *[c for c in taken if c not in whole], *corners).dropna(subset=[*key, *whole])
    blocks = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    counts = blocks(le, "_nl").join(blocks(r, "_nr"), key)
    place = lambda n: F.pmod(F.xxhash64(*whole), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    le = le.join(counts, key).withColumn("_lb", place("_nl")).withColumn("_rb", every("_nr")).drop("_nl", "_nr")
    r = r.join(counts, key).withColumn("_rb", place("_nr")).withColumn("_lb", every("_nl")).drop("_nl", "_nr")
    kept = [*key, "id"]

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows and b.num_rows:
            b = b.sort_by([(c, "ascending") for c in order])
            boxes = [np.column_stack([t.column(c).to_numpy() for c in whole]) for t in (a, b)]
            at, iou = _best_of(*boxes)
            hit = np.flatnonzero(~(iou <= 0))
        else:
            at, iou, hit = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        out = a.select(kept).take(pa.array(hit)).append_column("iou", pa.array(iou[hit]))
        best = b.take(pa.array(at[hit]))
        for c in taken:
            out = out.append_column(c, best.column(c))
        return out

    types = {f.name: f.dataType.simpleString() for f in le.schema} | {f.name: f.dataType.simpleString() for f in r.schema} | {"iou": "double"}
    schema = ", ".join(f"`{c}` {types[c]}" for c in [*kept, "iou", *taken])
    groups = [*key, "_lb", "_rb"]
    r = r.select(*[F.col(c).alias(f"_g_{c}") for c in groups], *[c for c in r.columns if c not in groups])  # both sides may be of one table
    return le.groupBy(*groups).cogroup(r.groupBy(*[f"_g_{c}" for c in groups])).applyInArrow(run, schema)


def best_iou(left: DataFrame, right: DataFrame) -> DataFrame:
    """For each left box (doc_id, page, id, box) the right one (other, box) of largest positive IoU, the least of equals."""
    best = block_bests(left, right, ["other"], []).groupBy("doc_id", "page", "id").agg(F.max(F.struct("iou", (-F.col("other")).alias("o"))).alias("b"))
    return best.select("doc_id", "page", "id", (-F.col("b.o")).alias("other"), "b.iou")


def snap(detected: DataFrame, evidence: DataFrame, least: float = 0.15, by: float = 16.0) -> DataFrame:
    """Detected boxes (doc_id, page, id, box, pw, ph) moved to the evidence (kind, rank, box) that fits
    best (raster before vector, then rank), padded; those without keep their own, padded."""
    e = evidence.withColumn("_plain", F.when(F.col("kind") == "raster", 0).when(F.col("kind").isNotNull(), 1).otherwise(2))
    bests = block_bests(detected, e, ["_plain", "rank"], ["kind", "_x0", "_y0", "_x1", "_y1"]).where(F.col("iou") >= least)
    found = F.struct(G.box("_x0", "_y0", "_x1", "_y1").alias("_box"), "kind", F.col("iou").alias("_iou"))
    best = bests.groupBy("doc_id", "page", "id").agg(F.max_by(found, F.struct("iou", -F.col("_plain"), -F.col("rank"))).alias("b"))
    out = detected.join(best, ["doc_id", "page", "id"], "left")
    chosen = F.when(F.col("b").isNotNull(), G.pad(F.col("b._box"), by, F.col("pw"), F.col("ph"))).otherwise(G.pad(F.col("box"), by, F.col("pw"), F.col("ph")))
    return out.select("doc_id", "page", "id", chosen.alias("box"), F.coalesce("b.kind", F.lit("model")).alias("source"), F.bround("b._iou", 3).alias("iou"))


def anchor_text(boxes: DataFrame, anchors: DataFrame) -> DataFrame:
    """The nearest anchor (text, abox, rank) of each box: vertical distance, 1000 more where the anchor's
    middle is not over the box (20 points around)."""
    b, a = F.col("box"), F.col("abox")
    middle = (a["x0"] + a["x1"]) / 2
    dy = F.least(F.abs(a["y0"] - b["y1"]), F.abs(a["y0"] - b["y0"]))
    score = F.when(middle.between(b["x0"] - 20, b["x1"] + 20), dy).otherwise(dy + 1000.0)
    pairs = boxes.join(anchors, ["doc_id", "page"])
    best = pairs.groupBy("doc_id", "page", "id").agg(F.min(F.struct(score.alias("s"), "rank", "text")).alias("m"))
    return boxes.join(best, ["doc_id", "page", "id"], "left").select("doc_id", "page", "id", F.col("m.text").alias("text"))


def caption_binds(tables: DataFrame, lines: DataFrame, ratio: float = 0.9) -> DataFrame:
    """Tables (doc_id, page, id, box, above: bottom of what stands over the caption) whose nearest line
    above, overlapping in x, is nearer to the table than to what stands over it."""
    own, line = F.col("box"), F.col("lbox")
    over = (line["y1"] <= own["y0"]) & (line["x0"] < own["x1"]) & (line["x1"] > own["x0"])
    pairs = tables.join(lines, ["doc_id", "page"]).where(over)
    best = pairs.groupBy("doc_id", "page", "id", "above").agg(F.max_by(F.struct("text", "lbox"), line["y1"]).alias("l"), F.first("box").alias("box"))
    below, above = F.col("box.y0") - F.col("l.lbox.y1"), F.col("l.lbox.y0") - F.col("above")
    return best.where(below <= ratio * above).select("doc_id", "page", "id", F.col("l.text").alias("caption"))


def isolated_rules(boxes: DataFrame, share: float = 0.8, thin: float = 2.0, reach: float = 12.0) -> DataFrame:
    """Boxes without the wide thin ones at whose ends no upright box stands."""
    b = F.col("box")
    rule = (G.width(b) >= share * F.col("pw")) & (G.height(b) <= thin)
    upright = boxes.where(G.height(b) > thin).select("doc_id", "page", F.col("box").alias("_v"))
    v = F.col("_v")
    at_end = ((F.abs(v["x0"] - b["x0"]) <= reach) | (F.abs(v["x1"] - b["x1"]) <= reach)) & (v["y0"] - reach <= b["y1"]) & (v["y1"] + reach >= b["y0"])
    held = boxes.where(rule).join(upright, ["doc_id", "page"]).where(at_end).select("doc_id", "page", "id").distinct()
    alone = boxes.where(rule).join(held, ["doc_id", "page", "id"], "left_anti").select("doc_id", "page", "id")
    return boxes.join(alone, ["doc_id", "page", "id"], "left_anti")


def reconcile(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer comparison of counts n: missing, short, extra or ok."""
    e, f = expected.withColumnRenamed("n", "want"), found.withColumnRenamed("n", "have")
    both = e.join(f, keys, "full_outer").select(*keys, F.coalesce("want", F.lit(0)).alias("want"), F.coalesce("have", F.lit(0)).alias("have"))
    state = F.when((F.col("want") > 0) & (F.col("have") == 0), "missing").when(F.col("have") < F.col("want"), "short").when(F.col("have") > F.col("want"), "extra").otherwise("ok")
    return both.withColumn("state", state)


def compare_cells(md: DataFrame, vec: DataFrame) -> DataFrame:
    """Cells (doc_id, page, tbl, row, col, text) of Markdown against vector evidence (text, box): replace
    a differing cell that has evidence with a box, queue those without."""
    keys = ["doc_id", "page", "tbl", "row", "col"]
    both = md.withColumnRenamed("text", "md").join(vec.withColumnRenamed("text", "vec"), keys, "full_outer")
    same = T.alnum_key(F.col("md")) == T.alnum_key(F.col("vec"))
    reason = (
        F.when(F.col("vec").isNull() & F.col("md").isNotNull(), "no_evidence")
        .when(F.col("md").isNull(), "missing_in_md")
        .when(same, "same")
        .when(T.blank(F.col("vec")), "blank_evidence")
        .when(F.col("box").isNull(), "no_box")
        .otherwise("replace")
    )
    return both.withColumn("reason", reason)


def crosscheck(lines: DataFrame, pins: DataFrame, nets: DataFrame) -> DataFrame:
    """Lines (doc_id, line_no, line) against a netlist: pins (doc_id, ref, pin) and nets (doc_id, net).

    A doubted line is confirmed if a designator on it, or a pin-to-net phrase, is in the netlist; a line
    with a designator that isn't there is spurious, unless the netlist has no part of that prefix or the
    line is a quotation. Confirmed comes before spurious."""
    refs = pins.select("doc_id", C.normal_ref(F.col("ref")).alias("ref")).where("ref <> ''").distinct()
    prefixes = refs.select("doc_id", C.ref_prefix(F.col("ref")).alias("prefix")).distinct()
    named = lines.select("doc_id", "line_no", "line", F.explode(C.designators(F.col("line"), wide=True)).alias("d")).withColumn("ref", C.normal_ref(F.col("d")))
    named = named.withColumn("prefix", C.ref_prefix(F.col("ref")))
    seen = named.join(refs.withColumn("_in", F.lit(True)), ["doc_id", "ref"], "left").join(prefixes.withColumn("_px", F.lit(True)), ["doc_id", "prefix"], "left")
    per = seen.groupBy("doc_id", "line_no").agg(F.bool_or(F.coalesce("_in", F.lit(False))).alias("any_in"), F.bool_or(F.col("_in").isNull() & F.col("_px").isNotNull()).alias("any_out"))
    phrases = lines.select("doc_id", "line_no", F.explode(C.pin_nets(F.col("line"))).alias("p")).select("doc_id", "line_no", "p.*")
    keyed = pins.select("doc_id", C.normal_ref(F.col("ref")).alias("ref"), F.upper("pin").alias("pin")).distinct()
    good = phrases.where("pin <> ''").join(keyed, ["doc_id", "ref", "pin"], "left_semi").select("doc_id", "line_no")
    known = nets.where(C.is_named_net(F.col("net"))).select("doc_id", "net").distinct()
    good = good.unionByName(phrases.join(known, ["doc_id", "net"], "left_semi").select("doc_id", "line_no")).distinct().withColumn("_pin", F.lit(True))
    out = lines.join(per, ["doc_id", "line_no"], "left").join(good, ["doc_id", "line_no"], "left")
    doubted = F.col("line").rlike(r"(?i)\[unverified(?:\s+range)?\]|\[unreadable\]")
    state = F.when(F.col("_pin").isNotNull() | (doubted & F.coalesce("any_in", F.lit(False))), "confirmed")
    state = state.when(F.coalesce("any_out", F.lit(False)) & ~T.strip(F.col("line")).startswith(">"), "spurious")
    return out.select("doc_id", "line_no", "line", state.alias("state"))


def vector_only_nets(nets: DataFrame, lines: DataFrame) -> DataFrame:
    """Named nets that no pin-to-net phrase of the document names."""
    said = lines.select("doc_id", F.explode(C.pin_nets(F.col("line"))).alias("p")).select("doc_id", F.col("p.net").alias("net"))
    return nets.where(C.is_named_net(F.col("net"))).select("doc_id", "net").distinct().join(said, ["doc_id", "net"], "left_anti")


def expand_boxes(boxes: DataFrame, grids: DataFrame) -> DataFrame:
    """Boxes (doc_id, page, id, box) widened to hold every grid box of their page that overlaps them."""
    g = grids.select("doc_id", "page", F.col("box").alias("_g"))
    hit = boxes.join(g, ["doc_id", "page"]).where(G.overlap(F.col("box"), F.col("_g")))
    side = lambda f, k: f(F.col(f"_g.{k}")).alias(k)
    per = hit.groupBy("doc_id", "page", "id").agg(side(F.min, "x0"), side(F.min, "y0"), side(F.max, "x1"), side(F.max, "y1"))
    out = boxes.join(per, ["doc_id", "page", "id"], "left")
    wide = G.union(F.col("box"), G.box("x0", "y0", "x1", "y1"))
    return out.select("doc_id", "page", "id", F.when(F.col("x0").isNotNull(), wide).otherwise(F.col("box")).alias("box"))


def insert_figures(lines: DataFrame, figures: DataFrame) -> DataFrame:
    """Lines (doc_id, line_no, sub_no, line) with each figure's block (doc_id, number, ord, block) after the
    first caption line of its number; figures without one go to the end, in order."""
    from ..functions.markdown import caption_number
    from .lines import by_doc

    number = F.when(F.col("line").rlike(r"(?i)^\s*(?:#{1,6}\s*)?\*{0,2}\s*(?:figure|table)\s+\d+\s*[:.]"), caption_number(F.col("line")))
    found = lines.withColumn("_n", number).where("_n is not null").groupBy("doc_id", "_n").agg(F.min(F.struct("line_no", "sub_no")).alias("at"))
    end = lines.groupBy("doc_id").agg(F.max("line_no").alias("_end"))
    placed = figures.join(found.withColumnRenamed("_n", "number"), ["doc_id", "number"], "left").join(end, "doc_id")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))
    placed = placed.withColumn("_r", rank)
    own = placed.select("doc_id", F.coalesce("at.line_no", F.col("_end")).alias("line_no"), (F.coalesce("at.sub_no", F.lit(1000)) + F.col("_r")).cast("int").alias("sub_no"), F.col("block").alias("line"))
    return lines.select("doc_id", "line_no", "sub_no", "line").unionByName(own).withColumn("sub_no", (F.row_number().over(by_doc())).cast("int"))
