"""Best boxes by blocks, against brute force over all pairs."""

import random

import pytest

from quillstream.operators import matching

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def iou(a, b):
    w, h = (max(0.0, min(a[k + 2], b[k + 2]) - max(a[k], b[k])) for k in (0, 1))
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return w * h / (area(a) + area(b) - w * h) if w * h > 0 else 0.0


def boxes(n, seed):
    r = random.Random(seed)
    for k in range(n):
        x, y, w, h = (r.randrange(9) for _ in range(4))
        yield (k % 3, k % 2, k, tuple(map(float, (x, y, x + w, y + h))))


@pytest.mark.parametrize("block", [3, 1000])
def test_best_iou_makes_no_pairs_outside_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(matching, "BLOCK", block)
    a, b = list(boxes(60, 1)), list(boxes(90, 2))
    left = spark.createDataFrame([*a, (0, 0, 99, None)], f"doc_id long, page int, id long, box {BOX}")
    right = spark.createDataFrame([*b, (0, 0, 99, None)], f"doc_id long, page int, other long, box {BOX}")
    want = {}
    for d, p, k, x in a:
        score, least = max(((iou(x, y), -o) for e, q, o, y in b if (d, p) == (e, q)))
        if score > 0:
            want[k] = (-least, score)
    got = {r["id"]: (r["other"], r["iou"]) for r in matching.best_iou(left, right).collect()}
    assert got == want and len(want) > 20
    assert matching.block_bests(left, right, ["other"], []).count() <= len(a) * -(-15 // block)


@pytest.mark.parametrize("block", [3, 1000])
def test_snap_makes_no_pairs_outside_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(matching, "BLOCK", block)
    a, b = list(boxes(60, 1)), [(d, p, x, "raster" if k % 3 == 0 else "vector", k // 2) for d, p, k, x in boxes(90, 2)]
    left = spark.createDataFrame([(*x, 9.0, 9.0) for x in [*a, (0, 0, 99, None)]], f"doc_id long, page int, id long, box {BOX}, pw double, ph double")
    right = spark.createDataFrame(b, f"doc_id long, page int, box {BOX}, kind string, rank long")
    got = {r["id"]: r for r in matching.snap(left, right, by=1.0).collect()}
    assert len(got) == 61 and (got[99]["source"], got[99]["iou"]) == ("model", None)
    sources = set()
    for d, p, k, x in a:
        score, raster, _, y = max(((iou(x, y), kind == "raster", -rank, y) for e, q, y, kind, rank in b if (d, p) == (e, q)))
        if score < 0.15:
            y, want = x, ("model", None)
        else:
            want = ("raster" if raster else "vector", round(score, 3))
        sources.add(want[0])
        assert (got[k]["source"], got[k]["iou"]) == want
        assert tuple(got[k]["box"]) == (max(0.0, y[0] - 1), max(0.0, y[1] - 1), min(9.0, y[2] + 1), min(9.0, y[3] + 1))
    assert sources == {"model", "raster", "vector"}
    with monkeypatch.context() as m:
        m.setattr(matching, "block_bests", None)
        with pytest.raises(TypeError):
            matching.snap(left, right)
