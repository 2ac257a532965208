"""Operators whose rows stream by in order, against plain loops."""

import random

from quillstream.operators import grouped


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def runs_by_loops(keys):
    gone = [False] * len(keys)
    for size in range(len(keys) // 2, 1, -1):
        k = 0
        while k + 2 * size <= len(keys):
            if all(keys[j] and keys[j] == keys[j + size] for j in range(k, k + size)) and not any(gone[k : k + 2 * size]):
                gone[k + size : k + 2 * size] = [True] * size
                k += 2 * size
            else:
                k += 1
    return gone


def test_repeated_runs_stream_by(spark):
    r = random.Random(5)
    docs = [[r.choice(["a", "b", " a ", "", "c"][: r.randint(1, 5)]) for _ in range(r.randint(1, 40))] for _ in range(200)]
    rows = [(k, j, x) for k, doc in enumerate(docs) for j, x in enumerate(doc)]
    want = {(k, j) for k, doc in enumerate(docs) for j, gone in enumerate(runs_by_loops([x.strip() for x in doc]) if len(doc) >= 4 else [False] * len(doc)) if not gone}
    r.shuffle(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # documents go over batches
    try:
        kept = grouped.drop_repeated_runs(spark.createDataFrame(rows, "doc_id long, block_no int, text string"))
        got = [(x["doc_id"], x["block_no"]) for x in kept.collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert set(got) == want and len(got) == len(want) < len(rows) - 100
    assert "FlatMapGroups" not in plan(kept)


def test_ngram_repetition_shuffles_nothing(spark):
    from collections import Counter

    from quillstream.operators import scans

    r = random.Random(7)
    words = ["a", "b", "é", "1", "22", "-", "x\x1fy", "字"]
    texts = ["".join(r.choice(words) + r.choice([" ", "  ", "　", "\t", " ", " \x1f "]) for _ in range(400)) + r.choice(["", "\n", "\x85", "\r\n"]) + "1 2 3 " * r.choice([1, 300]) for _ in range(60)]
    texts += [None, "", "1 2 3 " * 400, "a b " * 240, "a b c\n" * 400]
    want = {}
    for k, t in enumerate(texts):
        best = 0
        for line in scans.re.split("[\n\x85]", (t or "").replace("\r\n", "\n")):
            w = [x for x in scans.re.split("[ \t　 ]+", line) if x]
            grams = Counter(" ".join(w[j : j + 3]) for j in range(len(w) - 2)) if len(line) >= 1000 else {}
            best = max([best, *(n for g, n in grams.items() if scans.re.search(r"[^\W\d_]", g))])
        want[k] = best
    out = scans.ngram_repetition(spark.createDataFrame(list(enumerate(texts)), "doc_id long, md string"))
    assert {x["doc_id"]: x["max_gram"] for x in out.collect()} == want and len(set(want.values())) > 3
    assert "Exchange" not in plan(out)


def test_packed_blocks_stream_by(spark):
    from quillstream.operators import planning

    r = random.Random(9)
    rows = [(k % 5 if k % 5 else None, k, r.choice([0, 1, 3, 9, 10, 11, 40])) for k in range(3000)] + [(9, 1, 4), (9, 2, None), (9, 3, 40)]
    want, state = {}, {}
    for d, k, n in rows:
        used, chunk = state.get(d, (0, -1))
        if chunk < 0 or (used is not None and n is not None and used + n > 10):
            used, chunk = 0, chunk + 1
        state[d] = (None if used is None or n is None else used + n + 2, chunk)
        want[d, k] = chunk
    r.shuffle(rows)
    out = planning.pack_blocks(spark.createDataFrame(rows, "doc_id long, block_no long, n_chars int"), 10)
    assert {(x["doc_id"], x["block_no"]): x["chunk"] for x in out.collect()} == want
    assert out.schema["chunk"].dataType.simpleString() == "int" and "collect_list" not in plan(out)
