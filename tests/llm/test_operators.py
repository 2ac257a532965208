"""Training-data operators against brute force on small tables: nulls, empty and long texts, ties,
repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quillstream.llm import chat, chunkcodec, components, jaccard_join, langid, neardup_vectors, packing, quality, sentencepiece_codec, sharding, substring_dedup, toxicity

WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = say(60), say(200).split()
    out = [None, "", " \n ", "one", "one two", "One TWO", "x" * 5000, "la " * 120, say(40), say(300), say(300) + "\n" + passage, passage + " " + say(20), say(10) + " " + passage]
    for k in range(8):
        near = list(base)
        for j in rng.sample(range(200), k % 4):
            near[j] = "new"
        out.append(" ".join(near))
    out += [out[9], out[9], " ".join(base[:34]), " ".join(base[:35]), "日本 語 " * 30, "a b c"]
    return out


def table(spark, rows=None, n=2):
    rows = texts() if rows is None else rows
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(rows)], DOCS)
    return df.withColumns({"text_": F.lit("x"), "node": F.lit(1), "h": F.lit(2), "row": F.lit(3), "shard": F.lit(4)}).repartition(n)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_components(spark, monkeypatch):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(5, 5)]
    df = spark.createDataFrame(links, "a long, b long")
    near = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for x in sorted(near):
        if x not in want:
            todo = [x]
            while todo:
                y = todo.pop()
                if y not in want:
                    want[y] = x
                    todo += near[y]
    for small in (10_000, 5):
        monkeypatch.setattr(components, "SMALL", small)
        assert {r["node"]: r["component"] for r in components.components(df).collect()} == want


def brute_windows(rows):
    split = [re.findall(WORD, t or "") for t in rows]
    seen = Counter(tuple(w[k : k + 35]) for w in split for k in range(len(w) - 34))
    out = []
    for w in split:
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return out


def test_substring_dedup(spark):
    rows = texts()
    rows += ["the same few words " * 80, "the same few words " * 40 + "and more", "la " * 3000]  # periodic texts
    for shard_bytes in (1 << 22, 4000):
        got = substring_dedup.remove_repeats(table(spark, rows), shard_bytes=shard_bytes).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("k")).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["k"]) for r in got} == dict(enumerate(brute_windows(rows)))
    kept = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(table(spark), untouched=True).collect()}
    assert kept[2] == rows[2] and kept[8] == rows[8]
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


def test_substring_dedup_is_linear_on_one_word_texts():
    data = np.frombuffer(b"la " * 200_000, np.uint8)
    words = substring_dedup.Words(data, np.array([0, len(data)]))
    shard = substring_dedup.Shard(words, 35)
    shard.compile(np.arange(len(words) - 34))
    gone = np.zeros(len(words), bool)
    assert sum(map(len, shard.places)) < 40
    for a, b in shard.repeats(0, len(words)):
        gone[a:b] = True
    assert gone.all()


def brute_jaccard(rows, width=3, percent=90):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for t in rows:
        w = re.findall(WORD, (t or "").translate(low))
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    up = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = up[a], up[b]
            up = [min(x, y) if z in (x, y) else z for z in up]
    return {k: (len(s), up[k]) for k, s in enumerate(sets)}


def edited(seed=5):
    """Clusters whose members have few to many words changed, around the similarity asked for; passages that many share."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    passage, out = say(70), []
    for size in (6, 11, 14, 25, 60, 150, 400):
        base = say(size)
        for k in range(9):
            near = list(base)
            for j in rng.sample(range(size), min(size, rng.randint(0, max(1, size // 40)))):
                near[j] = rng.choice(words)
            out.append(" ".join(near[k % 2 :]))
    return out + [" ".join(say(25) + passage + say(25)) for _ in range(20)]


def test_jaccard_join(spark, monkeypatch):
    whole, cut = (jaccard_join.BLOCK, jaccard_join.LIST, 1_000_000, 48), (300, 3, 2000, 1)  # cut: families and signatures dealt over blocks
    for rows, width, percent, (block, most, posts, short) in ((texts() + edited(), 3, 90, whole), (edited(), 3, 90, cut), (edited(6), 5, 80, cut)):
        monkeypatch.setattr(jaccard_join, "LIST", most)
        monkeypatch.setattr(jaccard_join, "POSTS", posts)
        monkeypatch.setattr(jaccard_join, "SHORT", short)
        got = jaccard_join.join(table(spark, rows), width, percent, block=block).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_jaccard(rows, width, percent)
    monkeypatch.undo()
    assert jaccard_join.join(empty(spark)).count() == 0
    lone = jaccard_join.join(spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (4, "d e f"), (9, "d e f"), (3, "x")], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in lone) == [(0, 0), (3, 3), (4, 4), (4, 4), (4, 4), (9, 4)]


@pytest.mark.parametrize("percent", (60, 80, 90, 100))
def test_similar_sets_share_a_post_and_sketches_never_part_them(percent):
    from quillstream.llm import agreement

    rng = np.random.default_rng(percent)
    scheme = agreement.Scheme(percent)
    for _ in range(300):
        n = int(np.exp(rng.uniform(1, 7)))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        changed = int(rng.integers(0, agreement.difference(n, percent) + 1))
        gone = int(rng.integers(0, changed + 1))
        y = np.unique(np.concatenate([rng.permutation(x)[gone:], rng.integers(0, 1 << 62, changed - gone).astype(np.uint64)]))
        same = len(np.intersect1d(x, y))
        if 100 * same < percent * (len(x) + len(y) - same) or same == max(len(x), len(y)):
            continue
        halved = dict(zip(scheme.band(np.array([len(x), len(y)])).tolist(), scheme.needs([x, y]).tolist()))
        signature, _, owner = scheme.posts([x, y], halved)
        assert set(signature[owner == 0]) & set(signature[owner == 1])
        p, q = (dict(s) for s in scheme.sketches([x, y]))
        shared = set(p) & set(q)
        assert shared and all(scheme.may_link(np.frombuffer(p[b], "<u8"), np.frombuffer(q[b], "<u8"), len(x), len(y)) for b in shared)


def test_a_band_is_halved_until_each_set_fills_enough_parts():
    from quillstream.llm import agreement

    scheme = agreement.Scheme(80)
    band = scheme.bands[5]
    pool = np.arange(1, 200_000, dtype=np.uint64)
    crowded = pool[agreement._place(pool, band.parts) < 2][: band.first + 1]  # fills two parts at most
    needs = scheme.needs([crowded])[0]
    assert needs > 0
    near = np.append(crowded[:-1], np.uint64(1 << 50))
    signature, _, owner = scheme.posts([crowded, near], {5: int(needs)})
    assert set(signature[owner == 0]) & set(signature[owner == 1])


@pytest.mark.parametrize("seed", range(6))
def test_t_occurrence_search_finds_all(seed):
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(40)]
    sets += [np.unique(np.concatenate([s[1:], rng.integers(100, 103, 1).astype(np.uint64)])) for s in sets[:20]]
    lists = jaccard_join.Lists(sets)
    for percent in (60, 80, 90):
        for k, q in enumerate(sets):
            want = [j for j in range(k) if 100 * len(np.intersect1d(q, sets[j])) >= percent * len(np.union1d(q, sets[j]))]
            assert list(lists.search(q, k, percent)) == want


@pytest.mark.parametrize("seed", range(4))
def test_t_occurrence_search_is_exact_for_queries_outside_the_lists(seed):
    rng = np.random.default_rng(seed)
    draw = lambda n: rng.integers(0, 1 << 40, n).astype(np.uint64)
    base = draw(300)

    def near(most):
        gone = int(rng.integers(0, most))
        return np.unique(np.concatenate([rng.permutation(base)[gone:], draw(gone)]))

    left, right = [near(30) for _ in range(150)], [near(30) for _ in range(60)] + [np.unique(draw(300))]
    small = lambda: np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64)
    for held, asked in ((left, right), ([small() for _ in range(60)], [small() for _ in range(60)])):
        lists = jaccard_join.Lists(held)
        for percent in (60, 80, 90):
            for q in asked:
                want = [j for j, s in enumerate(held) if 100 * len(np.intersect1d(q, s)) >= percent * len(np.union1d(q, s))]
                assert list(lists.search(q, None, percent)) == want


def test_packing(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [*texts(), "a  b", " lead", "trail ", "x \n y", "<|endoftext|> it's 3x!", "word " * 3000]
    want = {k: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for k, t in enumerate(rows)}
    got = packing.pack_documents(table(spark, rows), path, 128).toPandas()
    for doc, own in got.groupby("doc_id"):
        own = own.sort_values("piece")
        ids = want.pop(doc)
        assert own["piece"].tolist() == list(range(len(own))) and own["length"].sum() == len(ids) and (len(ids) > 128 or len(own) == 1)
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in zip(own["start"], own["length"], own["ids_crc32"]))
        assert all(n == 128 for n in own["length"].iloc[1:])
    assert not want
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() <= 128
    assert packing.pack_documents(empty(spark)).count() == 0


def test_a_word_takes_one_entry_of_the_token_tables(monkeypatch):
    monkeypatch.setattr(packing, "_coders", {})
    monkeypatch.setattr(chunkcodec, "_tables", [])
    coder = packing.coder(public_tokenizers.path("byte_bpe_50k.json"))
    words = [a + b for a in "bcdfg" for b in ("ran", "tel", "omi", "ush")]
    for text in (" ".join(["x", *words]), " ".join(["x", *words[::-1], *words])):
        coder.encode_text(text)
        assert sum(len(x) for x in vars(coder).values() if isinstance(x, dict)) == len(words)


@pytest.mark.parametrize("stay, recent", [(0, 1), (9, 3), (40, 5), (1000, 10)])
def test_token_tables_give_the_ids_of_whole_texts(monkeypatch, stay, recent):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "_coders", {})
    monkeypatch.setattr(chunkcodec, "_tables", [])
    monkeypatch.setattr(chunkcodec, "STAY", stay)
    monkeypatch.setattr(chunkcodec, "RECENT", recent)
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder, tokenizer = packing.coder(path), Tokenizer.from_file(path)
    rng = random.Random(stay)
    parts = ["the", "The,", "é", "don't", "'s", "'", "12.5", ".", ",", "a.", "x\ny", "\n", "\n\n", "\t", "\u00a0", "\u3000", "\x85", "\x1c", "日本", "e\u0301", "q" * 60, "q" * 60 + ",", "<|endoftext|>", "***", "a1b", "²", "🙂"]
    for k in range(400):
        few = rng.sample(parts, rng.randint(1, len(parts)))
        text = "".join(rng.choice(few) + rng.choice(["", " ", " ", " "] if k % 3 else [" "]) for _ in range(rng.randint(0, 30))).strip()
        text += rng.choice(["", "", " ", "\n"])
        assert coder.encode_text(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(coder.chunks) + len(coder.pieces) <= stay and len(coder.recent) <= recent and not coder.own_chunks and not coder.own_pieces
    chunkcodec.empty_tables()
    assert not coder.chunks and not coder.pieces and not coder.recent


def test_bin_bounds():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = rng.integers(1, 100, 60)
        bins, offsets = packing.best_fit(sizes, 100)
        assert np.bincount(bins, weights=sizes).max() <= 100
        assert -(-sizes.sum() // 100) <= packing.bin_bound(sizes, 100) <= bins.max() + 1
    assert packing.bin_bound(np.array([51] * 7), 100) == 7


def test_exchange_between_partitions(spark):
    rows = spark.createDataFrame([(k, 0, 0, 40 + k % 7, 0) for k in range(200)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack(rows, 100, pieces_per_task=20).toPandas()
    assert len(out) == 200 and out.groupby("sequence_id")["length"].sum().max() <= 100


def test_quality(spark):
    docs = table(spark)
    labels = spark.createDataFrame([(k, k % 3 != 0) for k in range(30)], "doc_id long, q boolean").select("doc_id", F.col("q").cast("int").alias("quality"))
    got = {r["doc_id"]: r for r in quality.apply_rules(docs, labels).collect()}
    for k, t in enumerate(texts()):
        w = re.findall(WORD, t or "")
        seen = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        rep = {x for j in range(len(w) - 7) if seen[tuple(w[j : j + 8])] > 1 for x in range(j, j + 8)}
        assert (got[k]["n_words"], got[k]["word_chars"], got[k]["n_repeat_words"]) == (len(w), sum(map(len, w)), len(rep))
        assert got[k]["base_failed"] == (len(w) < 20 or 100 * len(rep) > 30 * len(w)) and not (got[k]["base_failed"] and got[k]["kept"])
    assert quality.apply_rules(empty(spark), labels).count() == 0


def test_exact_binomial_bound():
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-9)
    assert quality.upper_bound(3, 3, 0.05) == 1.0 and quality.upper_bound(0, 0, 0.05) == 1.0
    p = quality.upper_bound(7, 900, 0.01)
    assert quality.log_binomial_tail(7, 900, p) == pytest.approx(np.log(0.01), abs=1e-6)


def test_cutoffs_respect_the_risk(spark):
    rng = np.random.default_rng(1)
    rows = [(k, 200, 1000, int(1000 * abs(rng.normal(0, 0.01 if k % 4 else 0.2))), 0, 0) for k in range(6000)]
    measured = spark.createDataFrame(rows, quality.MEASURES)
    labels = measured.select("doc_id", (F.col("doc_id") % 4 > 0).cast("int").alias("quality"))
    chosen = quality.cutoffs(measured, labels)
    good = quality.judge(measured, chosen).join(labels.where("quality = 1"), "doc_id")
    assert (1, "symbol_ratio") in chosen and good.where("not kept").count() <= quality.RISK * good.count()


def test_cutoffs_are_tested_in_sequence(spark):
    sizes = {50: 1200, 200: 1000}  # 1,151 good labels without a rejection suffice at level 0.05 / 16
    rows = [(words * 10000 + k, words, 5 * words, 0, 0, 0) for words, many in sizes.items() for k in range(many)]
    measured = spark.createDataFrame(rows, quality.MEASURES)
    chosen = quality.cutoffs(measured, measured.select("doc_id", F.lit(1).alias("quality")))
    assert chosen == {(0, rule): grid[0] for rule, grid in quality.RULES.items()}


def labelled(spark):
    rng = random.Random(5)
    tongues = {"aa": "lomi tera vano", "bb": "éçu öpa ßim"}
    rows = []
    for k in range(400):
        lang = "aa" if k % 2 else "bb"
        words = [rng.choice(tongues[lang].split()) + rng.choice(["", "n", "r"]) for _ in range(30)]
        if k % 5 == 0:
            words[rng.randrange(30)] = "vilegrub"
        rows.append((k, " ".join(words), lang, "s", 0))
    rows += [(1000, None, "aa", "s", 0), (1001, "", None, "s", 0), (1002, "123 !!", "bb", "s", 0)]
    return spark.createDataFrame(rows, DOCS)


def test_toxicity_learns_what_labels_mark(spark):
    docs = labelled(spark)
    labels = docs.where("doc_id < 400").select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    got = toxicity.classify(docs, labels).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert len(got) == 403 and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    assert np.mean([r["predicted"] == (r["doc_id"] % 5 == 0) for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.classify(docs, labels.where("toxic = 0")).select("score").distinct().collect()
    assert [r[0] for r in none] == [0.0]


def test_language_is_told_on_held_out_texts(spark):
    got = {r["doc_id"]: r for r in langid.identify(labelled(spark)).collect()}
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 400]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert [got[k]["lang_pred"] for k in (1000, 1001, 1002)] == ["und"] * 3
    assert {r["lang_pred"] for r in langid.identify(table(spark, ["a", None], 1).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_tabulated_network_equals_the_plain_one():
    rng = np.random.default_rng(2)
    windows = rng.integers(0, 256, (8, langid.LENGTH)).astype(np.uint8)
    net = langid.fit(windows, np.arange(8) % 2, ["a", "b"])
    pooled = []
    for width, filters, bias in zip(langid.WIDTHS, net.filters, net.biases):
        e = net.embedding[windows]
        columns = np.concatenate([e[:, k : langid.LENGTH - width + 1 + k] for k in range(width)], axis=2)
        pooled.append(np.maximum((columns @ filters).max(axis=1) + bias, 0))
    want = langid.log_softmax(np.concatenate(pooled, axis=1) @ net.dense + net.dense_bias)
    assert np.allclose(langid.Predictor(net).windows(windows), want, atol=1e-4)


def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(6, 16))
    rows = [(k, (base[k % 6] + rng.normal(scale=0.05 * (k % 3), size=16)).tolist()) for k in range(120)]
    rows += [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [None] * 16), (204, []), (205, [1e-300] * 16), (206, rows[0][1]), (206, rows[0][1])]
    fine = {k: np.array(v) for k, v in rows if v and k not in (201, 202, 203)}
    unit = {k: v / np.abs(v).max() for k, v in fine.items()}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    near = {a: {b for b in unit if b != a and unit[a] @ unit[b] >= 0.95} for a in unit}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    for block, most in ((4096, 50_000), (16, 10)):
        monkeypatch.setattr(neardup_vectors, "LIST", most)
        monkeypatch.setattr(neardup_vectors, "SHORT", 96 if block > 16 else 4)
        got = {r["vec_id"]: r for r in neardup_vectors.near_duplicates(df, block=block).collect()}
        assert {k: got[k]["n_links"] for k in got} == {k: len(near.get(k, ())) for k in got}
        for k in got:
            reach, todo = {k}, [k]
            while todo:
                for b in near.get(todo.pop(), ()):
                    if b not in reach:
                        reach.add(b)
                        todo.append(b)
            assert got[k]["component_id"] == min(reach) and got[k]["kept"] == (min(reach) == k)
    assert neardup_vectors.near_duplicates(df.limit(0)).count() == 0
    whole = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.01]), (None, None)], "vec_id long, embedding array<double>")
    got = sorted(tuple(r)[:4] for r in neardup_vectors.near_duplicates(whole).fillna(-1).collect())
    assert got == [(-1, 0, -1, True)] * 3 + [(7, 1, 7, True)] * 2 + [(8, 1, 7, False)]


def test_sentencepiece_parity(spark):
    import sentencepiece

    reference = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_model())
    rows = [*texts(), "a  b", " lead", "trail ", "tab\tand\nline", "<s> 😀 ü"]
    got = {r["doc_id"]: r for r in sentencepiece_codec.summary(table(spark, rows)).collect()}
    for k, t in enumerate(rows):
        ids = np.array(reference.encode(t or ""), "<u4")
        assert (got[k]["n_tokens"], got[k]["ids_crc32"], got[k]["parity"], got[k]["round_trip"]) == (len(ids), zlib.crc32(ids.tobytes()), True, True)
    both = sentencepiece_codec.decode(sentencepiece_codec.encode(table(spark, rows))).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in both)


def test_sentencepiece_ids_where_the_marker_stands_in_the_text():
    import sentencepiece

    path = sentencepiece_codec.default_model()
    reference = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = ["w▁ ▁z", "▁", "a▁ b", "a ▁b c", "▁▁ ▁▁ x", "x ▁"]
    got = sentencepiece_codec.Codec(path).encode(rows)
    assert [(np.frombuffer(ids, "<u4").tolist(), same) for ids, same in got] == [(reference.encode(t), True) for t in rows]


def test_sentencepiece_decoding_is_that_of_the_library():
    own = sentencepiece_codec.Codec(sentencepiece_codec.default_model())
    library, asked, rng = own.tokenizer, [], random.Random(5)

    class Counted:
        def decode_batch(self, ids, **options):
            asked.extend(ids)
            return library.decode_batch(ids, **options)

    own.tokenizer = Counted()
    n = len(own.file.pieces)
    single = [k for k, (_, _, kind) in enumerate(own.file.pieces) if kind == sentencepiece_codec.BYTE]
    marks = [k for k, (piece, _, _) in enumerate(own.file.pieces) if not piece.strip(sentencepiece_codec.MARK)]
    sound = [list(own.reference.encode(t)) for t in ["", "a b", "  a", "<s> 😀 ü\U0001f9ff\u0378", "w▁ ▁z", "\x00\t\n"]]
    odd = [[k] for k in range(n)] + [[], [n], [n + 7, 300, n], [2**32 - 1]]
    odd += [[rng.choice(rng.choice((single, marks, range(n)))) for _ in range(rng.randint(1, 9))] for _ in range(5000)]
    for ids, broken in ((sound, False), (odd, True)):
        asked.clear()
        got = own.decode([sentencepiece_codec.pack(x) for x in ids])
        assert got == library.decode_batch(ids, skip_special_tokens=False)
        assert 0 < len(asked) < len(ids) if broken else not asked  # the library decodes what is broken, and that alone


def test_unigram_models_are_rebuilt():
    piece = lambda text, score, kind: bytes([10, 2 + len(text) + 5 + 2, 10, len(text)]) + text + b"\x15" + np.float32(score).tobytes() + bytes([24, kind])
    data = piece(b"<unk>", 0, 2) + piece("▁".encode() + b"a", -1, 1) + piece(b"b", -2, 1) + bytes([18, 2, 24, 1])
    model = sentencepiece_codec.ModelFile.parse(data)
    assert model.kind == sentencepiece_codec.UNIGRAM and model.tokenizer().encode("ab").ids == [1, 2]


def test_sharding(spark):
    rows = [(k, "x" * (k * 37 % 900)) for k in range(400)] + [(7777, "y" * 5000)] + [(8888, "z" * 600)] * 5 + [(9, None)] + [(5555, "v" * 3900), (5555, "w" * 10000)] + [(None, "n" * n) for n in (3000, 1500, 1200, 10, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit(1))
    out = sharding.assign(df, limit=4000).toPandas()
    out["doc_id"] = out["doc_id"].fillna(-1).astype(int)
    assert len(out) == len(rows)
    sizes = out.groupby("shard")["n_bytes"].sum()
    assert ((sizes <= 4000) | (out.groupby("shard").size() == 1)).all() and (out["shard_bytes"] == out["shard"].map(sizes)).all()
    plain = out[~out["shard"].str.contains(r"\+")]
    bits = {d: f"{int(hashlib.md5(("" if d < 0 else str(d)).encode()).hexdigest()[:15], 16):060b}" for d in out["doc_id"]}
    assert all(bits[d].startswith(s) and len(s) == n for d, s, n in zip(plain["doc_id"], plain["shard"], plain["depth"]))
    shards = sorted(set(plain["shard"]))
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    for s in shards:  # a bucket is split only if it was too large
        if s:
            assert sum(n for d, n in zip(out["doc_id"], out["n_bytes"]) if bits[d].startswith(s[:-1])) > 4000
    assert sharding.assign(df.limit(0)).count() == 0


def cheapest(roles):
    """Least cost by trying every assignment, with the automaton stated anew."""
    follow = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}

    def new(state, role):
        if role in follow[state]:
            return 0
        return 3 if any(m != 1 and role in follow[m] for m in follow[state]) else None

    best = {0: 0}
    for own in roles:
        now = {}
        for state, cost in best.items():
            for role in (1, 2, 3):
                change = 0 if role == own else 1 if own == 0 else 2
                for more in ([1] if role == state else []) + ([new(state, role)] if new(state, role) is not None else []):
                    now[role] = min(now.get(role, 99999), cost + change + more)
        best = now
    return min(c + {0: 0, 1: 6, 2: 3, 3: 0}[s] for s, c in best.items())


def test_chat_repair(spark):
    rng = random.Random(4)
    names = ["system", "user", "assistant", "tool", None, " User "]
    turns = [(c, t, rng.choice(names), f"t{t}") for c in range(40) for t in range(rng.randint(1, 9))] + [(99, t, rng.choice(names[:4]), None) for t in range(300)] + [(None, 0, "user", "q")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(9))
    got = chat.repair(df, part=50).toPandas()
    assert len(got) == len(turns)
    whole = chat.repair(df).toPandas()
    key = ["conv_id", "turn", "new_role", "action", "inserted", "cost", "piece"]
    order = lambda x: x[key].astype(object).sort_values(["conv_id", "turn"]).values.tolist()
    assert str(order(got)) == str(order(whole))
    for conv, own in got[got["conv_id"].notna()].groupby("conv_id"):
        own = own.sort_values("turn")
        assert own["cost"].sum() == cheapest([chat.role_number(r) for r in own["role"]])
        said = re.findall(r"<\|(system|user|assistant)\|>\n", "".join(own["piece"]))
        assert re.fullmatch("s?(ua)+|s?", "".join(x[0] for x in said)) and "".join(own["piece"]).endswith("<|end|>\n")
    assert chat.repair(df.limit(0)).count() == 0


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    docs = labelled(spark).unionByName(labelled(spark).where("doc_id in (1, 3)").withColumn("doc_id", F.col("doc_id") + 5000))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs.where("doc_id < 400").select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 5 == 0).cast("int").alias("toxic")).write.parquet(str(tmp_path / "labels.parquet"))
    names = docs.columns
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        if name != "best_fit_packing":
            assert at.columns == names
            kept.append({r["doc_id"] for r in at.select("doc_id").collect()})
    assert kept[0] == set(range(400)) | {5001, 5003}
    assert not any(k % 5 == 0 for k in kept[1] if k < 400) and kept[1] >= {k for k in range(400) if k % 5}
    assert kept[2] == kept[1] - {5001, 5003} and kept[3] == kept[2]
    assert {r["doc_id"] for r in at.collect()} == kept[3]


def test_pipeline_drops_copies_near_by_five_words(spark, tmp_path):
    import corpus_pipeline

    words = [f"w{k}" for k in range(200)]
    near, far = list(words), list(words)
    for k in (20, 70, 120, 170):  # five-word Jaccard 176 / 216, three-word 186 / 210
        near[k] = "new"
    for k in range(10, 190, 30):  # six edits: five-word Jaccard 166 / 226
        far[k] = f"other{k}"
    docs = table(spark, [" ".join(words), " ".join(near), " ".join(far)])
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()} == {0, 2}


def test_pipeline_stages_on_odd_tables(spark, tmp_path):
    """Nulls, empty texts, columns named like those that stages add, and an empty table."""
    import corpus_pipeline

    spark.createDataFrame([(k, 1, int(k % 2)) for k in range(8)] + [(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts())] + [(None, "one two three", None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).select("*", *[F.lit(c).alias(c) for c in ("score", "predicted", "held_out", "lang_pred", "n_words", "n_removed", "row", "shard", "text_key")])
    for stage in (corpus_pipeline.language_id, corpus_pipeline.remove_toxic, corpus_pipeline.drop_near_copies, corpus_pipeline.remove_repeats):
        got = stage(spark, docs, str(tmp_path))
        assert got.schema.names == docs.schema.names
        assert all(r[c] == c for r in got.collect() for c in docs.columns[5:])
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert {r["doc_id"] for r in corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()} == {*range(len(texts())), None}
    assert corpus_pipeline.pack(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_toxicity_features_are_the_character_ngrams_of_each_text():
    rows = ["Été 日本\tß!", "", "aaaa", "x" * 3, "😀 a b c", "ab"]
    data = "".join(rows).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in rows])])
    text, feature = toxicity.features(np.frombuffer(data, np.uint8), offsets)
    low = [re.sub(r"\s", " ", t.lower()) for t in rows]
    want = [{t[a : a + n] for n in toxicity.ORDERS for a in range(len(t) - n + 1)} for t in low]
    assert np.bincount(text, minlength=len(rows)).tolist() == [len(x) for x in want]
    assert len(np.unique(feature)) == len(set().union(*want))
    alone, one = toxicity.features(np.frombuffer(low[0].encode(), np.uint8), np.array([0, len(low[0].encode())]))
    assert sorted(one) == sorted(feature[text == 0])


def test_toxicity_counts_choice_and_score_by_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    rows = [" ".join(rng.choice(["bad", "ugly"] if k % 3 == 0 and rng.random() < 0.5 else ["fine", "good", "day", "sun"]) for _ in range(12)) for k in range(120)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels)
    learnt = [k for k in range(120) if zlib.crc32(str(k).encode()) % 4 != 2]
    sets = {k: {t[a : a + n] for t in [rows[k]] for n in toxicity.ORDERS for a in range(len(t) - n + 1)} for k in learnt}
    n1 = sum(k % 3 == 0 for k in learnt)
    n0 = len(learnt) - n1

    def statistic(gram):
        c = [sum(gram in sets[k] for k in learnt if (k % 3 == 0) == one) for one in (False, True)]
        share = sum(c) / (n0 + n1)
        cells = [(c[0], n0 * share), (c[1], n1 * share), (n0 - c[0], n0 * (1 - share)), (n1 - c[1], n1 * (1 - share))]
        return sum(c) > 1 and 2 * sum(x * np.log(x / e) for x, e in cells if x) >= toxicity.LEAST

    chosen = {g for g in set().union(*sets.values()) if statistic(g)}
    assert len(model.chosen) == len(chosen)
    code = {}
    for g in chosen:
        h = 0
        for c in g:
            h = (h * 0xD6E8FEB86659FD93 + ord(c) + 1) % (1 << 64)
        code[g] = int(toxicity.mix(np.array([(h + len(g) * int(toxicity.STEP)) % (1 << 64)], np.uint64))[0])
    weight = dict(zip(model.chosen.tolist(), model.weight.tolist()))
    assert set(code.values()) == set(weight)
    for r in toxicity.score(docs, model).collect():
        z = model.bias + sum(weight[code[g]] for g in chosen if g in r["text"])
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-9
