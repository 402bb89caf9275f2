"""Word-level operators against plain Python, with nulls, empty and long texts, ties, repeats, clashing names, empty tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayflux.llm import decontaminate, jaccard, maxent, spans, tokens

ODD = [None, "", " \n\t", "a", "Ünï cödé É", "x" * 5000, "the same words again " * 4000]
WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in ("x", "y", "z", "w", "é")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.15 else "") for _ in range(n))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t) for i, t in zip(ids or range(len(texts)), texts, strict=True)], "doc_id long, text string")


def test_words_in_blocks_equal_one_block(monkeypatch):
    text = ("Abc  déf\tx\n" * 900 + "y" * 700 + " end").encode()
    raw = np.frombuffer(text, np.uint8)
    bounds = np.array([0, len(raw)])
    whole = tokens.words(raw, bounds)
    monkeypatch.setattr(tokens, "BLOCK", 128)
    parts = tokens.words(raw, bounds)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert [text[a:b].decode().lower() for a, b in zip(*whole[:2], strict=True)] == split(text.decode())


def test_passages_equal_plain_search(spark):
    rng = random.Random(1)
    items = [prose(rng, n) for n in (40, 20, 13, 12, 3, 1)] + [None, "...", prose(rng, 15)]
    ids = [1, 2, 3, 4, 5, None, 7, 8, 2]
    docs = [prose(rng, 60) + " " + items[k].upper() + " " + prose(rng, 30) for k in (0, 1, 2, 3, 8)] + [" ".join(items[0].split()[:12]), items[4], items[4]] + ODD
    item = spark.createDataFrame(list(zip(ids, items, strict=True)), "item_id long, text string")
    for size in (1 << 20, 64):  # one block of items, many blocks
        found = decontaminate.find_passages(frame(spark, docs).withColumn("passages", F.lit(1)), item, block_bytes=size)
        got = {r["doc_id"]: r for r in decontaminate.digest(found).collect()}
        word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        for d, text in enumerate(docs):
            w, hit, names = word.findall(lower(text)), set(), set()
            for i, t in zip(ids, items, strict=True):
                own = word.findall(lower(t))
                m = min(13, len(own))
                windows = {tuple(own[k : k + m]) for k in range(len(own) - m + 1)} if m else set()
                for k in range(len(w) - m + 1 if m else 0):
                    if tuple(w[k : k + m]) in windows:
                        hit.update(range(k, k + m))
                        names.add("" if i is None else str(i))
            r = got[d]
            digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
            assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (len(w), len(hit), len(names), digest)
            assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
    empty = decontaminate.digest(decontaminate.find_passages(frame(spark, docs), item.limit(0)))
    assert empty.agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.find_passages(frame(spark, docs).limit(0), item).count() == 0


def components(sets, percent):
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_jaccard_classes_equal_all_pairs(spark, n, percent):
    rng = random.Random(n)
    docs = list(ODD)
    for size in (4, 6, 8, 12, 25, 60, 160):
        for _ in range(3):
            base = prose(rng, size).split()
            docs += [" ".join(base)] * 2
            for _ in range(8):
                near = list(base)
                for _ in range(rng.randint(1, max(1, size // 20))):
                    near[rng.randrange(size)] = rng.choice(WORDS)
                docs.append(" ".join(near[: size - rng.randint(0, 2)]))
    order = list(range(len(docs)))
    rng.shuffle(order)
    df = spark.createDataFrame([(d, docs[d]) for d in order] + [(None, None), (None, docs[-1]), (7, docs[7])], "doc_id long, text string").withColumn("n", F.lit("clash"))
    out = [r for r in jaccard.jaccard_classes(df, n, percent).collect()]
    sets = {}
    for d, text in enumerate(docs):
        w = split(text)
        sets[d] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    want = components(sets, percent)
    got = {r["doc"]: r for r in out if r["doc"] is not None}
    assert {d: got[d]["component_id"] for d in want} == want
    assert {d: got[d]["n_shingles"] for d in want} == {d: len(s) for d, s in sets.items()}
    assert len(out) == df.count()
    assert sorted((r["component_id"] is None, r["n_shingles"]) for r in out if r["doc"] is None) == sorted([(True, 0), (False, len(sets[len(docs) - 1]))])
    assert jaccard.jaccard_classes(df.limit(0), n, percent).count() == 0


def test_buckets_in_cells_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    base = prose(rng, 60).split()
    docs = []
    for _ in range(120):
        near = list(base)
        for _ in range(rng.randint(0, 5)):
            near[rng.randrange(60)] = rng.choice(WORDS)
        docs.append(" ".join(near))
    df = frame(spark, docs)
    whole = {r["doc"]: r["component_id"] for r in jaccard.jaccard_classes(df, 4, 85).collect()}
    monkeypatch.setattr(jaccard, "CELL", 16)
    assert {r["doc"]: r["component_id"] for r in jaccard.jaccard_classes(df, 4, 85).collect()} == whole
    sets = {d: {tuple(w[k : k + 4]) for k in range(57)} for d, w in enumerate(t.split() for t in docs)}
    assert whole == components({d: {tuple(map(lower, x)) for x in s} for d, s in sets.items()}, 85)


def test_repeated_spans(spark):
    rng = random.Random(5)
    sentence = lambda k: " ".join(rng.choice(WORDS) for _ in range(k)) + "."
    passage = " ".join(sentence(9) for _ in range(7))
    clean = [" ".join(sentence(8) for _ in range(12)) for _ in range(6)]
    docs = [clean[0] + "\n" + passage + "\n" + clean[1], clean[2] + " " + passage, clean[3], passage + " " + clean[4] + " " + passage, clean[5], clean[5], *ODD[:4]]
    df = frame(spark, docs).withColumn("sentences", F.lit(1)).withColumn("version", F.lit(2)).repartition(3)
    out = {r["doc_id"]: r for r in spans.remove_repeats(df.union(df.filter("doc_id = 3"))).collect()}
    assert out[0]["text"] == docs[0] and out[2]["text"] == docs[2]
    assert out[1]["text"].strip() == clean[2].strip()
    assert out[3]["text"].strip() == clean[4].strip()
    assert out[4]["text"] == docs[4] and out[5]["text"] == ""
    assert [out[d]["text"] for d in range(6, 10)] == docs[6:]
    assert out[1]["removed"]["removed"] == 7
    assert out[0]["version"] == 2
    long = frame(spark, [ODD[-1], "z " + ODD[-1]])
    kept = {r["doc_id"]: r["text"] for r in spans.remove_repeats(long).collect()}
    assert len(kept[1]) < 200 < len(kept[0]) + 200
    assert spans.remove_repeats(df.limit(0)).count() == 0


def test_runs_cover_repeats_to_both_ends(spark):
    rng = random.Random(11)
    sentence = lambda k: " ".join(rng.choice(WORDS) + str(rng.randrange(10**6)) for _ in range(k)) + "."
    passages = [" ".join(map(sentence, sizes)) for sizes in ((10, 11, 12, 9, 10), (10, 12, 9), (19, 1, 1), (1, 1, 30, 2))]
    passages += [" ".join(sentence(rng.randint(lo, hi)) for _ in range(8)) for lo, hi in ((4, 14), (6, 18), (5, 25), (1, 60)) for _ in range(10)]
    docs, wanted = [], []
    for passage in passages:
        for _ in range(2):
            ends = [" ".join(sentence(rng.randint(4, 14)) for _ in range(4)) for _ in range(2)]
            docs.append(f"{ends[0]} {passage} {ends[1]}")
            wanted.append(docs[-1] if len(docs) % 2 else f"{ends[0]} {ends[1]}")
    flow = [" ".join(sentence(1)[:-1] for _ in range(51)) for _ in range(20)]
    for passage in flow:  # without stops, begun and left in mid-sentence
        for _ in range(2):
            ends = [" ".join(sentence(1)[:-1] for _ in range(rng.randint(0, 30))) for _ in range(2)]
            docs.append(f"{ends[0]} {passage} {ends[1]}")
            wanted.append(docs[-1] if len(docs) % 2 else " ".join(ends))
    # a long sentence entered in its middle, and the short ones behind it
    tail = " ".join([sentence(45), sentence(7), sentence(9)])
    docs += [sentence(20)[:-1] + " " + tail, sentence(3)[:-1] + " " + tail]
    wanted += [docs[-2], " ".join(docs[-1].split()[:3])]
    got = {r["doc_id"]: r["text"] for r in spans.remove_repeats(frame(spark, docs).repartition(3)).collect()}
    assert [got[d].split() for d in range(len(docs))] == [w.split() for w in wanted]


def test_runs_settled_in_turns_give_the_same(spark, monkeypatch):
    rng = random.Random(12)
    shared = [prose(rng, 60) for _ in range(5)]
    df = frame(spark, [prose(rng, 30) + "\n" + rng.choice(shared) + "\n" + prose(rng, 80) for _ in range(60)]).repartition(2).localCheckpoint()
    whole = sorted(spans.remove_repeats(df).select("doc_id", "text").collect())
    assert any(len(r["text"]) < 600 for r in whole)
    monkeypatch.setattr(spans, "HELD", 8)
    monkeypatch.setattr(spans, "row_blocks", lambda bounds: ((k, k + 1) for k in range(len(bounds) - 1)))
    assert sorted(spans.remove_repeats(df).select("doc_id", "text").collect()) == whole


def test_language_model(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(150):  # most words follow from the one before
        at, own = rng.randrange(30), []
        for _ in range(rng.randint(1, 80)):
            at = (at + 1) % 30 if rng.random() < 0.9 else rng.randrange(30)
            own.append(WORDS[at])
        texts.append(" ".join(own))
    texts += ODD
    df = frame(spark, texts).withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in maxent.score_texts(df, F.col("doc_id") % 7 != 2).collect()}
    count = Counter()
    for d, t in enumerate(texts):
        if d % 7 != 2:
            count.update([*split(t), None])
    n, v = sum(count.values()), len(count)
    for d, t in enumerate(texts):
        own = [*split(t), None]
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(count[x] > 0 for x in own), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[x] + 1) / (n + v + 1)) for x in own), rel_tol=1e-9)
        assert r["score"] < 0
    held = [r for d, r in got.items() if d % 7 == 2 and r["n_tokens"] > 5]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert maxent.score_texts(df.limit(0), F.lit(True)).count() == 0
    none = maxent.score_texts(frame(spark, ["a b"]), F.lit(False)).first()
    assert none["n_known"] == 0 and none["base_score"] == 0.0


def test_model_probabilities_sum_to_one_at_most():
    """Over classes exactly; over the words of a class, unseen ones included, at most."""
    rng = np.random.default_rng(1)
    w = rng.normal(size=(maxent.WIDTH, maxent.CLASSES)).astype(np.float32)
    block = np.frombuffer(b"one two three four five six", np.uint8)
    t = maxent.Text(block, np.array([0, len(block)]))
    assert np.allclose(np.exp(maxent.log_softmax(maxent.logits(w, t.slots()))).sum(1), 1, atol=1e-4)
    v = maxent.Vocabulary(np.zeros(0, np.uint64), {0: (10, 3), 20: (7, 7)}, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert v.mass[0] == 14 and v.mass[20] == 15 and v.mass[1] == 1


def test_shingles_of_blocks_of_few_words():
    for n in (1, 2, 3, 4, 5, 6, 9):
        for size in range(n + 1):
            raw = np.frombuffer(" ".join(WORDS[:size]).encode(), np.uint8)
            for bounds in ([0, len(raw)], [0, 0, len(raw), len(raw)]):
                _, _, h, rows = tokens.words(raw, np.array(bounds))
                assert [len(x) for x in tokens.shingles(h, rows, n)] == [min(1, size) if b > a else 0 for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_components_without_links_take_no_rounds(spark, monkeypatch):
    stages, kept = jaccard.Stages(spark, "test"), []
    keep = stages.keep
    monkeypatch.setattr(stages, "keep", lambda df, name: kept.append(name) or keep(df, name))
    links = spark.createDataFrame([], "a long, b long")
    assert jaccard.components(links, stages, "none").count() == 0 and len(kept) == 2
    assert sorted(jaccard.components(spark.createDataFrame([(1, 2), (2, 5)], "a long, b long"), stages, "some").collect()) == [(1, 1), (2, 1), (5, 1)]
