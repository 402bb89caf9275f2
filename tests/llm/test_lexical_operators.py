"""Phrase mining, packing and spelling variants against plain Python, with nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayflux.llm import packing, phrases, variants
from wayflux.llm.common import Stages

LOW = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
WORDS = ["Ab", "cd", "éf", "gh", "IJ", "kl", "mn", "öp"]


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", "", ",", ".", "\n", "\t", "  "]) for _ in range(n))


def plain_phrases(rows, support, top):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        sizes[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    out = {}
    for lang, f in counts.items():
        f = {p: a for p, a in f.items() if a >= support}
        found = []
        for p, a in f.items():
            s = p.split(" ")
            if len(s) < 2 or any(len(q.split(" ")) > len(s) and f" {p} " in f" {q} " and 100 * b >= 50 * a for q, b in f.items()):
                continue
            cuts = [(10**6 * a * a // (f[" ".join(s[:k])] * f[" ".join(s[k:])]), k, f[" ".join(s[:k])], f[" ".join(s[k:])]) for k in range(1, len(s))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, p.encode(), p, left, right))
        for rank, (score, a, _, p, left, right) in enumerate(sorted(found)[:top], 1):
            out[lang, rank] = (p, -a, left, right, sizes[lang], -score)
    return out


@pytest.mark.parametrize("shards, held", [(4, 1 << 19), (1, 64), (25, 64)])
def test_phrases_equal_a_plain_count(spark, monkeypatch, shards, held):
    monkeypatch.setattr(phrases, "HELD", held)
    rng = random.Random(3)
    rows = [(rng.choice(["en", "en", "fr", "und", None]), prose(rng, rng.randrange(40))) for _ in range(120)]
    rows += [("en", None), (None, None), ("fr", ""), ("fr", " .,; \n"), ("xx", "x" * 4000), ("long", "one two three " * 5000), ("hot", "a. b? a b")]
    rows += [("en", "the very same text, twice over")] * 12
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "rank int, lang string, text string").withColumns({"phrase": F.lit("x"), "n": F.lit(1), "g": F.lit(2)})
    got = phrases.collocations(df, support=4, shards=shards, top=20).collect()
    assert {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got} == plain_phrases(rows, 4, 20)
    assert phrases.collocations(df.limit(0)).count() == 0


FEW = ["ab", "bc", "cd", "de", "ef", "fg", "gh", "hi", "ij", "jk", "kl"]


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    """Eleven words on hashes of six bits: some seeds do not tell all of them apart."""
    monkeypatch.setattr(phrases, "HASH_BITS", 6)
    tried, real = [], phrases.word_names
    monkeypatch.setattr(phrases, "word_names", lambda texts, seed: tried.append(seed) or real(texts, seed))
    rows = [("en", (" ".join(FEW) + " ") * 6)]
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string"), support=4, top=50).collect()
    assert {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got} == plain_phrases(rows, 4, 50)
    assert len(tried) > 1


def test_long_phrases_and_large_numbers(spark):
    stages = Stages(spark, "test")
    df = spark.createDataFrame([("en", "a b c d e. " * 30), ("en", "b c d. " * 20)], "lang string, text string")
    frequent, known, sizes = phrases.frequent_phrases(df, stages, max_words=5, support=25)
    assert {r["phrase"]: r["f"] for r in phrases.spelled(frequent, known, 5).collect() if len(r["w"]) > 3} == {"a b c d": 30, "b c d e": 30, "a b c d e": 30}
    assert sizes.first()["n"] == 30 * 5 + 20 * 3
    a, b, c = 3 * 10**12, 7 * 10**12, 4 * 10**12  # beyond 64 bits
    score = F.expr("cast(a as decimal(18,0)) * cast(a as decimal(18,0)) * 1000000 div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    assert spark.createDataFrame([(a, b, c)], "a long, l long, r long").select(score).first()[0] == 10**6 * a * a // (b * c)


ODD = [None, "", " ", "\n\n \t", "x" * 5000, "<|endoftext|> it's 'LL", "naïve 漢字 \u0085 ok", "word " * 3000, "12 345 678"]


def test_pieces_are_the_tokenizers_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(1)
    texts = [prose(rng, rng.randrange(300)) for _ in range(40)] + ODD + ["same"] * 5
    df = spark.createDataFrame([(None if i % 17 == 3 else i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumns({"length": F.lit("x"), "offset": F.lit(0)})
    packed = packing.pack(df, path, 2, tokens=64, with_ids=True).collect()
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    want = Counter()
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 64 + 1
        for n, (s, e) in enumerate(zip([0, *range(first, len(ids), 64)], range(first, len(ids) + 1, 64))):
            want[None if i % 17 == 3 else i // 2, n, s, e - s, tuple(ids[s:e])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, tuple(r.ids)) for r in packed) == want
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in packed)
    by = defaultdict(list)
    for r in packed:
        by[r.sequence_id].append((r.offset, r.length, r.ids))
    for held in by.values():
        ends = np.cumsum([x[1] for x in sorted(held)])
        assert [x[0] for x in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= 64
    total = sum(r.length for r in packed)
    assert -(-total // 64) <= len(by) <= -(-total // 64) + 1
    whole = packing.sequences(packing.pack(df, path, 2, tokens=64, with_ids=True)).collect()
    assert sorted(map(tuple, (r.ids for r in whole))) == sorted(tuple(i for _, _, ids in sorted(held, key=lambda x: x[0]) for i in ids) for held in by.values())
    assert packing.pack(df.limit(0), path, 2).count() == 0


def plain_best_fit(lengths, tokens, documents, cost, weights):
    """One piece at a time: the sequence with the least weighted norm of what is left, or a new one."""
    whole, bins = np.array([tokens, documents, cost]), []
    for n in sorted(lengths, reverse=True):
        need = np.array([n, 1, n * n])
        fits = [k for k, left in enumerate(bins) if (left >= need).all()]
        if not fits:
            bins.append(whole - need)
            continue
        k = min(fits, key=lambda k: (np.array(weights) * ((bins[k] - need) / whole) ** 2).sum())
        bins[k] = bins[k] - need
    return len(bins)


@pytest.mark.parametrize("rule", packing.RULES)
@pytest.mark.parametrize("tokens, documents, cost", [(50, None, None), (50, 3, None), (50, 8, 900), (64, 2, 1200)])
def test_plans_hold_every_limit(rule, tokens, documents, cost):
    rng = np.random.default_rng(5)
    longest = packing.longest_piece(tokens, cost)
    for top in (longest, longest // 2, 3):
        lengths = rng.integers(1, top + 1, 400).tolist()
        counts = Counter(lengths)
        plan = packing.plan(counts, tokens, documents, cost, rule=rule)
        held = Counter()
        for many, pieces in plan:
            assert sum(n * c for n, c in pieces) <= tokens and sum(c for _, c in pieces) <= (documents or tokens) and sum(n * n * c for n, c in pieces) <= (cost or tokens**2)
            for n, c in pieces:
                held[n] += many * c
        assert held == counts
        used = sum(many for many, _ in plan)
        least = max(-(-sum(lengths) // tokens), -(-len(lengths) // (documents or tokens)), -(-sum(n * n for n in lengths) // (cost or tokens**2)))
        assert least <= used <= 1.25 * least + 2
        if rule == "norm":
            assert used <= plain_best_fit(lengths, tokens, documents or tokens, cost or tokens**2, (1.0, 0.1, 0.1)) + 1


def plain_variants(rows, slip=31, chars=7):
    count = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if slip and h % slip == 0:
                p = h % len(w)
                w = w[:p] + w[p + 1 :]
            if len(w) >= chars:
                count[w] += 1
    count = {w: n for w, n in count.items() if n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    out, form = {}, {}
    for w, n in count.items():
        close = [v for v in count if abs(len(v) - len(w)) < 2 and near(v, w)]
        best = min(close, key=lambda v: (-count[v], v), default=None)
        if best and count[best] >= 10 * n:
            form[w] = best
        out[w] = (n, len(close), count[form[w]] if w in form else None)
    for w in out:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, *out[w])
    return out


@pytest.mark.parametrize("block", [8192, 16, 3])
def test_variants_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(variants, "BLOCK_WORDS", block)
    rng = random.Random(2)
    base = ["".join(rng.choice("abcé") for _ in range(rng.choice([7, 8, 9, 12]))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "Übergröße", "x" * 90]
    words = []
    for w in base:
        words += [w] * rng.choice([2, 30, 350])
        for _ in range(14):
            k, c = rng.randrange(len(w) + 1), rng.choice("abcéz÷")
            words += [rng.choice([w[:k] + c + w[k:], w[:k] + c + w[k + 1 :], w[:k] + w[k + 1 :]])] * rng.choice([1, 2, 2, 3, 25])
    rng.shuffle(words)
    rows = [(i, rng.choice([" ", "-", "\n", "漢"]).join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    rows += [(None, "Nulls nulledid nulledid"), (3, "repeated rowwise"), (3, "repeated rowwise"), (5, None), (6, ""), (7, "aaaaaaab " * 4000), (8, ("q" * 3000 + " ") * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("x"), "n": F.lit(0), "block": F.lit(1)})
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants.spelling_variants(df).collect()}
    assert got == plain_variants(rows)
    assert len({r[1] for r in got.values()}) < len(got) and any(f and f != r for f, r, *_ in got.values())
    assert variants.spelling_variants(df.limit(0)).count() == 0


def test_blocks_that_are_skipped_hold_no_near_word():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(7, 12))) for _ in range(600)})
    blocks = [words[k : k + 5] for k in range(0, len(words), 5)]
    directory = variants.Directory(list(range(len(blocks))), [b[0] for b in blocks], [b[-1] for b in blocks])
    whole = variants.SortedList(words)
    pairs = {(words[i], words[j]) for i, j in zip(*whole.near(words))}
    for own, block in enumerate(blocks):
        for w in block:
            seen = {own, *directory.visited(w, own)}
            assert all(words.index(v) // 5 in seen for a, v in pairs if a == w)


def test_crc_of_two_strings_from_their_own():
    rng = np.random.default_rng(1)
    pairs = [(bytes(rng.integers(0, 256, rng.integers(0, 30), dtype=np.uint8)), bytes(rng.integers(0, 256, rng.integers(0, 65), dtype=np.uint8))) for _ in range(200)]
    seed, size, own = (np.array(x) for x in zip(*((zlib.crc32(a), len(b), zlib.crc32(b)) for a, b in pairs)))
    assert variants.crc_after(seed.astype(np.uint32), size, own.astype(np.uint32)).tolist() == [zlib.crc32(a + b) for a, b in pairs]
