"""Mixing, classifiers, archives, neighbours, url filter and the pipeline on small fixtures."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wayflux.llm import ann, mixing, quality, sparse, toxicity, urls, warc
from wayflux.llm.queries import RULES


def test_shares_and_flow_against_all_splits():
    assert mixing.shares({"a": 10, "b": 1000, "c": 1000}, {"a": 3, "b": 1, "c": 2}, 600, 3) == {"a": 30.0, "b": 190.0, "c": 380.0}
    patterns, quotas = [(4, (0,)), (3, (0, 1)), (2, (1,))], [5.0, 6.0]
    flow = mixing.min_cost_flow(patterns, quotas, [0.0, 1.0, 4.0])
    got = [sum(f.values()) for f in flow]
    assert sum(got) == pytest.approx(11) and all(f.keys() <= set(own) for f, (_, own) in zip(flow, patterns, strict=True))
    cost = lambda used, size: sum(c * min(size, max(0, used - k * size)) for k, c in enumerate([0, 1, 4]))
    best = min(cost(a, 4) + cost(b + c, 3) + cost(d, 2) for a, b, c, d in itertools.product(range(13), range(10), range(10), range(7)) if a + b == 5 and c + d == 6 and b + c <= 9)
    assert sum(cost(u, s) for u, (s, _) in zip(got, patterns, strict=True)) == pytest.approx(best)


def test_mix_reaches_targets_and_repeats_itself(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "c", None]) if i % 3 else "hot", " w" * rng.randint(0, 60), "x") for i in range(900)] + [(None, "a", None, "x"), (5, "b", "w w", "y"), (5, "b", "w w", "y")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, rest string")
    df = df.withColumn("words", mixing.word_count(F.col("text")))
    run = lambda d: mixing.mix_sources(d, F.array("source"), mixing.cycled, F.col("words"), ["doc_id"])
    out, sizes, targets = run(df)
    got = out.collect()
    assert len(got) == len(rows) and sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for s, t in targets.items():
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - t) <= 2
        assert all(r["taken"] <= 3 * r["words"] and (r["words"] == 0 or r["taken"] % r["words"] == 0) for r in own)
    again = run(df.repartition(5))[0].collect()
    key = lambda r: (str(r["doc_id"]), r["words"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert run(df.limit(0))[0].count() == 0
    assert [r[0] for r in spark.createDataFrame([("",), (None,), (" a\x0bb\t",), ("\n",), ("é x",)], "t string").select(mixing.word_count(F.col("t"))).collect()] == [0, 0, 2, 0, 2]


def test_overlapping_members_fill_both_sources(spark):
    df = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["a"], 10) for i in range(100)], "id long, m array<string>, n int")
    out, sizes, targets = mixing.mix_sources(df, F.col("m"), lambda s: dict.fromkeys(s, 1), F.col("n"), ["id"])
    assert sizes == {"a": 1000, "b": 500}
    taken = {r["m"][-1]: r["t"] for r in out.groupBy("m").agg(F.sum("taken").alias("t")).collect()}
    assert sum(taken.values()) == 1000 and taken["b"] >= 500


def test_factorisation_machine_identity_and_learning():
    rng = np.random.default_rng(4)
    m = sparse.Model(0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    idx, x = np.array([0, 2, 5, 1]), rng.normal(size=4)
    plain = 0.3 + (m.w[idx] * x).sum() + sum(m.v[idx[i]] @ m.v[idx[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert m.margin(idx, x, np.array([0, 4, 4])) == pytest.approx([plain, 0.3])
    # exclusive or: no linear model can do it
    rows = rng.integers(0, 2, (400, 2))
    idx = (rows + np.array([0, 2])).ravel()
    fit = sparse.fit(idx, np.ones(800), np.arange(0, 801, 2), (rows[:, 0] ^ rows[:, 1]).astype(float), 4, rank=4, epochs=60)
    assert ((fit.score(idx, np.ones(800), np.arange(0, 801, 2)) > 0.5) == (rows[:, 0] ^ rows[:, 1])).mean() > 0.95


@pytest.mark.parametrize("which", ["quality", "toxic"])
def test_classifiers_on_held_out_rows(spark, which):
    rng = random.Random(6)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed", "do"]
    rows, labels = [], []
    for i in range(400):
        y = i % 3 == 0
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        if y and which == "toxic":
            text.insert(rng.randrange(len(text)), rng.choice(["stupid", "vilegrub"]))
        if which == "quality" and not y:
            text = [w + rng.choice(["###", "$$$", "%%%"]) for w in text]
        rows.append((i, " ".join(text), None if i % 5 else len(text)))
        labels.append((i, int(y), int(y)))
    rows += [(None, "a", 1), (9000, None, None), (9001, "", 0), (9002, "x" * 20000, 1), (3, rows[3][1], 3)]
    labels += [(None, 1, 1), (9999, 1, 1), (0, None, None), (3, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("label", F.lit("clash"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fn = quality.classify if which == "quality" else toxicity.classify
    extra = {"meta": ("n_chars",)} if which == "quality" else {}
    df = df.drop("label")
    got = fn(df, lab, "score", usable=F.col("doc_id") % 4 != 2, **extra).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and r["doc_id"] % 4 == 2]
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in held]) > 0.95
    assert fn(df.limit(0), lab, "score", **extra).count() == 0
    none = {r["score"] for r in fn(df, lab.limit(0), "score", **extra).collect()}
    assert len(none) == 1 and none.pop() == pytest.approx(0.5)


def test_archives_round_trip(spark, tmp_path):
    big = "é" * 700
    rows = [(i, f"http://{'abc'[i % 3]}.example.org/p/{i}", big if i % 4 == 0 else f"<p>{i}</p>" * (i * 9)) for i in range(120)]
    rows += [(200, None, None), (201, "no scheme", ""), (202, "http://x.y/\r\nEvil: 1", big), (None, "http://n.n/", big), (203, "http://a.example.org/p/3", "short"), (203, "http://a.example.org/p/3", "short")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("kind", F.lit("clash")).repartition(3)
    captures, shards, folder = warc.archive(df, str(tmp_path / "w"))
    back = warc.read_records(warc.lookup(captures.select("surt", "page"), shards, folder), folder, payloads=True).collect()
    assert len(back) == len(rows)
    want = {}
    for p, _, h in rows:
        raw = (h or "").encode()
        again = h == big and p != 202
        want[p] = (len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", 202 if again else None, b"" if again else raw)
    assert all((r["size"], r["sha1"], r["kind"], r["refers"], bytes(r["payload"])) == want[r["page"]] for r in back)
    some = spark.createDataFrame([(warc.surt(rows[5][1]), "5"), (warc.surt(rows[5][1]), "6"), ("zz", "1"), ("", "200")], "surt string, page string")
    assert sorted(r["page"] for r in warc.lookup(some, shards, folder).collect()) == ["200", "5"]
    none = warc.archive(df.limit(0), str(tmp_path / "e"))
    assert none[0].count() == 0 and none[1].count() == 0


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(12, 16))
    v = (centre[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))).astype(np.float32)
    v[700:900] = v[0]  # copies: ties go to the smaller ids
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [None] * 16), (2200, [1.0]), (None, v[1].tolist())]
    df = spark.createDataFrame(rows + odd + rows[:2], "vec_id long, embedding array<float>").withColumn("h", F.lit(0))
    sample = v[::2].astype(float)
    router = ann.Router(sample, 8)
    assert 1 <= router.probes <= 8
    for r in (None, router):
        got = {}
        for x in ann.search(df, F.col("vec_id") % 50 == 0, router=r).collect():
            got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
        u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
        hits = 0
        for q in range(0, 1500, 50):
            s = u @ u[q]
            s[q] = -2
            best = np.lexsort((np.arange(1500), -np.round(s, 12)))[:5]
            mine = [i for _, i, _ in sorted(got[q])]
            hits += len(set(best) & set(mine))
            if q in (0, 700, 750, 800, 850):
                assert mine == best.tolist()
        assert set(got) == set(range(0, 1500, 50))
        assert hits >= 0.9 * 150
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
    cut = ann.balanced_cut(ann.neighbour_graph(ann.unit(sample)), 8)
    assert np.bincount(cut).max() - np.bincount(cut).min() <= 3


def test_every_query_finds_k_where_there_are_k(spark):
    """Partitions of few rows, one of them asked; queries of another length than most vectors."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(60, 8))
    router = ann.Router(vectors, 16, steps=30)
    router.probes = 1
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(100 + i, [1.0, 2.0, 3.0, float(i)]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, (F.col("vec_id") % 4 == 0) | (F.col("vec_id") >= 100), router=router).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(range(0, 60, 4)) and all(len(v) == 5 for v in got.values())
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    best = {q: set(np.argsort(-(unit @ unit[q]))[1:6].tolist()) for q in got}
    assert sum(len(best[q] & set(v)) for q, v in got.items()) > 25
    few = df.filter("vec_id < 4")
    assert ann.search(few, F.lit(True), router=router).count() == 12


def test_url_rules_and_templates(spark):
    rows = [("http://A.net/x", "a.net", "/x", "net/", "block"), ("http://sub.Example.net/en/1?q#f", "sub.example.net", "/en/1", "example.net/en/", "allow"),
            ("http://example.com/de/2", "example.com", "/de/2", "example.com/de/", "block"), ("https://w.org/fr/", "w.org", "/fr/", "org/fr/", "allow"),
            ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"), ("http://a.net", "a.net", "", None, None), ("nothing", "", "", None, "allow"), (None, "", "", None, "allow"), ("x://h#f", "h", "", None, "allow")]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "page_id long, url string").withColumn("template", F.lit("clash"))
    got = {r["page_id"]: r for r in urls.judge(df, RULES).select("page_id", "_url.*").collect()}
    for i, r in enumerate(rows):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == r[1:4]
        assert r[4] is None or got[i]["verdict"] == r[4]
    # one branch of a host is bad, the other good; an unlabelled page follows its branch
    pages = [(f"http://h.io/{'spam' if k % 2 else 'news'}/{k}", k % 2 if k < 60 else None) for k in range(80)] + [(f"http://h.io/{'abcdefghijklmnopqrstuvwxyz'[k % 26]}{k}x/1", 0) for k in range(300)]
    df = spark.createDataFrame(pages, "url string, bad int")
    got = {r["url"]: r for r in urls.judge(df, [], labels=F.col("bad")).select("url", "_url.verdict", "_url.template").collect()}
    assert got["http://h.io/spam/71"]["verdict"] == "block" and got["http://h.io/news/70"]["verdict"] == "allow"
    assert len({r["template"] for r in got.values()}) < 20
    assert urls.judge(df.limit(0), RULES).count() == 0


def test_url_rules_say_nothing_beyond_their_path(spark):
    rules = [("block", "example.com", "/de/"), ("block", "years.org", "/2019/"), ("block", "two.org", "/a/b/"), ("block", "two.org", "/d/")]
    paths = ["b.example.com/de/", "b.example.com/en/", "b.example.com/fr/", "b.example.com/de", "years.org/2019/", "years.org/2020/", "two.org/a/b/c/", "two.org/a/c/", "two.org/d/c/", "none.org/x/"]
    df = spark.createDataFrame([(f"http://{p}{k}" if p.endswith("/") else f"http://{p}",) for p in paths for k in range(40)], "url string")
    got = urls.judge(df, rules).groupBy(F.regexp_extract("url", "//(.*?)[0-9]*$", 1).alias("p")).agg(F.collect_set("_url.verdict").alias("v"), F.collect_set("_url.rule").alias("r")).collect()
    assert {r["p"]: r["v"] for r in got} == {p: ["block"] if p in ("b.example.com/de/", "years.org/2019/", "two.org/a/b/c/", "two.org/d/c/") else ["allow"] for p in paths}
    assert all(bool(r["r"]) == (r["v"] == ["block"]) for r in got)


def plain_judgement(pages, rules):
    """The template tree and the purities by plain loops: {url: (template, purity, evidence, verdict)}."""
    def rule_of(host, path):
        fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        return max(fits, key=lambda r: len(r[1] + r[2]), default=None)

    def typed(segment):
        segment = re.sub(r"(?i)\b(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{8,}\b", "<x>", segment)
        return re.sub("[0-9]+", "<n>", segment)

    def kinds(segs):
        return "".join("n" if s == "<n>" else "x" if "<x>" in s else "m" if "<n>" in s else "w" for s in segs)

    shapes, of_url = {}, {}
    for url in pages:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        segs, rule = tuple(typed(s) for s in path.split("/") if s), rule_of(host, path)
        segs = segs if len(segs) <= 4 else (*segs[:4], "**")
        of_url[url] = host, rule is not None, segs, rule
        n, labelled, bad = shapes.get((host, rule is not None, segs), (0, 0, 0))
        shapes[host, rule is not None, segs] = n + 1, labelled + (rule is not None), bad + (rule is not None and rule[0] == "block")
    template = {s: () for s in shapes}
    for level in range(max(len(s[2]) for s in shapes)):
        nodes = {}
        for s in shapes:
            if len(s[2]) > level:
                nodes.setdefault((s[0], s[1], template[s]), {}).setdefault(s[2][level], []).append(s)
        for branches in nodes.values():
            size = {b: [sum(shapes[s][k] for s in own) for k in range(3)] for b, own in branches.items()}
            every = [sum(v[k] for v in size.values()) for k in range(3)]
            rare = {b for b, v in size.items() if len(size) >= urls.FAN_OUT and v[0] * urls.FAN_OUT < every[0]}
            below = {b: Counter() for b in rare}
            for b in rare:
                for s in branches[b]:
                    below[b][kinds(s[2][level + 1 :])] += shapes[s][0]
            pool = sum(below.values(), Counter())
            free, total = len(pool) - 1, sum(pool.values())
            labels = sum(v[1] > 0 for v in size.values())
            for b, own in branches.items():
                n, labelled, bad = size[b]
                if b in rare:
                    x2 = sum(c * c * total / pool[k] for k, c in below[b].items()) / n - n
                    cut = 2 / (9 * free) if free else 0
                    pooled = not (free > 0 and n >= urls.EXPECTED * (free + 1) and x2 > free * (1 - cut + 1.645 * cut**0.5) ** 3)
                else:
                    p = every[2] / every[1] if every[1] else 0
                    differs = labelled and 0 < p < 1 and abs(bad / labelled - p) > 1.96 * (p * (1 - p) / labelled) ** 0.5
                    pooled = labelled > 0 and labels > 1 and not differs
                for s in own:
                    template[s] += ("*" if pooled else b,)
    known = [(v[1], v[2]) for v in shapes.values()]
    overall = (sum(b for _, b in known) + 2) / (sum(x for x, _ in known) + 4)
    out = {}
    for url, (host, fits, segs, rule) in of_url.items():
        mine = [s for s in shapes if s[:2] == (host, fits) and template[s] == template[host, fits, segs]]
        if fits:
            on_host = [v for s, v in shapes.items() if s[:2] == (host, True)]
            prior = (sum(v[2] for v in on_host) + 4 * overall) / (sum(v[1] for v in on_host) + 4)
            seen = [shapes[s] for s in mine]
        else:
            prior = (0 + 4 * 0.5) / 4
            seen = [v for s in mine for o, v in shapes.items() if o[0] != host and o[2] == s[2] and v[1]]
        evidence, bad = sum(v[1] for v in seen), sum(v[2] for v in seen)
        purity = (bad + 4 * prior) / (evidence + 4)
        verdict = rule[0] if rule else "block" if purity >= urls.BLOCK_FROM else "allow"
        out[url] = "/" + "/".join(template[host, fits, segs]), round(purity, 9), evidence, verdict
    return out


def test_templates_and_purities_equal_plain_loops(spark):
    rng = random.Random(5)
    hosts = ["a.net", "b.net", "x.example.net", "p.example.com", "q.example.com", "r.org", "s.org", "t.io"]
    rules = RULES + [("block", "t.io", "/u/bad/"), ("allow", "t.io", "/u/good/")]
    pages = []
    for h in hosts:
        for k in range(120):
            pages.append(f"http://{h}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.choice([str(k), f'{k}.html', 'abc12345f'])}")
        for k in range(60):  # rare branches, some with another kind of rest
            pages.append(f"https://{h}/tag{chr(97 + k % 26)}{chr(97 + k % 7)}/{'x/y/z' if k % 26 == 3 else k}")
    pages += [f"http://t.io/u/{w}/{k}" for w in ("bad", "good", "unknown") for k in range(40)]
    pages += [f"http://t.io/odd/{'one' if k % 2 else 'two'}" for k in range(9)] + [f"http://t.io/{'long/' * 300}{k}" for k in range(3)] + [None, "", "nothing", "http://r.org"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(pages)], "page_id long, url string")
    got = {r["url"]: (r["template"], round(r["purity"], 9), r["evidence"], r["verdict"]) for r in urls.judge(df, rules, levels=4).select("url", "_url.*").collect()}
    want = plain_judgement(pages, rules)
    assert got == want
    free = [v for u, v in want.items() if u and not any(x in u for x in (".net", "/de/", "/fr/")) and v[2]]
    assert {v[3] for u, v in want.items() if u and ".org/de/" in u} == {"block"} and {v[3] for v in free} == {"allow", "block"}
    assert {v[3] for u, v in want.items() if u and "example.com/en/" in u} == {"allow"}


def test_pipeline_stages_against_their_operators(spark):
    root = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    cols = docs.columns
    assert len(corpus_pipeline.STAGES) == 5
    kept, before = docs, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, root)
        assert kept.columns == cols
        now = kept.count()
        assert 0 < now <= before
        before = now
    out = corpus_pipeline.run(spark, root)
    assert out.count() == before and {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in kept.select("doc_id").collect()}
    clash = docs.withColumns({"quality": F.lit(1), "passages": F.lit("x"), "taken": F.lit(2), "size": F.lit(0)})
    for _, stage in corpus_pipeline.STAGES[2:]:
        assert set(clash.columns) <= set(stage(spark, clash, root).columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), root).count() == 0


def test_fit_gets_small_numbers_in_the_order_of_ids(spark, monkeypatch):
    rows = [(i * 7919 % 101, f"word{i} word{i % 3} " * (i % 5)) for i in range(101)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sample = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"))
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda idx, x, bounds, y, *rest: seen.update(idx=idx, x=x, bounds=bounds, y=y))
    quality.train(df, sample)
    assert seen["idx"].itemsize == seen["x"].itemsize == 4
    assert seen["y"].tolist() == [i % 2 for i in range(101)]
    text = dict(rows)
    for i in range(101):
        data = np.frombuffer(text[i].encode(), np.uint8)
        idx, x, _ = quality.features(data, np.array([0, len(data)]), [])
        own = slice(seen["bounds"][i], seen["bounds"][i + 1])
        assert seen["idx"][own].tolist() == idx.tolist() and seen["x"][own].tolist() == x.astype(np.float32).tolist()
