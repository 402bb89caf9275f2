"""Registered queries of the numbered operators, over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayflux.llm import ann, decontaminate, jaccard, maxent, mixing, packing, phrases, quality, spans, toxicity, urls, variants, warc
from wayflux.llm.common import crc_fold

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
QUALITY_FROM = 0.7
TOXIC_FROM = 0.5


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed, sizes, targets = mixing.mix_sources(docs, F.array("source"), mixing.cycled, F.col("size"), ["doc_id"])
    of = spark.createDataFrame([(s, int(sizes[s]), float(targets[s])) for s in sizes], "_s string, source_size long, target double")  # one row per source
    return mixed.join(F.broadcast(of), F.col("source").eqNullSafe(F.col("_s"))).select("doc_id", "size", "source_size", "target", "taken")


def op2_quality(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text", "n_chars")
    held = crc_fold(F.col("doc_id"), 4) == 2
    out = quality.classify(docs, table(spark, root, "labels"), "score", usable=~held, meta=("n_chars",), drop=("text",))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= QUALITY_FROM).cast("int").alias("predicted"))


def op3_repeated_spans(spark: SparkSession, root: str) -> DataFrame:
    out = spans.remove_repeats(table(spark, root, "documents").select("doc_id", "text"), "spans")
    return out.select("doc_id", "text", F.col("spans.sentences").alias("n_sentences"), F.col("spans.removed").alias("n_removed"))


def op4_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find_passages(docs, table(spark, root, "benchmark"), drop=("text",)))


def op5_warc(spark: SparkSession, root: str) -> DataFrame:
    """Write, index, look every page up by its key in the index, and read the records back."""
    captures, shards, folder = warc.archive(table(spark, root, "pages"))
    back = warc.read_records(warc.lookup(captures.select("surt", "page"), shards, folder), folder)
    return back.select(F.col("page").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), F.col("kind").alias("record_type"), F.col("refers").alias("refers_to"))


def op6_neighbours(spark: SparkSession, root: str) -> DataFrame:
    return ann.search(table(spark, root, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op7_url_filter(spark: SparkSession, root: str) -> DataFrame:
    out = urls.judge(table(spark, root, "pages").select("page_id", "url"), RULES)
    return out.select("page_id", "_url.host", "_url.path", "_url.rule", "_url.verdict", "_url.template", "_url.purity", "_url.evidence")


def op8_jaccard(spark: SparkSession, root: str) -> DataFrame:
    out = jaccard.jaccard_classes(table(spark, root, "documents").select("doc_id", "text"), n=4, percent=85)
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


def op9_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    held = crc_fold(F.col("doc_id"), 5) == 0
    out = toxicity.classify(docs, table(spark, root, "labels"), "score", usable=~held, drop=("text",))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op10_language_model(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    held = crc_fold(F.col("doc_id"), 7) == 2
    return maxent.score_texts(docs.withColumn("held_out", held), ~held).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_collocations(spark: SparkSession, root: str) -> DataFrame:
    return phrases.collocations(table(spark, root, "documents").select("text", "lang"), top=2000)


def op12_best_fit(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, tokens=1024)


def op13_variants(spark: SparkSession, root: str) -> DataFrame:
    return variants.spelling_variants(table(spark, root, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_mix_sources, op2_quality, op3_repeated_spans, op4_decontaminate, op5_warc, op6_neighbours, op7_url_filter, op8_jaccard, op9_toxicity, op10_language_model, op11_collocations, op12_best_fit, op13_variants)}

SQL: dict[str, str] = {
    "op4_decontaminate": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        p AS (SELECT DISTINCT item, m, array_to_string(w[k : k + m - 1], ' ') AS win FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM (SELECT *, least(13, len(w)) AS m FROM b WHERE len(w) > 0))),
        hits AS (SELECT doc_id, k, x.m, item FROM (SELECT doc_id, m, k, array_to_string(w[k : k + m - 1], ' ') AS win FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)) x JOIN p ON p.win = x.win AND p.m = x.m),
        n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS pos FROM (SELECT DISTINCT doc_id, k, m FROM hits)) GROUP BY 1),
        i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last, CAST(strlen(body) AS BIGINT) AS size FROM p)
        SELECT page_id, size AS payload_bytes, sha1(body) AS payload_digest, CASE WHEN size >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN size >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM g""",
    "op11_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
        n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1),
        g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k)),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
        c AS (SELECT lang, k, phrase, a, j, array_to_string(s[1 : j], ' ') AS x, array_to_string(s[j + 1 : k], ' ') AS y FROM (SELECT *, string_split(phrase, ' ') AS s, unnest(range(1, k)) AS j FROM f WHERE k > 1)),
        s AS (SELECT c.*, l.a AS l, r.a AS r, CAST(1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a) AS BIGINT) AS score FROM c JOIN f l ON l.lang = c.lang AND l.phrase = x JOIN f r ON r.lang = c.lang AND r.phrase = y),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        o AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + 1], ' ') AS phrase, max(a) AS around FROM f, (VALUES (1), (2)) t(i) WHERE k = 3 GROUP BY ALL),
        k AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase AND b.k = 2 WHERE around IS NULL OR 100 * around < 50 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM k JOIN n USING (lang)
        QUALIFY rank <= 2000""",
    "op13_variants": r"""
        WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
        r AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents) WHERE length(w) >= 7 GROUP BY ALL),
        x AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM r),
        h AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || x[i : i + 1] AS BIGINT))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM x, t),
        v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN w[1 : h % length(w)] || w[h % length(w) + 2 :] ELSE w END AS word, n FROM h) WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
        d AS (SELECT word, n, k, word[1 : k - 1] || word[k + 1 :] AS less FROM (SELECT *, unnest(range(1, length(word) + 1)) AS k FROM v)),
        i AS (SELECT DISTINCT d.word, v.word AS near, d.n, v.n AS m FROM d JOIN v ON v.word = less),
        p AS (SELECT word, near, m FROM i UNION SELECT near, word, n FROM i UNION SELECT a.word, b.word, b.n FROM d a JOIN d b ON a.less = b.less AND a.k = b.k AND a.word <> b.word),
        b AS (SELECT word, count(*) AS n_near, arg_min(near, (-m, near)) AS near, max(m) AS m FROM p GROUP BY 1),
        f AS (SELECT v.word, n, CASE WHEN m >= 10 * n THEN near END AS form, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN m END AS form_n FROM v LEFT JOIN b ON b.word = v.word),
        c AS (SELECT word, word AS root FROM f WHERE form IS NULL UNION ALL SELECT f.word, c.root FROM c JOIN f ON f.form = c.word)
        SELECT f.word, form, root, n, n_near, form_n FROM f JOIN c ON c.word = f.word""",
}
