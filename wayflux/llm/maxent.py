"""Hashed maximum-entropy language model: P(word | history) = P(class | history) P(word | class).

The class factor is a softmax over sums of hashed feature weights: a bias, the word before, the two words
before together, and skips over one and over two words. Its weights come from distributed gradient updates.
The word factor has only a bias for each word, whose maximum-likelihood weights are the (smoothed) log
counts, so it comes from counts over the whole corpus.

Classes: the most frequent words have one each, all other words share GROUPS classes by their last two
bytes, unseen words too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import Stages
from wayflux.llm.tokens import FOLD, _P, mix, row_blocks, utf8, words

SINGLES, GROUPS = 15, 17
CLASSES = SINGLES + GROUPS
END, BEGIN = np.uint64(0x5BD1E9955BD1E995), np.uint64(0xC2B2AE3D27D4EB4F)
BITS = (13, 14, 13, 12)  # slots of: word before, two words before, skip over one, skip over two
OFFSETS = np.concatenate([[1], 1 + np.cumsum([1 << b for b in BITS])])
WIDTH = int(OFFSETS[-1])
ROWS = 256
KNOWN = 1 << 20
BATCH = 4096


class Text:
    """Tokens of a block of rows, an end after each row's words: hashes, groups by form, row bounds."""

    def __init__(self, block: np.ndarray, bounds: np.ndarray):
        start, end, h, rows = words(block, bounds)
        n_rows = len(bounds) - 1
        at = np.arange(len(h)) + np.repeat(np.arange(n_rows), np.diff(rows))
        self.bounds = rows + np.arange(n_rows + 1)
        self.h = np.full(len(h) + n_rows, END, np.uint64)
        self.h[at] = h
        last = FOLD[block[end - 1]].astype(np.uint64)
        before = np.where(end - start > 1, FOLD[block[np.maximum(end - 2, 0)]], 0).astype(np.uint64)
        self.group = np.full(len(self.h), -1, np.int64)
        self.group[at] = (mix(last * np.uint64(256) + before, 5) % np.uint64(GROUPS)).astype(np.int64)

    def slots(self) -> np.ndarray:
        """Rows of the weight table of every token: bias, and one per feature of its history."""
        n = len(self.h)
        place = np.arange(n) - np.repeat(self.bounds[:-1], np.diff(self.bounds))
        past = []
        for k in (1, 2, 3):
            p = np.full(n, BEGIN, np.uint64)
            p[k:] = self.h[:-k] if n > k else p[k:]
            past.append(np.where(place >= k, p, BEGIN))
        parts = (past[0], past[0] * np.uint64(_P) + past[1], past[1], past[2])
        cols = [np.zeros(n, np.int64)]
        for k, (part, bits) in enumerate(zip(parts, BITS, strict=True)):
            cols.append(OFFSETS[k] + (mix(part, 30 + k) >> np.uint64(64 - bits)).astype(np.int64))
        return np.stack(cols)


class Vocabulary:
    """What tasks know of the corpus counts: totals, class sizes, and the words with a count of N / KNOWN or more (so KNOWN at most)."""

    def __init__(self, singles: np.ndarray, per_class: dict[int, tuple[int, int]], known: np.ndarray, counts: np.ndarray):
        self.singles = np.sort(singles)
        self.n, self.v = sum(n for n, _ in per_class.values()), sum(v for _, v in per_class.values())
        self.mass = np.array([sum(per_class.get(k, (0, 0))) + 1 for k in range(CLASSES)], np.float64)
        order = np.argsort(known)
        self.known, self.counts = known[order], counts[order]

    def classes(self, h: np.ndarray, group: np.ndarray) -> np.ndarray:
        out = np.where(group >= 0, SINGLES + group, CLASSES - 1)
        if len(self.singles):
            at = np.minimum(np.searchsorted(self.singles, h), len(self.singles) - 1)
            out = np.where(self.singles[at] == h, at, out)
        return out

    def count(self, h: np.ndarray) -> np.ndarray:
        """Count of each word, -1 where the table does not have it."""
        if not len(self.known):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, self.counts[at], -1)


def _blocks(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, int, Text]]:
    data, bounds = utf8(batch.column(text))
    for i, j in row_blocks(bounds):
        yield i, j, Text(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])


def count_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """(h, group, c): every token's hash, form group and count; counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, g, c = (np.concatenate([x[k] for x in held]) for k in range(3))
            u, first, back = np.unique(h, return_index=True, return_inverse=True)
            return u, g[first], np.bincount(back, c, len(u)).astype(np.int64)

        def batch() -> pa.RecordBatch:
            u, g, c = merged()
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(g), pa.array(c)], names=["h", "group", "c"])

        for b in batches:
            for _, _, t in _blocks(b, text):
                u, first, c = np.unique(t.h, return_index=True, return_counts=True)
                held.append((u, t.group[first], c))
                size += len(u)
                if size > 1 << 21:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1 << 20:  # memory stays bounded; the sums are the same
                        yield batch()
                        held, size = [], 0
        if held:
            yield batch()

    return texts.select(text).mapInArrow(run, "h long, group long, c long").groupBy("h").agg(F.max("group").alias("group"), F.sum("c").alias("c"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Sums of the counts on the driver: SINGLES words, CLASSES class sizes, KNOWN words at most."""
    top = counts.orderBy(F.desc("c"), "h").limit(SINGLES).collect()
    singles = np.sort(np.array([r["h"] for r in top], np.int64).view(np.uint64))
    place = {int(h.view(np.int64)): k for k, h in enumerate(singles)}
    kind = F.when(F.col("group") >= 0, F.col("group") + SINGLES).otherwise(F.lit(CLASSES - 1))
    for h, k in place.items():
        kind = F.when(F.col("h") == h, F.lit(k)).otherwise(kind)
    per = {r["k"]: (r["n"], r["v"]) for r in counts.groupBy(kind.cast("int").alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    least = sum(n for n, _ in per.values()) / KNOWN
    got = counts.filter(F.col("c") >= least).select("h", "c").toArrow()
    return Vocabulary(singles, per, got["h"].to_numpy().astype(np.int64).view(np.uint64), got["c"].to_numpy().astype(np.int64))


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def logits(weights: np.ndarray, slots: np.ndarray) -> np.ndarray:
    z = weights[slots[1]]
    z += weights[slots[0]]
    for s in slots[2:]:
        z += weights[s]
    return z


def gradient_step(weights: np.ndarray, squares: np.ndarray, uses: np.ndarray, slots: np.ndarray, classes: np.ndarray, rate: float) -> None:
    """One Adagrad update (one scale per row of the table) from a batch of tokens."""
    n = len(classes)
    g = np.exp(log_softmax(logits(weights, slots)))
    g[np.arange(n), classes] -= 1
    for s in slots:
        order = np.argsort(s, kind="stable")
        rows = s[order]
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        own = rows[first]
        grad = np.add.reduceat(g[order], first, axis=0)
        squares[own] += (grad * grad).mean(1)
        weights[own] -= rate * grad / np.sqrt(squares[own])[:, None]
        uses[own] += np.diff(np.append(first, n))


def train_round(texts: DataFrame, weights: np.ndarray, vocab, rate: float, text: str = "text") -> np.ndarray:
    """Every task runs gradient steps over its texts from the shared weights; a row of the table becomes the
    mean of the tasks' rows, weighted by how often each used it."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(weights)  # WIDTH x CLASSES floats
    schema = "part int, sums binary, uses binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, squares, uses, v = shared.value.copy(), np.full(WIDTH, 1e-2, np.float32), np.zeros(WIDTH, np.float32), vocab.value
        for b in batches:
            for _, _, t in _blocks(b, text):
                slots, classes = t.slots(), v.classes(t.h, t.group)
                for k in range(0, len(classes), BATCH):
                    gradient_step(w, squares, uses, slots[:, k : k + BATCH], classes[k : k + BATCH], rate)
        parts = [p for p in range(-(-WIDTH // ROWS)) if uses[p * ROWS : (p + 1) * ROWS].any()]
        if parts:
            d = (w - shared.value) * uses[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([d[p * ROWS : (p + 1) * ROWS].tobytes() for p in parts], pa.binary()), pa.array([uses[p * ROWS : (p + 1) * ROWS].tobytes() for p in parts], pa.binary())], names=["part", "sums", "uses"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for p, d, u in zip(b.column("part").to_pylist(), b.column("sums"), b.column("uses"), strict=True):
                own = [np.frombuffer(x.as_buffer(), np.float32) for x in (d, u)]
                sums[p] = [a + x for a, x in zip(sums[p], own, strict=True)] if p in sums else own
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), *(pa.array([s[k].tobytes() for s in sums.values()], pa.binary()) for k in range(2))], names=["part", "sums", "uses"])

    got = texts.select(text).mapInArrow(run, schema).repartition(F.col("part")).mapInArrow(add, schema).collect()
    out = weights.copy()
    for r in got:
        uses = np.frombuffer(r["uses"], np.float32)
        rows = slice(r["part"] * ROWS, r["part"] * ROWS + len(uses))
        out[rows] += np.frombuffer(r["sums"], np.float32).reshape(len(uses), CLASSES) / np.maximum(uses, 1)[:, None]
    return out


def start_weights(vocab: Vocabulary) -> np.ndarray:
    """Zero but for the bias: log shares of the classes."""
    w = np.zeros((WIDTH, CLASSES), np.float32)
    w[0] = np.log(vocab.mass / vocab.mass.sum())
    return w


def score_rows(docs: DataFrame, weights, vocab, text: str = "text") -> DataFrame:
    """Rows of two kinds. A document (h null, `id` its number in this run): its other columns, token numbers and log10
    sums without the words beyond the table. A word beyond the table: id, h, and how often the document has it."""
    others = [f for f in docs.schema.fields if f.name != text]
    from pyspark.sql import types as T

    names = [f.name for f in others]
    kinds = pa.schema([pa.field("id", pa.int64()), pa.field("h", pa.int64()), pa.field("tf", pa.int64()), pa.field("tokens", pa.int64()), pa.field("found", pa.int64()), pa.field("sum", pa.float64()), pa.field("model", pa.float64())])
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("h", T.LongType()), T.StructField("tf", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("found", T.LongType()), T.StructField("sum", T.DoubleType()), T.StructField("model", T.DoubleType()), *(T.StructField(f.name, f.dataType, True) for f in others)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, v = weights.value, vocab.value
        number = TaskContext.get().partitionId() << 36
        mass = np.log10(v.mass)
        for b in batches:
            for i, j, t in _blocks(b, text):
                n, at = j - i, t.bounds[:-1]
                u, back = np.unique(t.h, return_inverse=True)
                c = v.count(u)
                per = np.where(c >= 0, np.log10(np.maximum(c, 0) + 1.0), 0.0)[back]
                classes = v.classes(t.h, t.group)
                slots, model = t.slots(), np.empty(len(classes))
                for k in range(0, len(classes), BATCH):
                    z = log_softmax(logits(w, slots[:, k : k + BATCH]))
                    model[k : k + BATCH] = z[np.arange(len(z)), classes[k : k + BATCH]]
                model = model / np.log(10) - mass[classes]
                ids = number + np.arange(n)
                number += n
                found = np.add.reduceat((c > 0)[back].astype(np.int64), at)
                own = [ids, ids, np.zeros(n, np.int64), np.diff(t.bounds), found, np.add.reduceat(per, at), np.add.reduceat(model, at)]
                cols = [pa.array(x, k.type) for x, k in zip(own, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*cols, *(b.column(c).slice(i, n) for c in names)], names=[*kinds.names, *names])
                rest = np.flatnonzero((c < 0)[back])
                row = np.searchsorted(t.bounds, rest, "right") - 1
                both, tf = np.unique(row * len(u) + back[rest], return_counts=True)
                tail = [ids[both // len(u)], u[both % len(u)].view(np.int64), tf]
                nulls = [pa.nulls(len(both), k.type) for k in list(kinds)[3:]]
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in tail), *nulls, *(pa.nulls(len(both), b.column(c).type) for c in names)], names=[*kinds.names, *names])

    return docs.mapInArrow(run, schema)


def score_texts(docs: DataFrame, train: Column, rounds: int = 2, rate: float = 0.12, text: str = "text", seed_col: str = "doc_id") -> DataFrame:
    """`docs` without the text, with n_tokens, n_known, train_tokens, base_score and score (log10).

    Learns from the rows where `train` holds: token counts over all of them, and one pass of gradient updates
    over all of them, in `rounds` turns that each take the rows of one hash value and start from the mean of
    the turn before. Words beyond the broadcast table (rarer than one in KNOWN) get their counts by a join.

    A null text is empty: one token, the end. Null ids fall in the first turn; repeated rows are rows of
    their own; with no training rows all counts are 0 and the model is uniform over the classes. Columns
    with the names of results are replaced.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "maxent")
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    learn = docs.filter(train)
    counts = stages.keep(count_words(learn, text), "counts")
    vocab = vocabulary(counts)
    shared = spark.sparkContext.broadcast(vocab)
    weights = start_weights(vocab)
    for k in range(rounds):
        own = learn.filter(F.pmod(F.xxhash64(seed_col, F.lit(23)), F.lit(rounds)) == k)
        weights = train_round(own, weights, shared, rate / (1 + k), text)
    other = [c for c in docs.columns if c != text and c not in results]
    packed = docs.select(F.struct(*other).alias("_row") if other else F.struct(F.lit(0)).alias("_row"), F.col(text).alias("_text"))
    rows = score_rows(packed, spark.sparkContext.broadcast(weights), shared, "_text")
    c = F.coalesce("c", F.lit(0))
    tail = F.col("tokens").isNull()
    got = rows.join(counts.select("h", "c"), "h", "left").groupBy("id").agg(
        F.first("_row", ignorenulls=True).alias("_row"),
        F.max("tokens").alias("n_tokens"),
        (F.max("found") + F.coalesce(F.sum(F.when(tail & (c > 0), F.col("tf"))), F.lit(0))).alias("n_known"),
        (F.max("sum") + F.coalesce(F.sum(F.when(tail, F.col("tf") * F.log10(c + 1))), F.lit(0.0))).alias("_sum"),
        F.max("model").alias("_model"),
    )
    whole = float(vocab.n + vocab.v + 1)
    return got.select(*(F.col("_row")[c].alias(c) for c in other), "n_tokens", "n_known", F.lit(vocab.n).cast("long").alias("train_tokens"), (F.col("_sum") - F.col("n_tokens") * F.log10(F.lit(whole))).alias("base_score"), (F.col("_sum") + F.col("_model")).alias("score"))
