"""Toxicity: linear model over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.llm.common import add_column, label_sample
from wayflux.llm.sparse import Model, fit, row_sums, sigmoid
from wayflux.llm.tokens import FOLD, mix, powers, row_blocks, utf8

BITS = 20
LENGTHS = (3, 4, 5, 6)
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = FOLD.copy()
_LOWER[_WHITE] = 0x20


def grams(block: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """Per row the bounds of its characters, and for each length the slot of the n-gram at every character
    (-1 where the row ends sooner). A-Z are lower-cased, white space is a space."""
    folded = _LOWER[block]
    chars = np.frombuffer(folded.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((block & 0xC0) != 0x80)])
    at = starts[bounds]
    value = mix(chars.astype(np.uint64))
    n = len(value)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value * up[:n], out=sums[1:])
    left = np.repeat(at[1:], np.diff(at)) - np.arange(n)

    def each() -> Iterator[np.ndarray]:
        for k in LENGTHS:
            slot = np.full(n, -1, np.int64)
            if n >= k:
                h = mix((sums[k:] - sums[:-k]) * down[: n - k + 1], k)
                slot[: n - k + 1] = (h >> np.uint64(64 - BITS)).astype(np.int64)
            slot[left < k] = -1
            yield slot

    return at, each()


def _row_slots(batch: pa.RecordBatch, text: str, wanted: np.ndarray | None) -> Iterator[np.ndarray]:
    """Distinct slots of each row, in order; with `wanted` only those."""
    data, bounds = utf8(batch.column(text))
    seen = np.zeros(1 << BITS, bool)
    for i, j in row_blocks(bounds):
        at, each = grams(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
        slots = list(each)
        for a, b in zip(at[:-1], at[1:], strict=True):
            own = np.concatenate([s[a:b] for s in slots])
            own = own[own >= 0]
            if wanted is not None:
                yield np.unique(own[wanted[own]])
            else:
                seen[own] = True
                distinct = np.flatnonzero(seen) if len(own) > 1 << 13 else np.unique(own)
                seen[own] = False
                yield distinct


def ratios(docs: DataFrame, features: int, min_rows: int, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Slots and naive Bayes log-count ratios of the n-grams that tell the two labels apart best.

    Documents with each n-gram are counted per label in every task, and the counts summed per slot; the
    number of slots is fixed. The `features` slots with the largest likelihood-ratio statistic stay.
    """
    schema = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("pos", T.LongType()), T.StructField("neg", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((2, 1 << BITS), np.int64), [0, 0]
        for b in batches:
            for y, own in zip(b.column("label").to_pylist(), _row_slots(b, text, None), strict=True):
                sums[y, own] += 1
                n[y] += 1
        full = np.flatnonzero(sums.any(0))
        full_and_total = [np.append(full, -1), np.append(sums[1, full], n[1]), np.append(sums[0, full], n[0])]
        yield pa.RecordBatch.from_arrays([pa.array(full_and_total[0], pa.int32()), pa.array(full_and_total[1]), pa.array(full_and_total[2])], names=["slot", "pos", "neg"])

    sums = docs.select("label", text).mapInArrow(count, schema).groupBy("slot").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    got = sums.filter((F.col("slot") == -1) | (F.col("pos") + F.col("neg") >= min_rows)).toArrow()
    slot, pos, neg = (got[c].to_numpy().astype(np.int64) for c in ("slot", "pos", "neg"))
    total = slot == -1
    p, q = (int(pos[total][0]), int(neg[total][0])) if total.any() else (0, 0)
    slot, pos, neg = slot[~total], pos[~total], neg[~total]
    if p == 0 or q == 0 or not len(slot):
        return np.zeros(0, np.int64), np.zeros(0)
    ratio = np.log((pos + 1) / (p + 2)) - np.log((neg + 1) / (q + 2))
    rate = (pos + neg) / (p + q)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.nan_to_num(pos * np.log(pos / (p * rate))) + np.nan_to_num(neg * np.log(neg / (q * rate)))
    best = np.lexsort((slot, -g))[:features]
    best = best[np.argsort(slot[best])]
    return slot[best], ratio[best]


def train(docs: DataFrame, sample: DataFrame, text: str = "text", id_col: str = "doc_id", features: int = 4096, min_rows: int = 4) -> tuple[np.ndarray, Model]:
    """Weight of every slot (0: not a feature) times its ratio, and the linear model behind it."""
    rows = docs.select(id_col, text).join(F.broadcast(sample), id_col)
    slot, ratio = ratios(rows, features, min_rows, text)
    wanted = np.zeros(1 << BITS, bool)
    wanted[slot] = True
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def make():
        w = shared.value
        return lambda b: pa.array([s.astype(np.int32) for s in _row_slots(b, text, w)], pa.list_(pa.int32()))

    got = add_column(rows, "_f", T.ArrayType(T.IntegerType()), make, (text,)).select(id_col, "label", "_f").toArrow().sort_by(id_col)
    lists = [np.array(f.values, np.int64) if len(f) else np.zeros(0, np.int64) for f in got["_f"]]
    idx = np.searchsorted(slot, np.concatenate(lists)) if lists else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(f) for f in lists])]).astype(np.int64)
    model = fit(idx, ratio[idx], bounds, got["label"].to_numpy().astype(float), max(1, len(slot)), epochs=12, rate=0.05, decay=1e-4)
    table = np.zeros(1 << BITS, np.float32)
    table[slot] = model.w[: len(slot)] * ratio
    return table, model


def score(docs: DataFrame, table: np.ndarray, bias: float, into: str = "toxicity", text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """`docs` with a double column `into`, 0 to 1: how likely the model takes the whole text for toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # 2^BITS floats

    def make():
        weights = shared.value
        wanted = weights != 0

        def run(b: pa.RecordBatch) -> pa.Array:
            data, bounds = utf8(b.column(text))
            out = [np.zeros(0)]
            for i, j in row_blocks(bounds):
                at, each = grams(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                found = []
                for s in each:
                    place = np.flatnonzero((s >= 0) & wanted[s])
                    row = np.searchsorted(at, place, "right") - 1
                    found.append((row << BITS) | s[place])
                own = np.unique(np.concatenate(found))
                row = own >> BITS
                out.append(sigmoid(bias + row_sums(weights[own & ((1 << BITS) - 1)], np.searchsorted(row, np.arange(j - i + 1)))))
            return pa.array(np.concatenate(out), pa.float64())

        return run

    return add_column(docs, into, T.DoubleType(), make, drop)


def classify(docs: DataFrame, labels: DataFrame, into: str = "toxicity", label: str = "toxic", train_rows: int = 30_000, usable=None, drop: tuple[str, ...] = (), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from at most about `train_rows` labelled documents (hash sample of those that `usable` allows)
    and score every whole text.

    Null and empty texts have no n-grams and get the score of the bias. Labels without a document, an id or
    a value do nothing; an id with several labels takes the largest. Without labels of both kinds every
    score is the smoothed share of the label.
    """
    sample = label_sample(labels, label, train_rows, F.lit(True) if usable is None else usable, id_col)
    table, model = train(docs, sample, text, id_col)
    return score(docs, table, model.bias, into, text, drop)
