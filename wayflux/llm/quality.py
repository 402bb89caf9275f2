"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.llm.common import add_column, label_sample, release
from wayflux.llm.sparse import Model, fit
from wayflux.llm.tokens import NOT_NEWLINE, per_row, row_blocks, utf8, words

WORD_BITS = 14
STEPS = 16
STATS = ("words", "distinct", "word_length", "top_word", "punctuation", "symbols", "digits", "upper", "breaks", "repeated_lines", "repeated_line_bytes", "plain_words", "long_words", "repeated_next")
RANK = 8

_codes = np.arange(256)
_CLASS = {
    "punctuation": np.isin(_codes, list(b".,;:'\"()-?")),
    "symbols": np.isin(_codes, list(b"!#$%&*+/<=>@[\\]^_`{|}~")),
    "digits": (_codes >= 48) & (_codes < 58),
    "upper": (_codes >= 65) & (_codes < 91),
    "breaks": _codes == 10,
}
_LETTERS = ((_codes >= 97) & (_codes < 123)) | ((_codes >= 65) & (_codes < 91)) | (_codes >= 128)


def _step(share: np.ndarray) -> np.ndarray:
    """A share of 0 to 1 as one of STEPS steps, finer near 0; undefined values are 0."""
    return np.clip(np.nan_to_num(np.sqrt(share)) * (STEPS - 1) + 0.5, 0, STEPS - 1).astype(np.int64)


def _log_step(n: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(n, 0) + 1), 0, STEPS - 1).astype(np.int64)


def features(block: np.ndarray, bounds: np.ndarray, extra: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a block of texts: hashed words by damped counts with norm 1, then one step per
    statistic and metadata value (missing: none)."""
    n = len(bounds) - 1
    start, end, h, rows = words(block, bounds)
    row = np.repeat(np.arange(n), np.diff(rows))
    slot = (h >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    both, count = np.unique((row << WORD_BITS) | slot, return_counts=True)
    own, idx, x = both >> WORD_BITS, both & ((1 << WORD_BITS) - 1), np.log1p(count)
    norm = np.sqrt(np.bincount(own, x * x, n))
    x = x / norm[own]
    n_words, size = np.diff(rows).astype(float), np.diff(bounds).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = {name: _step(np.minimum(1, 4 * per_row(flags[block], bounds) / size)) for name, flags in _CLASS.items()}
        value["words"] = _log_step(n_words)
        value["distinct"] = _step(np.bincount(own, minlength=n) / n_words)
        value["word_length"] = np.clip(np.nan_to_num(per_row(end - start, rows) / n_words), 0, STEPS - 1).astype(np.int64)
        top = np.zeros(n)
        np.maximum.at(top, own, count)
        value["top_word"] = _step(top / n_words)
        letters = np.concatenate([[0], np.cumsum(_LETTERS[block])])
        plain = letters[end] - letters[start] == end - start
        value["plain_words"] = _step(per_row(plain, rows) / n_words)
        value["long_words"] = _step(per_row(end - start > 20, rows) / n_words)
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        value["repeated_next"] = _step(per_row(again, rows) / n_words)
        a, b, line, lines = words(block, bounds, NOT_NEWLINE)
        of = np.repeat(np.arange(n), np.diff(lines))
        order = np.lexsort((line, of))
        twice = np.zeros(len(line), bool)
        twice[order[1:]] = (line[order[1:]] == line[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
        value["repeated_lines"] = _step(per_row(twice, lines) / np.diff(lines))
        value["repeated_line_bytes"] = _step(per_row(np.where(twice, b - a, 0), lines) / size)
    dense = [np.where(n_words > 0, value[s], 0) for s in STATS] + [np.where(np.isnan(e), -1, _log_step(np.nan_to_num(e))) for e in extra]
    base = 1 << WORD_BITS
    side = np.stack([np.where(d >= 0, base + k * STEPS + d, base + len(dense) * STEPS) for k, d in enumerate(dense)], 1)
    weight = np.where(side == base + len(dense) * STEPS, 0.0, 0.5)
    idx = np.concatenate([idx, side.ravel()])
    own = np.concatenate([own, np.repeat(np.arange(n), len(dense))])
    x = np.concatenate([x, weight.ravel()])
    order = np.argsort(own, kind="stable")
    return idx[order], x[order], np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))])


def width(n_extra: int) -> int:
    return (1 << WORD_BITS) + (len(STATS) + n_extra) * STEPS + 1


def _per_block(batch: pa.RecordBatch, text: str, meta: tuple[str, ...]):
    data, bounds = utf8(batch.column(text))
    extra = [batch.column(m).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float) for m in meta]
    for i, j in row_blocks(bounds):
        yield features(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], [e[i:j] for e in extra])


def train(docs: DataFrame, sample: DataFrame, text: str = "text", meta: tuple[str, ...] = (), id_col: str = "doc_id", rank: int = RANK) -> Model:
    """Fit on the documents named in `sample` (id, label), which is bounded: its features are computed on
    the executors and brought together."""
    kind = T.ArrayType(T.FloatType())

    def make():
        def run(b: pa.RecordBatch) -> pa.Array:
            out = []
            for idx, x, at in _per_block(b, text, meta):
                out += [np.concatenate([idx[s:e], x[s:e]]).astype(np.float32) for s, e in zip(at[:-1], at[1:], strict=True)]
            return pa.array(out, pa.list_(pa.float32()))

        return run

    rows = docs.select(id_col, text, *meta).join(F.broadcast(sample), id_col)
    got = add_column(rows, "_f", kind, make, (text, *meta)).select(id_col, "label", "_f").toArrow()
    order = pa.compute.sort_indices(got[id_col]).to_numpy()
    label = got["label"].to_numpy().astype(float)[order]
    sizes = pa.compute.list_value_length(got["_f"]).to_numpy().astype(np.int64) // 2
    bounds = np.concatenate([[0], np.cumsum(sizes[order])])
    place = np.empty(len(order), np.int64)  # where a row's features go
    place[order] = bounds[:-1]
    idx, x, row = np.empty(bounds[-1], np.int32), np.empty(bounds[-1], np.float32), 0
    for chunk in got["_f"].chunks:
        flat, at = chunk.flatten().to_numpy(), 0
        for to, n in zip(place[row : row + len(chunk)].tolist(), sizes[row : row + len(chunk)].tolist(), strict=True):
            idx[to : to + n], x[to : to + n] = flat[at : at + n], flat[at + n : at + 2 * n]
            at += 2 * n
        row += len(chunk)
    got = flat = chunk = None  # this is the driver, whose memory is small
    release()
    model = fit(idx, x, bounds, label, width(len(meta)), rank)
    idx = x = None
    release()
    return model


def score(docs: DataFrame, model: Model, into: str = "quality", text: str = "text", meta: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> DataFrame:
    """`docs` with a double column `into`, 0 to 1: how likely the model takes the text for good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the hash width

    def make():
        m = shared.value

        def run(b: pa.RecordBatch) -> pa.Array:
            parts = [m.score(*f) for f in _per_block(b, text, meta)]
            return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

        return run

    return add_column(docs, into, T.DoubleType(), make, drop)


def classify(docs: DataFrame, labels: DataFrame, into: str = "quality", label: str = "quality", train_rows: int = 12_000, usable=None, meta: tuple[str, ...] = (), drop: tuple[str, ...] = (), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from at most about `train_rows` labelled documents (hash sample of those that `usable` allows)
    and score every whole text.

    Null and empty texts have no words and all statistics at 0, and get a score like any other. Labels
    without a document, an id or a value do nothing; an id with several labels takes the largest; ids that
    several documents share give each the label. Without labels every score is one half. Metadata columns
    must be numeric; a null there is no feature.
    """
    sample = label_sample(labels, label, train_rows, F.lit(True) if usable is None else usable, id_col)
    return score(docs, train(docs, sample, text, meta, id_col), into, text, meta, drop)
