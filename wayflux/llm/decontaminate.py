"""Benchmark passages in documents, found by a Wu-Manber search over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import add_column
from wayflux.llm.tokens import ALNUM, FOLD, _P, mix, row_blocks, utf8, words

WINDOW = 13
TABLE_BITS = 18
SEGMENT = 256
KIND = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"


def _blocks(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of `size` words that ends at each word (the first words of the array have none)."""
    if size == 1:
        return mix(h, 1)
    out = np.zeros(len(h), np.uint64)
    out[1:] = mix(h[:-1] * np.uint64(_P) + h[1:], 2)
    return out


class Patterns:
    """Shift table, suffix buckets and prefix hashes of the test strings of one length in words."""

    def __init__(self, strings: dict[bytes, set[int]], hashes: dict[bytes, np.ndarray], length: int):
        self.m, self.b = length, min(2, length)
        keys = list(strings)
        table = np.array([hashes[k] for k in keys], np.uint64).reshape(len(keys), length)
        blocks = np.stack([_blocks(row, self.b) for row in table])
        order = np.argsort(blocks[:, -1], kind="stable")
        self.table, self.suffix, self.prefix = table[order], blocks[order, -1], blocks[order, self.b - 1]
        self.strings = [keys[i] for i in order]
        self.items = [np.array(sorted(strings[k]), np.int64) for k in self.strings]
        self.shift = np.full(1 << TABLE_BITS, length - self.b + 1, np.uint8 if length < 250 else np.int64)
        for end in range(self.b - 1, length):  # a block ending `length - 1 - end` words before the end of a string
            np.minimum.at(self.shift, self.slot(blocks[:, end]), length - 1 - end)

    @staticmethod
    def slot(block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end word, string) of every place where prefix, suffix and all word hashes agree.

        All rows are searched at once: each stretch of SEGMENT end positions has a cursor, and every
        step moves all cursors by their shift.
        """
        blocks = _blocks(h, self.b)
        slots = self.slot(blocks)
        first, last = rows[:-1] + self.m - 1, rows[1:]
        long = last > first
        first, last = first[long], last[long]
        pieces = -(-(last - first) // SEGMENT)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(first, pieces) + within * SEGMENT
        stop = np.minimum(at + SEGMENT, np.repeat(last, pieces))
        found = []
        while len(at):
            step = self.shift[slots[at]].astype(np.int64)
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        ends = np.concatenate(found) if found else np.zeros(0, np.int64)
        low, high = np.searchsorted(self.suffix, blocks[ends], "left"), np.searchsorted(self.suffix, blocks[ends], "right")
        n = high - low
        which = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        ends = np.repeat(ends, n)
        same = self.prefix[which] == blocks[ends - self.m + self.b]
        ends, which = ends[same], which[same]
        for k in range(self.m):
            same = self.table[which, k] == h[ends - self.m + 1 + k]
            ends, which = ends[same], which[same]
        return ends, which


def compile_items(items: list[tuple[str, str]], window: int = WINDOW) -> tuple[list[str], list[Patterns]]:
    """Item names and one pattern set per length of test string; equal strings are one pattern."""
    names = sorted({i for i, _ in items})
    number = {name: k for k, name in enumerate(names)}
    by_length: dict[int, dict[bytes, set[int]]] = {}
    hashes: dict[bytes, np.ndarray] = {}
    for name, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        start, end, h, _ = words(raw, np.array([0, len(raw)]), ALNUM)
        folded = FOLD[raw].tobytes()
        tokens = [folded[a:b] for a, b in zip(start, end, strict=True)]
        m = min(window, len(tokens))
        for k in range(len(tokens) - m + 1 if m else 0):
            key = b" ".join(tokens[k : k + m])
            by_length.setdefault(m, {}).setdefault(key, set()).add(number[name])
            hashes[key] = h[k : k + m]
    return names, [Patterns(strings, hashes, m) for m, strings in sorted(by_length.items())]


def _search(batch: pa.RecordBatch, text: str, names: list[str], sets: list[Patterns], known: str | None) -> pa.Array:
    data, bounds = utf8(batch.column(text))
    out = batch.column(known).to_pylist() if known else [None] * batch.num_rows
    for i, j in row_blocks(bounds):
        block = data[bounds[i] : bounds[j]]
        start, end, h, rows = words(block, bounds[i : j + 1] - bounds[i], ALNUM)
        folded = FOLD[block].tobytes()
        hit, pairs = np.zeros(len(h) + 1, np.int64), []
        for p in sets:
            ends, which = p.search(h, rows)
            for e, w in zip(ends.tolist(), which.tolist(), strict=True):
                a = e - p.m + 1
                if b" ".join(folded[start[k] : end[k]] for k in range(a, e + 1)) == p.strings[w]:  # the direct comparison
                    hit[a] += 1
                    hit[e + 1] -= 1
                    pairs.append((a, p.items[w]))
        covered = np.cumsum(hit[:-1]) > 0
        items: dict[int, set[int]] = {}
        for a, ids in pairs:
            items.setdefault(int(np.searchsorted(rows, a, "right")) - 1, set()).update(ids.tolist())
        for r in range(j - i):
            a, b = rows[r], rows[r + 1]
            mine = covered[a:b]
            if known:
                for s in out[i + r]["spans"]:
                    mine[s["start"] : s["end"]] = True
            edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
            got = {names[k] for k in items.get(r, ())} | set(out[i + r]["items"] if known else ())
            out[i + r] = {"n_words": int(b - a), "spans": [{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2], strict=True)], "items": sorted(got)}
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])
    return pa.array(out, kind)


def find_passages(docs: DataFrame, items: DataFrame, into: str = "passages", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = 32 << 20, drop: tuple[str, ...] = ()) -> DataFrame:
    """`docs` with a struct column `into`: n_words, spans (word positions that lie in an occurrence of a
    test string, end exclusive, merged) and items (their ids as sorted strings).

    A test string is a run of `window` item words; a shorter item is one string. The items, a stated set,
    are handled in blocks of at most `block_bytes` of text (but one item at least): each block's tables are
    broadcast, and the documents pass the blocks one after the other, without a shuffle.

    Null and empty texts have no words and no spans; items without words never occur; a null item id counts
    as an id of no characters; repeated items and equal windows count once per id; an empty item table
    gives no spans. Other columns pass through; a column named `into` is replaced.
    """
    spark = docs.sparkSession
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("t")).distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    known = None
    for k in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k) if blocks > 1 else rows
        shared = spark.sparkContext.broadcast(compile_items([(r.i, r.t) for r in part.collect()], window))

        def make(shared=shared, known=known):
            names, sets = shared.value
            return lambda b: _search(b, text, names, sets, known)

        docs = add_column(docs, into, _kind(spark), make, drop if k == blocks - 1 else ())
        known = into
    return docs


def _kind(spark):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(KIND)


def digest(found: DataFrame, into: str = "passages", id_col: str = "doc_id", share: int = 20) -> DataFrame:
    """Per document: words, words hit, items, their digest, and whether hits reach 1 / `share` of its words."""
    p = F.col(into)
    n_hit = F.aggregate(p["spans"], F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    out = found.select(id_col, p["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(p["items"]).cast("long").alias("n_items"), F.sha2(F.array_join(p["items"], ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
