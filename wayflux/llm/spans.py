"""Substring dedup: runs of consecutive sentences that occur again are removed from all but one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.llm.common import add_column, free_name, freeing
from wayflux.llm.tokens import mix, powers, row_blocks, utf8, words

LONG = 40
RUN_WORDS = 20
RUN_SENTENCES = 2
HELD = 1 << 20
SUBS = 2
_STOPS = np.isin(np.arange(256), list(b".!?"))
_CLOSERS = np.isin(np.arange(256), list(b"\"')]}"))


def sentences(block: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, first word of each sentence (and the end), sentence bounds of the rows, word starts, word bounds.

    A sentence ends after a word with a full stop, exclamation or question mark (closing quotes or brackets
    may follow), at a line break, or at the end of the text. One of more than LONG words ends after each of
    its words, so that text without stops is compared word by word, wherever a passage begins in it.
    """
    start, end, h, rows = words(block, bounds)
    n = len(h)
    if not n:
        return h, np.zeros(1, np.int64), np.zeros(len(bounds), np.int64), start, rows
    last = end - 1
    for _ in range(3):
        last = np.where(_CLOSERS[block[last]] & (last > start), last - 1, last)
    breaks = np.concatenate([[0], np.cumsum(block == 10)])
    nxt = np.append(start[1:], len(block))
    stop = _STOPS[block[last]] | (breaks[nxt] > breaks[end])
    final = np.zeros(n, bool)
    final[rows[1:][np.diff(rows) > 0] - 1] = True
    stop |= final
    ends = np.flatnonzero(stop) + 1
    size = np.diff(ends, prepend=0)
    stop |= np.repeat(size > LONG, size)
    first = np.concatenate([[0], np.flatnonzero(stop) + 1])
    return h, first, np.searchsorted(first[:-1], rows), start, rows


def runs(h: np.ndarray, first: np.ndarray, of_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes, first and last sentence (exclusive) of the runs: from each sentence on, and up to each
    sentence, the fewest sentences that are RUN_SENTENCES and RUN_WORDS words at least and lie in one row.

    They cover all that repeats: a sentence of a repeated passage whose run on from it ends behind the
    passage lies in the run up to the passage's last sentence. Which runs there are depends on their words alone.
    """
    n = len(first) - 1
    at = np.arange(n)
    row = np.searchsorted(of_rows, at, "right")
    stop = np.maximum(np.searchsorted(first, first[:-1] + RUN_WORDS, "left"), at + RUN_SENTENCES)
    begin = np.minimum(np.searchsorted(first, first[1:] - RUN_WORDS, "right"), at - RUN_SENTENCES + 2) - 1
    on = stop <= of_rows[row]
    upto = begin >= of_rows[row - 1]
    upto &= stop[begin] != at + 1  # not the same run again
    at, stop = np.concatenate([at[on], begin[upto]]), np.concatenate([stop[on], at[upto] + 1])
    out = []
    for seed in (1, 2):  # sums of mixed hashes weighted by place in the run: telescoping powers of an odd base
        up, down = powers(len(h) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h, seed) * up[: len(h)], dtype=np.uint64)])
        a, b = first[at], first[stop]
        out.append(mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64), seed + 10).view(np.int64))
    return out[0], out[1], at, stop


def later(h1: np.ndarray, h2: np.ndarray, place: tuple) -> tuple[np.ndarray, np.ndarray]:
    """For sorted runs: which are at another place than the first of their run, and which are that first's equals
    (and not itself)."""
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    at = np.maximum.accumulate(np.where(new, np.arange(len(h1)), 0))
    equal = np.logical_and.reduce([c == c[at] for c in place])
    return ~new & ~equal, ~new & equal


def _key(df: DataFrame, id_col: str, text: str):
    return [F.coalesce(F.xxhash64(F.col(id_col).cast("string")), F.lit(0)) if df.schema[id_col].dataType != T.LongType() else F.col(id_col), F.xxhash64(text)]


def pack(doc: np.ndarray, version: np.ndarray, first: np.ndarray, stop: np.ndarray, *hashes: np.ndarray) -> tuple[int, int, bytes]:
    """Numbers of rows and of documents, and the compressed columns of rows sorted by document: a document once."""
    new = np.append(True, (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]))
    small = [np.ascontiguousarray(x.astype(np.int32).view(np.uint8).reshape(-1, 4).T) for x in (first, stop - first)]  # bytes of one weight together
    columns = (doc[new], version[new], *hashes, *small, new)
    return len(doc), int(new.sum()), pa.compress(b"".join(c.tobytes() for c in columns), "zstd", asbytes=True)


def unpack(n: int, docs: int, data: bytes, hashes: tuple = ()) -> list[np.ndarray]:
    """doc, version, first, stop and the hashes of `pack`."""
    each = 9 + sum(np.dtype(k).itemsize for k in hashes)
    raw = pa.decompress(data, 16 * docs + each * n, "zstd", asbytes=True)
    out, at = [], 0
    for kind, size in ((np.int64, docs), (np.int64, docs), *((k, n) for k in hashes), (np.uint8, 4 * n), (np.uint8, 4 * n), (np.bool_, n)):
        out.append(np.frombuffer(raw, kind, size, at))
        at += out[-1].nbytes
    first, size = (np.ascontiguousarray(x.reshape(4, -1).T).view(np.int32).ravel() for x in out[-3:-1])
    row = np.cumsum(out[-1]) - 1
    return [out[0][row], out[1][row], first, first + size, *out[2:-3]]


def merged(doc: np.ndarray, version: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """The spans of each document, those that meet or overlap as one."""
    order = np.lexsort((first, version, doc))
    doc, version, first, stop = doc[order], version[order], first[order], stop[order]
    group = np.cumsum(np.append(0, (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]))) << 32
    reach = np.maximum.accumulate(group + stop)
    new = np.append(True, (group + first)[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(new)) - 1
    return doc[new], version[new], first[new], (reach[last] & 0xFFFFFFFF).astype(np.int32)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, version, first, stop): sentence spans (stop exclusive) whose run occurs earlier, earlier being a
    smaller (id, hash of the text, place); a null id comes first.

    A task settles what it holds, about HELD runs at a time: of the occurrences of a run in them all but the
    earliest are repeats for sure, and only that one meets those of others. Runs go in packed columns, dealt by
    their hash; a task meets one of SUBS shares of its runs at a time.
    """
    doc, version = _key(docs, id_col, text)
    rows = docs.select(doc.alias("doc"), version.alias("version"), F.col(text).alias("text"))
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "part int, sub int, n int, docs int, data binary"
    kinds = (np.int64, np.int32)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        held = 0
        for b in batches:
            doc = b.column("doc").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            version = b.column("version").to_numpy(zero_copy_only=False)
            data, bounds = utf8(b.column("text"))
            for i, j in row_blocks(bounds):
                h, first, of_rows, _, _ = sentences(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                h1, h2, a, z = runs(h, first, of_rows)
                row = np.searchsorted(of_rows, a, "right") - 1
                parts.append((h1, h2, doc[i + row], version[i + row], (a - of_rows[row]).astype(np.int32), (z - of_rows[row]).astype(np.int32)))
                held += len(a)
                if held > HELD:  # memory stays bounded; what is not settled here meets later
                    yield from settle(parts)
                    held = 0
        yield from settle(parts)

    def settle(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not sum(len(p[0]) for p in parts):
            return
        h1, h2, doc, version, a, z = (np.concatenate([p[k] for p in parts]) for k in range(6))
        parts.clear()
        order = np.lexsort((a, version, doc, h2, h1))
        settled, same = later(h1[order], h2[order], (doc[order], version[order], a[order]))
        sure, order = order[settled], order[~settled & ~same]
        if len(sure):
            spans = merged(doc[sure], version[sure], a[sure], z[sure])
            for k in range(0, len(spans[0]), 1 << 16):
                own = [x[k : k + (1 << 16)] for x in spans]
                yield row_of(int(mix(own[0][:1].view(np.uint64))[0] % np.uint64(n_parts)), -1, pack(*own))
        high = h1.view(np.uint64) >> np.uint64(20)
        share = (high % np.uint64(n_parts * SUBS)).astype(np.int64)
        order = order[np.lexsort((a[order], version[order], doc[order], share[order]))]
        cuts = np.append(np.flatnonzero(np.diff(share[order], prepend=-1)), len(order))
        for k, m in zip(cuts[:-1], cuts[1:], strict=True):
            o = order[k:m]
            yield row_of(int(share[o[0]]) // SUBS, int(share[o[0]]) % SUBS, pack(doc[o], version[o], a[o], z[o], h1[o], h2[o].astype(np.int32)))

    def row_of(part: int, sub: int, packed: tuple[int, int, bytes]) -> pa.RecordBatch:
        ints = (pa.array([x], pa.int32()) for x in (part, sub, *packed[:2]))
        return pa.RecordBatch.from_arrays([*ints, pa.array([packed[2]], pa.binary())], names=["part", "sub", "n", "docs", "data"])

    def met(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if held:
            doc, version, first, stop, h1, h2 = (np.concatenate([x[k] for x in held]) for k in range(6))
            held.clear()
            order = np.lexsort((first, version, doc, h2, h1))
            again, _ = later(h1[order], h2[order], (doc[order], version[order], first[order]))
            if again.any():
                yield from spans_of(merged(*(x[order[again]] for x in (doc, version, first, stop))))

    def spans_of(columns) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(columns[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[k : k + (1 << 16)]) for x in columns], names=["doc", "version", "first", "stop"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], -1
        for b in batches:
            for sub, n, docs, data in zip(*(b.column(c).to_pylist() for c in ("sub", "n", "docs", "data")), strict=True):
                if sub != at:
                    yield from met(held)
                    at = sub
                if sub < 0:
                    yield from spans_of(unpack(n, docs, data))
                else:
                    held.append(unpack(n, docs, data, kinds))
        yield from met(held)

    packed = rows.mapInArrow(freeing(local), schema).repartitionById(n_parts, F.col("part")).sortWithinPartitions("sub")
    return packed.mapInArrow(freeing(whole), "doc long, version long, first int, stop int")


def remove_repeats(docs: DataFrame, into: str = "removed", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated sentence spans cut out of the text, and the struct `into`: sentences, removed.

    Runs of several consecutive sentences are hashed (96 bits) and met across all documents; sentences
    covered by a run that occurs earlier go, to both ends of what repeats; in sentences of more than LONG
    words, which are cut into their words, wherever it begins and ends. A part of a shorter sentence stays; the rest of the text stays byte for byte. Null texts stay null,
    empty texts empty; texts without a full run lose nothing; a text may lose everything and stays as an
    empty row. Rows that agree in id and text count as one document, and are treated alike. A column named
    `into` is replaced; others pass through.
    """
    spans = repeated_spans(docs, id_col, text).groupBy("doc", "version").agg(F.collect_set(F.shiftleft(F.col("first").cast("long"), 32) + F.col("stop")).alias("_spans"))
    names = {c: free_name(docs, c) for c in ("_doc", "_version", "_spans")}
    doc, version = _key(docs, id_col, text)
    keyed = docs.withColumns({names["_doc"]: F.coalesce(doc, F.lit(-(1 << 63))), names["_version"]: version})
    spans = spans.select(F.col("doc").alias(names["_doc"]), F.col("version").alias(names["_version"]), F.col("_spans").alias(names["_spans"]))
    joined = keyed.join(spans, [names["_doc"], names["_version"]], "left")
    out_text = free_name(docs, "_kept")

    def make():
        kind = pa.struct([("text", pa.string()), ("sentences", pa.int64()), ("removed", pa.int64())])

        def run(b: pa.RecordBatch) -> pa.Array:
            data, bounds = utf8(b.column(text))
            there = b.column(text).is_valid().to_pylist()
            cut = b.column(names["_spans"])
            spans = cut.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            of_spans = np.concatenate([[0], np.cumsum(cut.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            out = []
            for i, j in row_blocks(bounds):
                block = data[bounds[i] : bounds[j]]
                own = bounds[i : j + 1] - bounds[i]
                _, first, of_rows, start, _ = sentences(block, own)
                for r in range(j - i):
                    a, z = int(of_rows[r]), int(of_rows[r + 1])
                    own_spans = spans[of_spans[i + r] : of_spans[i + r + 1]]
                    if not len(own_spans):
                        body = block[own[r] : own[r + 1]].tobytes().decode() if there[i + r] else None
                        out.append((body, z - a, 0))
                        continue
                    cover = np.zeros(z - a + 1, np.int64)
                    np.add.at(cover, own_spans >> 32, 1)
                    np.add.at(cover, own_spans & 0xFFFFFFFF, -1)
                    gone = np.cumsum(cover)[:-1] > 0
                    edge = np.append(start[first[a:z]], own[r + 1])
                    edge[0] = own[r]
                    kept = block[own[r] : own[r + 1]][np.repeat(~gone, np.diff(edge))]
                    out.append((kept.tobytes().decode(), z - a, int(gone.sum())))
            return pa.array([{"text": t, "sentences": s, "removed": g} for t, s, g in out], kind)

        return run

    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("sentences", T.LongType()), T.StructField("removed", T.LongType())])
    got = add_column(joined, out_text, kind, make, list(names.values()))
    cols = [F.col(out_text)["text"].alias(text) if c == text else F.col(c) for c in docs.columns if c != into]
    return got.select(*cols, F.struct(F.col(out_text)["sentences"].alias("sentences"), F.col(out_text)["removed"].alias("removed")).alias(into))
