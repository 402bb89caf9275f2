"""Exact Jaccard join of word n-grams by a partition of the hashed universe, and its components.

Two sets whose sizes allow the similarity differ in at most H tokens. Tokens are hashed into segments, as
many as the size band needs, so that sets within H of each other agree in a segment (value 1), or differ by
one token there (value 2), as soon as the values of the segments asked sum to H + 1 (pigeonhole). Sets are
indexed under every segment subset of their own band, and under the one-deletion neighbourhood of some
segments; a set asks its own band and the one below, choosing the cheapest segments and neighbourhoods.
Sets that meet are compared token by token.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import Stages, freeing
from wayflux.llm.tokens import mix, row_blocks, shingles, utf8, words

SKETCH_BITS = 17
FILTER_BITS = 20
DELETIONS = 0.03
EMPTY_COST = 1e6
CELL = 4096
# what a row of the index is: exact or one token left out, indexed and/or asked; asked ones sort first
EXACT_BOTH, EXACT_ASKED, LESS_BOTH, LESS_ASKED, EXACT_HELD, LESS_HELD = range(6)


class Bands:
    """Size bands [low, high] with high / low about 1 / similarity; sets of a band meet the next one at most."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low, self.high = [1], [max(1, 100 // percent)]

    def of(self, n: int) -> int:
        while self.high[-1] < n:
            self.low.append(self.high[-1] + 1)
            self.high.append(max(self.low[-1], self.low[-1] * 100 // self.percent))
        return int(np.searchsorted(self.high, n))

    def differ(self, a: int, b: int) -> int:
        """Most tokens in which similar sets of these sizes, or of smaller ones, differ."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def segments(self, band: int) -> int:
        top = self.high[band]
        return self.differ(top, top * 100 // self.percent) + 1


_HALF, _KEY = np.uint64(32), np.uint64((1 << 61) - 1)
_PLACES = 1 << 14  # segments whose places are kept


@lru_cache(maxsize=128)
def _places(band: int, m: int) -> np.ndarray:
    """A hash of each segment of a band."""
    return mix(np.uint64(band << 32) + np.arange(m, dtype=np.uint64), 3)


class Parts:
    """The segments of one set in one band: keys, sizes, and the one-deletion keys of its first segments.

    `value` is `mix(tokens, 0)`, which is the same for all bands.
    """

    def __init__(self, tokens: np.ndarray, band: int, m: int, value: np.ndarray):
        seg = ((mix(tokens, 2 * band + 1) >> _HALF) * np.uint64(m)) >> _HALF
        order = np.argsort(seg.astype(np.uint16) if m <= 1 << 16 else seg, kind="stable")
        self.value = value[order]
        at = np.zeros(m + 1, np.int64)
        np.cumsum(np.bincount(seg.astype(np.int64), minlength=m), out=at[1:])
        sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(self.value, out=sums[1:])
        ends = sums[at]
        self.at, self.sum, self.size = at, ends[1:] - ends[:-1], at[1:] - at[:-1]
        self.place = _places(band, m) if m <= _PLACES else _places.__wrapped__(band, m)
        self.key = self._key(self.sum, self.size, self.place)

    def _key(self, total: np.ndarray, size: np.ndarray, place: np.ndarray) -> np.ndarray:
        return mix(total + place + size.astype(np.uint64), 4) & _KEY

    def without_one(self, segs: np.ndarray) -> np.ndarray:
        if not len(segs):
            return np.zeros(0, np.uint64)
        each = np.concatenate([np.arange(self.at[s], self.at[s + 1]) for s in segs])
        seg = np.repeat(segs, self.size[segs])
        return self._key(self.sum[seg] - self.value[each], self.size[seg] - 1, self.place[seg])


def deletable(m: int) -> int:
    """Number of segments, the first ones, that are indexed with their one-deletion neighbourhoods."""
    return min(m, int(m * DELETIONS) + 1)


def allocate(parts: Parts, need: int, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments to ask exactly and segments to ask with one deletion, of least estimated cost with values
    summing to `need`. `held`: how often indexed keys of a slot occur beyond the usual."""
    cost = 1.0 + held[(parts.key >> np.uint64(61 - SKETCH_BITS)).astype(np.int64)] + np.where(parts.size == 0, EMPTY_COST, 0)
    order = np.argsort(cost, kind="stable")
    need = min(need, len(order))
    able = order[: max(0, need - deletable(len(order)))]
    able = able[able < deletable(len(order))]
    extra = 1.0 + parts.size[able] + cost[able]
    able, extra = able[np.argsort(extra, kind="stable")], np.sort(extra)
    paid = np.concatenate([[0], np.cumsum(cost[order])])
    total = np.concatenate([[0], np.cumsum(extra)]) + paid[need - np.arange(len(able) + 1)]
    t = int(np.argmin(total))
    return order[: need - t], able[:t]


def index_rows(tokens: np.ndarray, bands: Bands, held: np.ndarray) -> np.ndarray:
    """Keys of one set, each with what it is in the low three bits."""
    n = len(tokens)
    if n == 0:
        return np.zeros(0, np.uint64)
    b, value, out = bands.of(n), mix(tokens, 0), []

    def put(keys: np.ndarray, what) -> None:
        out.append((keys << np.uint64(3)) | np.asarray(what, np.uint64))

    m = bands.segments(b)
    if m > 1:
        own = Parts(tokens, b, m, value)
        ask, less = allocate(own, bands.differ(n, n) + 1, held)
        what = np.full(m, EXACT_HELD)
        what[ask] = EXACT_BOTH
        put(own.key, what)
        first = np.arange(deletable(m))
        put(own.without_one(np.setdiff1d(first, less)), LESS_HELD)
        put(own.without_one(less), LESS_BOTH)
    if b and (m := bands.segments(b - 1)) > 1 and bands.high[b - 1] * 100 >= bands.percent * n:
        low = Parts(tokens, b - 1, m, value)
        ask, less = allocate(low, bands.differ(n, bands.high[b - 1]) + 1, held)
        put(low.key[ask], EXACT_ASKED)
        put(low.without_one(less), LESS_ASKED)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _sets(batch: pa.RecordBatch, n: int, text: str = "text", where: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and token set of each row (of the rows flagged in `where`)."""
    data, bounds = utf8(batch.column(text))
    for i, j in row_blocks(bounds):
        if where is not None and not where[i:j].any():
            continue
        _, _, h, rows = words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
        yield from zip(range(i, j), shingles(h, rows, n), strict=True)


def _class_of(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: sums of two independent mixes of its tokens."""
    return tuple(int(np.uint64(mix(tokens, s).sum(dtype=np.uint64)).view(np.int64)) for s in (21, 22))


def outline(tokens: np.ndarray) -> bytes:
    """Token counts per hash bin (up to 255), about two tokens a bin. The bins of two sets differ in sum by no more
    than the sets do in tokens, also when bins are merged, so a larger sum rules a pair out for sure."""
    bits = min(11, max(4, (len(tokens) - 1).bit_length() - 1))
    counts = np.bincount((mix(tokens, 41) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def fold_bins(outlines: list[bytes]) -> np.ndarray:
    """Outlines as rows of a matrix, all with the bins of the coarsest."""
    size = min(map(len, outlines))
    return np.stack([np.frombuffer(o, np.uint8).reshape(size, -1).sum(1, dtype=np.int32) for o in outlines])


def describe(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc, version, n, c1, c2, outline) per row, and rows (n = -1) with slots of the sketch that are much fuller than the rest (c1: slot, c2: count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, counts, keys = Bands(percent), np.zeros(1 << SKETCH_BITS, np.int64), 0
        for b in batches:
            size, c1, c2 = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            outlines: list = [None] * b.num_rows
            for k, tokens in _sets(b, n):
                size[k] = len(tokens)
                if len(tokens):
                    c1[k], c2[k] = _class_of(tokens)
                    outlines[k] = outline(tokens)
                    band = bands.of(len(tokens))
                    if (m := bands.segments(band)) > 1:
                        slot = (Parts(tokens, band, m, mix(tokens, 0)).key >> np.uint64(61 - SKETCH_BITS)).astype(np.int64)
                        np.add.at(counts, slot, 1)
                        keys += m
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("version"), pa.array(size), pa.array(c1), pa.array(c2), pa.array(outlines, pa.binary())], names=["doc", "version", "n", "c1", "c2", "outline"])
        full = np.flatnonzero(counts > 8 + 4 * keys / len(counts))
        if len(full):
            none = pa.nulls(len(full), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(np.full(len(full), -1)), pa.array(full), pa.array(counts[full]), pa.nulls(len(full), pa.binary())], names=["doc", "version", "n", "c1", "c2", "outline"])

    return rows.mapInArrow(freeing(run), "doc long, version long, n long, c1 long, c2 long, outline binary")


def emit(rows: DataFrame, n: int, percent: int, held) -> DataFrame:
    """Index rows (key, doc) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, cost = Bands(percent), held.value
        for b in batches:
            doc = b.column("doc").to_numpy(zero_copy_only=False)
            keys, owner, size = [], [], 0
            for k, tokens in _sets(b, n):
                keys.append(index_rows(tokens, bands, cost))
                owner.append(np.full(len(keys[-1]), doc[k]))
                size += len(keys[-1])
                if size > 1 << 16:
                    yield _pairs(keys, owner)
                    keys, owner, size = [], [], 0
            if size:
                yield _pairs(keys, owner)

    def _pairs(keys: list, owner: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owner))], names=["key", "doc"])

    return rows.mapInArrow(freeing(run), "key long, doc long")


def meet(index: DataFrame) -> DataFrame:
    """(bucket, head, head_is, doc, is_): every set that shares a key with the first set that asks for it.

    Rows come sorted by key; only the head of the current bucket is held, so buckets of any size stream by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head, head_is = None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            key, doc = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "doc"))
            bucket, what = key >> 3, key & 7
            new = np.ones(len(key), bool)
            new[1:] = bucket[1:] != bucket[:-1]
            new[0] = bucket[0] != last
            at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            own, own_is = np.where(at >= 0, doc[at], head), np.where(at >= 0, what[at], head_is)
            last, head, head_is = bucket[-1], own[-1], own_is[-1]
            keep = ~new & (own_is < EXACT_HELD) & (own != doc)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (bucket, own, own_is, doc, what)], names=["bucket", "head", "head_is", "doc", "is_"])

    return index.repartition(F.shiftright("key", 3)).sortWithinPartitions("key", "doc").mapInArrow(freeing(run), "bucket long, head long, head_is long, doc long, is_ long")


def _slots(col) -> object:
    return F.pmod(F.xxhash64(col), F.lit(1 << FILTER_BITS)).cast("int")


def token_sets(rows: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(doc, tokens) of the wanted docs and of some others: a bit table of fixed size keeps most rows from being cut up."""
    spark = rows.sparkSession
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[wanted.select(_slots("doc").alias("s")).distinct().toArrow()["s"].to_numpy()] = True
    shared = spark.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = b.column("doc")
            got, size = [], 0
            for k, tokens in _sets(b, n):
                got.append((doc[k].as_py(), tokens.tobytes()))
                size += len(tokens)
                if size > 1 << 18:
                    yield _batch(got)
                    got, size = [], 0
            if got:
                yield _batch(got)

    def _batch(got: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary())], names=["doc", "tokens"])

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            yield b.select(["doc", "text"]).filter(pa.array(table[b.column("slot").to_numpy()]))

    kept = rows.select("doc", "text", _slots("doc").alias("slot")).mapInArrow(freeing(lambda it: run(some(it))), "doc long, tokens binary")
    return kept


def _far(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Flags of pairs that cannot be similar: too different in size, or in the sum over their bins."""
    apart = np.abs(a - b).sum(-1) * (100 + percent) > (na + nb) * (100 - percent)
    return apart | (np.minimum(na, nb) * 100 < np.maximum(na, nb) * percent)


def rule_out(pairs: DataFrame, outlines: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their outlines allow to be similar."""
    for end in ("a", "b"):
        pairs = pairs.join(outlines.select(F.col("doc").alias(end), F.col("n").alias(f"n{end}"), F.col("outline").alias(f"o{end}")), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, nx, ny in zip(*(batch.column(c).to_pylist() for c in ("oa", "ob", "na", "nb")), strict=True):
                m = fold_bins([x, y])
                keep.append(not _far(m[0], m[1], nx, ny, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "na", "nb", "oa", "ob").mapInArrow(freeing(run), "a long, b long").distinct()


def cross(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets of one bucket and cell that are in different components, may meet, and whose outlines allow it.

    Rows (bucket, i, j, left, doc, w, comp, n, outline) come sorted by cell; a cell has two blocks of bounded size
    (one, where i = j), and only pairs that pass leave it.
    """

    def pairs(cell: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        left, doc, w, comp, n = (np.array([r[k] for r in cell]) for k in range(5))
        bins = fold_bins([r[5] for r in cell])
        asks, holds = w < EXACT_HELD, (w != EXACT_ASKED) & (w != LESS_ASKED)
        exact = (w == EXACT_BOTH) | (w == EXACT_ASKED) | (w == EXACT_HELD)
        first, second = np.flatnonzero(left), np.flatnonzero(~left) if not left.all() else np.arange(len(cell))
        out = []
        for i in first:
            may = (comp[second] != comp[i]) & (exact[second] | exact[i]) & ((asks[second] & holds[i]) | (holds[second] & asks[i]))
            js = second[may]
            js = js[~_far(bins[js], bins[i], n[js], n[i], percent)]
            out.append((np.minimum(doc[js], doc[i]), np.maximum(doc[js], doc[i])))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if len(cell) > 1 and any(r[0] for r in cell):
                a, b = pairs(cell)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != at:
                    yield from done()
                    at, cell = row[:3], []
                cell.append(row[3:])
        yield from done()

    cells = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "doc", "w")
    return cells.select("bucket", "i", "j", "left", "doc", "w", "comp", "n", "outline").mapInArrow(freeing(run), "a long, b long").distinct()


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of candidate pairs: 100 * common tokens >= percent * tokens of both."""
    left = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("doc").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("ta"), batch.column("tb"), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if min(len(s), len(t)) * 100 < percent * max(len(s), len(t)):
                    linked.append(False)
                    continue
                merged = np.sort(np.concatenate([s, t]), kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())
                linked.append(100 * common >= percent * (len(s) + len(t) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return both.mapInArrow(freeing(run), "a long, b long, linked boolean").groupBy("a", "b").agg(F.max("linked").alias("linked"))


def components(links: DataFrame, stages: Stages, name: str) -> DataFrame:
    """(id, comp): smallest id reachable over links (a, b), for ids that have a link.

    Each round takes the least label around a node and follows it once; it ends when no label falls, and
    every round is a written table.
    """
    both = stages.keep(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-arcs")
    label = stages.keep(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), f"{name}-0")
    total, k = None, 0
    if both.isEmpty():
        return label
    while True:
        now = label.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return label
        total, k = now, k + 1
        near = both.join(label.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        step = label.join(near, "id").select("id", F.least("comp", "near").alias("comp"))
        jump = label.select(F.col("id").alias("comp"), F.col("comp").alias("further"))
        step = step.join(jump, "comp", "left").select("id", F.least("comp", "further").alias("comp"))
        label = stages.keep(step, f"{name}-{k}")
        if k > 1:
            stages.drop(f"{name}-{k - 2}")


def jaccard_classes(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, version, n_shingles, component_id) per row: size of its set of distinct n-word shingles, and the smallest id
    reachable over links, where two sets link when 100 * common >= percent * united.

    A text of fewer words is one shingle of all its words; null and empty texts have an empty set and link
    with nothing. Equal sets are one node from the start (their smallest id stands for them). Rows that
    share an id are one document with several texts. A null id counts as no document: its row links
    others, but its component is null if nothing else is in it; ids are below 2^62. `version` is a hash of the text. An empty
    table gives no rows. Candidates are met in three turns, each only between components that are still
    apart: every set with the head it shares most keys with, with all heads, with all sets. Only pairs that sizes or
    outlines rule out for sure are not compared token by token; no pair is left out.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "jaccard")
    no_id = 1 << 62  # documents without an id get one from here on
    version = F.coalesce(F.xxhash64(text), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.pmod(F.xxhash64(text), F.lit(no_id)) + F.lit(no_id)).alias("doc"), version.alias("version"), F.col(text).alias("text"))
    told = stages.keep(describe(rows.select("doc", "version", "text"), n, percent), "told")
    held = np.zeros(1 << SKETCH_BITS, np.float64)
    heavy = told.filter("n = -1").groupBy("c1").agg(F.sum("c2").alias("c2")).toArrow()  # 2^SKETCH_BITS rows at most
    held[heavy["c1"].to_numpy()] = heavy["c2"].to_numpy()
    shared = spark.sparkContext.broadcast(held)
    # Empty sets are classes of their own
    plain = told.filter("n >= 0").withColumns({"c1": F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("c1")), "salt": F.pmod(F.xxhash64("doc", "version"), F.lit(64)).cast("int")})
    kinds = ["n", "c1", "c2"]
    parts = plain.groupBy(*kinds, "salt").agg(F.min(F.struct("doc", "version")).alias("least"), F.count("*").alias("rows"))
    classes = parts.groupBy(*kinds).agg(F.min("least").alias("rep"), F.collect_list("salt").alias("salts"), F.sum("rows").alias("rows"))
    classes = stages.keep(classes, "classes")
    back = classes.select(*kinds, "rep", F.explode("salts").alias("salt"))
    of = stages.keep(plain.join(back, [*kinds, "salt"]).select("doc", "version", "n", "rep", "outline"), "members")
    copies = stages.keep(of.filter((F.col("doc") != F.col("rep.doc")) | (F.col("version") != F.col("rep.version"))).select("doc", "version").distinct(), "copies")
    texts = rows.select("doc", "version", "text")
    met = stages.keep(meet(emit(texts.join(copies, ["doc", "version"], "left_anti"), n, percent, shared)), "met")
    outlines = of.filter((F.col("doc") == F.col("rep.doc")) & (F.col("version") == F.col("rep.version")) & (F.col("n") > 0)).select("doc", "n", "outline")
    # a document with several texts is one node: its texts' classes are linked through it
    several = of.groupBy("doc").agg(F.min("rep.doc").alias("a"), F.max("rep.doc").alias("z")).filter("a <> z").select("doc")
    own = of.join(several, "doc").select(F.least("doc", "rep.doc").alias("a"), F.greatest("doc", "rep.doc").alias("b")).filter("a <> b").distinct()
    links = stages.keep(own, "links-0")
    label, done = components(links, stages, "comp-0"), None
    for turn in ("best", "heads", "all"):
        pairs = _candidates(met, label, turn, percent, outlines)
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stages.keep(rule_out(pairs, outlines, percent), f"pairs-{turn}")
        ends = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
        if pairs.limit(1).count():
            seen = stages.keep(verify(pairs, token_sets(texts, ends, n), percent), f"seen-{turn}")
            links = links.union(seen.filter("linked").select("a", "b"))
            done = seen.select("a", "b") if done is None else done.union(seen.select("a", "b"))
            if seen.filter("linked").limit(1).count():
                label = components(links, stages, f"comp-{turn}")
    named = classes.join(label.select(F.col("id").alias("rep_doc"), "comp"), F.col("rep.doc") == F.col("rep_doc"), "left")
    named = named.select(*kinds, F.coalesce("comp", F.col("rep.doc")).alias("comp"), F.explode("salts").alias("salt"))
    out = plain.join(named, [*kinds, "salt"]).select("doc", "version", F.col("n").alias("n_shingles"), "comp")
    return out.select(F.when(F.col("doc") < no_id, F.col("doc")).alias("doc"), "version", "n_shingles", F.when(F.col("comp") < no_id, F.col("comp")).alias("component_id"))


def _candidates(met: DataFrame, label: DataFrame, turn: str, percent: int, outlines: DataFrame) -> DataFrame:
    """Pairs (a < b) of a turn whose ends are in different components."""
    if turn == "best":
        count = met.groupBy("doc", "head").agg(F.count("*").alias("n"))
        best = count.groupBy("doc").agg(F.max(F.struct("n", F.negate("head").alias("h"))).alias("m")).select("doc", F.negate("m.h").alias("head"))
        return best.select(F.least("doc", "head").alias("a"), F.greatest("doc", "head").alias("b")).distinct()
    if turn == "heads":
        pairs = met.select(F.least("doc", "head").alias("a"), F.greatest("doc", "head").alias("b")).distinct()
        for end in ("a", "b"):
            pairs = pairs.join(label.select(F.col("id").alias(end), F.col("comp").alias(f"c{end}")), end, "left")
        return pairs.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    rows = met.select("bucket", "doc", F.col("is_").alias("w")).union(met.select("bucket", "head", "head_is")).distinct()
    rows = rows.join(label.select(F.col("id").alias("doc"), "comp"), "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    mixed = rows.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.ceil(F.count("*") / CELL).alias("blocks")).filter("c0 <> c1").select("bucket", "blocks")
    rows = rows.join(mixed, "bucket").join(outlines, "doc").withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    # a bucket of several blocks is a grid of cells, block i against block j from i on
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = rows.withColumn("other", F.explode(other)).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    return cross(spread.withColumn("left", F.col("own") == F.col("i")), percent)
