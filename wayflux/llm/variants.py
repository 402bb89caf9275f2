"""Spelling variants: words one edit apart, found by scanning sorted lists with banded edit-matrix rows.

In a sorted list, words that begin alike are neighbours, and the rows of the edit matrix of their common beginning are
the same; each is worked out once, and a range of words whose common beginning is more than one edit from every
beginning of the asked word is skipped. An edit in the later half of a word leaves its beginning as it is, one in the
earlier half its end; so a word is only held against those with its first half in the sorted list, and in the list of
reversed words. Lists are cut into blocks of bounded size; a word visits the blocks whose own beginning is not skipped.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.llm.common import Stages, freeing
from wayflux.llm.tokens import FOLD, row_blocks, utf8, words
from wayflux.session import salted_join

BLOCK_WORDS = 8192
MOST_BLOCKS = 1 << 16  # the directory has at most so many rows; beyond, blocks grow
BOUND_CHARS = 48  # of the bounds of a block; a shorter bound only lets a word visit more blocks
HELD = 1 << 18
ROWS = 1 << 16
_LAST = chr(0x10FFFF)


def _shift_tables(longest: int) -> np.ndarray:
    """[n][k][b]: what byte k with value b of a crc32 becomes when n more bytes follow, apart from those bytes' own crc32."""
    out = np.zeros((longest + 1, 4, 256), np.uint32)
    for n in range(longest + 1):
        zeros = bytes(n)
        base = zlib.crc32(zeros)
        for bit in range(32):
            k, b = divmod(bit, 8)
            out[n, k, (np.arange(256) >> b) & 1 == 1] ^= np.uint32(zlib.crc32(zeros, 1 << bit) ^ base)
    return out


SHORT = 64  # bytes of a word up to which the crc32 of an id and the word are put together from tables
_tables: list[np.ndarray] = []


def crc_after(seed: np.ndarray, size: np.ndarray, own: np.ndarray) -> np.ndarray:
    """crc32 of two strings from that of the first, and the length (up to SHORT) and crc32 of the second."""
    if not _tables:
        _tables.append(_shift_tables(SHORT))
    out, table = own.copy(), _tables[0]
    for k in range(4):
        out ^= table[size, k, (seed >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cleaned text, and bounds, hash, row bounds and code points of its runs of A-Z, a-z and U+00C0 to U+00FF."""
    lead = data == 0xC3  # all of U+00C0 to U+00FF are this byte and one more
    letter = lead.copy()
    letter[1:] |= lead[:-1]
    low = FOLD[data]
    letter |= (low >= 97) & (low <= 122)
    clean = np.where(letter, low, np.uint8(32))
    start, end, h, at = words(clean, bounds)
    leads = np.zeros(len(data) + 1, np.int32)
    np.cumsum(lead, out=leads[1:])
    return clean, start, end, h, at, end - start - (leads[end] - leads[start])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 7, min_count: int = 2, slip: int = 31) -> DataFrame:
    """(word, n): distinct words of `min_chars` code points or more that occur `min_count` times or more.

    Words are maximal runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. With `slip`, a word loses a letter
    wherever that divides the crc32 of `<id>:<word>`: the one at its remainder by the word's length.
    """
    seed = F.crc32(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            rows = list(seen.items())
            for a in range(0, len(rows), ROWS):
                part = rows[a : a + ROWS]
                yield pa.RecordBatch.from_arrays([pa.array([r[0].decode() for r in part], pa.string()), pa.array([r[1] for r in part], pa.int64())], names=["word", "n"])
            seen.clear()

        for b in batches:
            data, bounds = utf8(b.column("text"))
            seeds = b.column("seed").to_numpy().astype(np.uint32)
            for i, j in row_blocks(bounds):
                clean, start, end, h, at, chars = _runs(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                row = np.repeat(np.arange(i, j), np.diff(at))
                long = chars >= min_chars
                start, end, h, chars, row = start[long], end[long], h[long], chars[long], row[long]
                _, first, which = np.unique(h, return_index=True, return_inverse=True)
                raw = clean.tobytes()
                own = [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)]
                slipped = np.zeros(len(h), bool)
                if slip and len(h):
                    size = (end - start)[first]
                    crc = np.array([zlib.crc32(w) for w in own], np.uint32)[which]
                    crc = crc_after(seeds[row], np.minimum(size, SHORT)[which], crc)
                    for k in np.flatnonzero((size > SHORT)[which]).tolist():
                        crc[k] = zlib.crc32(own[which[k]], int(seeds[row[k]]))
                    slipped = crc % np.uint32(slip) == 0
                    for k in np.flatnonzero(slipped & (chars > min_chars)).tolist():
                        word, p = own[which[k]].decode(), int(crc[k]) % int(chars[k])
                        word = (word[:p] + word[p + 1 :]).encode()
                        seen[word] = seen.get(word, 0) + 1
                for word, n in zip(own, np.bincount(which[~slipped], minlength=len(own)).tolist(), strict=True):
                    if n:
                        seen[word] = seen.get(word, 0) + n
                if len(seen) > HELD:
                    yield from out()
        yield from out()

    found = docs.select(F.col(text).cast("string").alias("text"), seed.alias("seed")).mapInArrow(freeing(run), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class SortedList:
    """Distinct words in code-point order, with the lengths of the beginnings that neighbours share."""

    def __init__(self, keys: list[str]):
        self.keys = keys
        self.chars, self.at, self.size = flat(keys)
        n = len(keys)
        shared = np.zeros(n, np.int64)
        same, depth = np.arange(1, n), 0
        while len(same):
            same = same[(self.size[same] > depth) & (self.size[same - 1] > depth)]
            same = same[self.chars[self.at[same] + depth] == self.chars[self.at[same - 1] + depth]]
            depth += 1
            shared[same] = depth
        self.turns = np.lexsort((np.arange(n), shared))  # where a word parts from the one before, by depth
        self.turns = self.turns[self.turns > 0]
        self.depths = shared[self.turns]

    def parting(self, depth: int) -> np.ndarray:
        """Positions of the words that share exactly `depth` code points with the word before."""
        return self.turns[slice(*np.searchsorted(self.depths, [depth, depth + 1]))]

    def near(self, asked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (position in `asked`, position in the list) that are one edit apart and share the first (n - 1) // 2
        code points, n being the length of the asked word."""
        chars, at, size = flat(asked)
        begin = (size - 1) // 2
        low = np.array([bisect_left(self.keys, w[: (len(w) - 1) // 2]) for w in asked], np.int64)
        high = np.array([bisect_left(self.keys, w[: (len(w) - 1) // 2] + _LAST) for w in asked], np.int64)
        waiting = np.flatnonzero(low < high)
        waiting = waiting[np.argsort(begin[waiting], kind="stable")]
        none = np.zeros(0, np.int64)
        q, lo, hi = none, none, none
        rows = np.zeros((3, 0), np.uint8)  # distances to the first depth - 1, depth and depth + 1 code points asked
        found: list[tuple[np.ndarray, np.ndarray]] = []
        depth = int(begin[waiting[0]]) if len(waiting) else 0
        while len(q) or len(waiting):
            if not len(q):
                depth = int(begin[waiting[0]])
            now = int(np.searchsorted(begin[waiting], depth, "right"))
            new, waiting = waiting[:now], waiting[now:]
            q, lo, hi = np.r_[q, new], np.r_[lo, low[new]], np.r_[hi, high[new]]
            fresh = np.empty((3, len(new)), np.uint8)
            fresh[0], fresh[1], fresh[2] = (1 if depth else 2), 0, 1
            rows = np.concatenate([rows, fresh], axis=1)

            # the first word of a range may end here
            ends = self.size[lo] == depth
            over = size[q] - depth
            done = np.flatnonzero(ends & (np.abs(over) <= 1))
            done = done[rows[over[done] + 1, done] == 1]
            found.append((q[done], lo[done]))

            # ranges of the words that go on alike: from where each parts from the one before
            turns = self.parting(depth)
            a, b = np.searchsorted(turns, lo, "right"), np.searchsorted(turns, hi, "left")
            kinds = np.maximum(b - a, 0) + 1
            of = np.repeat(np.arange(len(q)), kinds)
            step = np.arange(len(of)) - np.repeat(np.cumsum(kinds) - kinds, kinds)
            start, stop = lo[of], hi[of]
            later = np.flatnonzero(step)
            start[later] = turns[a[of[later]] + step[later] - 1]
            before = np.flatnonzero(step < kinds[of] - 1)
            stop[before] = turns[a[of[before]] + step[before]]
            goes = np.flatnonzero(~(ends[of] & (step == 0)))
            of, start, stop = of[goes], start[goes], stop[goes]

            c, own, left = self.chars[self.at[start] + depth], q[of], size[q[of]]
            differs = [c != chars[np.minimum(at[own] + depth + k, len(chars) - 1)] for k in (-1, 0, 1)]
            r0, r1, r2 = rows[:, of]
            n0 = np.minimum(r0 + differs[0], r1 + 1) if depth else r1 + 1
            n1 = np.where(left > depth, np.minimum(np.minimum(r1 + differs[1], r2 + 1), n0 + 1), 2)
            n2 = np.where(left > depth + 1, np.minimum(r2 + differs[2], n1 + 1), 2)
            rows = np.minimum(np.stack([n0, n1, n2]), 2).astype(np.uint8)
            alive = np.flatnonzero(rows.min(0) <= 1) if len(of) else none  # all other ranges are skipped
            q, lo, hi, rows = own[alive], start[alive], stop[alive], rows[:, alive]
            depth += 1
        if not found:
            return none, none
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def flat(keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words on end (and one 0), where each begins, and lengths."""
    size = np.fromiter(map(len, keys), np.int64, len(keys))
    chars = np.frombuffer(("".join(keys) + "\0").encode("utf-32-le"), np.uint32)
    return chars, np.cumsum(size) - size, size


def _alike(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], i: np.ndarray, j: np.ndarray, n: np.ndarray, from_end: bool) -> np.ndarray:
    """Whether words i of x and j of y share their first (or last) n code points."""
    same = np.ones(len(i), bool)
    todo = np.flatnonzero(n > 0)
    t = 0
    while len(todo):
        a = x[1][i[todo]] + (x[2][i[todo]] - 1 - t if from_end else t)
        b = y[1][j[todo]] + (y[2][j[todo]] - 1 - t if from_end else t)
        equal = x[0][a] == y[0][b]
        same[todo[~equal]] = False
        t += 1
        todo = todo[equal & (n[todo] > t)]
    return same


class Directory:
    """First and last words of the blocks of a sorted list, cut to BOUND_CHARS code points."""

    def __init__(self, blocks: list[int], first: list[str], last: list[str]):
        self.blocks, self.first, self.last = blocks, first, last
        self.common = [os.path.commonprefix([a, b]) for a, b in zip(first, last, strict=True)]

    def visited(self, word: str, own: int) -> list[int]:
        """Blocks other than `own` that may hold words which share the word's first half and are one edit away."""
        half = word[: (len(word) - 1) // 2][:BOUND_CHARS]
        k, out = bisect_left(self.last, half), []
        while k < len(self.blocks) and self.first[k] <= half + _LAST:
            dead = self.blocks[k] != own and beyond_one_edit(self.common[k], word)
            if dead:  # all blocks that begin alike are skipped
                k = max(k + 1, bisect_right(self.last, self.common[k][:dead] + _LAST))
                continue
            if self.blocks[k] != own:
                out.append(self.blocks[k])
            k += 1
        return out


def beyond_one_edit(start: str, word: str) -> int:
    """0 if some word that begins with `start` may be one edit from `word`; else how much of `start` rules that out."""
    i = shared_start(start, word, 0, 0)
    if i >= len(start):
        return 0
    reach = max(i + 1 + shared_start(start, word, i + 1, i + 1), i + 1 + shared_start(start, word, i + 1, i), i + shared_start(start, word, i, i + 1))
    return 0 if reach >= len(start) else reach + 1


def shared_start(x: str, y: str, i: int, j: int) -> int:
    n = 0
    while i + n < len(x) and j + n < len(y) and x[i + n] == y[j + n]:
        n += 1
    return n


def near_words(counted: DataFrame, stages: Stages, backwards: bool) -> DataFrame:
    """(word, near, m): words one edit apart that share their first half, or else (`backwards`) those that do not.

    Each pair comes from both sides; m is the count of `near`. Half is half the length of the shorter word.
    """
    spark, name = counted.sparkSession, "back" if backwards else "fore"
    key = F.reverse("word") if backwards else F.col("word")
    total = counted.count()
    size = max(BLOCK_WORDS, -(-total // MOST_BLOCKS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for b in batches:
            at = np.arange(seen, seen + b.num_rows)
            seen += b.num_rows
            block = b.column("part").to_numpy().astype(np.int64) << 32 | at // size
            yield pa.RecordBatch.from_arrays([pa.array(block), b.column("key"), b.column("n")], names=["block", "key", "n"])

    ordered = counted.select(key.alias("key"), "n").repartitionByRange(max(1, -(-total // (4 * size))), "key").sortWithinPartitions("key")
    members = stages.keep(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(cut, "block long, key string, n long"), name)
    bounds = members.groupBy("block").agg(F.min(F.substring("key", 1, BOUND_CHARS)).alias("first"), F.max(F.substring("key", 1, BOUND_CHARS)).alias("last"))
    rows = sorted(bounds.collect(), key=lambda r: (r["first"], r["last"]))  # one row per block, MOST_BLOCKS and some at most
    directory = spark.sparkContext.broadcast(Directory(*([r[k] for r in rows] for k in ("block", "first", "last"))))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block, word = [], []
            for own, w in zip(b.column("block").to_pylist(), b.column("key").to_pylist(), strict=True):
                for other in directory.value.visited(w, own):
                    block.append(other)
                    word.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(word, pa.string())], names=["block", "key"])

    visits = members.select("block", "key").mapInArrow(visit, "block long, key string").withColumn("n", F.lit(None).cast("long"))
    met = members.unionByName(visits).repartition(max(1, -(-total // size)), "block").sortWithinPartitions("block", F.col("n").isNull(), "key")

    def pairs(index: SortedList, counts: np.ndarray, asked: list[str]) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(asked), BLOCK_WORDS):
            some = asked[a : a + BLOCK_WORDS]
            i, j = index.near(some)
            x, y = flat(some), (index.chars, index.at, index.size)
            half = np.minimum(x[2][i], y[2][j]) // 2
            fits = _alike(x, y, i, j, half, backwards) != backwards
            i, j = i[fits], j[fits]
            for s in range(0, len(i), ROWS):
                p, r = i[s : s + ROWS].tolist(), j[s : s + ROWS]
                words_, nears = [some[k] for k in p], [index.keys[k] for k in r.tolist()]
                if backwards:
                    words_, nears = [w[::-1] for w in words_], [w[::-1] for w in nears]
                yield pa.RecordBatch.from_arrays([pa.array(words_, pa.string()), pa.array(nears, pa.string()), pa.array(counts[r])], names=["word", "near", "m"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, counts, index = None, [], [], None

        def ready() -> Iterator[pa.RecordBatch]:
            nonlocal index
            if keys and index is None:
                index = SortedList(keys)
                yield from pairs(index, np.array(counts, np.int64), keys)

        for b in batches:
            own, asks = b.column("block").to_numpy(), b.column("n").is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((own[1:] != own[:-1]) | (asks[1:] != asks[:-1])) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(own)], strict=True):
                if s == e:
                    continue
                if own[s] != block:
                    yield from ready()
                    block, keys, counts, index = own[s], [], [], None
                part = b.slice(s, e - s)
                if asks[s]:
                    yield from ready()
                    yield from pairs(index, np.array(counts, np.int64), part.column("key").to_pylist())
                else:
                    keys.extend(part.column("key").to_pylist())
                    counts.extend(part.column("n").to_pylist())
        yield from ready()

    return met.mapInArrow(freeing(scan), T.StructType([T.StructField("word", T.StringType()), T.StructField("near", T.StringType()), T.StructField("m", T.LongType())]))


def group_variants(counted: DataFrame, times: int = 10, stages: Stages | None = None) -> DataFrame:
    """(word, n, form, root, n_near, form_n) of distinct words and their counts (word, n).

    Near words differ by exactly one code point inserted, deleted or replaced. The near word with the largest count
    (ties: the first in code-point order) is the form if it has `times` the word's count. The root is where following
    forms ends; a word without form is its own. An empty table gives no rows.
    """
    stages = stages or Stages(counted.sparkSession, "variants")
    near = near_words(counted, stages, False).union(near_words(counted, stages, True))
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("near").alias("form"))).alias("best"))
    best = best.select(F.col("word").alias("w"), "n_near", F.col("best.form").alias("form"), (-F.col("best.m")).alias("form_n"))
    joined = counted.join(best, counted["word"] == best["w"], "left")
    formed = F.coalesce(F.col("form_n") >= times * F.col("n"), F.lit(False))
    found = stages.keep(joined.select("word", "n", F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")), "forms")

    # counts rise by `times` with every form, so a chain is short, and its length halves with every turn
    links, turn = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stages.keep(salted_join(links, on, ["root"], "left", spread=["word"]).select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots{turn}")
        links = after.select("word", "root")
        if not after.filter("moved").limit(1).count():
            break
        turn += 1
    roots = links.select(F.col("word").alias("w"), "root")
    return found.join(roots, found["word"] == roots["w"], "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 7, min_count: int = 2, slip: int = 31, times: int = 10) -> DataFrame:
    """`group_variants` of the vocabulary of whole texts.

    A null text has no words; a null id counts as an empty one where letters slip; repeated rows count as often as they
    occur. Other columns are not looked at. An empty table gives no rows.
    """
    stages = Stages(docs.sparkSession, "variants")
    return group_variants(stages.keep(vocabulary(docs, id_col, text, min_chars, min_count, slip), "words"), times, stages)
