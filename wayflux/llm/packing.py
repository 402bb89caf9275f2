"""Sequences of bounded size from token pieces: vector best-fit, planned on the counts of lengths, carried out in Spark.

What a piece needs (tokens, one of the documents of a sequence, attention cost: its length squared) follows from its
length. So the greedy choice, longest first, is made for whole classes of equal pieces and equally filled sequences;
the plan is as large as a sequence has tokens, and the driver never sees a document. Every piece then finds its place
from its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wayflux.llm.common import Stages, freeing

# fixed value: how byte-level BPE vocabularies of this family cut text before merging
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("norm", "dot")
RANK_BITS = 44
BATCH_IDS = 1 << 20

_encoders: dict[str, Callable[[list[str]], list[list[int]]]] = {}


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Texts to ids without special tokens, whose strings in a text are ordinary text.

    A plain byte-level BPE vocabulary runs on a faster implementation of the same merges (they agree on every
    assigned code point); all others on the library that the file is of.
    """
    if path not in _encoders:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec.get("model") or {}, spec.get("pre_tokenizer") or {}
        vocab, merges = model.get("vocab") or {}, model.get("merges") or []
        merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in merges]
        plain = model.get("type") == "BPE" and not spec.get("normalizer") and merged == list(range(256, 256 + len(merged))) and len(vocab) == 256 + len(merged)
        if plain and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space"):
            import tiktoken

            byte = byte_alphabet()
            ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()}
            encoding = tiktoken.Encoding("plain", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
            _encoders[path] = lambda texts: [encoding.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            _encoders[path] = lambda texts: [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    return _encoders[path]


def longest_piece(tokens: int, cost: int | None) -> int:
    return tokens if cost is None else min(tokens, math.isqrt(cost))


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, longest: int, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], part, place): every text's ids and `end_id`, cut into pieces of at
    most `longest`, of which the first may be shorter.

    `part` is the task that made the row, `place` its number among the rows of its length there.
    """
    kind = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, kind), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    schema = T.StructType([*fields, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(longest + 1, np.int64)
        for b in batches:
            rows, at, size = [], [], 0
            for k, t in enumerate(b.column(text)):
                ids = np.array([*encode([t.as_py() or ""])[0], end_id], "<u4")
                bounds = [0, *range((len(ids) - 1) % longest + 1, len(ids) + 1, longest)]
                for n, (s, e) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append((n, s, e - s, zlib.crc32(ids[s:e].tobytes()), ids[s:e] if with_ids else None, int(seen[e - s])))
                    seen[e - s] += 1
                    at.append(k)
                size += len(ids)
                if size > BATCH_IDS:
                    yield batch(b.column(id_col), rows, at, part)
                    rows, at, size = [], [], 0
            if rows:
                yield batch(b.column(id_col), rows, at, part)

    def batch(ids: pa.Array, rows: list[tuple], at: list[int], part: int) -> pa.RecordBatch:
        n, s, length, crc, own, place = (list(c) for c in zip(*rows, strict=True))
        arrays = [ids.take(pa.array(at, pa.int64())), pa.array(n, pa.int32()), *(pa.array(c, pa.int64()) for c in (s, length, crc))]
        arrays += [pa.array([o.astype(np.int32) for o in own], pa.list_(pa.int32()))] if with_ids else []
        return pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(rows), pa.int32()), pa.array(place, pa.int64())], names=schema.names)

    return docs.select(id_col, F.col(text).cast("string").alias(text)).mapInArrow(freeing(run), schema)


def plan(counts: dict[int, int], tokens: int, documents: int | None = None, cost: int | None = None, weights: tuple[float, float, float] = (1.0, 0.1, 0.1), rule: str = "norm") -> list[tuple[int, list[tuple[int, int]]]]:
    """(how many, [(length, copies), ...]) of equal sequences that hold `counts` pieces of each length.

    Longest pieces first. A piece goes to the open sequence that it fits in tokens, documents and cost, and there by the
    rule: `norm` takes the least weighted norm of the capacities left after it, `dot` the largest weighted dot product
    of its needs and the capacities left before it, all as shares of the whole capacities. One is opened only
    where none fits. Equally filled sequences are one class, so the work does not depend on the counts.
    """
    whole = np.array([tokens, documents or tokens, cost or tokens * tokens], np.int64)
    share = np.array(weights) / whole
    left, many, held = np.zeros((0, 3), np.int64), np.zeros(0, np.int64), []

    def put(k: int, bins: int, need: np.ndarray, length: int, copies: int) -> None:
        """`copies` pieces into each of `bins` sequences of class k, which become a class of their own."""
        nonlocal left, many
        now = held[k] + [(length, copies)]
        if held[k] and held[k][-1][0] == length:
            now = held[k][:-1] + [(length, held[k][-1][1] + copies)]
        if bins == many[k]:
            left[k] -= copies * need
            held[k] = now
        else:
            many[k] -= bins
            left = np.vstack([left, left[k] - copies * need])
            many = np.append(many, bins)
            held.append(now)

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        need, todo = np.array([length, 1, length * length], np.int64), counts[length]
        while todo:
            fits = np.flatnonzero((left >= need).all(1))
            if not len(fits):
                most = int((whole // need).min())
                if not most:
                    raise ValueError(f"a piece of {length} tokens fits no sequence")
                for bins, copies in ((todo // most, most), (1, todo % most)):
                    if bins and copies:
                        left, many = np.vstack([left, whole - copies * need]), np.append(many, bins)
                        held.append([(length, copies)])
                break
            if rule == "norm":  # a sequence that has taken one piece is the best again until it is full
                k = int(fits[np.argmin(((left[fits] - need) * share * (left[fits] - need) / whole).sum(1))])
                copies = min(int((left[k] // need).min()), todo)
            elif rule == "dot":
                k, copies = int(fits[np.argmax((left[fits] * share * need / whole).sum(1))]), 1
            else:
                raise ValueError(f"rule {rule}: one of {RULES}")
            bins = min(int(many[k]), todo // copies)
            put(k, bins, need, length, copies)
            todo -= bins * copies
    return [(int(n), h) for n, h in zip(many, held, strict=True)]


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """For each length, in order of ranks: from which rank on a pattern takes pieces, and where it puts them."""
    rows, taken, first = [], {}, 0
    for many, held in patterns:
        offset = 0
        for length, copies in held:
            rows.append((length << RANK_BITS | taken.get(length, 0), many, first, offset))
            taken[length] = taken.get(length, 0) + many * copies
            offset += length * copies
        first += many
    return dict(zip(("key", "many", "first", "offset"), np.array(sorted(rows), np.int64).reshape(-1, 4).T, strict=True))


def pack(docs: DataFrame, vocabulary: str, end_id: int, tokens: int = 1024, documents: int | None = None, cost: int | None = None, weights: tuple[float, float, float] = (1.0, 0.1, 0.1), rules: tuple[str, ...] = RULES, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Where every piece of every text goes: id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    A sequence holds at most `tokens` tokens, pieces of `documents` texts, and a `cost` of squared lengths (null: no
    limit beyond the tokens); texts that are longer than a piece may be are cut. Of the rules, the one whose plan
    has the fewest sequences is taken. Offsets have no gaps.

    A null text is empty, and an empty one is its end id alone. Rows without an id and repeated rows are packed like
    any others. Pieces of one length are alike to the plan, so ties go by the order of the table. Other columns are
    not looked at. An empty table gives no rows.
    """
    stages = Stages(docs.sparkSession, "packing")
    longest = longest_piece(tokens, cost)
    pieces = stages.keep(token_pieces(docs, vocabulary, end_id, longest, id_col, text, with_ids), "pieces")
    per_part = stages.keep(pieces.groupBy("part", "length").agg(F.count("*").alias("own")), "counts")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("own").alias("n")).collect()}  # one row per length
    plans = [plan(counts, tokens, documents, cost, weights, rule) for rule in rules]
    where = places(min(plans, key=lambda p: sum(n for n, _ in p)))
    before = F.sum("own").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranked = pieces.join(per_part.select("part", "length", F.coalesce(before, F.lit(0)).alias("before")), ["part", "length"])

    fields = [f for f in pieces.schema.fields if f.name not in ("part", "place")]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            k = np.searchsorted(where["key"], length << RANK_BITS | rank, "right") - 1
            beyond = rank - (where["key"][k] & ((1 << RANK_BITS) - 1))
            turn, which = np.divmod(beyond, where["many"][k])
            out = [pa.array(where["first"][k] + which), pa.array(where["offset"][k] + turn * length)]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), *out], names=schema.names)

    return ranked.select(*(f.name for f in fields), (F.col("before") + F.col("place")).alias("rank")).mapInArrow(run, schema)


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, ids, bounds): the ids of whole sequences, from `pack(..., with_ids=True)`, and where their pieces begin."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids", F.col(id_col), "piece")))
    whole = packed.groupBy("sequence_id").agg(held.alias("held"))
    begin = F.transform("held", lambda p: F.struct(p[id_col].alias(id_col), p["piece"].alias("piece"), p["offset"].alias("offset")))
    return whole.select("sequence_id", F.flatten(F.col("held")["ids"]).alias("ids"), begin.alias("bounds"))
