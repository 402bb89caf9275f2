"""WARC archives with a two-level capture index, written and read back by Spark tasks.

Archives: one gzip member per record. Index: lines sorted by reversed host, in compressed blocks, with a
sparse directory of the blocks at the end of each shard; a lookup searches the shards' first keys, the
directory and the block, then reads the record's byte range.

Files go to a folder that all executors reach. A task writes files of its own name, and only files named
in the tables of finished tasks count, so tasks that are lost or run twice do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import Stages

LINES_PER_BLOCK = 256
GAP = 1 << 16
READ = 4 << 20
CAPTURE = "surt string, page string, file string, offset long, length long"


def open_folder(where: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by a URI (file:/x and file:///x alike) or a local path."""
    if m := re.match(r"file:/+(.*)", where):
        return fs.LocalFileSystem(), "/" + m[1]
    return fs.FileSystem.from_uri(where) if "://" in where else (fs.LocalFileSystem(), where)


def _task_name() -> str:
    t = TaskContext.get()
    return f"{t.partitionId():05d}-{t.taskAttemptId()}" if t else uuid.uuid4().hex


def surt(url: str | None) -> str:
    """Sort key: host labels in reverse, then the rest: http://a.b.com/x?y -> com,b,a)/x?y."""
    if not url:
        return ""
    m = re.match(r"(?s)(.*?)://([^/?#]*)(.*)", url)
    if not m:
        return url
    return ",".join(reversed(m[2].lower().split("."))) + ")" + m[3]


def _record_id(page: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + page)}>"


def record(page: str, url: str | None, payload: bytes, kind: str, sha1: str, size: int, refers: str | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit has no payload, but the digest and length of the full one."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += ["Content-Type: application/http; msgtype=response", "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode(), f"X-Payload-Length: {size}", f"X-Page-Id: {page}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers)}", f"X-Refers-To-Page: {refers}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers, payload and its digest of one record; an inconsistent record is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} does not end where its length says")
    payload = block.partition(b"\r\n\r\n")[2]
    sha1 = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != sha1 or len(payload) != int(fields["X-Payload-Length"])):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not have the payload it names")
    return {"page": fields["X-Page-Id"], "kind": fields["WARC-Type"], "sha1": sha1, "size": int(fields["X-Payload-Length"]), "refers": fields.get("X-Refers-To-Page"), "url": fields.get("WARC-Target-URI"), "payload": payload}


def with_types(pages: DataFrame, least: int, id_col: str, url: str, html: str) -> DataFrame:
    """page, url, payload, sha1, size, kind, refers: of equal payloads of `least` bytes or more, the one with the
    largest id is the response, the others revisit it.

    Equal payloads are counted per digest and salt first, so that one payload's pages do not meet in a task.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "sha2": F.sha2("payload", 256), "size": F.length("payload").cast("long"), "salt": F.pmod(F.xxhash64("page", "url"), F.lit(64)).cast("int")})
    key = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url).cast("string").alias("url"), payload.alias("payload")).filter(F.length("payload") >= least)
    key = key.select(F.sha2("payload", 256).alias("sha2"), F.pmod(F.xxhash64("page", "url"), F.lit(64)).cast("int").alias("salt"), "page")
    parts = key.groupBy("sha2", "salt").agg(F.max("page").alias("page"), F.count("*").alias("n"))
    whole = parts.groupBy("sha2").agg(F.max("page").alias("last"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).filter("n > 1 AND last IS NOT NULL")
    first = whole.select("sha2", "last", F.explode("salts").alias("salt"))
    out = rows.join(first, ["sha2", "salt"], "left")
    again = F.col("last").isNotNull() & ~F.col("page").eqNullSafe(F.col("last"))
    return out.select("page", "url", "payload", "sha1", "size", F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("last")).alias("refers"))


def write_archives(typed: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one archive per task; returns the captures (surt, page, file, offset, length). Run it once: keep its result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        for b in batches:
            rows = []
            for r in zip(*(b.column(c).to_pylist() for c in ("page", "url", "payload", "kind", "sha1", "size", "refers")), strict=True):
                if out is None:
                    where, root = open_folder(folder)
                    where.create_dir(root)
                    name = f"{root}/{_task_name()}.warc.gz"
                    out = where.open_output_stream(name, compression=None)
                page = "" if r[0] is None else str(r[0])
                raw = record(page, r[1], r[2], r[3], r[4], r[5], str(r[6]), date)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = packer.compress(raw) + packer.flush()
                out.write(raw)
                rows.append((surt(r[1]), page, name, at, len(raw)))
                at += len(raw)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, [pa.string()] * 3 + [pa.int64()] * 2, strict=True)], names=["surt", "page", "file", "offset", "length"])
        if out is not None:
            out.close()

    return typed.mapInArrow(run, CAPTURE)


def write_index(captures: DataFrame, folder: str, lines: int = LINES_PER_BLOCK) -> DataFrame:
    """Write one index shard per range of keys; returns the shards (surt, page: first key; file, offset, length: of the directory)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at, directory, block, first = None, "", 0, [], [], None
        where = None

        def flush() -> None:
            nonlocal at, block
            raw = zlib.compress("\n".join(json.dumps(x) for x in block).encode(), 6)
            out.write(raw)
            directory.append([*block[0][:2], at, len(raw)])
            at += len(raw)
            block = []

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("surt", "page", "file", "offset", "length")), strict=True):
                if out is None:
                    where, root = open_folder(folder)
                    where.create_dir(root)
                    name, first = f"{root}/{_task_name()}.idx", row[:2]
                    out = where.open_output_stream(name, compression=None)
                block.append(row)
                if len(block) == lines:
                    flush()
        if out is not None:
            if block:
                flush()
            raw = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(raw)
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([first[0]]), pa.array([first[1]]), pa.array([name]), pa.array([at], pa.int64()), pa.array([len(raw)], pa.int64())], names=["surt", "page", "file", "offset", "length"])

    n = captures.sparkSession.sparkContext.defaultParallelism * 2
    return captures.repartitionByRange(n, "surt", "page").sortWithinPartitions("surt", "page").mapInArrow(run, CAPTURE)


class Shard:
    """One index shard: its directory, and the block read last."""

    def __init__(self, folder: str, name: str, offset: int, length: int):
        self.file = open_folder(folder)[0].open_input_file(name)
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, offset)))
        self.firsts = [(_b(d[0]), _b(d[1])) for d in self.directory]
        self.held: tuple[int, list, list] = (-1, [], [])

    def block(self, k: int) -> tuple[list, list]:
        if self.held[0] != k:
            _, _, at, size = self.directory[k]
            rows = [json.loads(x) for x in zlib.decompress(self.file.read_at(size, at)).split(b"\n")]
            self.held = (k, rows, [(_b(r[0]), _b(r[1])) for r in rows])
        return self.held[1:]

    def find(self, key: tuple[bytes, bytes]) -> Iterator[list]:
        """All lines with the key; they may start in the block before the first that begins with it."""
        k = max(0, bisect_left(self.firsts, key) - 1)
        while k < len(self.firsts) and self.firsts[k] <= key:
            rows, keys = self.block(k)
            yield from rows[bisect_left(keys, key) : bisect_right(keys, key)]
            k += 1


def _b(text: str) -> bytes:
    return text.encode()


def lookup(keys: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """Captures of every key (surt, page), equal keys once: two binary searches and a block read per key.

    The first key of each shard, a few per core of the cluster, is brought to the driver.
    """
    spark = keys.sparkSession
    known = sorted(((_b(r["surt"]), _b(r["page"])), r["file"], r["offset"], r["length"]) for r in shards.collect())
    shared = spark.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        firsts, k_open, shard = [t[0] for t in table], -1, None
        for b in batches:
            found = []
            for s, p in zip(b.column("surt").to_pylist(), b.column("page").to_pylist(), strict=True):
                key = (_b(s), _b(p))
                k = bisect_right(firsts, key) - 1
                if k < 0:
                    continue
                if k != k_open:
                    k_open, shard = k, Shard(folder, *table[k][1:])
                found += shard.find(key)
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], t) for c, t in enumerate([pa.string()] * 3 + [pa.int64()] * 2)], names=["surt", "page", "file", "offset", "length"])

    n = spark.sparkContext.defaultParallelism * 2
    return keys.distinct().repartitionByRange(n, "surt", "page").sortWithinPartitions("surt", "page").mapInArrow(run, CAPTURE)


def read_records(captures: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """page, kind, sha1, size, refers (and url, payload) of the captures, by byte ranges; near ranges are read at once."""
    schema = "page long, kind string, sha1 string, size long, refers long" + (", url string, payload binary" if payloads else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, name, file = open_folder(folder)[0], None, None
        held, held_at = b"", 0
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            out = []
            for k, (f, offset, length) in enumerate(rows):
                if f != name:
                    name, file, held, held_at = f, where.open_input_file(f), b"", 0
                if not (held_at <= offset and offset + length <= held_at + len(held)):
                    end = offset + length
                    for g, o, n in rows[k + 1 :]:
                        if g != f or o - end > GAP or o < offset or o + n - offset > READ:
                            break
                        end = max(end, o + n)
                    held, held_at = file.read_at(end - offset, offset), offset
                r = parse(zlib.decompress(held[offset - held_at : offset - held_at + length], 31))
                out.append((int(r["page"]) if r["page"] else None, r["kind"], r["sha1"], r["size"], int(r["refers"]) if r["refers"] else None, *((r["url"], r["payload"]) if payloads else ())))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 7 if payloads else 5]
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(kinds)], names=["page", "kind", "sha1", "size", "refers", "url", "payload"][: len(kinds)])

    n = captures.sparkSession.sparkContext.defaultParallelism * 2
    return captures.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def archive(pages: DataFrame, folder: str | None = None, least: int = 1000, id_col: str = "page_id", url: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame, str]:
    """Write every page as a record: (captures, index shards, folder).

    A null html is an empty payload, a null url a record without target under the empty key, a null id an
    empty id (never a response that others refer to, if its payload has another page). Rows that share the
    largest id and the payload are all responses; repeated rows are records of their own; an empty table
    writes no file. Other columns are not read.
    """
    stages = Stages(pages.sparkSession, "warc")
    folder = folder or f"{stages.root}/archives"
    captures = stages.keep(write_archives(with_types(pages, least, id_col, url, html), folder), "captures")
    shards = stages.keep(write_index(captures, folder), "shards")
    return captures, shards, folder
