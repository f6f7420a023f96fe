"""Operator 1: WARC archives with boundary-chain verification.

Writing: one gzip member per record; equal payloads of at least
``min_revisit_bytes`` are stored once (the record with the largest id is the
``response``, the others are ``revisit`` records that refer to it).

Reading: archives are cut into byte ranges. A task emits, for every offset in
its range that could start a record (gzip magic, or ``WARC/1.`` in a plain
archive), where the record that starts there would end: its successor.
Successors inside the range are followed at once (pointer jumping over a
numpy array), so each candidate is left with its first offset outside the range. Pointer
jumping over these exits, from offset 0 of each file, then finds the single
offset at which the true chain enters each range. Only records on that chain
are read: magic bytes inside a payload start a candidate but nothing points
at it from the file's start.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyvox.llm.common import shared_folder, staged

RANGE_BYTES = 4 << 20
ROLL_BYTES = 64 << 20
MAX_RANGE_TASKS = 20_000
_CHUNK = 1 << 16
_GZ = b"\x1f\x8b\x08"
_PLAIN = b"WARC/1."

RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, "
                 "payload_digest string, payload_bytes long, verified boolean, "
                 "file string, offset long")


# --- writing ---------------------------------------------------------------

def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Plan the records: ``page_id, url, payload, payload_bytes, sha1, refers_to``.

    Null html counts as an empty payload. A page without an id is always a
    response and is never referred to. Rows that repeat both id and payload
    of a response are responses too. Only (id, digest) pairs meet by digest;
    payloads travel only by page id, and only responses carry one.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    slim = p.drop("payload").filter("page_id is not null")
    big = F.col("payload_bytes") >= F.lit(min_revisit_bytes)
    kept = slim.filter(big).groupBy("sha1").agg(F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("n"))
    shared = kept.filter("n > 1").drop("n")
    revisits = (slim.filter(big).join(shared, "sha1").filter("page_id <> kept_id")
                .select("page_id", "url", F.lit(None).cast("binary").alias("payload"), "payload_bytes", "sha1",
                        F.col("kept_id").alias("refers_to")))
    full = ["page_id", "url", "payload", "payload_bytes", "sha1", F.lit(None).cast("long").alias("refers_to")]
    responses = p.join(kept.select(F.col("kept_id").alias("page_id"), "sha1"), ["page_id", "sha1"]).select(*full)
    small = p.filter("page_id is not null").filter(~big).select(*full)
    loose = p.filter("page_id is null").select(*full)
    out = revisits.unionByName(responses).unionByName(loose)
    return out.unionByName(small) if min_revisit_bytes > 0 else out


def _record(r: dict) -> bytes:
    pid = "" if pd.isna(r["page_id"]) else str(int(r["page_id"]))
    url = "" if r["url"] is None else re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", r["url"])
    digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {r['payload_bytes']}\r\n\r\n").encode()
    revisit = not pd.isna(r["refers_to"])
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{pid}>", f"WARC-Target-URI: {url}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{int(r['refers_to'])}>"]
    body = http if revisit else http + (r["payload"] or b"")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write_archives(recs: DataFrame, folder: str, compress: bool = True, level: int = 3,
                   roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write records as archives below ``folder``; returns ``file, bytes, records``.

    Every task writes under a name of its own attempt and only a finished
    file is named in the (staged) result, so a task that is lost and repeated
    leaves an unlisted file, never a half-read one.
    """
    suffix = "warc.gz" if compress else "warc"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, path, size, n = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    path, size, n = f"{root}/{uuid.uuid4().hex}.{suffix}", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                data = _record(r)
                data = _member(data, level) if compress else data
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= roll_bytes:
                    out.close()
                    done.append((path, size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, n))
        yield pa.RecordBatch.from_pydict({"file": pa.array([d[0] for d in done], pa.string()),
                                          "bytes": pa.array([d[1] for d in done], pa.int64()),
                                          "records": pa.array([d[2] for d in done], pa.int64())})

    return staged(recs.mapInArrow(write, "file string, bytes long, records long"), "warc-files")


# --- reading ---------------------------------------------------------------

class _Source:
    """Bounded reads of one archive."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.f = fs.open_input_file(path)
        self.size = self.f.size()

    def at(self, off: int, n: int) -> bytes:
        return self.f.read_at(max(0, min(n, self.size - off)), off) if off < self.size else b""

    def member(self, off: int) -> Iterator[bytes | int]:
        """Plain bytes of the gzip member at ``off`` piece by piece, then its end offset (-1: no member)."""
        d = zlib.decompressobj(31)
        pos = off
        try:
            while not d.eof:
                raw = self.at(pos, _CHUNK)
                if not raw:
                    yield -1
                    return
                pos += len(raw)
                out = d.decompress(raw, 1 << 20)
                yield out
                while d.unconsumed_tail and not d.eof:
                    yield d.decompress(d.unconsumed_tail, 1 << 20)
        except zlib.error:
            yield -1
            return
        yield pos - len(d.unused_data)


def _parse_head(block: bytes) -> dict[str, str] | None:
    """Header fields by lower-case name; None if this isn't a whole WARC header."""
    end = block.find(b"\r\n\r\n")
    if end < 0 or not block.startswith(_PLAIN):
        return None
    out = {"": str(end + 4)}
    for line in block[:end].split(b"\r\n")[1:]:
        k, _, v = line.decode("utf-8", "replace").partition(":")
        out[k.strip().lower()] = v.strip()
    return out if out.get("content-length", "").isdigit() else None


def _head_block(src: _Source, off: int) -> bytes:
    """Bytes at ``off`` up to a header's end at least, however long the header is; nothing if no record
    can start here. What is read doubles until it holds the end."""
    n = _CHUNK
    while True:
        block = src.at(off, n)
        if not block.startswith(_PLAIN):
            return b""
        if b"\r\n\r\n" in block or len(block) < n:
            return block
        n *= 2


def _successor(src: _Source, off: int, gz: bool) -> int:
    """Where the record that would start at ``off`` ends; -1 if none can start there."""
    if not gz:
        head = _parse_head(_head_block(src, off))
        nxt = off + int(head[""]) + int(head["content-length"]) + 4 if head else -1
        return nxt if nxt <= src.size else -1
    first = b""
    for piece in src.member(off):
        if isinstance(piece, int):
            return piece if first.startswith(_PLAIN) else -1
        if len(first) < len(_PLAIN):
            first += piece[:len(_PLAIN)]
            if len(first) >= len(_PLAIN) and not first.startswith(_PLAIN):
                return -1
    return -1


def _range_exits(src: _Source, start: int, end: int, gz: bool) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of a byte range and, by pointer jumping inside it, the first
    chain offset of each that lies outside (-1: the chain breaks)."""
    magic = _GZ if gz else _PLAIN
    data = src.at(start, end - start + len(magic) - 1)
    offs = np.array([start + m.start() for m in re.finditer(re.escape(magic), data) if start + m.start() < end],
                    dtype=np.int64)
    nxt = np.array([_successor(src, int(o), gz) for o in offs], dtype=np.int64)
    while len(offs):
        i = np.searchsorted(offs, nxt)
        inside = (nxt >= start) & (nxt < end)
        hit = inside & (i < len(offs)) & (offs[np.minimum(i, len(offs) - 1)] == nxt)
        nxt[inside & ~hit] = -1
        if not hit.any():
            break
        nxt[hit] = nxt[i[hit]]
    return offs, nxt


def ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, size, start, end`` for every byte range of every archive."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    return (files.filter("bytes > 0").select("file", F.col("bytes").alias("size"), starts.alias("start"))
            .withColumn("end", F.least(F.col("start") + range_bytes, "size")))


def _dealt(rows: DataFrame, files: DataFrame, range_bytes: int) -> DataFrame:
    """Rows of ranges dealt out: they are few and each is much work, so by a fixed number of
    partitions (about one range each), which isn't coalesced for being small."""
    total = files.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 0
    return rows.repartition(int(min(max(total, 1), MAX_RANGE_TASKS)), "file", "start")


def chain_entries(files: DataFrame, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, start, end, entry``: the offset where the chain from offset 0 first enters each range."""
    spark = files.sparkSession
    rng = ranges(files, range_bytes)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for r in b.to_pylist():
                offs, exits = _range_exits(_Source(fs, r["file"]), r["start"], r["end"], r["file"].endswith(".gz"))
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([r["file"]] * len(offs), pa.string()), "start": pa.array([r["start"]] * len(offs), pa.int64()),
                    "off": pa.array(offs, pa.int64()), "jump": pa.array(exits, pa.int64())})

    spread = _dealt(rng, files, range_bytes)
    cand = staged(spread.mapInArrow(emit, "file string, start long, off long, jump long"), "warc-candidates")
    # nodes that matter: offset 0 and offsets that some other range's chain exits to
    exits = cand.filter("jump >= 0").select("file", F.col("jump").alias("off")).distinct()
    zero = files.filter("bytes > 0").select("file", F.lit(0).cast("long").alias("off"))
    nodes = cand.join(exits.unionByName(zero).distinct(), ["file", "off"]).select("file", "off", "jump")
    reached = zero
    longest = files.agg(F.max("bytes")).first()[0] or 0
    rounds = max(1, int(np.ceil(np.log2(max(2, -(-longest // range_bytes) + 1)))))
    for _ in range(rounds):  # after k rounds: chain steps 0 .. 2^k - 1 are reached
        nodes = staged(nodes, "warc-jumps")
        step = reached.join(nodes, ["file", "off"]).filter("jump >= 0").select("file", F.col("jump").alias("off"))
        reached = reached.unionByName(step).distinct()
        ahead = nodes.select("file", F.col("off").alias("jump"), F.col("jump").alias("further"))
        nodes = (nodes.join(ahead, ["file", "jump"], "left")
                 .select("file", "off", F.coalesce("further", F.lit(-1).cast("long")).alias("jump")))
    per_range = (reached.withColumn("start", (F.floor(F.col("off") / range_bytes) * range_bytes).cast("long"))
                 .groupBy("file", "start").agg(F.min("off").alias("entry")))
    return staged(per_range.join(rng, ["file", "start"]).select("file", "start", "end", "entry"), "warc-entries")


def _read_record(src: _Source, off: int, gz: bool) -> tuple[dict | None, int]:
    """Fields of the record at ``off`` (payload hashed in pieces, never held whole) and its successor."""
    head: dict | None = None
    held, http, left, got, nxt = b"", None, 0, 0, -1
    sha = hashlib.sha1()

    def pieces() -> Iterator[bytes | int]:
        if gz:
            yield from src.member(off)
            return
        end = _successor(src, off, False)
        pos = off
        while end > pos:
            part = src.at(pos, min(_CHUNK, end - pos))
            pos += len(part)
            yield part
        yield end

    for p in pieces():
        if isinstance(p, int):
            nxt = p
            break
        held += p
        if head is None:
            head = _parse_head(held)
            if head is None:
                continue
            held, left = held[int(head[""]):], int(head["content-length"])
        if http is None:
            cut = held.find(b"\r\n\r\n", 0, left)
            if cut < 0:
                continue
            http, held, left = held[:cut], held[cut + 4:], left - cut - 4
        part = held[:left]
        sha.update(part)
        left, got, held = left - len(part), got + len(part), b""
    if head is None or nxt < 0:
        return None, -1
    ident = lambda k: (m := re.fullmatch(r"<urn:page:(-?\d+)>", head.get(k, ""))) and int(m[1])
    length = re.search(rb"(?i)content-length:\s*(\d+)", http or b"")
    kind = head.get("warc-type", "")
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    found = base64.b32encode(sha.digest()).decode()
    size = int(length[1]) if length else got
    return {"page_id": ident("warc-record-id"), "url": head.get("warc-target-uri") or None, "record_type": kind,
            "refers_to": ident("warc-refers-to"), "payload_digest": digest if kind == "revisit" else found,
            "payload_bytes": size if kind == "revisit" else got,
            "verified": None if kind == "revisit" else digest == found and size == got, "offset": off}, nxt


def read_archives(files: DataFrame, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record reachable from its archive's start (RECORD_SCHEMA).

    ``payload_bytes`` and ``payload_digest`` of a response are those of the bytes
    read back, and ``verified`` says whether the stored headers agree with them; a
    revisit's are from its HTTP header and WARC header (``verified`` is null).
    Bytes after a broken record can't be reached and are left out. Empty
    archives give no rows.
    """
    entries = chain_entries(files, folder, range_bytes)
    schema = "page_id long, url string, record_type string, refers_to long, payload_digest string, " \
             "payload_bytes long, verified boolean, file string, offset long"
    types = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
             "payload_digest": pa.string(), "payload_bytes": pa.int64(), "verified": pa.bool_(),
             "file": pa.string(), "offset": pa.int64()}
    arrow = pa.schema(list(types.items()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for r in b.to_pylist():
                src, off, rows = _Source(fs, r["file"]), r["entry"], []
                while 0 <= off < r["end"]:
                    row, off = _read_record(src, off, r["file"].endswith(".gz"))
                    if row:
                        rows.append({**row, "file": r["file"]})
                    if len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    return _dealt(entries, files, range_bytes).mapInArrow(walk, schema)


def roundtrip(spark: SparkSession, pages: DataFrame, min_revisit_bytes: int = 0, compress: bool = True,
              range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    folder = shared_folder(spark, "warc")
    files = write_archives(records(pages, min_revisit_bytes), folder, compress)
    return read_archives(files, folder, range_bytes)
