"""WARC archives of pages: one gzip member per record, written and read back sequentially.

Writing. Archives are rows (archive, data) of a table in the shared folder: each holds a warcinfo record and records up to
about ``roll`` bytes, and is complete in itself. So Spark's commit protocol covers them, a lost executor's work is simply
redone, and any store that Spark writes to will do. ``export`` puts them out as .warc.gz files.
A record whose payload equals that of a smaller page_id is a revisit of it: same headers, HTTP header only, no payload.

Reading. One pass over an archive: zlib decompresses piece by piece, a member ends where its trailer says, headers end at
the blank line, and Content-Length frames the block. SHA-1 digests of block and payload are verified as the bytes pass;
a record whose digest, framing or trailer is wrong raises.

Defined results: a null payload counts as empty; rows with a null page_id are responses unless a row with equal payload
has a page_id; all rows that bear a group's smallest page_id are responses; payloads of any length are one record; an empty
table gives no archive. A url is written without white space and control characters of ASCII, which a header can't hold,
and read back so; a null url is written as ``urn:none``, which reads back as null. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, spread

EMPTY_AS = ""
DATE = "1970-01-01T00:00:00Z"  # archives are reproducible: no clock is read


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("Content-Length", str(len(block)))]) + "\r\n"
    gz = zlib.compressobj(1, zlib.DEFLATED, 31)
    return gz.compress(head.encode() + block + b"\r\n\r\n") + gz.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    clean = "".join(c for c in (url or "urn:none") if c > " " and c != "\x7f") or "urn:none"
    headers = [("WARC-Type", "revisit" if refers_to is not None else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", clean), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload))]
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return member(headers, http + (b"" if refers_to is not None else payload))


def info_record(archive: str) -> bytes:
    return member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{archive}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"), ("WARC-Filename", archive)], b"format: WARC File Format 1.1\r\n")


class Reader:
    """Records of one archive in order: (headers, http headers, payload); feeds zlib ``step`` bytes at a time."""

    def __init__(self, data: bytes, step: int = 1 << 16):
        self.data, self.step = data, step

    def members(self) -> Iterator[Iterator[bytes]]:
        at, view = 0, memoryview(self.data)
        while at < len(view):
            gz, start = zlib.decompressobj(31), at

            def pieces(gz=gz) -> Iterator[bytes]:
                nonlocal at
                while not gz.eof:
                    if at >= len(view):
                        raise ValueError("the archive ends inside a gzip member")
                    part = view[at : at + self.step]
                    out = gz.decompress(part)
                    at += len(part) - len(gz.unused_data)
                    if out:
                        yield out

            source = pieces()
            yield source
            for _ in source:  # whatever the record's reader has left
                raise ValueError("bytes after the end of a record")
            if at == start:
                raise ValueError("an empty gzip member")

    def __iter__(self) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
        for source in self.members():
            yield self.record(source)

    @staticmethod
    def fields(lines: bytes) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode("utf-8").split("\r\n")[1:])}

    def record(self, source: Iterator[bytes]) -> tuple[dict[str, str], dict[str, str], bytes]:
        held = b""
        while b"\r\n\r\n" not in held:
            held += next(source, b"") or self.fail("no end of the record's headers")
        head, _, held = held.partition(b"\r\n\r\n")
        if not head.startswith(b"WARC/"):
            self.fail("not a WARC record")
        headers = self.fields(head)
        length, sha, parts, got = int(headers["content-length"]), hashlib.sha1(), [], 0
        while got < length:
            piece = held or next(source, b"") or self.fail("the block is shorter than its Content-Length")
            piece, held = piece[: length - got], piece[length - got :]
            sha.update(piece)
            parts.append(piece)
            got += len(piece)
        for piece in source:
            held += piece
        if held != b"\r\n\r\n":
            self.fail("no end of the record")
        block = b"".join(parts)
        if headers.get("warc-block-digest") != "sha1:" + base64.b32encode(sha.digest()).decode():
            self.fail("the block's digest differs")
        http: dict[str, str] = {}
        payload = block
        if headers.get("content-type", "").startswith("application/http"):
            first, _, payload = block.partition(b"\r\n\r\n")
            http = self.fields(first)
            if headers["warc-type"] == "response" and headers["warc-payload-digest"] != "sha1:" + base32_sha1(payload):
                self.fail("the payload's digest differs")
        return headers, http, payload

    @staticmethod
    def fail(why: str):
        raise ValueError(why)


def with_references(pages: DataFrame, scratch: Scratch, least: int = 0, few: int = 1_000_000) -> DataFrame:
    """Append refers_to: the smallest page_id with an equal payload, if that is another page and payloads of at least
    ``least`` bytes. Payloads are compared by SHA-1. Only groups of several pages are joined back: broadcast if they number
    at most ``few`` (28 bytes each), so that no html is shuffled, and else by a join that Spark splits where it is uneven."""
    digest = lambda df: F.unhex(F.sha1(F.coalesce(df["html"], F.lit(EMPTY_AS)).cast("binary")))
    pages = pages.drop("refers_to")
    sums = pages.where(F.octet_length(F.coalesce("html", F.lit(EMPTY_AS))) >= least).select(digest(pages).alias("_sha"), "page_id")
    group = scratch.save(sums.groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").select("_sha", "_first"))
    group = F.broadcast(group) if group.limit(few + 1).count() <= few else group
    return pages.withColumn("_sha", digest(pages)).join(group, "_sha", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))).drop("_sha", "_first")


def write(pages: DataFrame, scratch: Scratch, roll: int = 2 << 20) -> DataFrame:
    """(archive, data): archives of all rows of ``pages`` (page_id, url, html, refers_to)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        held: list[bytes] = []

        def close():
            nonlocal count
            name = f"pages-{part:06d}-{count:06d}.warc.gz"
            data = info_record(name) + b"".join(held)
            count += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], names=["archive", "data"])

        size = 0
        for batch in batches:
            ids, urls, bodies, refs = (batch.column(c) for c in range(4))
            for k in range(batch.num_rows):
                rec = page_record(ids[k].as_py(), urls[k].as_py(), (bodies[k].as_py() or EMPTY_AS).encode(), refs[k].as_py())
                held.append(rec)
                size += len(rec)
                if size >= roll:
                    yield close()
                    size = 0
        if held:
            yield close()

    return scratch.save(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.col("refers_to").cast("long").alias("refers_to")).mapInArrow(run, "archive string, data binary"))


def read(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record but the warcinfo: page_id, url, payload_bytes, payload_digest, record_type, refers_to, archive
    (and the payload, null for revisits)."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string" + ", payload binary" * payloads

    def number(urn: str | None) -> int | None:
        digits = urn[len("<urn:page:") : -1] if urn else ""
        return int(digits) if digits else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = []
                archive = batch.column(0)[k].as_py()
                for headers, http, payload in Reader(batch.column(1)[k].as_py()):
                    kind = headers["warc-type"]
                    if kind == "warcinfo":
                        continue
                    uri = headers["warc-target-uri"]
                    if kind == "response" and int(http["content-length"]) != len(payload):
                        Reader.fail("the payload's length differs")
                    rows.append((number(headers["warc-record-id"]), None if uri == "urn:none" else uri, int(http["content-length"]), headers["warc-payload-digest"].removeprefix("sha1:"), kind, number(headers.get("warc-refers-to")), archive, *((payload if kind == "response" else None,) if payloads else ())))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), *([pa.binary()] if payloads else [])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=[f.split()[0] for f in schema.split(", ")])

    return archives.mapInArrow(run, schema)


def archive_round_trip(pages: DataFrame, scratch: Scratch, least: int = 0) -> DataFrame:
    """Write every page, read every archive."""
    return read(write(with_references(spread(pages.select("page_id", "url", "html")), scratch, least), scratch))


def export(archives: DataFrame, folder: str) -> int:
    """Put the archives out as files under ``folder``, a path that every executor mounts; each appears whole or not at all."""
    import os

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                os.makedirs(folder, exist_ok=True)
                with open(f"{folder}/.{name}.{os.getpid()}", "wb") as f:
                    f.write(data)
                os.replace(f.name, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return archives.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
