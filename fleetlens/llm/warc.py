"""Web archives in ZIP packages: written from a table of pages, and read by ranges.

A package holds `archive/data.warc.gz`, stored as it is, in which every record is a gzip member
of its own, and `indexes/index.cdxj` with the place of each record. The reader fetches the end of
the file, follows the end-of-directory record (and its ZIP64 form) to the central directory,
locates the stored members, reads the index, and then fetches records by byte range. Nothing is
extracted; packages are reached through the file system that their URI names.

Of records with equal payloads of `least_bytes` or more, the one with the smallest page id is the
response and the others are revisits, which keep the HTTP header but not the payload. Null html
is an empty payload. A page without an id can be a revisit but is never referred to. Rows that
share id and payload are all responses if any is.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import fresh_path, stored

LEAST_BYTES = 100
#: A task begins another package beyond this many bytes of records.
PACKAGE_BYTES = 64_000_000
RANGE_BYTES = 4_000_000
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


# --- records ------------------------------------------------------------------------------


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {_DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    pairs = (line.split(b":", 1) for line in data.split(b"\r\n")[1:] if b":" in line)
    return {k.decode().lower(): v.strip().decode("utf-8", "replace") for k, v in pairs}


def parse(data: bytes) -> dict:
    """A record's fields; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")

    def page(name: str) -> int | None:
        text = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    return {
        "page_id": page("warc-record-id"), "url": fields["warc-target-uri"], "record_type": kind,
        "payload": payload if kind == "response" else None, "payload_digest": digest,
        "payload_bytes": int(_headers(http)["content-length"]) if kind == "revisit" else len(payload),
        "refers_to": page("warc-refers-to"),
    }


# --- ZIP directories ----------------------------------------------------------------------


def _range(file, at: int, size: int) -> bytes:
    file.seek(at)
    return file.read(size)


def directory(file, size: int) -> list[dict]:
    """The central directory: name, method, stored size, and place of each member's header."""
    tail_at = max(0, size - 65_557)
    tail = _range(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no ZIP directory")
    count, length, at = struct.unpack("<HII", tail[end + 10 : end + 20])
    locator = end - 20
    if locator >= 0 and tail[locator : locator + 4] == b"PK\x06\x07":
        (place,) = struct.unpack("<Q", tail[locator + 8 : locator + 16])
        wide = _range(file, place, 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 directory where its locator points")
        count, length, at = struct.unpack("<QQQ", wide[32:56])
    data, members, place = _range(file, at, length), [], 0
    for _ in range(count):
        if data[place : place + 4] != b"PK\x01\x02":
            raise ValueError("broken ZIP directory")
        (method,) = struct.unpack("<H", data[place + 10 : place + 12])
        packed, full = struct.unpack("<II", data[place + 20 : place + 28])
        name, extra, comment = struct.unpack("<HHH", data[place + 28 : place + 34])
        (header,) = struct.unpack("<I", data[place + 42 : place + 46])
        fields = data[place + 46 + name : place + 46 + name + extra]
        while len(fields) >= 4:
            kind, width = struct.unpack("<HH", fields[:4])
            if kind == 1:
                # the 64-bit values, in this order, of those that do not fit above
                wide = list(struct.unpack(f"<{width // 8}Q", fields[4 : 4 + width // 8 * 8]))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                header = wide.pop(0) if header == 0xFFFFFFFF else header
            fields = fields[4 + width :]
        members.append({"name": data[place + 46 : place + 46 + name].decode(), "method": method, "size": packed, "header": header})
        place += 46 + name + extra + comment
    return members


def data_place(file, member: dict) -> int:
    """Where a stored member's bytes begin: after its local header."""
    if member["method"] != 0:
        raise ValueError(f"{member['name']} is compressed, ranges of it cannot be read")
    head = _range(file, member["header"], 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header for {member['name']}")
    return member["header"] + 30 + sum(struct.unpack("<HH", head[26:30]))


def _members_of(file, at: int, size: int) -> Iterator[tuple[int, int]]:
    """(place, length) of each gzip member in a range, for packages without an index."""
    done, unread, decoder, begin = 0, b"", zlib.decompressobj(31), 0
    while done < size or unread:
        if not unread:
            unread = _range(file, at + done, min(RANGE_BYTES, size - done))
            done += len(unread)
        decoder.decompress(unread)
        if decoder.eof:
            unread = decoder.unused_data
            place = done - len(unread)
            yield at + begin, place - begin
            begin, decoder = place, zlib.decompressobj(31)
        else:
            unread = b""
    if begin < size:
        raise ValueError("the archive ends inside a record")


def locate(uri: str) -> Iterator[tuple[int, int]]:
    """(place, length) of each record of a package."""
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as file:
        members = {m["name"]: m for m in directory(file, file.size())}
        archives = [n for n in members if n.startswith("archive/") and n.endswith(".warc.gz")]
        begins = {n.rsplit("/", 1)[1]: data_place(file, members[n]) for n in archives}
        if INDEX not in members:
            for n in archives:
                yield from _members_of(file, begins[n.rsplit("/", 1)[1]], members[n]["size"])
            return
        at, left, rest = data_place(file, members[INDEX]), members[INDEX]["size"], b""
        while left:
            read = _range(file, at, min(RANGE_BYTES, left))
            at, left = at + len(read), left - len(read)
            *lines, rest = (rest + read).split(b"\n")
            for line in lines:
                entry = json.loads(line[line.index(b"{") :])
                yield begins[entry["filename"]] + int(entry["offset"]), int(entry["length"])


# --- Spark --------------------------------------------------------------------------------


def _write(folder: str, package_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        task, written, rows = TaskContext.get(), 0, (
            row for batch in batches for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")))
        )
        row = next(rows, None)
        while row is not None:
            # the attempt's number keeps a repeated task from touching another's package
            name = f"package-{task.partitionId():05d}-{task.taskAttemptId()}-{written}.wacz"
            written += 1
            index, place = [], 0
            with system.open_output_stream(f"{root}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                with package.open(MEMBER, "w", force_zip64=True) as member:
                    while row is not None and place < package_bytes:
                        page, url, payload, digest, refers = (v.as_py() for v in row)
                        data = gzip.compress(record(page, url, payload, digest, refers), 1, mtime=0)
                        member.write(data)
                        index.append(f"{page} {json.dumps({'filename': 'data.warc.gz', 'offset': place, 'length': len(data)})}\n")
                        place += len(data)
                        row = next(rows, None)
                package.writestr(INDEX, "".join(index))
                package.writestr("datapackage.json", json.dumps({"profile": "data-package", "resources": [MEMBER, INDEX]}))
            yield pa.RecordBatch.from_pylist(
                [{"path": f"{folder}/{name}", "records": len(index)}], pa.schema([("path", pa.string()), ("records", pa.int64())])
            )

    return run


def write_archives(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = LEAST_BYTES, package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Writes packages to `folder` and returns one row for each: path, records.

    First pages of repeated payloads come from a minimum per digest, combined before the shuffle.
    The list of packages is stored, so reading them never writes them again.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "archives")
    payload = F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    first = (
        rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1 and first is not null")
    )
    named = rows.join(stored(first.select("digest", "first"), "archive-first"), "digest", "left")
    refers = F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first"))
    ready = named.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))
    return stored(ready.mapInArrow(_write(folder, package_bytes), "path string, records long"), "archive-packages")


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            found = list(locate(path))
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(found), pa.string()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())],
                names=["path", "place", "length"],
            )


_RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
])
_RECORD_SQL = (
    "page_id long, url string, record_type string, payload binary, payload_digest string, payload_bytes long, refers_to long"
)


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, held, begin = None, None, b"", 0
        for batch in batches:
            places = batch.column("place").to_pylist()
            sizes = batch.column("length").to_pylist()
            out, size = [], 0
            for i, uri in enumerate(batch.column("path").to_pylist()):
                if uri != path:
                    if file is not None:
                        file.close()
                    system, name = fs.FileSystem.from_uri(uri)
                    path, file, held, begin = uri, system.open_input_file(name), b"", 0
                at, length = places[i], sizes[i]
                if not begin <= at or at + length > begin + len(held):
                    begin, held = at, _range(file, at, max(length, RANGE_BYTES))
                fields = parse(gzip.decompress(held[at - begin : at - begin + length]))
                size += len(fields["payload"] or b"")
                out.append(fields if with_payload else fields | {"payload": None})
                if size > RANGE_BYTES * 4:
                    yield pa.RecordBatch.from_pylist(out, _RECORD)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, _RECORD)
        if file is not None:
            file.close()

    return run


def read_records(packages: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the packages in the column `path`, whoever wrote them.

    Places are dealt out by package and stretch of 16 MB, so one large package is read by many tasks.
    """
    places = packages.select("path").mapInArrow(_locate, "path string, place long, length long")
    stretch = F.shiftright("place", 24)
    dealt = places.repartition("path", stretch).sortWithinPartitions("path", "place")
    return dealt.mapInArrow(_read(with_payload), _RECORD_SQL)


def digest(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return read_records(write_archives(pages), with_payload=False)


def sql(least_bytes: int = LEAST_BYTES) -> str:
    return f"""
    with p as (
      select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
    f as (select *, min(page_id) over (partition by payload_digest) as first from p)
    select page_id, payload_bytes, payload_digest,
           case when payload_bytes >= {least_bytes} and page_id <> first then 'revisit' else 'response' end as record_type,
           case when payload_bytes >= {least_bytes} and page_id <> first then first end as refers_to
    from f
    """
