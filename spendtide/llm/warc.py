"""WARC archives: written whole, then normalised to one gzip member per record.

A crawler's archive is often one gzip stream over all records, of which no record can be
read alone. The normaliser inflates such a stream once, in pieces, rewrites every record
as a gzip member of its own and writes a sidecar with each member's offset and length
beside the archive. Records named as repeats become revisits on the way: their headers
stay, their payload goes. Reading back seeks to the members that the sidecar lists.

Archives are files of bounded size in a folder that all executors share, opened through
``pyarrow.fs`` by the folder's scheme. Each attempt of a task writes files under names of
its own; only those that a finished task reports in its rows are read later, so a lost
executor or a repeated task leaves unused files, never wrong ones.

Among equal payloads the smallest id is the response and the others revisit it. Groups
with more than a ``HEAVY``-th of all records, fewer than ``HEAVY`` in number, are
broadcast; the rest is joined by the digest.

Defined results: a null payload counts as empty; a null id comes after every other, and is
left out of the record's headers, as a null address is; control characters of an address
are escaped; of records that share the smallest id one is the response; an empty table gives no archive and no row; extra columns are
never read. An archive that ends inside its stream or a record is an error.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote
from uuid import NAMESPACE_URL, uuid4, uuid5

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendtide.plans.materialize import materialize, new_path

#: Bytes and records after which an archive is closed, before compression.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 32 << 20, 20_000
HEAVY = 1000
_PIECE = 1 << 20
#: The table has no time of capture; the field is mandatory.
CAPTURED = "1970-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CONTROL = re.compile(r"[\x00-\x1f\x7f]")

Headers = dict[str, str]


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """The folder's file system and its path there."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def payload_digest(payload: bytes) -> str:
    """SHA-1 in base 32, as in the header but for its prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(archive: str, n: int) -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, f'{archive}/{n}')}>"


def _lines(first: str, headers: Headers) -> bytes:
    return "".join([first, "\r\n", *[f"{k}: {v}\r\n" for k, v in headers.items()], "\r\n"]).encode()


def response(archive: str, n: int, key: str | None, url: str | None, payload: bytes) -> bytes:
    """A response record; its block is an HTTP head and the payload."""
    http = _lines("HTTP/1.1 200 OK", {
        "Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload)),
    })
    headers = {
        "WARC-Type": "response", "WARC-Record-ID": record_id(archive, n), "WARC-Date": CAPTURED,
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Content-Type": "application/http;msgtype=response",
    }
    if url is not None:
        headers["WARC-Target-URI"] = _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", url)
    if key is not None:
        headers["Page-ID"] = quote(key)
    headers["Content-Length"] = str(len(http) + len(payload))
    return _lines("WARC/1.1", headers) + http + payload + b"\r\n\r\n"


def revisit(headers: Headers, block: bytes, refers_to: str, page: str | None) -> tuple[Headers, bytes]:
    """The record as a revisit of another one: the HTTP head is all that stays."""
    head = block[: block.index(b"\r\n\r\n") + 4]
    headers = headers | {"WARC-Type": "revisit", "WARC-Profile": _REVISIT, "WARC-Refers-To": refers_to}
    if page is not None:
        headers["Refers-To-Page-ID"] = quote(page)
    return headers | {"Content-Length": str(len(head))}, head


class Whole:
    """An archive as one gzip stream."""

    def __init__(self, folder: str) -> None:
        system, path = store(folder)
        self.name, self.records, self._bytes = f"{uuid4().hex}.warc.gz", 0, 0
        self._out = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self._gzip = zlib.compressobj(wbits=31)

    @property
    def full(self) -> bool:
        return self._bytes >= ARCHIVE_BYTES or self.records >= ARCHIVE_RECORDS

    def add(self, record: bytes) -> None:
        self._out.write(self._gzip.compress(record))
        self.records, self._bytes = self.records + 1, self._bytes + len(record)

    def close(self) -> None:
        self._out.write(self._gzip.flush())
        self._out.close()


def write_whole(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Archives under ``folder`` with a response for every row; (archive, n, id, digest,
    bytes) of the records. The rows must be stored before anything else reads them."""
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.col(payload_col).cast("string").alias("payload"),
    )
    kind = dict(rows.dtypes)["id"]
    rows = rows.withColumn("key", F.col("id").cast("string"))
    _create(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            places: list[tuple] = []
            columns = (batch.column(c) for c in ("key", "url", "payload"))
            keys, urls, payloads = (c.cast(pa.binary()) if k == 2 else c for k, c in enumerate(columns))
            for k in range(batch.num_rows):
                payload = payloads[k].as_py() or b""
                out = out or Whole(folder)
                places.append((out.name, out.records, payload_digest(payload), len(payload)))
                out.add(response(out.name, out.records, keys[k].as_py(), urls[k].as_py(), payload))
                if out.full:
                    out.close()
                    out = None
            archive, n, digest, size = (list(c) for c in zip(*places)) if places else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(archive, pa.string()), pa.array(n, pa.int64()), batch.column("id"),
                 pa.array(digest, pa.string()), pa.array(size, pa.int64())],
                ["archive", "n", "id", "digest", "bytes"],
            )
        if out is not None:
            out.close()

    return rows.mapInArrow(run, f"archive string, n long, id {kind}, digest string, bytes long")


def _create(folder: str) -> None:
    system, path = store(folder)
    system.create_dir(path, recursive=True)


def repeats(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(archive, n, first) of the stored ``records`` that repeat a payload of at least
    ``least_bytes`` bytes; ``first`` is the response's (no_id, id, archive, n)."""
    wanted = records.where(F.col("bytes") >= least_bytes)
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "archive", "n")
    groups = wanted.groupBy("digest").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("size"))
    groups = materialize(groups.where("size > 1"), "repeated-payloads")
    limit = wanted.count() // HEAVY
    heavy = groups.where(F.col("size") > limit).drop("size")
    light = groups.where(F.col("size") <= limit).drop("size")
    rest = wanted.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    found = wanted.join(F.broadcast(heavy), "digest").unionByName(rest.join(light, "digest"))
    own = (F.col("archive") == F.col("first.archive")) & (F.col("n") == F.col("first.n"))
    return found.where(~own).select("archive", "n", "first")


class _Inflated:
    """Bytes of an inflated archive, read piece by piece."""

    def __init__(self, file: pa.NativeFile) -> None:
        self._file, self._held, self._gzip, self._packed = file, b"", zlib.decompressobj(31), b""
        self._inside = False

    def _more(self) -> bool:
        """Inflate another piece; False at the end of the file."""
        while True:
            if self._gzip.eof:
                self._packed, self._gzip, self._inside = self._gzip.unused_data, zlib.decompressobj(31), False
            packed = self._packed or self._file.read(_PIECE)
            if not packed:
                if self._inside:
                    raise ValueError("the archive ends inside its gzip stream")
                return False
            self._inside = True
            piece = self._gzip.decompress(packed, _PIECE)
            self._packed = self._gzip.unconsumed_tail
            if piece:
                self._held += piece
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Everything up to the next ``mark``, which is passed; None at the end."""
        seen = 0
        while (at := self._held.find(mark, seen)) < 0:
            seen = max(0, len(self._held) - len(mark) + 1)
            if not self._more():
                if self._held.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        found, self._held = self._held[:at], self._held[at + len(mark) :]
        return found

    def exactly(self, size: int) -> bytes:
        pieces, have = [self._held], len(self._held)
        while have < size:
            self._held = b""
            if not self._more():
                raise ValueError("the archive ends inside a record")
            pieces.append(self._held)
            have += len(self._held)
        whole = b"".join(pieces)
        self._held = whole[size:]
        return whole[:size]


def parse(file: pa.NativeFile) -> Iterator[tuple[str, Headers, bytes]]:
    """Version line, headers and block of every record of an archive, in whatever members
    it is compressed."""
    data = _Inflated(file)
    while (head := data.until(b"\r\n\r\n")) is not None:
        version, *lines = head.lstrip(b"\r\n").decode().split("\r\n")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        block = data.exactly(int(headers["Content-Length"]))
        data.exactly(4)
        yield version, headers, block


def normalise_archive(
    source: str, archive: str, target: str, refers: dict[int, tuple[str, str | None]]
) -> list[dict]:
    """Rewrite one archive; the index entries, which also stand in its sidecar.

    ``refers`` names the records that become revisits: what they refer to, and its page.
    """
    system, folder = store(source)
    out_system, out_folder = store(target)
    entries, offset = [], 0
    with (
        system.open_input_stream(f"{folder}/{archive}", compression=None) as file,
        out_system.open_output_stream(f"{out_folder}/{archive}", compression=None) as out,
    ):
        for n, (version, headers, block) in enumerate(parse(file)):
            if n in refers:
                headers, block = revisit(headers, block, *refers[n])
            gzip = zlib.compressobj(wbits=31)
            member = gzip.compress(_lines(version, headers) + block + b"\r\n\r\n") + gzip.flush()
            out.write(member)
            entries.append({
                "n": n, "record_id": headers["WARC-Record-ID"], "type": headers["WARC-Type"],
                "offset": offset, "length": len(member),
            })
            offset += len(member)
    with out_system.open_output_stream(f"{out_folder}/{sidecar(archive)}", compression=None) as out:
        out.write("".join(json.dumps(e) + "\n" for e in entries).encode())
    return entries


def sidecar(archive: str) -> str:
    return archive.removesuffix(".gz") + ".index.jsonl"


def normalise(
    records: DataFrame, source: str, target: str, repeated: DataFrame | None = None
) -> DataFrame:
    """Rewrite all archives that the stored ``records`` (archive, n) name; the index
    (archive, n, record_id, type, offset, length) of the new ones, to be stored.

    An archive's repeats are listed in one row; an archive has ``ARCHIVE_RECORDS`` at most.
    """
    archives = records.select("archive").distinct()
    if repeated is None:
        lists = archives.select("archive", F.array().cast("array<struct<n:long,archive:string,first:long,page:string>>").alias("refers"))
    else:
        refer = F.struct(
            "n", F.col("first.archive").alias("archive"), F.col("first.n").alias("first"),
            F.col("first.id").cast("string").alias("page"),
        )
        found = repeated.groupBy("archive").agg(F.collect_list(refer).alias("refers"))
        lists = archives.join(found, "archive", "left")
    lists = materialize(lists, "archives")
    _create(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                archive = new_name = batch.column("archive")[k].as_py()
                refers = {
                    r["n"]: (record_id(r["archive"], r["first"]), r["page"])
                    for r in batch.column("refers")[k].as_py() or []
                }
                entries = normalise_archive(source, archive, target, refers)
                made = {"archive": [new_name] * len(entries)}
                made |= {c: [e[c] for e in entries] for c in ("n", "record_id", "type", "offset", "length")}
                yield pa.RecordBatch.from_pydict(made, _INDEX)

    # A task per archive, as an archive is bounded; a number keeps tiny rows from one task.
    spread = lists.repartition(max(1, lists.count()), "archive")
    return spread.mapInArrow(run, "archive string, n long, record_id string, type string, offset long, length long")


_INDEX = pa.schema([
    ("archive", pa.string()), ("n", pa.int64()), ("record_id", pa.string()), ("type", pa.string()),
    ("offset", pa.int64()), ("length", pa.int64()),
])
_READ = pa.schema([
    ("archive", pa.string()), ("n", pa.int64()), ("record_id", pa.string()), ("type", pa.string()),
    ("url", pa.string()), ("page", pa.string()), ("refers_to", pa.string()), ("refers_page", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def _plain(value: str | None) -> str | None:
    return None if value is None else unquote(value)


def read_archive(folder: str, archive: str, payloads: bool = True) -> Iterator[dict]:
    """The records of a normalised archive, each by its offset in the sidecar.

    A revisit has the length and digest that its headers state; a response's are taken
    from its payload, and must be those of its headers.
    """
    system, path = store(folder)
    with system.open_input_stream(f"{path}/{sidecar(archive)}", compression=None) as file:
        entries = [json.loads(line) for line in file.read().splitlines()]
    with system.open_input_file(f"{path}/{archive}") as file:
        for entry in entries:
            file.seek(entry["offset"])
            member = pa.BufferReader(file.read(entry["length"]))
            ((_, headers, block),) = parse(member)
            head, _, payload = block.partition(b"\r\n\r\n")
            size = int(head.lower().split(b"content-length:")[1].split(b"\r\n")[0])
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if headers["WARC-Type"] == "response":
                if (len(payload), payload_digest(payload)) != (size, digest):
                    raise ValueError(f"{archive}: record {entry['n']} is not what its headers state")
            yield {
                "archive": archive, "n": entry["n"], "record_id": headers["WARC-Record-ID"],
                "type": headers["WARC-Type"], "url": headers.get("WARC-Target-URI"),
                "page": _plain(headers.get("Page-ID")), "refers_to": headers.get("WARC-Refers-To"),
                "refers_page": _plain(headers.get("Refers-To-Page-ID")), "payload_bytes": size,
                "payload_digest": digest, "payload": payload if payloads else None,
            }


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives that the stored ``index`` names, read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                rows, held = [], 0
                for row in read_archive(folder, archive, payloads):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if held >= _PIECE or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)

    archives = index.select("archive").distinct()
    schema = (
        "archive string, n long, record_id string, type string, url string, page string,"
        " refers_to string, refers_page string, payload_bytes long, payload_digest string, payload binary"
    )
    return archives.repartition(max(1, archives.count()), "archive").mapInArrow(run, schema)


def archive_pages(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
    payload_col: str = "html", least_bytes: int = 0,
) -> DataFrame:
    """Write the rows as archives under ``folder`` (by default in the work folder), let
    repeats become revisits and read all records back: one row per row of ``pages`` with
    its id, payload_bytes, payload_digest, record_type and refers_to."""
    folder = folder or new_path(pages.sparkSession, "warc")
    kind = dict(pages.select(F.col(id_col).alias("id")).dtypes)["id"]
    whole, single = f"{folder}/whole", f"{folder}/records"
    records = materialize(write_whole(pages, whole, id_col, url_col, payload_col), "warc-records")
    index = materialize(normalise(records, whole, single, repeats(records, least_bytes)), "warc-index")
    return read_records(index, single, payloads=False).select(
        F.col("page").cast(kind).alias(id_col), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers_page").cast(kind).alias("refers_to"),
    )
