"""WARC archives: writing, normalising a monolithic gzip, and reading back by offset.

``write`` makes one archive per task, all its records in a single gzip stream, a warcinfo
record first. ``normalise`` inflates such a stream once, front to back in bounded pieces,
rewrites every record as a gzip member of its own and writes a sidecar index (offset and
length of each member) beside the new archive. ``sidecars`` lists what these index files
hold, and ``read`` seeks to the listed members and inflates each alone; how many tasks read
does not depend on how many archives there are.

Records have a type, id, date, target and payload digest; a revisit names the record id,
target and date of its response. A response's record id follows from its page id and
payload, so that its revisits can be written anywhere.

Files live in the cluster's shared folder and are opened through Arrow's file systems. A
task attempt writes under a name of its own and reports it in its result row, and results
are staged, so a retried or lost attempt leaves at most an unused file behind. The
monolithic archives go when the normalised ones are staged.

Of records with equal payloads of at least ``least`` bytes the one with the largest id holds
the payload, the others are revisits that name it. Defined cases: a null or empty payload is
a response of 0 bytes; a null url has no target header; control characters in a url are
escaped; repeated ids with equal payloads are responses if theirs is the largest id (rows
equal in id and payload are one record id); null
ids are never referred to (a group of null ids only is all responses); an empty table gives
no rows; very large records pass through memory one at a time; extra columns are ignored.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import discard, remove, staged
from tripstream.session import work_path

LEAST = 1000
SIDECAR = ".cdxj"
ROWS = 10_000
LEVEL = 1
PIECE = 1 << 20
INDEX = "archive string, offset bigint, length bigint, record_id string, page_id bigint, record_type string"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to string"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str):
    """(file system, path) of a uri or a local path."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def record_id(page_id, digest: bytes) -> str:
    """The id of the response that holds a payload; null pages, which nobody refers to, get a random one."""
    name = uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest.hex()}")
    return f"<urn:uuid:{name}>"


def _target(url: str) -> str:
    return "".join(quote(c) if c < " " or c == "\x7f" else c for c in url)


def _framed(lines: list[str], block: bytes) -> bytes:
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"]).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def info(date: str) -> bytes:
    """The record that an archive starts with."""
    return _framed(["WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}", "Content-Type: application/warc-fields"],
                   b"software: tripstream\r\nformat: WARC File Format 1.1\r\n")


def record(kind: str, page_id, url: str | None, payload: bytes, refers_to=None, refers_url: str | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record; a revisit has the HTTP head alone and names its response."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    digest = hashlib.sha1(payload).digest()
    own = record_id(page_id, digest) if kind == "response" else f"<urn:uuid:{uuid.uuid4()}>"
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + _target(url))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Date: {date}"]
        if refers_url is not None:
            lines.append("WARC-Refers-To-Target-URI: " + _target(refers_url))
    lines += ["WARC-Payload-Digest: sha1:" + base64.b32encode(digest).decode(), "Content-Type: application/http; msgtype=response"]
    return _framed(lines, head + payload if kind == "response" else head)


def inflated(stream) -> Iterator[bytes]:
    """Pieces of a gzip stream, of one member or several."""
    d = zlib.decompressobj(31)
    while data := stream.read(PIECE):
        while data:
            if d.eof:
                d = zlib.decompressobj(31)
            if out := d.decompress(data, PIECE):
                yield out
            data = d.unused_data if d.eof else d.unconsumed_tail
    if out := d.flush():
        yield out
    if not d.eof:
        raise EOFError("the gzip stream ends inside a member")


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, whole record) of each record of a stream."""
    buffer = bytearray()

    def more(n: int) -> bool:
        while len(buffer) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while more(1):
        end = buffer.find(b"\r\n\r\n")
        while end < 0:
            if not more(len(buffer) + 1):
                raise EOFError("the archive ends inside a header")
            end = buffer.find(b"\r\n\r\n")
        headers = _headers(bytes(buffer[:end]))
        size = end + 4 + int(headers["content-length"]) + 4
        if not more(size):
            raise EOFError("the archive ends inside a record")
        yield headers, bytes(buffer[:size])
        del buffer[:size]


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if t == "string" else pa.int64()) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def write(pages: DataFrame, folder: str, date: str) -> DataFrame:
    """``pages`` (page_id, url, html, and of a revisit's response refers_to, refers_url) as archives; one row per archive: path, n."""

    def run(batches):
        name, out, sink, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, None, 0
        for batch in batches:
            for page_id, url, html, refers, target in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fs, path = _open(name)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    sink, out = fs.open_output_stream(path, compression=None), zlib.compressobj(LEVEL, wbits=31)
                    sink.write(out.compress(info(date)))
                payload = (html or "").encode("utf-8", "surrogatepass")
                sink.write(out.compress(record("response" if refers is None else "revisit", page_id, url, payload, refers, target, date)))
                n += 1
        if out is not None:
            sink.write(out.flush())
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "n": [n]})

    return pages.select("page_id", "url", "html", "refers_to", "refers_url").mapInArrow(run, "path string, n bigint")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive (column ``path``) record by record, with its sidecar; one row per new archive: path, n."""

    def run(batches):
        names = [c.split()[0] for c in INDEX.split(", ")][1:]
        for batch in batches:
            for source in batch.column("path").to_pylist():
                name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                fs, path = _open(name)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                n = at = 0
                with (fs.open_input_stream(_open(source)[1], compression=None) as stream, fs.open_output_stream(path, compression=None) as sink,
                      fs.open_output_stream(f"{path}{SIDECAR}", compression=None) as side):
                    for headers, whole in records(inflated(stream)):
                        out = zlib.compressobj(LEVEL, wbits=31)
                        member = out.compress(whole) + out.flush()
                        sink.write(member)
                        page = headers.get("x-page-id")
                        row = (at, len(member), headers["warc-record-id"], None if page is None else int(page), headers["warc-type"])
                        side.write((json.dumps(dict(zip(names, row))) + "\n").encode())
                        at += len(member)
                        n += 1
                yield pa.RecordBatch.from_pydict({"path": [name], "n": [n]})

    return archives.select("path").mapInArrow(run, "path string, n bigint")


def sidecars(archives: DataFrame) -> DataFrame:
    """The members that the archives' index files list."""

    def run(batches):
        for batch in batches:
            for name in batch.column("path").to_pylist():
                fs, path = _open(name)
                rows = []
                with io.TextIOWrapper(fs.open_input_stream(f"{path}{SIDECAR}", compression=None), "utf-8") as lines:
                    for line in lines:
                        rows.append((name, *json.loads(line).values()))
                        if len(rows) == ROWS:
                            yield _batch(rows, INDEX)
                            rows = []
                if rows:
                    yield _batch(rows, INDEX)

    return archives.select("path").mapInArrow(run, INDEX)


def read(index: DataFrame) -> DataFrame:
    """Each indexed page inflated alone: page_id, payload size and digest, type, and the record id that a revisit names."""

    def run(batches):
        files = {}
        try:
            for batch in batches:
                rows = []
                for name, at, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                    if name not in files:
                        for f in files.values():
                            f.close()
                        fs, path = _open(name)
                        files = {name: fs.open_input_file(path)}
                    files[name].seek(at)
                    whole = zlib.decompress(files[name].read(length), 31)
                    end = whole.index(b"\r\n\r\n")
                    headers = _headers(whole[:end])
                    block = whole[end + 4 : end + 4 + int(headers["content-length"])]
                    head, _, payload = block.partition(b"\r\n\r\n")
                    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
                    kind, refers = headers["warc-type"], headers.get("warc-refers-to")
                    if kind == "response" and hashlib.sha1(payload).digest() != digest:
                        raise ValueError(f"{name} at {at}: the payload does not have its digest")
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    page = headers.get("x-page-id")
                    rows.append((None if page is None else int(page), size, digest.hex(), kind, refers))
                yield _batch(rows, RECORD)
        finally:
            for f in files.values():
                f.close()

    return index.where("record_type <> 'warcinfo'").mapInArrow(run, RECORD)


def roles(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``pages`` (page_id, url, html) with refers_to and refers_url: id and url of the page that holds the same payload, else null.

    Only payloads of ``least`` bytes are compared, so the many empty pages meet nowhere.
    """
    none = [F.lit(None).cast("bigint").alias("refers_to"), F.lit(None).cast("string").alias("refers_url")]
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    small = pages.where(size < least).select("page_id", "url", "html", *none)
    large = pages.where(size >= least).withColumn("_d", F.sha1("html"))
    holders = large.groupBy("_d").agg(F.max(F.struct("page_id", "url")).alias("_m"), F.count("*").alias("_n")).where("_n > 1 AND _m.page_id IS NOT NULL")
    joined = large.join(staged(holders, "warc-holders"), "_d", "left")
    other = F.col("_m").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_m.page_id"))
    named = joined.select("page_id", "url", "html", F.when(other, F.col("_m.page_id")).alias("refers_to"), F.when(other, F.col("_m.url")).alias("refers_url"))
    return small.unionByName(named)


def archive(pages: DataFrame, *, least: int = LEAST) -> DataFrame:
    """Index, as the sidecars list it, of the normalised archives that ``pages`` were written to."""
    folder, date = work_path(pages.sparkSession, "warc"), dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    monoliths = staged(write(roles(rows, least), f"{folder}/monoliths", date), "warc-monoliths")
    # one task per archive, dealt by range: as many tasks as archives, none with two while another has none
    archives = staged(normalise(monoliths.repartitionByRange(max(1, monoliths.count()), "path"), f"{folder}/members"), "warc-archives")
    remove(pages.sparkSession, f"{folder}/monoliths")
    discard(monoliths)
    return staged(sidecars(archives), "warc-index")


def report(pages: DataFrame, **options) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as read back."""
    index = archive(pages, **options)
    # neighbouring members of an archive go to one task, however large or few the archives are
    found = staged(read(index.repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset")), "warc-read")
    names = index.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("_page")).distinct()
    plain, revisits = found.where("refers_to IS NULL"), found.where("refers_to IS NOT NULL")
    named = revisits.join(names, "refers_to").withColumn("refers_to", F.col("_page")).drop("_page")
    return plain.withColumn("refers_to", F.lit(None).cast("bigint")).unionByName(named)
