"""Legacy archive converter: ARC 1 and 2 files become WARC files with equivalent identifiers, timestamps, types, digests.

An ARC file starts with a version block whose body names the fields of the header lines that follow; a record is one such
line and as many bytes as its last field declares. Version 1 lines have 5 fields, version 2 lines 10. A record's body is
an HTTP response. The converter gives each a WARC-Record-ID (a name-based UUID of archive and record number), a
WARC-Date from the 14-digit ARC date, a WARC-Type, and SHA-256 block and payload digests. Of records with equal payloads
of at least MIN_REVISIT bytes the one with the smallest source id stays a response; the others become revisits that refer
to it and keep the HTTP header, whose Content-Length tells the size of the payload left out. Records of one id and payload
after the first are revisits of it. Each ARC and WARC record is a gzip member of its own.

Files are cut by records and by bytes, and read and written as streams: a task holds one record at a time. A version 2
checksum of 32 hex digits is checked as the payload's MD5; another result code than the HTTP status line's is kept beside it.
Rows without an id, repeated rows and very long pages are pages like others.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zlib
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, materialize, new_file, new_path, slices

# The field lines of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
MIN_REVISIT = 100
ID_HEADER = b"X-Source-Id"


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class Unpacked:
    """The contents of a stream of gzip members, read in small steps: readline() and read(n), nothing held but a step."""

    def __init__(self, source, step: int = 1 << 16):
        self.source, self.step, self.member = source, step, zlib.decompressobj(31)
        self.packed, self.data, self.at, self.begun = b"", b"", 0, False

    def _more(self) -> bool:
        """Decompress a step; False at the end of the stream."""
        while True:
            if not self.packed:
                self.packed = self.source.read(self.step)
                if not self.packed:
                    if self.begun:
                        raise EOFError("the last gzip member is cut off")
                    return False
            self.begun = True
            got = self.member.decompress(self.packed, self.step)
            if self.member.eof:
                self.packed, self.member, self.begun = self.member.unused_data, zlib.decompressobj(31), False
            else:
                self.packed = self.member.unconsumed_tail
            if got:
                self.data, self.at = self.data[self.at :] + got, 0
                return True

    def readline(self) -> bytes:
        """Up to and with the next line feed, or to the end."""
        start = self.at
        while (end := self.data.find(b"\n", start)) < 0:
            start = len(self.data) - self.at
            if not self._more():
                end = len(self.data) - 1
                break
        line, self.at = self.data[self.at : end + 1], end + 1
        return line

    def read(self, n: int) -> bytes:
        parts, held = [self.data[self.at : self.at + n]], min(n, len(self.data) - self.at)
        self.at += held
        while held < n and self._more():
            parts.append(self.data[: n - held])
            self.at = len(parts[-1])
            held += self.at
        return b"".join(parts)


@contextmanager
def unpacked(uri: str):
    system, path = filesystem(uri)
    with system.open_input_stream(path, compression=None) as source:
        yield Unpacked(source)


def arc_version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 threadloom\n{ARC_FIELDS[version]}\n\n".encode()
    values = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"] + (["200", "-", "-", "0", name] if version == 2 else [])
    return " ".join([*values, str(len(body))]).encode() + b"\n" + body


def arc_record(url: str | None, date: str, source_id: int | None, payload: bytes, version: int, name: str, offset: int) -> bytes:
    named = b"" if source_id is None else ID_HEADER + b": %d\r\n" % source_id
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n%s\r\n" % (len(payload), named) + payload
    values = [quote(url, safe=":/?#[]@!$&'()*+,;=%~-._") if url else "-", "0.0.0.0", date, "text/html"]
    if version == 2:
        values += ["200", hashlib.md5(payload).hexdigest(), "-", str(offset), name]
    return " ".join([*values, str(len(body))]).encode() + b"\n" + body + b"\n"


def parse_arc(data):
    """(fields by name, body) of each record after the version block, by the header form that the version block declares.

    data: bytes, or a stream with readline and read."""
    data = io.BytesIO(data) if isinstance(data, bytes) else data

    def body_of(size: int) -> bytes:
        body = data.read(size)
        if len(body) < size:
            raise ValueError("an ARC record is shorter than it declares")
        return body

    head = data.readline().decode("latin-1")
    if not head.startswith("filedesc://"):
        raise ValueError("not an ARC file of version 1 or 2")
    body = body_of(int(head.rsplit(" ", 1)[1])).decode("latin-1").split("\n")
    if int(body[0].split(" ")[0]) not in ARC_FIELDS:
        raise ValueError("not an ARC file of version 1 or 2")
    names = body[1].split(" ")
    while head := data.readline():
        if head == b"\n":  # the line feed after a record
            continue
        values = head.rstrip(b"\n").decode("latin-1").split(" ")
        if len(values) != len(names):
            raise ValueError(f"an ARC header line of {len(values)} fields; the version block declares {len(names)}")
        fields = dict(zip(names, values, strict=True))
        yield fields, body_of(int(fields["Archive-length"]))


def http_parts(body: bytes) -> tuple[bytes, bytes, dict[bytes, bytes]]:
    head, _, payload = body.partition(b"\r\n\r\n")
    fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:] if b": " in x)
    return head + b"\r\n\r\n", payload, fields


def _text(n: bytes | None) -> int | None:
    return None if n is None else int(n)


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def record_id(archive: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{number}')}>"


def parse_warc(data):
    """(type, fields, block) of each record of a stream with readline and read."""
    while data.readline():  # the version line
        fields = {}
        while (line := data.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        yield fields["WARC-Type"], fields, data.read(int(fields["Content-Length"]))
        data.read(4)


def write_arc(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "20240101000000", records: int = 2000, most_bytes: int = 64_000_000) -> DataFrame:
    """Archive files of up to `records` pages and about `most_bytes` of html (one page at least), version 1 and 2 in turn;
    returns their paths. A null html is empty, a null url '-'. All pages get the one given date."""
    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        for b in slices(batches, records, "html", most_bytes):
            version, name = 1 + k % 2, f"pages-{part:06d}-{k:05d}.arc.gz"
            with new_file(f"{out}/{name}") as file:
                member = _member(arc_version_block(name, version, date))
                offset = file.write(member)
                for i in range(b.num_rows):
                    source, url, html = (b.column(c)[i].as_py() for c in ("id", "url", "html"))
                    member = _member(arc_record(url, date, source, html or b"", version, name, offset))
                    offset += file.write(member)
            k += 1
            yield pa.RecordBatch.from_pydict({"arc": [f"{out}/{name}"]})

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("binary").alias("html"))
    return materialize(rows.mapInArrow(run, "arc string"), "arc-files")


def spread(paths: DataFrame, name: str, most: int = 20_000) -> DataFrame:
    """Rows of file paths, a partition for each file or few: their bytes say nothing of the work, so the number is given."""
    return paths.repartition(max(1, min(most, paths.count())), name)


INDEX = "arc string, number int, source_id long, payload_bytes long, payload_digest binary"


def arc_index(arcs: DataFrame) -> DataFrame:
    """(arc, number, source_id, payload_bytes, payload_digest) of each record of the ARC files named in arcs(arc)."""
    def run(batches):
        for b in batches:
            for arc in b.column("arc").to_pylist():
                rows = []
                with unpacked(arc) as data:
                    for number, (fields, body) in enumerate(parse_arc(data)):
                        _, payload, http = http_parts(body)
                        check_payload(fields, payload)
                        rows.append((arc, number, _text(http.get(ID_HEADER)), len(payload), hashlib.sha256(payload).digest()))
                if rows:
                    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["arc", "number", "source_id", "payload_bytes", "payload_digest"])

    return arcs.mapInArrow(run, INDEX)


def plan_revisits(index: DataFrame) -> DataFrame:
    """(arc, number, refers: the record that a revisit refers to). Only narrow rows move; large groups meet as one minimum."""
    first = F.min(F.struct(F.col("source_id").isNull().alias("none"), "source_id", "arc", "number")).alias("first")
    long = index.filter(F.col("payload_bytes") >= MIN_REVISIT)
    groups = long.groupBy("payload_digest").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1").select("payload_digest", "first")
    again = long.join(groups, "payload_digest")
    again = again.filter((F.col("arc") != F.col("first.arc")) | (F.col("number") != F.col("first.number")))
    return again.select("arc", "number", F.struct("first.source_id", "first.arc", "first.number").alias("refers"))


def check_payload(fields: dict[str, str], payload: bytes) -> None:
    declared = fields.get("Checksum", "-")
    if re.fullmatch("[0-9a-f]{32}", declared) and hashlib.md5(payload).hexdigest() != declared:
        raise ValueError("an ARC payload differs from its declared checksum")


def converted(name: str, number: int, fields: dict[str, str], body: bytes, to) -> bytes:
    """The WARC record of an ARC record; to: what a revisit refers to, or None."""
    head, payload, _ = http_parts(body)
    d = fields["Archive-date"]
    known = [("WARC-Record-ID", record_id(name, number)), ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z")]
    if fields["URL"] != "-":
        known.append(("WARC-Target-URI", fields["URL"]))
    if fields["IP-address"] != "0.0.0.0":
        known.append(("WARC-IP-Address", fields["IP-address"]))
    code = fields.get("Result-code", "-")
    if code != "-" and head.split(b" ", 2)[1:2] != [code.encode()]:
        known.append(("X-Archive-Result-Code", code))
    block = body
    if to:
        block = head
        known += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(to["arc"].rpartition("/")[2], to["number"]))]
        if to["source_id"] is not None:
            known.append(("X-Refers-To-Source-Id", str(to["source_id"])))
    known += [("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest()), ("Content-Type", "application/http; msgtype=response")]
    return warc_record("revisit" if to else "response", known, block)


def convert(arcs: DataFrame, out: str) -> DataFrame:
    """Write one WARC file for each ARC file of arcs(arc) and return the paths. Revisits of a file are bounded by its records."""
    index = materialize(arc_index(spread(arcs, "arc")), "arc-index")
    revisits = plan_revisits(index).groupBy("arc").agg(F.collect_list(F.struct("number", "refers")).alias("revisits"))

    def run(batches):
        for b in batches:
            paths = []
            for arc, revisits in zip(b.column("arc").to_pylist(), b.column("revisits").to_pylist(), strict=True):
                refers = {r["number"]: r["refers"] for r in revisits or []}
                name = arc.rpartition("/")[2]
                paths.append(f"{out}/{name.removesuffix('.arc.gz')}.warc.gz")
                with new_file(paths[-1]) as file, unpacked(arc) as data:
                    info = [("WARC-Record-ID", record_id(name, -1)), ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")]
                    file.write(_member(warc_record("warcinfo", info, b"software: threadloom\r\nformat: WARC File Format 1.1\r\n")))
                    for number, (fields, body) in enumerate(parse_arc(data)):
                        file.write(_member(converted(name, number, fields, body, refers.get(number))))
            yield pa.RecordBatch.from_pydict({"warc": paths})

    jobs = arcs.join(revisits, "arc", "left")
    return materialize(spread(jobs, "arc").mapInArrow(run, "warc string"), "warc-files")


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string"


def read_warc(warcs: DataFrame) -> DataFrame:
    """The response and revisit records of the WARC files named in warcs(warc). Digests of blocks at hand are checked."""
    def run(batches):
        for b in batches:
            for path in b.column("warc").to_pylist():
                rows = []
                with unpacked(path) as data:
                    for kind, fields, block in parse_warc(data):
                        if kind not in ("response", "revisit"):
                            continue
                        _, payload, http = http_parts(block)
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{path}: a payload differs from its digest")
                        size = len(payload) if kind == "response" else int(http[b"Content-Length"])
                        to = fields.get("X-Refers-To-Source-Id")
                        rows.append((_text(http.get(ID_HEADER)), fields.get("WARC-Target-URI"), size, digest, kind, None if to is None else int(to), fields["WARC-Record-ID"]))
                if rows:
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in RECORDS.split(", ")])

    return spread(warcs, "warc").mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, **columns) -> DataFrame:
    """Pages to ARC files, those to WARC files, and the records read back from these."""
    spark = pages.sparkSession
    arcs = write_arc(pages, new_path(spark, "arc"), **columns)
    return read_warc(convert(arcs, new_path(spark, "warc")))
