"""Legacy archives: ARC files of both versions, their conversion to WARC, and a reader of WARC records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import checked_broadcast, shared_path, stored

#: The field names of the two versions' record header lines.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
#: A header line by version. It is read from its end, as a URL or a content type may hold blanks.
HEADS = {1: re.compile(rb"(.+) (\S+) (\d{8,17}) (.*) (\d+)"), 2: re.compile(rb"(.+) (\S+) (\d{8,17}) (.*) (\S+) (\S+) (\S+) (\S+) (\S+) (\d+)")}
#: Bytes that a header line may have, payload bytes and rows of a batch, most payload groups that are broadcast.
LINE_BYTES, BATCH_BYTES, BATCH_ROWS, BROADCAST_GROUPS = 1 << 16, 8_000_000, 2000, 200_000
#: Fixed value: seconds of the first synthesised date, 2000-01-01.
FIRST_SECOND = 946_684_800
RECORD = "page_id long, url string, ip string, date string, mime string, http binary, payload binary, payload_digest string, payload_bytes long, version int, archive string, archive_date string, defect string"
COLUMNS = [c.split()[0] for c in RECORD.split(", ")]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _date(page_id: int | None) -> str:
    seconds = FIRST_SECOND + (page_id or 0) % (40 * 365 * 86_400)
    return pd.Timestamp(seconds, unit="s").strftime("%Y%m%d%H%M%S")


def arc_record(version: int, page_id: int | None, url: str | None, html: str | None, name: str) -> str:
    """A header line of the version, the declared length in bytes, and the HTTP response as it came."""
    body = html or ""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"X-Page-Id: {page_id}\r\n" if page_id is not None else "") + "\r\n"
    length = len(http.encode()) + len(body.encode())
    # a header line is split at blanks, so none may stand in a field
    place = "".join(f"%{b:02X}" if b <= 32 or b == 127 else chr(b) for b in url.encode()) if url and url.isascii() else "".join(
        chr(b) if 32 < b < 127 else f"%{b:02X}" for b in (url or "").encode())
    head = [place or "-", "0.0.0.0", _date(page_id), "text/html"]
    if version == 2:
        head += ["200", "-", "-", "0", name]
    return " ".join([*head, str(length)]) + "\n" + http + body


def arc_head(version: int, name: str) -> str:
    """The version block that begins a file."""
    block = f"{version} 0 plumbline\n{' '.join(FIELDS[version])}\n"
    extra = f" 200 - - 0 {name}" if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 20000101000000 text/plain{extra} {len(block)}\n{block}"


def opened(data: bytes) -> BinaryIO:
    """A file's bytes as a stream; compressed members are inflated as they are read."""
    return gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)


def _text(value: bytes) -> str:
    try:
        return value.decode("utf-8")
    except UnicodeDecodeError:
        return value.decode("latin-1")


def parse_arc(data: bytes, strict: bool = True) -> Iterator[dict]:
    """Records of an ARC file as written: fields by the names that the version block declares, content by the declared length.

    What is no record raises a ValueError. Without strict it comes as an item with a `defect` and the bytes as its content, and reading goes on
    at the next line that is a header line of the version.
    """
    stream, names, head, archive, lost, lost_at, at = opened(data), None, None, (None, None), bytearray(), 0, 0

    def defect(reason: str, where: int, content: bytes) -> dict:
        if strict:
            raise ValueError(f"{reason} at byte {where}")
        return {"defect": f"{reason} at byte {where}", "content": content, "archive": archive}

    while line := stream.readline(LINE_BYTES):
        start, at = at, at + len(line)
        if not line.strip():
            lost += line if lost else b""
            continue
        first = line.startswith(b"filedesc://") and line.rstrip(b"\r\n").rpartition(b" ")[2].isdigit()
        match = None if first or head is None else head.fullmatch(line.rstrip(b"\r\n"))
        if not first and not match:
            lost_at = lost_at if lost else start
            lost += line
            if strict or len(lost) > BATCH_BYTES:
                yield defect("no header line", lost_at, bytes(lost))
                lost.clear()
            continue
        if lost:
            yield defect("no header line", lost_at, bytes(lost))
            lost.clear()
        values = line.split() if first else match.groups()
        length = int(values[-1])
        content = stream.read(length)
        at += len(content)
        if len(content) != length:
            yield defect(f"{len(content)} of {length} bytes of a record", start, line + content)
        elif first:
            lines = content.decode("utf-8", "replace").splitlines()
            version = int(lines[0].split(" ")[0]) if lines and lines[0][:1].isdigit() else 0
            names = FIELDS.get(version)
            head = HEADS.get(version)
            archive = _text(values[0]).removeprefix("filedesc://"), _text(values[2])
            if names is None or len(lines) < 2 or lines[1].split(" ") != names:
                names = head = None
                yield defect("fields that are not those of a version", start, line + content)
        else:
            yield dict(zip(names, map(_text, values))) | {"version": version, "content": content, "archive": archive, "defect": None}
    if lost:
        yield defect("no header line", lost_at, bytes(lost))


def _split_http(content: bytes) -> tuple[bytes, bytes]:
    if content.startswith(b"HTTP/"):
        head, mark, body = content.partition(b"\r\n\r\n")
        if mark:
            return head + mark, body
    return b"", content


def _header(http: bytes, name: bytes) -> str | None:
    for line in http.split(b"\r\n"):
        k, _, v = line.partition(b":")
        if k.strip().lower() == name:
            return v.strip().decode("latin-1")
    return None


def arc_rows(data: bytes, strict: bool = True) -> Iterator[dict]:
    for r in parse_arc(data, strict):
        name, date = r["archive"]
        if r["defect"] is not None:
            yield dict.fromkeys(COLUMNS) | {"payload": r["content"], "archive": name, "archive_date": date, "defect": r["defect"]}
            continue
        http, payload = _split_http(r["content"])
        page = _header(http, b"x-page-id")
        yield {"page_id": int(page) if page is not None and page.isdecimal() or page and page[1:].isdecimal() and page[0] == "-" else None,
               "url": r["URL"], "ip": r["IP-address"], "date": r["Archive-date"], "mime": r["Content-type"],
               "http": http, "payload": payload, "payload_digest": digest(payload), "payload_bytes": len(payload), "version": r["version"],
               "archive": name, "archive_date": date, "defect": None}


def _warc_date(d: str) -> str:
    d = d.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _urn(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5('/'.join(map(str, parts)).encode()).digest(), version=3)}>"


def _warc(head: list[str], block: bytes, kind: str) -> bytes:
    lines = ["WARC/1.1", *head, "WARC-Block-Digest: sha1:" + digest(block), f"Content-Type: {kind}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def warcinfo_record(archive: str, date: str, part: int) -> tuple[str, bytes]:
    """(identifier, record) that tells from which archive the records that name it come."""
    me = _urn("warcinfo", archive, part)
    block = f"software: plumbline\r\nformat: WARC File Format 1.1\r\nisPartOf: {archive}\r\n".encode()
    return me, _warc(["WARC-Type: warcinfo", f"WARC-Record-ID: {me}", f"WARC-Date: {_warc_date(date)}"], block, "application/warc-fields")


def warc_record(r, info: str | None = None) -> bytes:
    """A WARC/1.1 record of an ARC record: identifier, timestamp, type and digest follow from what the ARC record holds. Content with an
    HTTP head is a response, other content a resource of its own type. A revisit keeps the HTTP head alone and names the record that
    has the payload by identifier, URL and date."""
    body = bytes(r["http"])
    kind = "application/http; msgtype=response" if body else r["mime"] or "application/octet-stream"
    head = [f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: {_urn(r['page_id'], r['date'], r['url'])}",
            f"WARC-Date: {_warc_date(r['date'])}", f"WARC-Target-URI: {r['url']}", f"WARC-IP-Address: {r['ip']}",
            f"WARC-Payload-Digest: sha1:{r['payload_digest']}", f"X-Payload-Length: {r['payload_bytes']}"]
    if info:
        head.append(f"WARC-Warcinfo-ID: {info}")
    if r["page_id"] is not None:
        head.append(f"X-Page-Id: {r['page_id']}")
    if r["record_type"] == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(r['refers_to'], r['first_date'], r['first_url'])}",
                 f"WARC-Refers-To-Target-URI: {r['first_url']}", f"WARC-Refers-To-Date: {_warc_date(r['first_date'])}"]
        if r["refers_to"] is not None:
            head.append(f"X-Refers-To-Page: {r['refers_to']}")
    else:
        body += bytes(r["payload"])
    return _warc(head, body, kind)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of the records of a WARC file, by declared lengths."""
    stream = opened(data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("no record where one has to begin")
        head = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8").partition(":")
            head[k.strip().lower()] = v.strip()
        length = int(head["content-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {head.get('warc-record-id')} is cut")
        yield head, block


def _contents(df) -> Iterator[bytes]:
    return (bytes(c) for pdf in df for c in pdf["content"] if len(c))


def read_binary(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def write_arc(pages: DataFrame, path: str) -> None:
    """One compressed ARC file for each partition, of version 1 or 2 in turn; a null html is empty."""

    def records(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name, first = 1 + part % 2, f"part-{part:05d}.arc", True
        for pdf in batches:
            out = [arc_record(version, None if pd.isna(i) else int(i), u, h, name) for i, u, h in zip(pdf["page_id"], pdf["url"], pdf["html"])]
            if first and out:
                out[:0] = [arc_head(version, name)]
                first = False
            yield pd.DataFrame({"value": out})

    plain = pages.select("page_id", "url", "html")
    plain.mapInPandas(records, "value string").write.option("lineSep", "\n").option("compression", "gzip").text(path)


def read_arc(spark, path: str, strict: bool = True) -> DataFrame:
    """Records of all ARC files below a folder. A file is inflated and parsed as a stream by one task, in batches of bounded bytes. What
    is no record ends the job, or without strict comes as a row with its `defect` and bytes."""

    def rows(batches):
        for data in _contents(batches):
            got, held = [], 0
            for r in arc_rows(data, strict):
                got.append(r)
                held += len(r["payload"])
                if held >= BATCH_BYTES or len(got) >= BATCH_ROWS:
                    yield _frame(got)
                    got, held = [], 0
            if got:
                yield _frame(got)

    return read_binary(spark, path).mapInPandas(rows, RECORD)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=COLUMNS).astype({"page_id": "Int64", "payload_bytes": "Int64", "version": "Int64"})


def deduplicated(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """record_type, refers_to, first_url and first_date: of records with equal payloads of at least least_bytes, the one with the smallest
    page_id (null last, then by date and URL) stays and the others revisit it. Digests are counted with map-side sums; only groups of
    several records are joined back."""
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "date", "url")
    groups = stored(records.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
                    .agg(F.min(key).alias("f"), F.count("*").alias("n")).where("n > 1").drop("n"), "payloads")
    joined = records.join(checked_broadcast(groups, BROADCAST_GROUPS), ["payload_digest", "payload_bytes"], "left")
    other = F.when(F.col("f.none"), (F.col("date") != F.col("f.date")) | (F.col("url") != F.col("f.url"))).otherwise(~F.col("page_id").eqNullSafe(F.col("f.page_id")))
    again = F.col("f").isNotNull() & other
    kind = F.when(again, "revisit").when(F.length("http") > 0, "response").otherwise("resource")
    told = {"record_type": kind, "refers_to": F.when(again, F.col("f.page_id")), "first_url": F.when(again, F.col("f.url")), "first_date": F.when(again, F.col("f.date"))}
    return joined.withColumns(told).drop("f")


def write_warc(records: DataFrame, path: str) -> None:
    """Compressed WARC files, one for each partition, with a warcinfo record before the first record of each archive; the line separator of
    the writer ends a record. Bytes pass the text writer as they are, so blocks of any encoding keep theirs."""

    def lines(batches):
        from pyspark import TaskContext

        part, infos = TaskContext.get().partitionId(), {}
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                for c in ("page_id", "refers_to"):
                    r[c] = None if pd.isna(r[c]) else int(r[c])
                archive = r["archive"]
                if archive is not None and archive not in infos:
                    infos[archive], record = warcinfo_record(archive, r["archive_date"], part)
                    out.append(record)
                out.append(warc_record(r, infos.get(archive)))
            yield pd.DataFrame({"value": out})

    records.mapInPandas(lines, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def read_warc(spark, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, date, url, refers_to_id) of all records below a folder but
    warcinfo. The length and digest of a response or resource are taken from its block and must be those declared."""
    columns = {"page_id": "long", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long", "record_id": "string",
               "date": "string", "url": "string", "refers_to_id": "string"}

    def rows(batches):
        for data in _contents(batches):
            out = []
            for head, block in parse_warc(data):
                kind = head["warc-type"]
                if kind == "warcinfo":
                    continue
                size, sha = int(head["x-payload-length"]), head["warc-payload-digest"].removeprefix("sha1:")
                if kind != "revisit":
                    payload = _split_http(block)[1] if head["content-type"].startswith("application/http") else block
                    if (len(payload), digest(payload)) != (size, sha):
                        raise ValueError(f"payload of {head['warc-record-id']} is not the declared one")
                page, first = head.get("x-page-id"), head.get("x-refers-to-page")
                out.append((page and int(page), size, sha, kind, first and int(first), head["warc-record-id"], head["warc-date"], head["warc-target-uri"], head.get("warc-refers-to")))
                if len(out) >= BATCH_ROWS:
                    yield pd.DataFrame(out, columns=list(columns)).astype({"page_id": "Int64", "refers_to": "Int64"})
                    out = []
            if out:
                yield pd.DataFrame(out, columns=list(columns)).astype({"page_id": "Int64", "refers_to": "Int64"})

    return read_binary(spark, path).mapInPandas(rows, ", ".join(f"{c} {t}" for c, t in columns.items()))


def convert(spark, arc: str, warc: str, least_bytes: int = 0, strict: bool = True) -> DataFrame:
    """Converts all ARC files below a folder to WARC files in another and gives the stretches that are no records (archive, defect, payload):
    none with strict, which ends the job at the first."""
    records = read_arc(spark, arc, strict)
    write_warc(deduplicated(records.where(F.col("defect").isNull()), least_bytes), warc)
    return records.where(F.col("defect").isNotNull()).select("archive", "defect", "payload")


def converted(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages written as ARC files, converted to WARC files, and read back from those: one row per page.

    A null html is an empty payload, a null url stands as '-', a null page_id stays null and is never the first of a group that
    has an id (in a group of null ids alone the smallest date and URL is the first, and refers_to stays null). Rows that repeat a
    page_id with the same payload are revisits only of a smaller id, so they stay responses beside each other. An empty table gives no rows.
    """
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc, least_bytes)
    return read_warc(spark, warc)
