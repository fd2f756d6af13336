"""WARC archives of pages and a two-level capture index.

``write_archives`` writes one gzip member per record (``response``, or ``revisit`` for a payload of at least
``MIN_DEDUP_BYTES`` bytes that a smaller page id already holds) and returns the captures: where each record
lies. ``build_index`` sorts the captures by their key (host labels reversed, then path and query) and page id,
compresses runs of ``BLOCK_LINES`` lines into blocks, and ends every index file with its sparse directory: the
first key and place of each block. ``lookup`` finds the files by the first key of each (one row per file),
binary-searches the file's directory, and then reads only the blocks and records that are asked for.

Files lie below a folder that all executors reach and are opened through ``pyarrow.fs``. A task writes files
under names of its own and reports them in its rows; a retried task writes new files, and only those named
in the stored captures are ever read. Repeats are found on stored (page id, digest) rows; payloads are shuffled
once, by page id and digest, and those below ``MIN_DEDUP_BYTES`` not at all by content. The index moves keys only.

Defined results: a null html is an empty payload, a null url an empty key; equal page ids are one capture per
row; an empty table gives an empty index; columns other than id, url and html are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from formline.session import scratch_path, store

MIN_DEDUP_BYTES = 100
BLOCK_LINES = 500
FILE_BYTES = 64_000_000
DATE = "2024-01-01T00:00:00Z"
CAPTURE = "_row bigint, key string, page_id bigint, file string, offset bigint, size bigint"
RECORD = "page_id bigint, record_type string, url string, payload_bytes bigint, payload_digest string, refers_to bigint"


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def url_key(url: str | None) -> str:
    """Host labels reversed and comma separated, then path and query: ``com,example)/a?b``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url.strip().lower()
    place = (parts.path or "/") + ("?" + parts.query if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + place


def dedup_plan(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages with digest and the page they refer to.

    The smallest id per digest is combined before the shuffle and joined to ids and digests only, so a payload that very
    many pages share moves as short rows. Payloads meet the revisits (unique by id and digest) on the page id.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    large = store(
        rows.where(F.col("page_id").isNotNull() & (F.length("payload") >= MIN_DEDUP_BYTES)).select(
            F.col("page_id").alias("_page"), F.unhex("digest").alias("_digest")
        ),
        "digests",
    )
    first = large.groupBy(F.col("_digest").alias("_same")).agg(F.min("_page").alias("_first"))
    revisits = (
        large.join(first, (F.col("_digest") == F.col("_same")) & (F.col("_first") < F.col("_page")))
        .select("_page", "_digest", F.col("_first").alias("refers_to"))
        .distinct()
    )
    return rows.join(
        revisits, (F.col("page_id") == F.col("_page")) & (F.unhex("digest") == F.col("_digest")), "left"
    ).select("page_id", "url", "payload", "digest", "refers_to")


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record with an HTTP response inside; a revisit has the response's head only."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{url}')}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", json.dumps(url or "")[1:-1]),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To-Page-ID", str(refers_to)),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    lines = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return lines.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and the payload behind the HTTP head."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


class _Rolled:
    """Files of at most about FILE_BYTES below ``root``, with names no other attempt uses."""

    def __init__(self, root: str, ending: str):
        self.fs, self.root = _files(root)
        self.fs.create_dir(self.root, recursive=True)
        self.ending, self.out, self.at = ending, None, 0
        self.name = None

    def add(self, data: bytes) -> tuple[str, int]:
        if self.out is None:
            self.name, self.at = f"{uuid.uuid4().hex}.{self.ending}", 0
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
        place = self.name, self.at
        self.out.write(data)
        self.at += len(data)
        if self.at >= FILE_BYTES:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_archives(
    pages: DataFrame, root: str, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Writes ``*.warc.gz`` below ``root``; the stored captures, one row per row of ``pages``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, count = _Rolled(root, "warc.gz"), 0
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = batch.slice(low, 256).to_pylist()
                out = []
                for r in rows:
                    raw = record_bytes(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"])
                    member = gzip.compress(raw, 6, mtime=0)
                    name, at = files.add(member)
                    out.append((count, url_key(r["url"]), r["page_id"], name, at, len(member)))
                    count += 1
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("_row", "key", "page_id", "file", "offset", "size"), o)) for o in out],
                    pa.schema(
                        [("_row", pa.int64()), ("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("size", pa.int64())]
                    ),
                )
        files.close()

    plan = dedup_plan(pages, page_id, url, html).withColumn("page_id", F.col("page_id").cast("long"))
    return store(plan.mapInArrow(write, CAPTURE).drop("_row"), "captures")


def build_index(captures: DataFrame, root: str) -> DataFrame:
    """Writes index files below ``root``; the stored top level: first key and page id, name and place of each file's directory."""
    order = ["key", "page_id", "file", "offset"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import chain, islice

        rows = chain.from_iterable(b.to_pylist() for b in batches)
        files, place, directory, first = None, 0, [], None
        while block := list(islice(rows, BLOCK_LINES)):
            if files is None:
                fs, base = _files(root)
                fs.create_dir(base, recursive=True)
                name = f"{uuid.uuid4().hex}.idx"
                files = fs.open_output_stream(f"{base}/{name}", compression=None)
            lines = "".join(json.dumps([r[c] for c in ("key", "page_id", "file", "offset", "size")]) + "\n" for r in block)
            data = gzip.compress(lines.encode(), 6, mtime=0)
            files.write(data)
            head = [block[0]["key"], block[0]["page_id"]]
            first = first or head
            directory.append([*head, place, len(data)])
            place += len(data)
        if files is None:
            return
        data = gzip.compress(json.dumps(directory).encode(), 6, mtime=0)
        files.write(data)
        files.close()
        yield pa.RecordBatch.from_pylist(
            [{"first_key": first[0], "first_page": first[1], "name": name, "at": place, "size": len(data)}],
            pa.schema([("first_key", pa.string()), ("first_page", pa.int64()), ("name", pa.string()), ("at", pa.int64()), ("size", pa.int64())]),
        )

    sorted_rows = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    top = sorted_rows.mapInArrow(write, "first_key string, first_page bigint, name string, at bigint, size bigint")
    return store(top, "index-files")


def _ordered(key: str, page) -> tuple:
    return key, page is not None, page or 0  # nulls first, as in the sort


def lookup(queries: DataFrame, top: DataFrame, index_root: str, url: str = "url", page_id: str | None = None) -> DataFrame:
    """The captures (``key, page_id, file, offset, size``) of each asked url, or of each asked url and page.

    The top level has one row per index file, so its size follows the number of sort tasks, not the pages.
    Blocks that several queries need are read once per task.
    """
    files = sorted(
        ((_ordered(r["first_key"], r["first_page"]), r["name"], r["at"], r["size"]) for r in top.collect()),
        key=lambda f: f[0],
    )
    firsts = [f[0] for f in files]
    schema = "key string, page bigint, exact boolean, name string, at bigint, size bigint"

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _files(index_root)
        held: dict[int, list] = {}

        def directory(k: int) -> list:
            if k not in held:
                if len(held) >= 4:
                    held.pop(next(iter(held)))
                with fs.open_input_file(f"{base}/{files[k][1]}") as f:
                    held[k] = json.loads(gzip.decompress(f.read_at(files[k][3], files[k][2])))
            return held[k]

        for pdf in batches:
            out = []
            pages = pdf["page"] if page_id else [None] * len(pdf)
            for link, page in zip(pdf["url"], pages):
                key, page = url_key(link), None if pd.isna(page) else int(page)
                low = _ordered(key, page) if page_id else (key, False, 0)
                high = low if page_id else (key, True, 2**63)
                k = max(bisect.bisect_left(firsts, low) - 1, 0)
                while k < len(files) and firsts[k] <= high:
                    heads = directory(k)
                    begins = [_ordered(h[0], h[1]) for h in heads]
                    b = max(bisect.bisect_left(begins, low) - 1, 0)
                    while b < len(heads) and begins[b] <= high:
                        out.append((key, page, bool(page_id), files[k][1], heads[b][2], heads[b][3]))
                        b += 1
                    k += 1
            yield pd.DataFrame(out, columns=["key", "page", "exact", "name", "at", "size"]).astype({"page": "Int64"})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _files(index_root)
        last, lines = None, {}
        for pdf in batches:
            out = []
            for key, page, exact, name, at, size in pdf.itertuples(index=False):
                if last != (name, at):
                    with fs.open_input_file(f"{base}/{name}") as f:
                        text = gzip.decompress(f.read_at(size, at)).decode()
                    last, lines = (name, at), {}
                    for entry in map(json.loads, text.splitlines()):
                        lines.setdefault(entry[0], []).append(entry)
                asked = None if pd.isna(page) else int(page)
                out += [e for e in lines.get(key, []) if not exact or e[1] == asked]
            yield pd.DataFrame(out, columns=["key", "page_id", "file", "offset", "size"]).astype({"page_id": "Int64"})

    asked = queries.select(F.col(url).alias("url"), *([F.col(page_id).cast("long").alias("page")] if page_id else []))
    found = asked.mapInPandas(blocks, schema).distinct()
    dealt = found.repartitionByRange("name", "at", "key", "page").sortWithinPartitions("name", "at", "key", "page")
    return dealt.mapInPandas(read, "key string, page_id bigint, file string, offset bigint, size bigint")


def read_records(captures: DataFrame, root: str) -> DataFrame:
    """Each capture's record, read by its place: type, url, payload, its digest, and the page a revisit refers to."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _files(root)
        name, source = None, None
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(low, 256).to_pylist():
                    if r["file"] != name:
                        if source is not None:
                            source.close()
                        name, source = r["file"], fs.open_input_file(f"{base}/{r['file']}")
                    fields, payload = parse_record(gzip.decompress(source.read_at(r["size"], r["offset"])))
                    revisit = fields["WARC-Type"] == "revisit"
                    page = fields["WARC-Page-ID"]
                    out.append(
                        {
                            "page_id": int(page) if page else None,
                            "record_type": fields["WARC-Type"],
                            "url": json.loads(f'"{fields["WARC-Target-URI"]}"'),
                            "payload": None if revisit else payload,
                            "payload_digest": fields["WARC-Payload-Digest"].split(":")[1] if revisit else hashlib.sha256(payload).hexdigest(),
                            "refers_to": int(fields["WARC-Refers-To-Page-ID"]) if revisit else None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema)
        if source is not None:
            source.close()

    schema = pa.schema(
        [("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    )
    order = captures.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return order.mapInArrow(
        read,
        "page_id bigint, record_type string, url string, payload binary, payload_digest string, refers_to bigint",
    )


def round_trip(spark: SparkSession, pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes archives and index, looks every page up again, and describes what the archives hold."""
    root = scratch_path(spark, "warc")
    captures = write_archives(pages, f"{root}/archive", page_id, url, html)
    top = build_index(captures, f"{root}/index")
    found = lookup(pages, top, f"{root}/index", url, page_id)
    records = store(
        read_records(found, f"{root}/archive").select(
            "page_id", "record_type", "refers_to", F.length("payload").cast("long").alias("payload_bytes"), "payload_digest"
        ),
        "warc-records",
    )
    responses = records.where(F.col("record_type") == "response")
    held = store(
        responses.groupBy(F.col("page_id").alias("_page")).agg(
            F.min(F.struct("payload_bytes", "payload_digest")).alias("_held")
        ),
        "warc-held",
    )
    # A revisit's payload is that of the record it refers to; only revisits have a key to join on.
    revisits = (
        records.where(F.col("record_type") == "revisit")
        .drop("payload_bytes", "payload_digest")
        .join(held, F.col("refers_to") == F.col("_page"), "left")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.select("page_id", "_held.*", "record_type", "refers_to"))
