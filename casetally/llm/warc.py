"""WARC: writing captures, reading archives, assembling transactions."""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casetally.llm.common import shared_folder, stored

VERSION = "WARC/1.1"
DATE = "2020-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 20

RECORD_SCHEMA = (
    "record_id string, record_type string, concurrent_to array<string>, target_uri string, "
    "headers map<string,string>, payload binary, payload_bytes long, payload_digest string, "
    "archive string, position long"
)


def record_bytes(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own, as WARC archives hold them."""
    head = [VERSION, f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 4, mtime=0)


def one_line(text: str | None) -> str:
    """A header value: line breaks and other controls are percent-encoded."""
    return "".join(c if ord(c) >= 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in text or "")


def capture_records(page_id, url, payload: bytes, digest: str, kind: str, refers_uri) -> bytes:
    """Response or revisit, request and metadata of one capture.

    The request and the metadata name the first record as the one they are concurrent to.
    """
    main, uri = f"<urn:uuid:{uuid.uuid4()}>", one_line(url)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    own = [("WARC-Record-ID", main), *common, ("WARC-Payload-Digest", f"sha256:{digest}"),
           ("Content-Type", "application/http;msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if kind == "revisit":
        own += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To-Target-URI", one_line(refers_uri)),
                ("WARC-Refers-To-Date", DATE)]
        block = http
    else:
        block = http + payload
    side = [("WARC-Concurrent-To", main), *common]
    request = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), *side,
               ("Content-Type", "application/http;msgtype=request")]
    metadata = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), *side,
                ("Content-Type", "application/warc-fields")]
    page = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    return b"".join((
        record_bytes(kind, own, block),
        record_bytes("request", request, f"GET {uri} HTTP/1.1\r\n\r\n".encode()),
        record_bytes("metadata", metadata, page),
    ))


def write_archives(
    pages: DataFrame, folder: str, least_shared: int = 100, archive_bytes: int = 64 << 20,
    page_id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Write one capture per page and return the archives: ``archive, captures``.

    Of pages with equal payloads of at least ``least_shared`` bytes the smallest id is
    written as response (every row of that id, should it repeat; NULL only if there is no
    other), the others as revisits without payload. Equality is decided on narrow rows,
    by digest and length; a payload is shuffled once, and one that many pages share is a
    hot key of a join with one row per digest, which Spark splits. Every task writes its
    own archives through a file system that all tasks see; the result lists only those of
    tasks that succeeded, and is itself a written table.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    first = (
        rows.filter(F.octet_length("payload") >= least_shared)
        .groupBy("digest").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
    )
    uris = rows.join(first, "digest").filter(F.col("page_id").eqNullSafe(F.col("_first"))).groupBy("digest").agg(
        F.first("_first").alias("_first"), F.min("url").alias("_uri")
    )
    revisit = F.col("_uri_known") & ~F.col("page_id").eqNullSafe(F.col("_first"))
    decided = rows.join(uris.withColumn("_uri_known", F.lit(True)), "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("_uri")).alias("refers_uri"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        out, path, size, captures = None, None, 0, 0

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"archive": [path], "captures": [captures]})

        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    path, size, captures = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                values = [c[i].as_py() for c in batch.columns]
                data = capture_records(*values)
                out.write(data)
                size, captures = size + len(data), captures + 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield listed()
        if out is not None:
            out.close()
            yield listed()

    return stored(decided.mapInArrow(write, "archive string, captures long"))


class _Members:
    """The gzip members of a stream, one record each, read piece by piece."""

    def __init__(self, stream):
        self.stream, self.left, self.position = stream, b"", 0

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        while True:
            if not self.left:
                self.left = self.stream.read(READ_BYTES)
                if not self.left:
                    return
            start, inflate, parts = self.position, zlib.decompressobj(31), []
            while not inflate.eof:
                if not self.left:
                    self.left = self.stream.read(READ_BYTES)
                    if not self.left:
                        raise ValueError("an archive ends within a record")
                parts.append(inflate.decompress(self.left))
                self.position += len(self.left) - len(inflate.unused_data)
                self.left = inflate.unused_data
            yield start, b"".join(parts)


def parse_record(raw: bytes) -> tuple[dict[str, list[str]], bytes]:
    """Header fields, names in lower case and each with all its values, and the block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("a record does not begin with its version")
    fields: dict[str, list[str]] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in " \t" and name:  # folded
            fields[name][-1] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        fields.setdefault(name, []).append(value.strip())
    return fields, rest[: int(fields["content-length"][0])]


def read_records(spark: SparkSession, archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the listed archives, one row each (:data:`RECORD_SCHEMA`).

    The payload of an HTTP record is what follows its header block; of other records it is
    the whole block. With ``payloads`` false it is measured and digested but left out, and
    ``archive, position`` tell where it lies. Archives are dealt evenly to tasks and read
    as streams, so memory is bounded by the largest record.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]

        def frame(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string(),
                     pa.map_(pa.string(), pa.string()), pa.binary(), pa.int64(), pa.string(),
                     pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for position, raw in _Members(stream):
                        fields, block = parse_record(raw)
                        if fields.get("content-type", [""])[0].startswith("application/http"):
                            block = block.partition(b"\r\n\r\n")[2]
                        body = fields["warc-type"][0] == "metadata" or payloads
                        rows.append((
                            fields["warc-record-id"][0], fields["warc-type"][0],
                            fields.get("warc-concurrent-to", []), fields.get("warc-target-uri", [None])[0],
                            [(k, ", ".join(v)) for k, v in fields.items()], block if body else None,
                            len(block), hashlib.sha256(block).hexdigest(), path, position,
                        ))
                        held += len(block) if body else 500
                        if held >= 8 << 20 or len(rows) >= 5000:
                            yield frame(rows)
                            rows, held = [], 0
                if rows:
                    yield frame(rows)

    tasks = max(1, archives.count())
    return archives.select("archive").repartitionByRange(tasks, "archive").mapInArrow(read, RECORD_SCHEMA)


def assemble(records: DataFrame, per_row: int = 1000) -> DataFrame:
    """Captures from their records: ``record_id, part, capture, requests, metadata``.

    A response, revisit or resource record leads a capture. A request or metadata record
    belongs to the capture of the record it is concurrent to, named by either side, and
    also through other request or metadata records, over the fewest links; every round goes
    one link further, until no record finds an owner. One that reaches no leading record
    gives a capture of its own with a NULL ``capture``. All record types travel as structs.

    There is one row per leading record, also for one without other records. Should more
    than ``per_row`` records be concurrent to one, the rest of them follows in further
    rows, told apart by ``part``; nothing is cut and no row grows with the data.
    """
    leads = F.col("record_type").isin("response", "revisit", "resource")
    lead = records.filter(leads)
    side = records.filter(F.col("record_type").isin("request", "metadata"))
    named = side.select("record_id", F.explode("concurrent_to").alias("to"))
    ids = lead.select(F.col("record_id").alias("to"))
    direct = named.join(ids, "to", "left_semi").select("record_id", F.col("to").alias("capture_id"))
    reverse = lead.select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("capture_id"))
    near = stored(direct.unionByName(reverse).groupBy("record_id").agg(F.min("capture_id").alias("capture_id")))
    onward = stored(named.join(ids, "to", "left_anti").select("record_id", "to"))
    back = onward.select(F.col("to").alias("record_id"), F.col("record_id").alias("to"))
    links = stored(onward.unionByName(back.join(side.select("record_id"), "record_id", "left_semi")))
    owner = found = near
    while True:
        found = stored(
            links.join(found.select(F.col("record_id").alias("to"), "capture_id"), "to")
            .join(owner.select("record_id"), "record_id", "left_anti")
            .groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
        )
        if found.isEmpty():
            break
        owner = owner.unionByName(found)
    owned = side.join(owner, "record_id", "left").withColumn(
        "capture_id", F.coalesce("capture_id", "record_id")
    )
    parts = owned.groupBy("capture_id").agg(F.ceil(F.count("*") / F.lit(per_row)).alias("_parts"))
    split = owned.join(parts.filter("_parts > 1"), "capture_id", "left").withColumn(
        "part", F.pmod(F.xxhash64("record_id"), F.coalesce("_parts", F.lit(1))).cast("int")
    )
    fields = ["record_id", "record_type", "target_uri", "headers", "payload", "payload_bytes",
              "payload_digest", "archive", "position"]
    record = F.struct(*fields)

    def of(kind: str) -> Column:
        return F.collect_list(F.when(F.col("record_type") == kind, record))

    sides = split.groupBy("capture_id", "part").agg(
        of("request").alias("requests"), of("metadata").alias("metadata")
    )
    heads = lead.select(F.col("record_id").alias("capture_id"), record.alias("capture"))
    return heads.join(sides, "capture_id", "full").select(
        F.col("capture_id").alias("record_id"), F.coalesce("part", F.lit(0)).alias("part"), "capture",
        F.coalesce("requests", F.array()).alias("requests"),
        F.coalesce("metadata", F.array()).alias("metadata"),
    )


def page_captures(captures: DataFrame) -> DataFrame:
    """Per capture ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A revisit carries no payload: its digest is the one its header names, and length and
    page are those of the response with that digest.
    """
    own = F.element_at(F.transform(
        "metadata", lambda m: F.regexp_extract(m["payload"].cast("string"), r"(?m)^page-id: (-?\d+)", 1)
    ), 1)
    rows = captures.filter("capture IS NOT NULL AND part = 0").select(
        own.alias("_page"), "capture.*",
    ).select(
        F.when(F.col("_page") != "", F.col("_page").cast("long")).alias("page_id"), "record_type",
        "payload_bytes",
        F.when(
            F.col("record_type") == "revisit",
            F.regexp_replace(F.col("headers")["warc-payload-digest"], "^sha256:", ""),
        ).otherwise(F.col("payload_digest")).alias("payload_digest"),
    )
    rows = stored(rows)
    first = rows.filter("record_type = 'response'").groupBy("payload_digest").agg(
        F.min("page_id").alias("_page"), F.max("payload_bytes").alias("_bytes")
    )
    revisits = rows.filter("record_type = 'revisit'").join(first, "payload_digest", "left").select(
        "page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.col("_page").alias("refers_to"),
    )
    return rows.filter("record_type != 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")
    ).unionByName(revisits)


def archived_pages(pages: DataFrame, **columns: str) -> DataFrame:
    """Write the pages to archives, read these back and assemble: one row per page."""
    spark = pages.sparkSession
    folder = shared_folder(spark)
    archives = write_archives(pages, folder, **columns)
    return page_captures(assemble(stored(read_records(spark, archives, folder, payloads=False))))
