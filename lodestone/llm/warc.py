"""WARC archives in per-record Zstandard frames with a dictionary.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary; every record is one frame compressed with it.  The writer makes
response records and, for payloads that occurred before, revisit records that
refer to the response.  The reader loads the dictionary from the leading frame,
decodes frame by frame, and checks version line, mandatory headers, block
length, record end and payload digest of each record.

Archives are files in a shared folder, reached through Arrow's file systems for
writing and Spark's binaryFile source for reading.  A task writes its archives
under names made of its partition and a part number, first to a temporary name
of the attempt: a repeated task replaces its own files with equal ones.

Null payloads are empty payloads and are archived as such.  A page without an id
gets a record under an id of its place in the archive, without the page's header;
it revisits a page with an equal payload and an id, and is a response where there
is none.  Repeated page ids each get a record.  Empty tables give empty archives' tables.  Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, scratch_path, task

SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
PART_BYTES = 8 << 20  # payload bytes of one archive file: it is read whole
SAMPLE_BYTES = 1 << 20  # of a part's first payloads, for its dictionary
DICT_BYTES = 16 << 10
MANDATORY = ("WARC-Record-ID", "Content-Length", "WARC-Date", "WARC-Type")
READ = "path string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, url string, payload binary, error string"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, sha: str, refers_to: int | None, date: str, place: str = "") -> bytes:
    """Bytes of one WARC/1.1 record.  A revisit has an empty block.  ``place``
    names a record without a page id."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(f'at {place}' if page_id is None else page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join((url or '').split()) or 'about:blank'}",
        f"WARC-Payload-Digest: sha1:{sha}",
        *([] if page_id is None else [f"X-Page-ID: {page_id}"]),
        f"X-Payload-Length: {size}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def archive(records: list[bytes], samples: list[bytes]) -> bytes:
    """A dictionary frame and one frame per record."""
    import zstandard

    raw = b""
    if len(samples) >= 8 and sum(map(len, samples)) >= 8 * DICT_BYTES:
        try:
            raw = zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too uniform to train on
            raw = b""
    if not raw:
        raw = b"".join(samples)[-DICT_BYTES:] or b"WARC/1.1\r\n"
    c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *map(c.compress, records)])


def _parse(data: bytes) -> dict:
    """Fields of one decoded record; raises ValueError for what is wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC version line")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line[:40]!r}")
        fields[name.strip()] = value.strip()
    if missing := [n for n in MANDATORY if n not in fields]:
        raise ValueError(f"missing {missing[0]}")
    n = int(fields["Content-Length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {n} does not match the block")
    block, kind = rest[:n], fields["WARC-Type"]
    sha = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    size = int(fields.get("X-Payload-Length", n))
    if kind == "response" and (digest(block) != sha or size != n):
        raise ValueError("payload digest or length does not match")
    if kind == "revisit" and (n or "X-Refers-To-Page-ID" not in fields):
        raise ValueError("revisit with a block or without a target")
    if kind not in ("response", "revisit"):
        raise ValueError(f"record type {kind!r}")
    refers, page = fields.get("X-Refers-To-Page-ID"), fields.get("X-Page-ID")
    return {
        "page_id": None if page is None else int(page), "record_type": kind, "refers_to": None if refers is None else int(refers), "payload_bytes": size,
        "payload_digest": sha, "url": fields.get("WARC-Target-URI"), "payload": block if kind == "response" else None, "error": None,
    }


def read_archive(data: bytes):
    """Records of one archive in order; a broken one as its error alone."""
    import zstandard

    bad = dict.fromkeys(("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "url", "payload"))
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != SKIPPABLE:
        yield bad | {"error": "no dictionary frame"}
        return
    size = struct.unpack_from("<I", data, 4)[0]
    if 8 + size > len(data):
        yield bad | {"error": "dictionary frame is cut off"}
        return
    words = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    d = zstandard.ZstdDecompressor(dict_data=words)
    view, at = memoryview(data), 8 + size
    while at < len(data):
        if bytes(view[at : at + 4]) != FRAME:
            yield bad | {"error": f"no frame at byte {at}"}
            return
        try:
            # a window that grows until the frame ends in it: nothing after the
            # frame is copied more than a few times
            window = 1 << 16
            while True:
                one = d.decompressobj()
                out = one.decompress(view[at : at + window])
                if one.eof:
                    break
                if at + window >= len(data):
                    raise zstandard.ZstdError("frame is cut off")
                window *= 4
        except zstandard.ZstdError as e:
            yield bad | {"error": f"frame at byte {at}: {e}"}
            return
        at = min(at + window, len(data)) - len(one.unused_data)
        try:
            yield _parse(out)
        except (ValueError, KeyError, UnicodeDecodeError) as e:
            yield bad | {"error": f"record before byte {at}: {e}"}


def write_archives(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
) -> str:
    """Archive every page; returns the folder.  Of equal payloads of at least
    ``min_revisit_bytes`` bytes the page with the largest id is the response,
    the others revisit it."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload")
    )
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha": F.sha2("payload", 256)})
    # who is the response: one row for each digest that occurs twice; the payloads
    # meet them by digest (a hot one is split, as any skewed join)
    groups = rows.where(F.col("size") >= min_revisit_bytes).groupBy("sha").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    rows = rows.join(groups.where("n > 1").select("sha", "first"), "sha", "left").select(
        "page_id", "url", "payload", "size", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to")
    )

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        part = 0

        def flush(records, samples):
            nonlocal part
            name = f"{root}/part-{task.partitionId():06d}-{part:04d}.warc.zst"
            held = f"{root}/_temporary-{task.taskAttemptId()}-{part:04d}"
            data = archive(records, samples)
            with store.open_output_stream(held, compression=None) as f:
                f.write(data)
            store.move(held, name)
            part += 1
            return pa.RecordBatch.from_pydict({"path": [name], "n": [len(records)], "bytes": [len(data)]})

        records, samples, total, sampled, seen = [], [], 0, 0, 0
        for b in batches:
            cols = [column(b, c).to_pylist() for c in ("page_id", "url", "payload", "size", "refers_to")]
            for page, url, payload, size, refers in zip(*cols):
                seen += 1
                r = record(page, url, payload, size, digest(payload), refers, date, f"{task.partitionId()}/{seen}")
                records.append(r)
                total += len(r)
                if sampled < SAMPLE_BYTES:
                    samples.append(r)
                    sampled += len(r)
                if total >= PART_BYTES:
                    yield flush(records, samples)
                    records, samples, total, sampled = [], [], 0, 0
        if records:
            yield flush(records, samples)

    rows.mapInArrow(task(run), "path string, n long, bytes long").agg(F.sum("n"), F.sum("bytes")).first()
    return folder


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in a folder; ``error`` says what is
    wrong with a record that could not be read (null otherwise)."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    except Exception as e:  # nothing was archived
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], READ)

    names = [x.split()[0] for x in READ.split(", ")]
    types = dict(zip(names, [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]))

    def run(batches):
        for b in batches:
            for path, data in zip(column(b, "path").to_pylist(), column(b, "content").to_pylist()):
                got, size = [], 0
                for r in read_archive(data):
                    got.append(r | {"path": path})
                    size += len(r["payload"] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in got], types[n]) for n in names], names)
                        got, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in got], types[n]) for n in names], names)

    return files.mapInArrow(task(run), READ)
