"""Pages to WARC archives and back, index first.

Each task writes the records of its pages to archives of its own, one gzip member per record, and returns an index row for each:
file, offset, length, URL, digest. A record counts only through its index row, so files of lost or repeated tasks are
never read. Reading sorts the selected index rows by place, and fetches neighbouring records in one range read.
Of equal payloads of at least ``MIN_REVISIT`` bytes only the one with the smallest page id is stored; the others are revisit records.

Nulls: a null html is an empty payload, a null URL is left out of the record, a null page id is kept as null. Repeated page ids are
records of their own; of these with equal payloads, each is a response if its id is the smallest. An empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import map_batches, written
from tidefold.session import scratch_path

MIN_REVISIT = 100
FILE_BYTES = 256 << 20
# Ranges this near are read as one, up to so many bytes.
GAP_BYTES = 64 << 10
RUN_BYTES = 1 << 20
# A task reads about so many bytes of archives.
TASK_BYTES = 8 << 20
DATE = "2025-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, compressed by itself."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers_to is None else b"")
    head.append(f"Content-Length: {len(block)}")
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a compressed record."""
    whole = zlib.decompress(data, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, text (the payload), digest, refers_to (null for responses).

    The digests that occur more than once are written before pages are joined with them, so that the pages of a very frequent payload can
    be split.
    """
    text = F.coalesce("html", F.lit(""))
    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text.alias("text"), F.sha2(text, 256).alias("digest"))
    large = picked.where(F.octet_length("text") >= MIN_REVISIT)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = written(first, "warc-first")
    refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return picked.join(first, "digest", "left").select("page_id", "url", "text", "digest", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives below ``folder``, which all executors reach, and returns the index."""

    def run(batches):
        files, _ = pafs.FileSystem.from_uri(folder)
        sink, name, at = None, "", 0
        try:
            for batch in batches:
                out = defaultdict(list)
                for r in (r for i in range(0, batch.num_rows, 64) for r in batch.slice(i, 64).to_pylist()):
                    if sink is None or at > FILE_BYTES:
                        if sink:
                            sink.close()
                        name, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        path = pafs.FileSystem.from_uri(name)[1]
                        files.create_dir(path.rsplit("/", 1)[0])
                        sink = files.open_output_stream(path, compression=None)
                    data = record(r["page_id"], r["url"], r["text"].encode(), r["digest"], r["refers_to"])
                    sink.write(data)
                    kind = "response" if r["refers_to"] is None else "revisit"
                    for k, v in zip(_INDEX, (name, at, len(data), r["page_id"], r["url"], r["digest"], kind), strict=True):
                        out[k].append(v)
                    at += len(data)
                yield {k: pa.array(out[k], t) for k, t in _INDEX.items()}
        finally:
            if sink:
                sink.close()

    return written(map_batches(with_references(pages), run, INDEX), "warc-index")


_INDEX = {
    "file": pa.string(), "offset": pa.int64(), "length": pa.int64(), "page_id": pa.int64(), "url": pa.string(),
    "digest": pa.string(), "record_type": pa.string(),
}


def runs(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[str, int, int]]]]:
    """Neighbouring (file, offset, length) as (file, begin, end, members); rows come sorted."""
    members: list = []
    for row in rows:
        file, offset, length = row
        if members and (file != members[0][0] or offset > end + GAP_BYTES or offset + length - members[0][1] > RUN_BYTES):
            yield members[0][0], members[0][1], end, members
            members = []
        members.append(row)
        end = max(end, offset + length) if len(members) > 1 else offset + length
    if members:
        yield members[0][0], members[0][1], end, members


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the index rows name: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    ``payloads=False`` checks the payloads against their digests, but leaves them out.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple = (None, None)
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            for file, begin, end, members in runs(rows):
                if opened[0] != file:
                    store, path = pafs.FileSystem.from_uri(file)
                    opened = (file, store.open_input_file(path))
                data = opened[1].read_at(end - begin, begin)
                out = []
                for _, offset, length in members:
                    headers, payload = parsed(data[offset - begin : offset - begin + length])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = headers["WARC-Type"]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"damaged record at {file}:{offset}")
                    refers = _page(headers["WARC-Refers-To"]) if kind == "revisit" else None
                    out.append((_page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), int(headers["WARC-Payload-Length"]), digest, kind, refers, payload if payloads and kind == "response" else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], schema=pa.schema(list(zip(names, kinds, strict=True))))

    names = [c.split()[0] for c in schema.split(", ")]
    return index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Every page through an archive: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    index = write(pages, scratch_path(pages.sparkSession, "warc"))
    return read(index, payloads=False).drop("payload", "url")
