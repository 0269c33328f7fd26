"""Web archives (WARC 1.1, one gzip member per record) that are written with an index and read by the index.

The index has archive, offset, length, URL and digest of each record; whoever wants records selects index rows, and the reader
fetches their byte ranges in sorted order, neighbouring ranges in one read. The index is also what commits an archive: a task that is
run again writes a file of another name, and only files named in the index count.

Archives go through ``pyarrow.fs``, which opens local, HDFS, S3 and GCS paths by their scheme.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtlake.llm.common import stored
from subtlake.llm.tokens import bounded_batches, slices
from subtlake.session import shuffle_partitions

INDEX = "page_id long, archive string, offset long, length long, url string, payload_digest string, record_type string, refers_to long"
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary, "
          "archive string, offset long")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _clean(url: str) -> str:
    """Control characters and blanks in percent form, so that a URL can not end its header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(1, wbits=31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0,
                   archive_bytes: int = 1 << 30, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One record per row of ``pages`` into archives below ``folder``; returns the written index, see ``INDEX``.

    The payload is ``html`` in UTF-8 (null: empty). Of records with equal payloads of at least ``least`` bytes, that with the smallest
    page id is a response and the others revisits of it; rows that repeat the smallest page id are responses, too. Null page ids
    are the largest; a null URL has no URL line. An archive is closed when it reaches ``archive_bytes``.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    seen = rows.select("sha1", F.octet_length("html").alias("size"), "page_id").where(F.col("size") >= least)
    first = seen.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha1", "first")
    joined = rows.join(stored(first, "payloads"), "sha1", "left")
    archives = f"{folder.rstrip('/')}/archives"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, place, out, path, offset = None, None, None, None, 0
        for batch in batches:
            for part in slices(batch, "html"):
                index = []
                for row in part.to_pylist():
                    if out is None:
                        if target is None:
                            target, place = fs.FileSystem.from_uri(archives)
                            target.create_dir(place, recursive=True)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        path, offset, out = f"{archives}/{name}", 0, target.open_output_stream(f"{place}/{name}", compression=None)
                    payload = row["html"].encode()
                    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    revisit = row["first"] is not None and row["first"] != row["page_id"]
                    data = _record(row["page_id"], row["url"], payload, digest, row["first"], revisit, date)
                    out.write(data)
                    index.append({"page_id": row["page_id"], "archive": path, "offset": offset, "length": len(data), "url": row["url"],
                                  "payload_digest": digest, "record_type": "revisit" if revisit else "response",
                                  "refers_to": row["first"] if revisit else None})
                    offset += len(data)
                    if offset >= archive_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_pylist(index, _arrow(INDEX))
        if out is not None:
            out.close()

    index = f"{folder.rstrip('/')}/index"
    joined.select("page_id", "url", "html", "sha1", "first").mapInArrow(write, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def _header(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def parse_record(data: bytes) -> dict:
    """Fields and payload of one record, all from its own bytes."""
    head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    fields = _header(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    if revisit:
        digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(_header(http)["content-length"])
    else:
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        if digest != fields["warc-payload-digest"].removeprefix("sha1:"):
            raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    return {"page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
            "refers_to": _page(fields.get("warc-refers-to")), "payload_digest": digest, "payload_bytes": size,
            "payload": None if revisit else payload}


def read_records(selected: DataFrame, gap: int = 1 << 16, most: int = 8 << 20, stretch: int = 64 << 20) -> DataFrame:
    """The records that ``selected`` rows of an index name, see ``RECORD``; the payload of a revisit is null, its digest and size are not.

    Rows are sorted by archive and offset; ranges with at most ``gap`` bytes between them are fetched in one read of up to ``most``
    bytes (or one record). Stretches of ``stretch`` bytes of an archive are read by different tasks. A payload that does not have its
    digest ends the job. Rows selected twice come twice.
    """
    wanted = selected.select("archive", "offset", "length")
    part = F.floor(F.col("offset") / stretch)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for batch in batches:
            rows = batch.to_pylist()
            begin = 0
            while begin < len(rows):
                archive, low = rows[begin]["archive"], rows[begin]["offset"]
                high, stop = low + rows[begin]["length"], begin + 1
                while (stop < len(rows) and rows[stop]["archive"] == archive and rows[stop]["offset"] <= high + gap
                       and rows[stop]["offset"] + rows[stop]["length"] - low <= most):
                    high = max(high, rows[stop]["offset"] + rows[stop]["length"])
                    stop += 1
                if archive != opened:
                    if source is not None:
                        source.close()
                    where, path = fs.FileSystem.from_uri(archive)
                    opened, source = archive, where.open_input_file(path)
                source.seek(low)
                data = source.read(high - low)
                out, size = [], 0
                for row in rows[begin:stop]:
                    at = row["offset"] - low
                    out.append(parse_record(data[at:at + row["length"]]) | {"archive": archive, "offset": row["offset"]})
                    size += len(out[-1]["payload"] or b"")
                    if size > most:
                        yield pa.RecordBatch.from_pylist(out, _arrow(RECORD))
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, _arrow(RECORD))
                begin = stop
        if source is not None:
            source.close()

    # index rows are few bytes for much to read, so the number of tasks is set and not left to their size
    dealt = wanted.repartition(shuffle_partitions(selected), "archive", part).sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(read, RECORD)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index")
