"""WARC archives with a Zstandard dictionary in a leading skippable frame, one compressed frame per record."""

from __future__ import annotations

import hashlib
import io
import os
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.shared import mounted, run_dir, written

LEAST_BYTES = 100  # payloads below that are archived whole each time
SAMPLES, SAMPLE_CHARS, DICTIONARY = 1_000, 8_192, 64 * 1024  # records the dictionary is built from, what is read of each, its size
SKIPPABLE = 0x184D2A5D  # fixed value: the skippable frame that holds a dictionary
DATE = "2024-01-01T00:00:00Z"


def record_id(page: str | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def page_of(record: str) -> str | None:
    return record[len("<urn:page:") : -1] or None


def record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """A response, or a revisit of the record of ``refers_to``: that one has the HTTP header only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Target-URI: {target}", f"WARC-Date: {date}"]
    head.append(f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[str | None, int, str, str, str | None]:
    """page, payload bytes, payload digest, record type, page referred to; the digest of a response is computed anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "revisit":
        size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
        return page_of(fields["WARC-Record-ID"]), size, digest, "revisit", page_of(fields["WARC-Refers-To"])
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    return page_of(fields["WARC-Record-ID"]), len(payload), digest, "response", None


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary built from records; none if there are too few to build one."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def read_records(file) -> Iterator[bytes]:
    """The records of an archive one by one; no more than one and a chunk are held."""
    head = file.read(8)
    held, kind = head, None
    if len(head) == 8 and struct.unpack("<II", head)[0] == SKIPPABLE:
        kind, held = zstandard.ZstdCompressionDict(file.read(struct.unpack("<II", head)[1])), b""
    codec = zstandard.ZstdDecompressor(dict_data=kind) if kind else zstandard.ZstdDecompressor()
    frame, parts = codec.decompressobj(), []
    while held or (held := file.read(1 << 20)):
        parts.append(frame.decompress(held))
        held = b""
        if frame.eof:
            yield b"".join(parts)
            held, parts, frame = frame.unused_data, [], codec.decompressobj()
    if any(parts):
        raise ValueError("the archive ends inside a record")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record per row of ``pages`` into archives below ``folder``, one per partition; returns (path, records).

    Of records with equal payloads (by SHA-256) of ``LEAST_BYTES`` or more, the one with the smallest id is a response
    and the others revisit it; rows that repeat that id are responses too, as are rows without an id. A null payload is
    empty. The dictionary is built on the driver from at most ``SAMPLES`` records, those with the smallest hashes of
    their ids. A file takes its place when it is complete, so attempts of a task replace one another.
    """
    spark = pages.sparkSession
    target = mounted(folder)
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    tagged = base.withColumn("digest", F.when((F.octet_length("html") >= LEAST_BYTES) & F.col("page_id").isNotNull(), F.sha2("html", 256)))
    groups = tagged.where("digest IS NOT NULL").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = written(groups.select(F.col("digest").alias("of"), "first"), folder, "equal-payloads")
    # about twice as many short rows as wanted pass the filter, however many partitions there are
    place = F.pmod(F.xxhash64("page_id"), F.lit(1 << 40))
    short = base.select("page_id", "url", F.substring("html", 1, SAMPLE_CHARS).alias("html"), place.alias("place"))
    some = short.where(F.col("place") <= (1 << 40) * 2 * SAMPLES // max(base.count(), 1)).orderBy("place", "page_id").limit(SAMPLES).collect()
    trained = dictionary([record(str(r.page_id), r.url, r.html.encode(), None) for r in some])
    rows = tagged.join(groups, F.col("digest") == F.col("of"), "left")
    rows = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", F.when(F.col("first") < F.col("page_id"), F.col("first")).cast("string").alias("refers_to"))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(trained)) if trained else zstandard.ZstdCompressor(level=3)
        path, n = f"{target}/part-{TaskContext.get().partitionId():06d}.warc.zst", 0
        os.makedirs(target, exist_ok=True)
        temp = f"{path}.{uuid.uuid4().hex}"
        with open(temp, "wb") as f:
            if trained:
                f.write(struct.pack("<II", SKIPPABLE, len(trained)) + trained)
            for frame in frames:
                for r in frame.itertuples(index=False):
                    f.write(codec.compress(record(r.page_id, r.url, (r.html or "").encode(), r.refers_to)))
                    n += 1
        os.replace(temp, path)
        yield pd.DataFrame({"path": [path], "records": [n]})

    return written(rows.mapInPandas(work, "path string, records long"), folder, "archives")


def read_archives(archives: DataFrame, id_type: str = "long") -> DataFrame:
    """Per record of the files in column ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                out = []
                with io.open(path, "rb") as f:
                    for data in read_records(f):
                        out.append(parse(data))
                        if len(out) == 10_000:
                            yield pd.DataFrame(out, columns=names)
                            out = []
                yield pd.DataFrame(out, columns=names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    rows = archives.select("path").repartition(F.col("path")).mapInPandas(work, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return rows.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive_report(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    made = write_archives(pages, run_dir(pages.sparkSession, "warc"), id_col, url, html)
    return read_archives(made, pages.schema[id_col].dataType.simpleString())
