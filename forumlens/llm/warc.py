"""WARC archives: write, normalise to one gzip member per record, read back by offset.

Spark's text writer makes the raw archives: whole-file gzip streams, as many a
crawler leaves them.  The normaliser reads and inflates each stream once, from
start to end and a piece at a time, rewrites every record as a gzip member of its
own and writes a sidecar index of offsets: whatever the size of an archive, a task
holds one record of it.  Readers then seek to single records.

Normalised archives are files, so tasks write them to the shared folder through
pyarrow's file systems: under a name of the attempt, moved to the final name at
the end.  The bytes depend on the input alone, so a repeated task replaces a
file by an equal one.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import common as C
from forumlens.sources.files import file_system

#: Fixed values of the format.
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS_PER_FILE = 2000
READ_SIZE = 1 << 18  # bytes of a stream read, or inflated, at a time
INDEX_ROWS = 4096  # index rows that a task holds


def digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are four of base 32."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int, date: str) -> DataFrame:
    """One column ``value``: each page as a WARC record without its final END."""
    rows = pages.select(pages[id_col].cast("string").alias("id"), pages[id_col].alias("page"),
                        pages[url_col].alias("url"), F.coalesce(pages[html_col], F.lit("")).alias("html"))
    rows = rows.withColumns({"bytes": F.octet_length("html").cast("long"),
                             "digest": digest(F.col("html").cast("binary"))})
    # the digest alone names the payload; one row per payload that occurs twice
    first = (rows.where(F.col("bytes") >= least_bytes).groupBy("digest")
             .agg(F.max("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    # dealt anew, so that Spark may split a payload that a third of the pages share
    rows = rows.join(first.repartition(C.shuffle_width(pages.sparkSession)), "digest", "left")
    revisit = F.coalesce((F.col("bytes") >= least_bytes) & F.col("first").isNotNull()
                         & ~F.col("page").eqNullSafe(F.col("first")), F.lit(False))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    body = F.when(revisit, "").otherwise(F.col("html"))
    url = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20\x7F]", ""),
                              F.lit("\r\n")), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce("id", F.lit("")), F.lit(f">\r\nWARC-Date: {date}\r\n"),
        url, F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"),
                                 F.lit(f">\r\nWARC-Profile: {REVISIT_PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(END))
    return rows.select(F.concat(head, http, body).alias("value"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """``pages`` as raw archives in ``folder``, whole-file gzip streams.

    Of equal payloads of ``least_bytes`` or more, the page of the largest id is
    the response (of several rows with that id, or none at all, each one), the
    others are revisits that refer to it.  Null html is an empty payload.
    """
    (records(pages, id_col, url_col, html_col, least_bytes, date).write
     .option("compression", "gzip").option("lineSep", END)
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder))


def pieces(file, size: int = READ_SIZE) -> Iterator[bytes]:
    """What a file holds, ``size`` bytes at a time."""
    while data := file.read(size):
        yield data


def inflated(compressed: Iterator[bytes], size: int = READ_SIZE) -> Iterator[bytes]:
    """A gzip stream of any number of members, at most ``size`` bytes at a time."""
    stream = None
    for data in compressed:
        while data:
            if stream is None or stream.eof:
                stream = zlib.decompressobj(31)
            yield stream.decompress(data, size)
            data = stream.unused_data if stream.eof else stream.unconsumed_tail
    while stream is not None and not stream.eof:
        if not (rest := stream.decompress(b"", size)):
            raise ValueError("a gzip stream ends before its end")
        yield rest


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, final END included, by the lengths that they state."""
    held = bytearray()
    need = 0
    for piece in pieces:
        held += piece
        while len(held) >= need:
            if not need:
                k = held.find(END.encode())
                if k < 0:
                    break
                need = k + len(END) + int(fields(bytes(held[:k]))["content-length"]) + len(END)
                continue
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held.strip():
        raise ValueError(f"a record is cut off after {len(held)} bytes")


def fields(head: bytes) -> dict[str, str]:
    lines = (x.partition(":") for x in head.decode("utf-8").split("\r\n")[1:])
    return {a.lower(): b.strip() for a, _, b in lines}


def _normalise(folder: str):
    kind = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                      ("record", pa.string()), ("type", pa.string())])

    def one(path: str) -> Iterator[list[dict]]:
        store, base = file_system(folder)
        source, raw = file_system(path)
        name = path.rpartition("/")[2].removesuffix(".gz").removesuffix(".txt")
        mine = f"{base}/_{name}-{uuid.uuid4().hex}"
        rows, offset = [], 0
        with (source.open_input_stream(raw, compression=None) as file,
              store.open_output_stream(f"{mine}.warc.gz", compression=None) as out,
              store.open_output_stream(f"{mine}.index", compression=None) as index):
            for record in split_records(inflated(pieces(file))):
                head = fields(record[:record.index(END.encode())])
                member = gzip.compress(record, 6, mtime=0)
                out.write(member)
                rows.append({"archive": f"{name}.warc.gz", "offset": offset, "length": len(member),
                             "record": head["warc-record-id"], "type": head["warc-type"]})
                index.write((json.dumps(rows[-1]) + "\n").encode())
                offset += len(member)
                if len(rows) == INDEX_ROWS:
                    yield rows
                    rows = []
        for end in ("warc.gz", "index"):
            store.move(f"{mine}.{end}", f"{base}/{name}.{end}")
        yield rows

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for rows in one(path):
                    yield pa.RecordBatch.from_pylist(rows, kind)
    return run


def normalise(spark: SparkSession, raw: str, folder: str) -> DataFrame:
    """Rewrite the archives in ``raw`` to ``folder``, one member per record, with
    a sidecar ``.index`` of JSON lines beside each; the rows of all indexes.

    Spark lists the archives (``*.gz``) without reading them; tasks open them
    themselves, so both folders must be ones that pyarrow's file systems reach.
    Archives may have any number of gzip members and any size.  An archive that
    ends within a record or a stream, or isn't gzip, is an error.  Equal records
    are kept each; an empty archive or folder gives no rows.
    """
    store, base = file_system(folder)
    store.create_dir(base, recursive=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(raw).select("path")
    return C.stored(files.mapInArrow(
        _normalise(folder), "archive string, offset long, length long, record string, type string"), "index")


def _read(folder: str):
    def run(batches):
        store, base = file_system(folder)
        name, file = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["archive"] != name:
                    name, file = row["archive"], store.open_input_file(f"{base}/{row['archive']}")
                file.seek(row["offset"])
                record = gzip.decompress(file.read(row["length"]))
                k = record.index(END.encode())
                head, block = fields(record[:k]), record[k + len(END):-len(END)]
                k = block.index(END.encode())
                payload = block[k + len(END):]
                told = head["warc-payload-digest"].removeprefix("sha1:")
                if head["warc-type"] == "revisit":  # the payload is elsewhere; its size is stated here
                    size = int(fields(block[:k])["content-length"])
                else:
                    size = len(payload)
                    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != told:
                        raise ValueError(f"{row['record']}: the payload doesn't have its digest")
                named = [head.get(f, "").removeprefix("<urn:page:").removesuffix(">")
                         for f in ("warc-record-id", "warc-refers-to")]
                out.append({"id": named[0] or None, "payload_bytes": size, "payload_digest": told,
                            "record_type": head["warc-type"], "refers_to": named[1] or None,
                            "payload": payload.decode("utf-8") if head["warc-type"] != "revisit" else None})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.string())]))
    return run


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Every record of ``index``, read at its offset: id, payload_bytes,
    payload_digest, record_type, refers_to and payload (null for revisits).

    A record of a page without an id has the id null; a payload that lacks the
    digest that its record states is an error; index rows that repeat are read
    again; an empty index gives no rows.
    """
    return index.mapInArrow(_read(folder), "id string, payload_bytes long, payload_digest string, "
                                           "record_type string, refers_to string, payload string")


def through_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) written, normalised and read back: a row per
    page.  Null html is the empty payload, a null url is left out of its record;
    of equal payloads the largest id is the response (``write_archives``), rows
    that repeat have a record each; other columns are ignored; no pages, no rows.
    """
    spark = pages.sparkSession
    raw, folder = C.new_folder(spark, "warc-raw"), C.new_folder(spark, "warc")
    write_archives(pages, raw, least_bytes=least_bytes)
    return read_archives(normalise(spark, raw, folder), folder)
