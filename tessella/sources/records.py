"""Web archive records: byte ranges of archive files, and pages out of records."""

import gzip
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_FIELDS = [
    T.StructField("warc", T.BinaryType()),
    T.StructField("warc_error", T.StringType()),
    T.StructField("download_success", T.BooleanType()),
]


def slice_records(pointers: DataFrame, root: str, partitions: int | None = None) -> DataFrame:
    """Read the byte range of each pointer from the archive files under `root`.

    The pointers are range-partitioned by file and offset: a task reads one stretch of
    one or few files front to back, and a file with very many pointers is shared
    by several tasks. A range that cannot be read gives empty bytes and an error text.
    """
    ordered = ["warc_filename", "warc_record_offset"]
    spread = pointers.repartitionByRange(partitions, *ordered) if partitions else pointers.repartitionByRange(*ordered)
    out = T.StructType([*pointers.schema.fields, *RECORD_FIELDS])
    names = pointers.columns

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = pafs.FileSystem.from_uri(root)
        current, stream = None, None
        for batch in batches:
            files = batch.column("warc_filename").to_pylist()
            offsets = batch.column("warc_record_offset").to_pylist()
            lengths = batch.column("warc_record_length").to_pylist()
            payloads, errors = [], []
            for file, offset, length in zip(files, offsets, lengths):
                try:
                    if file != current:
                        current, stream = None, filesystem.open_input_file(f"{base}/{file}")
                        current = file
                    stream.seek(offset)
                    data = stream.read(length)
                    if len(data) < length:
                        raise EOFError(f"{len(data)} of {length} bytes")
                    payloads.append(data)
                    errors.append("")
                except Exception as failure:  # recorded in the row, the job goes on
                    payloads.append(b"")
                    errors.append(repr(failure))
            columns = [
                pa.array(payloads, pa.binary()),
                pa.array(errors, pa.string()),
                pa.array([e == "" for e in errors], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], *columns], names=[*names, *[f.name for f in RECORD_FIELDS]]
            )

    return spread.sortWithinPartitions(*ordered).mapInArrow(read, out)


def slice_blobs(pointers: DataFrame, blobs: DataFrame) -> DataFrame:
    """The same for content that is already in a table (warc_filename, content)."""
    end = F.col("warc_record_offset") + F.col("warc_record_length")
    complete = F.col("content").isNotNull() & (end <= F.length("content"))
    data = F.substring(
        "content", (F.col("warc_record_offset") + 1).cast("int"), F.col("warc_record_length").cast("int")
    )
    return (
        pointers.join(blobs, "warc_filename", "left")
        .withColumn("warc", F.when(complete, data).otherwise(F.lit(b"")))
        .withColumn(
            "warc_error",
            F.when(F.col("content").isNull(), F.lit("missing")).when(~complete, F.lit("short")).otherwise(F.lit("")),
        )
        .withColumn("download_success", F.col("warc_error") == "")
        .drop("content")
    )


def _headers(block: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = block.decode("latin-1").split("\r\n")
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return first, {name.strip().lower(): value.strip() for name, value in pairs}


def response_body(data: bytes) -> tuple[bytes, str]:
    """Body and charset of the first response record of archive bytes."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        head_end = data.find(b"\r\n\r\n", at)
        if head_end < 0:
            break
        version, headers = _headers(data[at:head_end].lstrip(b"\r\n"))
        if not version.startswith("WARC/"):
            raise ValueError("not an archive record")
        start = head_end + 4
        size = int(headers.get("content-length", "0"))
        if headers.get("warc-type") == "response":
            http_head, _, body = data[start : start + size].partition(b"\r\n\r\n")
            _, http = _headers(http_head)
            if "chunked" in http.get("transfer-encoding", "").lower():
                body = _dechunk(body)
            encoding = http.get("content-encoding", "").lower()
            if encoding == "gzip":
                body = gzip.decompress(body)
            elif encoding == "deflate":
                body = zlib.decompress(body)
            charset = http.get("content-type", "").lower().partition("charset=")[2].split(";")[0]
            return body, charset.strip(" \"'") or "utf-8"
        at = start + size
        while data[at : at + 2] == b"\r\n":
            at += 2
    return b"", ""


def _dechunk(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        line_end = body.find(b"\r\n", at)
        if line_end < 0:
            return b"".join(parts)
        size = int(body[at:line_end].split(b";")[0] or b"0", 16)
        if size == 0:
            return b"".join(parts)
        parts.append(body[line_end + 2 : line_end + 2 + size])
        at = line_end + 4 + size


def _page(data: bytes | None, upstream_error: str | None) -> tuple[str, str]:
    if upstream_error:
        return "", "no WARC"
    try:
        body, charset = response_body(data or b"")
        if not body or not charset:
            return "", "No page or encoding"
        try:
            return body.decode(charset), ""
        except (LookupError, UnicodeDecodeError):
            return body.decode("utf-8", errors="replace"), ""
    except Exception as failure:  # recorded in the row, the job goes on
        return "", str(failure) or repr(failure)


def warc_to_pages(records: DataFrame) -> DataFrame:
    """Add `html` and `html_error` to rows with `warc` and `warc_error`; drops the bytes."""
    page_type = T.StructType([T.StructField("html", T.StringType()), T.StructField("html_error", T.StringType())])

    @F.pandas_udf(page_type)
    def page(warc: pd.Series, error: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_page(w, e) for w, e in zip(warc, error)], columns=["html", "html_error"])

    return records.withColumn("_page", page("warc", "warc_error")).select(
        *[c for c in records.columns if c != "warc"], "_page.html", "_page.html_error"
    )
