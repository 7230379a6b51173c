"""Content-addressed WARC archive (operator 1).

``write_archive`` stores two tables: ``payloads`` keeps each distinct payload once under
its SHA-256 address, ``records`` keeps the exact header bytes of every record and the
address of its payload. ``read_archive`` joins them back into whole records and verifies
every payload against its address. ``export_warc`` / ``import_warc`` go through plain
WARC files.

Defined cases: a null payload is the empty payload; a null url leaves WARC-Target-URI
out; control characters and blanks in a url are percent-encoded, so no header line can
be forged. Rows with a null id are recorded and come back with a null id; they never
become the target of a revisit unless all rows of their payload have a null id, and then
all are responses. Rows repeating both the smallest id and its payload are the same
capture, all responses. Payloads shorter than ``min_payload_bytes`` are all responses.
Extra columns are ignored. Empty input gives an empty archive.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: RFC 4648 base32 digits against the digits that conv(.., 32) writes. Fixed values.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload) -> F.Column:
    """Upper-case base32 SHA-1: four groups of 40 bits, eight digits each."""
    hexa = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexa, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), CONV_DIGITS, BASE32_DIGITS)


def _safe_url(url) -> F.Column:
    out = F.regexp_replace(url, " ", "%20")
    for code in (9, 10, 13):
        out = F.regexp_replace(out, chr(code), "%%%02X" % code)
    return F.regexp_replace(out, "[\\x00-\\x1F\\x7F]", "%00")


def _line(name: str, value) -> F.Column:
    return F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n"))


def _uri(page_id) -> F.Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  body_col: str = "html", min_payload_bytes: int = 0,
                  captured_at: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``path/payloads`` (address, payload) and ``path/records`` (address, header).

    The ids and digests are narrow and decide responses and revisits; payload bytes are
    shuffled once, by (address, id), combined map-side."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("address", F.unhex(F.sha2("payload", 256)))
    narrow = rows.select("page_id", "url", "address", base32_sha1(F.col("payload")).alias("sha1"),
                         F.octet_length("payload").cast("long").alias("n"))
    keepers = narrow.groupBy("address").agg(F.min("page_id").alias("keeper"))

    j = narrow.join(keepers, "address")
    revisit = (F.col("n") >= min_payload_bytes) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))
    body_len = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _uri(F.col("page_id"))),
        _line("WARC-Date", F.lit(captured_at)),
        F.coalesce(_line("WARC-Target-URI", _safe_url(F.col("url"))), F.lit("")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _uri(F.col("keeper"))),
                                 _line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", body_len), F.lit("\r\n"), http)
    (j.select("address", F.encode(header, "UTF-8").alias("header"))
     .write.option("compression", "zstd").parquet(path + "/records"))

    key = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    once = rows.groupBy("address", key.alias("k")).agg(F.first("payload").alias("payload"))
    kept = keepers.select("address", F.coalesce(F.col("keeper").cast("string"), F.lit("")).alias("k"))
    (once.join(kept, ["address", "k"], "left_semi").select("address", "payload")
     .write.option("compression", "zstd").parquet(path + "/payloads"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Whole records again: (address, header, payload), every payload verified against
    its SHA-256 address. A hot payload only repeats on the record side, which the join can split."""
    payloads = spark.read.parquet(path + "/payloads")
    bad = F.raise_error(F.concat(F.lit("payload does not match its address "), F.hex("address")))
    checked = payloads.select("address", F.when(F.unhex(F.sha2("payload", 256)) == F.col("address"), F.col("payload"))
                              .otherwise(bad.cast("binary")).alias("payload"))
    return spark.read.parquet(path + "/records").join(checked, "address")


def header_field(header, name: str) -> F.Column:
    """The value of a WARC header line, or NULL."""
    got = F.regexp_extract(F.decode(header, "UTF-8"), "(?:^|\\r\\n)%s: ([^\\r\\n]*)" % name, 1)
    return F.when(got != "", got)


def page_of(uri) -> F.Column:
    return F.regexp_extract(F.coalesce(uri, F.lit("")), "<urn:x-page:(.*)>", 1)


def export_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Plain WARC files, one per task: header bytes, block (empty for revisits), CRLF CRLF.
    The text writer's line end is the last byte of each record, so no byte is added."""
    h = F.decode("header", "UTF-8")
    block = F.when(header_field(F.col("header"), "WARC-Type") == "revisit", F.lit("")).otherwise(
        F.decode("payload", "UTF-8"))
    (records.select(F.concat(h, block, F.lit("\r\n\r")).alias("value"))
     .write.option("lineSep", "\n").option("compression", compression).text(path))


IMPORT_SCHEMA = T.StructType([T.StructField("header", T.BinaryType()), T.StructField("body", T.BinaryType())])


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files (one file is one task's work): WARC header, then block bytes."""
    def parse(batches: Iterator) -> Iterator:
        import gzip

        import pandas as pd
        for pdf in batches:
            for raw in pdf["content"]:
                data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                at, out = 0, []
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    fields = dict(x.split(b": ", 1) for x in data[at:end].split(b"\r\n")[1:] if b": " in x)
                    size = int(fields[b"Content-Length"])
                    out.append((data[at:end], data[end:end + size]))
                    at = end + size + 4
                yield pd.DataFrame(out, columns=["header", "body"])
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, IMPORT_SCHEMA)
