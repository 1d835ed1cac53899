"""Content-addressed WARC archive: each payload once by its SHA-256, exact record headers apart, records by a join.

``write`` makes two tables under a path.  ``payloads`` has one row for each distinct payload (``address``, the SHA-256;
``n_bytes``; ``payload``).  ``headers`` has one row for each record: its exact header bytes (WARC fields and HTTP
header, up to the payload) and the address.  ``reconstruct`` verifies every stored payload against its address and
joins the two back into whole WARC records.  Of records with equal payloads of at least ``min_bytes`` that with the
largest ``page_id`` is the response, the others are revisits of it; smaller payloads are all responses.

Scale: the payloads are hashed and written where they are read; who is a response is decided on slim rows (id, url,
digests) by an aggregation that combines before its shuffle.  The rows that must not be written again are a staged
table, broadcast only while its counted rows are few.  Payload bytes are shuffled once, in ``reconstruct``; a payload
that a third of all records share meets them in a join that adaptive execution can split.

Defined results: a null html is an empty payload.  A null id is a record without an id of its own; it is a response
only if its whole group has none.  Rows that repeat id and payload are records of their own with the same type, and
the payload is still stored once.  A null url leaves out ``WARC-Target-URI``; line breaks in a url are percent-encoded.
An empty table makes an empty archive.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.llm.common import bounded, staged
from aurum.session import shared_path

MIN_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = "\r\n"


def base32(hexadecimal: Column) -> Column:
    """RFC 4648 base32, upper case, of a hexadecimal string whose length is a multiple of ten digits."""
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page_id: Column, address: Column) -> Column:
    h = F.md5(F.concat_ws(":", page_id.cast("string"), address).cast("binary"))
    parts = [F.substring(h, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))


def _header(date: str) -> Column:
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}"),
                    _line("Content-Length", F.col("n_bytes").cast("string")), F.lit(_CRLF))
    block = F.length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("address"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to"), F.col("address")))),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("X-Refers-To-Page-ID", F.when(revisit, F.col("refers_to").cast("string"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(_CRLF), http).cast("binary")


def write(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    """Archive ``pages`` (``page_id``, ``url``, ``html``) under ``path``."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")) \
        .withColumn("address", F.sha2("payload", 256))
    slim = staged(rows.select("page_id", "url", "address", F.octet_length("payload").cast("long").alias("n_bytes"),
                              base32(F.sha1("payload")).alias("sha1")), "warc_rows")
    groups = staged(slim.groupBy("address").agg(F.max("page_id").alias("response_id")), "warc_groups")
    revisit = ~F.col("page_id").eqNullSafe(F.col("response_id")) & (F.col("n_bytes") >= min_bytes)
    records = staged(slim.join(groups, "address").select(
        "page_id", "url", "address", "n_bytes", "sha1",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to")), "warc_records")
    records.select("page_id", "record_type", "address", "n_bytes", _header(date).alias("header")) \
        .write.option("compression", "zstd").parquet(f"{path}/headers")

    # rows whose payload another row writes, and payloads of several responses, of which one is written
    several = records.where("record_type = 'response'").groupBy("address").count().where("count > 1").select("address")
    special = staged(
        records.where("record_type = 'revisit'").select("page_id", "address", F.lit(False).alias("once")).distinct()
        .unionByName(records.where("record_type = 'response'").join(several, "address", "left_semi")
                     .select("page_id", "address", F.lit(True).alias("once")).distinct()), "warc_special")
    marked = rows.alias("r").join(
        bounded(special).alias("s"), F.expr("r.page_id <=> s.page_id and r.address = s.address"), "left") \
        .select("r.address", "r.payload", "s.once")
    store = marked.where("once is null").unionByName(marked.where("once").dropDuplicates(["address"]))
    store.select("address", F.octet_length("payload").cast("long").alias("n_bytes"), "payload") \
        .write.option("compression", "zstd").parquet(f"{path}/payloads")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """Every record from the archive: ``page_id, record_type, header, payload, record`` (the last three binary).

    ``payload`` is the full payload, of revisits too; ``record`` has it only if the record is a response.  A payload
    that does not have its stated digest or length fails the job.
    """
    stored = spark.read.schema("address string, n_bytes long, payload binary").parquet(f"{path}/payloads")
    good = (F.sha2("payload", 256) == F.col("address")) & (F.octet_length("payload") == F.col("n_bytes"))
    verified = stored.select("address", F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its address "), F.col("address"))).cast("binary"))
        .alias("payload"))
    headers = spark.read.parquet(f"{path}/headers")
    response = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return headers.join(verified, "address").select(
        "page_id", "record_type", "header", "payload",
        F.concat("header", response, F.lit(b"\r\n\r\n")).alias("record"))


def archived(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """What a fresh archive of ``pages`` says of each record, from the records read back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``."""
    spark = pages.sparkSession
    path = shared_path(spark, "llm", "warc")
    write(pages, path, min_bytes)
    header = F.decode("header", "UTF-8")
    kind = pages.schema["page_id"].dataType.simpleString()

    def named(name: str) -> Column:
        value = F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1)
        return F.when(value != "", value)

    digest = base32(F.sha1("payload"))
    checked = F.when(named("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), digest), digest).otherwise(
        F.raise_error(F.lit("a payload differs from the digest in its record's header")))
    return reconstruct(spark, path).select(
        named("X-Page-ID").cast(kind).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), checked.alias("payload_digest"),
        named("WARC-Type").alias("record_type"), named("X-Refers-To-Page-ID").cast(kind).alias("refers_to"))
