"""Content-addressed web archive.

An archive is two Parquet tables in a folder: ``payloads`` has each distinct payload once under its SHA-256,
``headers`` has the exact header bytes of every record and the key of its payload. A record's original bytes are the
join of the two. All of it is DataFrame functions; payload bytes are shuffled once, after equal ones of a task met.

Rows of one digest are merged by comparing their bytes; two payloads with one SHA-256 would end the job. Nulls: a null body is an empty payload, a null url an
empty ``WARC-Target-URI``. Rows with a null id are written too; they are responses unless a row with an id has the same payload. Ties: rows that repeat an id and
its payload repeat its record, and count as the response if theirs is the largest id. Line breaks in a url are percent-encoded, as a header has none. Other
columns are not read, so none can clash. An empty table gives an empty archive; payloads may have any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.llm.common import stored

CRLF = "\r\n"
# Fixed value: the profile of revisit records with equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads under this size are never written as revisits.
REVISIT_MIN_BYTES = 1000
#: The tables have no capture time; records carry this one unless another is given.
NO_DATE = "1970-01-01T00:00:00Z"


def _line(name: str, value: Column) -> Column:
    text = F.replace(F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(f"{name}: "), text, F.lit(CRLF))


def _record_id(key: Column) -> Column:
    """Names a record by its row's id and its payload's digest, which records that refer to it share."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(":"), F.col("sha1"), F.lit(">"))


def write_archive(pages: DataFrame, path: str, *, id_col: str = "page_id", uri_col: str = "url", body_col: str = "html", min_bytes: int = REVISIT_MIN_BYTES, date: str = NO_DATE) -> str:
    """Write one record per row under ``path``. Of equal payloads of ``min_bytes`` or more the one with the largest id
    is the response, the others revisit it."""
    body = F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8")
    base = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), body.alias("payload")).withColumns({"digest": F.sha2("payload", 256), "sha1": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    owners = stored(base.groupBy("digest").agg(F.max("id").alias("owner")), f"{path}/owners")
    revisit = (F.col("bytes") >= min_bytes) & F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    kind = F.when(revisit, "revisit").otherwise("response")
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id(F.col("id"))),
        _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(PROFILE)), _line("WARC-Refers-To", _record_id(F.col("owner"))))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))),
        F.lit(CRLF),
    )
    base.select("id", "uri", "digest", "sha1", "bytes").join(owners, "digest").select("id", "digest", F.encode(header, "UTF-8").alias("header")).write.parquet(f"{path}/headers")
    # Equal digests are merged where their bytes are equal too.
    kept = stored(base.select("digest", "payload").distinct(), f"{path}/payloads")
    if kept.groupBy("digest").count().filter("count > 1").limit(1).count():
        raise ValueError("different payloads with one SHA-256")
    return path


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The payload store, each payload hashed anew; one that doesn't match its key ends the job."""
    found = spark.read.parquet(f"{path}/payloads")
    key = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("digest"))))
    return found.select(key.alias("digest"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))


def _field(name: str) -> Column:
    return F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: what its header says, its payload, and ``record``, the bytes of the whole record.

    A column that isn't selected costs nothing: without ``payload`` and ``record`` the join moves digests only."""
    heads = spark.read.parquet(f"{path}/headers")
    joined = heads.join(read_payloads(spark, path), "digest")
    kind = _field("WARC-Type")
    block = F.when(kind == "revisit", F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    return joined.select(
        "id",
        kind.alias("record_type"),
        _field("WARC-Target-URI").alias("uri"),
        F.nullif(F.regexp_extract(_field("WARC-Refers-To"), r"<urn:page:(-?\d+):", 1), F.lit("")).cast("long").alias("refers_to"),
        "payload_bytes",
        "payload_digest",
        (_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))).alias("digest_agrees"),
        "payload",
        F.concat("header", block, F.encode(F.lit(CRLF * 2), "UTF-8")).alias("record"),
    )
