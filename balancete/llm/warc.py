"""WARC (13): a content-addressed archive.

``write_archive`` makes a WARC record of every row and writes two tables below a folder:

* ``payloads`` (digest, payload): the bytes of each distinct payload once, under their
  SHA-256. Rows of one digest must also agree in length and in a second, independent hash,
  or the write fails.
* ``headers`` (header, digest, and the row's id): the exact bytes of every record up to its
  payload, the WARC header and the HTTP header.

``read_archive`` hashes each stored payload again (a payload that does not match its digest
fails the read), parses the headers, and joins the two on the digest; ``record`` is the
original record, header, payload and the closing line ends. Of records with equal payloads of
``min_revisit_bytes`` or more the one with the smallest id is the response, the others are
revisits that name it. ``write_warc`` writes the records as WARC text files, revisits without
their payload.

The index of the rows (id, URL, digest, length) is narrow and is shuffled; the payloads are
shuffled once, reduced to one per digest and task. A payload that a third of the rows hold is
one row per task in every aggregation, and AQE splits the joins on the digest, whose small
side has been written out before.

Defined results:
* null payload: empty; empty payloads and those under the limit are all responses;
* equal payloads under a repeated smallest id: one of those rows is the response, the others
  revisit it; a null id comes after all others, and a revisit of it names null;
* null URL: a record without ``WARC-Target-URI``; line ends and blanks in a URL are
  percent-encoded, so that a URL cannot end the header;
* the payload is bytes of any length up to Spark's limit of one value; text counts as UTF-8;
* empty table: an archive of two empty tables; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_shared, shared_scratch_path
from .common import checkpoint

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"

MIN_REVISIT_BYTES = 100


def _lines(*fields: tuple[str, Column | None]) -> Column:
    """Header lines; a field whose value is null is left out (``concat_ws`` skips nulls)."""
    return F.concat_ws(EOL, *[F.concat(F.lit(f"{name}: "), value) for name, value in fields])


def _uri(url: Column) -> Column:
    """The URL with its blanks and control characters percent-encoded."""
    bad = r"[\x00-\x20\x7F]"
    coded = F.array_join(F.transform(F.split(url, ""), lambda c: F.when(
        c.rlike(bad), F.concat(F.lit("%"), F.hex(c))).otherwise(c)), "")
    return F.when(url.rlike(bad), coded).otherwise(url)


def _record_id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in (
        (1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _rows(df: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                     payload.alias("payload")).withColumns(
        {"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})


def write_archive(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES,
                  date: str = "1970-01-01T00:00:00Z", content_type: str = "text/html; charset=utf-8") -> None:
    """Write ``headers`` and ``payloads`` below ``path`` (a shared folder)."""
    rows = _rows(df, id_col, url_col, payload_col)
    index = checkpoint(rows.select("id", "url", "digest", "n_bytes", F.xxhash64("payload").alias("check"))
                       .withColumn("seq", F.monotonically_increasing_id()))
    groups = index.groupBy("digest").agg(
        F.count("*").alias("n"), F.min("n_bytes").alias("least"), F.max("n_bytes").alias("most"),
        F.min("check").alias("low"), F.max("check").alias("high"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "seq", "url")).alias("first")).where("n > 1")
    # Written out, so that AQE can split the rows of a hot digest in the join below.
    groups = checkpoint(groups.withColumn("sound", (F.col("least") == F.col("most")) & (F.col("low") == F.col("high"))))
    if groups.where(~F.col("sound")).limit(1).count():
        raise ValueError("two payloads differ under one SHA-256 digest")
    first = groups.where(F.col("least") >= min_revisit_bytes).select(
        F.col("digest").alias("_digest"), F.col("first.id").alias("first_id"), F.col("first.seq").alias("first_seq"),
        F.col("first.url").alias("first_url"))
    h = index.join(first, F.col("digest") == F.col("_digest"), "left").withColumn(
        "revisit", F.col("first_seq").isNotNull() & (F.col("first_seq") != F.col("seq")))
    refers = lambda value: F.when(F.col("revisit"), value)
    http = F.concat(_lines(("HTTP/1.1 200 OK" + EOL + "Content-Type", F.lit(content_type)),
                           ("Content-Length", F.col("n_bytes").cast("string"))), F.lit(EOL * 2))
    h = h.withColumn("http", http)
    block = F.octet_length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("n_bytes"))
    warc = F.concat(F.lit(VERSION + EOL), _lines(
        ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID", _record_id(F.col("id"), F.col("digest"), F.col("seq"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", _uri(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Refers-To", refers(_record_id(F.col("first_id"), F.col("digest"), F.col("first_seq")))),
        ("WARC-Refers-To-Target-URI", refers(_uri(F.col("first_url")))),
        ("WARC-Profile", refers(F.lit(REVISIT_PROFILE))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", block.cast("string"))), F.lit(EOL * 2))
    h.select("id", F.when(F.col("revisit"), F.col("first_id")).alias("first_id"), "digest",
             F.encode(F.concat(warc, "http"), "UTF-8").alias("header")).write.parquet(f"{path}/headers")
    # One row per digest and task goes to the shuffle.
    rows.groupBy("digest").agg(F.any_value("payload").alias("payload")).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: id, record_type, record_id, target_uri, payload_digest, payload_bytes,
    refers_to (id of the response), refers_to_record, header, payload, record (the original)."""
    store = spark.read.parquet(f"{path}/payloads")
    # Checked before the join and once per payload: without the payload only the results travel.
    real = F.sha2("payload", 256)
    store = store.select(F.col("digest").alias("_digest"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                         F.when(real == F.col("digest"), real).otherwise(F.raise_error(F.concat(
                             F.lit("payload does not match its digest "), "digest"))).alias("payload_digest"))
    heads = spark.read.parquet(f"{path}/headers").withColumn("_text", F.decode("header", "UTF-8"))
    field = F.str_to_map(F.substring_index("_text", EOL * 2, 1), F.lit(EOL), F.lit(": "))
    heads = heads.select("id", "first_id", "header", field.alias("_f"))
    heads = heads.withColumn("_digest", F.substring(F.col("_f")["WARC-Payload-Digest"], 8, 64))
    j = heads.join(store, "_digest", "left")
    get = lambda name: F.col("_f")[name]
    return j.select(
        "id", get("WARC-Type").alias("record_type"), get("WARC-Record-ID").alias("record_id"),
        get("WARC-Target-URI").alias("target_uri"), "payload_digest", "payload_bytes",
        F.when(get("WARC-Type") == "revisit", F.col("first_id")).alias("refers_to"),
        get("WARC-Refers-To").alias("refers_to_record"), "header", "payload",
        F.concat("header", "payload", F.lit(b"\r\n\r\n")).alias("record"))


def write_warc(archive: DataFrame, path: str) -> None:
    """The records of ``read_archive`` as WARC files, byte by byte, one per task. For payloads
    that are UTF-8 text (Spark writes text only): others fail."""
    payload = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    text = F.decode(F.concat("header", payload), "UTF-8")
    archive.select(text.alias("value")).write.option("lineSep", EOL * 2).text(path)


def warc(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
         min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the archive, read it back, and return its records without their bytes."""
    spark = df.sparkSession
    path = shared_scratch_path(spark, "warc")
    write_archive(df, path, id_col, url_col, payload_col, min_revisit_bytes)
    out = checkpoint(read_archive(spark, path).drop("header", "payload", "record"))
    remove_shared(spark, path)
    return out
