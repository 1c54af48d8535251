"""A content-addressed WARC archive: payloads once by strong digest, exact record headers apart.

``headers``: one row per record, its header block byte for byte. ``payloads``: each distinct payload
once, under its SHA-256. Records are put together again by a join on the digest. Payloads are verified when written
(all rows of a digest agree in length and in a second, independent hash) and when read (digest and
length recomputed from the stored bytes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quotegrid.session import stage, working_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
HEADERS_SCHEMA = "page_id long, url string, digest string, header binary"
PAYLOADS_SCHEMA = "digest string, payload binary"


def base32(hex_digest: Column, chars: int = 40) -> Column:
    """Upper-case base32 of a hex digest whose bits divide by 20: five hex digits make four letters."""
    letters = []
    for i in range(0, chars, 5):
        bits = F.conv(F.substring(hex_digest, i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def record_id(page_id: Column, url: Column, digest: Column) -> Column:
    """A name-based UUID of the record: the same pages give the same ids."""
    h = F.sha2(F.concat_ws("\x00", page_id.cast("string"), url, digest), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write(pages: DataFrame, path: str, min_revisit_bytes: int = 0, captured: str = "2000-01-01T00:00:00Z",
          key: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Write the archive of ``pages`` below ``path``.

    Of the records with equal payloads of at least ``min_revisit_bytes`` bytes, those of the largest key
    are responses and the others revisit it; smaller payloads are all responses. NULL html is an empty
    payload. Rows without a key never are the target; if all rows of a payload lack one, all are responses. Rows repeated with key and
    payload are alike: all responses or all revisits. Line ends in a url are percent-encoded in the header. Columns
    other than the three named are not read.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # every payload byte is shuffled once: copies within a task are merged before
    store = rows.groupBy("digest").agg(F.any_value("payload").alias("payload"))
    store.write.parquet(f"{path}/payloads")
    narrow = stage(rows.select(
        "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("n_bytes"),
        base32(F.sha1("payload")).alias("sha1"), F.xxhash64("payload").alias("check")), "warc-rows")
    targets = narrow.groupBy("digest").agg(
        F.max("page_id").alias("target_page"), F.max_by("url", "page_id").alias("target_url"), F.min("n_bytes").alias("least"),
        F.max("n_bytes").alias("most"), F.min("check").alias("check_a"), F.max("check").alias("check_b"))
    targets = targets.select(
        "digest", "target_url", F.when((F.col("least") == F.col("most")) & (F.col("check_a") == F.col("check_b")), F.col("target_page"))
        .otherwise(F.raise_error(F.concat(F.lit("different payloads with digest "), F.col("digest"))).cast("long")).alias("target_page"))
    revisits = (F.col("n_bytes") >= min_revisit_bytes) & F.col("target_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target_page"))
    safe = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    common = [
        _line("WARC-Record-ID", record_id(F.col("page_id"), F.col("url"), F.col("digest"))), _line("WARC-Date", F.lit(captured)),
        _line("WARC-Target-URI", safe), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
    ]
    response = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: response{CRLF}"), *common,
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", (F.length(_http()) + F.col("n_bytes")).cast("string")), F.lit(CRLF))
    revisit = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: revisit{CRLF}"), *common,
        _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("WARC-Refers-To", record_id(F.col("target_page"), F.col("target_url"), F.col("digest"))),
        _line("X-Refers-To-Page-ID", F.col("target_page").cast("string")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.length(_http()).cast("string")), F.lit(CRLF))
    header = F.concat(F.when(revisits, revisit).otherwise(response), _http()).cast("binary")
    narrow.join(targets, "digest").select("page_id", "url", "digest", header.alias("header")).write.parquet(f"{path}/headers")
    return path


def _http() -> Column:
    return F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n_bytes").cast("string"), F.lit(f"{CRLF}{CRLF}"))


def _field(name: str) -> Column:
    got = F.regexp_extract(F.col("head"), rf"(?:^|\r\n){name}: ([^\r]*)\r\n", 1)
    return F.when(got != "", got)


def verified_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads with digest, length and SHA-1 recomputed; a wrong digest is an error."""
    rows = spark.read.schema(PAYLOADS_SCHEMA).parquet(f"{path}/payloads")
    sound = F.sha2("payload", 256) == F.col("digest")
    return rows.select(
        F.when(sound, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))).alias("digest"),
        "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records again: fields parsed off the stored headers, joined with their payloads.

    Columns page_id, url, record_type, refers_to, header, payload, payload_bytes, payload_digest. A
    header whose digest line differs from the payload's is an error. Columns not asked for are not shuffled.
    """
    head = spark.read.schema(HEADERS_SCHEMA).parquet(f"{path}/headers").withColumn("head", F.col("header").cast("string")).select(
        "page_id", "url", "digest", "header", _field("WARC-Type").alias("record_type"),
        _field("X-Refers-To-Page-ID").cast("long").alias("refers_to"), _field("WARC-Payload-Digest").alias("stated"))
    rows = head.join(verified_payloads(spark, path), "digest")
    good = F.col("stated") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    return rows.select(
        "page_id", "url", "record_type", "refers_to", "header", "payload", "payload_bytes",
        F.when(good, F.col("payload_digest")).otherwise(F.raise_error(F.lit("header and payload do not belong together"))).alias("payload_digest"))


def originals(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record: the bytes of every record as archived, a revisit without its payload."""
    end = F.lit(f"{CRLF}{CRLF}").cast("binary")
    return read(spark, path).select("page_id", F.concat(
        "header", F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b"")), end).alias("record"))


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write an archive of ``pages`` in the shared folder and read it back."""
    spark = pages.sparkSession
    return read(spark, write(pages, working_path(spark, "warc"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLE = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
t AS (SELECT body, max(page_id) AS target, sha1(body) AS hex FROM p GROUP BY body)
SELECT p.page_id, CAST(octet_length(encode(p.body)) AS bigint) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST(((('0x' || substr(t.hex, 5 * CAST(i // 4 AS int) + 1, 5))::bigint >> (15 - 5 * CAST(i % 4 AS int))) & 31) AS int), 1)), '') AS payload_digest,
       CASE WHEN p.page_id = t.target OR t.target IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> t.target OR p.page_id IS NULL THEN t.target END AS refers_to, p.url
FROM p JOIN t ON p.body = t.body
"""
