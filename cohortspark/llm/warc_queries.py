"""Query of the WARC archives. Base32 is not at hand in the SQL twin, so it is spelled out from the digest's bits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import query, table
from .warc import archive_pages, record_table

SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, t, octet_length(encode(t)) AS n, from_hex(sha1(t)) AS h, max(page_id) OVER (PARTITION BY t) AS top FROM p),
b AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
      list_sum(list_transform(range(0, 5), lambda j: ((instr('0123456789ABCDEF', substr(hex(h), CAST((5 * k + j) // 4 + 1 AS BIGINT), 1)) - 1) // CAST(pow(2, 3 - (5 * k + j) % 4) AS BIGINT)) % 2 * CAST(pow(2, 4 - j) AS BIGINT)))::BIGINT), 1)), '') AS s FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, s AS payload_digest, CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to FROM b
"""


@query("op2_warc", SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    archives, where = archive_pages(table(spark, folder, "pages"))
    return record_table(archives, where).withColumnRenamed("id", "page_id")
