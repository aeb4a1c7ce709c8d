"""The query of the archive operator, with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.llm.archives import round_trip
from ledgerlark.llm.registry import query, read

ARCHIVE_SQL = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), sized AS (
  SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM page
), stored AS (
  SELECT payload_digest, max(page_id) AS first FROM sized WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id OR page_id IS NULL THEN first END AS refers_to
FROM sized LEFT JOIN stored USING (payload_digest)
"""


@query("op1_capture_index", ARCHIVE_SQL)
def capture_index(spark, folder):
    """All pages written to archives, in the order of the merged index.

    The table has no capture time; the id in seconds after 2024-01-01 stands for it.
    """
    pages = read(spark, folder, "pages")
    found = round_trip(pages, F.lit(1_704_067_200) + F.col("page_id"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
