"""Queries of the operators that run on DataFrame functions alone, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.llm.decontamination import report
from ledgerlark.llm.mixing import mix
from ledgerlark.llm.registry import query, read
from ledgerlark.llm.sharding import place

SHARDS = [f"shard-{i:03d}" for i in range(16)]
SLOTS = 2053

# The line of a source is cut at its target, so the SQL needs no slots: a row
# gives the words that lie before the cut, in the first and the second reading.
MIX_SQL = r"""
WITH counted AS (
  SELECT doc_id, source,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS shuffled,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents
), sized AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM counted GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
            WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized
), ordered AS (
  SELECT *, 2.0::DOUBLE * source_size::DOUBLE AS cap,
         row_number() OVER (ORDER BY (2.0::DOUBLE * source_size::DOUBLE) / weight, source ASC NULLS LAST) AS place
  FROM weighed
), levels AS (
  SELECT a.place,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM sized)::DOUBLE
          - coalesce(sum(b.cap) FILTER (WHERE b.place < a.place), 0.0::DOUBLE))
         / sum(b.weight) FILTER (WHERE b.place >= a.place) AS level
  FROM ordered a JOIN ordered b ON true GROUP BY a.place
), targeted AS (
  SELECT source, source_size, least(cap, (SELECT max(level) FROM levels) * weight) AS target FROM ordered
), placed AS (
  SELECT c.doc_id, c.size, t.source_size, t.target, floor(t.target)::BIGINT AS tokens,
         coalesce(sum(c.size) OVER (PARTITION BY c.source ORDER BY c.shuffled, c.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM counted c JOIN targeted t ON c.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(0, least(start + size, tokens) - start)
        + greatest(0, least(source_size + start + size, tokens) - source_size - start))::BIGINT AS taken
FROM placed
"""


@query("op2_mix_sources", MIX_SQL)
def mix_sources(spark, folder):
    """All documents mixed by source, 5 : 2 : 1, at 150 % of their words."""
    return mix(read(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# The table is filled here turn by turn: a turn claims the first slot in the
# shard's preference order that no earlier turn has claimed.
SHARD_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT i AS shard, ('0x' || substr(md5('shard-' || lpad(i::VARCHAR, 3, '0') || ':offset'), 1, 15))::BIGINT % {SLOTS} AS first,
         ('0x' || substr(md5('shard-' || lpad(i::VARCHAR, 3, '0') || ':skip'), 1, 15))::BIGINT % ({SLOTS} - 1) + 1 AS skip
  FROM range({len(SHARDS)}) t(i)
), preferences AS (
  SELECT list(list_transform(range({SLOTS}), lambda k: (first + k * skip) % {SLOTS}) ORDER BY shard) AS wanted FROM shards
), turns(turn, slot, claimed) AS (
  SELECT 0::BIGINT, wanted[1][1], list_transform(range({SLOTS}), lambda s: s = wanted[1][1]) FROM preferences
  UNION ALL
  SELECT turn + 1, next, list_transform(claimed, lambda taken, s: taken OR s - 1 = next)
  FROM (
    SELECT turn, claimed,
           list_filter(wanted[(turn + 1) % {len(SHARDS)} + 1], lambda s: NOT claimed[s + 1])[1] AS next
    FROM turns, preferences WHERE turn + 1 < {SLOTS}
  )
), filled AS (SELECT slot::INTEGER AS slot, (turn % {len(SHARDS)})::INTEGER AS shard FROM turns)
SELECT d.doc_id, f.slot, f.shard
FROM documents d
JOIN filled f ON f.slot = coalesce(('0x' || substr(md5(d.doc_id::VARCHAR), 1, 15))::BIGINT % {SLOTS}, 0)
"""


@query("op3_place_on_shards", SHARD_SQL)
def place_on_shards(spark, folder):
    """The shard of every document."""
    docs = read(spark, folder, "documents").select("doc_id")
    return place(docs, SHARDS, SLOTS, F.col("doc_id")).select("doc_id", "slot", "shard")


DECONTAMINATION_SQL = r"""
WITH item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item, list_slice(words, pos, pos + least(len(words), 10) - 1) AS words
  FROM (SELECT item, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS pos FROM item WHERE len(words) > 0)
), doc AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
), spot AS (
  SELECT row_no, pos, list_slice(words, pos, pos + span - 1) AS words, span
  FROM (SELECT row_no, words, span, unnest(range(1, len(words) - span + 2)) AS pos
        FROM doc, (SELECT DISTINCT len(words) AS span FROM item_window) WHERE len(words) >= span)
), hit AS (
  SELECT row_no, pos, span, item FROM spot JOIN item_window USING (words)
), covered AS (
  SELECT row_no, count(DISTINCT word) AS n_hit
  FROM (SELECT row_no, unnest(range(pos, pos + span)) AS word FROM hit) GROUP BY row_no
), named AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_no, item FROM hit) GROUP BY row_no
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN covered USING (row_no) LEFT JOIN named USING (row_no)
"""


@query("op5_decontaminate", DECONTAMINATION_SQL)
def decontaminate(spark, folder):
    """Words of every document that lie in a ten-word window of a benchmark item."""
    return report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
