"""Queries of personal data, ranked search and phrases, with their SQL where SQL can say the same."""

from __future__ import annotations

from ledgerlark.llm import personal_data, phrases, ranked_search
from ledgerlark.llm.registry import query, read


@query("op11_personal_data")
def personal_spans(spark, folder):
    """Plain and disguised identifiers of every document, as spans in code points."""
    return personal_data.report(read(spark, folder, "documents"))


SEARCH_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), item AS (
  SELECT row_number() OVER () AS item_no, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark
), total AS (
  SELECT count(*)::BIGINT AS documents, sum(len(terms))::BIGINT AS words FROM doc WHERE len(terms) > 0
), asked AS (
  SELECT item_no, term, count(*)::BIGINT AS times FROM (SELECT item_no, unnest(terms) AS term FROM item) GROUP BY ALL
), held AS (
  SELECT row_no, term, count(*)::BIGINT AS tf
  FROM (SELECT row_no, unnest(terms) AS term FROM doc) SEMI JOIN asked USING (term) GROUP BY ALL
), weighed AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM held, total GROUP BY term, documents
), impact AS (
  SELECT row_no, doc_id, term,
         weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(terms) * documents) // words))) AS impact
  FROM held JOIN weighed USING (term) JOIN doc USING (row_no), total
), scored AS (
  SELECT item_no, row_no, doc_id, sum(times * impact)::BIGINT AS score
  FROM asked JOIN impact USING (term) GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id ASC NULLS FIRST) AS place
  FROM scored WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked JOIN item USING (item_no) WHERE place <= 10
"""


@query("op12_ranked_search", SEARCH_SQL)
def best_documents(spark, folder):
    """The ten best documents for every benchmark item."""
    return ranked_search.rank(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


PHRASE_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), line AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM piece
), gram AS (
  SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2),
                            lambda pos: array_to_string(list_slice(words, pos, pos + size - 1), ' '))) AS phrase
  FROM line, range(1, 5) AS sizes(size) WHERE len(words) >= size
), counted AS (
  SELECT lang, size, phrase, count(*)::BIGINT AS f FROM gram GROUP BY ALL
), total AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
), candidate AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM counted WHERE size >= 2 AND f >= 30
), cut AS (
  SELECT lang, phrase, size, a, k, array_to_string(list_slice(words, 1, k), ' ') AS first,
         array_to_string(list_slice(words, k + 1, size), ' ') AS rest
  FROM candidate, range(1, 4) AS cuts(k) WHERE k < size
), scored AS (
  SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, k,
         ((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f::HUGEINT))::BIGINT AS score
  FROM cut JOIN counted x ON x.lang = cut.lang AND x.phrase = first JOIN counted y ON y.lang = cut.lang AND y.phrase = rest
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(list_slice(words, pos, pos + short - 1), ' ') AS phrase, max(a) AS around
  FROM candidate, range(2, 4) AS shorts(short), range(1, 4) AS places(pos)
  WHERE short < size AND pos + short - 1 <= size GROUP BY ALL
), kept AS (
  SELECT w.* FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE i.around IS NULL OR 100 * i.around::HUGEINT < 80 * a::HUGEINT
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase ASC) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", PHRASE_SQL)
def collocations(spark, folder):
    """The 2000 best phrases of every language."""
    return phrases.collocations(read(spark, folder, "documents"))
