"""SQL that gives the rows of those queries which SQL can express, over whole tables and texts."""

from __future__ import annotations

from tallywatch.llm.divergence import LEAST_DOCUMENTS, SMOOTHING, TOP
from tallywatch.llm.near import COMMON, SHINGLE, SIMILARITY
from tallywatch.llm.repeats import LENGTH
from tallywatch.llm.secrets import BASE_RULES, RULES, Rule

WORDS = """words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)"""

SHARED_PASSAGES = f"""WITH {WORDS},
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {LENGTH - 1}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {LENGTH - 2})) AS i FROM words WHERE len(w) >= {LENGTH})),
owners AS (SELECT h, min(doc_id) AS low FROM windows GROUP BY h),
covered AS (
  SELECT DISTINCT doc_id, i + k AS place
  FROM (SELECT doc_id, i, unnest(range({LENGTH})) AS k FROM windows JOIN owners USING (h) WHERE low < doc_id)),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
kept AS (
  SELECT doc_id, count(c.place) AS n_removed,
         coalesce(string_agg(p.word, ' ' ORDER BY p.place) FILTER (WHERE c.place IS NULL), '') AS left_over
  FROM placed p LEFT JOIN covered c USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

NEAR_DUPLICATES = f"""WITH RECURSIVE {WORDS},
found AS (
  SELECT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM words WHERE len(w) > 0)),
counted AS (SELECT doc_id, s, count(*) AS tf FROM found GROUP BY ALL),
spread AS (
  SELECT s, count(*) AS df, 1 + ln(1 / greatest(count(*) / (SELECT count(*) FROM documents), {COMMON})) AS idf
  FROM counted GROUP BY s),
weighted AS (SELECT doc_id, s, tf * idf AS weight, df FROM counted JOIN spread USING (s)),
total AS (SELECT doc_id, sum(weight) AS weight FROM weighted GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.weight, b.weight)) AS weight
  FROM weighted a JOIN weighted b ON a.s = b.s AND a.doc_id < b.doc_id WHERE a.df > 1 AND b.df > 1 GROUP BY ALL),
links AS (
  SELECT a, b FROM shared s JOIN total x ON x.doc_id = a JOIN total y ON y.doc_id = b
  WHERE s.weight / (x.weight + y.weight - s.weight) >= {SIMILARITY} - 1e-9),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT a, b FROM ways UNION SELECT r.doc_id, e.b FROM reached r JOIN ways e ON e.a = r.other)
SELECT d.doc_id, least(d.doc_id, min(r.other)) AS class_id
FROM documents d LEFT JOIN reached r USING (doc_id) GROUP BY d.doc_id"""


def _spans(place: int, rule: Rule) -> str:
    """Counting matches of a rule as (doc_id, kind, place, start, stop)."""
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, '{rule.name}' AS kind, {place} AS place, stop - size AS start, stop
  FROM (SELECT doc_id, length(m) AS size, length(regexp_extract(m, '{pattern}', {rule.part})) AS counted,
               sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
        FROM (SELECT doc_id, unnest(found) AS m, unnest(string_split_regex(text, '{pattern}')[1:len(found)]) AS gap,
                     unnest(range(len(found))) AS i
              FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS found FROM texts)))
  WHERE counted >= {rule.least}"""


_LISTED = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place){}, '')"

SECRETS = f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_spans(i, r) for i, r in enumerate(RULES))}),
summed AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{r.name}') AS n_{r.name}" for r in BASE_RULES)},
         {_LISTED.format(f" FILTER (WHERE place < {len(BASE_RULES)})")} AS base, {_LISTED.format("")} AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.name}, 0) AS n_{r.name}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN summed USING (doc_id)"""


def _share(count: str, total: str) -> str:
    return f"(1 + 1000000000::HUGEINT * ({count} + {SMOOTHING}) // ({total} + {SMOOTHING} * terms))::BIGINT"


DIVERGENCE = f"""WITH rows AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
found AS (
  SELECT r, lang, source, translate(m, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS m FROM rows)),
counted AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM found GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::BIGINT AS lang_n FROM counted GROUP BY ALL HAVING sum(docs) >= {LEAST_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS terms, sum(lang_n)::BIGINT AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM rows),
dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, lang_n, terms, lang_total, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counted USING (lang, source, term)),
shares AS (SELECT *, {_share("n", "total")} AS p, {_share("lang_n", "lang_total")} AS q FROM dense),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source),
ahead AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM ahead))
WHERE part = 'pair' OR rank <= {TOP}"""

NEGATIVES = """WITH plain AS (
  SELECT vec_id::BIGINT AS id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM (SELECT DISTINCT vec_id, label, embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
  FROM plain a JOIN plain b ON a.id % 100 = 0 AND (a.id <> b.id OR a.label <> b.label)),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same AND anchor_id <> id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""
