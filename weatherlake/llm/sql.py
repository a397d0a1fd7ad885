"""SQL for DuckDB that gives the rows of the queries which SQL can express."""

from __future__ import annotations

import string

from weatherlake.llm import quality, secret_scan

EXACT_DEDUP = f"""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS norm FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY norm)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _left(pattern: str) -> str:
    return f"length(regexp_replace(text, {_quoted(pattern)}, '', 'g'))"


def _common(lang: str, words: list[str]) -> str:
    counts = [f"(strlen(spaced) - strlen(replace(spaced, ' {w} ', ''))) // {len(f' {w} '.encode())}" for w in words]
    return f"WHEN lang = '{lang}' THEN [{', '.join(counts)}]"


def _distance(left: str, right: str) -> str:
    p, q = f"({left}[i] / n_{left})", f"({right}[i] / n_{right})"
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0 END"
    return f"sqrt(greatest(list_sum([{part(p)} + {part(q)} FOR i IN range(1, len({left}) + 1)]) / 2, 0))"


def _sums(name: str, bins: int) -> str:
    return f"[{', '.join(f'sum({name}[{i + 1}])' for i in range(bins))}]"


QUALITY = f"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS words
  FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 4], ' ')) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM texts)
), repeats AS (
  SELECT doc_id, sum(least(5, next - i)) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i, 1, i + 5) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM windows WHERE n > 1)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), classes AS (
  SELECT doc_id, lang, text, words, [{', '.join(_left(p) for p in quality.NOT_IN_CLASS.values())}] AS known,
         ' ' || regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || ' ' AS spaced
  FROM texts
), common AS (
  SELECT doc_id, lang, words, text, known || [length(text) - list_sum(known)::BIGINT] AS class_counts,
         length(spaced) - length(replace(spaced, '  ', ' ')) + 1 AS n_spaced,
         CASE {' '.join(_common(lang, words) for lang, words in quality.COMMON_WORDS.items())} END AS found
  FROM classes
), counted AS (
  SELECT doc_id, lang, len(words) AS n_words, length(text) - class_counts[{quality.CLASSES.index("blank") + 1}] AS word_chars,
         class_counts[{quality.CLASSES.index("symbol") + 1}] AS n_symbols, class_counts,
         CASE WHEN found IS NOT NULL THEN found || [n_spaced - list_sum(found)::BIGINT] END AS word_counts
  FROM common
), languages AS (
  SELECT lang AS r_lang, count(*) AS r_docs, {_sums("class_counts", len(quality.CLASSES))} AS r_class,
         {_sums("word_counts", quality.N_COMMON + 1)} AS r_word
  FROM counted GROUP BY lang
), measured AS (
  SELECT *, coalesce(n_repeat_words, 0)::BIGINT AS repeat_words, coalesce(n_dup_lines, 0) AS dup_lines,
         list_sum(class_counts) AS n_class_counts, list_sum(word_counts) AS n_word_counts,
         list_sum(r_class) AS n_r_class, list_sum(r_word) AS n_r_word, [{"0, " * quality.N_COMMON}1] AS bare, 1 AS n_bare
  FROM counted LEFT JOIN languages ON lang IS NOT DISTINCT FROM r_lang LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)
), judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, dup_lines AS n_dup_lines, repeat_words AS n_repeat_words,
         n_words < {quality.MIN_WORDS} OR 100 * repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         CASE WHEN r_docs >= {quality.MIN_REFERENCE_DOCS} AND n_class_counts >= {quality.MIN_CLASS_CHARS}
              THEN round({_distance("class_counts", "r_class")}, 6) END AS class_distance,
         CASE WHEN r_docs >= {quality.MIN_REFERENCE_DOCS} AND n_word_counts >= {quality.MIN_HISTOGRAM_WORDS}
                   AND n_word_counts * (1 - r_word[{quality.N_COMMON + 1}] / n_r_word) >= {quality.MIN_EXPECTED_COMMON}
              THEN round({_distance("word_counts", "r_word")}, 6) END AS word_distance,
         round({quality.MAX_WORD_SHARE} * {_distance("bare", "r_word")}, 6) AS word_limit
  FROM measured
)
SELECT * EXCLUDE (word_limit), NOT base_failed AND NOT (coalesce(class_distance > {quality.MAX_CLASS_DISTANCE}, false)
       OR coalesce(word_distance > word_limit, false)) AS kept
FROM judged
"""

SOURCE_AUDIT = r"""WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
terms AS (
  SELECT rid, lang, source,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total FROM grp LEFT JOIN cells USING (lang, source) GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p,
    1 + 1000000000 * (k.n + 1) // (l.total + l.v) AS q
  FROM totals g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM both_parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= 200"""


def _spans(place: int, rule: secret_scan.Rule) -> str:
    """rid, place, kind, start, stop of a rule's matches: the lengths of the parts between matches and of the matches add up."""
    pattern = _quoted(rule.pattern)
    return f"""SELECT rid, {place} AS place, '{rule.kind}' AS kind, start, start + length(match) AS stop FROM (
    SELECT rid, match, sum(length(part) + length(match)) OVER (PARTITION BY rid ORDER BY i) - length(match) AS start
    FROM (SELECT rid, unnest(range(1, len(matches) + 1)) AS i, unnest(matches) AS match, unnest(parts[1:len(matches)]) AS part
      FROM (SELECT rid, regexp_extract_all(text, {pattern}) AS matches, string_split_regex(text, {pattern}) AS parts FROM docs)))
  WHERE length(regexp_extract(match, {pattern}, {rule.group})) >= {rule.least}"""


_BASE = len(secret_scan.BASE)
_written = "coalesce(string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, place){}, '')"
SECRETS = f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_spans(i, rule) for i, rule in enumerate(secret_scan.RULES))})
SELECT doc_id, sha256(any_value(text)) AS blob,
  {", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in secret_scan.RULES)},
  sha256({_written.format(f" FILTER (place < {_BASE})")}) AS base_sha256, {_written.format("")} AS spans
FROM docs LEFT JOIN spans USING (rid) GROUP BY rid, doc_id"""
