"""The query of quality rules in SQL: counts by words and windows, expectation-maximisation by recursion over patterns."""

from __future__ import annotations

from ledgerline.llm.common import NOT_WHITE, WHITE
from ledgerline.llm.quality_rules import BAD_PRIOR, BASE_FAILED, GOOD_PRIOR, LEAST, ROUNDS, RULES, SETTLED, SHARE, STRENGTH

_VOTES = [f"d{j}" for j in range(len(RULES))]
_COLUMNS = ", ".join(_VOTES)
_CAST = ", ".join(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END AS d{j}" for j, (_, bad, good) in enumerate(RULES))


def _how_many(vote: int) -> str:
    return "(" + " + ".join(f"({d} = {vote})::INT" for d in _VOTES) + ")"


def _rate(vote: str, mass: str, prior: tuple[float, ...]) -> str:
    own = f"CASE {vote} WHEN 0 THEN {prior[0]} WHEN 1 THEN {prior[1]} ELSE {prior[2]} END"
    return f"ln((weight * {own} + sum({mass}) OVER (PARTITION BY {vote})) / (sum({mass}) OVER () + weight))"


_ODDS = " + ".join(f"{_rate(d, 'good', GOOD_PRIOR)} - {_rate(d, 'bad', BAD_PRIOR)}" for d in _VOTES)

OP9_SQL = f"""WITH RECURSIVE texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
 parts AS (SELECT *, list_filter(regexp_split_to_array(t, '{WHITE}+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{NOT_WHITE}')) AS l FROM texts),
 placed AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM parts),
 windows AS (SELECT r, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g
  FROM placed WINDOW o AS (PARTITION BY r ORDER BY i)),
 found AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows WHERE g IS NOT NULL),
 gaps AS (SELECT r, lead(i) OVER (PARTITION BY r ORDER BY i) - i AS gap FROM found WHERE n > 1),
 covered AS (SELECT r, sum(least(5, coalesce(gap, 5)))::BIGINT AS n FROM gaps GROUP BY r),
 counts AS (SELECT parts.r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
  len(l) AS n_lines, (length(t) - length(replace(t, '!!', ''))) // 2 AS n_bangs, length(t) - length(replace(t, '.', '')) AS n_stops,
  len(list_filter(w, lambda x: regexp_full_match(x, '[\\p{{L}}''’-]+[.,;:?!]?'))) AS n_plain FROM parts LEFT JOIN covered ON covered.r = parts.r),
 votes AS (SELECT *, {BASE_FAILED} AS base_failed, {_CAST} FROM counts),
 patterns AS (SELECT {_COLUMNS}, count(*) AS n, sum(count(*)) OVER ()::DOUBLE AS total, {STRENGTH} * sum(count(*)) OVER ()::DOUBLE + 1 AS weight FROM votes GROUP BY {_COLUMNS}),
 fitted AS (SELECT 0 AS round, {_COLUMNS}, n, total, weight::DOUBLE AS weight, (1 + {_how_many(2)})::DOUBLE / (2 + {_how_many(2)} + 3 * {_how_many(0)}) AS post, 1::DOUBLE AS moved FROM patterns
  UNION ALL SELECT round + 1, {_COLUMNS}, n, total, weight, next, max(abs(next - post)) OVER () FROM (
   SELECT *, 1 / (1 + exp(-greatest(least(ln(share / (1 - share)) + odds, 500), -500))) AS next FROM (
    SELECT *, least(greatest((sum(good) OVER () + {SHARE} * weight) / (total + weight), 1e-6), 1 - 1e-6) AS share, {_ODDS} AS odds FROM (
     SELECT *, n * post AS good, n * (1 - post) AS bad FROM fitted WHERE round < {ROUNDS} AND moved >= {SETTLED})))),
 posterior AS (SELECT {_COLUMNS}, round(post, 6) AS quality FROM fitted WHERE round = (SELECT max(round) FROM fitted))
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND quality >= {LEAST} AS kept, quality
 FROM votes JOIN posterior USING ({_COLUMNS})"""
