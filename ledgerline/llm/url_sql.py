"""The query of URL filters in SQL: links by patterns, components by recursion."""

from __future__ import annotations

from ledgerline.llm.url_filters import LOWER, RULES, UNSEEN, UPPER, URL_PARTS

_RULES = ", ".join("('{}', '{}', '{}', '{}')".format(rule, verdict, rule.split("/")[0], rule[rule.index("/") :]) for rule, verdict in RULES)
_VALUE = """(?:"([^"]*)"|''([^'']*)''|["'']?([^\\s"''>]+))"""
_REFERENCES = ((r"&(?:quot|#34|#[xX]22);", '"'), (r"&(?:apos|#39|#[xX]27);", "''"), (r"&(?:sol|#47|#[xX]2[fF]);", "/"), (r"&(?:amp|#38|#[xX]26);", "&"))


def _part(url: str, group: int) -> str:
    return f"coalesce(regexp_extract({url}, '{URL_PARTS}', {group}), '')"


def _host(url: str) -> str:
    return f"translate({_part(url, 1)}, '{UPPER}', '{LOWER}')"


def _node(url: str) -> str:
    return f"CASE WHEN {_part(url, 1)} <> '' THEN {_host(url)} || {_part(url, 2)} || {_part(url, 3)} END"


def _groups(text: str, pattern: str) -> str:
    return " || ".join(f"regexp_extract({text}, '{pattern}', {i})" for i in (1, 2, 3))


def _attribute(name: str) -> str:
    return _groups("tag", rf"(?is)\s{name}\s*=\s*{_VALUE}")


def _decoded(text: str) -> str:
    for pattern, char in _REFERENCES:
        text = f"regexp_replace({text}, '{pattern}', '{char}', 'g')"
    return text


def _best(column: str, table: str) -> str:
    fits = f"({table}.host = r.h OR ends_with({table}.host, '.' || r.h)) AND starts_with({table}.path, r.p)"
    return f"(SELECT arg_max(r.{column}, (length(r.rule), r.rule)) FROM rules r WHERE {fits})"


_TAG = """(?is)<(?:link|meta)\\b(?:(?:[^>"'']|"[^"]*"|''[^'']*'')*>|[^>]*>)"""
_AFTER = """(?is)^[\\s\\d.]*[;,\\s]\\s*(?:url\\s*=\\s*)?(?:"([^"]*)"?.*|''([^'']*)''?.*|([^\\s"''].*))$"""
_DOTS = """list_reduce(list_transform(string_split(full_path, '/'), lambda s: [s]), lambda o, s:
 CASE WHEN s[1] = '..' THEN o[1:greatest(len(o) - 1, 1)] WHEN s[1] = '.' THEN o ELSE list_concat(o, s) END)"""

OP2_SQL = f"""WITH RECURSIVE rules(rule, verdict, h, p) AS (VALUES {_RULES}),
 parts AS (SELECT page_id, url, html, {_host('url')} AS host, {_part('url', 2)} AS path, {_node('url')} AS node FROM pages),
 judged AS (SELECT page_id, host, path, node, {_best('rule', 'parts')} AS rule, {_best('verdict', 'parts')} AS own FROM parts),
 tags AS (SELECT url, host, path, node, unnest(list_distinct(regexp_extract_all(regexp_replace(html, '{UNSEEN}', ' ', 'g'), '{_TAG}'))) AS tag FROM parts WHERE node IS NOT NULL AND html IS NOT NULL),
 attributes AS (SELECT *, {_attribute('rel')} AS rel, {_decoded(_attribute('href'))} AS href, {_attribute('http-equiv')} AS kind, {_decoded(_attribute('content'))} AS content FROM tags),
 found AS (SELECT url, host, path, node, trim(CASE WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(rel, '(?i)(^|\\s)canonical(\\s|$)') THEN href
  WHEN regexp_matches(tag, '(?i)^<meta') AND regexp_matches(kind, '(?i)^\\s*refresh\\s*$') THEN {_groups('content', _AFTER)} END) AS ref FROM attributes),
 paths AS (SELECT url, host, path, node, ref, regexp_extract(url, '^((?s:.*?)://)', 1) AS scheme, regexp_extract(ref, '^[^?#]*((?s:.*))$', 1) AS rest,
  CASE WHEN starts_with(ref, '/') THEN '' ELSE coalesce(nullif(regexp_extract(path, '^((?s:.*)/)', 1), ''), '/') END || regexp_extract(ref, '^([^?#]*)', 1) AS full_path FROM found WHERE ref <> ''),
 resolved AS (SELECT node, CASE WHEN starts_with(ref, '//') THEN regexp_replace(scheme, '//$', '') || ref
  WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN ref WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN NULL
  WHEN starts_with(ref, '?') THEN scheme || host || path || ref WHEN starts_with(ref, '#') THEN url
  ELSE scheme || host || array_to_string({_DOTS}, '/') || CASE WHEN regexp_extract(full_path, '([^/]*)$', 1) IN ('.', '..') THEN '/' ELSE '' END || rest END AS target FROM paths),
 edges AS (SELECT node AS a, {_node('target')} AS b FROM resolved),
 pairs AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
 reach(start, node) AS (SELECT DISTINCT node, node FROM judged WHERE rule IS NULL AND node IN (SELECT a FROM pairs)
  UNION SELECT reach.start, pairs.b FROM reach JOIN pairs ON pairs.a = reach.node),
 nodes AS (SELECT a AS node, {_host("('x://' || a)")} AS host, {_part("('x://' || a)", 2)} AS path FROM (SELECT DISTINCT a FROM pairs)),
 votes AS (SELECT node, {_best('verdict', 'nodes')} AS vote FROM nodes),
 blocked AS (SELECT start FROM reach JOIN votes ON votes.node = reach.node GROUP BY start
  HAVING coalesce(bool_or(vote = 'block'), false) AND NOT coalesce(bool_or(vote = 'allow'), false))
 SELECT page_id, host, path, rule, coalesce(own, CASE WHEN node IN (SELECT start FROM blocked) THEN 'block' END, 'allow') AS verdict FROM judged"""
