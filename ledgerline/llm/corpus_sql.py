"""SQL of the manifest, of fill-in-middle and of decontamination."""

from __future__ import annotations

from ledgerline.llm.decontamination import WINDOW
from ledgerline.llm.fill_in_middle import CUT, SUFFIX_FIRST
from ledgerline.llm.manifest import FIELDS


def _leaf(n_chars: str) -> str:
    values = (f"CAST({n_chars if c == 'n_chars' else c} AS VARCHAR)" for c in FIELDS)
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _levels(name: str, leaves: str) -> str:
    """A recursive table (tree, level, i, h) over leaves (tree, i, h): pairs of a level, or its last node, are hashed while there are several."""
    return f"""{name} AS (SELECT tree, 0 AS level, i, h FROM {leaves}
  UNION ALL SELECT tree, level + 1, i // 2, sha256(h || coalesce(other, '')) FROM (
   SELECT *, lead(h) OVER (PARTITION BY tree ORDER BY i) AS other, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 AND i % 2 = 0)"""


def _folds(name: str, start: str, nodes: str) -> str:
    """A recursive table from (r, tree, i, fold, proof): each level's sibling is hashed in and written down."""
    return f"""{name} AS (SELECT r, tree, 0 AS level, i, fold, proof FROM {start}
  UNION ALL SELECT f.r, f.tree, f.level + 1, f.i // 2, sha256(CASE WHEN f.i % 2 = 1 THEN coalesce(s.h, '') || f.fold ELSE f.fold || coalesce(s.h, '') END), f.proof || coalesce(s.h, '')
   FROM {name} f JOIN tops t ON t.tree = f.tree AND f.level < t.level LEFT JOIN {nodes} s ON s.tree = f.tree AND s.level = f.level AND s.i = f.i + 1 - 2 * (f.i % 2))"""


# The checksum's table of 256 entries comes from its polynomial; text of a number has one byte for each character.
_ENTRY = "list_reduce(range(0, 8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT))"
_CRC = "xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda c, b: xor(c >> 8, entries[CAST(xor(c, b) & 255 AS INT) + 1]), 4294967295), 4294967295)"

OP11_SQL = f"""WITH RECURSIVE checks AS (SELECT list({_ENTRY} ORDER BY b) AS entries FROM range(256) t(b)),
 rows_ AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS h,
  CASE WHEN doc_id IS NOT NULL AND n_chars IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS other FROM documents, checks),
 leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM rows_),
 {_levels("nodes", "leaves")},
 tops AS (SELECT tree, max(level) AS level, arg_max(h, level) AS h FROM nodes GROUP BY tree
  UNION ALL SELECT '#', CAST(ceil(log2(greatest(1, count(DISTINCT tree)))) AS INT), '' FROM leaves),
 groups_ AS (SELECT '#' AS tree, tree AS name, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS i FROM tops WHERE tree <> '#'),
 {_levels("above", "groups_")},
 starts AS (SELECT r, tree, i, other AS fold, '' AS proof FROM leaves),
 {_folds("inside", "starts", "nodes")},
 ended AS (SELECT f.r, '#' AS tree, g.i, f.fold, f.proof, g.h AS subroot FROM inside f JOIN tops t ON t.tree = f.tree AND t.level = f.level JOIN groups_ g ON g.name = f.tree),
 {_folds("outside", "ended", "above")},
 proved AS (SELECT f.r, f.fold, f.proof FROM outside f JOIN tops t ON t.tree = '#' AND t.level = f.level)
 SELECT l.doc_id, l.h AS leaf, e.subroot, a.h AS root, sha256(p.proof) AS proof_sha256, p.fold AS folded_root, p.fold = a.h AS verified
 FROM leaves l JOIN ended e ON e.r = l.r JOIN proved p ON p.r = l.r, (SELECT arg_max(h, level) AS h FROM above) a"""


def _draw(k: int) -> str:
    return f"CAST('0x' || substr(drawn, {8 * k - 7}, 8) AS BIGINT)"


OP12_SQL = f"""SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars, sha256(output) AS output_sha256,
 sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN substr(output, 4, strpos(output, '<S>') - 4) || substr(output, strpos(output, '<M>') + 3) || substr(output, strpos(output, '<S>') + 3, strpos(output, '<M>') - strpos(output, '<S>') - 3)
  ELSE substr(output, strpos(output, '<P>') + 3, strpos(output, '<M>') - strpos(output, '<P>') - 3) || substr(output, strpos(output, '<M>') + 3) || substr(output, 4, strpos(output, '<P>') - 4) END) AS restored_sha256
 FROM (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
  ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END AS output
  FROM (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_draw(3)} % 100 >= {CUT} THEN 'plain' WHEN {_draw(4)} % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form,
   least({_draw(1)} % (n + 1), {_draw(2)} % (n + 1)) AS a, greatest({_draw(1)} % (n + 1), {_draw(2)} % (n + 1)) AS b
   FROM (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS drawn FROM documents)))"""


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"

OP13_SQL = f"""WITH items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '-') AS item, {_WORDS} AS w FROM benchmark),
 windows AS (SELECT item, least({WINDOW}, len(w)) AS k, unnest(list_transform(range(1, len(w) - least({WINDOW}, len(w)) + 2), lambda i: array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' '))) AS g FROM items WHERE len(w) > 0),
 texts AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
 sizes AS (SELECT DISTINCT k FROM windows), grams AS (SELECT DISTINCT g FROM windows),
 runs AS (SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM texts, sizes WHERE len(w) >= k),
 met AS (SELECT r, k, i, g FROM runs SEMI JOIN grams USING (g)),
 hits AS (SELECT r, count(DISTINCT spot) AS n FROM (SELECT r, unnest(range(i, i + k)) AS spot FROM met) GROUP BY r),
 owners AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM met JOIN windows USING (g) GROUP BY r)
 SELECT doc_id, len(w) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(owners.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
 FROM texts LEFT JOIN hits ON hits.r = texts.r LEFT JOIN owners ON owners.r = texts.r"""
