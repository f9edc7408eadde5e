"""The SQL (DuckDB) counterparts of the operators that SQL can express."""

from __future__ import annotations

from statloom.llm import quality_rules as q
from statloom.llm.decontaminate import WINDOW
from statloom.llm.phrase_mining import COVERED, LONGEST, SUPPORT, TOP

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _divergence() -> str:
    """Base measures, references per language, distances and verdicts."""
    words = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
    lines = r"list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"
    inside = [f"length(t) - length(translate(t, {_text(c)}, ''))" for c in q.CLASSES.values() if c != "\n"]
    inside.insert(list(q.CLASSES).index("line"), "length(t) - length(replace(t, chr(10), ''))")
    chars = f"[{', '.join(inside)}]"
    lists = " ".join(
        f"WHEN '{lang}' THEN [{', '.join(map(_text, listed.split()))}]" for lang, listed in q.COMMON_WORDS.items()
    )
    every = f"[{', '.join(map(_text, q.ALL_WORDS))}]"

    def distance(own: str, reference: str) -> str:
        p, r = f"(x / greatest(list_sum({own}), 1))", f"({reference}[i] / greatest(list_sum({reference}), 1))"
        half = lambda a, b: f"CASE WHEN {a} > 0 THEN {a} * log2({a} / (({a} + {b}) / 2)) ELSE 0 END"
        parts = f"list_transform({own}, lambda x, i: ({half(p, r)} + {half(r, p)}) / 2)"
        return f"sqrt(greatest(list_sum({parts}), 0))"

    return f"""WITH d AS (
      SELECT row_number() OVER () AS n, doc_id, lang, coalesce(text, '') AS t FROM documents),
    m AS MATERIALIZED (
      SELECT n, doc_id, lang, t, {words} AS w, {lines} AS l, {chars} AS c, CASE lang {lists} ELSE {every} END AS listed FROM d),
    k AS (
      SELECT n, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k, i FROM
      (SELECT n, w, unnest(range(1, len(w) - 1)) AS i FROM m)),
    r AS (
      SELECT n, count(DISTINCT p) AS again FROM (
        SELECT n, unnest([i, i + 1, i + 2]) AS p FROM (SELECT n, i, count(*) OVER (PARTITION BY n, k) AS c FROM k) WHERE c > 1)
      GROUP BY n),
    b AS MATERIALIZED (
      SELECT n, doc_id, lang, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(again, 0) AS n_repeat_words,
             list_transform(list_append(c, length(t) - list_sum(c)), lambda x: CAST(x AS DOUBLE)) AS chars, f AS found, listed
      FROM m LEFT JOIN r USING (n) LEFT JOIN (
        SELECT n, map_from_entries(list((x, c))) AS f FROM (
          SELECT n, x, count(*) AS c FROM (SELECT n, translate(unnest(w), '{UPPER}', '{LOWER}') AS x FROM m)
          WHERE x IN {tuple(q.ALL_WORDS)} GROUP BY n, x) GROUP BY n) USING (n)),
    h AS MATERIALIZED (
      SELECT b.* EXCLUDE (found, listed), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             list_transform(list_append(cw, n_words - coalesce(list_sum(cw), 0)), lambda x: CAST(x AS DOUBLE)) AS commons,
             coalesce('=' || lang, '') AS ref
      FROM (SELECT *, list_transform(listed, lambda x: coalesce(found[x], 0)) AS cw FROM b) b),
    e AS (
      SELECT ref, list(s ORDER BY i) AS ref_chars FROM (
        SELECT ref, i, sum(chars[i]) AS s FROM (SELECT ref, chars, unnest(range(1, len(chars) + 1)) AS i FROM h WHERE NOT base_failed)
        GROUP BY ref, i) GROUP BY ref),
    g AS (
      SELECT ref, list(s ORDER BY i) AS ref_commons FROM (
        SELECT ref, i, sum(commons[i]) AS s FROM (SELECT ref, commons, unnest(range(1, len(commons) + 1)) AS i FROM h WHERE NOT base_failed)
        GROUP BY ref, i) GROUP BY ref HAVING sum(s) >= {q.REFERENCE_LEAST})
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed
      AND NOT coalesce(ref_commons IS NOT NULL AND list_sum(chars) >= {q.CHAR_LEAST} AND {distance("chars", "ref_chars")} > {q.CHAR_LIMIT}, FALSE)
      AND NOT coalesce(n_words >= {q.WORD_LEAST} AND {distance("commons", "ref_commons")} > {q.WORD_LIMIT} + {q.WORD_NOISE} / sqrt(n_words), FALSE) AS kept
    FROM h LEFT JOIN e USING (ref) LEFT JOIN g USING (ref)"""


def _windows() -> str:
    """Windows of the items, and the words of the documents inside any of their occurrences."""
    words = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce({words}, []) AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least({WINDOW}, len(w)) AS m
          FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0 AND item_id IS NOT NULL),
    k AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS k
          FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
    o AS (SELECT n, i, m, item FROM (
            SELECT n, i, m, array_to_string(w[i:i + m - 1], ' ') AS k FROM (
              SELECT n, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT m FROM k)))
          JOIN k USING (m, k)),
    h AS (SELECT n, count(DISTINCT p) AS n_hit FROM (SELECT n, unnest(range(i, i + m)) AS p FROM o) GROUP BY n),
    f AS (SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT n, item FROM o) GROUP BY n)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (n) LEFT JOIN f USING (n)"""


def _collocations() -> str:
    """All phrases of a language counted, cut, scored and ranked."""
    return rf"""WITH p AS (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?
-
]')) AS p FROM documents),
    w AS MATERIALIZED (SELECT lang, regexp_extract_all(p, '[^ 	]+') AS w FROM p),
    n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    f AS MATERIALIZED (
      SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p, count(*) AS a FROM (
        SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT lang, w, unnest(range(1, {LONGEST + 1})) AS k FROM w))
      GROUP BY lang, k, p HAVING count(*) >= {SUPPORT}),
    c AS (SELECT lang, p, a, string_split(p, ' ') AS w, unnest(range(1, k)) AS cut, k FROM f WHERE k > 1),
    s AS (
      SELECT c.lang, c.p, c.k, c.a, c.cut, l.a AS l, r.a AS r, n.n,
             CAST((1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
      FROM c JOIN n ON n.lang = c.lang
      JOIN f l ON l.lang = c.lang AND l.p = array_to_string(w[1:cut], ' ')
      JOIN f r ON r.lang = c.lang AND r.p = array_to_string(w[cut + 1:], ' ')),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
    x AS (
      SELECT lang, part, max(a) AS longer FROM (
        SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS part FROM (
          SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (
            SELECT lang, a, string_split(p, ' ') AS w, unnest(range(2, k)) AS m FROM f WHERE k > 2))) GROUP BY lang, part),
    k AS (
      SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, p) AS rank
      FROM b LEFT JOIN x ON x.lang = b.lang AND x.part = b.p WHERE longer IS NULL OR 100 * longer < {COVERED} * a)
    SELECT lang, rank, p AS phrase, a, l, r, n, score FROM k WHERE rank <= {TOP}"""


def _trie() -> str:
    """Rebuilt turns, their prefixes, and the sums over the nodes below each prefix."""
    crc = (
        "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), "
        "lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]), lambda v, k: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"
    )
    return f"""WITH t AS MATERIALIZED (
      SELECT conv_id AS c, n, sha256(concat(octet_length(encode(r)), ':', r, x))[:32] AS g, CAST(length(x) AS BIGINT) AS chars,
             row_number() OVER (PARTITION BY conv_id ORDER BY n NULLS FIRST, sha256(concat(octet_length(encode(r)), ':', r, x))[:32]) AS k
      FROM (SELECT conv_id, turn AS n, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
    h AS (SELECT c, c - c % 100 AS b, {crc} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
    u AS (SELECT h.c, t.k, g, chars FROM h JOIN t ON t.c = h.b AND t.k <= h.h
          UNION ALL SELECT h.c, t.k, g, chars FROM h JOIN t ON t.c = h.c AND t.k > h.h),
    v AS (SELECT c, g, chars, row_number() OVER (PARTITION BY c ORDER BY k) AS d FROM u),
    p AS MATERIALIZED (
      SELECT c, d, chars, string_agg(g, '') OVER (PARTITION BY c ORDER BY d) AS p FROM v
      UNION ALL SELECT c, 0, 0, '' FROM h),
    z AS (SELECT c, max(d) AS z FROM p GROUP BY c),
    m AS MATERIALIZED (
      SELECT p, d, min(c) AS id, count(*) AS n, max(chars) AS chars,
             string_agg(CASE WHEN d = z THEN CAST(c AS VARCHAR) END, ',' ORDER BY c) AS ends
      FROM p JOIN z USING (c) GROUP BY p, d),
    w AS (SELECT p, left(p, 32 * (d - 1)) AS up FROM m WHERE d > 0),
    k AS (SELECT up, count(*) AS n FROM w GROUP BY up),
    a AS (
      SELECT top, sum(leaf) AS leaves, sum(save) AS saved FROM (
        SELECT left(m.p, 32 * unnest(range(0, d + 1))) AS top, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, (m.n - 1) * chars AS save
        FROM m LEFT JOIN k ON k.up = m.p) GROUP BY top)
    SELECT m.id AS conv_id, m.d AS depth, o.id AS parent_conv_id, m.n AS n_convs, coalesce(k.n, 0) AS n_children,
           CAST(a.leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
    FROM m LEFT JOIN w ON w.p = m.p LEFT JOIN m o ON o.p = w.up LEFT JOIN k ON k.up = m.p JOIN a ON a.top = m.p"""


ORACLE: dict[str, str] = {"op1_divergence": _divergence(), "op9_fm_index": _windows(), "op11_son_phrases": _collocations(), "op13_prefix_trie": _trie()}
