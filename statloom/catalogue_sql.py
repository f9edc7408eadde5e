"""The SQL (DuckDB) counterpart of each catalogue query that SQL can express."""

from __future__ import annotations

from statloom.catalogue import NEGATIVE, RANKED, STATS

BASE = """
base AS (
  SELECT c_custkey AS key, c_name AS name, n_name AS nation, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
o AS (
  SELECT o_custkey AS key, CAST(count(*) AS DOUBLE) AS orders_cnt,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
  FROM orders GROUP BY o_custkey),
i AS (
  SELECT o_custkey AS key, CAST(count(*) AS DOUBLE) AS lines_cnt,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
e AS (
  SELECT user_id AS key, CAST(count(*) AS DOUBLE) AS events_cnt,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS event_value
  FROM events GROUP BY user_id),
w AS (
  SELECT key, name, nation, segment, orders_cnt, total_price, lines_cnt, qty, revenue,
         events_cnt, event_value
  FROM base FULL JOIN o USING (key) FULL JOIN i USING (key) FULL JOIN e USING (key))
"""


def r2(x: str) -> str:
    return f"round_even(({x}) * 100.0, 0) / 100.0"


def r6(x: str) -> str:
    return f"round_even(({x}) * 1e6, 0) / 1e6 + 0.0"


FILLED = (
    "z AS (SELECT key, name, nation, segment, "
    + ", ".join(f"coalesce({s}, 0.0) AS {s}" for s in STATS)
    + ", CAST(0 AS DOUBLE) AS no_value FROM w)"
)
WIDE = f"WITH {BASE} "
ZERO = f"WITH {BASE}, {FILLED} "


def stacked(ids: str, source: str, stats: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{s}' AS stat, CAST({s} AS DOUBLE) AS value FROM {source}" for s in stats
    )


def moments(stats: list[str]) -> str:
    return ", ".join(
        f'{r2(f"median({s})")} AS "Median of {s}", '
        f'{r2(f"sum({s}) / count({s})")} AS "Mean of {s}", '
        f'{r2(f"stddev_samp({s})")} AS "Std of {s}"'
        for s in stats
    )


WORDS = r"string_split_regex(regexp_replace(t, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '[\s\p{Z}]+')"
CUSTOMERS = "customer JOIN nation ON c_nationkey = n_nationkey"
YEARS, DAYS = "CAST(c_custkey % 40 AS VARCHAR)", "CAST(c_custkey % 365 AS VARCHAR)"
PRICE_NUMBER = "CAST(c_custkey % 100 AS VARCHAR) || '.' || CAST(c_custkey % 10 AS VARCHAR)"
LONG_NAME = """CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment
  WHEN c_custkey % 7 = 0 THEN 'Bobby Reid'
  WHEN c_custkey % 5 = 0 THEN c_mktsegment || ' ' || n_name
  ELSE c_mktsegment || ' ' || n_name || ' ' || c_name END"""
POSITIONS = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'FW,MF' WHEN 'BUILDING' THEN 'DF / MF'
  WHEN 'FURNITURE' THEN 'DF,GK' WHEN 'MACHINERY' THEN 'MF' ELSE 'Unknown' END"""
BUCKETS = f"""SELECT c_custkey, CASE WHEN t LIKE '%GK%' THEN 'GK' WHEN t LIKE 'DF%' THEN 'DF'
  WHEN t LIKE 'MF%' THEN 'MF' WHEN t LIKE 'FW%' THEN 'FW' END AS bucket
  FROM (SELECT c_custkey, {POSITIONS} AS t FROM customer)"""

SPELLED = """spelled AS (
  SELECT p_partkey, p_name, CASE p_partkey % 5
    WHEN 0 THEN p_name
    WHEN 1 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
    WHEN 2 THEN upper(substr(p_name, 2))
    WHEN 3 THEN 'Zö-' || p_name
    ELSE split_part(p_name, ' ', 1) || ' x ' || reverse(split_part(p_name, ' ', 2)) END AS spelled
  FROM part)"""


def prepared(x: str) -> str:
    plain = f"regexp_replace({x}, '[\\x{{80}}-\\x{{FF}}]', '', 'g')"
    spaced = f"trim(lower(regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g')))"
    return f"array_to_string(list_sort(string_split_regex({spaced}, '\\s+')), ' ')"


LCS = """list_reduce(string_split(x, ''), lambda prev, ch: list_reduce(range(1, length(y) + 1),
  lambda cur, j: list_append(cur, CASE WHEN substr(y, j, 1) = ch THEN prev[j] + 1
    ELSE greatest(prev[j + 1], cur[j]) END), [0::BIGINT]),
  list_transform(range(0, length(y) + 1), lambda q: 0::BIGINT))[-1]"""
SCORE = f"""CAST(CASE WHEN length(x) = 0 OR length(y) = 0 THEN 0
  ELSE round_even(100.0 * (CAST(2.0 AS DOUBLE) * {LCS} / (length(x) + length(y))), 0) END AS BIGINT)"""


def matched(threshold: int) -> str:
    return f"""WITH {SPELLED},
    l AS (SELECT DISTINCT {prepared('spelled')} AS x FROM spelled),
    r AS (SELECT {prepared('p_name')} AS y, min(p_partkey) AS ord, arg_min(p_name, p_partkey) AS known
          FROM part GROUP BY 1),
    s AS (SELECT x, ord, known, {SCORE} AS score FROM l CROSS JOIN r),
    b AS (SELECT x, known, score FROM s WHERE score >= {threshold}
          QUALIFY row_number() OVER (PARTITION BY x ORDER BY score DESC, ord) = 1),
    m AS (SELECT p_partkey, spelled, known AS matched_name, score AS match_score
          FROM spelled LEFT JOIN b ON {prepared('spelled')} = x) """


def histogram(bins: int, group: str | None) -> str:
    ids = f"{group}, " if group else ""
    cells = stacked(ids + "1 AS one" if group else "1 AS one", "lineitem", ["l_extendedprice", "l_quantity"])
    return f"""WITH c AS ({cells}),
    m AS (SELECT {ids}stat, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
                 CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi
          FROM c GROUP BY {ids}stat),
    g AS (SELECT m.*, CAST(b AS INTEGER) AS bin FROM m CROSS JOIN range(0, {bins}) AS t(b)),
    f AS (SELECT {ids}stat, value, lo, (hi - lo) / CAST({bins} AS DOUBLE) AS step,
                 CAST(least(floor((value - lo) / (hi - lo) * CAST({bins} AS DOUBLE)), {bins} - 1) AS INTEGER) AS b
          FROM c JOIN m USING ({ids}stat)),
    n AS (SELECT {ids}stat, CASE WHEN value < lo + b * step THEN b - 1
                 WHEN b < {bins} - 1 AND value >= lo + (b + 1) * step THEN b + 1 ELSE b END AS bin,
                 count(*) AS cnt
          FROM f GROUP BY ALL)
    SELECT {ids}stat, bin,
           lo + bin * ((hi - lo) / CAST({bins} AS DOUBLE)) AS low,
           CASE WHEN bin = {bins - 1} THEN hi
                ELSE lo + (bin + 1) * ((hi - lo) / CAST({bins} AS DOUBLE)) END AS high,
           CAST(coalesce(cnt, 0) AS BIGINT) AS "rows"
    FROM g LEFT JOIN n USING ({ids}stat, bin)"""


LEADERS = (
    ZERO
    + ", m AS (SELECT nation, "
    + ", ".join(f"sum({s}) / count({s}) AS {s}" for s in STATS)
    + " FROM z GROUP BY nation), u AS ("
    + stacked("nation", "m", STATS)
    + f"""), leaders AS (SELECT stat, nation AS "group", {r2('value')} AS mean FROM u
       QUALIFY row_number() OVER (PARTITION BY stat ORDER BY value DESC NULLS LAST, nation) = 1),
     wins AS (SELECT "group", count(*) AS wins FROM leaders
       WHERE stat NOT IN ({', '.join(repr(s) for s in NEGATIVE)}) GROUP BY "group") """
)


def look(order: str) -> str:
    return f"""(SELECT o_custkey AS c_custkey, o_orderpriority FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey {order}) = 1) AS f"""


def kept(order: str) -> str:
    return f"""SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey {order}) = 1"""


LINKS = r"regexp_extract_all(html, '<a\b[^>]*>([^<]*)</a>', 1)"
SIZE = 64

# Embeddings, standardised, as one list per vector.
SCALED = """
v AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, range(1, len(embedding) + 1) AS t(i)
      WHERE embedding IS NOT NULL),
m AS (SELECT i, avg(x) AS mean, stddev_pop(x) AS dev FROM v GROUP BY i),
c AS (SELECT vec_id, i, CASE WHEN dev > 0 THEN (x - mean) / dev ELSE 0 END AS z FROM v JOIN m USING (i)),
s AS MATERIALIZED (SELECT vec_id, list(z ORDER BY i) AS z FROM c GROUP BY vec_id)"""


def lloyd(ks: list[int], rounds: int = 60) -> str:
    """K-means from the vectors with the least ids: ``km`` holds the centres after each round,
    ``near`` the last one's nearest centre of each vector."""
    return f"""WITH RECURSIVE {SCALED},
    f AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS c, z FROM s ORDER BY vec_id LIMIT {max(ks)}),
    km(it, k, c, z) AS (
      SELECT 0, k, c, z FROM f JOIN (SELECT unnest({ks}) AS k) ON c < k
      UNION ALL
      SELECT it, k, c, list(mean ORDER BY i) FROM (
        SELECT it, k, c, i, avg(z[i]) AS mean FROM (
          SELECT it + 1 AS it, k, vec_id, any_value(s.z) AS z, arg_min(c, list_distance(s.z, km.z)) AS c
          FROM s CROSS JOIN km WHERE it < {rounds} GROUP BY it, k, vec_id)
        CROSS JOIN (SELECT unnest(range(1, (SELECT max(len(z)) FROM s) + 1)) AS i)
        GROUP BY it, k, c, i) GROUP BY it, k, c),
    near AS (
      SELECT k, vec_id, arg_min(c, list_distance(s.z, km.z)) AS c, min(list_distance(s.z, km.z)) AS d
      FROM s CROSS JOIN km WHERE it = {rounds} GROUP BY k, vec_id)"""


CLUSTERED = lloyd([4]) + """,
    ids AS (SELECT c, n, row_number() OVER (ORDER BY n DESC, z) - 1 AS id
            FROM (SELECT c, count(*) AS n FROM near GROUP BY c) JOIN (SELECT c, z FROM km WHERE it = 60) USING (c))"""


def components(squarings: int = 14) -> str:
    """The two leading directions of the covariance: its power by repeated squaring maps any vector
    to the first; with that taken out, the same again gives the second."""

    def power(start: str, name: str) -> str:
        steps, last = [], start
        for n in range(squarings):
            product = f"SELECT a.i, b.j, sum(a.x * b.x) AS x FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY a.i, b.j"
            steps.append(
                f"{name}{n} AS MATERIALIZED (SELECT i, j, x / sqrt(sum(x * x) OVER ()) AS x FROM ({product}))"
            )
            last = f"{name}{n}"
        # the column with the largest diagonal is not orthogonal to the direction
        column = f"SELECT j FROM {last} WHERE i = j ORDER BY x DESC LIMIT 1"
        picked = f"SELECT i, x / sqrt(sum(x * x) OVER ()) AS x FROM {last} WHERE j = ({column})"
        steps.append(f"{name}u AS (SELECT i, x, (SELECT x FROM ({picked}) ORDER BY abs(x) DESC LIMIT 1) AS top FROM ({picked}))")
        steps.append(f"{name} AS MATERIALIZED (SELECT i, x * sign(top) AS x FROM {name}u)")
        return ",\n".join(steps)

    value = "SELECT sum(a.x * b.x * c.x) AS x FROM {m} a JOIN {v} b ON a.i = b.i JOIN {v} c ON a.j = c.i"
    return f"""WITH {SCALED},
    cov AS MATERIALIZED (
      SELECT a.i, b.i AS j, sum(a.z * b.z) / (count(*) - 1) AS x FROM c a JOIN c b USING (vec_id) GROUP BY a.i, b.i),
    {power("cov", "p")},
    e1 AS ({value.format(m="cov", v="p")}),
    rest AS MATERIALIZED (
      SELECT cov.i, cov.j, cov.x - (SELECT x FROM e1) * a.x * b.x AS x
      FROM cov JOIN p a ON cov.i = a.i JOIN p b ON cov.j = b.i),
    {power("rest", "q")},
    e2 AS ({value.format(m="cov", v="q")})"""


def least_squares() -> str:
    """The value model: numbers beside one category are fitted on what is left of them within the
    category's rows; the normal equations are eliminated step by step."""
    numbers = ["l_quantity", "l_discount", "l_tax", "p_size"]
    n, sql = len(numbers), []
    logs = ", ".join(f"ln(1 + greatest(CAST({x} AS DOUBLE), 0)) AS x{i}" for i, x in enumerate(numbers))
    sql.append(f"""r AS MATERIALIZED (
      SELECT l_orderkey || '-' || l_linenumber AS line, l_partkey, l_suppkey, l_returnflag AS f, p_brand AS b,
             {logs}, l_extendedprice * 1000 AS x{n}
      FROM lineitem JOIN part ON l_partkey = p_partkey)""")
    sql.append("""t AS (SELECT * FROM r
      WHERE CAST('0x' || substr(md5(line || ':42'), 1, 8) AS BIGINT) % 10 < 8)""")
    columns = range(n + 1)
    sql.append("g AS (SELECT f, b, " + ", ".join(f"avg(x{i}) AS m{i}" for i in columns) + " FROM t GROUP BY f, b)")
    left = ", ".join(f"x{i} - m{i} AS d{i}" for i in columns)
    sql.append(f"d AS (SELECT f, {left} FROM t JOIN g USING (f, b))")
    cells = [(i, j) for i in range(n) for j in range(i, n + 1)]
    sql.append("a0 AS (SELECT f, " + ", ".join(f"sum(d{i} * d{j}) AS a{i}_{j}" for i, j in cells) + " FROM d GROUP BY f)")
    for k in range(n - 1):
        after = []
        for i, j in cells:
            term = f"a{i}_{j} - a{k}_{i} * a{k}_{j} / a{k}_{k}" if i > k else f"a{i}_{j}"
            after.append(f"{term} AS a{i}_{j}")
        sql.append(f"a{k + 1} AS (SELECT f, {', '.join(after)} FROM a{k})")
    last = f"a{n - 1}"
    for i in reversed(range(n)):
        known = "".join(f" - a{i}_{j} * w{j}" for j in range(i + 1, n))
        sql.append(f"w{i} AS (SELECT *, (a{i}_{n}{known}) / a{i}_{i} AS w{i} FROM {last})")
        last = f"w{i}"
    guess = f"m{n} + " + " + ".join(f"w{i} * (x{i} - m{i})" for i in range(n))
    return f"""WITH {', '.join(sql)}
    SELECT line, l_partkey, l_suppkey,
           CASE f WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'None' ELSE 'Returned' END AS position,
           {r2(f"x{n} / 1e6")} AS actual_m, {r2(f"least(greatest({guess}, 100000), 200000000) / 1e6")} AS predicted_m
    FROM r JOIN g USING (f, b) JOIN {last} USING (f)"""


ORACLE: dict[str, str] = {
    "src_csv_na": """SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS name,
        CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance FROM customer""",
    "src_csv_empty": """SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN 'Ø"' || c_name || ', é"' END AS name
        FROM customer""",
    "src_csv_plain": """SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN 'Ø"' || c_name || ', é"' END AS name
        FROM customer""",
    "sources_tolerant": """SELECT 'customer' AS source, count(*) AS "rows" FROM customer
        UNION ALL SELECT 'nation', count(*) FROM nation""",
    "html_comment_extract": r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, bodies[i] AS body FROM (
        SELECT page_id, bodies, unnest(range(1, len(bodies) + 1)) AS i FROM (
          SELECT page_id, regexp_extract_all(html, '(?s)<!--(.*?)-->', 1) AS bodies FROM pages))""",
    "html_table_rows": """
        SELECT c_custkey AS page_id, CAST(1 AS BIGINT) AS row_ord, 'Player' AS name,
               'Min' AS minutes, 'Gls' AS goals FROM customer
        UNION ALL SELECT c_custkey, 2, c_name, CAST(c_custkey * 1000 AS VARCHAR), 'A & B' FROM customer
        UNION ALL SELECT c_custkey, 3, 'Player', 'Min', 'Gls' FROM customer""",
    "html_rows_min_cells": """
        SELECT p_partkey AS page_id, CAST(1 AS BIGINT) AS row_ord, p_name AS name,
               '€' || CAST(p_size AS VARCHAR) || 'M' AS price FROM part
        UNION ALL SELECT p_partkey, 3, 'x', NULL FROM part""",
    "cell_pick": f"""SELECT page_id, trim(c[1]) AS first_name, trim(c[2]) AS second_name,
        CASE WHEN len(c) >= 3 THEN trim(c[-1]) END AS price
        FROM (SELECT page_id, {LINKS} AS c FROM pages) WHERE len(c) >= 2""",
    "page_count": r"""SELECT CAST(coalesce(greatest(max(TRY_CAST(n AS BIGINT)), 1), 22) AS BIGINT) AS pages
        FROM (SELECT unnest(regexp_extract_all(url, 'page=(\d+)', 1)) AS n FROM pages)""",
    # none of the given pages has an element of that class, so the default holds; were there one on
    # the first page, its numbers would be compared
    "page_count_links": r"""SELECT CAST(CASE WHEN len(bar) = 0 THEN 22
        ELSE greatest(1, coalesce(list_max(list_transform(
          regexp_extract_all(bar, '(?s)<a\b[^>]*>(.*?)</a>', 1),
          lambda t: TRY_CAST(trim(regexp_replace(t, '<[^>]*>', '', 'g')) AS BIGINT))), 1)) END AS BIGINT) AS pages
        FROM (SELECT coalesce(regexp_extract(arg_min(html, page_id),
          '(?s)<(\w+)[^>]*\bclass=["''][^"'']*\bpagination\b[^"'']*["''][^>]*>(.*?)</(div|ul|nav)>', 2), '') AS bar
          FROM pages)""",
    "page_count_listing": """SELECT c_custkey AS page_id, CAST(CASE WHEN c_custkey % 7 = 0 THEN 22
        WHEN c_custkey % 5 = 0 THEN 1 ELSE greatest(3, c_custkey % 9 + 1) END AS BIGINT) AS pages FROM customer""",
    "html_table_spans": """
        SELECT c_custkey AS page_id, CAST(1 AS BIGINT) AS row_ord, c_name AS Player,
               CAST(c_custkey AS VARCHAR) AS Min, CAST(NULL AS VARCHAR) AS beyond FROM customer
        UNION ALL SELECT c_custkey, 2, c_name, 'again', 'x' || CAST(c_custkey AS VARCHAR) FROM customer""",
    "url_list": """SELECT i AS page, 'https://example.com/list/' || CAST(i AS VARCHAR) AS url
        FROM range(1, (SELECT count(*) FROM pages) + 1) AS t(i)""",
    "strip_thousands": """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0
        THEN format('{:,}', c_custkey * 98765) || ' kg'
        ELSE CAST(c_custkey * 98765 AS VARCHAR) END AS text FROM customer""",
    "rename_map": "SELECT p_size, p_name AS label, p_partkey AS key FROM part",
    "first_names": "SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS label, p_brand AS brand FROM part",
    "numeric_totals": WIDE + ", u AS (" + stacked("key", "w", STATS)
    + ") SELECT stat, CAST(sum(round_even(value * 100, 0)) AS DOUBLE) / 100 AS total FROM u GROUP BY stat",
    "conform_schema": """SELECT p_partkey, p_name, CAST(NULL AS DOUBLE) AS rating, '' AS note
        FROM part""",
    "unpivot_stats": WIDE + stacked("key", "w", STATS),
    "coerce_numeric": """SELECT c_custkey, CASE WHEN NOT isnan(v) THEN v END AS value FROM (
        SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 7 = 0 THEN 'N/A' WHEN c_custkey % 11 = 0
          THEN 'x1' WHEN c_custkey % 13 = 0 THEN 'NaN' ELSE CAST(c_acctbal AS VARCHAR) END AS DOUBLE) AS v
        FROM customer)""",
    "coerce_int": """SELECT c_custkey, CASE WHEN v = floor(v) THEN CAST(v AS BIGINT) END AS value FROM (
        SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey AS VARCHAR) || '.5'
          WHEN c_custkey % 7 = 0 THEN 'abc' ELSE CAST(c_custkey AS VARCHAR) END AS DOUBLE) AS v
        FROM customer)""",
    "fill_const": """SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'N/A') AS priority,
        CASE WHEN o_orderkey % 4 = 0 THEN 0.0 ELSE o_totalprice END AS price FROM orders""",
    "impute_median": WIDE + "SELECT key, segment, " + ", ".join(
        f"coalesce({s}, median({s}) OVER (PARTITION BY segment), 0.0) AS {s}" for s in STATS
    ) + " FROM w",
    "drop_any_null": WIDE + f"SELECT key, {', '.join(STATS)} FROM w WHERE "
    + " AND ".join(f"{s} IS NOT NULL" for s in STATS),
    "parse_age": rf"""SELECT c_custkey, CASE
        WHEN regexp_matches(t, '^\d+\s*-\s*\d+$') THEN {r2("TRY_CAST(split_part(t, '-', 1) AS DOUBLE) + TRY_CAST(split_part(t, '-', 2) AS DOUBLE) / CAST(365 AS DOUBLE)")}
        WHEN contains(t, '-') THEN NULL
        WHEN contains(t, '.') THEN {r2("TRY_CAST(t AS DOUBLE)")}
        WHEN regexp_matches(t, '^\d+$') THEN TRY_CAST(t AS DOUBLE) END AS age
        FROM (SELECT c_custkey, trim(CASE c_custkey % 6
          WHEN 0 THEN ' ' || {YEARS} || '-' || {DAYS} || ' ' WHEN 1 THEN {YEARS}
          WHEN 2 THEN {YEARS} || '.' || CAST(c_custkey % 1000 AS VARCHAR)
          WHEN 3 THEN '1-2-3' WHEN 4 THEN 'N/A' ELSE '-' || {YEARS} END) AS t FROM customer)""",
    "last_token": f"""SELECT c_custkey, nullif({WORDS}[-1], '') AS word FROM (
        SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN '   ' WHEN c_custkey % 10 = 0 THEN NULL
          ELSE n_name || '  ' || c_name END AS t FROM {CUSTOMERS})""",
    "clean_name": rf"""SELECT c_custkey, coalesce(CASE WHEN contains(t, ',')
          THEN array_to_string(list_reverse(list_transform(string_split(t, ','), lambda p: trim(p))), ' ')
          ELSE regexp_replace(trim(t), '\s+', ' ', 'g') END, 'N/A') AS name FROM (
        SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name || ', ' || c_mktsegment
          WHEN c_custkey % 4 = 1 THEN c_name || ' ,' || n_name || ' ,' || c_mktsegment
          WHEN c_custkey % 4 = 2 THEN '  ' || c_name || '   ' || n_name || ' ' END AS t
        FROM {CUSTOMERS})""",
    "name_first_two": f"""SELECT c_custkey, CASE WHEN len({WORDS}) >= 2
        THEN array_to_string({WORDS}[1:2], ' ') ELSE t END AS name
        FROM (SELECT c_custkey, {LONG_NAME} AS t FROM {CUSTOMERS})""",
    "name_first_last": f"""SELECT c_custkey, CASE WHEN t = 'Bobby Reid' THEN 'Bobby Cordova-Reid'
        WHEN len({WORDS}) >= 3 THEN {WORDS}[1] || ' ' || {WORDS}[-1] ELSE t END AS name
        FROM (SELECT c_custkey, {LONG_NAME} AS t FROM {CUSTOMERS})""",
    "parse_money": f"""SELECT c_custkey, TRY_CAST(regexp_replace(u, '[MK]', '', 'g') AS DOUBLE) *
        CASE WHEN contains(u, 'M') THEN 1e6 WHEN contains(u, 'K') THEN 1e3 ELSE 1e0 END AS value FROM (
        SELECT c_custkey, upper(trim(regexp_replace(CASE c_custkey % 5
          WHEN 0 THEN '€' || {PRICE_NUMBER} || 'M' WHEN 1 THEN '£' || {PRICE_NUMBER} || 'k '
          WHEN 2 THEN 'Free' WHEN 3 THEN {PRICE_NUMBER} ELSE ' € ' || {PRICE_NUMBER} || 'm' END,
          '[€£]', '', 'g'))) AS u FROM customer)""",
    "main_role": f"""SELECT c_custkey, trim(string_split_regex(t, '[,/]')[1]) AS role
        FROM (SELECT c_custkey, {POSITIONS} AS t FROM customer)""",
    "position_buckets": f"SELECT * FROM ({BUCKETS}) WHERE bucket IS NOT NULL",
    "bucket_counts": f"""SELECT bucket, count(*) AS "rows" FROM ({BUCKETS})
        WHERE bucket IS NOT NULL GROUP BY bucket""",
    "union_roles": """SELECT c_custkey, c_name, c_mktsegment AS position FROM customer
        WHERE c_mktsegment IS NOT NULL""",
    "sort_first_token": f"""SELECT c_custkey, n_name || ' ' || c_name AS name FROM {CUSTOMERS}
        ORDER BY n_name, name, c_custkey""",
    "merge_wide": WIDE + f"""SELECT key, name, segment, nation, CAST(orders_cnt AS BIGINT) AS orders_cnt,
        total_price, CAST(lines_cnt AS BIGINT) AS lines_cnt,
        CASE WHEN qty = floor(qty) THEN CAST(qty AS BIGINT) END AS qty, {r2('revenue')} AS revenue,
        CAST(events_cnt AS BIGINT) AS events_cnt, event_value FROM w WHERE qty > 90""",
    "merge_wide_union": WIDE + "SELECT * FROM w",
    "merge_suffixes": """SELECT key, name_x, balance, name_y FROM
        (SELECT c_custkey AS key, c_name AS name_x, c_acctbal AS balance FROM customer) FULL JOIN
        (SELECT s_suppkey AS key, s_name AS name_y FROM supplier) USING (key)""",
    "merge_skips_repeats": """SELECT key, c_name, n_name FROM
        (SELECT c_custkey AS key, c_name FROM customer) FULL JOIN
        (SELECT n_nationkey AS key, n_name FROM nation) USING (key)""",
    "key_violations": """SELECT o_custkey, count(*) AS "count" FROM orders GROUP BY o_custkey
        HAVING count(*) > 1""",
    "lookup_first": f"""SELECT c.c_custkey, c_name, o_orderpriority FROM customer c
        LEFT JOIN {look('ASC')} ON c.c_custkey = f.c_custkey""",
    "lookup_hot_key": """SELECT l_orderkey, l_linenumber, k, o_orderpriority FROM (
            SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber <= 3 THEN 1 ELSE l_orderkey END AS BIGINT) AS k
            FROM lineitem) LEFT JOIN orders ON o_orderkey = k""",
    "lookup_last_default": f"""SELECT c.c_custkey, c_name, CASE WHEN f.c_custkey IS NULL THEN 'Unknown'
        ELSE o_orderpriority END AS o_orderpriority FROM customer c
        LEFT JOIN {look('DESC')} ON c.c_custkey = f.c_custkey""",
    "dedup_first": kept("ASC"),
    "dedup_last": kept("DESC"),
    "filter_threshold": WIDE + "SELECT key, name, qty FROM w WHERE qty > 900",
    "role_filter": """SELECT c_custkey, c_name, c_mktsegment FROM customer
        WHERE upper(c_mktsegment) = 'BUILDING'""",
    "global_profile": ZERO + f"SELECT {moments(STATS)} FROM z",
    "group_profile": ZERO + ", u AS (" + stacked("nation", "z", STATS) + f""")
        SELECT nation, stat, {r2('median(value)')} AS median, {r2('sum(value) / count(value)')} AS mean,
        {r2('stddev_samp(value)')} AS std FROM u GROUP BY nation, stat""",
    "group_profile_wide": ZERO + f"SELECT nation, {moments(STATS)} FROM z GROUP BY nation",
    "rollup_profile": ZERO + f"""SELECT CASE WHEN grouping(nation) = 1 THEN 'all' ELSE nation END AS nation,
        {moments(STATS)} FROM z GROUP BY GROUPING SETS ((), (nation))""",
    "narrowed_profile": "WITH u AS ("
    + stacked("l_returnflag", "lineitem", ["l_extendedprice", "l_quantity"])
    + f") SELECT l_returnflag, stat, {r2('median(value)')} AS median FROM u GROUP BY l_returnflag, stat",
    "group_means": ZERO + "SELECT nation, "
    + ", ".join(f"{r2(f'sum({s}) / count({s})')} AS {s}" for s in STATS) + " FROM z GROUP BY nation",
    "distinct_groups": WIDE + "SELECT DISTINCT nation FROM w",
    "all_zero_stats": ZERO + ", u AS (" + stacked("key", "z", RANKED)
    + ") SELECT stat, bool_and(value = 0) AS all_zero FROM u GROUP BY stat",
    "top_bottom_n": ZERO + ", u AS (" + stacked("key, name, nation", "z", RANKED) + """),
        f AS (SELECT stat, bool_and(value = 0) AS none FROM u GROUP BY stat),
        r AS (
          SELECT stat, 'Highest' AS direction, name, nation, value,
                 row_number() OVER (PARTITION BY stat ORDER BY value DESC, key) AS n FROM u
          UNION ALL
          SELECT stat, 'Lowest', name, nation, value,
                 row_number() OVER (PARTITION BY stat ORDER BY value, key) FROM u JOIN f USING (stat)
          WHERE none OR value > 0)
        SELECT stat, direction, CASE n WHEN 1 THEN '1st' WHEN 2 THEN '2nd' ELSE '3rd' END AS "rank",
               name AS entity, nation AS "group", value FROM r WHERE n <= 3""",
    "top_k_single": WIDE + """SELECT key, name, revenue FROM w
        ORDER BY revenue DESC NULLS LAST, key LIMIT 3""",
    "leader_per_stat": LEADERS + "SELECT * FROM leaders",
    "leader_wins": LEADERS + "SELECT * FROM wins",
    "best_group": LEADERS + """SELECT "group", wins, CAST((SELECT sum(wins) FROM wins) AS BIGINT) AS "of"
        FROM wins ORDER BY wins DESC, "group" LIMIT 1""",
    "hist_global": histogram(20, None),
    "hist_group": histogram(10, "l_returnflag"),
    "token_sort_ratio": f"""WITH {SPELLED}, p AS (SELECT p_partkey, spelled,
        {prepared('p_name')} AS x, {prepared('spelled')} AS y FROM spelled)
        SELECT p_partkey, spelled, {SCORE} AS score FROM p""",
    "fuzzy_best_match": matched(90) + "SELECT * FROM m",
    "fuzzy_best_match_70": matched(70) + "SELECT * FROM m",
    "fuzzy_semi": matched(80) + "SELECT p_partkey, spelled FROM m WHERE matched_name IS NOT NULL",
    "fuzzy_unmatched": matched(90) + """SELECT p_partkey, spelled, 'Part' AS role FROM m
        WHERE matched_name IS NULL""",
    "values_without_players": """SELECT trim(p_name) AS Player, 'Unknown' AS Position,
        '€' || CAST(min(p_partkey) AS VARCHAR) || 'M' AS Price FROM part GROUP BY trim(p_name)""",
    "roles_skipped": """SELECT 'Accepted' AS position, count(*) AS "rows" FROM lineitem
        WHERE l_returnflag = 'A'""",
    "log_features": WIDE + ", p AS (SELECT key, " + ", ".join(
        f"coalesce({s}, (SELECT median({s}) FROM w), 0.0) AS {s}" for s in STATS
    ) + ") SELECT key, ".replace(") SELECT", " FROM w) SELECT") + ", ".join(
        r6(f"ln(1 + greatest({s + (' - 500' if s == 'event_value' else '')}, 0.0)) * "
           + str({"qty": 1.5, "revenue": 2.0, "orders_cnt": 0.5}.get(s, 1.0))) + f" AS {s}"
        for s in STATS
    ) + " FROM p",
    "clip_scale": WIDE + f"""SELECT key, CASE WHEN total_price IS NOT NULL
        THEN {r2("least(greatest(total_price * 10, 100000), 200000000) / 1e6")} END AS value_m FROM w""",
    "standardize": ZERO + "SELECT key, " + ", ".join(
        r6(f"coalesce(({s} - avg({s}) OVER ()) / nullif(stddev_pop({s}) OVER (), 0), 0.0)") + f" AS {s}"
        for s in RANKED
    ) + " FROM z",
    "one_hot": "SELECT c_custkey, c_mktsegment, " + ", ".join(
        f"""CAST(c_mktsegment = '{s}' AS INTEGER) AS "c_mktsegment={s}\""""
        for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    ) + " FROM customer",
    "split_80_20": """SELECT c_custkey,
        CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 10 < 8 AS train
        FROM customer""",
    "wcss_k1": f"""SELECT 1 AS k, round(sum(ss), 4) AS wcss FROM (
        SELECT i, var_pop(CAST(embedding[i] AS DOUBLE)) * count(embedding[i]) AS ss
        FROM embeddings CROSS JOIN range(1, {SIZE + 1}) AS t(i) GROUP BY i)""",
    "ols_one_feature": """SELECT CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'None'
        ELSE 'Returned' END AS role, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
        round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
        FROM lineitem GROUP BY l_returnflag""",
    "elbow_curve": lloyd(list(range(1, 11)))
    + " SELECT CAST(k AS INTEGER) AS k, round(sum(d * d), 4) AS wcss FROM near GROUP BY k",
    "elbow_drawn": f"WITH {SCALED} SELECT 1 AS k, round(sum(list_dot_product(z, z)), 4) AS wcss FROM s",
    "kmeans_assign": CLUSTERED + " SELECT vec_id, CAST(id AS INTEGER) AS cluster FROM near JOIN ids USING (c)",
    "cluster_sizes": CLUSTERED + """ SELECT CAST(id AS INTEGER) AS cluster, n AS "rows" FROM ids ORDER BY id""",
    "cluster_profile": CLUSTERED
    + ", g AS (SELECT id, i, avg(x) AS mean FROM v JOIN near USING (vec_id) JOIN ids USING (c) GROUP BY id, i)"
    + " SELECT CAST(id AS INTEGER) AS cluster, "
    + ", ".join(f"{r2(f'max(mean) FILTER (i = {i + 1})')} AS x{i}" for i in range(64))
    + " FROM g GROUP BY id",
    "pca_2d": components()
    + f" SELECT vec_id, {r6('sum(c.z * p.x)')} AS pc1, {r6('sum(c.z * q.x)')} AS pc2"
    + " FROM c JOIN p ON c.i = p.i JOIN q ON c.i = q.i GROUP BY vec_id",
    "pca_shares": components()
    + f""" SELECT 1 AS component, {r6("(SELECT x FROM e1) / sum(x)")} AS share FROM cov WHERE i = j
    UNION ALL SELECT 2, {r6("(SELECT x FROM e2) / sum(x)")} FROM cov WHERE i = j""",
    "value_model": least_squares() + " ORDER BY predicted_m DESC, line, l_partkey, l_suppkey",
    "first_token_places": f"""SELECT c_custkey, name, row_number() OVER (ORDER BY n_name, name, c_custkey) AS place
        FROM (SELECT c_custkey, n_name, n_name || ' ' || c_name AS name FROM {CUSTOMERS})""",
    "rollup_places": ZERO + f"""SELECT *, row_number() OVER (ORDER BY nation = 'all' DESC, nation NULLS FIRST) AS place FROM (
        SELECT CASE WHEN grouping(nation) = 1 THEN 'all' ELSE nation END AS nation,
        {moments(STATS)} FROM z GROUP BY GROUPING SETS ((), (nation)))""",
    "group_places": WIDE + """SELECT nation, row_number() OVER (ORDER BY nation NULLS FIRST) AS place
        FROM (SELECT DISTINCT nation FROM w)""",
    "value_places": "SELECT *, row_number() OVER (ORDER BY predicted_m DESC, line, l_partkey, l_suppkey) AS place FROM ("
    + least_squares() + ")",
}
