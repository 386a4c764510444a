"""The same results in DuckDB SQL, by other means where a plan is rewritten.

Open items use the interval join, ids and differences one global window, and
comments inside blocks a split of the text into comment and other parts.
"""

from __future__ import annotations

from repotide.bindings import EARLIER_LOAD_UNTIL, ORDERS_AS_OF
from repotide.schemas import DELTAS, MEASURES

ORACLE_SQL: dict[str, str] = {}

_M = ", ".join(f'"{m}"' for m in MEASURES)
_D = ", ".join(DELTAS)


def _each(pattern: str, names=MEASURES) -> str:
    return ", ".join(pattern.format(m=m) for m in names)


# Named relations; each query lists those it needs, in order.
_PARTS = {
    "log": """log AS (
        SELECT c_nationkey::bigint AS repo, o_orderkey AS commit_id, o_custkey AS committer_id,
               o_orderdate::date AS day
        FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "files": """files AS (
        SELECT l_orderkey AS commit_id, l_returnflag AS language, 'p' || l_partkey AS provider,
               l_quantity::bigint AS "lines", l_linenumber::bigint AS "code",
               round(l_tax * 100)::bigint AS "comments",
               round(l_discount * 100)::bigint AS "blanks",
               floor(l_extendedprice)::bigint AS "bytes"
        FROM lineitem)""",
    "sizes": f"""sizes AS (
        SELECT commit_id, {_each('sum("{m}")::bigint AS "{m}"')} FROM files GROUP BY commit_id)""",
    "joined": f"""joined AS (
        SELECT repo, commit_id, committer_id, day, {_M} FROM sizes JOIN log USING (commit_id))""",
    "last": f"""last AS (
        SELECT repo, day, {_M} FROM (
            SELECT *, row_number() OVER (PARTITION BY repo, day ORDER BY commit_id DESC) AS rn
            FROM joined) WHERE rn = 1)""",
    # a log whose days run back and forth: the series starts with the day that
    # ends first in the log, days before it are cut
    "last_in_log": f"""last AS (
        SELECT repo, day, {_M} FROM (
            SELECT *, first_value(day) OVER (PARTITION BY repo ORDER BY commit_id) AS first_day
            FROM (SELECT *, row_number() OVER (PARTITION BY repo, day ORDER BY commit_id DESC) AS rn
                  FROM joined) WHERE rn = 1)
        WHERE day >= first_day)""",
    "size_day": f"""size_day AS (
        SELECT s.repo, s.day, {_each('''last_value(l."{m}" IGNORE NULLS) OVER w AS "{m}"''')}
        FROM (SELECT repo, unnest(generate_series(min(day), DATE '{ORDERS_AS_OF}',
                                                  INTERVAL 1 DAY))::date AS day
              FROM last GROUP BY repo) s
        LEFT JOIN last l ON l.repo = s.repo AND l.day = s.day
        WINDOW w AS (PARTITION BY s.repo ORDER BY s.day
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "changes": f"""changes AS (
        SELECT repo, commit_id, committer_id, day,
               {_each('coalesce(abs("{m}" - lag("{m}") OVER w), 0)::bigint AS delta_{m}')}
        FROM joined WINDOW w AS (PARTITION BY repo ORDER BY day, commit_id))""",
    "start": "start AS (SELECT repo, min(day) AS first_day FROM log GROUP BY repo)",
    "issues": """items AS (
        SELECT repo, least(day, l_shipdate::date) AS created,
               CASE WHEN l_linestatus = 'F' THEN greatest(day, l_shipdate::date) END AS closed
        FROM lineitem JOIN log ON l_orderkey = commit_id)""",
    "pulls": """items AS (
        SELECT c_nationkey::bigint AS repo, o_orderdate::date AS created,
               CASE WHEN o_orderstatus <> 'O'
                    THEN o_orderdate::date + (o_custkey % 90)::int END AS closed
        FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "open_items": f"""open_items AS (
        SELECT d.repo, d.day::timestamp AS "start",
               d.day::timestamp + INTERVAL '23:59:59' AS "end",
               count(i.created)::bigint AS open_events
        FROM (SELECT repo, unnest(generate_series(first_day, DATE '{ORDERS_AS_OF}' - 1,
                                                  INTERVAL 1 DAY))::date AS day FROM start) d
        LEFT JOIN items i ON i.repo = d.repo AND i.created <= d.day
             AND coalesce(i.closed, DATE '{ORDERS_AS_OF}')::timestamp
                 >= d.day::timestamp + INTERVAL '23:59:59'
        GROUP BY d.repo, d.day)""",
    "density": f"""density AS (
        SELECT s.repo, s.day AS "start", {_each('s."{m}"')},
               last_value(o."end"::date IGNORE NULLS) OVER w AS "end",
               last_value(o.open_events IGNORE NULLS) OVER w AS open_events
        FROM size_day s LEFT JOIN open_items o ON o.repo = s.repo AND o."start" = s.day
        WINDOW w AS (PARTITION BY s.repo ORDER BY s.day
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "revs": """revs AS (
        SELECT event_id, ts, event_type AS author, 'u' || user_id || '@x' AS author_email,
               k, event_type AS committer, 'c' || k || '@x' AS committer_email,
               'h' || event_id AS commit_hash,
               CASE k % 3 WHEN 0 THEN []::varchar[] WHEN 1 THEN ['u' || k || '@x']
                    ELSE ['u' || k || '@x', 'u' || (k + 100) || '@x'] END AS co_author_emails,
               CASE WHEN event_id = 0 THEN []::varchar[]
                    WHEN event_id % 10 = 0 THEN ['h' || (event_id - 1), 'h' || (event_id - 7)]
                    ELSE ['h' || (event_id - 1)] END AS parents
        FROM (SELECT *, (props->>'$.k')::int AS k FROM events))""",
    "hashes": """hashes AS (
        SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS id, commit_hash FROM revs)""",
    "authors": """authors AS (
        SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS id, author, author_email
        FROM (SELECT *, row_number() OVER (PARTITION BY author_email ORDER BY ts, event_id) AS rn
              FROM revs) WHERE rn = 1)""",
    "committers": """committers AS (
        SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS id, committer, committer_email
        FROM (SELECT *, row_number() OVER (PARTITION BY committer_email ORDER BY ts, event_id) AS rn
              FROM revs) WHERE rn = 1)""",
    "parent_lists": """parent_lists AS (
        SELECT r.commit_hash,
               '[' || string_agg('{"commit_hash":' || coalesce(h.id::varchar, 'null') || '}', ','
                                 ORDER BY r.pos) || ']' AS parent_hash_ids
        FROM (SELECT commit_hash, pos, parents[pos] AS parent
              FROM (SELECT *, unnest(range(1, greatest(len(parents), 1) + 1)) AS pos FROM revs)) r
        LEFT JOIN hashes h ON h.commit_hash = r.parent GROUP BY r.commit_hash)""",
    "co_lists": """co_lists AS (
        SELECT r.commit_hash,
               '[' || string_agg('{"author_email":' || coalesce(a.id::varchar, 'null') || '}', ','
                                 ORDER BY r.pos) || ']' AS co_author_ids
        FROM (SELECT commit_hash, pos, co_author_emails[pos] AS email
              FROM (SELECT *, unnest(range(1, greatest(len(co_author_emails), 1) + 1)) AS pos
                    FROM revs)) r
        LEFT JOIN authors a ON a.author_email = r.email GROUP BY r.commit_hash)""",
    "tags": """tags AS (
        SELECT 'h' || event_id AS commit_hash, event_id, ts, k >= 10 AS resolves
        FROM (SELECT event_id, ts, k,
                     unnest(CASE WHEN k >= 90 THEN ['v', 'w'] ELSE ['v'] END) AS series
              FROM (SELECT *, (props->>'$.k')::int AS k FROM events)))""",
    "pages": """pages_of AS (
        SELECT event_id // 100 AS page, arg_min(event_type, event_id) AS first_type,
               count(*) AS n FROM events GROUP BY 1)""",
}


def _register(name: str, needs: str, sql: str) -> None:
    chosen = [_PARTS[part] for part in needs.split()]
    ORACLE_SQL[name] = (f"WITH {', '.join(chosen)} " if chosen else "") + sql


_SIZES = "log files sizes joined"

_register("scan_table", "", "SELECT * FROM customer")
_register("sql_query", _SIZES, f"SELECT repo, commit_id, day, {_M} FROM joined")
_register(
    "append_new_keys",
    "",
    """SELECT o_orderkey AS commit_id, o_orderstatus,
              CASE WHEN o_orderstatus = 'O' THEN 0.0::double ELSE o_totalprice END AS o_totalprice
       FROM orders""",
)
_register("union_sources", "files", f"SELECT commit_id, provider, {_M} FROM files")
_register("file_size_ingest", "files", f"SELECT commit_id, language, provider, {_M} FROM files")
_register(
    "revision_scan",
    "revs",
    "SELECT commit_hash, ts AS committed_datetime, len(parents)::bigint AS n_parents FROM revs",
)
for _kind in ("issue", "pull_request"):
    _closed = """CASE WHEN event_type <> 'error'
                      THEN ts + to_hours((props->>'$.k')::int) END AS closed_at"""
    _register(
        f"{_kind}s_from_pages",
        "",
        f"SELECT 'i' || event_id AS {_kind}_id, ts AS created_at, {_closed} FROM events",
    )
    _register(
        f"{_kind}s_normalised",
        "",
        f"""SELECT (row_number() OVER (ORDER BY event_id) - 1)::bigint AS {_kind}_id_key,
                   ts AS created_at, {_closed} FROM events""",
    )
_register(
    "page_completeness",
    "pages",
    """SELECT sum(n)::bigint AS expected,
              (sum(n) FILTER (first_type <> 'view'))::bigint AS received,
              count(*) FILTER (first_type = 'view') AS missing_pages FROM pages_of""",
)
_register(
    "page_gaps",
    "pages",
    """SELECT 'c' || (page - 1) AS cursor FROM pages_of p
       WHERE first_type = 'view'
         AND EXISTS (SELECT 1 FROM pages_of q WHERE q.page = p.page - 1 AND q.first_type <> 'view')
       UNION ALL
       SELECT NULL FROM pages_of p
       WHERE page = 0 AND first_type = 'view'
         AND EXISTS (SELECT 1 FROM pages_of q WHERE q.first_type <> 'view')""",
)
_register(
    "text_size",
    "",
    r"""SELECT doc_id, count(line) AS "lines",
               count(*) FILTER (kind = 'code') AS "code",
               count(*) FILTER (kind = 'comment') AS "comments",
               count(*) FILTER (kind = 'blank') AS "blanks",
               any_value(size) AS "bytes"
        FROM (SELECT doc_id, size, line,
                     CASE WHEN line IS NULL THEN 'none'
                          WHEN trim(line, e' \t\r\f\x0B') = '' THEN 'blank'
                          WHEN ltrim(line, e' \t\r\f\x0B')[1] = '#'
                            OR ltrim(line, e' \t\r\f\x0B')[1:2] = '//' THEN 'comment'
                          ELSE 'code' END AS kind
              FROM (SELECT doc_id, strlen(text)::bigint AS size,
                           unnest(CASE WHEN text = '' THEN [NULL]
                                       WHEN text LIKE e'%\n'
                                       THEN string_split(text, e'\n')[:-2]
                                       ELSE string_split(text, e'\n') END) AS line
                    FROM documents))
        GROUP BY doc_id""",
)
# Comments and the text between them alternate; blackened comments keep their
# newlines, so every line can then be judged by itself.
_register(
    "text_size_blocks",
    "",
    r"""SELECT page_id, count(line) AS "lines",
               count(*) FILTER (kind = 'code') AS "code",
               count(*) FILTER (kind = 'comment') AS "comments",
               count(*) FILTER (kind = 'blank') AS "blanks",
               any_value(size) AS "bytes"
        FROM (SELECT page_id, size, line,
                     CASE WHEN line IS NULL THEN 'none'
                          WHEN trim(line, e' \t\r\f\x0B\x01') <> '' THEN 'code'
                          WHEN contains(line, e'\x01') THEN 'comment'
                          ELSE 'blank' END AS kind
              FROM (SELECT page_id, size,
                           unnest(CASE WHEN body = '' THEN [NULL]
                                       ELSE string_split(array_to_string(
                                  list_transform(range(1, len(outside) + 1), lambda i:
                                      outside[i] || coalesce(e'\x01' || regexp_replace(
                                          regexp_replace(inside[i], e'[^\n]', e'\x01', 'g'),
                                          e'\n', e'\x01\n\x01', 'g'), '')), ''), e'\n') END) AS line
                    FROM (SELECT page_id, size, body,
                                 string_split_regex(body, '(?s)<!--.*?(?:-->|\z)') AS outside,
                                 regexp_extract_all(body, '(?s)<!--.*?(?:-->|\z)') AS inside
                          FROM (SELECT page_id, strlen(t)::bigint AS size,
                                       CASE WHEN t LIKE e'%\n' THEN t[:-2] ELSE t END AS body
                                FROM (SELECT page_id, replace(html, '<', e'\n<') AS t
                                      FROM pages)))))
        GROUP BY page_id""",
)
_register("day_bucket", "", "SELECT event_id, ts::date AS day FROM events")
_register("project_start", "log", "SELECT repo, min(day) AS start FROM log GROUP BY repo")
_SPINE = f"""SELECT repo, unnest(generate_series(min(day), DATE '{ORDERS_AS_OF}',
                                  INTERVAL 1 DAY))::date AS day FROM log GROUP BY repo"""
_register("calendar_spine", "log", _SPINE)
_register(
    "calendar_align",
    "log",
    f"""SELECT s.repo, s.day, c.commits FROM ({_SPINE}) s
        LEFT JOIN (SELECT repo, day, count(*) AS commits FROM log GROUP BY repo, day) c
          ON c.repo = s.repo AND c.day = s.day""",
)
_register("revision_count", "log", "SELECT repo, count(*) AS revisions FROM log GROUP BY repo")
_register("size_per_commit", "files sizes", f"SELECT commit_id, {_M} FROM sizes")
_register("size_commit_log_join", _SIZES, "SELECT * FROM joined")
_register("last_of_day", f"{_SIZES} last", "SELECT * FROM last")
_register("size_per_day", f"{_SIZES} last size_day", "SELECT * FROM size_day")
_register(
    "productivity_per_commit", f"{_SIZES} changes", f"SELECT repo, commit_id, {_D} FROM changes"
)
_register(
    "productivity_one_project",
    _SIZES,
    f"""SELECT commit_id,
               {_each('coalesce(abs("{m}" - lag("{m}") OVER w), 0)::bigint AS delta_{m}')}
        FROM joined WINDOW w AS (ORDER BY day, commit_id)""",
)
for _name, _day in (("productivity_per_day", "day"), ("stored_productivity_per_day", "date")):
    _register(
        _name,
        f"{_SIZES} changes",
        f"""SELECT s.repo, s.day AS "{_day}", {_each("coalesce(sum({m}), 0)::bigint AS {m}", DELTAS)}
            FROM (SELECT repo, unnest(generate_series(min(day), DATE '{ORDERS_AS_OF}',
                                                      INTERVAL 1 DAY))::date AS day
                  FROM changes GROUP BY repo) s
            LEFT JOIN changes c ON c.repo = s.repo AND c.day = s.day GROUP BY s.repo, s.day""",
    )
_register(
    "contribution_per_day",
    f"{_SIZES} changes",
    f"""SELECT s.repo, s.day, coalesce(c.committer_id, -1) AS committer_id,
               {_each("coalesce(sum(c.{m}), -1)::bigint AS {m}", DELTAS)}
        FROM (SELECT repo, unnest(generate_series(min(day), max(day),
                                                  INTERVAL 1 DAY))::date AS day
              FROM changes GROUP BY repo) s
        LEFT JOIN changes c ON c.repo = s.repo AND c.day = s.day
        GROUP BY s.repo, s.day, c.committer_id""",
)
_register("open_items_per_day", "log start issues open_items", "SELECT * FROM open_items")
_register("open_pull_requests_per_day", "log start pulls open_items", "SELECT * FROM open_items")
_DENSITY = f"{_SIZES} last size_day start issues open_items density"
_register("issue_density_per_day", _DENSITY, "SELECT * FROM density")
_register("issue_density_from_daily_tables", _DENSITY, "SELECT * FROM density")
_register("stored_issue_density_per_day", _DENSITY, "SELECT * FROM density")
_register(
    "landed_issue_density_per_day",
    _DENSITY.replace(" last ", " last_in_log "),
    "SELECT * FROM density",
)
# a repository's pages of 100 items; of seven pages the fourth is lost
_LANDED = """per_repo AS (
        SELECT repo, count(*) AS total, (count(*) + 99) // 100 AS wanted FROM items GROUP BY repo),
    asked AS (
        SELECT repo, total, wanted, unnest(range(0, wanted)) AS page FROM per_repo),
    landed AS (SELECT * FROM asked WHERE page % 7 <> 3)"""
_LOST_ITEMS = "sum(least(total, page * 100 + 100) - page * 100) FILTER (page % 7 = 3)"
for _name, _sql in {
    "page_completeness_per_repository": f"""SELECT repo, max(total) AS expected,
            (max(total) - coalesce({_LOST_ITEMS}, 0))::bigint AS received,
            count(*) FILTER (page % 7 = 3) AS missing_pages FROM asked GROUP BY repo""",
    "page_chain": """SELECT repo, page, CASE WHEN page > 0 THEN 'c' || (page - 1) END AS "after",
            CASE WHEN page < wanted - 1 THEN 'c' || page END AS "end",
            CASE WHEN page >= 4 THEN 'c' || (((page - 4) // 7) * 7 + 3) END AS run,
            CASE WHEN page >= 4 THEN (page - 4) % 7 ELSE page END AS place, false AS in_cycle
            FROM landed""",
    "lost_pages": """SELECT repo, 'c' || (page - 1) AS cursor, page AS first_page, 1::bigint AS pages
            FROM asked WHERE page % 7 = 3""",
}.items():
    ORACLE_SQL[_name] = f"WITH {_PARTS['log']}, {_PARTS['issues']}, {_LANDED} {_sql}"
_register(
    "landing_rejects",
    "",
    """SELECT * FROM (
         SELECT CASE event_id % 50
                    WHEN 7 THEN '{"commit_hash": "h' || event_id || '", "ordinal": ' || event_id
                    WHEN 9 THEN '{"ordinal": ' || event_id || '}'
                    WHEN 11 THEN '{"commit_hash": "h' || event_id || '", "ordinal": "x"}' END AS line,
                CASE event_id % 50 WHEN 9 THEN 'missing commit_hash' ELSE 'malformed' END AS reason
         FROM events) WHERE line IS NOT NULL""",
)
# levels by walking from the roots, one step a turn
_PARTS["history"] = """numbered AS (
        SELECT repo, day, row_number() OVER (PARTITION BY repo ORDER BY commit_id) - 1 AS n FROM log),
    parents AS (
        SELECT repo, n, unnest(CASE WHEN n % 10 = 3 THEN [n - 3] WHEN n % 10 = 8 THEN [n - 6]
                                    WHEN n % 10 = 9 THEN [n - 1, n - 2] ELSE [n - 1] END) AS p
        FROM numbered WHERE n > 0 AND n % 100 <> 50),
    walk AS (
        SELECT repo, n, 0 AS level FROM numbered WHERE n = 0 OR n % 100 = 50
        UNION
        SELECT parents.repo, parents.n, level + 1 FROM walk
        JOIN parents ON parents.repo = walk.repo AND parents.p = walk.n),
    placed AS (SELECT repo, n, max(level)::bigint AS level FROM walk GROUP BY repo, n)"""
_register(
    "log_order_from_parents",
    "log history",
    """SELECT p.repo, 'n' || p.n AS commit_hash, level,
              row_number() OVER (PARTITION BY p.repo ORDER BY level, day, 'n' || p.n) - 1 AS ordinal
       FROM placed p JOIN numbered d ON d.repo = p.repo AND d.n = p.n""",
)
ORACLE_SQL["log_order_from_parents"] = ORACLE_SQL["log_order_from_parents"].replace(
    "WITH log", "WITH RECURSIVE log", 1
)
_register(
    "stored_issues_in_two_loads",
    "log issues",
    """SELECT repo, concat_ws('/', created, coalesce(closed::varchar, 'open'), n) AS issue_id,
              created::timestamp AS created_at, closed::timestamp AS closed_at
       FROM (SELECT *, row_number() OVER (PARTITION BY repo, created, closed) - 1 AS n FROM items)""",
)
_register(
    "stored_releases_by_repo",
    "log",
    """SELECT repo, 'o' || commit_id AS commit_hash
       FROM (SELECT *, unnest(range(0, CASE WHEN commit_id % 4 = 0 THEN 2 ELSE 1 END)) FROM log)
       JOIN orders ON o_orderkey = commit_id
       WHERE o_orderpriority = '1-URGENT' AND commit_id % 6 <> 0 AND commit_id % 9 <> 0""",
)
_register(
    "stored_sql", "log",
    "SELECT repo, 'c' || committer_id AS committer, count(*) AS commits FROM log GROUP BY 1, 2",
)
_register(
    "rejected_items",
    "log",
    """SELECT * FROM (
         SELECT repo, concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS item,
                l_shipdate::date AS created,
                CASE WHEN l_linestatus = 'F' THEN day END AS closed
         FROM lineitem JOIN log ON l_orderkey = commit_id)
       WHERE created IS NULL OR closed < created""",
)
_register(
    "issue_density_ratio",
    _DENSITY,
    """SELECT repo, "start",
              round(open_events * 1000 / nullif("lines", 0)::double, 6) AS open_per_kline
       FROM density""",
)
_register("commit_hashes", "revs hashes", "SELECT id::bigint AS id, commit_hash FROM hashes")
_register("authors_dim", "revs authors", "SELECT * FROM authors")
_register("committers_dim", "revs committers", "SELECT * FROM committers")
_register(
    "surrogate_keys",
    "",
    "SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS id, event_id FROM events",
)
_register(
    "key_reference",
    "revs hashes authors",
    """SELECT h.id AS commit_hash_id, a.id AS author_id FROM revs r
       JOIN hashes h ON h.commit_hash = r.commit_hash
       LEFT JOIN authors a ON a.author_email = r.author_email""",
)
_LISTS = "revs hashes authors parent_lists co_lists"
_register(
    "key_reference_list",
    _LISTS,
    """SELECT h.id AS commit_hash_id, p.parent_hash_ids, c.co_author_ids FROM hashes h
       JOIN parent_lists p ON p.commit_hash = h.commit_hash
       JOIN co_lists c ON c.commit_hash = h.commit_hash""",
)
_register(
    "commit_edges",
    "revs",
    """SELECT commit_hash, pos - 1 AS pos, parents[pos] AS parent_hash
       FROM (SELECT *, unnest(range(1, len(parents) + 1)) AS pos FROM revs)""",
)
_register(
    "co_authors",
    "",
    """SELECT event_id, pos - 1 AS pos, people[pos] || k AS name,
              lower(people[pos]) || k || '@x' AS email
       FROM (SELECT *, unnest(range(1, len(people) + 1)) AS pos
             FROM (SELECT event_id, k, CASE k % 3 WHEN 0 THEN []::varchar[] WHEN 1 THEN ['U']
                                       ELSE ['U', 'V'] END AS people
                   FROM (SELECT event_id, (props->>'$.k')::int AS k FROM events)))""",
)
_register(
    "releases",
    "revs hashes tags",
    """SELECT h.id AS commit_hash_id FROM tags t JOIN hashes h ON h.commit_hash = t.commit_hash
       WHERE t.resolves""",
)
_register(
    "new_revisions",
    "revs",
    f"SELECT commit_hash FROM revs WHERE ts >= TIMESTAMP '{EARLIER_LOAD_UNTIL}'",
)
_register(
    "new_releases",
    "revs hashes tags",
    f"""SELECT h.id AS commit_hash_id FROM tags t JOIN hashes h ON h.commit_hash = t.commit_hash
        WHERE t.resolves AND t.ts >= TIMESTAMP '{EARLIER_LOAD_UNTIL}'""",
)
for _name in ("normalised_log", "normalised_log_in_two_loads"):
    _register(
        _name,
        f"{_LISTS} committers",
        """SELECT h.id AS commit_hash_id, a.id AS author_id, m.id AS committer_id,
                  c.co_author_ids, p.parent_hash_ids, r.ts AS authored_datetime,
                  r.ts AS committed_datetime, 'UTF-8' AS encoding,
                  'change ' || r.author || chr(10)
                  || CASE WHEN k % 3 > 0
                          THEN chr(10) || 'Co-authored-by: U' || k || ' <u' || k || '@x>' ELSE '' END
                  || CASE WHEN k % 3 > 1
                          THEN chr(10) || 'Co-authored-by: V' || k || ' <v' || k || '@x>' ELSE '' END AS message,
                  NULL::varchar AS gpgsign
           FROM revs r JOIN hashes h ON h.commit_hash = r.commit_hash
           JOIN authors a ON a.author_email = r.author_email
           JOIN committers m ON m.committer_email = r.committer_email
           JOIN parent_lists p ON p.commit_hash = r.commit_hash
           JOIN co_lists c ON c.commit_hash = r.commit_hash""",
    )
_register(
    "schema_violations",
    "",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "column", rule FROM (
         SELECT *, 'language' AS "column", 'null' AS rule FROM lineitem WHERE l_returnflag = 'N'
         UNION ALL SELECT *, 'comments', 'type' FROM lineitem WHERE l_linestatus = 'F'
         UNION ALL SELECT *, 'lines', 'fraction' FROM lineitem WHERE l_quantity <> floor(l_quantity)
         UNION ALL SELECT *, 'blanks', 'fraction' FROM lineitem WHERE l_tax <> floor(l_tax)
         UNION ALL SELECT *, 'bytes', 'fraction' FROM lineitem
                   WHERE l_extendedprice <> floor(l_extendedprice))""",
)
_SUSPECT = """suspect AS (
        SELECT *, CASE WHEN l_linestatus = 'F' THEN 'type' WHEN l_linenumber IN (2, 4) THEN 'fraction' END AS of_comments
        FROM lineitem),
    broken AS (
        SELECT *, 'language' AS "column", 'null' AS rule FROM suspect WHERE l_returnflag = 'N'
        UNION ALL SELECT *, 'comments', of_comments FROM suspect WHERE of_comments IS NOT NULL
        UNION ALL SELECT *, 'lines', 'fraction' FROM suspect WHERE l_quantity <> floor(l_quantity)
        UNION ALL SELECT *, 'blanks', 'fraction' FROM suspect WHERE l_tax <> floor(l_tax)
        UNION ALL SELECT *, 'bytes', 'fraction' FROM suspect WHERE l_extendedprice <> floor(l_extendedprice)
        UNION ALL SELECT *, 'day', 'time' FROM suspect WHERE l_linenumber = 1)"""
_ROW_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
ORACLE_SQL["schema_violations_exact"] = f'WITH {_SUSPECT} SELECT {_ROW_KEY}, "column", rule FROM broken'
ORACLE_SQL["rejected_rows_by_rule"] = f"""WITH {_SUSPECT}
    SELECT "column", rule, count(*) AS rows FROM broken GROUP BY 1, 2
    UNION ALL
    SELECT NULL, NULL, count(*) FROM suspect
    WHERE l_returnflag <> 'N' AND of_comments IS NULL AND l_quantity = floor(l_quantity)
      AND l_tax = floor(l_tax) AND l_extendedprice = floor(l_extendedprice) AND l_linenumber <> 1"""
_register(
    "append_conflicts",
    "",
    """SELECT commit_id, o_totalprice, 'stored' AS kind
       FROM (SELECT o_orderkey AS commit_id, o_totalprice AS had,
                    CASE WHEN o_orderkey % 12 = 0 THEN 0.0::double ELSE o_totalprice END AS o_totalprice
             FROM orders WHERE o_orderkey % 6 = 0
             UNION ALL
             SELECT o_orderkey, o_totalprice, -1.0::double FROM orders WHERE o_orderkey % 30 = 0)
       WHERE o_totalprice <> had
       UNION ALL
       SELECT o_orderkey, CASE WHEN o_orderkey % 12 = 0 THEN 0.0::double ELSE o_totalprice END, 'batch'
       FROM orders WHERE o_orderkey % 10 = 0
       UNION ALL SELECT o_orderkey, -1.0::double, 'batch' FROM orders WHERE o_orderkey % 10 = 0""",
)
_register(
    "stored_constraint_report",
    "",
    """SELECT 'unique' AS rule, 'customer' AS "table", 'c_custkey' AS "column", c_custkey AS value,
              2::bigint AS rows FROM customer WHERE c_custkey % 7 = 0
       UNION ALL
       SELECT 'foreign', 'lineitem', 'l_orderkey', l_orderkey, count(*) FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey
       UNION ALL
       SELECT 'foreign', 'orders', 'o_custkey', o_custkey, count(*) FROM orders
       WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey""",
)
_register("stored_size_refreshed", f"{_SIZES} last size_day", "SELECT * FROM size_day")
ORACLE_SQL["stored_productivity_refreshed"] = ORACLE_SQL["stored_productivity_per_day"]
ORACLE_SQL["stored_density_refreshed"] = ORACLE_SQL["stored_issue_density_per_day"]
_register(
    "stored_contribution_refreshed",
    f"{_SIZES} changes",
    f"""SELECT s.repo, s.day AS "date", 'c' || c.committer_id AS committer,
               {_each("coalesce(sum(c.{m}), -1)::bigint AS {m}", DELTAS)}
        FROM (SELECT repo, unnest(generate_series(min(day), max(day),
                                                  INTERVAL 1 DAY))::date AS day
              FROM changes GROUP BY repo) s
        LEFT JOIN changes c ON c.repo = s.repo AND c.day = s.day
        GROUP BY s.repo, s.day, c.committer_id""",
)
_register(
    "orphan_keys",
    "log",
    "SELECT commit_id FROM log WHERE commit_id NOT IN (SELECT l_orderkey FROM lineitem)",
)
_register("stream_new_revisions", "", "SELECT event_id FROM events")
_register(
    "stream_daily_activity",
    "",
    """SELECT ts::date AS day, user_id, count(*) AS n,
              sum(value::varchar::decimal(38, 18))::double AS total
       FROM events
       WHERE ts::date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
       GROUP BY 1, 2""",
)
_register("stream_revisions_by_folder", "", "SELECT * FROM events")
_register(
    "stream_size_log_join",
    _SIZES,
    f"SELECT repo, commit_id, committer_id, day, {_M} FROM joined WHERE commit_id % 4 <= 2",
)
ORACLE_SQL["stored_productivity_in_buckets"] = ORACLE_SQL["stored_productivity_per_day"]
_register("stored_size_log_join", _SIZES, f"SELECT repo, day, {_M} FROM joined")
