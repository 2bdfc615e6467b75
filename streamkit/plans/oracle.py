"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark plans: plain window functions where the
Spark side uses the blocked scan, row-level window enumeration where it uses
panes, a brute-force join for count windows.  Sums are cast to BIGINT
(DuckDB widens to HUGEINT).
"""

from __future__ import annotations

# Fixed value: single-character whitespace class, same as streamkit.functions.text.WHITESPACE.
WS = r"[ \t\n\x0B\f\r]"

EVENTS = """
events_c AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(round(value * 100) AS BIGINT) AS cents,
         contains(event_type, 'c') AS has_c
  FROM events
)"""

US_HOUR = 3_600_000_000
US_MIN = 60_000_000

ROLL = "OVER (PARTITION BY has_c ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _part_tokens(first: str, second: str, first_idx: int = 1, second_idx: int = 2) -> str:
    return f"""
part_tokens AS (
  SELECT p_partkey, 0 AS pos, {first}(string_split(p_name, ' ')[{first_idx}]) AS token FROM part
  UNION ALL
  SELECT p_partkey, 1 AS pos, {second}(string_split(p_name, ' ')[{second_idx}]) AS token FROM part
)"""


def _tumbling(size_us: int, ts: str = "ts") -> tuple[str, str]:
    start = f"make_timestamp((epoch_us({ts}) // {size_us}) * {size_us})"
    end = f"make_timestamp((epoch_us({ts}) // {size_us}) * {size_us} + {size_us})"
    return start, end


def _sliding_rows(source: str, cols: str, size_us: int, slide_us: int, ts: str = "ts") -> str:
    """Rows of ``source`` repeated once per sliding window containing them (k = window index)."""
    return f"""
SELECT {cols}, k
FROM (
  SELECT *, unnest(generate_series(
           CAST(floor((epoch_us({ts}) - {size_us}) / {slide_us}) AS BIGINT) + 1,
           CAST(floor(epoch_us({ts}) / {slide_us}) AS BIGINT))) AS k
  FROM {source}
)"""


def _win_cols(slide_us: int, size_us: int) -> str:
    return (f"make_timestamp(k * {slide_us}) AS window_start, "
            f"make_timestamp(k * {slide_us} + {size_us}) AS window_end")


ORACLE = {
    "sequence_map": """
WITH s AS (SELECT unnest(generate_series(min(o_orderkey), max(o_orderkey))) AS value FROM orders)
SELECT value, 2 * value AS doubled FROM s""",
    "sequence_predicate": """
WITH s AS (SELECT unnest(generate_series(min(o_orderkey), max(o_orderkey))) AS value FROM orders)
SELECT value, value <> 1 AS keep FROM s""",
    "token_case_flatmap": f"WITH {_part_tokens('upper', 'lower')} SELECT p_partkey, pos, token FROM part_tokens",
    "token_filter": f"""WITH {_part_tokens('lower', 'upper', 2, 1)}
SELECT p_partkey, pos, token FROM part_tokens WHERE contains(token, 'r')""",
    "word_count": f"""
WITH t AS (SELECT text, regexp_replace(text, '{WS}+$', '') AS s FROM documents),
w AS (
  SELECT unnest(CASE WHEN s = '' AND text <> '' THEN CAST([] AS VARCHAR[])
                     ELSE string_split_regex(s, '{WS}') END) AS word
  FROM t
)
SELECT word, count(*) AS count FROM w GROUP BY word""",
    "parse_pairs": f"""WITH {EVENTS}
SELECT event_id, split_part(line, ' ', 1) AS key, CAST(split_part(line, ' ', 2) AS INTEGER) AS n
FROM (SELECT event_id, concat_ws(' ', event_type, CAST(cents AS VARCHAR)) AS line FROM events_c)""",
    "pair_length": "SELECT doc_id, CAST(length(text) AS INTEGER) AS len FROM documents",
    "csv_sink_format": "SELECT p_partkey, concat_ws('----', lower(p_name), upper(p_name)) AS line FROM part",
    "document_lines": """
WITH l AS (
  SELECT doc_id,
         CASE WHEN text = '' THEN CAST([] AS VARCHAR[])
              WHEN regexp_matches(text, '(\r\n|\r|\n)$')
                THEN list_slice(string_split_regex(text, '\r\n|\r|\n'), 1, -2)
              ELSE string_split_regex(text, '\r\n|\r|\n') END AS arr
  FROM documents
)
SELECT doc_id, CAST(unnest(generate_series(0, len(arr) - 1)) AS INTEGER) AS line_no, unnest(arr) AS line FROM l""",
    "text_roundtrip": "SELECT p_name AS value FROM part",
    "delimited_roundtrip": """
SELECT lower(p_name) || '----' || CASE WHEN p_size % 3 > 0 THEN CAST(p_size AS VARCHAR) ELSE '' END || '----' || upper(p_name) AS value FROM part""",
    "key_by_letter": f"""WITH {_part_tokens('upper', 'upper')}
SELECT p_partkey, pos, token, contains(token, 'L') AS key FROM part_tokens""",
    "rolling_sum": f"""WITH {EVENTS}
SELECT event_id, has_c,
       first_value(event_type) {ROLL} AS event_type,
       CAST(sum(cents) {ROLL} AS BIGINT) AS cents
FROM events_c""",
    "rolling_sum_global": f"""WITH {EVENTS}
SELECT event_id, cents, 1 AS key,
       CAST(sum(cents) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS running_cents
FROM events_c""",
    "rolling_reduce": f"""WITH {EVENTS}
SELECT event_id, has_c,
       CASE WHEN row_number() {ROLL} = 1 THEN event_type WHEN has_c THEN 'c' ELSE 'n' END AS event_type,
       CAST(sum(cents) {ROLL} AS BIGINT) AS cents
FROM events_c""",
    "rolling_fold": f"""WITH {EVENTS}
SELECT event_id, has_c, 100 + count(*) {ROLL} AS fold FROM events_c""",
    "rolling_max": f"""WITH {EVENTS}
SELECT event_id, has_c, first_value(event_type) {ROLL} AS event_type, max(value) {ROLL} AS value FROM events_c""",
    "rolling_min": f"""WITH {EVENTS}
SELECT event_id, has_c, first_value(event_type) {ROLL} AS event_type, min(value) {ROLL} AS value FROM events_c""",
    "rolling_maxby": f"""WITH {EVENTS},
b AS (SELECT event_id, has_c,
             max({{'v': value, 'o': -event_id, 'id': event_id, 't': event_type}}) {ROLL} AS best
      FROM events_c)
SELECT event_id, has_c, best.id AS best_event_id, best.t AS best_event_type, best.v AS best_value FROM b""",
    "rolling_minby": f"""WITH {EVENTS},
b AS (SELECT event_id, has_c,
             min({{'v': value, 'o': event_id, 'id': event_id, 't': event_type}}) {ROLL} AS best
      FROM events_c)
SELECT event_id, has_c, best.id AS best_event_id, best.t AS best_event_type, best.v AS best_value FROM b""",
    "union_self": f"""WITH {_part_tokens('upper', 'upper')}
SELECT p_partkey, pos, token FROM part_tokens UNION ALL SELECT p_partkey, pos, token FROM part_tokens""",
    "split_tags": f"""WITH {_part_tokens('upper', 'upper')}
SELECT p_partkey, pos, token,
       CASE WHEN contains(token, 'L') THEN 'LLLL' WHEN contains(token, 'R') THEN 'RRRR' ELSE '****' END AS output
FROM part_tokens""",
    "split_select": f"""WITH {_part_tokens('upper', 'upper')}
SELECT p_partkey, pos, token FROM part_tokens WHERE NOT contains(token, 'L') AND contains(token, 'R')""",
    "select_lower": f"""WITH {_part_tokens('upper', 'upper')}
SELECT p_partkey, pos, lower(token) AS token FROM part_tokens WHERE contains(token, 'L')""",
    "co_map": f"""WITH {_part_tokens('lower', 'upper', 2, 1)}
SELECT 1 AS side, token AS value FROM part_tokens WHERE contains(token, 'r')
UNION ALL
SELECT 2 AS side, CAST(p_size AS VARCHAR) AS value FROM part""",
    "co_flat_map": """
SELECT 1 AS side, 0 AS pos, upper(string_split(p_name, ' ')[1]) AS value FROM part
UNION ALL
SELECT 2 AS side, 0 AS pos, CAST(len(string_split(p_name, ' ')) AS VARCHAR) AS value FROM part""",
    "tumbling_sum": f"""WITH {EVENTS}
SELECT user_id, {_tumbling(US_HOUR)[0]} AS window_start, {_tumbling(US_HOUR)[1]} AS window_end,
       CAST(sum(cents) AS BIGINT) AS cents
FROM events_c GROUP BY ALL""",
    "tumbling_max": f"""WITH {EVENTS}
SELECT user_id, {_tumbling(US_HOUR)[0]} AS window_start, {_tumbling(US_HOUR)[1]} AS window_end,
       max(value) AS max_value
FROM events_c GROUP BY ALL""",
    "tumbling_fold": f"""WITH {EVENTS}
SELECT user_id, {_tumbling(US_HOUR)[0]} AS window_start, {_tumbling(US_HOUR)[1]} AS window_end,
       100 + count(*) AS fold
FROM events_c GROUP BY ALL""",
    "tumbling_maxby": f"""WITH {EVENTS},
b AS (SELECT event_type, {_tumbling(6 * US_HOUR)[0]} AS window_start, {_tumbling(6 * US_HOUR)[1]} AS window_end,
             max({{'v': value, 'o': -event_id, 'id': event_id}}) AS best
      FROM events_c GROUP BY ALL)
SELECT event_type, window_start, window_end, best.id AS best_event_id, best.v AS best_value FROM b""",
    "sliding_sum": f"""WITH {EVENTS}, r AS ({_sliding_rows('events_c', 'user_id, cents', US_HOUR, 20 * US_MIN)})
SELECT user_id, {_win_cols(20 * US_MIN, US_HOUR)}, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS n
FROM r GROUP BY user_id, k""",
    "sliding_nondividing": f"""WITH {EVENTS}, r AS ({_sliding_rows('events_c', 'user_id, cents', 50 * US_MIN, 20 * US_MIN)})
SELECT user_id, {_win_cols(20 * US_MIN, 50 * US_MIN)}, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS n
FROM r GROUP BY user_id, k""",
    "sliding_max_by_type": f"""WITH {EVENTS}, r AS ({_sliding_rows('events_c', 'event_type, value', 2 * US_HOUR, US_HOUR)})
SELECT event_type, {_win_cols(US_HOUR, 2 * US_HOUR)}, max(value) AS max_value, min(value) AS min_value
FROM r GROUP BY event_type, k""",
    "global_concat": f"""WITH {EVENTS},
r AS ({_sliding_rows('events_c', 'event_id, ts, event_type', 6 * US_HOUR, 3 * US_HOUR)})
SELECT {_win_cols(3 * US_HOUR, 6 * US_HOUR)},
       string_agg(event_type, '' ORDER BY ts, event_id) AS concat,
       CAST(sum(length(event_type)) AS BIGINT) AS total_len
FROM r GROUP BY k""",
    "windowed_word_count": f"""
WITH t AS (SELECT doc_id, text, regexp_replace(text, '{WS}+$', '') AS s FROM documents),
w AS (
  SELECT make_timestamp(doc_id * 1000000) AS ts,
         unnest(CASE WHEN s = '' AND text <> '' THEN CAST([] AS VARCHAR[])
                     ELSE string_split_regex(s, '{WS}') END) AS word
  FROM t
),
r AS ({_sliding_rows('w', 'word', 5_000_000, 1_000_000)})
SELECT word, {_win_cols(1_000_000, 5_000_000)}, count(*) AS count FROM r GROUP BY word, k""",
    "count_tumbling": f"""WITH {EVENTS},
r AS (SELECT user_id, cents, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events_c)
SELECT user_id, CAST((((rn - 1) // 5) + 1) * 5 AS BIGINT) AS window_end_count, CAST(sum(cents) AS BIGINT) AS cents
FROM r GROUP BY user_id, (rn - 1) // 5 HAVING count(*) = 5""",
    "count_sliding": f"""WITH {EVENTS},
r AS (SELECT user_id, cents, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events_c),
ends AS (SELECT user_id, unnest(generate_series(2, max(rn), 2)) AS e FROM r GROUP BY user_id)
SELECT ends.user_id, CAST(e AS BIGINT) AS window_end_count, CAST(sum(cents) AS BIGINT) AS cents
FROM ends JOIN r ON r.user_id = ends.user_id AND r.rn BETWEEN e - 4 AND e
GROUP BY ends.user_id, e""",
    "count_sliding_by_type": f"""WITH {EVENTS},
r AS (SELECT event_type, cents, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events_c),
ends AS (SELECT event_type, unnest(generate_series(2, max(rn), 2)) AS e FROM r GROUP BY event_type)
SELECT ends.event_type, CAST(e AS BIGINT) AS window_end_count, CAST(sum(cents) AS BIGINT) AS cents
FROM ends JOIN r ON r.event_type = ends.event_type AND r.rn BETWEEN e - 4 AND e
GROUP BY ends.event_type, e""",
    "session_by_user": f"""WITH {EVENTS},
m AS (SELECT user_id, ts, event_id, cents,
             CASE WHEN lag(ts) OVER w IS NULL
                    OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {6 * US_HOUR} THEN 1 ELSE 0 END AS st
      FROM events_c WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM m)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end,
       count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM s GROUP BY user_id, sid""",
    "session_by_type": f"""WITH {EVENTS},
m AS (SELECT event_type, ts, event_id, cents,
             CASE WHEN lag(ts) OVER w IS NULL
                    OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {10 * US_MIN} THEN 1 ELSE 0 END AS st
      FROM events_c WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
s AS (SELECT *, sum(st) OVER (PARTITION BY event_type ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM m)
SELECT event_type, min(ts) AS session_start, max(ts) + INTERVAL 10 MINUTE AS session_end,
       count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM s GROUP BY event_type, sid""",
    "compound_growth": """
SELECT c_custkey, total, total / 36 AS per_period
FROM (SELECT c_custkey,
             list_reduce(list_concat([c_acctbal], list_transform(range(36), lambda x: CAST(1.0 AS DOUBLE) + CAST(0.004 AS DOUBLE))),
                         lambda a, b: a * b) AS total
      FROM customer)""",
}

NULLABLE = f"""{EVENTS},
n AS (SELECT event_id, ts, user_id, has_c, event_type,
             CASE WHEN event_id % 7 > 0 THEN value END AS value, CASE WHEN event_id % 7 > 0 THEN cents END AS cents FROM events_c)"""
_STEP = "lambda a, b: (a * 3 + b) % 1000003"

ORACLE.update({
    "rolling_minby_nullable": f"""WITH {NULLABLE},
b AS (SELECT event_id, has_c, min({{'v': value, 'id': event_id}}) FILTER (WHERE value IS NOT NULL) {ROLL} AS best FROM n)
SELECT event_id, has_c, coalesce(best.id, -1) AS best_event_id, coalesce(best.v, -1) AS best_value FROM b""",
    "rolling_sum_null_order": f"""WITH {NULLABLE}, s AS (SELECT *, CASE WHEN event_id % 3 > 0 THEN event_id // 50 END AS slot FROM n)
SELECT event_id, has_c,
       CAST(coalesce(sum(cents) OVER (PARTITION BY has_c ORDER BY slot NULLS FIRST, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS BIGINT) AS running_cents
FROM s""",
    "rolling_sum_lines": f"""WITH d AS ({ORACLE['document_lines']}), p AS (SELECT 'file:///texts/' || doc_id || '.txt' AS path, line_no, line FROM d)
SELECT path, line_no,
       CAST(sum(length(line)) OVER (PARTITION BY contains(line, 'q') ORDER BY path, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running
FROM p""",
    "rolling_sum_by_position": f"""WITH {EVENTS}
SELECT event_type, event_id, cents,
       CAST(sum(cents) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents
FROM events_c""",
    "rolling_python_fold": f"""WITH {NULLABLE}, u AS (SELECT *, CASE WHEN user_id % 5 > 0 THEN CAST(user_id AS BIGINT) END AS "user" FROM n),
l AS (SELECT "user", event_id, event_type,
             list(coalesce(cents, 0)) OVER (PARTITION BY "user" ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM u)
SELECT coalesce("user", -1) AS user_id, event_id, CAST(list_reduce(list_concat([CAST(7 AS BIGINT)], c), {_STEP}) AS BIGINT) AS weight, event_type AS last_type FROM l""",
    "tumbling_python_reduce": f"""WITH {EVENTS},
l AS (SELECT event_type, {_tumbling(6 * US_HOUR)[0]} AS window_start, {_tumbling(6 * US_HOUR)[1]} AS window_end,
             list(cents ORDER BY ts, event_id) AS c, list(event_id ORDER BY ts, event_id) AS ids FROM events_c GROUP BY ALL)
SELECT event_type, window_start, window_end, ids[1] AS event_id, CAST(list_reduce(c, {_STEP}) AS BIGINT) AS weight FROM l""",
    # the closed form of the fold: 3^n (7 + sum of c_i / 3^i), modulo a prime (666669 is 1/3)
    "rolling_python_monoid": f"""WITH RECURSIVE {NULLABLE},
r AS (SELECT event_id, has_c, coalesce(cents, 0) AS c, first_value(event_id) {ROLL} AS first_id, row_number() {ROLL} AS rn FROM n),
pw(i, up, down) AS (SELECT 0::BIGINT, 1::BIGINT, 1::BIGINT UNION ALL SELECT i + 1, up * 3 % 1000003, down * 666669 % 1000003 FROM pw WHERE i < (SELECT max(rn) FROM r)),
s AS (SELECT event_id, has_c, first_id, up, sum(c * down % 1000003) {ROLL} AS total FROM r JOIN pw ON i = rn)
SELECT event_id, has_c, first_id, CAST(up * ((7 + total) % 1000003) % 1000003 AS BIGINT) AS weight FROM s""",
    "sliding_python_monoid": f"""WITH {EVENTS}, r AS ({_sliding_rows('events_c', 'event_id, cents, ts', 12 * US_HOUR, 5 * US_HOUR)}),
l AS (SELECT {_win_cols(5 * US_HOUR, 12 * US_HOUR)}, list(cents ORDER BY ts, event_id) AS c, first(event_id ORDER BY ts, event_id) AS first_id FROM r GROUP BY k)
SELECT window_start, window_end, first_id, CAST(list_reduce(list_concat([CAST(0 AS BIGINT)], c), {_STEP}) AS BIGINT) AS weight FROM l""",
    "count_python_monoid": f"""WITH {EVENTS},
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events_c),
l AS (SELECT event_type, ((rn - 1) // 50 + 1) * 50 AS window_end_count, list(cents ORDER BY event_id) AS c, min(event_id) AS first_id FROM r GROUP BY ALL HAVING count(*) = 50)
SELECT event_type, window_end_count, first_id, CAST(list_reduce(list_concat([CAST(0 AS BIGINT)], c), {_STEP}) AS BIGINT) AS weight FROM l""",
    "tumbling_minby": f"""WITH {EVENTS},
b AS (SELECT event_type, {_tumbling(6 * US_HOUR)[0]} AS window_start, {_tumbling(6 * US_HOUR)[1]} AS window_end,
             min({{'v': value, 'id': event_id}}) AS best
      FROM events_c GROUP BY ALL)
SELECT event_type, window_start, window_end, best.id AS best_event_id, best.v AS best_value FROM b""",
    "sliding_minute_steps": f"""WITH {EVENTS}, r AS ({_sliding_rows('events_c', 'event_type, value', 48 * US_HOUR, 30 * US_MIN)})
SELECT event_type, {_win_cols(30 * US_MIN, 48 * US_HOUR)}, count(*) AS n, max(value) AS max_value FROM r GROUP BY event_type, k""",
    "count_sliding_long": f"""WITH {EVENTS}
SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS window_end_count,
       sum(round(value * 4) / 4) OVER w AS sum_value, max(value) OVER w AS max_value
FROM events_c WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
    "count_sliding_thousand": f"""WITH {EVENTS}
SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS window_end_count,
       CAST(sum(cents) OVER w AS BIGINT) AS cents, max(value) OVER w AS max_value, count(*) OVER w AS n
FROM events_c WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)""",
})

ORACLE["iterator_sequence"] = ORACLE["sequence_map"]
ORACLE["flat_map_python"] = ORACLE["token_case_flatmap"]
ORACLE["output_format_roundtrip"] = ORACLE["text_roundtrip"]
ORACLE["tumbling_python_monoid"] = ORACLE["tumbling_python_reduce"]

# Streaming: the input is bounded, so every window closes and the results are
# those of the batch queries.
ORACLE.update({
    "stream_tumbling_sum": ORACLE["tumbling_sum"],
    "stream_tumbling_max": ORACLE["tumbling_max"],
    "stream_tumbling_fold": ORACLE["tumbling_fold"],
    "stream_sliding_count": f"""WITH {EVENTS}, r AS ({_sliding_rows('events_c', 'event_type', 2 * US_HOUR, US_HOUR)})
SELECT event_type, {_win_cols(US_HOUR, 2 * US_HOUR)}, count(*) AS n FROM r GROUP BY event_type, k""",
    "stream_global_concat": ORACLE["global_concat"],
    "stream_session_by_user": ORACLE["session_by_user"],
    "stream_rolling_sum": f"""WITH {EVENTS}
SELECT event_id, user_id, cents,
       CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS running_cents
FROM events_c""",
    "stream_rolling_reduce": ORACLE["rolling_reduce"],
    "stream_rolling_fold": ORACLE["rolling_fold"],
    "stream_rolling_max": ORACLE["rolling_max"],
    "stream_count_tumbling": ORACLE["count_tumbling"],
    "stream_windowed_word_count": ORACLE["windowed_word_count"],
    "stream_count_sliding": ORACLE["count_sliding"],
    "stream_rolling_maxby": f"""WITH {EVENTS},
b AS (SELECT event_id, user_id,
             max({{'v': value, 'o': -event_id, 'id': event_id, 't': event_type}})
               OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best
      FROM events_c)
SELECT event_id, user_id, best.id AS best_event_id, best.t AS best_event_type, best.v AS best_value FROM b""",
    # the watermark is replayed: a row is late when its window ends no later
    # than the latest time of the batches before, less 6 h
    "stream_epoch_lines_late": f"""WITH {EVENTS},
e AS (SELECT *, event_id % 7 AS batch, epoch_ms(ts) AS tms, epoch_ms(ts) // 3600000 AS k FROM events_c),
m AS (SELECT batch, max(max(tms)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 6 * 3600000 AS mark FROM e GROUP BY batch)
SELECT user_id, make_timestamp(k * {US_HOUR}) AS window_start, make_timestamp((k + 1) * {US_HOUR}) AS window_end,
       CAST(sum(cents) AS BIGINT) AS cents, count(*) AS n
FROM e JOIN m USING (batch) WHERE mark IS NULL OR (k + 1) * 3600000 > mark
GROUP BY user_id, k""",
})
