"""DuckDB SQL that computes the same result as each registered query, written
independently of the Spark code (plain joins, BETWEEN, window functions),
over the driver's pre-registered table views."""

from __future__ import annotations

# Words of a text by Java's split(" "): trailing empty words dropped, an empty
# text is one empty word, a text of spaces only has none.
_WORDS = """
  SELECT {keep} unnest(CASE WHEN text = '' THEN [''] ELSE string_split(rtrim(text, ' '), ' ') END) AS word
  FROM {table} WHERE text = '' OR rtrim(text, ' ') <> ''
"""


def _word_count(table: str) -> str:
    return f"SELECT word, COUNT(*) AS cnt FROM ({_WORDS.format(keep='', table=table)}) w GROUP BY word"


_IP_OCTETS = ("(16 + ({k} * 7) % 108)", "({k} % 256)", "(({k} >> 8) % 256)", "(({k} * 13) % 256)")


def _ip_text(k: str) -> str:
    return "concat_ws('.', " + ", ".join(f"CAST({o.format(k=k)} AS VARCHAR)" for o in _IP_OCTETS) + ")"


def _ip_num(k: str) -> str:
    a, b, c, d = (o.format(k=k) for o in _IP_OCTETS)
    return f"((CAST({a} AS BIGINT) << 24) | (CAST({b} AS BIGINT) << 16) | (CAST({c} AS BIGINT) << 8) | CAST({d} AS BIGINT))"


_RULES = """
  rules AS (
    SELECT (CAST(16 + 4 * n.n_nationkey AS BIGINT) << 24) AS start_num,
           (CAST(19 + 4 * n.n_nationkey AS BIGINT) << 24) - 1 AS end_num,
           r.r_name AS province
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
"""

_LINES = f"""
  lines AS (
    SELECT string_split(concat_ws(' ', CAST(o.o_custkey AS VARCHAR), {_ip_text('o.o_custkey')},
                                  p.p_type, replace(p.p_name, ' ', '_'),
                                  CAST(l.l_extendedprice AS VARCHAR)), ' ') AS f,
           {_ip_num('o.o_custkey')} AS ip_num
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                    JOIN part p ON l.l_partkey = p.p_partkey),
  parsed AS (
    SELECT f[1] AS buyer, f[2] AS ip, f[3] AS category, f[4] AS item,
           CAST(f[5] AS DOUBLE) AS price, ip_num FROM lines)
"""

_ZONED = f"""
  WITH {_LINES}, {_RULES},
  zoned AS (
    SELECT p.category, coalesce(r.province, '') AS province, p.price
    FROM parsed p LEFT JOIN rules r ON p.ip_num BETWEEN r.start_num AND r.end_num)
"""

# The exact sum of doubles between 2^-8 and 2^40 or so, as an integer of 2^-60, rounded once.
_UNIT = "1152921504606846976::DOUBLE"
_MONEY = f"CAST(CAST(SUM(CAST(price * {_UNIT} AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {_UNIT}"

_METRICS = f"""
  {_ZONED}
  SELECT 'total' AS metric, 'TOTAL_INCOME' AS key, {_MONEY} AS income FROM zoned HAVING COUNT(*) > 0
  UNION ALL SELECT 'category', category, {_MONEY} FROM zoned GROUP BY category
  UNION ALL SELECT 'province', province, {_MONEY} FROM zoned GROUP BY province
"""

_RECORDS = """
  records AS (
    SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
           CAST(user_id AS VARCHAR) AS key, props AS value, ts AS "timestamp"
    FROM events)
"""


def oracle_queries() -> dict[str, str]:
    return {
        "word_count": _word_count("documents"),
        "word_count_per_batch": f"""
            SELECT batch_id, word, COUNT(*) AS cnt FROM (
              {_WORDS.format(keep='batch_id,', table='(SELECT text, dense_rank() OVER (ORDER BY turn) - 1 AS batch_id FROM conversations)')}
            ) w GROUP BY batch_id, word""",
        "word_count_running": _word_count("conversations"),
        "word_state_capped": f"""
            SELECT word, LEAST(100, SUM(cnt))::BIGINT AS cnt FROM (
              SELECT word, LEAST(100, cnt) AS cnt FROM ({_word_count('(SELECT p_name AS text FROM part)')}) b
              UNION ALL {_word_count('benchmark')}) x GROUP BY word""",
        "word_count_sorted": f"""
            SELECT word, cnt, row_number() OVER (ORDER BY cnt, word) AS position
            FROM ({_word_count('documents')}) c""",
        "word_count_top10": f"{_word_count('documents')} ORDER BY cnt DESC, word LIMIT 10",
        "word_count_store": _word_count("benchmark"),
        "word_store_lookup": f"""
            SELECT word, SUM(cnt)::BIGINT AS cnt FROM (
              {_word_count('documents')} UNION ALL {_word_count('conversations')} UNION ALL {_word_count('benchmark')}) x
            WHERE starts_with(word, 'st') GROUP BY word""",
        "order_lines_parsed": f"WITH {_LINES} SELECT buyer, ip, category, item, price FROM parsed",
        "order_total_income": f"WITH {_LINES} SELECT {_MONEY} AS total_income FROM parsed",
        "order_income_by_category": f"WITH {_LINES} SELECT category, {_MONEY} AS income FROM parsed GROUP BY category",
        "order_income_by_zone": f"{_ZONED} SELECT province, {_MONEY} AS income FROM zoned GROUP BY province",
        "order_metrics_one_pass": _METRICS,
        "order_running_metrics": _METRICS,
        "order_resume_totals": f"""
            SELECT metric, key, income AS value FROM ({_METRICS}) m
            UNION ALL
            SELECT 'offset', 'orders/' || CAST(l_orderkey % 4 AS VARCHAR),
                   CAST(MAX(l_orderkey * 16 + l_linenumber) + 1 AS DOUBLE)
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
            GROUP BY l_orderkey % 4""",
        "metric_store_scan": f"""
            {_ZONED}
            SELECT key, {_MONEY} AS value FROM (
              SELECT 'TOTAL_INCOME' AS key, price FROM zoned UNION ALL SELECT category, price FROM zoned
              UNION ALL SELECT province, price FROM zoned) f GROUP BY key""",
        "order_income_wide": f"""
            SELECT CAST(p_size AS VARCHAR) AS category,
              CASE WHEN p_size = 50 OR p_size = 48 AND COUNT(DISTINCT same) = 2 THEN 'NaN'::DOUBLE
                WHEN p_size = 49 OR p_size = 48 AND bool_or(same) THEN 'Infinity'::DOUBLE
                WHEN p_size = 48 THEN '-Infinity'::DOUBLE
                ELSE {_MONEY} * pow(2::DOUBLE, (p_size - 25) * 40) END AS income
            FROM (SELECT p_size, l_extendedprice AS price, l_partkey % 2 = l_orderkey % 2 AS same FROM lineitem JOIN part ON l_partkey = p_partkey
                  WHERE l_orderkey IN (SELECT o_orderkey FROM orders)) x
            GROUP BY p_size""",
        "ip_to_number": f"""
            SELECT c_custkey, {_ip_text('c_custkey')} AS ip, {_ip_num('c_custkey')} AS ip_num FROM customer""",
        "ip_zone_lookup": f"""
            WITH {_RULES}
            SELECT c.c_custkey, {_ip_text('c.c_custkey')} AS ip, coalesce(r.province, '') AS province
            FROM customer c LEFT JOIN rules r ON {_ip_num('c.c_custkey')} BETWEEN r.start_num AND r.end_num""",
        "ip_wide_zone_lookup": f"""
            WITH {_RULES}
            SELECT c.c_custkey, {_ip_num('c.c_custkey')} << 30 AS number, coalesce(r.province, '') AS province
            FROM customer c LEFT JOIN rules r ON {_ip_num('c.c_custkey')} BETWEEN r.start_num AND r.end_num""",
        "ip_point_lookup": f"""
            WITH {_RULES}
            SELECT s.s_suppkey, {_ip_text('s.s_suppkey')} AS ip, r.province
            FROM supplier s JOIN rules r ON {_ip_num('s.s_suppkey')} BETWEEN r.start_num AND r.end_num""",
        "offset_ledger_latest": f"""
            WITH {_RECORDS}
            SELECT 'eddy-events' AS groupid, topic, "partition" AS partitioner, MAX("offset") + 1 AS "offset"
            FROM records GROUP BY topic, "partition" """,
        "offset_resume": f"""
            WITH {_RECORDS},
            span AS (SELECT MIN("timestamp") AS lo, MAX("timestamp") AS hi FROM records),
            cut AS (SELECT lo + to_microseconds((epoch_us(hi) - epoch_us(lo)) // 2) AS c FROM span),
            ledger AS (
              SELECT topic, "partition" AS partitioner, MAX("offset") + 1 AS stored
              FROM records WHERE "timestamp" < (SELECT c FROM cut) AND "partition" <> 0 GROUP BY topic, "partition")
            SELECT r.topic, r."partition", r."offset", r.key, r.value
            FROM records r LEFT JOIN ledger l ON r.topic = l.topic AND r."partition" = l.partitioner
            WHERE r."offset" >= coalesce(l.stored, 0)""",
        "kafka_record_tail": f"""
            WITH {_RECORDS}
            SELECT topic, "partition", printf('offset = %d, key = %s, value = %s', "offset", key, value) AS line
            FROM records""",
        "message_range": "SELECT 'this is message' || CAST(event_id + 1000 AS VARCHAR) AS value FROM events",
    }
