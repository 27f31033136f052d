"""DuckDB oracle SQL for every registered query.

Each statement re-derives the proxy tables (FIXTURES.md §2) from the
driver's raw tables (`events`, `customer`, `nation`) with plain SQL and
then states the query in an independent form: self-joins where the
Spark side uses range conditions or bucketed aggregates, lag SQL where it
uses bucketed windows, correlated lookups where it uses a point-in-time
join.
"""

from __future__ import annotations

# Fixed values shared with cardsentry/functions/constants.py and
# tools/proxy.py (they must agree for the compare).
REPORT_DT = "2024-02-01 00:00:00"
DAY_REPORT_DATE = "2024-01-16"
ADHOC_FROM = "2024-01-10 00:00:00"
ADHOC_TO = "2024-01-20 00:00:00"

PROXY = """
WITH
transactions AS (
    SELECT CAST(event_id AS VARCHAR)                     AS transaction_id,
           CAST(ts AS TIMESTAMP)                         AS transaction_date,
           CAST(value AS DECIMAL(18,2))                  AS amount,
           'C' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 3 AS VARCHAR) AS card_num,
           event_type                                    AS oper_type,
           CASE WHEN event_type = 'purchase' THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
           CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS terminal
    FROM events
),
cards AS (
    SELECT 'C' || CAST(c_custkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS card_num,
           'A' || CAST(c_custkey AS VARCHAR) || '-' || CASE WHEN i = 2 THEN '1' ELSE '0' END AS account
    FROM customer, (SELECT unnest([0, 1, 2]) AS i) ii
),
accounts AS (
    SELECT 'A' || CAST(c_custkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS account,
           CAST(DATE '2024-01-01' + CAST((c_custkey * 7 + i * 30) % 90 AS INTEGER) AS DATE) AS valid_to,
           CAST(c_custkey AS VARCHAR) AS client
    FROM customer, (SELECT unnest([0, 1]) AS i) ii
),
clients AS (
    SELECT CAST(c_custkey AS VARCHAR) AS client_id,
           c_name AS last_name,
           'Proxy' AS first_name,
           'Testovich' AS patronymic,
           'P' || CAST(c_custkey AS VARCHAR) AS passport_num,
           CASE WHEN c_custkey % 5 = 0 THEN NULL
                ELSE CAST(DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER) AS DATE) END AS passport_valid_to,
           '+0 000 000-00-00' AS phone
    FROM customer
),
blacklist AS (
    SELECT CAST(DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS DATE) AS date,
           'P' || CAST(c_custkey AS VARCHAR) AS passport
    FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT CAST(DATE '2024-01-01' + CAST(c_custkey % 30 + 5 AS INTEGER) AS DATE) AS date,
           'P' || CAST(c_custkey AS VARCHAR) AS passport
    FROM customer WHERE c_acctbal < 0 AND c_custkey % 2 = 0
),
terminals AS (
    SELECT CAST(n.n_nationkey + 25 * j AS VARCHAR) AS terminal_id,
           n.n_name AS terminal_city,
           TIMESTAMP '2024-01-01 00:00:00' AS effective_from,
           CASE WHEN (n.n_nationkey + 25 * j) % 10 = 0 THEN TIMESTAMP '2024-01-16 00:00:00'
                ELSE TIMESTAMP '9999-12-31 00:00:00' END AS effective_to
    FROM nation n, (SELECT unnest([0, 1, 2, 3]) AS j) jj
    UNION ALL
    SELECT CAST(n.n_nationkey + 25 * j AS VARCHAR) AS terminal_id,
           m.n_name AS terminal_city,
           TIMESTAMP '2024-01-16 00:00:00' AS effective_from,
           TIMESTAMP '9999-12-31 00:00:00' AS effective_to
    FROM nation n, (SELECT unnest([0, 1, 2, 3]) AS j) jj, nation m
    WHERE (n.n_nationkey + 25 * j) % 10 = 0 AND m.n_nationkey = (n.n_nationkey + 25 * j + 1) % 25
),
enriched AS (
    SELECT t.transaction_id, t.transaction_date, t.amount, t.card_num, t.oper_type, t.oper_result,
           t.terminal, a.account, a.valid_to, c.client_id, c.last_name, c.first_name, c.patronymic,
           c.passport_num, c.passport_valid_to, c.phone
    FROM transactions t
    JOIN cards k ON t.card_num = k.card_num
    JOIN accounts a ON k.account = a.account
    JOIN clients c ON a.client = c.client_id
)
"""

_ROW = """transaction_date AS event_dt, passport_num AS passport, last_name, first_name, patronymic, phone"""


def _r1a(report_dt: str) -> str:
    return f"""
    SELECT DISTINCT e.transaction_date AS event_dt, e.passport_num AS passport, e.last_name, e.first_name,
           e.patronymic, e.phone, 'locked passport' AS event_type, TIMESTAMP '{report_dt}' AS report_dt
    FROM enriched e JOIN blacklist b ON e.passport_num = b.passport
    WHERE e.transaction_date > CAST(b.date AS TIMESTAMP)"""


def _r1b(report_dt: str) -> str:
    return f"""
    SELECT DISTINCT {_ROW}, 'overdue passport' AS event_type, TIMESTAMP '{report_dt}' AS report_dt
    FROM enriched WHERE transaction_date > CAST(passport_valid_to AS TIMESTAMP)"""


def _r2(report_dt: str) -> str:
    return f"""
    SELECT DISTINCT {_ROW}, 'invalid_contract' AS event_type, TIMESTAMP '{report_dt}' AS report_dt
    FROM enriched WHERE transaction_date > CAST(valid_to AS TIMESTAMP)"""


def _with_city(point_in_time: bool) -> str:
    cond = ("AND e.transaction_date >= t.effective_from AND e.transaction_date < t.effective_to"
            if point_in_time else "")
    return f"""
    with_city AS (
        SELECT e.*, t.terminal_city FROM enriched e
        JOIN terminals t ON e.terminal = t.terminal_id {cond}
    )"""


def _r3(report_dt: str, point_in_time: bool = True, within_us: int = 3_600_000_000) -> str:
    # Independent form: the symmetric self-join of the reference.
    return f"""
    , {_with_city(point_in_time).strip()}
    SELECT DISTINCT a.transaction_date AS event_dt, a.passport_num AS passport, a.last_name, a.first_name,
           a.patronymic, a.phone, 'different cities within one hour' AS event_type,
           TIMESTAMP '{report_dt}' AS report_dt
    FROM with_city a JOIN with_city b
      ON a.account = b.account AND a.terminal_city <> b.terminal_city
    WHERE abs(epoch_us(a.transaction_date) - epoch_us(b.transaction_date)) < {within_us}"""


def _r4_lags(within_us: int) -> str:
    return f"""
    , ordered AS (
        SELECT *, epoch_us(transaction_date) AS us,
               lag(oper_result, 1) OVER w AS r1, lag(oper_result, 2) OVER w AS r2, lag(oper_result, 3) OVER w AS r3,
               lag(amount, 1) OVER w AS a1, lag(amount, 2) OVER w AS a2, lag(amount, 3) OVER w AS a3,
               lag(epoch_us(transaction_date), 3) OVER w AS u3
        FROM enriched
        WINDOW w AS (PARTITION BY account ORDER BY transaction_date, transaction_id)
    )"""


def _r4(report_dt: str, within_us: int) -> str:
    return _r4_lags(within_us) + f"""
    SELECT {_ROW}, 'attempt_to_select_the_amount' AS event_type, TIMESTAMP '{report_dt}' AS report_dt
    FROM ordered
    WHERE oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT'
      AND a3 > a2 AND a2 > a1 AND a1 > amount AND us - u3 < {within_us}"""


def _r4b(report_dt: str, within_us: int) -> str:
    return f"""
    , ordered AS (
        SELECT *, epoch_us(transaction_date) AS us,
               lag(amount) OVER w AS prev_amount, lead(amount) OVER w AS next_amount,
               lag(epoch_us(transaction_date)) OVER w AS prev_us, lead(epoch_us(transaction_date)) OVER w AS next_us,
               lead(oper_result) OVER w AS next_result
        FROM enriched
        WINDOW w AS (PARTITION BY account ORDER BY transaction_date, transaction_id)
    )
    SELECT {_ROW}, 'attempt_to_select_the_amount' AS event_type, TIMESTAMP '{report_dt}' AS report_dt
    FROM ordered
    WHERE prev_amount > amount AND amount > next_amount AND next_result = 'SUCCESS'
      AND abs(next_us - prev_us) < {within_us}"""


H72 = 72 * 3_600_000_000
M20 = 20 * 60_000_000
H1 = 3_600_000_000


def _report(report_dt: str, probing_us: int = M20) -> str:
    # R3/R4 need their own CTEs; wrap each rule as a subquery over the shared proxy.
    parts = [
        _r1a(report_dt), _r1b(report_dt), _r2(report_dt),
    ]
    r3 = f"""
    SELECT DISTINCT a.transaction_date AS event_dt, a.passport_num AS passport, a.last_name, a.first_name,
           a.patronymic, a.phone, 'different cities within one hour' AS event_type,
           TIMESTAMP '{report_dt}' AS report_dt
    FROM with_city a JOIN with_city b
      ON a.account = b.account AND a.terminal_city <> b.terminal_city
    WHERE abs(epoch_us(a.transaction_date) - epoch_us(b.transaction_date)) < {H1}"""
    r4 = f"""
    SELECT {_ROW}, 'attempt_to_select_the_amount' AS event_type, TIMESTAMP '{report_dt}' AS report_dt
    FROM ordered
    WHERE oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT'
      AND a3 > a2 AND a2 > a1 AND a1 > amount AND us - u3 < {probing_us}"""
    return (PROXY + ", " + _with_city(True).strip() + _r4_lags(probing_us) + "\n"
            + "\nUNION ALL\n".join(parts + [r3, r4]))


def _daily_mart(probing_us: int = M20) -> str:
    # Every day D of the data gets its own report (report_date = D, report_dt = D + 1 day).
    # A daily run sees operations up to the end of its day and, for R3/R4, one rule
    # window of the previous day (lookback = within).
    rd = "CAST(CAST(e.transaction_date AS DATE) + 1 AS TIMESTAMP)"
    cols = ("e.transaction_date AS event_dt, e.passport_num AS passport, e.last_name, e.first_name, "
            "e.patronymic, e.phone")
    return PROXY + ", " + _with_city(True).strip() + _r4_lags(probing_us) + f"""
    SELECT DISTINCT {cols}, 'locked passport' AS event_type, {rd} AS report_dt,
           CAST(e.transaction_date AS DATE) AS report_date
    FROM enriched e JOIN blacklist b ON e.passport_num = b.passport
    WHERE e.transaction_date > CAST(b.date AS TIMESTAMP)
    UNION ALL
    SELECT DISTINCT {cols}, 'overdue passport', {rd}, CAST(e.transaction_date AS DATE)
    FROM enriched e WHERE e.transaction_date > CAST(e.passport_valid_to AS TIMESTAMP)
    UNION ALL
    SELECT DISTINCT {cols}, 'invalid_contract', {rd}, CAST(e.transaction_date AS DATE)
    FROM enriched e WHERE e.transaction_date > CAST(e.valid_to AS TIMESTAMP)
    UNION ALL
    SELECT DISTINCT {cols}, 'different cities within one hour', {rd}, CAST(e.transaction_date AS DATE)
    FROM with_city e JOIN with_city b
      ON e.account = b.account AND e.terminal_city <> b.terminal_city
    WHERE abs(epoch_us(e.transaction_date) - epoch_us(b.transaction_date)) < {H1}
      AND b.transaction_date < CAST(CAST(e.transaction_date AS DATE) + 1 AS TIMESTAMP)
    UNION ALL
    SELECT {cols}, 'attempt_to_select_the_amount', {rd}, CAST(e.transaction_date AS DATE)
    FROM ordered e
    WHERE oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT'
      AND a3 > a2 AND a2 > a1 AND a1 > amount AND us - u3 < {probing_us}"""


def _day_report() -> str:
    # One daily run for DAY_REPORT_DATE with lookback = within (half-open day [D, D+1)).
    d0 = f"TIMESTAMP '{DAY_REPORT_DATE} 00:00:00'"
    d1 = f"(TIMESTAMP '{DAY_REPORT_DATE} 00:00:00' + INTERVAL 1 DAY)"
    rd = f"TIMESTAMP '{REPORT_DT}'"
    cols = ("e.transaction_date AS event_dt, e.passport_num AS passport, e.last_name, e.first_name, "
            "e.patronymic, e.phone")
    return PROXY + ", " + _with_city(True).strip() + f"""
    , scoped AS (
        SELECT * FROM enriched
        WHERE transaction_date >= {d0} - INTERVAL 20 MINUTE AND transaction_date < {d1}
    ),
    ordered AS (
        SELECT *, epoch_us(transaction_date) AS us,
               lag(oper_result, 1) OVER w AS r1, lag(oper_result, 2) OVER w AS r2, lag(oper_result, 3) OVER w AS r3,
               lag(amount, 1) OVER w AS a1, lag(amount, 2) OVER w AS a2, lag(amount, 3) OVER w AS a3,
               lag(epoch_us(transaction_date), 3) OVER w AS u3
        FROM scoped
        WINDOW w AS (PARTITION BY account ORDER BY transaction_date, transaction_id)
    )
    SELECT DISTINCT {cols}, 'locked passport' AS event_type, {rd} AS report_dt
    FROM enriched e JOIN blacklist b ON e.passport_num = b.passport
    WHERE e.transaction_date > CAST(b.date AS TIMESTAMP) AND e.transaction_date >= {d0} AND e.transaction_date < {d1}
    UNION ALL
    SELECT DISTINCT {cols}, 'overdue passport', {rd}
    FROM enriched e WHERE e.transaction_date > CAST(e.passport_valid_to AS TIMESTAMP)
      AND e.transaction_date >= {d0} AND e.transaction_date < {d1}
    UNION ALL
    SELECT DISTINCT {cols}, 'invalid_contract', {rd}
    FROM enriched e WHERE e.transaction_date > CAST(e.valid_to AS TIMESTAMP)
      AND e.transaction_date >= {d0} AND e.transaction_date < {d1}
    UNION ALL
    SELECT DISTINCT {cols}, 'different cities within one hour', {rd}
    FROM with_city e JOIN with_city b
      ON e.account = b.account AND e.terminal_city <> b.terminal_city
    WHERE abs(epoch_us(e.transaction_date) - epoch_us(b.transaction_date)) < {H1}
      AND e.transaction_date >= {d0} AND e.transaction_date < {d1}
      AND b.transaction_date >= {d0} - INTERVAL 1 HOUR AND b.transaction_date < {d1}
    UNION ALL
    SELECT {cols}, 'attempt_to_select_the_amount', {rd}
    FROM ordered e
    WHERE oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT'
      AND a3 > a2 AND a2 > a1 AND a1 > amount AND us - u3 < {M20}
      AND e.transaction_date >= {d0}"""


_SNAPSHOTS = """
    , days AS (
        SELECT CAST(unnest(generate_series(CAST(min(CAST(ts AS DATE)) AS TIMESTAMP),
                                           CAST(max(CAST(ts AS DATE)) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
               AS load_date
        FROM events
    ),
    snapshots AS (
        SELECT t.terminal_id, t.terminal_city, d.load_date
        FROM terminals t JOIN days d
          ON d.load_date >= CAST(t.effective_from AS DATE) AND CAST(d.load_date AS TIMESTAMP) < t.effective_to
    )"""

_SHEETS = """
            SELECT 'blacklist' AS table_name, passport AS a, CAST(date AS VARCHAR) AS b, date AS load_date FROM blacklist
            WHERE CAST(substr(passport, 2) AS BIGINT) % 10 <> 1
            UNION ALL SELECT 'quarantine', 'date', 'blacklist', date FROM blacklist WHERE CAST(substr(passport, 2) AS BIGINT) % 10 = 1
            UNION ALL SELECT 'terminals', terminal_id, terminal_city, load_date FROM snapshots
            UNION ALL SELECT 'quarantine', 'unknown_sheet', 'notes', load_date FROM snapshots WHERE CAST(terminal_id AS INTEGER) % 25 = 0"""

# Four deliveries: by the operation's time and up to two days more.
_DELIVERED = """
    , delivered AS (
        SELECT transaction_id, transaction_date, CAST(transaction_id AS BIGINT) AS key,
               least(3, (CAST(transaction_date + to_hours(CAST(transaction_id AS BIGINT) * 7 % 48) AS DATE)
                         - (SELECT min(CAST(ts AS DATE)) FROM events)) // 8) AS delivery
        FROM transactions
    )"""

# Gaps and islands: a run of consecutive days with the same city is one version.
_HISTORY = _SNAPSHOTS + """
    , islands AS (
        SELECT terminal_id, terminal_city, load_date,
               load_date - CAST(row_number() OVER (PARTITION BY terminal_id, terminal_city ORDER BY load_date)
                                AS INTEGER) AS grp
        FROM snapshots
    ),
    runs AS (
        SELECT terminal_id, terminal_city, min(load_date) AS first_day, max(load_date) AS last_day
        FROM islands GROUP BY terminal_id, terminal_city, grp
    ),
    ordered AS (
        SELECT r.*, lead(first_day) OVER (PARTITION BY terminal_id ORDER BY first_day) AS next_first,
               (SELECT max(load_date) FROM snapshots) AS max_day
        FROM runs r
    )
    SELECT terminal_id, terminal_city, CAST(first_day AS TIMESTAMP) AS effective_from,
           CASE WHEN next_first = last_day + 1 THEN CAST(next_first AS TIMESTAMP)
                WHEN last_day < max_day THEN CAST(last_day + 1 AS TIMESTAMP)
                ELSE TIMESTAMP '9999-12-31 00:00:00' END AS effective_to,
           0 AS deleted_flg
    FROM ordered
    UNION ALL
    SELECT terminal_id, terminal_city, CAST(last_day + 1 AS TIMESTAMP) AS effective_from,
           COALESCE(CAST(next_first AS TIMESTAMP), TIMESTAMP '9999-12-31 00:00:00') AS effective_to,
           1 AS deleted_flg
    FROM ordered
    WHERE last_day < max_day AND (next_first IS NULL OR next_first <> last_day + 1)"""

_TX_COLS = "transaction_id, transaction_date, amount, card_num, oper_type, oper_result, terminal"

ADHOC_SQL = """
SELECT t.oper_type, t.oper_result, count(*) AS n_ops, CAST(sum(t.amount) AS DECIMAL(38,2)) AS total_amount,
       count(DISTINCT k.account) AS n_accounts
FROM transactions t JOIN cards k ON t.card_num = k.card_num
WHERE t.amount >= {min_amount}
GROUP BY t.oper_type, t.oper_result"""


# Skewed variant: one card (hence one account) receives a third of all operations.
HOT_CARD = "C0-0"
PROXY_HOT = PROXY.replace(
    "'C' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 3 AS VARCHAR) AS card_num",
    f"CASE WHEN event_id % 3 = 0 THEN '{HOT_CARD}' "
    "ELSE 'C' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 3 AS VARCHAR) END AS card_num")
assert PROXY_HOT != PROXY


def oracle_sql() -> dict[str, str]:
    rd = REPORT_DT
    return {
        "ingest_transactions": PROXY + f"""
            SELECT {_TX_COLS}, CAST(transaction_date AS DATE) AS load_date FROM transactions""",
        "ingest_idempotent": PROXY + f"""
            SELECT {_TX_COLS}, CAST(transaction_date AS DATE) AS load_date FROM transactions""",
        "quarantine_bad_lines": """
            SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(ts AS DATE) AS business_date,
                   6 AS n_fields, 'field_count' AS reason
            FROM events WHERE event_type = 'error'""",
        "ingest_excel_blacklist": PROXY + """
            SELECT date, passport, date AS load_date FROM blacklist""",
        "ingest_excel_terminals": PROXY + _SNAPSHOTS + """
            SELECT terminal_id, terminal_city, load_date FROM snapshots""",
        "ingest_excel_stream": PROXY + _SNAPSHOTS + _SHEETS + """
            UNION ALL SELECT 'quarantine', 'broken_workbook', NULL, min(CAST(ts AS DATE)) FROM events""",
        "ingest_excel_sheets": PROXY + _SNAPSHOTS + _SHEETS,
        "terminal_history_incremental": PROXY + _HISTORY.replace("        FROM snapshots\n    ),", """        FROM (SELECT * FROM snapshots WHERE NOT (CAST(terminal_id AS INTEGER) % 7 = 3 AND load_date
              - (SELECT min(CAST(ts AS DATE)) FROM events) IN (26, 27)))
    ),"""),
        "seed_load": PROXY + """
            SELECT client_id, last_name, first_name, patronymic,
                   CAST(DATE '1950-01-01' + CAST(CAST(client_id AS BIGINT) % 9000 AS INTEGER) AS DATE) AS date_of_birth,
                   passport_num, passport_valid_to, phone, DATE '1900-01-01' AS create_dt,
                   CASE WHEN CAST(client_id AS BIGINT) % 3 = 0 THEN DATE '2024-01-02' END AS update_dt,
                   TIMESTAMP '1900-01-01 00:00:00' AS effective_from, TIMESTAMP '9999-12-31 00:00:00' AS effective_to, 0 AS deleted_flg
            FROM clients""",
        "seed_tables": PROXY + """
            SELECT s.*, DATE '1900-01-01' AS create_dt, CAST(NULL AS DATE) AS update_dt, TIMESTAMP '1900-01-01 00:00:00' AS effective_from,
                   TIMESTAMP '9999-12-31 00:00:00' AS effective_to, 0 AS deleted_flg
            FROM (SELECT 'cards' AS table_name, card_num AS key, account AS ref, CAST(NULL AS DATE) AS valid_to FROM cards
                  UNION ALL SELECT 'accounts', account, client, valid_to FROM accounts) s""",
        "stamp_snapshot": PROXY + f"""
            SELECT {_TX_COLS}, date_trunc('day', transaction_date) AS effective_from,
                   date_trunc('day', transaction_date) + INTERVAL 1 DAY AS effective_to, 0 AS deleted_flg
            FROM transactions""",
        "terminal_history": PROXY + _HISTORY,
        "adhoc_sql": PROXY + ADHOC_SQL.format(min_amount="0"),
        "enriched_transactions": PROXY + """
            SELECT transaction_id, transaction_date, amount, card_num, oper_type, oper_result, terminal,
                   account, valid_to, client_id, last_name, first_name, patronymic, passport_num,
                   passport_valid_to, phone
            FROM enriched""",
        "locked_passport": PROXY + _r1a(rd),
        "overdue_passport": PROXY + _r1b(rd),
        "invalid_contract": PROXY + _r2(rd),
        "point_in_time_city": PROXY + """
            SELECT t.transaction_id, t.transaction_date, t.terminal,
                   (SELECT v.terminal_city FROM terminals v
                     WHERE v.terminal_id = t.terminal
                       AND v.effective_from <= t.transaction_date AND t.transaction_date < v.effective_to)
                   AS terminal_city
            FROM transactions t""",
        "point_in_time_city_many_versions": PROXY + """
            , first AS (SELECT CAST(min(CAST(ts AS DATE)) AS TIMESTAMP) AS at FROM events),
            hot AS (
                SELECT transaction_id, transaction_date, CASE WHEN CAST(transaction_id AS BIGINT) % 10 = 0 THEN 'hot' ELSE terminal END AS terminal
                FROM transactions
            )
            SELECT h.transaction_id, h.transaction_date, h.terminal,
                   (SELECT n_name FROM nation, first
                     WHERE n_nationkey = (epoch_us(h.transaction_date) - epoch_us(first.at)) // 300000000 % 25) AS terminal_city
            FROM hot h WHERE h.terminal = 'hot'
            UNION ALL
            SELECT h.transaction_id, h.transaction_date, h.terminal, v.terminal_city
            FROM hot h JOIN terminals v ON v.terminal_id = h.terminal AND v.effective_from <= h.transaction_date AND h.transaction_date < v.effective_to""",
        "different_cities": PROXY + _r3(rd, True),
        "different_cities_all_versions": PROXY + _r3(rd, False),
        "amount_probing": PROXY + _r4(rd, H72),
        "amount_probing_three_step": PROXY + _r4b(rd, H72),
        "fraud_report": _report(rd),
        "fraud_report_day": _day_report(),
        "daily_mart": _daily_mart(),
        "daily_pipeline": _daily_mart(),
        "daily_pipeline_late": _daily_mart(),
        "fraud_report_probing": _report(rd, H72),
        "daily_mart_probing": _daily_mart(H72),
        "table_list": PROXY + "UNION ALL".join(f"""
            SELECT '{n}' AS name, count(*) AS n_rows FROM {n}
            """ for n in ("accounts", "blacklist", "cards", "clients", "terminals", "transactions")),
        "positional_sql": PROXY + """
            SELECT oper_type, oper_result, count(*) AS n_ops FROM transactions
            WHERE amount >= 10 AND oper_result = 'REJECT' GROUP BY oper_type, oper_result""",
        "table_by_name": PROXY + """
            SELECT card_num, account FROM cards""",
        "stream_amount_probing": PROXY + _r4(rd, H72),
        "stream_different_cities": PROXY + _r3(rd, True),
        "stream_profile_rules": PROXY + _DELIVERED + f"""
            SELECT DISTINCT e.transaction_date AS event_dt, e.passport_num AS passport, e.last_name, e.first_name,
                   e.patronymic, e.phone, 'locked passport' AS event_type, TIMESTAMP '{rd}' AS report_dt
            FROM enriched e JOIN blacklist b ON e.passport_num = b.passport JOIN delivered v ON v.transaction_id = e.transaction_id
            WHERE e.transaction_date > CAST(b.date AS TIMESTAMP) AND (v.delivery >= 2 OR CAST(substr(b.passport, 2) AS BIGINT) % 2 = 0)
            UNION ALL """ + _r1b(rd) + " UNION ALL " + _r2(rd),
        "stream_late_operations": PROXY + _DELIVERED + """
            , lines AS (
                SELECT transaction_id, transaction_date, turn FROM (
                    SELECT *, least(3, delivery + CASE WHEN key % 20 = 7 THEN 2 ELSE 0 END) AS turn FROM delivered)
            ),
            copies AS (
                SELECT * FROM lines
                UNION ALL SELECT * FROM lines WHERE CAST(transaction_id AS BIGINT) % 10 = 3
                UNION ALL SELECT transaction_id, transaction_date, turn + 1 FROM lines WHERE CAST(transaction_id AS BIGINT) % 10 = 5 AND turn < 3
            ),
            newest AS (SELECT turn, max(transaction_date) AS newest FROM copies GROUP BY turn),
            judged AS (
                SELECT c.*, coalesce(c.transaction_date <= (SELECT max(n.newest) FROM newest n WHERE n.turn < c.turn) - INTERVAL 3 DAY, false) AS late
                FROM copies c
            )
            SELECT transaction_id, 'late' AS status, count(*) AS n FROM judged WHERE late GROUP BY transaction_id
            UNION ALL SELECT transaction_id, 'kept', 1 FROM judged WHERE NOT late GROUP BY transaction_id
            UNION ALL SELECT transaction_id, 'repeated', count(*) - 1 FROM judged WHERE NOT late GROUP BY transaction_id HAVING count(*) > 1""",
        "fraud_report_hot_account": _report(rd).replace(PROXY, PROXY_HOT),
        "enriched_transactions_bucketed": PROXY_HOT + """
            SELECT transaction_id, transaction_date, amount, card_num, oper_type, oper_result, terminal,
                   account, valid_to, client_id, last_name, first_name, patronymic, passport_num,
                   passport_valid_to, phone
            FROM enriched""",
        "operation_lags": PROXY_HOT + f"""
            SELECT transaction_id, account, transaction_date, amount, oper_result,
                   {", ".join(f"lag({c}, {k}) OVER w AS {c}_{k}" for c in ("transaction_date", "amount", "oper_result") for k in (1, 2, 3))}
            FROM enriched WINDOW w AS (PARTITION BY account ORDER BY transaction_date, transaction_id)""",
    }
