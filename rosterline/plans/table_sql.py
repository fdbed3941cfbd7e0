"""The same queries as SQL text over the provided tables, written independently."""

from __future__ import annotations

from decimal import Decimal

from ..schemas import MAX_STRIKES, STRIKE_FACTOR, rung_names

# Named sub-queries; each may use the ones it lists first.
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "period": (
        (),
        """SELECT CAST(o_custkey AS VARCHAR) AS emp_id, o_orderpriority AS designation,
                  CAST(o_orderdate AS DATE) AS start_date, o_totalprice AS salary,
                  o_orderkey AS order_id, o_orderstatus AS delivery
           FROM orders""",
    ),
    "best": (
        ("period",),
        """SELECT emp_id, designation, start_date, salary, order_id, delivery FROM (
             SELECT *, row_number() OVER (PARTITION BY emp_id, start_date
                                          ORDER BY salary DESC, order_id DESC) AS rn
             FROM period) WHERE rn = 1""",
    ),
    "chained": (
        ("best",),
        """SELECT emp_id, designation, start_date, salary, order_id, end_date,
                  CASE WHEN end_date IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status
           FROM (SELECT *, lead(start_date) OVER (PARTITION BY emp_id ORDER BY start_date)
                        AS end_date FROM best)""",
    ),
    "flags": (
        (),
        """SELECT CAST(user_id AS VARCHAR) AS employee_id, ts FROM events
           WHERE event_type = 'error' AND value > 40""",
    ),
    "counts": (
        ("flags",),
        """SELECT employee_id, count(*) AS strike_count FROM flags
           WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY employee_id""",
    ),
    "struck": (("counts",), "SELECT employee_id FROM counts WHERE strike_count >= 10"),
    "early_counts": (
        ("flags",),
        """SELECT employee_id, count(*) AS strike_count FROM flags
           WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
           GROUP BY employee_id""",
    ),
    "balance": (
        (),
        "SELECT CAST(c_custkey AS VARCHAR) AS employee_id, c_acctbal AS salary FROM customer",
    ),
    "overlay": (
        ("chained", "struck"),
        """SELECT emp_id, designation, start_date, salary, order_id,
                  CASE WHEN status = 'ACTIVE' AND s.employee_id IS NOT NULL
                       THEN DATE '2002-01-01' ELSE end_date END AS end_date,
                  CASE WHEN s.employee_id IS NOT NULL THEN 'INACTIVE' ELSE status END AS status
           FROM chained LEFT JOIN struck s ON s.employee_id = emp_id""",
    ),
    "entry": (
        (),
        """SELECT CAST(user_id AS VARCHAR) AS emp_id, CAST(ts AS DATE) AS date,
                  CASE event_type WHEN 'error' THEN 'CANCELLED' WHEN 'signup' THEN 'PENDING'
                                  ELSE 'ACTIVE' END AS status,
                  ts AS ingest_timestamp, event_id
           FROM events
           WHERE dayofweek(ts) NOT IN (0, 6)
             AND CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events
                                          WHERE day(ts) IN (1, 15, 26))""",
    ),
    "moved": (
        (),
        """SELECT CAST(user_id AS VARCHAR) AS emp_id, CAST(ts AS DATE) AS date,
                  CASE event_type WHEN 'error' THEN 'CANCELLED' WHEN 'signup' THEN 'PENDING'
                                  ELSE 'ACTIVE' END AS status,
                  ts AS ingest_timestamp
           FROM events WHERE user_id IN (SELECT o_custkey FROM orders)""",
    ),
    "first_votes": (
        ("moved",),
        """SELECT emp_id, date, CASE WHEN c >= a THEN 'CANCELLED' ELSE 'ACTIVE' END AS status FROM (
             SELECT emp_id, date, count(*) FILTER (status = 'CANCELLED') AS c,
                    count(*) FILTER (status = 'ACTIVE') AS a
             FROM moved
             WHERE ingest_timestamp < TIMESTAMP '2024-01-16 00:00:00'
               AND dayofweek(date) NOT IN (0, 6)
               AND date NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE day(ts) IN (1, 15, 26))
             GROUP BY emp_id, date)
           WHERE c > 0 OR a > 0""",
    ),
    "intake": (
        ("entry", "overlay"),
        """SELECT * FROM entry
           WHERE emp_id IN (SELECT emp_id FROM overlay WHERE status = 'ACTIVE')""",
    ),
    "quota": (
        (),
        """SELECT CAST(c_custkey AS VARCHAR) AS emp_id, c_nationkey AS leave_quota FROM customer""",
    ),
    "usage": (
        ("reconciled", "quota"),
        """SELECT emp_id, leaves_taken, leave_quota,
                  CASE WHEN leave_quota <> 0
                       THEN round(CAST(leaves_taken AS DOUBLE) / leave_quota * 100, 2)
                  END AS leave_percent
           FROM (SELECT emp_id, count(*) AS leaves_taken FROM reconciled
                 WHERE status = 'ACTIVE' GROUP BY emp_id) LEFT JOIN quota USING (emp_id)""",
    ),
    "over": (("usage",), "SELECT * FROM usage WHERE leave_percent > 80"),
    "alerted": (
        ("reconciled", "quota"),
        """SELECT emp_id FROM (
             SELECT emp_id, count(*) AS n FROM reconciled
             WHERE status = 'ACTIVE' AND ingest_timestamp < TIMESTAMP '2024-01-16 00:00:00'
             GROUP BY emp_id) JOIN quota USING (emp_id)
           WHERE leave_quota <> 0 AND round(CAST(n AS DOUBLE) / leave_quota * 100, 2) > 80""",
    ),
    "alert_text": (
        ("over",),
        """SELECT '2024-01-31' AS report_date, emp_id,
                  printf('Employee ID: %s' || chr(10) || 'Leave Taken: %d' || chr(10)
                         || 'Leave Quota: %d' || chr(10) || 'Usage: %.2f%%' || chr(10)
                         || 'Report Date: %s',
                         emp_id, leaves_taken, leave_quota, leave_percent, '2024-01-31') AS value
           FROM over""",
    ),
    "order_day": (
        (),
        """SELECT CAST(unnest(generate_series(
                    (SELECT CAST(min(o_orderdate) AS DATE) FROM orders),
                    (SELECT CAST(max(o_orderdate) AS DATE) FROM orders),
                    INTERVAL 1 DAY)) AS DATE) AS date""",
    ),
    "order_holiday": (
        (),
        """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders
           WHERE day(o_orderdate) = 1 AND month(o_orderdate) IN (1, 4, 7, 10)""",
    ),
    "upcoming_day": (
        (),
        """SELECT CAST(d AS DATE) AS date FROM unnest(generate_series(
             DATE '2024-01-10', DATE '2024-01-31', INTERVAL 1 DAY)) AS t(d)
           WHERE dayofweek(d) NOT IN (0, 6)
             AND CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events
                                         WHERE day(ts) IN (1, 15, 26))""",
    ),
    "vocab": (
        (),
        r"""SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word
            FROM documents""",
    ),
    "token": (
        (),
        r"""SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word
            FROM conversations""",
    ),
    "said": (
        (),
        """SELECT CAST(conv_id AS VARCHAR) AS sender, role AS receiver, text AS message
           FROM conversations WHERE role IS NOT NULL AND text IS NOT NULL""",
    ),
}


def _vote(source: str) -> str:
    """The status vote as two windows over the rows of a (sub-)query."""
    return f"""SELECT emp_id, date, status, ingest_timestamp, event_id,
                      CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
               FROM (SELECT *, row_number() OVER (PARTITION BY emp_id, date
                                  ORDER BY ingest_timestamp DESC, event_id DESC) AS rn
                     FROM (SELECT *, CASE WHEN
                              count(*) FILTER (WHERE status = 'CANCELLED')
                                OVER (PARTITION BY emp_id, date) >=
                              count(*) FILTER (WHERE status = 'ACTIVE')
                                OVER (PARTITION BY emp_id, date)
                              THEN 'CANCELLED' ELSE 'ACTIVE' END AS decided
                           FROM {source})
                     WHERE status = decided) WHERE rn = 1"""


_PARTS["reconciled"] = (("intake",), _vote("intake"))
_PARTS["first_half"] = (
    ("entry",),
    "SELECT * FROM entry WHERE ingest_timestamp < TIMESTAMP '2024-01-16 00:00:00'",
)
_PARTS["stored"] = (("first_half",), _vote("first_half"))
_PARTS["pooled"] = (
    ("stored", "entry"),
    """SELECT emp_id, date, status, ingest_timestamp, event_id FROM stored
       UNION ALL
       SELECT emp_id, CAST(date - CASE WHEN date < DATE '2024-01-20' THEN 7 ELSE 14 END
                           AS DATE) AS date, status, ingest_timestamp, event_id
       FROM entry WHERE ingest_timestamp >= TIMESTAMP '2024-01-16 00:00:00'""",
)


def _with(body: str, *parts: str) -> str:
    """body preceded by the named sub-queries it needs."""
    order: list[str] = []

    def need(name: str) -> None:
        if name not in order:
            for other in _PARTS[name][0]:
                need(other)
            order.append(name)

    for part in parts:
        need(part)
    head = ",\n".join(f"{name} AS ({_PARTS[name][1]})" for name in order)
    return f"WITH {head}\n{body}"


def _rung(salary: str, i: int) -> str:
    power = Decimal(STRIKE_FACTOR) ** i
    digits = -power.as_tuple().exponent
    return (
        f"CAST(round(CAST({salary} AS DECIMAL(14,2)) * "
        f"CAST('{power:f}' AS DECIMAL({digits + 1},{digits})), 2) AS DOUBLE)"
    )


def _rungs(salary: str, count: str, single: bool = False) -> str:
    out = []
    for i, name in enumerate(rung_names(), start=1):
        value = _rung(salary, i)
        if single:
            value = f"CAST(CAST({value} AS REAL) AS DOUBLE)"
        out.append(f"CASE WHEN {count} >= {i} THEN {value} END AS {name}")
    return ",\n".join(out)


_CAPPED = f"CAST(least(strike_count, {MAX_STRIKES}) AS INTEGER)"

_PARTS["ladder"] = (
    ("counts", "balance"),
    f"""SELECT employee_id, salary, {_rungs("salary", "strike_count")},
               {_CAPPED} AS no_of_strikes
        FROM counts JOIN balance USING (employee_id)""",
)
_PARTS["early_ladder"] = (
    ("early_counts", "balance"),
    f"""SELECT employee_id, salary, {_rungs("salary", "strike_count")},
               {_CAPPED} AS no_of_strikes
        FROM early_counts JOIN balance USING (employee_id)""",
)
_PARTS["pay"] = (
    ("chained",),
    "SELECT emp_id AS employee_id, salary FROM chained WHERE status = 'ACTIVE'",
)
_PARTS["synced"] = (
    ("pay", "ladder"),
    f"""SELECT p.employee_id, p.salary, {_rungs("p.salary", "coalesce(no_of_strikes, 0)", True)},
               no_of_strikes
        FROM pay p LEFT JOIN ladder l ON l.employee_id = p.employee_id
        WHERE l.employee_id IS NULL OR p.salary <> l.salary""",
)


def _differs() -> str:
    names = ["salary", *rung_names(), "no_of_strikes"]
    return " OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for c in names)


def _kept() -> str:
    out = []
    for i, name in enumerate(rung_names(), start=1):
        out.append(
            f"CASE WHEN strike_count >= {i} THEN CASE WHEN e.no_of_strikes >= {i} "
            f"THEN e.{name} ELSE {_rung('p.salary', i)} END END AS {name}"
        )
    return ",\n".join(out)


def _upcoming(condition: str) -> str:
    return _with(
        f"""SELECT emp_id, count(DISTINCT date) AS upcoming_leaves_count,
                   '2024-01-10' AS run_date
            FROM reconciled JOIN upcoming_day USING (date)
            WHERE date < DATE '2024-01-31' AND {condition}
            GROUP BY emp_id
            HAVING count(DISTINCT date) * 100.0 / (SELECT count(*) FROM upcoming_day) > 60""",
        "reconciled",
        "upcoming_day",
    )


def _masks() -> str:
    """One row per employee, year and status with a number per month whose bits are its days."""
    months = ", ".join(
        f"CAST(coalesce(bit_or(CAST(1 AS BIGINT) << (day(date) - 1)) FILTER (WHERE month(date) = {k}), 0) AS INTEGER) AS m{k}"
        for k in range(1, 13)
    )
    return _with(
        f"""SELECT emp_id, status, CAST(year(date) AS INTEGER) AS year, {months},
                   CAST(count(DISTINCT date) AS INTEGER) AS days
            FROM reconciled GROUP BY emp_id, status, year(date)""",
        "reconciled",
    )


_COLUMNS = "emp_id, designation, start_date, end_date, salary, order_id, status"

_CHAIN = _with(f"SELECT {_COLUMNS} FROM chained", "chained")

_CLEAN = """SELECT DISTINCT c_custkey, c_name, c_acctbal FROM customer
            WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL AND c_acctbal > 0"""

_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _headcount(kind: str) -> str:
    """Active employees per designation, looking at one kind of delivery only."""
    return f"""SELECT designation, count(*) FILTER (WHERE following IS NULL) AS active_employees
               FROM (SELECT designation, lead(start_date) OVER (PARTITION BY emp_id
                                              ORDER BY start_date) AS following
                     FROM (SELECT *, row_number() OVER (PARTITION BY emp_id, start_date
                                        ORDER BY salary DESC, order_id DESC) AS rn
                           FROM period WHERE delivery = '{kind}') WHERE rn = 1)
               GROUP BY designation"""


_FILLED = _with(
    """SELECT emp_id, designation, start_date, end_date, salary, order_id,
              CASE WHEN end_date IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status
       FROM (SELECT emp_id, designation, start_date, salary, order_id,
                    CASE WHEN delivery = 'F' THEN CAST(start_date + 30 AS DATE)
                         ELSE lead(start_date) OVER (PARTITION BY emp_id ORDER BY start_date)
                    END AS end_date
             FROM best)""",
    "best",
)


_FLAGGED = _with(
    """SELECT CAST(conv_id AS VARCHAR) AS employee_id, turn FROM (
         SELECT conv_id, turn, bool_or(t.word IN ('the', 'die', 'la')) AS hit,
                bool_and(v.word IS NOT NULL) AS known
         FROM token t LEFT JOIN vocab v ON v.word = t.word
         GROUP BY conv_id, turn) WHERE hit AND known""",
    "token",
    "vocab",
)

_CALENDAR = """SELECT DISTINCT event_type AS reason, CAST(ts AS DATE) AS date,
                           CAST(year(ts) AS INTEGER) AS year FROM events"""

_STREAM = _with(
    f"""SELECT employee_id, salary, {_rungs("salary", "strike_count", True)},
               CAST(least(coalesce(strike_count, 0), {MAX_STRIKES}) AS INTEGER) AS no_of_strikes
        FROM balance LEFT JOIN (
          SELECT CAST(conv_id AS VARCHAR) AS employee_id, count(*) AS strike_count FROM (
            SELECT conv_id, turn, bool_or(word IN ('the', 'die', 'la')) AS hit,
                   bool_and(word IN (SELECT word FROM token JOIN conversations c
                                     USING (conv_id, turn) WHERE c.role <> 'system')) AS known
            FROM token GROUP BY conv_id, turn) WHERE hit AND known GROUP BY conv_id)
        USING (employee_id)""",
    "balance",
    "token",
)

SQL: dict[str, str] = {
    "clean_employees": _CLEAN,
    "best_per_key": _with(
        "SELECT emp_id, designation, start_date, salary, order_id FROM best", "best"
    ),
    "timeframe_chain": _CHAIN,
    "timeframe_chain_fill": _FILLED,
    "epoch_dates": """SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS emp_id,
                             CAST(o_orderdate AS DATE) AS start_date,
                             CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS end_date
                      FROM orders""",
    "timeframe_merge": _CHAIN,
    "interleaved_deliveries": _CHAIN,
    "split_store": _CHAIN,
    "period_changes": _with(
        f"SELECT {_COLUMNS} FROM chained WHERE emp_id IN (SELECT emp_id FROM period WHERE delivery = 'P')", "chained", "period"
    ),
    "timeframe_merge_touched": _CHAIN,
    "timeframe_merge_struck": _with(
        """SELECT emp_id, designation, start_date, end_date, salary, order_id,
                  CASE WHEN end_date IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status
           FROM (SELECT *, lead(start_date) OVER (PARTITION BY emp_id ORDER BY start_date)
                        AS end_date
                 FROM (SELECT *, row_number() OVER (PARTITION BY emp_id, start_date
                                    ORDER BY salary DESC, order_id DESC) AS rn
                       FROM period
                       WHERE delivery = 'F' OR emp_id NOT IN (SELECT employee_id FROM struck))
                 WHERE rn = 1)""",
        "period",
        "struck",
    ),
    "new_periods": _with(
        """SELECT order_id, emp_id, start_date, CAST(NULL AS DATE) AS end_date, salary
           FROM period p
           WHERE NOT EXISTS (SELECT 1 FROM period s WHERE s.delivery IN ('F', 'P')
                             AND s.emp_id = p.emp_id AND s.start_date = p.start_date
                             AND s.salary = p.salary)""",
        "period",
    ),
    "struck_overlay": _with(f"SELECT {_COLUMNS} FROM overlay", "overlay"),
    "struck_overlay_history": _with(
        """SELECT emp_id, designation, start_date, salary, order_id,
                  CASE WHEN s.employee_id IS NOT NULL THEN DATE '2002-01-01'
                       ELSE end_date END AS end_date,
                  CASE WHEN s.employee_id IS NOT NULL THEN 'INACTIVE' ELSE status END AS status
           FROM chained LEFT JOIN struck s ON s.employee_id = emp_id""",
        "chained",
        "struck",
    ),
    "mark_inactive": _with(
        """SELECT emp_id, designation, start_date, end_date, salary, order_id,
                  CASE WHEN emp_id IN (SELECT employee_id FROM struck) THEN 'INACTIVE'
                       ELSE status END AS status
           FROM chained""",
        "chained",
        "struck",
    ),
    "active_by_group": _with(
        """SELECT designation, count(*) FILTER (WHERE status = 'ACTIVE') AS active_employees,
                  '2002-01-01' AS run_date
           FROM chained GROUP BY designation""",
        "chained",
    ),
    "headcount_by_differences": _with(
        """SELECT designation, count(*) FILTER (WHERE status = 'ACTIVE') AS active_employees,
                  '2002-01-01' AS run_date
           FROM chained GROUP BY designation""",
        "chained",
    ),
    "headcount_upsert": _with(
        f"""SELECT coalesce(o.designation, f.designation) AS designation,
                   coalesce(o.active_employees, f.active_employees) AS active_employees
            FROM ({_headcount("F")}) f FULL OUTER JOIN ({_headcount("O")}) o
              ON o.designation = f.designation""",
        "period",
    ),
    "date_range": _with("SELECT date FROM order_day", "order_day"),
    "working_days": _with(
        """SELECT date FROM order_day WHERE dayofweek(date) NOT IN (0, 6)
             AND date NOT IN (SELECT date FROM order_holiday)""",
        "order_day",
        "order_holiday",
    ),
    "non_working_days": _with(
        """SELECT date FROM order_day WHERE dayofweek(date) IN (0, 6)
           UNION SELECT date FROM order_holiday""",
        "order_day",
        "order_holiday",
    ),
    "calendar_load": _CALENDAR,
    "quota_load": """SELECT DISTINCT o_custkey AS emp_id,
                            CAST(day(o_orderdate) AS INTEGER) AS leave_quota,
                            CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
    "leave_intake": _with(
        "SELECT emp_id, date, status, ingest_timestamp, event_id FROM intake", "intake"
    ),
    "leave_reconcile": _with("SELECT * FROM reconciled", "reconciled"),
    "leave_reconcile_history": _with(
        _vote("pooled"),
        "pooled",
    ),
    "upcoming_leaves": _upcoming("TRUE"),
    "upcoming_leaves_active": _upcoming("status = 'ACTIVE'"),
    "quota_usage": _with("SELECT * FROM usage", "usage"),
    "leave_day_masks": _masks(),
    "upcoming_leaves_masks": _upcoming("TRUE"),
    "quota_usage_masks": _with("SELECT * FROM usage", "usage"),
    "quota_over": _with("SELECT * FROM over", "over"),
    "new_alerts": _with(
        "SELECT * FROM over WHERE emp_id NOT IN (SELECT emp_id FROM alerted)", "over", "alerted"
    ),
    "alert_history": _with(
        "SELECT emp_id FROM over UNION SELECT emp_id FROM alerted", "over", "alerted"
    ),
    "alert_lines": _with(
        "SELECT report_date, emp_id, value || chr(10) AS value FROM alert_text", "alert_text"
    ),
    "strike_counts": _with("SELECT * FROM counts", "counts"),
    "strike_counts_decayed": _with(
        """SELECT employee_id, count(*) AS strike_count FROM flags
           WHERE ts >= TIMESTAMP '2024-01-21 00:00:00' GROUP BY employee_id""",
        "flags",
    ),
    "strike_counts_batch": _with(
        """SELECT * FROM counts WHERE employee_id IN
             (SELECT employee_id FROM flags WHERE ts >= TIMESTAMP '2024-01-29 00:00:00')""",
        "counts",
    ),
    "rolling_flags": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS employee_id, ts AS start_date,
                               count(*) OVER (PARTITION BY user_id, ts) AS flags,
                               count(*) OVER (PARTITION BY user_id ORDER BY ts
                                 RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)
                                 AS rolling_flags
                        FROM events WHERE event_type = 'error'""",
    "penalty_ladder": _with("SELECT * FROM ladder", "ladder"),
    "penalty_ladder_keep": _with(
        f"""SELECT e.employee_id, p.salary, {_kept()}, {_CAPPED} AS no_of_strikes
            FROM early_ladder e JOIN pay p USING (employee_id) JOIN counts USING (employee_id)""",
        "early_ladder",
        "pay",
        "counts",
    ),
    "changed_rows": _with(
        f"""SELECT n.* FROM ladder n JOIN early_ladder o USING (employee_id)
            WHERE {_differs()}""",
        "ladder",
        "early_ladder",
    ),
    "changes_by_digests": _with(
        f"""SELECT n.*, 'changed' AS change FROM ladder n JOIN early_ladder o USING (employee_id)
            WHERE {_differs()}
            UNION ALL
            SELECT *, 'added' FROM ladder WHERE employee_id NOT IN (SELECT employee_id FROM early_ladder)
            UNION ALL
            SELECT *, 'removed' FROM early_ladder WHERE employee_id NOT IN (SELECT employee_id FROM ladder)""",
        "ladder",
        "early_ladder",
    ),
    "salary_sync": _with("SELECT * FROM synced", "synced"),
    "strike_upsert": _with(
        """SELECT * FROM synced
           UNION ALL
           SELECT * FROM ladder WHERE employee_id NOT IN (SELECT employee_id FROM synced)""",
        "synced",
        "ladder",
    ),
    "struck_out": _with("SELECT employee_id FROM struck", "struck"),
    "struck_out_exact": _with(
        "SELECT employee_id FROM counts WHERE strike_count = 10", "counts"
    ),
    "merge_by_key": """SELECT coalesce(s_suppkey, c_custkey) AS id,
                              CASE WHEN s_acctbal > 0 THEN s_name ELSE c_name END AS name,
                              coalesce(s_acctbal, c_acctbal) AS balance
                       FROM customer FULL OUTER JOIN supplier ON s_suppkey = c_custkey""",
    "repeated_keys": _with(
        """SELECT emp_id, start_date, count(*) AS rows FROM period
           GROUP BY emp_id, start_date HAVING count(*) > 1""",
        "period",
    ),
    "flag_messages": _FLAGGED,
    "message_tokens": r"""SELECT CAST(conv_id AS VARCHAR) AS sender, turn,
                          CAST(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))
                               AS INTEGER) AS words
                          FROM conversations""",
    "encode_messages": _with(
        """SELECT sender AS key,
                  CAST(to_json({'sender': sender, 'receiver': receiver, 'message': message})
                       AS VARCHAR) AS value FROM said""",
        "said",
    ),
    "decode_messages": _with("SELECT sender, receiver, message FROM said", "said"),
    "csv_round_trip": _CUSTOMER,
    "csv_text_clean": _CLEAN,
    "csv_timeframe": _FILLED,
    "active_partition": _with(f"SELECT {_COLUMNS} FROM chained WHERE status = 'ACTIVE'", "chained"),
    "partition_overwrite": _with(
        """SELECT emp_id, designation, start_date, order_id, delivery,
                  CASE WHEN delivery = 'O' THEN salary * 2 ELSE salary END AS salary
           FROM period""",
        "period",
    ),
    "versioned_rewrite": _CHAIN,
    "alert_files": _with("SELECT report_date, emp_id, value FROM alert_text", "alert_text"),
    "word_list": "SELECT DISTINCT upper(p_brand) AS word FROM part",
    "ingest_archive": _CUSTOMER,
    "flag_messages_joined": _FLAGGED,
    "stream_strikes": _STREAM,
    "stream_restart": _STREAM,
    "daily_rerun": _with(
        """SELECT CAST(c_custkey AS VARCHAR) AS emp_id, 1::BIGINT AS n_records, n_periods, salary,
                  salary AS strike_salary
           FROM customer LEFT JOIN (
             SELECT emp_id, count(*) AS n_periods, max(salary) FILTER (status = 'ACTIVE') AS salary
             FROM chained GROUP BY emp_id) ON emp_id = CAST(c_custkey AS VARCHAR)""",
        "chained",
    ),
    "strike_out_store": _with(
        "SELECT emp_id, designation, start_date, end_date, salary, status FROM overlay", "overlay"
    ),
    "leave_two_days": _with(
        """SELECT emp_id, date, status FROM (
             SELECT emp_id, date, count(*) FILTER (status = 'CANCELLED') AS c,
                    count(*) FILTER (status = 'ACTIVE') AS a,
                    CASE WHEN c >= a THEN 'CANCELLED' ELSE 'ACTIVE' END AS status
             FROM (SELECT emp_id, date, status FROM first_votes
                   UNION ALL SELECT * FROM (
                     SELECT emp_id, CASE WHEN date < DATE '2024-01-20' THEN date - 7 ELSE date - 14 END AS date,
                            status
                     FROM moved WHERE ingest_timestamp >= TIMESTAMP '2024-01-16 00:00:00')
                   WHERE dayofweek(date) NOT IN (0, 6)
                     AND date NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE day(ts) IN (1, 15, 26)))
             GROUP BY emp_id, date)
           WHERE c > 0 OR a > 0""",
        "first_votes",
        "moved",
    ),
    "alert_files_two_runs": _with(
        """SELECT CASE WHEN emp_id IN (SELECT emp_id FROM alerted) THEN 1 ELSE 2 END AS run, emp_id, value
           FROM alert_text""",
        "alert_text",
        "alerted",
    ),
    "csv_no_header": _CALENDAR,
    "empty_delivery": """SELECT 'all' AS delivery, true AS taken, count(*) AS n_rows FROM customer
                         UNION ALL SELECT 'none', false, 0""",
    "input_files": "SELECT c_nationkey, count(*) AS n_rows FROM customer GROUP BY c_nationkey",
}
