"""The registered queries in plain SQL, over the driver's tables.

Written from the rules, not from the Spark code: each string states the result
as a direct (and unscaled) query. Views are inlined as CTEs.
"""

from __future__ import annotations

from batchgate import schema as S
from batchgate.operators.gate import REASON_GONE

AS_OF = "DATE '2024-02-15'"
SEED = 42

T = """
base AS (
  SELECT event_id AS k, event_id // 500 AS b, user_id, value,
         strftime(ts, '%Y-%m-%d') AS day,
         CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'refund'
              WHEN 'view' THEN 'transfer' WHEN 'signup' THEN 'adjustment' ELSE 'fee' END AS kind
  FROM events),
t AS (
  SELECT printf('incoming/transactions_2024-02-14_BATCH-%04d.csv', b)
           AS source_key,
         k AS row_seq,
         printf('TXN-%08d', CASE WHEN k % 97 = 5 THEN k - 1 ELSE k END)
           AS transaction_id,
         printf('BATCH-%04d', b) AS partner_batch_id,
         CASE WHEN k % 101 = 7 THEN '' ELSE printf('ACCT-%06d', user_id) END
           AS account_id,
         CASE WHEN k % 103 = 9 THEN '' WHEN k % 107 = 11 THEN 'not-a-date'
              WHEN k % 109 = 13 THEN '2999-01-01' ELSE day END AS transaction_date,
         CASE WHEN k % 127 = 17 THEN '' WHEN k % 109 = 13 THEN '2999-01-02'
              WHEN k % 113 = 15 THEN '2023-12-31' ELSE '2024-02-01' END AS posted_date,
         kind AS transaction_type,
         CASE WHEN k % 137 = 21 THEN '' WHEN k % 131 = 19 THEN 'not-a-number'
              WHEN k % 53 = 3 OR (k % 31 = 0 AND k % 62 <> 0) THEN '0.00'
              ELSE CAST(CAST(
                CASE WHEN (kind = 'refund' OR (kind IN ('transfer', 'adjustment') AND k % 2 = 0))
                          <> (k % 59 = 1)
                     THEN -value ELSE value END AS DECIMAL(12, 2)) AS VARCHAR) END AS amount,
         CASE WHEN k % 61 = 2 THEN 'XXX' WHEN k % 20 < 17 THEN 'USD'
              WHEN k % 20 < 19 THEN 'CAD' ELSE 'EUR' END AS currency,
         CASE WHEN k % 67 = 4 THEN 'unknown_status' WHEN k % 31 = 0 THEN 'failed'
              WHEN k % 19 = 0 THEN 'pending' WHEN k % 47 = 0 THEN 'reversed'
              ELSE 'completed' END AS status,
         'Merchant ' || (k % 12)::VARCHAR AS merchant_name,
         CASE WHEN kind <> 'refund' THEN '' WHEN k % 73 = 8 THEN ''
              WHEN k % 71 = 6 THEN 'TXN-99999999'
              ELSE printf('TXN-%08d', b * 500 + (k * 7 + 1) % 500) END
           AS related_transaction_id,
         'SYS-' || (k % 4)::VARCHAR AS source_system
  FROM base)"""

COLUMNS = (
    "transaction_id, partner_batch_id, account_id, transaction_date, posted_date, "
    "transaction_type, amount, currency, status, merchant_name, related_transaction_id, "
    "source_system"
)


def _date(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') "
        f"THEN TRY_CAST({column} AS DATE) END"
    )


def validation(rows: str = "t", as_of: str = AS_OF) -> str:
    """CTEs that judge the rows of the CTE ``rows``, ending in ``judged`` and ``v``."""
    return f"""
p AS (
  SELECT *,
         TRY_CAST(nullif(amount, '') AS DOUBLE) AS amount_num,
         {_date('transaction_date')} AS txn_dt,
         {_date('posted_date')} AS post_dt,
         (transaction_id = '')::INT + (account_id = '')::INT + (amount = '')::INT
           + (transaction_date = '')::INT AS blanks
  FROM {rows}),
c AS (SELECT *, blanks = 0 AND amount_num IS NOT NULL AND txn_dt IS NOT NULL AS ok FROM p),
dups AS (
  SELECT source_key, transaction_id, count(*) AS n FROM c WHERE ok
  GROUP BY ALL HAVING count(*) > 1),
ids AS (SELECT DISTINCT source_key, transaction_id FROM c WHERE transaction_id <> ''),
orphans AS (
  SELECT c.source_key, c.row_seq, c.transaction_id,
         'related_transaction_id ''' || c.related_transaction_id || ''' not found in file.'
           AS detail
  FROM c LEFT JOIN ids i
    ON i.source_key = c.source_key AND i.transaction_id = c.related_transaction_id
  WHERE ok AND transaction_type = 'refund' AND i.transaction_id IS NULL),
raw_v AS (
  SELECT source_key, row_seq, transaction_id, 1 AS ord, 0 AS sub, 'missing_required_field' AS rule,
         'critical' AS severity, 'Required field ''transaction_id'' is blank.' AS detail
  FROM c WHERE transaction_id = ''
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 2, 0, 'missing_required_field', 'critical',
         'Required field ''account_id'' is blank.' FROM c WHERE account_id = ''
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 3, 0, 'missing_required_field', 'critical',
         'Required field ''amount'' is blank.' FROM c WHERE amount = ''
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 4, 0, 'missing_required_field', 'critical',
         'Required field ''transaction_date'' is blank.' FROM c WHERE transaction_date = ''
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 5, 0, 'missing_required_field', 'critical',
         CASE WHEN amount_num IS NULL
              THEN 'amount value ''' || amount || ''' does not parse as a number.'
              ELSE 'transaction_date value ''' || transaction_date || ''' is not a valid date.' END
  FROM c WHERE blanks = 0 AND (amount_num IS NULL OR txn_dt IS NULL)
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 6, 0, 'invalid_enum_value', 'warning',
         CASE WHEN status NOT IN ('completed', 'pending', 'failed', 'reversed')
              THEN 'status ''' || status || ''' not recognized.'
              ELSE 'currency ''' || currency || ''' not recognized.' END
  FROM c WHERE ok AND (status NOT IN ('completed', 'pending', 'failed', 'reversed')
                       OR currency NOT IN ('USD', 'CAD', 'EUR'))
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 7, 0, 'date_logic_violation', 'critical',
         CASE WHEN post_dt IS NULL THEN 'posted_date is missing or unparseable.'
              WHEN post_dt < txn_dt THEN 'posted_date precedes transaction_date.'
              ELSE 'transaction_date is in the future.' END
  FROM c WHERE ok AND (post_dt IS NULL OR post_dt < txn_dt OR txn_dt > {as_of})
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 8, 0, 'amount_sign_mismatch', 'warning',
         CASE WHEN amount_num < 0 THEN 'Negative' ELSE 'Positive' END
           || ' amount on ' || transaction_type || '.'
  FROM c WHERE ok AND ((transaction_type IN ('purchase', 'fee') AND amount_num < 0)
                       OR (transaction_type = 'refund' AND amount_num > 0))
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 9, 0, 'status_amount_inconsistency', 'warning',
         'status is ''failed'' but amount is nonzero.'
  FROM c WHERE ok AND status = 'failed' AND amount_num <> 0
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 10, 0, 'zero_value_transaction', 'warning',
         'amount is 0.00.' FROM c WHERE ok AND amount_num = 0
  UNION ALL
  SELECT c.source_key, c.row_seq, c.transaction_id, 11, 0, 'duplicate_transaction', 'critical',
         'transaction_id appears ' || n::VARCHAR || ' times in the file.'
  FROM c JOIN dups USING (source_key, transaction_id) WHERE ok
  UNION ALL
  SELECT source_key, row_seq, transaction_id, 12, 0, 'orphaned_refund', 'critical', detail
  FROM orphans),
v AS (
  SELECT source_key, row_seq,
         (row_number() OVER (PARTITION BY source_key, row_seq ORDER BY ord, sub) - 1)::INT AS pos,
         CASE WHEN transaction_id = '' THEN 'UNKNOWN' ELSE transaction_id END AS transaction_id,
         rule, severity, detail
  FROM raw_v),
worst AS (
  SELECT source_key, row_seq, bool_or(severity = 'critical') AS critical FROM v GROUP BY ALL),
judged AS (
  SELECT c.*, coalesce(w.critical, false) AS critical, w.row_seq IS NOT NULL AS flagged
  FROM c LEFT JOIN worst w USING (source_key, row_seq))"""


VALID = f"WITH {T}, {validation()}"

COUNTS = """count(*) AS total_rows, count(*) FILTER (NOT critical) AS passed,
  count(*) FILTER (critical) AS rejected_critical,
  count(*) FILTER (flagged AND NOT critical) AS flagged_warning_only"""


def _row_rule(rule: str) -> str:
    return f"{VALID} SELECT source_key, row_seq, severity, detail FROM v WHERE rule = '{rule}'"


BENCH = f"""WITH {T},
b0 AS (
  SELECT *, TRY_CAST(nullif(amount, '') AS DOUBLE) AS amount_parsed,
         {_date('transaction_date')} AS transaction_date_parsed,
         {_date('posted_date')} AS posted_date_parsed
  FROM t),
b1 AS (
  SELECT *, count(nullif(transaction_id, '')) OVER (PARTITION BY transaction_id) AS id_count,
         transaction_type = 'refund' AND (related_transaction_id = ''
           OR related_transaction_id NOT IN (SELECT transaction_id FROM t)) AS orphaned
  FROM b0),
b2 AS (
  SELECT *,
         transaction_id = '' OR account_id = '' OR amount = '' OR transaction_date = ''
           OR amount_parsed IS NULL OR transaction_date_parsed IS NULL
           OR posted_date_parsed IS NULL
           OR coalesce(posted_date_parsed < transaction_date_parsed, false)
           OR coalesce(transaction_date_parsed > {AS_OF}, false)
           OR id_count > 1 OR orphaned AS critical
  FROM b1),
b3 AS (
  SELECT *,
         NOT critical AND (
           status NOT IN ('completed', 'pending', 'failed', 'reversed')
           OR currency NOT IN ('USD', 'CAD', 'EUR')
           OR (transaction_type IN ('purchase', 'fee') AND amount_parsed < 0)
           OR (transaction_type = 'refund' AND amount_parsed > 0)
           OR (status = 'failed' AND amount_parsed <> 0) OR amount_parsed = 0) AS warning
  FROM b2)"""

BENCH_COUNTS = """count(*) AS total_rows, count(*) FILTER (NOT critical) AS passed,
  count(*) FILTER (critical) AS rejected_critical,
  count(*) FILTER (warning) AS flagged_warning_only"""


FILES = f"""WITH f AS (
  SELECT doc_id AS arrival_seq,
         CASE WHEN doc_id % 11 = 3 THEN 'incoming/not_a_valid_filename_' || doc_id || '.csv'
              WHEN doc_id % 29 = 7
              THEN 'incoming/transactions_2024-13-45_BATCH-' || doc_id || '.csv'
              ELSE 'incoming/transactions_2024-02-'
                || lpad((1 + doc_id % 28)::VARCHAR, 2, '0') || '_BATCH-'
                || (CASE WHEN doc_id % 13 = 5 THEN doc_id - 1 ELSE doc_id END) || '.csv' END
           AS source_key,
         n_chars AS size_bytes, doc_id % 17 = 2 AS already_processed
  FROM documents),
named AS (
  SELECT *,
         nullif(regexp_extract(source_key,
           '/transactions_(\\d{{4}}-\\d{{2}}-\\d{{2}})_([A-Za-z0-9-]+)\\.csv$', 1), '')
           AS file_date,
         nullif(regexp_extract(source_key,
           '/transactions_(\\d{{4}}-\\d{{2}}-\\d{{2}})_([A-Za-z0-9-]+)\\.csv$', 2), '')
           AS partner_batch_id
  FROM f),
gated AS (
  SELECT *,
         CASE WHEN partner_batch_id IS NULL THEN 'rejected_filename'
              WHEN size_bytes > 10000 THEN 'rejected_size'
              WHEN TRY_CAST(file_date AS DATE) IS NULL THEN 'failed'
              ELSE 'accepted' END AS disposition,
         date_diff('day', TRY_CAST(file_date AS DATE), {AS_OF}) AS age
  FROM named),
files AS (
  SELECT *,
         CASE disposition
           WHEN 'rejected_filename' THEN 'filename does not match the expected convention'
           WHEN 'rejected_size' THEN 'file size (' || size_bytes
             || ' bytes) exceeds the 10000-byte limit for a daily file'
           WHEN 'failed' THEN 'file date ''' || file_date || ''' is not a date' END AS reason,
         CASE WHEN disposition <> 'accepted' THEN NULL
              WHEN age > 3 THEN 'Filename date ' || file_date || ' is ' || age
                || ' days in the past'
              WHEN age < -3 THEN 'Filename date ' || file_date || ' is ' || (-age)
                || ' days in the future' END AS staleness,
         disposition = 'accepted' AND (already_processed OR coalesce(
           count(*) FILTER (disposition = 'accepted') OVER (
             PARTITION BY partner_batch_id ORDER BY arrival_seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0) AS reprocessing,
         disposition = 'accepted' AND coalesce(
           count(*) FILTER (disposition = 'accepted') OVER (
             PARTITION BY partner_batch_id ORDER BY arrival_seq
             ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) > 0 AS superseded
  FROM gated)"""

REJECTED_TAIL = (
    "The file has been left in place. Review it manually in the AWS Console and rename, "
    "move, or delete it as appropriate."
)


def _draw(stream: int, key: str, slot: int) -> str:
    digest = f"md5('{SEED}:{stream}:' || ({key})::VARCHAR)"
    return f"('0x' || substr({digest}, {8 * slot + 1}, 8))::BIGINT"


def _uniform(stream: int, key: str, slot: int) -> str:
    return f"({_draw(stream, key, slot)} / 4294967296.0)"


def _weighted(u: str, bounds: list[tuple[float | None, str]]) -> str:
    cases = " ".join(f"WHEN {u} < {b} THEN {v}" for b, v in bounds if b is not None)
    return f"CASE {cases} ELSE {bounds[-1][1]} END"


def _even(u: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[floor({u} * {len(values)})::INT + 1]"


_KIND = _weighted(
    "u_kind",
    [(0.7, "'purchase'"), (0.82, "'refund'"), (0.92, "'transfer'"), (0.97, "'adjustment'"),
     (None, "'fee'")],
)
_STATUS = _weighted(
    "u_status",
    [(0.9, "'completed'"), (0.95, "'pending'"), (0.98, "'failed'"), (None, "'reversed'")],
)
# One clean transaction per order; 5000 orders to a file.
CLEAN = f"""
drawn AS (
  SELECT o_orderkey + 1 AS k, 'B' || (o_orderkey // 5000)::VARCHAR AS batch,
         {_uniform(0, 'o_orderkey + 1', 0)} AS u_kind,
         {_uniform(0, 'o_orderkey + 1', 1)} AS u_status,
         {_uniform(0, 'o_orderkey + 1', 2)} AS u_currency,
         {_uniform(0, 'o_orderkey + 1', 3)} AS u_merchant,
         {_draw(1, 'o_orderkey + 1', 0)} AS d_day,
         {_uniform(1, 'o_orderkey + 1', 1)} AS u_lag,
         {_draw(1, 'o_orderkey + 1', 2)} AS d_account,
         {_uniform(1, 'o_orderkey + 1', 3)} AS u_system,
         {_uniform(2, 'o_orderkey + 1', 0)} AS u_r,
         {_uniform(2, 'o_orderkey + 1', 1)} AS u_a,
         {_uniform(2, 'o_orderkey + 1', 2)} AS u_sign
  FROM orders),
shaped AS (
  SELECT *, {_KIND} AS kind, {_STATUS} AS st,
         DATE '2024-02-14' - (d_day % 2)::INT AS txn_day,
         {_weighted('u_lag', [(0.6, '0'), (0.9, '1'), (None, '2')])} AS lag,
         greatest(0.01, least(9999.99, round(exp(3.2 + 0.9 * sqrt(-2.0 * ln(1.0 - u_r))
           * cos(2.0 * pi() * u_a)), 2))) AS size
  FROM drawn),
clean AS (
  SELECT 'incoming/transactions_2024-02-14_' || batch || '.csv' AS source_key, k AS row_seq,
         printf('TXN-%08d', k) AS transaction_id, batch AS partner_batch_id,
         'ACCT-' || lpad((d_account % 5000 + 1)::VARCHAR, 6, '0') AS account_id,
         strftime(txn_day, '%Y-%m-%d') AS transaction_date,
         strftime(txn_day + lag, '%Y-%m-%d') AS posted_date,
         kind AS transaction_type,
         printf('%.2f', (CASE WHEN st = 'failed' THEN 0.0
           WHEN kind = 'refund' OR (kind IN ('transfer', 'adjustment') AND u_sign >= 0.5)
           THEN -size ELSE size END)::DOUBLE) AS amount,
         {_weighted('u_currency', [(0.85, "'USD'"), (0.95, "'CAD'"), (None, "'EUR'")])}
           AS currency,
         st AS status, {_even('u_merchant', S.MERCHANTS)} AS merchant_name,
         '' AS related_transaction_id, {_even('u_system', S.SOURCE_SYSTEMS)} AS source_system
  FROM shaped)"""


def links(rows: str, out: str, order: str = "row_seq", stream: int = 90) -> str:
    """CTEs that link the unlinked refunds of ``rows``, ending in ``out``."""
    high, low = (_draw(stream, f"r.source_key || '|' || {order}::VARCHAR", k) for k in (0, 1))
    drawn = f"(({high}) // 2)::HUGEINT * {1 << 31} + ({low}) // 2"
    return f"""
{out}_pool AS (
  SELECT source_key, transaction_id AS target,
         row_number() OVER (PARTITION BY source_key ORDER BY {order}) AS rank
  FROM {rows} WHERE transaction_type <> 'refund'),
{out}_size AS (SELECT source_key, count(*) AS n FROM {out}_pool GROUP BY ALL),
{out} AS (
  SELECT r.* REPLACE (coalesce(target, related_transaction_id) AS related_transaction_id)
  FROM {rows} r LEFT JOIN {out}_size s
    ON s.source_key = r.source_key AND transaction_type = 'refund' AND related_transaction_id = ''
  LEFT JOIN {out}_pool q ON q.source_key = r.source_key
    AND q.rank = (({drawn}) * s.n // {1 << 62} + 1)::BIGINT)"""


def _u(slot: int) -> str:
    return _uniform(12, "row_seq", slot)


_NAMES = [
    "missing_required_field", "duplicate_transaction", "invalid_enum_value",
    "date_logic_violation", "orphaned_refund", "amount_sign_mismatch",
    "status_amount_inconsistency", "zero_value_transaction",
]
_CRITICAL = ["missing_required_field", "duplicate_transaction", "date_logic_violation",
             "orphaned_refund"]


def _later(days: int) -> str:
    return f"strftime(transaction_date::DATE + {days}, '%Y-%m-%d')"


DEFECTIVE = f"""
ranked AS (
  SELECT *, row_number() OVER (ORDER BY {_draw(10, 'row_seq', 0)}, row_seq) AS place,
         floor({_uniform(11, 'row_seq', 0)} * 8)::INT AS choice FROM linked),
marked AS (
  SELECT * EXCLUDE (place, choice),
         CASE WHEN place <= greatest(1, floor((SELECT count(*) FROM linked) * 0.05))
              THEN choice END AS defect,
         {_u(0)} AS u0, {_u(1)} AS u1, {_u(2)} AS u2 FROM ranked),
changed AS (
  SELECT * REPLACE (
    CASE WHEN defect = 0 AND floor(u0 * 3) = 0 THEN '' ELSE account_id END AS account_id,
    CASE WHEN defect = 0 AND floor(u0 * 3) = 2 THEN ''
         WHEN defect = 3 AND u0 < 0.5 THEN {_later(3)}
         WHEN defect = 3 THEN {_later(365)} ELSE transaction_date END AS transaction_date,
    CASE WHEN defect = 3 AND u0 < 0.5 THEN transaction_date ELSE posted_date END AS posted_date,
    CASE WHEN defect = 4 THEN 'refund' ELSE transaction_type END AS transaction_type,
    CASE WHEN defect = 0 AND floor(u0 * 3) = 1 THEN ''
         WHEN defect = 4 THEN '-' || printf('%.2f', abs(amount::DOUBLE))
         WHEN defect = 5 AND transaction_type IN ('purchase', 'fee')
         THEN printf('%.2f', -(amount::DOUBLE))
         WHEN defect IN (5, 6) THEN printf('%.2f', abs(amount::DOUBLE))
         WHEN defect = 7 THEN '0.00' ELSE amount END AS amount,
    CASE WHEN defect = 2 AND u0 >= 0.5
         THEN {_even('u2', ['XXX', 'ZZZ', 'N/A'])} ELSE currency END AS currency,
    CASE WHEN defect = 2 AND u0 < 0.5
         THEN 'unknown_status_' || (floor(u1 * 99)::INT + 1)::VARCHAR
         WHEN defect = 6 THEN 'failed' ELSE status END AS status,
    CASE WHEN defect = 4
         THEN 'TXN-' || (90000000 + floor(u0 * 10000000)::BIGINT)::VARCHAR
         ELSE related_transaction_id END AS related_transaction_id)
  FROM marked),
defective AS (
  SELECT * EXCLUDE (defect, u0, u1, u2), false AS is_copy FROM changed
  UNION ALL
  SELECT * EXCLUDE (defect, u0, u1, u2), true FROM changed WHERE defect = 1),
manifest AS (
  SELECT transaction_id, {_even('(defect + 0.5) / 8', _NAMES)} AS defect,
         CASE WHEN defect IN (0, 1, 3, 4) THEN 'critical' ELSE 'warning' END AS severity
  FROM marked WHERE defect IS NOT NULL),
numbered AS (SELECT *, row_seq * 2 + is_copy::INT AS link_seq FROM defective),
{links('numbered', 'relinked', 'link_seq', 91)},
seeded AS (SELECT * EXCLUDE (link_seq) FROM relinked)"""

SEEDED = f"WITH {CLEAN}, {links('clean', 'linked')}, {DEFECTIVE}"

_DOC = """{'partner_batch_id': regexp_extract(source_key, '_([A-Za-z0-9-]+)\\.csv$', 1),
  'source_key': source_key, 'processed_at': '2024-02-15T00:00:00+00:00',
  'counts': {'total_rows': total_rows, 'passed': passed,
             'rejected_critical': rejected_critical,
             'flagged_warning_only': flagged_warning_only},
  'exceptions': coalesce(found, []), 'shared_violations': coalesce(common, [])}"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "structural_violations": f"""{VALID}
SELECT source_key, row_seq, pos, transaction_id, rule, severity, detail
FROM v WHERE rule = 'missing_required_field'""",
        "rule_invalid_enum": _row_rule("invalid_enum_value"),
        "rule_date_logic": _row_rule("date_logic_violation"),
        "rule_amount_sign": _row_rule("amount_sign_mismatch"),
        "rule_status_amount": _row_rule("status_amount_inconsistency"),
        "rule_zero_value": _row_rule("zero_value_transaction"),
        "rule_duplicate": _row_rule("duplicate_transaction"),
        "rule_orphaned_refund": f"""{VALID}
SELECT source_key, row_seq, transaction_id, 'critical' AS severity, detail FROM orphans""",
        "shared_violations": f"""{VALID}
SELECT o.source_key, o.transaction_id, o.row_seq, 'orphaned_refund' AS rule,
       'critical' AS severity, o.detail
FROM orphans o JOIN dups USING (source_key, transaction_id)""",
        "exceptions_full": f"""{VALID},
own AS (
  SELECT v.* FROM v LEFT JOIN dups USING (source_key, transaction_id)
  LEFT JOIN c ON c.source_key = v.source_key AND c.row_seq = v.row_seq
  WHERE NOT (rule = 'orphaned_refund' AND dups.n IS NOT NULL AND c.ok)),
entries AS (
  SELECT source_key, transaction_id, detail,
         row_number() OVER (PARTITION BY source_key, transaction_id ORDER BY row_seq) - 1 AS k
  FROM orphans JOIN dups USING (source_key, transaction_id)),
shared_rows AS (
  SELECT c.source_key, c.row_seq, transaction_id,
         (SELECT count(*) FROM own WHERE own.source_key = c.source_key AND own.row_seq = c.row_seq) AS before
  FROM c JOIN dups USING (source_key, transaction_id) WHERE ok)
SELECT source_key, row_seq, pos, transaction_id, rule, severity, detail FROM own
UNION ALL
SELECT source_key, row_seq, (before + k)::INT, transaction_id, 'orphaned_refund', 'critical', detail
FROM shared_rows JOIN entries USING (source_key, transaction_id)""",
        "exceptions_long": f"""{VALID}
SELECT source_key, row_seq, pos, transaction_id, rule, severity, detail FROM v""",
        "row_dispositions": f"""{VALID}
SELECT source_key, row_seq, ok, critical, flagged,
       CASE WHEN ok THEN count(*) FILTER (ok) OVER (PARTITION BY source_key, transaction_id)
            ELSE 0 END AS same_id FROM judged""",
        "valid_transactions": f"""{VALID}
SELECT source_key, row_seq, {COLUMNS} FROM judged WHERE NOT critical""",
        "batch_summary": f"{VALID} SELECT source_key, {COUNTS} FROM judged GROUP BY source_key",
        "batch_summary_by_rule": f"""{VALID}
SELECT source_key, rule, severity, count(*) AS violations FROM v GROUP BY ALL""",
        "raw_id_set": f"WITH {T} SELECT DISTINCT source_key, transaction_id FROM t "
        "WHERE transaction_id <> ''",
        "id_counts": f"""{VALID}
SELECT source_key, transaction_id, count(*) AS n FROM c WHERE ok GROUP BY ALL""",
        "bench_parse": f"""{BENCH}
SELECT row_seq, amount_parsed, transaction_date_parsed, posted_date_parsed FROM b0""",
        "bench_dup_counts": f"{BENCH} SELECT row_seq, id_count FROM b1",
        "bench_orphans": f"{BENCH} SELECT row_seq, transaction_id FROM b1 WHERE orphaned",
        "bench_flags": f"{BENCH} SELECT row_seq, critical, warning FROM b3",
        "bench_aggregate": f"{BENCH} SELECT {BENCH_COUNTS} FROM b3",
        "bench_by_type": f"{BENCH} SELECT transaction_type, {BENCH_COUNTS} FROM b3 GROUP BY ALL",
        "file_gate": f"""{FILES}
SELECT arrival_seq, source_key, file_date, partner_batch_id, disposition, reason FROM files""",
        "file_staleness": f"{FILES} SELECT arrival_seq, staleness FROM files "
        "WHERE staleness IS NOT NULL",
        "file_reprocessing": f"""{FILES}
SELECT arrival_seq, partner_batch_id, already_processed, reprocessing, superseded FROM files
WHERE reprocessing OR superseded""",
        "file_dispositions": f"""{FILES}
SELECT disposition, CASE WHEN disposition <> 'accepted' THEN NULL WHEN age > 3 THEN 'past'
         WHEN age < -3 THEN 'future' ELSE 'fresh' END
         AS freshness, already_processed, count(*) AS files
FROM files GROUP BY ALL""",
        "file_alerts": f"""{FILES}
SELECT source_key, 'Transaction Pipeline: Rejected File' AS subject,
       'A file was rejected: ' || reason || chr(10) || chr(10) || 'Bucket: bucket' || chr(10)
       || 'Key: ' || source_key || chr(10) || chr(10) || '{REJECTED_TAIL}' AS message
FROM files WHERE disposition LIKE 'rejected%'
UNION ALL
SELECT source_key, 'Transaction Pipeline: Reprocessing Detected',
       'A file was received for a batch that has already been processed. '
       || 'The previous result will be overwritten.' || chr(10) || chr(10)
       || 'Bucket: bucket' || chr(10) || 'Key: ' || source_key || chr(10)
       || 'Partner batch ID: ' || partner_batch_id || chr(10) || chr(10)
       || 'No action is required unless this reprocessing was unexpected.'
FROM files WHERE reprocessing""",
        "file_dead_letters": f"""{FILES}
SELECT source_key, size_bytes, reason AS error FROM files WHERE disposition = 'failed'""",
        "event_explode": f"""{FILES}
SELECT arrival_seq, 'bucket' AS bucket, source_key,
       CASE WHEN arrival_seq % 5 = 0 THEN 0 ELSE size_bytes END AS size_bytes FROM f""",
        "retention_expired": f"""SELECT 'BATCH-' || doc_id AS partner_batch_id,
       (doc_id % 200)::INT AS age_days FROM documents WHERE doc_id % 200 > 90""",
        "refund_link": f"""WITH {T}, {links('t', 'linked')}
SELECT source_key, row_seq, transaction_id, related_transaction_id FROM linked
WHERE transaction_type = 'refund'""",
        "gen_clean": f"WITH {CLEAN} SELECT source_key, row_seq, {COLUMNS} FROM clean",
        "gen_benchmark": f"WITH {CLEAN}, {links('clean', 'linked')} "
        f"SELECT source_key, row_seq, {COLUMNS} FROM linked",
        "inject_defects": f"{SEEDED} SELECT source_key, row_seq, is_copy, {COLUMNS} FROM defective",
        "gen_seeded": f"{SEEDED} SELECT source_key, row_seq, is_copy, {COLUMNS} FROM seeded",
        "defect_manifest": f"{SEEDED} SELECT transaction_id, defect, severity FROM manifest",
        "manifest_reconcile": f"""{SEEDED},
renumbered AS (SELECT * REPLACE (row_seq * 2 + is_copy::INT AS row_seq) FROM seeded),
{validation('renumbered')}
SELECT transaction_id, defect, severity,
       EXISTS (SELECT 1 FROM v WHERE v.transaction_id = m.transaction_id AND v.rule = m.defect)
         AS detected FROM manifest m""",
        "processed_transactions": f"""{VALID}
SELECT regexp_extract(source_key, '_([A-Za-z0-9-]+)\\.csv$', 1) AS batch, {COLUMNS}
FROM judged WHERE NOT critical""",
        "processed_summaries": f"""{VALID},
counts AS (SELECT source_key, {COUNTS} FROM judged GROUP BY source_key),
lists AS (
  SELECT source_key, row_seq, transaction_id, ok,
         list({{'rule': rule, 'severity': severity, 'detail': detail}} ORDER BY pos) AS violations
  FROM v JOIN (SELECT source_key, row_seq, ok FROM c) USING (source_key, row_seq) GROUP BY ALL),
docs AS (
  SELECT source_key,
         list({{'transaction_id': transaction_id, 'violations': violations,
                'shared': CASE WHEN ok AND n > 1 THEN true END}} ORDER BY ok, row_seq) AS found
  FROM lists LEFT JOIN dups USING (source_key, transaction_id) GROUP BY source_key),
commons AS (
  SELECT source_key,
         list({{'transaction_id': transaction_id, 'row_seq': row_seq, 'rule': 'orphaned_refund',
                'severity': 'critical', 'detail': detail}} ORDER BY row_seq) AS common
  FROM orphans JOIN dups USING (source_key, transaction_id) GROUP BY source_key)
SELECT regexp_extract(source_key, '_([A-Za-z0-9-]+)\\.csv$', 1) AS batch,
       to_json({_DOC})::VARCHAR AS document
FROM counts LEFT JOIN docs USING (source_key) LEFT JOIN commons USING (source_key)""",
        "file_profile": f"""WITH {T}
SELECT source_key, true AS utf8_ok, true AS usual_header, count(*) + 1 AS n_lines FROM t GROUP BY source_key""",
        "utf8_gate": """SELECT DISTINCT
  'incoming/transactions_2024-02-14_D' || (doc_id // 20) || '.csv' AS source_key
FROM documents WHERE doc_id % 7 = 3 AND contains(text, 'é')""",
        "pipeline_files": f"""{VALID}
SELECT source_key, 'accepted' AS disposition, NULL::VARCHAR AS staleness, {COUNTS}
FROM judged GROUP BY source_key""",
        "pipeline_transactions": f"""{VALID}
SELECT regexp_extract(source_key, '_([A-Za-z0-9-]+)\\.csv$', 1) AS batch, {COLUMNS}
FROM judged WHERE NOT critical""",
        "streamed_transactions": f"""{VALID}
SELECT regexp_extract(source_key, '_([A-Za-z0-9-]+)\\.csv$', 1) AS batch,
       {COLUMNS.replace('merchant_name', "CASE WHEN row_seq // 500 % 3 = 1 THEN 'Second ' ELSE '' END || merchant_name AS merchant_name")}
FROM judged WHERE NOT critical""",
        "removed_batches": f"""WITH {T}
SELECT DISTINCT regexp_extract(source_key, '_([A-Za-z0-9-]+)\\.csv$', 1) AS batch
FROM t WHERE (row_seq // 500) % 5 <> 0""",
        "versioned_transactions": f"""{VALID}
SELECT regexp_extract(source_key, '_([A-Za-z0-9-]+)\\.csv$', 1) AS batch,
       CASE WHEN row_seq // 500 % 3 = 1 THEN 'second' ELSE 'first' END AS run,
       {COLUMNS.replace('merchant_name', "CASE WHEN row_seq // 500 % 3 = 1 THEN 'Second ' ELSE '' END || merchant_name AS merchant_name")}
FROM judged WHERE NOT critical""",
        "versioned_summaries": f"""{VALID}
SELECT regexp_extract(source_key, '_([A-Za-z0-9-]+)\\.csv$', 1) AS batch,
       CASE WHEN row_seq // 500 % 3 = 1 THEN 'second' ELSE 'first' END AS run,
       count(*) AS total_rows, count(*) FILTER (NOT critical) AS passed
FROM judged GROUP BY ALL""",
        "reprocessing_by_index": f"""{FILES}
SELECT arrival_seq, nullif(partner_batch_id, '') AS partner_batch_id,
       coalesce(partner_batch_id IN (
         SELECT partner_batch_id FROM files WHERE arrival_seq % 17 = 2 AND partner_batch_id IS NOT NULL), false)
         AS already_processed
FROM files""",
        "retired_batches": f"""WITH {T}
SELECT DISTINCT regexp_extract(source_key, '_([A-Za-z0-9-]+)\\.csv$', 1) AS batch,
       CASE WHEN row_seq // 500 % 3 = 1 THEN 'second' ELSE 'first' END AS run
FROM t WHERE (row_seq // 500) % 5 <> 0""",
        "workload_counts": f"""{BENCH}, counts AS (SELECT {BENCH_COUNTS} FROM b3)
SELECT 'type ' || transaction_type AS name, count(*) AS n FROM b3 GROUP BY transaction_type
UNION ALL SELECT 'total_rows', total_rows FROM counts
UNION ALL SELECT 'passed', passed FROM counts
UNION ALL SELECT 'rejected_critical', rejected_critical FROM counts
UNION ALL SELECT 'flagged_warning_only', flagged_warning_only FROM counts""",
        "quoted_records": """SELECT
  'incoming/transactions_2024-02-14_Q' || (doc_id // 100) || '.csv' AS source_key,
  doc_id::VARCHAR AS transaction_id,
  regexp_replace(coalesce(text, ''), '[\r\n]', '', 'g') AS merchant_name FROM documents""",
        "pipeline_dispositions": f"""{VALID},
counts AS (SELECT source_key, row_seq // 500 AS b, {COUNTS} FROM judged GROUP BY ALL),
others AS (
  SELECT replace(source_key, 'BATCH-', 'GONE-') AS source_key, 'failed' AS disposition,
         '{REASON_GONE}' AS reason FROM counts WHERE b % 3 = 0
  UNION ALL SELECT replace(source_key, 'BATCH-', 'LOST-'), 'failed', '{REASON_GONE}' FROM counts WHERE b % 3 = 1
  UNION ALL SELECT 'incoming/no_date_' || b || '.csv', 'rejected_filename',
         'filename does not match the expected convention' FROM counts WHERE b % 5 = 2
  UNION ALL SELECT replace(source_key, 'BATCH-', 'HUGE-'), 'rejected_size',
         'file size (1099511627776 bytes) exceeds the {S.MAX_FILE_BYTES}-byte limit for a daily file'
  FROM counts WHERE b % 5 = 3)
SELECT source_key, 'accepted' AS disposition, NULL::VARCHAR AS reason,
       total_rows, passed, rejected_critical, flagged_warning_only FROM counts
UNION ALL SELECT *, NULL, NULL, NULL, NULL FROM others""",
        "csv_roundtrip": f"WITH {T} SELECT "
        + ", ".join(f"nullif({c.strip()}, '') AS {c.strip()}" for c in COLUMNS.split(","))
        + " FROM t",
    }
    return sql
