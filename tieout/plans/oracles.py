"""Plain SQL for the registered queries, over the order table alone.

Written apart from the DataFrame code and in other terms where there is a choice (windows
for least rows, list functions for text), so that equal answers mean something.
"""

import re
from string import Formatter

from tieout import fixed_values as fv


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sentence(template: str, **figures: str) -> str:
    """A fixed text with its ``{name}`` marks as SQL concatenation."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(_q(literal))
        if name:
            parts.append(f"CAST({figures[name]} AS VARCHAR)")
    return " || ".join(parts)


def _case_of(column: str, templates: dict, **figures: str) -> str:
    whens = [f"WHEN '{code}' THEN {_sentence(t, **figures)}" for code, t in templates.items()]
    return f"CASE {column} {' '.join(whens)} ELSE '' END"


_HOLIDAYS = "[DATE '1995-12-25', DATE '1996-01-01', DATE '1996-12-25', DATE '1997-01-01', DATE '1998-05-01']"

_CTES = [
    (
        "keyed",
        """
SELECT *, CASE WHEN slot < 40 THEN 'timing_lag_refund' WHEN slot < 65 THEN 'mdr_rate_mismatch'
               WHEN slot < 80 THEN 'duplicate_transaction' WHEN slot < 95 THEN 'missing_payout'
               WHEN slot < 100 THEN 'unexplained_value_break' ELSE 'clean_match' END AS label
FROM (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
             CAST(o_orderdate AS DATE) AS odate, (o_orderkey * 7919) % 1000 AS slot,
             o_orderkey // 25 AS bno FROM orders)""",
    ),
    (
        "ledger_x",
        """
SELECT k AS order_id, printf('CUST-%06d', c) AS customer_id, amount AS order_amount,
       odate AS order_date,
       CASE WHEN has_refund THEN CAST(amount * CAST(0.2 + 0.1 * ((k * 13) % 8) AS DECIMAL(4,2))
                                      AS DECIMAL(18,2)) END AS refund_amount,
       CASE WHEN has_refund THEN odate + CAST(1 + k % 3 AS INTEGER) END AS refund_date,
       CAST(0.02 AS DECIMAL(6,4)) AS expected_mdr_rate, label, bno
FROM (SELECT *, (k * 37) % 1000 < 150 OR slot < 40 AS has_refund FROM keyed)""",
    ),
    (
        "ledger",
        """
SELECT order_id, customer_id, order_amount, order_date, refund_amount, refund_date,
       expected_mdr_rate FROM ledger_x""",
    ),
    (
        "own_lines",
        """
SELECT 'TXN-' || order_id AS transaction_id, order_id, order_amount AS gross_amount, mdr_fee,
       gst_on_mdr, refund_adjustment,
       CAST(order_amount - mdr_fee - gst_on_mdr - refund_adjustment
            - CASE WHEN label = 'unexplained_value_break' THEN 1 ELSE 0 END AS DECIMAL(18,2))
         AS net_amount,
       printf('UTR%06d', bno) AS utr_number, printf('BATCH-%06d', bno) AS settlement_batch_id,
       label, bno
FROM (SELECT *, CAST(mdr_fee * 0.18 AS DECIMAL(18,2)) AS gst_on_mdr
      FROM (SELECT *, CAST(order_amount * CASE WHEN label = 'mdr_rate_mismatch' THEN 0.0210
                                               ELSE 0.0200 END AS DECIMAL(18,2)) AS mdr_fee,
                   CAST(CASE WHEN label = 'timing_lag_refund' THEN 0
                             ELSE coalesce(refund_amount, 0) END AS DECIMAL(18,2))
                     AS refund_adjustment
            FROM ledger_x))""",
    ),
    (
        "lines_x",
        """
SELECT * FROM own_lines WHERE label <> 'missing_payout'
UNION ALL SELECT * FROM own_lines WHERE label = 'duplicate_transaction'
UNION ALL SELECT * REPLACE ('TXN-O-' || order_id AS transaction_id, -order_id - 1 AS order_id)
FROM own_lines WHERE order_id % 400 = 7""",
    ),
    ("lines", "SELECT * EXCLUDE (label, bno) FROM lines_x"),
    (
        "per_batch",
        """
SELECT o.bno, o.last_date + 2 AS credit_date, coalesce(l.net, 0)::DECIMAL(18,2) AS net,
       l.utr AS utr
FROM (SELECT bno, max(order_date) AS last_date FROM ledger_x GROUP BY bno) o
LEFT JOIN (SELECT bno, CAST(sum(net_amount) AS DECIMAL(18,2)) AS net, min(utr_number) AS utr
           FROM lines_x GROUP BY bno) l ON o.bno = l.bno""",
    ),
    (
        "bank_feed",
        """
SELECT printf('UTR%06d', bno) AS utr_number,
       CAST(net + CASE WHEN bno % 29 = 0 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS bank_credit_amount,
       credit_date, printf('BATCH-%06d', bno) AS settlement_batch_id
FROM per_batch WHERE bno % 31 <> 30
UNION ALL
SELECT printf('UTR%06d', bno), CAST(10 AS DECIMAL(18,2)), credit_date, printf('GHOST-%06d', bno)
FROM per_batch WHERE bno % 37 = 36""",
    ),
    (
        "ranked_lines",
        """
SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY transaction_id NULLS FIRST,
            mdr_fee NULLS FIRST, gst_on_mdr NULLS FIRST, refund_adjustment NULLS FIRST,
            net_amount NULLS FIRST, utr_number NULLS FIRST, settlement_batch_id NULLS FIRST) AS rn,
       count(*) OVER (PARTITION BY order_id) AS n FROM lines""",
    ),
    (
        "truth",
        """
SELECT o.order_id, o.label AS exception_type,
       """
        + _case_of(
            "o.label",
            fv.TRUTH_SENTENCES,
            refund="o.refund_amount",
            refund_date="o.refund_date",
            fee="l.mdr_fee",
            expected_fee="CAST(o.order_amount * o.expected_mdr_rate AS DECIMAL(18,2))",
            transaction_id="l.transaction_id",
        )
        + """ AS expected_reasoning,
       l.transaction_id AS related_transaction_id
FROM ledger_x o LEFT JOIN ranked_lines l ON o.order_id = l.order_id AND l.rn = 1""",
    ),
    (
        "expected",
        """
SELECT order_id, order_amount, refund_amount, expected_mdr_fee, expected_refund_adjustment,
       expected_gst_on_mdr,
       CAST(order_amount - expected_mdr_fee - expected_gst_on_mdr - expected_refund_adjustment
            AS DECIMAL(18,2)) AS expected_net_amount
FROM (SELECT *, CAST(expected_mdr_fee * 0.18 AS DECIMAL(18,2)) AS expected_gst_on_mdr
      FROM (SELECT *, CAST(order_amount * expected_mdr_rate AS DECIMAL(18,2)) AS expected_mdr_fee,
                   CAST(coalesce(refund_amount, 0) AS DECIMAL(18,2)) AS expected_refund_adjustment
            FROM ledger))""",
    ),
    (
        "joined",
        """
SELECT e.*, coalesce(l.n, 0) AS settlement_row_count, l.transaction_id, l.mdr_fee, l.gst_on_mdr,
       l.refund_adjustment, l.net_amount, l.utr_number, l.settlement_batch_id
FROM expected e LEFT JOIN ranked_lines l ON e.order_id = l.order_id AND l.rn = 1""",
    ),
    (
        "identity",
        """
SELECT *, CAST(mdr_fee * 0.18 AS DECIMAL(18,2)) AS gst_on_charged_fee,
       CAST(order_amount - mdr_fee - gst_on_mdr - refund_adjustment AS DECIMAL(18,2))
         AS identity_net_amount FROM joined""",
    ),
    (
        "classified",
        """
SELECT *, CASE WHEN settlement_row_count = 0 THEN 'missing_payout'
               WHEN settlement_row_count >= 2 THEN 'duplicate_transaction'
               WHEN abs(mdr_fee - expected_mdr_fee) > 0.01 THEN 'mdr_rate_mismatch'
               WHEN abs(refund_adjustment - expected_refund_adjustment) > 0.01
                 THEN 'timing_lag_refund'
               WHEN abs(gst_on_mdr - gst_on_charged_fee) > 0.01
                 OR abs(net_amount - identity_net_amount) > 0.01 THEN 'unexplained_value_break'
               ELSE 'clean_match' END AS category FROM identity""",
    ),
    (
        "result",
        """
SELECT order_id,
       CASE WHEN category = 'clean_match' THEN 'exact'
            WHEN category IN ('missing_payout', 'duplicate_transaction') THEN 'no_match'
            ELSE 'fuzzy' END AS match_tier,
       category,
       """
        + _case_of(
            "category",
            fv.ENGINE_SENTENCES,
            refund="expected_refund_adjustment",
            fee="mdr_fee",
            expected_fee="expected_mdr_fee",
            row_count="settlement_row_count",
            gst_on_charged="gst_on_charged_fee",
            gst="gst_on_mdr",
            identity_net="identity_net_amount",
            net="net_amount",
        )
        + """ AS reasoning,
       order_amount, expected_mdr_fee, mdr_fee AS actual_mdr_fee, expected_refund_adjustment,
       refund_adjustment AS actual_refund_adjustment, expected_net_amount,
       net_amount AS actual_net_amount, settlement_row_count, transaction_id, utr_number,
       settlement_batch_id FROM classified""",
    ),
    (
        "calendar",
        f"""
SELECT day, sum(CASE WHEN isodow(day) < 6 AND NOT list_contains({_HOLIDAYS}, day) THEN 1 ELSE 0 END)
              OVER (ORDER BY day) AS nth
FROM (SELECT CAST(unnest(generate_series(least((SELECT min(order_date) FROM ledger), (SELECT min(credit_date) FROM bank_feed)),
             greatest((SELECT max(order_date) FROM ledger), (SELECT max(credit_date) FROM bank_feed)), INTERVAL 1 DAY)) AS DATE) AS day)""",
    ),
    (
        "batch_net",
        """
SELECT settlement_batch_id, CAST(sum(net_amount) AS DECIMAL(18,2)) AS computed_batch_net
FROM lines GROUP BY settlement_batch_id""",
    ),
    (
        "checked",
        """
SELECT *, abs(batch_diff) <= 0.01 AS batch_balanced
FROM (SELECT b.*, n.computed_batch_net,
             CAST(b.bank_credit_amount - n.computed_batch_net AS DECIMAL(18,2)) AS batch_diff
      FROM bank_feed b LEFT JOIN batch_net n ON b.settlement_batch_id = n.settlement_batch_id)""",
    ),
    (
        "controls",
        """
SELECT order_id FROM result WHERE category = 'clean_match'
ORDER BY sha256(order_id || '|42'), order_id LIMIT 5""",
    ),
    (
        "marked",
        """
SELECT r.*, CASE WHEN r.category <> 'clean_match' THEN 'flagged_by_engine'
                 WHEN c.order_id IS NOT NULL THEN 'clean_control_sample'
                 ELSE 'not_selected' END AS selection_reason
FROM result r LEFT JOIN controls c ON r.order_id = c.order_id""",
    ),
    (
        "responses",
        """
SELECT order_id, CASE WHEN order_id % 89 = 7 THEN attempt - 1
                      WHEN order_id % 83 = 9 THEN attempt * 3 ELSE attempt END AS attempt,
       CASE WHEN bad AND attempt = 1 THEN 'not json'
         WHEN bad AND attempt = 2 THEN '{"cause":"clean_match"}'
         WHEN bad THEN '{"cause":"clean_match","explanation":"x","confidence":"high",'
                       || '"recommended_action":"x"}'
         WHEN order_id % 17 = 3 THEN
           '[{"type":"text","text":"' || replace(good, '"', '\\"') || '"}]'
         ELSE good END AS content,
       order_id % 50 + 100 AS latency_ms, 'advisory-model-a' AS model,
       'prompt-0001' AS prompt_version
FROM (SELECT *, order_id % 97 = 5 OR order_id % 79 = 11 OR attempt < tries AS bad,
             '{"cause":"' || cause || '","explanation":"' || expl || '","confidence":'
             || CASE WHEN order_id % 7 = 5 THEN '95' ELSE '0.9' END
             || ',"recommended_action":"Review order ' || order_id || '."}' AS good
      FROM (SELECT order_id, tries, unnest(range(1, tries + 1)) AS attempt,
                   CASE WHEN order_id % 13 = 5 OR label = 'unexplained_value_break' THEN 'other'
                        ELSE label END AS cause,
                   CASE WHEN order_id % 5 = 0 THEN 'The line agrees with the order.'
                        WHEN order_id % 5 = 1
                          THEN printf('See 00000000-0000-4000-8000-%012d only.', order_id)
                        ELSE 'Amount on order is ' || order_amount END AS expl
            FROM (SELECT *, CASE WHEN order_id % 97 = 5 THEN 3 WHEN order_id % 79 = 11 THEN 1
                                 WHEN order_id % 11 = 5 THEN 2
                                 ELSE 1 END AS tries FROM ledger_x)))""",
    ),
    (
        "messages",
        """
SELECT *, CASE WHEN ltrim(content)[1] = '[' AND json_valid(content)
               THEN array_to_string(json_extract_string(content, '$[*].text'), '')
               ELSE content END AS message FROM responses""",
    ),
    (
        "read_replies",
        """
SELECT * EXCLUDE (message, j, pct), CASE WHEN pct IS NOT NULL THEN
         greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN pct > 1 THEN pct / 100 ELSE pct END))
         END AS confidence
FROM (SELECT *, CASE WHEN json_type(j, '$.cause') = 'VARCHAR' THEN j ->> '$.cause' END AS cause,
        CASE WHEN json_type(j, '$.explanation') = 'VARCHAR' THEN j ->> '$.explanation' END
          AS explanation,
        CASE WHEN json_type(j, '$.confidence') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
             THEN CAST(j ->> '$.confidence' AS DOUBLE) END AS pct,
        CASE WHEN json_type(j, '$.recommended_action') = 'VARCHAR'
             THEN j ->> '$.recommended_action' END AS recommended_action,
        j IS NOT NULL AS is_json
      FROM (SELECT *, CASE WHEN json_valid(message) THEN message END AS j FROM messages))""",
    ),
    (
        "parsed",
        """
SELECT order_id, attempt, content, latency_ms, model, prompt_version, error IS NULL AS valid,
       cause, explanation, confidence, recommended_action, error
FROM (SELECT *, CASE WHEN NOT is_json THEN 'not JSON'
                  WHEN cause IS NULL OR cause NOT IN ('clean_match', 'timing_lag_refund',
                       'mdr_rate_mismatch', 'duplicate_transaction', 'missing_payout', 'other')
                    THEN 'invalid field: cause'
                  WHEN explanation IS NULL THEN 'invalid field: explanation'
                  WHEN confidence IS NULL THEN 'invalid field: confidence'
                  WHEN recommended_action IS NULL THEN 'invalid field: recommended_action' END
               AS error
      FROM read_replies)""",
    ),
    (
        "resolved",
        """
SELECT o.order_id, w.attempt IS NOT NULL AS diagnosed, n.attempts_used,
       w.cause, w.explanation, w.confidence, w.recommended_action,
       CASE WHEN w.attempt IS NULL
            THEN 'no schema-valid response after ' || n.attempts_used || ' attempts: ' || f.error
            END AS error,
       n.latency_ms,
       o.model, o.prompt_version
FROM (SELECT order_id, max(attempt) AS last, min(model) AS model,
             min(prompt_version) AS prompt_version FROM parsed GROUP BY order_id) o
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY attempt) AS rn
           FROM parsed WHERE valid) w ON w.order_id = o.order_id AND w.rn = 1
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY attempt DESC) AS rn
           FROM parsed WHERE NOT valid) f ON f.order_id = o.order_id AND f.rn = 1
LEFT JOIN (SELECT p.order_id, count(*) AS attempts_used,
                  CAST(sum(p.latency_ms) AS BIGINT) AS latency_ms
           FROM parsed p JOIN (SELECT order_id, coalesce(min(attempt) FILTER (valid), max(attempt))
                                      AS until FROM parsed GROUP BY order_id) u
             ON u.order_id = p.order_id AND p.attempt <= u.until
           GROUP BY p.order_id) n ON n.order_id = o.order_id""",
    ),
    (
        "line_sums",
        """
SELECT order_id, count(*) AS n,
       sum(CAST(('0x' || substr(h, 1, 15))::BIGINT AS HUGEINT)) AS s1,
       sum(CAST(('0x' || substr(h, 16, 15))::BIGINT AS HUGEINT)) AS s2
FROM (SELECT order_id, sha256('gst_on_mdr=' || gst_on_mdr || '|mdr_fee=' || mdr_fee
        || '|net_amount=' || net_amount || '|refund_adjustment=' || refund_adjustment
        || '|settlement_batch_id=' || settlement_batch_id || '|transaction_id='
        || transaction_id) AS h FROM lines)
GROUP BY order_id""",
    ),
    (
        "all_headers",
        """
SELECT o.order_id, o.order_amount, o.order_date, o.refund_amount, o.refund_date,
       o.expected_mdr_rate, e.expected_mdr_fee, e.expected_gst_on_mdr,
       e.expected_refund_adjustment, e.expected_net_amount,
       b.bank_credit_amount AS batch_bank_credit_amount,
       n.computed_batch_net AS batch_computed_settlement_net,
       l.settlement_batch_id, coalesce(l.n, 0) AS settlement_row_count,
       substr(sha256(
         'batch_bank_credit_amount=' || coalesce(b.bank_credit_amount::VARCHAR, 'null')
         || '|batch_computed_settlement_net='
         || coalesce(n.computed_batch_net::VARCHAR, 'null')
         || '|expected_gst_on_mdr=' || e.expected_gst_on_mdr
         || '|expected_mdr_fee=' || e.expected_mdr_fee
         || '|expected_mdr_rate=' || o.expected_mdr_rate
         || '|expected_net_amount=' || e.expected_net_amount
         || '|expected_refund_adjustment=' || e.expected_refund_adjustment
         || '|order_amount=' || o.order_amount || '|order_date=' || o.order_date
         || '|order_id=' || o.order_id
         || '|refund_amount=' || coalesce(o.refund_amount::VARCHAR, 'null')
         || '|refund_date=' || coalesce(o.refund_date::VARCHAR, 'null')
         || '|lines=' || coalesce(s.n || ':' || s.s1 || ':' || s.s2, '0:0:0')), 1, 16)
         AS case_fingerprint
FROM ledger o JOIN expected e ON o.order_id = e.order_id
LEFT JOIN ranked_lines l ON l.order_id = o.order_id AND l.rn = 1
LEFT JOIN line_sums s ON s.order_id = o.order_id
LEFT JOIN batch_net n ON n.settlement_batch_id = l.settlement_batch_id
LEFT JOIN bank_feed b ON b.settlement_batch_id = l.settlement_batch_id""",
    ),
    (
        "headers",
        """
SELECT h.* FROM all_headers h JOIN marked m ON m.order_id = h.order_id
WHERE m.selection_reason <> 'not_selected'""",
    ),
    (
        "audit",
        """
SELECT '1.0' AS schema_version, 'run-0001' AS run_id,
       TIMESTAMP '2026-01-05 00:00:00' AS run_started_at, m.order_id,
       m.match_tier AS engine_match_tier, m.category AS engine_category,
       m.reasoning AS engine_reasoning, m.selection_reason AS agent_selection_reason,
       d.order_id IS NOT NULL AS agent_invoked,
       CASE WHEN d.order_id IS NOT NULL THEN NULL
            WHEN m.category = 'clean_match' THEN """
        + _q(fv.SKIP_CLEAN)
        + """ ELSE """
        + _q(fv.SKIP_NOT_REACHED)
        + """ END AS agent_skip_reason,
       d.cause AS agent_cause, d.explanation AS agent_explanation,
       d.confidence AS agent_confidence, d.recommended_action AS agent_recommended_action,
       d.model AS agent_model, d.prompt_version AS agent_prompt_version,
       CASE WHEN d.order_id IS NOT NULL THEN h.case_fingerprint END AS agent_case_fingerprint,
       CASE WHEN d.diagnosed THEN d.latency_ms END AS agent_latency_ms, d.error AS agent_error,
       coalesce(regexp_matches(regexp_replace(d.explanation,
         '[0-9a-f]{8}-[0-9a-f-]{27}', '', 'g'), '[0-9]'), false)
         AS agent_explanation_cites_figures,
       CASE WHEN d.cause IS NULL THEN 'not_assessed' WHEN d.cause = m.category THEN 'agree'
            ELSE 'disagree' END AS engine_agent_agreement,
       CASE WHEN m.category = 'clean_match' AND d.error IS NULL
             AND (d.cause IS NULL OR d.cause = m.category) THEN 'auto_cleared'
            ELSE 'needs_human_review' END AS review_status,
       CASE WHEN m.category <> 'clean_match' THEN
              CASE WHEN d.cause <> m.category THEN """
        + _q(fv.REVIEW_FLAGGED_DISAGREE)
        + """ ELSE """
        + _q(fv.REVIEW_FLAGGED)
        + """ END
            WHEN d.error IS NOT NULL THEN """
        + _q(fv.REVIEW_CONTROL_ERROR)
        + """
            WHEN d.cause <> m.category THEN """
        + _q(fv.REVIEW_CONTROL_DISAGREE)
        + """
            ELSE """
        + _q(fv.REVIEW_CLEARED)
        + """ END AS review_reason,
       'none' AS action_taken, false AS autonomous_action_taken,
       'advisory_only' AS action_policy, """
        + _q(fv.ACTION_NOTE)
        + """ AS action_note,
       m.order_amount AS evidence_order_amount, m.expected_mdr_fee AS evidence_expected_mdr_fee,
       m.actual_mdr_fee AS evidence_actual_mdr_fee,
       m.expected_refund_adjustment AS evidence_expected_refund_adjustment,
       m.actual_refund_adjustment AS evidence_actual_refund_adjustment,
       m.expected_net_amount AS evidence_expected_net_amount,
       m.actual_net_amount AS evidence_actual_net_amount,
       m.settlement_row_count AS evidence_settlement_row_count,
       m.transaction_id AS evidence_transaction_id,
       m.settlement_batch_id AS evidence_settlement_batch_id
FROM marked m
LEFT JOIN resolved d ON d.order_id = m.order_id AND m.selection_reason <> 'not_selected'
LEFT JOIN all_headers h ON h.order_id = m.order_id""",
    ),
]

_NAMES = [name for name, _ in _CTES]


def _with(body: str) -> str:
    """The query under the tables it needs, directly or through others."""
    bodies = dict(_CTES)
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"[a-z_]+", todo.pop()))
        for name in _NAMES:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(bodies[name])
    ctes = ",\n".join(f"{n} AS ({b})" for n, b in _CTES if n in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


_LOOKED_UP = (
    "(SELECT a.*, t.exception_type AS ground_truth FROM audit a "
    "JOIN truth t ON t.order_id = a.order_id)"
)
_GRADED = (
    "(SELECT r.*, t.exception_type AS true_category FROM result r "
    "JOIN truth t ON t.order_id = r.order_id)"
)
# lines without a fee or a net cannot be compared on them
_GAPS = (
    "FROM (SELECT *, CASE WHEN settlement_row_count = 0 THEN 'missing_payout' "
    "WHEN settlement_row_count >= 2 THEN 'duplicate_transaction' "
    "WHEN NOT no_fee AND abs(mdr_fee - expected_mdr_fee) > 0.01 THEN 'mdr_rate_mismatch' "
    "WHEN abs(refund_adjustment - expected_refund_adjustment) > 0.01 THEN 'timing_lag_refund' "
    "WHEN NOT no_fee AND abs(gst_on_mdr - gst_on_charged_fee) > 0.01 OR NOT no_fee AND NOT no_net "
    "AND abs(net_amount - identity_net_amount) > 0.01 THEN 'unexplained_value_break' "
    "ELSE 'clean_match' END AS category FROM (SELECT * EXCLUDE category, order_id % 53 = 9 AS "
    "no_fee, order_id % 59 = 4 AS no_net FROM classified))"
)
_ASSESSED = f"(SELECT * FROM {_LOOKED_UP} WHERE agent_invoked AND agent_cause <> '')"
_HELD = "review_status = 'needs_human_review'"
_AUDIT_CSV = ", ".join(fv.AUDIT_CSV_COLUMNS)
_QUEUE = ", ".join(fv.QUEUE_COLUMNS)
_SLICE = ", ".join(fv.SLICE_COLUMNS)

# the largest and the least order amounts of every slice are in play
SLICE_FILTER = (
    "engine_category IN ('clean_match', 'mdr_rate_mismatch', 'missing_payout') "
    "AND engine_match_tier IN ('exact', 'fuzzy', 'no_match') "
    "AND review_status IN ('needs_human_review', 'auto_cleared') "
    "AND coalesce(evidence_order_amount, 0) >= 250000"
)

_LABEL_CASE = (
    "CASE {c} "
    + " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in fv.CATEGORY_LABELS.items())
    + " ELSE {c} END"
)


def _label(column: str) -> str:
    return _LABEL_CASE.replace("{c}", column)


def _inr(value: str, digits: str, fraction: str) -> str:
    """Grouped from the right: three digits, then pairs, by turning the text around."""
    whole = f"split_part({digits}, '.', 1)"
    head = f"left({whole}, length({whole}) - 3)"
    pairs = (
        f"reverse(regexp_replace(regexp_replace(reverse({head}), '(\\d\\d)', '\\1,', 'g'), "
        f"',$', ''))"
    )
    grouped = (
        f"CASE WHEN length({whole}) > 3 THEN {pairs} || ',' || right({whole}, 3) "
        f"ELSE {whole} END"
    )
    return (
        f"CASE WHEN {value} IS NULL THEN 'n/a' ELSE CASE WHEN {value} < 0 THEN '{fv.MINUS}' "
        f"ELSE '' END || '{fv.RUPEE}' || {grouped} || {fraction} END"
    )


def _compact(value: str) -> str:
    v = f"CAST({value} AS DOUBLE)"
    return (
        f"CASE WHEN {value} IS NULL THEN 'n/a' "
        f"WHEN abs({v}) >= 1e7 THEN '{fv.RUPEE}' || format('{{:,.2f}}', {v} / 1e7) || ' Cr' "
        f"WHEN abs({v}) >= 1e5 THEN '{fv.RUPEE}' || format('{{:,.2f}}', {v} / 1e5) || ' L' "
        f"ELSE '{fv.RUPEE}' || format('{{:,.0f}}', {v}) END"
    )


def _checks(source: str, checks: dict[str, str]) -> str:
    counts = ", ".join(f"count(*) FILTER (coalesce({bad}, true)) AS {n}" for n, bad in checks.items())
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, {n} = 0 AS passed, CAST({n} AS BIGINT) AS n_bad FROM c"
        for n in checks
    )
    return f"(WITH c AS (SELECT {counts} FROM {source}) {rows})"


def _filled(table: str, columns: tuple) -> str:
    return _checks(table, {f"{table}_{c}_filled": f"{c} IS NULL" for c in columns})


_SUMMARY = (
    """
SELECT '1.0' AS schema_version, 'run-0001' AS run_id,
       TIMESTAMP '2026-01-05 00:00:00' AS run_started_at, a.*, b.*, 'advisory_only' AS action_policy
FROM (SELECT count(*) AS total_orders,
        count(*) FILTER (engine_match_tier = 'exact') AS tier_exact,
        count(*) FILTER (engine_match_tier = 'fuzzy') AS tier_fuzzy,
        count(*) FILTER (engine_match_tier = 'no_match') AS tier_no_match,
"""
    + ",\n".join(
        f"count(*) FILTER (engine_category = '{c}') AS category_{c}" for c in fv.CATEGORIES
    )
    + """,
        round(count(*) FILTER (engine_match_tier = 'exact') / count(*), 4) AS exact_match_rate,
        round(count(*) FILTER (engine_match_tier IN ('exact', 'fuzzy')) / count(*), 4)
          AS auto_resolved_rate,
        count(*) FILTER (engine_category <> 'clean_match') AS flagged_orders,
        count(*) FILTER (agent_invoked) AS agent_invoked_count,
        count(*) FILTER (agent_error IS NOT NULL) AS agent_failed_count,
        count(*) FILTER (agent_selection_reason = 'clean_control_sample') AS control_sample_count,
        min(agent_model) AS agent_model, min(agent_prompt_version) AS agent_prompt_version,
        0.0::DOUBLE AS agent_temperature,
        CAST(coalesce(sum(agent_latency_ms), 0) AS BIGINT) AS agent_total_latency_ms,
"""
    + ",\n".join(
        f"count(*) FILTER (engine_agent_agreement = '{a}' AND agent_selection_reason = "
        f"'flagged_by_engine') AS agreement_{a}"
        for a in fv.AGREEMENTS
    )
    + """,
        round(CAST(sum(CAST(agent_confidence AS DECIMAL(18,9))) AS DOUBLE)
              / count(agent_confidence), 3) AS mean_agent_confidence,
        count(*) FILTER (agent_explanation_cites_figures) AS explanations_citing_figures,
        count(*) FILTER (review_status = 'needs_human_review') AS orders_needing_human_review,
        count(*) FILTER (review_status = 'auto_cleared') AS orders_auto_cleared,
        CAST(0 AS BIGINT) AS autonomous_actions_taken
      FROM audit) a,
     (SELECT count(*) AS batches_checked,
             count(*) - count(*) FILTER (NOT batch_balanced) AS batches_balanced FROM checked) b"""
)

_GRADING = f"""
SELECT 'run-0001' AS run_id, count(*) AS total_orders,
       count(*) FILTER (engine_category = ground_truth) AS engine_correct,
       count(*) FILTER (engine_category = ground_truth) / count(*) AS engine_accuracy,
       count(*) FILTER (agent_invoked AND agent_cause <> '') AS agent_graded_orders,
       count(*) FILTER (agent_invoked AND agent_cause = ground_truth) AS agent_correct,
       count(*) FILTER (agent_invoked AND agent_cause = ground_truth)
         / count(*) FILTER (agent_invoked AND agent_cause <> '') AS agent_accuracy,
       count(DISTINCT ground_truth) AS engine_labels,
       count(DISTINCT CASE WHEN agent_invoked AND agent_cause <> '' THEN ground_truth END)
         AS agent_labels
FROM {_LOOKED_UP}"""


_CASE_LINE = (
    "transaction_id",
    "mdr_fee",
    "gst_on_mdr",
    "refund_adjustment",
    "net_amount",
    "settlement_batch_id",
)
_LISTED = (
    "(SELECT order_id, count(*) AS n_listed, string_agg("
    + _sentence(fv.CASE_LINE_TEXT, **{c: c for c in _CASE_LINE})
    + " || CASE WHEN copies > 1 THEN ' (x' || copies || ')' ELSE '' END"
    + ", chr(10) ORDER BY transaction_id, mdr_fee, gst_on_mdr, refund_adjustment, net_amount) "
    f"AS listed FROM (SELECT order_id, {', '.join(_CASE_LINE)}, count(*) AS copies FROM lines "
    "GROUP BY ALL) GROUP BY order_id)"
)


_CASE_FIELDS = (
    "order_id",
    "order_amount",
    "order_date",
    "refund_amount",
    "refund_date",
    "expected_mdr_rate",
    "expected_mdr_fee",
    "expected_gst_on_mdr",
    "expected_refund_adjustment",
    "expected_net_amount",
    "settlement_row_count",
    "batch_bank_credit_amount",
    "batch_computed_settlement_net",
)
_RENDER = (
    "SELECT h.order_id, 0 AS part_no, 1 AS n_parts, "
    + _sentence(
        fv.CASE_TEXT,
        lines=f"coalesce(l.listed, {_q(fv.CASE_NO_LINES)})",
        **{c: f"coalesce(CAST(h.{c} AS VARCHAR), {_q(fv.CASE_NO_VALUE)})" for c in _CASE_FIELDS},
    )
    + f" AS case_text FROM headers h LEFT JOIN {_LISTED} l ON l.order_id = h.order_id"
)

_DIGESTS = """
SELECT printf('BATCH-%06d', bno) AS settlement_batch_id,
       sha256(n || ':' || s1 || ':' || s2) AS id_digest
FROM (SELECT bno, count(*) AS n,
             sum(CAST(('0x' || substr(h, 1, 15))::BIGINT AS HUGEINT)) AS s1,
             sum(CAST(('0x' || substr(h, 16, 15))::BIGINT AS HUGEINT)) AS s2
      FROM (SELECT bno, sha256(order_id::VARCHAR) AS h FROM ledger_x) GROUP BY bno)"""

_RUNS = """
SELECT 'run-0001' AS run_id, order_id, CAST(order_amount AS DECIMAL(24,4)) AS order_amount, settlement_row_count,
       CAST(NULL AS VARCHAR) AS reasoning, CAST(NULL AS BOOLEAN) AS reviewed FROM result
UNION ALL SELECT 'run-0002', order_id, order_amount, settlement_row_count, reasoning, NULL FROM result
UNION ALL SELECT 'run-0003', order_id, order_amount, settlement_row_count, reasoning, order_id % 2 = 0
FROM result"""

# weekdays that are no holidays, counted day by day
_LAGS = f"""
SELECT l.order_id, l.transaction_id, l.settlement_batch_id, o.order_date, b.credit_date,
       CAST(c2.nth - c1.nth AS INTEGER) AS settlement_days,
       CASE WHEN b.credit_date IS NULL THEN 'no_credit' WHEN c2.nth - c1.nth < 1 THEN 'early'
            WHEN c2.nth - c1.nth > 400 THEN 'late' ELSE 'on_time' END AS status
FROM lines l JOIN ledger o ON l.order_id = o.order_id
LEFT JOIN (SELECT settlement_batch_id, min(credit_date) AS credit_date FROM bank_feed GROUP BY 1) b
  ON l.settlement_batch_id = b.settlement_batch_id
LEFT JOIN calendar c1 ON c1.day = o.order_date LEFT JOIN calendar c2 ON c2.day = b.credit_date"""
_GROSS = """
SELECT order_id, transaction_id, gross_amount, order_amount
FROM (SELECT l.* REPLACE (CAST(CASE WHEN l.order_id % 90 = 4 THEN l.gross_amount + 1
                                    WHEN l.order_id % 90 <> 5 THEN l.gross_amount END AS DECIMAL(18,2)) AS gross_amount),
             o.order_amount FROM lines l JOIN ledger o ON l.order_id = o.order_id)
WHERE gross_amount IS NULL OR gross_amount <> order_amount"""
_LEVELS = 6
_TREE = (
    """
SELECT * FROM (WITH placed AS (
    SELECT row_number() OVER (ORDER BY order_date, order_id) - 1 AS place, order_id FROM ledger),
level_0 AS (
    SELECT place // 64 AS node, CAST(count(*) AS BIGINT) AS n,
           sha256(string_agg(place || ' =' || order_id, chr(10) ORDER BY place)) AS digest
    FROM placed GROUP BY 1)"""
    + "".join(
        f""",
level_{i} AS (
    SELECT node // 64 AS node, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(node || ' ' || digest, chr(10) ORDER BY node)) AS digest
    FROM level_{i - 1} WHERE (SELECT count(*) FROM level_{i - 1}) > 1 GROUP BY 1)"""
        for i in range(1, _LEVELS)
    )
    + "\n"
    + " UNION ALL ".join(f"SELECT {i} AS level, node, n, digest FROM level_{i}" for i in range(_LEVELS))
    + ")"
)

_EVIDENCE_ROWS = " UNION ALL ".join(
    f"SELECT order_id, '{label}' AS label, evidence_expected_{name} AS expected, "
    f"evidence_actual_{name} AS actual, "
    f"abs(evidence_expected_{name} - evidence_actual_{name}) > 0.01 AS differs FROM audit "
    f"WHERE {_HELD} AND evidence_expected_{name} IS NOT NULL AND evidence_actual_{name} IS NOT NULL"
    for label, name in (
        ("MDR fee", "mdr_fee"),
        ("Refund adj.", "refund_adjustment"),
        ("Net amount", "net_amount"),
    )
)

_KPI = f"""
SELECT count(*) AS orders, count(*) FILTER (review_status = 'auto_cleared') AS auto_cleared,
       count(*) FILTER (review_status = 'auto_cleared') / count(*) AS auto_rate,
       count(*) FILTER ({_HELD}) AS needs_review,
       CAST(sum(evidence_order_amount) FILTER (review_status = 'auto_cleared') AS DECIMAL(18,2))
         AS value_cleared,
       CAST(sum(evidence_order_amount) FILTER ({_HELD}) AS DECIMAL(18,2)) AS value_held,
       CAST(sum(evidence_order_amount) FILTER ({_HELD}) AS DOUBLE)
         / CAST(sum(evidence_order_amount) AS DOUBLE) AS held_share FROM audit"""

_CHECK_LABELS = _checks(
    """(SELECT o.*, t.exception_type, coalesce(s.n, 0) AS n, s.t0, s.t1, s.fee, s.adj,
          abs(s.fee - CAST(o.order_amount * o.expected_mdr_rate AS DECIMAL(18,2))) AS gap
        FROM ledger o JOIN truth t ON t.order_id = o.order_id
        LEFT JOIN (SELECT order_id, count(*) AS n, min(transaction_id) AS t0,
                          max(transaction_id) AS t1, min(mdr_fee) AS fee,
                          min(refund_adjustment) AS adj FROM lines GROUP BY order_id) s
          ON s.order_id = o.order_id)""",
    {
        "missing_has_no_line": "exception_type = 'missing_payout' AND n <> 0",
        "duplicate_has_two_lines": "exception_type = 'duplicate_transaction' AND n <> 2",
        "duplicate_is_a_copy": (
            "exception_type = 'duplicate_transaction' AND coalesce(t0 <> t1, true)"
        ),
        "others_have_one_line": (
            "exception_type NOT IN ('missing_payout', 'duplicate_transaction') AND n <> 1"
        ),
        "timing_lag_has_refund": (
            "exception_type = 'timing_lag_refund' AND refund_amount IS NULL"
        ),
        "timing_lag_not_netted": (
            "exception_type = 'timing_lag_refund' AND coalesce(adj <> 0, true)"
        ),
        "mismatch_fee_is_off": (
            "exception_type = 'mdr_rate_mismatch' AND coalesce(gap <= 0.01, true)"
        ),
        "clean_fee_fits": "exception_type = 'clean_match' AND coalesce(gap >= 0.01, true)",
        "clean_refund_fits": (
            "exception_type = 'clean_match' "
            "AND coalesce(abs(adj - coalesce(refund_amount, 0)) >= 0.01, true)"
        ),
    },
)

_CHECK_COUNTS = " UNION ALL ".join(
    [
        "SELECT * FROM "
        + _checks(
            """(SELECT coalesce(o.order_id, t.order_id) AS id, coalesce(o.n, 0) AS o,
                       coalesce(t.n, 0) AS t
                FROM (SELECT order_id, count(*) AS n FROM ledger GROUP BY order_id) o
                FULL JOIN (SELECT order_id, count(*) AS n FROM truth GROUP BY order_id) t
                  ON o.order_id = t.order_id)""",
            {
                "order_id_unique": "o > 1",
                "one_truth_per_order": "o > 0 AND t <> 1",
                "truth_has_order": "o = 0",
            },
        ),
        "SELECT * FROM "
        + _filled("ledger", ("order_id", "order_amount", "order_date", "expected_mdr_rate")),
        "SELECT * FROM "
        + _filled("lines", ("transaction_id", "order_id", "mdr_fee", "gst_on_mdr", "net_amount")),
        "SELECT * FROM " + _filled("truth", ("order_id", "exception_type")),
    ]
)

_CHECK_GOVERNANCE = (
    "SELECT * FROM "
    + _checks(
        "audit",
        {
            "action_taken_none": "action_taken <> 'none'",
            "no_autonomous_action": "autonomous_action_taken",
            "flagged_needs_review": f"engine_category <> 'clean_match' AND NOT ({_HELD})",
            "invoked_has_prompt_version": (
                "agent_invoked AND coalesce(agent_prompt_version, '') = ''"
            ),
            "invoked_has_fingerprint": (
                "agent_invoked AND coalesce(agent_case_fingerprint, '') = ''"
            ),
            "known_tier": f"engine_match_tier NOT IN {fv.TIERS}",
            "known_category": f"engine_category NOT IN {fv.CATEGORIES}",
            "known_selection": f"agent_selection_reason NOT IN {fv.SELECTION_REASONS}",
            "known_agreement": f"engine_agent_agreement NOT IN {fv.AGREEMENTS}",
            "known_status": f"review_status NOT IN {fv.REVIEW_STATUSES}",
        },
    )
    + " UNION ALL SELECT 'one_record_per_order', (SELECT count(*) FROM audit) = "
    "(SELECT count(*) FROM result), abs((SELECT count(*) FROM audit) - "
    "(SELECT count(*) FROM result))"
)

_STRICT_BATCHES = """
SELECT coalesce(b.settlement_batch_id, n.settlement_batch_id) AS settlement_batch_id,
       b.credit AS bank_credit_amount, n.computed_batch_net,
       CAST(b.credit - n.computed_batch_net AS DECIMAL(18,2)) AS batch_diff,
       CASE WHEN n.computed_batch_net IS NULL THEN 'unmatched_bank'
            WHEN b.credit IS NULL THEN 'unmatched_lines'
            WHEN abs(b.credit - n.computed_batch_net) <= 0.01 THEN 'balanced'
            ELSE 'unbalanced' END AS status
FROM (SELECT settlement_batch_id, CAST(sum(bank_credit_amount) AS DECIMAL(18,2)) AS credit
      FROM bank_feed GROUP BY settlement_batch_id) b
FULL JOIN batch_net n ON n.settlement_batch_id = b.settlement_batch_id"""

_FIRST_PER_LABEL = """
SELECT order_id, exception_type, expected_reasoning
FROM (SELECT *, row_number() OVER (PARTITION BY exception_type ORDER BY order_id) AS rn FROM truth)
WHERE rn <= """

_SELECTED = (
    "SELECT order_id, selection_reason FROM marked WHERE selection_reason <> 'not_selected'"
)

_BODIES = {
    # sources
    "scan_table": "SELECT * FROM orders",
    "scan_csv_typed": "SELECT * FROM ledger",
    "scan_csv_strings": (
        "SELECT CAST(order_id AS VARCHAR) AS order_id, customer_id, "
        "CAST(order_amount AS VARCHAR) AS order_amount, CAST(order_date AS VARCHAR) AS order_date, "
        "CAST(refund_amount AS VARCHAR) AS refund_amount, "
        "CAST(refund_date AS VARCHAR) AS refund_date, "
        "CAST(expected_mdr_rate AS VARCHAR) AS expected_mdr_rate FROM ledger"
    ),
    "scan_audit_jsonl": "SELECT * FROM audit",
    "scan_run_summaries": _SUMMARY,
    "query_audit_sql": "SELECT * FROM audit",
    # sinks, read back
    "sink_table": "SELECT * FROM result",
    "sink_audit_table": "SELECT * FROM audit",
    "published_runs": _RUNS,
    "published_catalog_runs": _RUNS,
    "sink_audit_jsonl": "SELECT * FROM audit",
    "sink_audit_csv": f"SELECT {_AUDIT_CSV} FROM audit",
    "sink_table_csv": "SELECT * FROM lines",
    "bank_feed_csv": "SELECT * FROM bank_feed",
    "truth_csv": "SELECT * FROM truth",
    "sink_run_summary": _SUMMARY,
    "sink_grading": _GRADING,
    "export_slice_csv": f"SELECT {_SLICE} FROM audit WHERE {SLICE_FILTER}",
    # projections, filters, predicates
    "expected_settlement": "SELECT * FROM expected",
    "breaks_tolerance": (
        "SELECT order_id, abs(mdr_fee - expected_mdr_fee) > 0.01 AS fee_breaks, "
        "abs(refund_adjustment - expected_refund_adjustment) > 0.01 AS refund_breaks, "
        "abs(net_amount - expected_net_amount) > 100.00 AS net_breaks_wide FROM joined"
    ),
    "identity_check": (
        "SELECT order_id, mdr_fee, gst_on_charged_fee, net_amount, identity_net_amount "
        "FROM identity"
    ),
    "classify_orders": "SELECT order_id, settlement_row_count, category FROM classified",
    "classify_orders_strict": (
        "SELECT order_id, CASE WHEN settlement_row_count = 1 AND category IN ('clean_match', "
        "'unexplained_value_break') AND (no_fee OR no_net) THEN 'unexplained_value_break' "
        f"ELSE category END AS category {_GAPS}"
    ),
    "classify_orders_gaps": f"SELECT order_id, category {_GAPS}",
    "match_tier": "SELECT order_id, category, match_tier FROM result",
    "engine_reasoning": "SELECT order_id, category, reasoning FROM result",
    "reconciliation_result": "SELECT * FROM result",
    "flag_split": (
        "SELECT order_id, category, category <> 'clean_match' AS is_flagged FROM result"
    ),
    "exceptions_only": "SELECT * FROM truth WHERE exception_type <> 'clean_match'",
    "review_queue": f"SELECT {_QUEUE} FROM audit WHERE {_HELD} ORDER BY engine_category, order_id",
    "audit_slice": f"SELECT {_SLICE} FROM audit WHERE {SLICE_FILTER}",
    "coerce_types": (
        "SELECT order_id, TRY_CAST(CASE WHEN order_id % 10 = 3 THEN 'n/a' "
        "ELSE CAST(order_amount AS VARCHAR) END AS DECIMAL(18,2)) AS evidence_order_amount, "
        "coalesce(lower(CASE order_id % 5 WHEN 0 THEN 'True' WHEN 1 THEN '1' WHEN 2 THEN 'no' "
        "WHEN 3 THEN NULL ELSE 'FALSE' END) IN ('true', '1'), false) AS agent_invoked FROM ledger"
    ),
    "stringify": (
        "SELECT CAST(order_id AS VARCHAR) AS order_id, customer_id, "
        "CAST(order_amount AS VARCHAR) AS order_amount, CAST(order_date AS VARCHAR) AS order_date, "
        "coalesce(CAST(refund_amount AS VARCHAR), '') AS refund_amount, "
        "coalesce(CAST(refund_date AS VARCHAR), '') AS refund_date, "
        "CAST(expected_mdr_rate AS VARCHAR) AS expected_mdr_rate FROM ledger"
    ),
    "drop_internal": "SELECT * FROM ledger",
    "flatten_audit": "SELECT * FROM audit",
    "evidence_struct": (
        "SELECT order_id, order_amount, expected_mdr_fee, actual_mdr_fee, "
        "expected_refund_adjustment, actual_refund_adjustment, expected_net_amount, "
        "actual_net_amount, settlement_row_count, transaction_id, settlement_batch_id FROM result"
    ),
    "governance_columns": (
        "SELECT order_id, schema_version, action_taken, autonomous_action_taken, action_policy, "
        "action_note FROM audit"
    ),
    "explode_evidence": _EVIDENCE_ROWS,
    "batch_balanced": "SELECT settlement_batch_id, batch_diff, batch_balanced FROM checked",
    # joins
    "join_expected_lines": "SELECT * FROM joined",
    "orphan_lines": (
        "SELECT l.* FROM lines l WHERE NOT EXISTS "
        "(SELECT 1 FROM ledger o WHERE o.order_id = l.order_id)"
    ),
    "join_bank_batches": "SELECT * FROM checked",
    "batch_check_strict": _STRICT_BATCHES,
    "join_truth": f"SELECT * FROM {_GRADED}",
    "assemble_cases": (
        "SELECT h.*, CAST(coalesce(l.n_listed, 0) AS INTEGER) AS n_listed, "
        f"coalesce(l.listed, '') AS listed FROM headers h LEFT JOIN {_LISTED} l "
        "ON l.order_id = h.order_id"
    ),
    "audit_assembly": "SELECT * FROM audit",
    "repeated_orders_audit": (
        "SELECT order_id, engine_category, agent_selection_reason, agent_invoked, agent_cause, "
        "agent_case_fingerprint FROM (SELECT *, unnest(range(CASE WHEN order_id % 400 = 3 THEN 3 "
        "WHEN order_id % 40 = 3 THEN 2 ELSE 1 END)) FROM audit)"
    ),
    "truth_lookup": (
        "SELECT order_id, engine_category, agent_cause, ground_truth FROM " + _LOOKED_UP
    ),
    "batch_orders_lines": (
        "SELECT printf('BATCH-%06d', o.bno) AS settlement_batch_id, o.n_orders, o.order_total, "
        "l.n_lines, l.net_total FROM (SELECT bno, count(*) AS n_orders, "
        "CAST(sum(order_amount) AS DECIMAL(18,2)) AS order_total FROM ledger_x GROUP BY bno) o "
        "FULL JOIN (SELECT bno, count(*) AS n_lines, CAST(sum(net_amount) AS DECIMAL(18,2)) "
        "AS net_total FROM lines_x GROUP BY bno) l ON l.bno = o.bno"
    ),
    # aggregations
    "lines_per_order": (
        "SELECT order_id, n AS settlement_row_count, transaction_id, mdr_fee, gst_on_mdr, "
        "refund_adjustment, net_amount, utr_number, settlement_batch_id FROM ranked_lines "
        "WHERE rn = 1"
    ),
    "batch_net": "SELECT * FROM batch_net",
    "batch_check_rollup": (
        "SELECT count(*) AS total_batches, "
        "count(*) - count(*) FILTER (NOT batch_balanced) AS balanced_batches, "
        "count(*) FILTER (NOT batch_balanced) AS unbalanced_batches FROM checked"
    ),
    "unbalanced_batches": "SELECT * FROM checked WHERE NOT batch_balanced",
    "tier_counts": "SELECT match_tier, count(*) AS n FROM result GROUP BY match_tier",
    "category_counts": "SELECT category, count(*) AS n FROM result GROUP BY category",
    "outcome_counts": (
        "SELECT 'tier' AS level, match_tier AS code, count(*) AS n FROM result GROUP BY ALL "
        "UNION ALL SELECT 'category', category, count(*) FROM result GROUP BY ALL "
        "UNION ALL SELECT 'all', 'all', count(*) FROM result"
    ),
    "match_rates": (
        "SELECT count(*) AS total_orders, count(*) FILTER (match_tier = 'exact') / count(*) "
        "AS exact_rate, count(*) FILTER (match_tier IN ('exact', 'fuzzy')) / count(*) "
        "AS auto_resolved_rate FROM result"
    ),
    "confusion_matrix": (
        "SELECT true_category AS true_label, category AS predicted_label, count(*) AS n "
        f"FROM {_GRADED} GROUP BY ALL ORDER BY ALL"
    ),
    "engine_accuracy": (
        "SELECT count(*) AS engine_graded_orders, count(*) FILTER (category = true_category) "
        "AS engine_correct, count(*) FILTER (category = true_category) / count(*) "
        f"AS engine_accuracy FROM {_GRADED}"
    ),
    "engine_mismatches": (
        "SELECT order_id, 'missing_payout' AS category, true_category, reasoning FROM "
        f"{_GRADED} WHERE order_id % 211 = 3 AND true_category <> 'missing_payout'"
    ),
    "agent_accuracy": (
        "SELECT count(*) AS agent_graded_orders, count(*) FILTER (agent_cause = ground_truth) "
        "AS agent_correct, count(*) FILTER (agent_cause = ground_truth) / count(*) "
        f"AS agent_accuracy FROM {_ASSESSED}"
    ),
    "agent_confusion": (
        "SELECT ground_truth AS true_label, agent_cause AS predicted_label, count(*) AS n "
        f"FROM {_ASSESSED} GROUP BY ALL ORDER BY ALL"
    ),
    "agent_misses": (
        "SELECT order_id, ground_truth, engine_category, agent_cause, agent_confidence, "
        f"agent_explanation FROM {_ASSESSED} WHERE agent_cause <> ground_truth"
    ),
    "run_summary": _SUMMARY,
    "grading_report": _GRADING,
    "agreement_on_flagged": (
        "SELECT engine_agent_agreement, count(*) AS n FROM audit "
        "WHERE agent_selection_reason = 'flagged_by_engine' GROUP BY 1"
    ),
    "mean_confidence": (
        "SELECT round(CAST(sum(CAST(agent_confidence AS DECIMAL(18,9))) AS DOUBLE) "
        "/ count(agent_confidence), 3) AS mean_agent_confidence FROM audit"
    ),
    "kpi_tiles": _KPI,
    "value_split": (
        "SELECT part, value, CAST(value AS DOUBLE) / CAST(whole AS DOUBLE) * 100 AS share_pct FROM "
        "(SELECT 'Cleared' AS part, CAST(sum(evidence_order_amount) FILTER (NOT "
        f"({_HELD})) AS DECIMAL(18,2)) AS value, sum(evidence_order_amount) AS whole FROM audit "
        "UNION ALL SELECT 'Held for review', CAST(sum(evidence_order_amount) FILTER "
        f"({_HELD}) AS DECIMAL(18,2)), sum(evidence_order_amount) FROM audit)"
    ),
    "exceptions_by_category": (
        "SELECT engine_category, count(*) AS n_orders, CAST(sum(evidence_order_amount) "
        f"AS DECIMAL(18,2)) AS value, {_label('engine_category')} AS label FROM audit "
        "WHERE engine_category <> 'clean_match' GROUP BY engine_category"
    ),
    "facets": (
        "SELECT DISTINCT 'engine_category' AS facet, engine_category AS value FROM audit "
        "UNION ALL SELECT DISTINCT 'engine_match_tier', engine_match_tier FROM audit "
        "UNION ALL SELECT DISTINCT 'review_status', review_status FROM audit "
        "UNION ALL SELECT 'max_amount', CAST(max(evidence_order_amount) AS VARCHAR) FROM audit"
    ),
    "provenance": (
        "SELECT min(run_id) AS run_id, min(run_started_at) AS run_started_at, "
        "coalesce(min(agent_model), 'n/a') AS agent_model, "
        "coalesce(min(agent_prompt_version), 'n/a') AS agent_prompt_version FROM audit"
    ),
    "label_counts": "SELECT exception_type, count(*) AS n FROM truth GROUP BY exception_type",
    "bank_netting": (
        "SELECT printf('BATCH-%06d', bno) AS settlement_batch_id, net AS net_total, credit_date, "
        "utr AS utr_number FROM per_batch"
    ),
    "latency_total": (
        "SELECT CAST(coalesce(sum(agent_latency_ms), 0) AS BIGINT) AS agent_total_latency_ms "
        "FROM audit"
    ),
    # sorts, top-n, sampling
    "result_preview": (
        "SELECT * FROM result ORDER BY match_tier <> 'exact', category, order_id LIMIT 20"
    ),
    "audit_order": (
        "SELECT order_id, engine_match_tier FROM audit ORDER BY CASE engine_match_tier "
        "WHEN 'no_match' THEN 0 WHEN 'fuzzy' THEN 1 ELSE 2 END, order_id"
    ),
    "queue_by_value": (
        f"SELECT order_id, engine_category, evidence_order_amount FROM audit WHERE {_HELD} "
        "ORDER BY evidence_order_amount DESC, order_id"
    ),
    "cap_flagged": (
        "SELECT order_id, category FROM result WHERE category <> 'clean_match' "
        "ORDER BY order_id LIMIT 50"
    ),
    "cap_flagged_text_ids": (
        "SELECT printf('ORD-%012d', order_id) AS order_id, category FROM result "
        "WHERE category <> 'clean_match' ORDER BY order_id LIMIT 700"
    ),
    "cap_flagged_sparse_ids": (
        "SELECT CAST(CAST(order_id AS HUGEINT) * 1000003 * 1000003 AS DECIMAL(38,0)) AS order_id, category "
        "FROM result WHERE category <> 'clean_match' ORDER BY order_id LIMIT 700"
    ),
    "control_sample": "SELECT order_id FROM controls",
    "control_sample_large": (
        "SELECT order_id FROM result WHERE category = 'clean_match' "
        "ORDER BY sha256(order_id || '|42'), order_id LIMIT 12000"
    ),
    "samples_per_label": _FIRST_PER_LABEL + "2",
    "one_per_category": _FIRST_PER_LABEL + "1",
    # set operations
    "selection_union": _SELECTED,
    "duplicate_append": (
        "SELECT * EXCLUDE (label, bno) FROM own_lines UNION ALL "
        "SELECT * EXCLUDE (label, bno) FROM own_lines WHERE label = 'duplicate_transaction'"
    ),
    "distinct_batches": "SELECT DISTINCT settlement_batch_id FROM lines ORDER BY 1",
    # scalar functions
    "money_math": (
        "SELECT order_id, CAST(order_amount + coalesce(refund_amount, 0) AS DECIMAL(18,2)) "
        "AS added, CAST(order_amount - coalesce(refund_amount, 0) AS DECIMAL(18,2)) AS taken, "
        "CAST(order_amount * expected_mdr_rate AS DECIMAL(18,2)) AS fee, "
        "CAST(abs(coalesce(refund_amount, 0) - order_amount) AS DECIMAL(18,2)) AS gap FROM ledger"
    ),
    "cites_figures": (
        "SELECT order_id, attempt, coalesce(regexp_matches(regexp_replace(explanation, "
        "'[0-9a-f]{8}-[0-9a-f-]{27}', '', 'g'), '[0-9]'), false) AS cites FROM parsed"
    ),
    "normalize_confidence": (
        "SELECT order_id, greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN c > 1 THEN c / 100 "
        "ELSE c END)) AS confidence FROM (SELECT order_id, "
        "CAST(order_id % 301 - 50 AS DOUBLE) / 2 AS c FROM ledger)"
    ),
    "case_fingerprint": "SELECT order_id, case_fingerprint FROM headers",
    "id_sequence_digest": _DIGESTS,
    "run_id_digest": (
        "SELECT sha256(count(*) || ':' || sum(CAST(('0x' || substr(h, 1, 15))::BIGINT AS HUGEINT)) "
        "|| ':' || sum(CAST(('0x' || substr(h, 16, 15))::BIGINT AS HUGEINT))) AS run_digest "
        "FROM (SELECT sha256(CAST(settlement_batch_id AS VARCHAR) || '|' || id_digest) AS h "
        f"FROM ({_DIGESTS}))"
    ),
    "extract_content": "SELECT order_id, attempt, message FROM messages",
    "render_case": _RENDER,
    "inr_format": (
        "SELECT order_id, "
        + _inr("v", "CAST(abs(v) AS VARCHAR)", "'.' || split_part(CAST(abs(v) AS VARCHAR), '.', 2)")
        + " AS amount_text, "
        + _inr("v", "CAST(round_even(abs(v), 0) AS VARCHAR)", "''")
        + " AS whole_text FROM (SELECT order_id, CAST(refund_amount * CASE WHEN order_id % 3 = 0 "
        "THEN -1 ELSE order_id END AS DECIMAL(18,2)) AS v FROM ledger)"
    ),
    "inr_compact": (
        "SELECT order_id, "
        + _compact("v")
        + " AS amount_text FROM (SELECT order_id, CAST(refund_amount * CASE WHEN order_id % 3 = 0 "
        "THEN -1 ELSE order_id END AS DECIMAL(18,2)) AS v FROM ledger)"
    ),
    "category_label": f"SELECT order_id, category, {_label('category')} AS label FROM result",
    "batch_codes": (
        "SELECT k AS order_id, printf('BATCH-%06d', bno) AS batch_code, "
        "printf('UTR%06d', bno) AS utr_code, printf('CUST-%06d', c) AS customer_code FROM keyed"
    ),
    "date_lag": (
        "SELECT order_id, order_date, order_date + 2 AS plus_two, "
        "order_date + CAST(1 + order_id % 3 AS INTEGER) AS plus_key FROM ledger"
    ),
    "short_id": "SELECT order_id, left(transaction_id, 8) AS short_id FROM lines",
    "truth_reasoning": "SELECT order_id, expected_reasoning FROM truth",
    # derived tables
    "derive_ledger": "SELECT * FROM ledger",
    "assign_labels": "SELECT order_id, label FROM ledger_x",
    "force_refund": (
        "SELECT order_id, refund_amount, refund_date FROM ledger_x WHERE label = 'timing_lag_refund'"
    ),
    "derive_lines": "SELECT * FROM lines",
    "derive_bank_feed": "SELECT * FROM bank_feed",
    "derive_truth": "SELECT * FROM truth",
    # checks
    "check_counts": _CHECK_COUNTS,
    "check_repeated_counts": (
        "SELECT check_name, CASE WHEN check_name = 'order_id_unique' THEN false ELSE passed END "
        "AS passed, CASE WHEN check_name = 'order_id_unique' THEN (SELECT count(*) FROM ledger "
        f"WHERE order_id % 40 = 3) ELSE n_bad END AS n_bad FROM ({_CHECK_COUNTS})"
    ),
    "check_requested_labels": (
        "SELECT label || '_as_requested' AS check_name, abs(found - asked) <= 0.002 * orders AS "
        "passed, CAST(abs(found - asked) AS BIGINT) AS n_bad FROM (SELECT s.label, (SELECT count(*) "
        "FROM truth WHERE exception_type = s.label) AS found, (SELECT count(*) FROM truth) AS "
        "orders, (SELECT count(*) FROM truth) * s.share // 1000 AS asked FROM (VALUES "
        "('clean_match', 900), ('timing_lag_refund', 40), ('mdr_rate_mismatch', 25), "
        "('duplicate_transaction', 15), ('missing_payout', 15), ('unexplained_value_break', 5)) "
        "AS s(label, share))"
    ),
    "check_label_shares": (
        "SELECT 'clean_share' AS check_name, bad = 0 AS passed, bad AS n_bad FROM "
        "(SELECT CAST(count(*) FILTER (exception_type = 'clean_match') < 0.9 * count(*) AS BIGINT) "
        "AS bad FROM truth)"
    ),
    "check_labels": f"SELECT * FROM {_CHECK_LABELS}",
    "check_bank_sum": (
        "SELECT settlement_batch_id, bank_credit_amount, computed_batch_net, batch_diff "
        "FROM checked WHERE coalesce(abs(batch_diff) >= 0.01, true)"
    ),
    "check_governance": _CHECK_GOVERNANCE,
    "check_graded_all": (
        "SELECT 'all_orders_graded' AS check_name, o = g AS passed, abs(o - g) AS n_bad FROM "
        f"(SELECT (SELECT count(*) FROM result) AS o, (SELECT count(*) FROM {_GRADED}) AS g) "
        "UNION ALL SELECT 'all_categories_right', count(*) = 0, count(*) FROM "
        f"{_GRADED} WHERE category <> true_category"
    ),
    # checks beyond the verdict
    "check_gross_amounts": _GROSS,
    "check_line_references": (
        "SELECT order_id, transaction_id, settlement_batch_id, "
        "CASE WHEN order_id % 80 = 6 THEN 'UTR-ELSE' ELSE utr_number END AS utr_number FROM lines "
        "WHERE order_id % 80 = 6 AND settlement_batch_id IN (SELECT settlement_batch_id FROM bank_feed)"
    ),
    "check_refund_dates": (
        "SELECT *, CASE WHEN refund_date < order_date THEN 'before_order' WHEN refund_date IS NULL THEN 'no_date' "
        "ELSE 'no_amount' END AS problem FROM (SELECT order_id, order_date, "
        "CASE WHEN order_id % 60 <> 9 THEN refund_amount END AS refund_amount, "
        "CASE WHEN order_id % 60 = 7 THEN order_date - 3 WHEN order_id % 60 <> 8 THEN refund_date END AS refund_date "
        "FROM ledger) WHERE coalesce(refund_date < order_date, false) OR (refund_date IS NULL) <> (refund_amount IS NULL)"
    ),
    "check_settlement_lags": _LAGS,
    "check_strict": (
        "SELECT 'gross_is_order_amount' AS check_name, true AS passed, CAST(0 AS BIGINT) AS n_bad "
        "UNION ALL SELECT 'reference_was_credited', true, 0 "
        "UNION ALL SELECT 'refund_dates_fit', true, 0 UNION ALL SELECT 'settled_in_time', count(*) = 0, count(*) "
        f"FROM ({_LAGS}) WHERE status <> 'on_time'"
    ),
    "id_sequence_tree": _TREE,
    "id_sequence_differences": (
        "SELECT place // 64 * 64 AS first_place, place // 64 * 64 + 63 AS last_place, count(*) AS n_one, "
        "count(*) - count(*) FILTER (place = 900) AS n_two FROM (SELECT order_id AS place FROM ledger) "
        "GROUP BY 1, 2 HAVING count(*) FILTER (place IN (130, 700, 900)) > 0"
    ),
    "run_digest_as_pinned": (
        "SELECT 'id_digest_as_pinned' AS check_name, true AS passed, CAST(0 AS BIGINT) AS n_bad "
        "FROM (SELECT count(*) AS n FROM ledger) UNION ALL SELECT 'changed_ids_are_noticed', count(*) = 0, count(*) "
        "FROM ledger WHERE order_id = 7"
    ),
    # second opinions
    "parse_diagnosis": "SELECT * FROM parsed",
    "resolve_attempts": "SELECT * FROM resolved",
    "select_for_diagnosis": _SELECTED,
    "agreement": "SELECT order_id, engine_agent_agreement FROM audit",
    "skip_reason": (
        "SELECT order_id, CASE WHEN category = 'clean_match' THEN CASE WHEN c.order_id IS NULL "
        "THEN " + _q(fv.SKIP_CLEAN) + " ELSE " + _q(fv.SKIP_NOT_REACHED) + " END "
        "ELSE " + _q(fv.SKIP_NOT_REACHED) + " END AS agent_skip_reason "
        "FROM (SELECT r.order_id, r.category FROM result r) LEFT JOIN controls c USING (order_id) "
        "WHERE NOT (order_id IN (SELECT order_id FROM controls) OR order_id IN (SELECT order_id "
        "FROM result WHERE category <> 'clean_match' ORDER BY order_id LIMIT 50))"
    ),
    "decide_review": "SELECT order_id, review_status, review_reason FROM audit",
    "diagnosis_outcome": (
        "SELECT CASE WHEN d.diagnosed THEN 'ok' WHEN d.order_id IS NOT NULL THEN 'failed' "
        f"ELSE 'not_reached' END AS outcome, count(*) AS n FROM ({_SELECTED}) s "
        "LEFT JOIN resolved d ON d.order_id = s.order_id GROUP BY 1"
    ),
}

ORACLES = {name: _with(body) for name, body in _BODIES.items()}
