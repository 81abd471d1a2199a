"""The same answers in plain SQL, written for DuckDB against the supplied tables."""

from __future__ import annotations

import math
import re

# Decision texts and the metric dictionary, as the results must hold them.
PVALUE_ROLLOUT = (
    'Recommend staged rollout of treatment onboarding (10% -> 50% -> 100%) with guardrail monitoring.'
)
PVALUE_MITIGATE = (
    'Do not fully roll out yet; primary improved but guardrail risks require mitigation and follow-up test.'
)
PVALUE_STOP = 'Do not roll out treatment yet; primary metric did not meet decision threshold.'
TOLERANCE_ROLLOUT = [
    'Proceed with staged rollout',
    'The treatment improved 7-day activation and guardrail shifts remained within acceptable operating thresholds.',
    'Roll out 10% -> 50% -> 100% with daily monitoring and rollback triggers.',
]
TOLERANCE_HOLD = [
    'Hold full rollout and mitigate risk',
    'Activation improved, but at least one guardrail exceeded tolerance.',
    'Address guardrail risk drivers, then rerun a targeted validation test.',
]
TOLERANCE_STOP = [
    'Do not roll out treatment yet',
    'Primary activation outcome did not improve versus control.',
    'Iterate onboarding design and retest.',
]
DICTIONARY = [
    (
        'activated_within_7d',
        '7-Day Activation Rate',
        'Primary Outcome',
        'Share of new users who complete onboarding and book their first session within 7 days.',
        'Captures early conversion from signup to meaningful product use.',
        'Higher',
    ),
    (
        'retained_d7',
        'Day-7 Retention',
        'Secondary Outcome',
        'Share of users who return to the app on or after day 7.',
        'Signals short-term habit formation after onboarding.',
        'Higher',
    ),
    (
        'retained_d30',
        'Day-30 Retention',
        'Secondary Outcome',
        'Share of users who return to the app on or after day 30.',
        'Reflects medium-term user stickiness.',
        'Higher',
    ),
    (
        'cancelled_30d',
        '30-Day Cancellation Rate',
        'Guardrail',
        'Share of users who cancel within 30 days of signup.',
        'Ensures growth is not coming from poor-fit or low-quality starts.',
        'Lower',
    ),
    (
        'time_to_first_match_hours',
        'Time to First Match (hours)',
        'Guardrail',
        'Average hours between signup and first therapist match.',
        'Long wait times can hurt trust and downstream retention.',
        'Lower',
    ),
    (
        'support_tickets_30d',
        'Support Tickets per User (30D)',
        'Guardrail',
        'Average number of support tickets per user in first 30 days.',
        'Tracks friction introduced by product changes.',
        'Lower',
    ),
    (
        'noncompliance_flag',
        'Noncompliance Rate',
        'Design Integrity',
        'Share of users whose assigned experience differs from what they actually saw.',
        'Higher noncompliance weakens confidence in treatment effect estimates.',
        'Lower',
    ),
]

# --- warehouse tables ---------------------------------------------------------------------------

_ARMS = """
    CASE WHEN {k} % 2 = 0 THEN 'control' ELSE 'treatment' END AS assigned_variant,
    CASE WHEN ({k} % 2 = 0) <> ({k} % 11 = 0) THEN 'control' ELSE 'treatment' END AS actually_exposed_variant
"""
_TRAITS = """
    ['ios','ios','android','android','web'][{k} % 5 + 1] AS device,
    ['18-24','25-34','35-44','45+'][({k} // 2) % 4 + 1] AS age_bucket
"""


def product(hourly: bool = False) -> str:
    time = "date_trunc('hour', ts)" if hourly else "ts"
    event = f"""
        user_id, {time} AS event_ts,
        CASE WHEN event_id % 97 <> 0
             THEN user_id * 1000 + date_diff('day', DATE '2024-01-01', ts::DATE) END AS session_id,
        CASE WHEN event_id % 50 = 0 THEN 'null' ELSE props END AS properties_json
    """
    return f"""
    dim_users AS (
        SELECT user_id, min(ts) AS signup_ts,
            ['US','CA','GB','IN','AU'][(user_id // 2) % 5 + 1] AS country,
            ['organic','paid','referral'][user_id % 3 + 1] AS acquisition_channel,
            {_TRAITS.format(k="user_id")},
            count(*) FILTER (event_type = 'signup')::DOUBLE AS baseline_score,
            count(*) FILTER (event_type = 'signup' AND value < 50) AS pre_treatment_sessions_30d,
            {_ARMS.format(k="user_id")},
            min(ts) AS created_at
        FROM events GROUP BY user_id
    ),
    fact_events AS (
        SELECT 'evt_' || event_id || '_0' AS event_id,
            CASE event_type WHEN 'view' THEN 'app_open' WHEN 'click' THEN 'onboarding_completed'
                            WHEN 'purchase' THEN 'session_booked' ELSE event_type END AS event_name, {event}
        FROM events
        UNION ALL
        SELECT 'evt_' || event_id || '_1', 'onboarding_started', {event}
        FROM events WHERE event_type = 'view'
    ),
    fact_sessions AS (
        SELECT session_id, e.user_id, min(event_ts) AS session_start_ts, max(event_ts) AS session_end_ts,
            any_value(u.device) AS device
        FROM fact_events e JOIN dim_users u ON u.user_id = e.user_id
        WHERE session_id IS NOT NULL GROUP BY session_id, e.user_id
    ),
    fact_subscriptions AS (
        SELECT user_id, min(ts) AS subscribed_ts,
            CASE WHEN count(*) >= 12 THEN 'annual' ELSE 'monthly' END AS plan_type,
            min(value)::DECIMAL(10, 2) AS price_monthly
        FROM events WHERE event_type = 'purchase' GROUP BY user_id
    ),
    fact_cancellations AS (
        SELECT user_id, min(ts) AS cancelled_ts, 'price' AS reason
        FROM events WHERE event_type = 'error' AND value >= 100 GROUP BY user_id
    ),
    fact_support_tickets AS (
        SELECT event_id AS ticket_id, user_id, ts AS created_ts,
            CASE WHEN value >= 50 THEN 'billing' ELSE 'technical' END AS category
        FROM events WHERE event_type = 'error'
    ),
    fact_matches AS (
        SELECT user_id, min(ts) AS matched_ts, user_id % 50 AS therapist_id
        FROM events WHERE event_type = 'click' GROUP BY user_id
    )"""


COMMERCE_TABLES = f"""
    signups AS (SELECT o_custkey AS user_id, min(o_orderdate) AS signup_ts FROM orders GROUP BY 1),
    dim_users AS (
        SELECT s.user_id, s.signup_ts, n_name AS country, c_mktsegment AS acquisition_channel,
            {_TRAITS.format(k="s.user_id")},
            round(c_acctbal * 100) AS baseline_score,
            (SELECT count(*) FROM orders WHERE o_custkey = s.user_id
                AND o_orderdate < s.signup_ts + INTERVAL 365 DAY) AS pre_treatment_sessions_30d,
            {_ARMS.format(k="s.user_id")},
            s.signup_ts AS created_at
        FROM signups s JOIN customer ON c_custkey = s.user_id JOIN nation ON n_nationkey = c_nationkey
    ),
    fact_events AS (
        SELECT 'ord_' || o_orderkey AS event_id, o_custkey AS user_id, o_orderdate AS event_ts,
            CASE o_orderstatus WHEN 'P' THEN 'onboarding_completed' WHEN 'F' THEN 'session_booked'
                               WHEN 'O' THEN 'app_open' ELSE o_orderstatus END AS event_name,
            o_custkey * 10000 + year(o_orderdate) AS session_id, NULL::VARCHAR AS properties_json
        FROM orders
    ),
    fact_sessions AS (
        SELECT session_id, e.user_id, min(event_ts) AS session_start_ts, max(event_ts) AS session_end_ts,
            any_value(u.device) AS device
        FROM fact_events e JOIN dim_users u ON u.user_id = e.user_id GROUP BY session_id, e.user_id
    ),
    fact_subscriptions AS (
        SELECT o_custkey AS user_id, min(o_orderdate) AS subscribed_ts,
            CASE WHEN count(*) >= 10 THEN 'annual' ELSE 'monthly' END AS plan_type,
            min(o_totalprice)::DECIMAL(10, 2) AS price_monthly
        FROM orders GROUP BY 1
    ),
    fact_cancellations AS (
        SELECT o_custkey AS user_id, min(o_orderdate) AS cancelled_ts, 'price' AS reason
        FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1
    ),
    fact_support_tickets AS (
        SELECT o_orderkey AS ticket_id, o_custkey AS user_id, o_orderdate AS created_ts, 'order' AS category
        FROM orders WHERE o_orderpriority = '1-URGENT'
    ),
    fact_matches AS (
        SELECT o_custkey AS user_id, min(o_orderdate) AS matched_ts, o_custkey % 50 AS therapist_id
        FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1
    )"""


def user_metrics(activation: int, short: int, long: int, tickets: int, cancel: int) -> str:
    """All outcomes of a user, one correlated condition each, over the raw event log."""

    def happened(name: str) -> str:
        return f"EXISTS (SELECT 1 FROM fact_events e WHERE e.user_id = u.user_id AND event_name = '{name}'"

    def by(name: str) -> str:
        return f"{happened(name)} AND event_ts <= u.signup_ts + INTERVAL {activation} DAY)"

    def since(days: int) -> str:
        return f"{happened('app_open')} AND event_ts >= u.signup_ts + INTERVAL {days} DAY)"

    return f"""
    um AS (
        SELECT u.* EXCLUDE (created_at),
            ({happened("onboarding_started")}))::INTEGER AS onboarding_started,
            ({happened("onboarding_completed")}))::INTEGER AS onboarding_completed,
            ({happened("session_booked")}))::INTEGER AS session_booked,
            ({by("onboarding_completed")} AND {by("session_booked")})::INTEGER AS activated_within_7d,
            ({since(short)})::INTEGER AS retained_d7,
            ({since(long)})::INTEGER AS retained_d30,
            (EXISTS (SELECT 1 FROM fact_cancellations c WHERE c.user_id = u.user_id
                AND cancelled_ts < u.signup_ts + INTERVAL {cancel} DAY))::INTEGER AS cancelled_30d,
            (SELECT epoch_us(matched_ts - u.signup_ts) / 3.6e9 FROM fact_matches m
                WHERE m.user_id = u.user_id) AS time_to_first_match_hours,
            (SELECT count(*) FROM fact_support_tickets t WHERE t.user_id = u.user_id
                AND created_ts >= u.signup_ts
                AND created_ts < u.signup_ts + INTERVAL {tickets} DAY) AS support_tickets_30d
        FROM dim_users u
    )"""


PRODUCT = product()
PRODUCT_HOURLY = product(hourly=True)
PRODUCT_UM = f"{PRODUCT}, {user_metrics(2, 28, 29, 10, 10)}"
PRODUCT_HOURLY_UM = f"{PRODUCT_HOURLY}, {user_metrics(2, 28, 29, 10, 10)}"
COMMERCE_UM = f"{COMMERCE_TABLES}, {user_metrics(730, 1460, 1825, 365, 365)}"

METRICS = [
    "activated_within_7d",
    "retained_d7",
    "retained_d30",
    "cancelled_30d",
    "time_to_first_match_hours",
    "support_tickets_30d",
]


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name}"


_HOURS = _r("time_to_first_match_hours", "time_to_first_match_hours")
_WHO = """user_id, signup_ts, country, device, acquisition_channel, age_bucket, baseline_score,
    pre_treatment_sessions_30d, assigned_variant, actually_exposed_variant"""
_OUTCOMES = f"activated_within_7d, retained_d7, retained_d30, cancelled_30d, {_HOURS}, support_tickets_30d"
_STEPS = "onboarding_started, onboarding_completed, session_booked"
_AVERAGES = f"""
    avg(activated_within_7d) AS activation_rate_7d, avg(retained_d7) AS retention_rate_d7,
    avg(retained_d30) AS retention_rate_d30, avg(cancelled_30d) AS cancellation_rate_30d,
    {_r("avg(time_to_first_match_hours)", "avg_time_to_first_match_hours")},
    avg(support_tickets_30d) AS support_tickets_per_user_30d"""
_DASHBOARD_AVERAGES = f"""
    avg(activated_within_7d) AS activation_rate_7d, avg(retained_d7) AS retention_rate_d7,
    avg(retained_d30) AS retention_rate_d30, avg(cancelled_30d) AS cancellation_rate_30d,
    avg(time_to_first_match_hours) AS avg_match_latency_hours,
    avg(support_tickets_30d) AS support_tickets_per_user,
    avg((assigned_variant <> actually_exposed_variant)::INTEGER) AS noncompliance_rate"""
_DASHBOARD_SUMMARY = f"""
    summary AS (SELECT assigned_variant, count(*) AS users, {_DASHBOARD_AVERAGES} FROM um GROUP BY 1)"""
_DIMENSIONS = ["acquisition_channel", "device", "age_bucket", "country"]


def _with(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes} {select}"


def _segments(measures: str, dimensions=tuple(_DIMENSIONS)) -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS segment_dimension, {d} AS segment_value, assigned_variant, {measures}"
        f" FROM um GROUP BY {d}, assigned_variant"
        for d in dimensions
    )


def _funnel(source: str, order: bool) -> str:
    steps = ["signup", "onboarding_started", "onboarding_completed", "session_booked", "activated_within_7d"]
    parts = []
    for i, step in enumerate(steps, start=1):
        users = "count(*)" if step == "signup" else f"sum({step})::BIGINT"
        position = f"{i} AS step_order, '{step}' AS step_name" if order else f"'{step}' AS step"
        parts.append(
            f"SELECT assigned_variant, {position}, {users} AS users, {users} / count(*) AS rate_from_signup"
            f" FROM {source} GROUP BY assigned_variant"
        )
    return " UNION ALL ".join(parts)


# --- data quality -------------------------------------------------------------------------------

# Required columns, keys, references of the warehouse tables.
_REQUIRED = {
    "dim_users": _WHO.replace("\n", " ").replace(" ", "").split(",") + ["created_at"],
    "fact_sessions": ["session_id", "user_id", "session_start_ts", "device"],
    "fact_events": ["event_id", "user_id", "event_ts", "event_name"],
    "fact_subscriptions": ["user_id", "subscribed_ts", "plan_type", "price_monthly"],
    "fact_cancellations": ["user_id", "cancelled_ts", "reason"],
    "fact_support_tickets": ["ticket_id", "user_id", "created_ts", "category"],
    "fact_matches": ["user_id", "matched_ts", "therapist_id"],
}
_KEYS = {
    "dim_users": "user_id",
    "fact_sessions": "session_id",
    "fact_events": "event_id",
    "fact_subscriptions": "user_id",
    "fact_cancellations": "user_id",
    "fact_support_tickets": "ticket_id",
    "fact_matches": "user_id",
}
_REFERENCES = {
    "fact_sessions": "dim_users",
    "fact_events": "dim_users",
    "fact_subscriptions": "dim_users",
    "fact_cancellations": "fact_subscriptions",
    "fact_support_tickets": "dim_users",
    "fact_matches": "dim_users",
}


def _nulls() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS violations FROM {t}"
        for t, columns in _REQUIRED.items()
        for c in columns
    )


def _key_violations() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{k}' AS key_column,
            (SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)) AS repeated_keys,
            (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM {t})) AS surplus_rows"""
        for t, k in _KEYS.items()
    )


def _reference_violations() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, 'user_id' AS column_name, '{parent}' AS references_table,
            count(DISTINCT user_id) AS unknown_keys, count(*) AS orphan_rows
        FROM {t} WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM {parent})"""
        for t, parent in _REFERENCES.items()
    )


_DOMAINS = """
    SELECT 'dim_users' AS table_name, 'acquisition_channel_domain' AS rule, count(*) AS violations
    FROM dim_users WHERE acquisition_channel NOT IN ('organic', 'paid', 'referral')
    UNION ALL SELECT 'dim_users', 'assigned_variant_domain', count(*)
    FROM dim_users WHERE assigned_variant NOT IN ('control', 'treatment')
    UNION ALL SELECT 'dim_users', 'actually_exposed_variant_domain', count(*)
    FROM dim_users WHERE actually_exposed_variant NOT IN ('control', 'treatment')
    UNION ALL SELECT 'fact_subscriptions', 'price_monthly_positive', count(*)
    FROM fact_subscriptions WHERE NOT price_monthly > 0"""

_GATE_COLUMNS = '"check", value::DOUBLE AS value, low::DOUBLE AS lower_bound, high::DOUBLE AS upper_bound, passed'
_VOLUME = """
    SELECT 'min_users' AS "check", count(*) AS value, 1000 AS low, NULL AS high, count(*) >= 1000 AS passed
    FROM dim_users
    UNION ALL
    SELECT 'min_events', (SELECT count(*) FROM fact_events), 4 * count(*), NULL,
        (SELECT count(*) FROM fact_events) >= 4 * count(*) FROM dim_users"""
_NULL_ARM = """
    SELECT 'null_assigned_variant' AS "check", count(*) AS value, NULL AS low, 0 AS high, count(*) = 0 AS passed
    FROM dim_users WHERE assigned_variant IS NULL"""
_ALLOCATION = """
    SELECT 'treatment_share' AS "check", avg((assigned_variant IS NOT DISTINCT FROM 'treatment')::INTEGER) AS value, 0.4 AS low,
        0.6 AS high, avg((assigned_variant IS NOT DISTINCT FROM 'treatment')::INTEGER) BETWEEN 0.4 AND 0.6 AS passed FROM dim_users"""
_ACTIVATION = """
    SELECT 'activation_rate' AS "check", avg(activated_within_7d) AS value, 0.05 AS low, 0.8 AS high,
        avg(activated_within_7d) BETWEEN 0.05 AND 0.8 AS passed FROM um"""


# Fixed rules: the faults of the spoiled tables, by user id.
_FAULTS = """
    dirty_dim_users AS (
        SELECT u.* REPLACE (
            CASE WHEN user_id % 13 <> 0 THEN device END AS device,
            CASE WHEN user_id % 17 <> 0 THEN assigned_variant END AS assigned_variant,
            CASE WHEN user_id % 19 = 0 THEN 'tv' ELSE acquisition_channel END AS acquisition_channel)
        FROM dim_users u, generate_series(1, 2) AS copies(k) WHERE user_id % 23 <> 0 AND (k = 1 OR user_id % 29 = 0)),
    dirty_fact_subscriptions AS (
        SELECT * REPLACE (CASE WHEN user_id % 31 = 0 THEN 0 ELSE price_monthly END AS price_monthly)
        FROM fact_subscriptions WHERE user_id % 7 <> 0),
    dirty_fact_cancellations AS (
        SELECT * FROM fact_cancellations UNION ALL SELECT * FROM fact_cancellations WHERE user_id % 5 = 0),
    dirty_fact_events AS (SELECT * FROM fact_events UNION ALL SELECT * FROM fact_events WHERE user_id % 41 = 0),
    dirty_fact_matches AS (
        SELECT * REPLACE (CASE WHEN user_id % 11 <> 0 THEN therapist_id END AS therapist_id) FROM fact_matches),
    dirty_fact_sessions AS (SELECT * FROM fact_sessions),
    dirty_fact_support_tickets AS (SELECT * FROM fact_support_tickets)"""


def _on_spoiled(select: str) -> str:
    """A check read from the spoiled tables; its quoted table names stay."""
    return _with(f"{COMMERCE_TABLES}, {_FAULTS}", re.sub(r"(?<!')\b(dim_users|fact_[a-z_]+)\b(?!')", r"dirty_\1", select))


def _batch_violations() -> str:
    """Broken rules of the odd users and their spoiled facts, where even users are stored sound."""
    nulls = " UNION ALL ".join(
        f"SELECT '{t} {c} is missing' AS rule, count(*) - count({c}) AS violations FROM batch_{t}"
        for t in ("dim_users", "fact_subscriptions", "fact_cancellations", "fact_matches")
        for c in _REQUIRED[t]
    )
    references = " UNION ALL ".join(
        f"""SELECT '{t} user_id is not in {parent}', count(*) FROM batch_{t}
        WHERE user_id NOT IN (SELECT user_id FROM batch_{parent} UNION ALL SELECT user_id FROM {parent} WHERE user_id % 2 = 0)"""
        for t, parent in (("fact_subscriptions", "dim_users"), ("fact_cancellations", "fact_subscriptions"), ("fact_matches", "dim_users"))
    )
    domains = re.sub(r"(?<!')\b(dim_users|fact_subscriptions)\b(?!')", r"batch_\1", _DOMAINS)
    batch = ", ".join(
        f"batch_{t} AS (SELECT DISTINCT ON (user_id) * FROM dirty_{t}{' WHERE user_id % 2 = 1' if odd else ''})"
        for t, odd in (("dim_users", True), ("fact_subscriptions", True), ("fact_cancellations", False), ("fact_matches", False))
    )
    return _with(
        f"{COMMERCE_TABLES}, {_FAULTS}, {batch}, domains AS ({domains})",
        f"""SELECT rule, violations FROM ({nulls} UNION ALL {references}
        UNION ALL SELECT table_name || ' ' || rule, violations FROM domains) WHERE violations > 0""",
    )


def _gates(*parts: str) -> str:
    return f"SELECT {_GATE_COLUMNS} FROM ({' UNION ALL '.join(f'({p})' for p in parts)})"


_DUPLICATES = """
    SELECT sum(n)::BIGINT AS events_raw, sum(n) FILTER (n > 1) / sum(n) AS duplicate_event_rate
    FROM (SELECT count(*) AS n FROM fact_events GROUP BY user_id, event_name, event_ts)"""
_QUALITY = f"""
    quality AS (
        SELECT 'users' AS "check", count(*)::DOUBLE AS value FROM um
        UNION ALL SELECT 'events_raw', count(*) FROM fact_events
        UNION ALL SELECT 'duplicate_event_rate', duplicate_event_rate FROM ({_DUPLICATES})
        UNION ALL SELECT 'noncompliance_rate', avg((assigned_variant <> actually_exposed_variant)::INTEGER) FROM um
        UNION ALL SELECT 'activation_rate_7d', avg(activated_within_7d) FROM um
    )"""

# --- statistics ---------------------------------------------------------------------------------


def _long(source: str, keys: str = "", metrics=tuple(METRICS)) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys} user_id, assigned_variant, '{m}' AS metric, {m}::DOUBLE AS y FROM {source}" for m in metrics
    )


def _moments(source: str, keys: str = "") -> str:
    return f"""
    moments AS (
        SELECT {keys} metric, assigned_variant, count(y) AS n, avg(y) AS mean,
            coalesce(var_samp(y), 0) AS variance
        FROM ({source}) GROUP BY ALL
    )"""


def _tests(keys: str = "") -> str:
    """z-tests; the normal tail is integrated with Simpson's rule over 2,000 intervals."""
    side = "max({c}) FILTER (assigned_variant = '{a}')"
    cm, tm = side.format(c="mean", a="control"), side.format(c="mean", a="treatment")
    cv, tv = side.format(c="variance", a="control"), side.format(c="variance", a="treatment")
    cn, tn = side.format(c="n", a="control"), side.format(c="n", a="treatment")
    return f"""
    effects AS (
        SELECT {keys} metric, {cm} AS control_mean, {tm} AS treatment_mean, {tm} - {cm} AS effect_abs,
            CASE WHEN {cm} <> 0 THEN ({tm} - {cm}) / {cm} END AS effect_rel,
            sqrt({tv} / {tn} + {cv} / {cn}) AS standard_error,
            {cn} AS n_control, {tn} AS n_treatment
        FROM moments GROUP BY ALL
    ),
    tests AS (
        SELECT *, CASE WHEN standard_error = 0 THEN 1.0 ELSE greatest(0, 1 - 2 * (
            SELECT sum((CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                    * exp(-0.5 * pow(i / 2000 * abs(effect_abs / standard_error), 2)))
                * abs(effect_abs / standard_error) / 2000 / 3 / sqrt(2 * pi())
            FROM range(2001) steps(i))) END AS p_value
        FROM effects
    )"""


def _poisson_cuts() -> list[str]:
    out, term, total = [], math.exp(-1), 0.0
    for k in range(1, 40):
        total += term
        if round(total * 2**32) == 2**32:
            break
        out.append(format(round(total * 2**32), "08x"))
        term /= k
    return out


_WEIGHT = "CASE " + " ".join(f"WHEN draw < '{c}' THEN {k}" for k, c in enumerate(_poisson_cuts())) + f" ELSE {len(_poisson_cuts())} END"


def _bucket(buckets: int | None) -> str:
    return "user_id" if buckets is None else f"('0x' || substr(md5('42:' || user_id), 1, 8))::BIGINT % {buckets}"


def _replicates(cells: str, replicates: int, sums: str, keys: str = "") -> str:
    """Weighted sums per replicate from cells with an assigned_variant, a unit and value columns."""
    return f"""
    digests AS (
        SELECT *, block, md5('42:' || assigned_variant || ':' || unit || ':' || block) AS digest
        FROM {cells}, range({math.ceil(replicates / 4)}) blocks(block)
    ),
    draws AS (
        SELECT *, block * 4 + part AS replicate, substr(digest, 1 + 8 * part, 8) AS draw
        FROM digests, (VALUES (0), (1), (2), (3)) parts(part)
    ),
    replicates AS (
        SELECT {keys} metric, assigned_variant, replicate, {sums}
        FROM (SELECT *, {_WEIGHT} AS w FROM draws WHERE replicate < {replicates}) GROUP BY ALL
    )"""


def _intervals(value: str, keys: str = "") -> str:
    return f"""
    intervals AS (
        SELECT {keys} metric, quantile_cont(difference, 0.025) AS ci_low, quantile_cont(difference, 0.975) AS ci_high
        FROM (
            SELECT {keys} metric, replicate,
                max(v) FILTER (assigned_variant = 'treatment') - max(v) FILTER (assigned_variant = 'control')
                    AS difference
            FROM (SELECT *, {value} AS v FROM replicates) GROUP BY ALL
        ) GROUP BY ALL
    )"""


def _bootstrap(source: str, replicates: int, buckets: int | None, keys: str = "") -> str:
    return f"""
    cells AS (
        SELECT {keys} metric, assigned_variant, {_bucket(buckets)} AS unit, count(y) AS n, sum(y) AS sy
        FROM ({source}) GROUP BY ALL
    ),
    {_replicates("cells", replicates, "sum(w * sy) AS sy, sum(w * n) AS n", keys)},
    {_intervals("sy / nullif(n, 0)", keys)}"""


def _q_values(source: str, family: str, ties: str, out: str) -> str:
    """For each test, the smallest scaled p-value among itself and the larger ones of its family."""
    return f"""
    {out}_ranked AS (
        SELECT *, row_number() OVER (PARTITION BY {family} ORDER BY p_value, {ties}) AS pos,
            count(*) OVER (PARTITION BY {family}) AS m FROM {source}
    ),
    {out} AS (
        SELECT a.* EXCLUDE (pos, m),
            least(1.0, (SELECT min(b.p_value * b.m / b.pos) FROM {out}_ranked b
                WHERE {" AND ".join(f"b.{f.strip()} = a.{f.strip()}" for f in family.split(","))} AND b.pos >= a.pos))
                AS p_value_fdr
        FROM {out}_ranked a
    )"""


def _cuped(x: str, replicates: int = 2000, buckets: int = 1000) -> str:
    metrics = ["activated_within_7d", "retained_d7", "retained_d30"]
    rows = " UNION ALL ".join(
        f"SELECT user_id, assigned_variant, '{m}' AS metric, {m}::DOUBLE AS y, {x}::DOUBLE AS x FROM um"
        for m in metrics
    )
    return f"""
    pairs AS ({rows}),
    slopes AS (
        SELECT metric, covar_samp(y, x) / var_samp(x) AS theta, avg(x) AS x_mean FROM pairs GROUP BY metric
    ),
    adjusted AS (
        SELECT user_id, assigned_variant, metric, y, theta, y - theta * (x - x_mean) AS z
        FROM pairs JOIN slopes USING (metric)
    ),
    variances AS (
        SELECT metric, any_value(theta) AS theta, var_samp(y) AS raw_variance, var_samp(z) AS cuped_variance,
            avg(y) FILTER (assigned_variant = 'treatment') - avg(y) FILTER (assigned_variant = 'control')
                AS raw_effect_abs
        FROM adjusted GROUP BY metric
    ),
    {_moments("SELECT user_id, assigned_variant, metric, z AS y FROM adjusted")},
    {_tests()},
    {_bootstrap("SELECT user_id, assigned_variant, metric, z AS y FROM adjusted", replicates, buckets)},
    cuped AS (
        SELECT metric, {_r("theta", "theta", 12)}, {_r("raw_variance", "raw_variance")},
            {_r("cuped_variance", "cuped_variance")},
            {_r("100 * (1 - cuped_variance / raw_variance)", "variance_reduction_pct")},
            {_r("raw_effect_abs", "raw_effect_abs")}, {_r("effect_abs", "cuped_effect_abs")},
            {_r("ci_low", "cuped_ci_low")}, {_r("ci_high", "cuped_ci_high")}, {_r("p_value", "cuped_p_value")}
        FROM variances JOIN tests USING (metric) JOIN intervals USING (metric)
    )"""


_IN_ARMS = "um0 AS (SELECT * FROM um WHERE assigned_variant IN ('control', 'treatment'))"
_METRIC_LONG = _long("um0")
_COMMERCE_TESTS = f"{COMMERCE_UM}, {_IN_ARMS}, {_moments(_METRIC_LONG)}, {_tests()}"
_SEGMENT_KEYS = "segment_dimension, segment_value,"
_TEST_DIMENSIONS = ["acquisition_channel", "device", "age_bucket"]


def _segment_long(metrics=("activated_within_7d",)) -> str:
    return " UNION ALL ".join(
        _long("um0", f"'{d}' AS segment_dimension, {d} AS segment_value,", metrics) for d in _TEST_DIMENSIONS
    )


def _segment_tests(gate: int, level: float = 0.05) -> str:
    source = _segment_long()
    return f"""{COMMERCE_UM}, {_IN_ARMS}, {_moments(source, _SEGMENT_KEYS)}, {_tests(_SEGMENT_KEYS)},
    large AS (SELECT * FROM tests WHERE n_control >= {gate} AND n_treatment >= {gate}),
    {_q_values("large", "metric", "segment_dimension, segment_value", "adjusted_p")},
    {_bootstrap(source, 1500, 500, _SEGMENT_KEYS)},
    segment_results AS (
        SELECT segment_dimension, segment_value, metric, n_control, n_treatment,
            {_r("control_mean", "control_mean")}, {_r("treatment_mean", "treatment_mean")},
            {_r("effect_abs", "effect_abs")}, {_r("ci_low", "ci_low")}, {_r("ci_high", "ci_high")},
            {_r("p_value", "p_value")}, {_r("p_value_fdr", "p_value_fdr")},
            p_value_fdr <= {level} AS significant_fdr_05
        FROM adjusted_p JOIN intervals USING (segment_dimension, segment_value, metric)
    )"""


# Normal quantiles for a two-sided 5 % test and 80 % power.
_Z_ALPHA, _Z_BETA = 1.9599639845400536, 0.8416212335729144


def _needed(base: str, lift: str) -> str:
    p1 = f"least(greatest({base}, 1e-6), 1 - 1e-6)"
    p2 = f"least(greatest({base} + {lift}, 1e-6), 1 - 1e-6)"
    # greatest and least skip NULL here: a missing baseline must stay one
    return f"""CASE WHEN {base} IS NOT NULL THEN ceil(pow({_Z_ALPHA}::DOUBLE * sqrt(2 * (({p1} + {p2}) / 2) * (1 - ({p1} + {p2}) / 2))
        + {_Z_BETA}::DOUBLE * sqrt({p1} * (1 - {p1}) + {p2} * (1 - {p2})), 2) / ({lift} * {lift}))::BIGINT END"""


def _search(source: str, keys: str) -> str:
    """Forty halvings of [0.0001, 0.5] per row of the source."""
    return f"""
    search AS (
        SELECT {keys}, control_mean, greatest(2, least(n_control, n_treatment)) AS n, 0 AS step,
            1e-4::DOUBLE AS low, 0.5::DOUBLE AS high FROM {source}
        UNION ALL
        SELECT {keys}, control_mean, n, step + 1,
            CASE WHEN {_needed("control_mean", "((low + high) / 2)")} <= n THEN low ELSE (low + high) / 2 END,
            CASE WHEN {_needed("control_mean", "((low + high) / 2)")} <= n THEN (low + high) / 2 ELSE high END
        FROM search WHERE step < 40
    )"""


_SEGMENT_RATES = f"""{COMMERCE_UM},
    rates AS ({_segments("count(*) AS users, avg(activated_within_7d) AS rate")}),
    segment_rates AS (
        SELECT segment_dimension, segment_value,
            max(rate) FILTER (assigned_variant = 'control') AS control_mean,
            coalesce(max(users) FILTER (assigned_variant = 'control'), 0) AS n_control,
            coalesce(max(users) FILTER (assigned_variant = 'treatment'), 0) AS n_treatment
        FROM rates GROUP BY ALL
    )"""

_POWER = f"""
    primary_test AS (SELECT * FROM tests WHERE metric = 'activated_within_7d'),
    {_search("primary_test", "metric")}"""

_WORSE = """metric IN ('cancelled_30d', 'time_to_first_match_hours', 'support_tickets_30d')
    AND effect_abs > 0 AND p_value < 0.05"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _tolerance_text(i: int) -> str:
    return f"""CASE WHEN lift > 0 AND ok_c AND ok_l AND ok_t THEN {_text(TOLERANCE_ROLLOUT[i])}
        WHEN lift > 0 THEN {_text(TOLERANCE_HOLD[i])} ELSE {_text(TOLERANCE_STOP[i])} END"""


def _delta(column: str) -> str:
    return (
        f"max({column}) FILTER (assigned_variant = 'treatment') - max({column}) FILTER (assigned_variant = 'control')"
    )


_TESTS_ROUNDED = ", ".join(
    _r(c, c) for c in ["control_mean", "treatment_mean", "effect_abs", "effect_rel", "p_value"]
)
_SPLIT = "TIMESTAMP '1998-01-01'"
_SNAPSHOTS = f"""
    stored AS (SELECT o_custkey, max(o_orderdate) AS last_order_ts, count(*) AS orders FROM orders
        WHERE o_orderdate < {_SPLIT} GROUP BY 1),
    incoming AS (SELECT o_custkey, max(o_orderdate) AS last_order_ts, count(*) AS orders FROM orders
        WHERE o_orderdate >= {_SPLIT} GROUP BY 1)"""
_VIEW_ROWS = {
    "vw_events_deduped": "(SELECT DISTINCT user_id, event_name, event_ts FROM fact_events)",
    "vw_activation_user_level": "um",
    "vw_funnel_step_rates": "(SELECT DISTINCT assigned_variant FROM um)",
    "vw_retention_user_level": "um",
    "vw_retention_rates": "(SELECT DISTINCT assigned_variant FROM um)",
    "vw_guardrails_user_level": "um",
    "vw_guardrail_rates": "(SELECT DISTINCT assigned_variant FROM um)",
    "vw_experiment_user_metrics": "um",
    "vw_experiment_variant_summary": "(SELECT DISTINCT assigned_variant FROM um)",
    "vw_experiment_segment_summary": "(SELECT DISTINCT assigned_variant, acquisition_channel, device FROM um)",
}
_FIRSTS = """
    SELECT user_id, min(event_ts) FILTER (event_name = 'onboarding_started') AS onboarding_started_ts,
        min(event_ts) FILTER (event_name = 'onboarding_completed') AS onboarding_completed_ts,
        min(event_ts) FILTER (event_name = 'session_booked') AS {booked}
    FROM fact_events {where} GROUP BY user_id"""
_SEGMENT_SUMMARY = """
    SELECT assigned_variant, acquisition_channel, device, count(*) AS users,
        avg(activated_within_7d) AS activation_rate_7d, avg(retained_d30) AS retention_rate_d30,
        avg(cancelled_30d) AS cancellation_rate_30d
    FROM um GROUP BY ALL"""
_CALCULATED = """
    avg(activated_within_7d) AS activation_rate_7d, avg(retained_d7) AS d7_retention_rate,
    avg(retained_d30) AS d30_retention_rate, avg(cancelled_30d) AS cancellation_rate_30d,
    avg(support_tickets_30d) AS support_tickets_per_user,
    count(*) FILTER (assigned_variant = 'treatment') AS treatment_users,
    count(*) FILTER (assigned_variant = 'control') AS control_users,
    avg((actually_exposed_variant = 'treatment')::INTEGER) AS exposed_to_treatment_rate,
    sum(activated_within_7d)::BIGINT AS activated_users,
    avg(activated_within_7d) FILTER (assigned_variant = 'treatment')
        - avg(activated_within_7d) FILTER (assigned_variant = 'control') AS activation_lift_vs_control"""
_WEEK = """strftime(date_trunc('week', signup_ts), '%Y-%m-%d') || '/' ||
    strftime(date_trunc('week', signup_ts) + INTERVAL 6 DAY, '%Y-%m-%d') AS signup_week"""
_LIFTS = {
    "activation_rate_7d": "activated_within_7d",
    "retention_rate_d7": "retained_d7",
    "retention_rate_d30": "retained_d30",
    "cancellation_rate_30d": "cancelled_30d",
    "avg_time_to_first_match_hours": "time_to_first_match_hours",
    "support_tickets_per_user_30d": "support_tickets_30d",
}


def _lift_rows() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS metric, {_r("c", "control_value")}, {_r("t", "treatment_value")},
            {_r("t - c", "absolute_lift")}, {_r("(t - c) / nullif(c, 0)", "relative_lift")}
        FROM (SELECT avg({column}) FILTER (assigned_variant = 'control') AS c,
                     avg({column}) FILTER (assigned_variant = 'treatment') AS t FROM um)"""
        for name, column in _LIFTS.items()
    )


def _arm_columns(value: str) -> str:
    return (
        f"max({value}) FILTER (assigned_variant = 'control') AS control, "
        f"max({value}) FILTER (assigned_variant = 'treatment') AS treatment"
    )


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["users_through_csv"] = _with(
        PRODUCT,
        """SELECT * REPLACE (pre_treatment_sessions_30d::INTEGER AS pre_treatment_sessions_30d) FROM dim_users""",
    )
    q["events_through_parquet"] = _with(PRODUCT, "SELECT * FROM fact_events")
    q["users_through_stored_upsert"] = q["users_through_csv"]
    q["one_row_batch_folders"] = _with(
        PRODUCT, "SELECT count(*) AS users, 1::BIGINT AS changed_users, 1::BIGINT AS replaced_folders, 0::BIGINT AS other_files_changed FROM dim_users"
    )
    q["batch_constraint_violations"] = _batch_violations()
    q["required_inputs"] = _with(
        PRODUCT,
        """SELECT 'dim_users' AS table_name, count(*) AS row_count FROM dim_users
        UNION ALL SELECT 'fact_matches', count(*) FROM fact_matches
        UNION ALL SELECT t, NULL FROM (VALUES ('fact_events'), ('fact_cancellations'), ('fact_support_tickets')) AS m(t)""",
    )
    q["input_row_counts"] = _with(
        PRODUCT,
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _KEYS),
    )
    q["analysis_input"] = _with(
        PRODUCT_UM,
        f"""SELECT user_id, assigned_variant, acquisition_channel, device, age_bucket, baseline_score, {_OUTCOMES}
        FROM um WHERE assigned_variant IN ('control', 'treatment')""",
    )
    q["view_layer_segment_summary"] = _with(PRODUCT_HOURLY_UM, _SEGMENT_SUMMARY)
    q["view_layer_row_counts"] = _with(
        PRODUCT_HOURLY_UM,
        " UNION ALL ".join(
            f"SELECT '{v}' AS table_name, count(*) AS row_count FROM {s}" for v, s in _VIEW_ROWS.items()
        ),
    )
    q["upsert_latest_orders"] = _with(
        _SNAPSHOTS,
        """SELECT o_custkey, coalesce(i.last_order_ts, s.last_order_ts) AS last_order_ts,
            coalesce(i.orders, s.orders) AS orders
        FROM stored s FULL JOIN incoming i USING (o_custkey)""",
    )
    q["upsert_keeps_absent_columns"] = _with(
        _SNAPSHOTS,
        """SELECT o_custkey, coalesce(i.last_order_ts, s.last_order_ts) AS last_order_ts,
            coalesce(s.orders, 0) AS orders
        FROM stored s FULL JOIN incoming i USING (o_custkey)""",
    )

    q["null_violations"] = _with(PRODUCT, _nulls())
    q["primary_key_violations"] = _with(PRODUCT, _key_violations())
    q["foreign_key_violations"] = _with(COMMERCE_TABLES, _reference_violations())
    q["domain_violations"] = _with(COMMERCE_TABLES, _DOMAINS)
    q["spoiled_null_violations"] = _on_spoiled(_nulls())
    q["spoiled_primary_key_violations"] = _on_spoiled(_key_violations())
    q["spoiled_foreign_key_violations"] = _on_spoiled(_reference_violations())
    q["spoiled_domain_violations"] = _on_spoiled(_DOMAINS)
    q["spoiled_gates"] = _on_spoiled(_gates(_NULL_ARM, _ALLOCATION))
    q["volume_gates"] = _with(PRODUCT, _gates(_VOLUME))
    q["null_assignment_gate"] = _with(PRODUCT, _gates(_NULL_ARM))
    q["allocation_gate"] = _with(PRODUCT, _gates(_ALLOCATION))
    q["activation_gate"] = _with(PRODUCT_HOURLY_UM, _gates(_ACTIVATION))
    q["quality_gates"] = _with(COMMERCE_UM, _gates(_VOLUME, _NULL_ARM, _ALLOCATION, _ACTIVATION))
    q["quality_summary"] = _with(f"{PRODUCT_HOURLY_UM}, {_QUALITY}", "SELECT * FROM quality")
    q["labelled_quality_summary"] = _with(
        f"{PRODUCT_HOURLY_UM}, {_QUALITY}",
        """SELECT CASE "check" WHEN 'users' THEN 'Total simulated users' WHEN 'events_raw' THEN 'Total raw events'
            WHEN 'duplicate_event_rate' THEN 'Duplicate event rate' WHEN 'noncompliance_rate' THEN 'Noncompliance rate'
            ELSE 'Overall activation rate (7D)' END AS "Check", value AS "Value" FROM quality""",
    )
    q["duplicate_event_rate"] = _with(PRODUCT_HOURLY, _DUPLICATES)

    q["events_deduped"] = _with(
        PRODUCT_HOURLY,
        """SELECT event_id, user_id, event_ts, event_name, session_id, properties_json FROM fact_events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_name, event_ts ORDER BY event_id) = 1""",
    )
    q["distinct_event_keys"] = _with(PRODUCT_HOURLY, "SELECT DISTINCT user_id, event_name, event_ts FROM fact_events")
    q["first_times"] = _with(PRODUCT, _FIRSTS.format(booked="first_booking_ts", where=""))
    q["first_times_pivot"] = _with(
        COMMERCE_TABLES,
        _FIRSTS.format(
            booked="session_booked_ts",
            where="WHERE event_name IN ('onboarding_started', 'onboarding_completed', 'session_booked')",
        ),
    )
    q["sessions_from_events"] = _with(
        PRODUCT,
        """SELECT s.session_id, s.user_id, session_start_ts, session_end_ts, u.device
        FROM (SELECT session_id, user_id, min(event_ts) AS session_start_ts, max(event_ts) AS session_end_ts
              FROM fact_events WHERE session_id IS NOT NULL GROUP BY ALL) s
        LEFT JOIN dim_users u USING (user_id)""",
    )
    q["events_with_signup"] = _with(
        PRODUCT,
        """SELECT event_id, user_id, event_name, event_ts, signup_ts, assigned_variant
        FROM fact_events JOIN dim_users USING (user_id)""",
    )
    q["json_properties"] = _with(
        PRODUCT,
        """SELECT event_name, count(*) FILTER (properties_json IS NULL) AS missing,
            count(*) FILTER (properties_json = 'null') AS json_null,
            sum(TRY_CAST(json_extract_string(properties_json, '$.k') AS BIGINT))::BIGINT AS k_total
        FROM fact_events GROUP BY event_name""",
    )

    q["activation_user_level"] = _with(
        PRODUCT_HOURLY_UM,
        f"""SELECT user_id, signup_ts, assigned_variant, actually_exposed_variant, acquisition_channel,
            onboarding_started_ts, onboarding_completed_ts, first_booking_ts, activated_within_7d
        FROM um LEFT JOIN ({_FIRSTS.format(booked="first_booking_ts", where="")}) USING (user_id)""",
    )
    who = "user_id, assigned_variant, actually_exposed_variant, acquisition_channel"
    q["retention_user_level"] = _with(PRODUCT_UM, f"SELECT {who}, retained_d7, retained_d30 FROM um")
    q["support_user_level"] = _with(PRODUCT_UM, "SELECT user_id, support_tickets_30d FROM um")
    q["cancellation_user_level"] = _with(PRODUCT_UM, "SELECT user_id, cancelled_30d FROM um")
    q["spoiled_cancellation_user_level"] = _with(COMMERCE_UM, "SELECT user_id, cancelled_30d FROM um")
    q["match_latency_user_level"] = _with(PRODUCT_UM, f"SELECT user_id, {_HOURS} FROM um")
    q["guardrails_user_level"] = _with(
        COMMERCE_UM, f"SELECT {who}, cancelled_30d, {_HOURS}, support_tickets_30d FROM um"
    )
    q["experiment_user_metrics"] = _with(PRODUCT_UM, f"SELECT {_WHO}, {_OUTCOMES} FROM um")
    q["metrics_after_three_batches"] = q["experiment_user_metrics"]
    q["experiment_user_metrics_commerce"] = _with(COMMERCE_UM, f"SELECT {_WHO}, {_OUTCOMES} FROM um")
    q["dashboard_user_level"] = _with(
        PRODUCT_UM,
        f"""SELECT {_WHO}, signup_ts::DATE AS signup_date,
            (assigned_variant <> actually_exposed_variant)::INTEGER AS noncompliance_flag, {_STEPS}, {_OUTCOMES}
        FROM um""",
    )
    q["bi_user_level"] = _with(
        PRODUCT_UM,
        f"""SELECT {_WHO}, signup_ts::DATE AS signup_date, {_WEEK},
            (actually_exposed_variant = 'treatment')::INTEGER AS saw_treatment, {_STEPS}, {_OUTCOMES}
        FROM um""",
    )

    q["funnel_step_rates"] = _with(
        PRODUCT_UM,
        """SELECT assigned_variant, count(*) AS users,
            sum(onboarding_started)::BIGINT AS users_started_onboarding,
            sum(onboarding_completed)::BIGINT AS users_completed_onboarding,
            sum(session_booked)::BIGINT AS users_booked_session,
            avg(onboarding_started) AS rate_started_onboarding, avg(onboarding_completed) AS rate_completed_onboarding,
            avg(session_booked) AS rate_booked_session, avg(activated_within_7d) AS activation_rate_7d
        FROM um GROUP BY 1""",
    )
    q["retention_rates"] = _with(
        PRODUCT_UM,
        """SELECT assigned_variant, count(*) AS users, avg(retained_d7) AS retention_rate_d7,
            avg(retained_d30) AS retention_rate_d30 FROM um GROUP BY 1""",
    )
    q["guardrail_rates"] = _with(
        PRODUCT_UM,
        f"""SELECT assigned_variant, count(*) AS users, avg(cancelled_30d) AS cancellation_rate_30d,
            {_r("avg(time_to_first_match_hours)", "avg_time_to_first_match_hours")},
            avg(support_tickets_30d) AS support_tickets_per_user_30d FROM um GROUP BY 1""",
    )
    summary = f"SELECT assigned_variant, count(*) AS users, {_AVERAGES} FROM um"
    q["variant_summary"] = _with(PRODUCT_UM, f"{summary} GROUP BY 1")
    q["variant_summary_commerce"] = _with(COMMERCE_UM, f"{summary} GROUP BY 1")
    q["segment_summary"] = _with(PRODUCT_UM, _SEGMENT_SUMMARY)
    q["dashboard_variant_summary"] = _with(
        f"{PRODUCT_UM}, {_DASHBOARD_SUMMARY}",
        f"SELECT * REPLACE ({_r('avg_match_latency_hours', 'avg_match_latency_hours')}) FROM summary",
    )
    q["labelled_variant_summary"] = _with(
        f"{PRODUCT_UM}, {_DASHBOARD_SUMMARY}",
        f"""SELECT assigned_variant AS "Variant", users AS "Users", activation_rate_7d AS "Activation Rate (7D)",
            retention_rate_d7 AS "Retention Rate (D7)", retention_rate_d30 AS "Retention Rate (D30)",
            cancellation_rate_30d AS "Cancellation Rate (30D)",
            {_r("avg_match_latency_hours", '"Avg Match Latency (hrs)"')},
            support_tickets_per_user AS "Support Tickets per User (30D)", noncompliance_rate AS "Noncompliance Rate"
        FROM summary""",
    )
    q["variant_rate_texts"] = _with(
        f"{PRODUCT_UM}, {_DASHBOARD_SUMMARY}",
        """SELECT assigned_variant, printf('%.2f%%', 100 * activation_rate_7d) AS activation,
            printf('%.2f%%', 100 * cancellation_rate_30d) AS cancellation,
            printf('%.4f', support_tickets_per_user) AS tickets FROM summary""",
    )
    q["lift_table"] = _with(PRODUCT_UM, _lift_rows())
    q["funnel_long"] = _with(PRODUCT_UM, _funnel("um", order=True))
    q["ordered_funnel"] = _with(COMMERCE_UM, _funnel("um", order=False))
    q["daily_metrics"] = _with(
        COMMERCE_UM,
        f"SELECT signup_ts::DATE AS signup_date, assigned_variant, count(*) AS users, {_AVERAGES} FROM um GROUP BY 1, 2",
    )
    daily = (
        "SELECT signup_ts::DATE AS signup_date, assigned_variant, avg(activated_within_7d) AS activation_rate_7d "
        "FROM um GROUP BY 1, 2"
    )
    q["daily_activation"] = _with(PRODUCT_UM, daily)
    means = ", ".join(
        _r(f"avg({m})", m) if m == "time_to_first_match_hours" else f"avg({m}) AS {m}" for m in METRICS
    )
    q["segment_metrics"] = _with(PRODUCT_UM, _segments(f"count(*) AS users, {means}"))
    rates = _segments("count(*) AS users, avg(activated_within_7d) AS activation_rate_7d")
    q["segment_activation"] = _with(PRODUCT_UM, rates)
    q["labelled_segments"] = _with(
        PRODUCT_UM,
        f"""SELECT segment_dimension AS "Segment Type", segment_value AS "Segment Value",
            assigned_variant AS "Variant", users AS "Users", activation_rate_7d AS "Activation Rate (7D)"
        FROM ({rates})""",
    )
    q["funnel_by_arm"] = _with(
        PRODUCT_UM,
        f"""SELECT CASE step WHEN 'signup' THEN 'Signup' WHEN 'onboarding_started' THEN 'Onboarding Started'
            WHEN 'onboarding_completed' THEN 'Onboarding Completed' WHEN 'session_booked' THEN 'Session Booked'
            ELSE 'Activated Within 7 Days' END AS step, {_arm_columns("rate_from_signup")}
        FROM ({_funnel("um", order=False)}) GROUP BY 1""",
    )
    q["daily_activation_by_arm"] = _with(
        COMMERCE_UM, f"SELECT signup_date, {_arm_columns('activation_rate_7d')} FROM ({daily}) GROUP BY 1"
    )
    q["segment_activation_by_arm"] = _with(
        PRODUCT_UM,
        f"SELECT segment_dimension, segment_value, {_arm_columns('activation_rate_7d')} FROM ({rates}) GROUP BY 1, 2",
    )
    q["calculated_fields"] = _with(PRODUCT_UM, f"SELECT {_CALCULATED} FROM um")
    q["calculated_fields_by_week"] = _with(COMMERCE_UM, f"SELECT {_WEEK}, {_CALCULATED} FROM um GROUP BY 1")
    q["headline"] = _with(
        f"{PRODUCT_UM}, {_DASHBOARD_SUMMARY}",
        f"""SELECT sum(users)::BIGINT AS total_users,
            {_r(f"100 * ({_delta('activation_rate_7d')})", "activation_lift_pp")} FROM summary""",
    )
    q["filtered_variant_summary"] = _with(
        PRODUCT_UM,
        f"""{summary} WHERE signup_ts::DATE BETWEEN DATE '2024-01-01' AND DATE '2024-01-03'
            AND device IN ('ios', 'web') AND country IN ('US', 'CA', 'GB') GROUP BY 1""",
    )
    q["filtered_variant_summary_stored"] = q["filtered_variant_summary"]

    commerce = f"{COMMERCE_UM}, {_IN_ARMS}"
    described = f"SELECT metric, assigned_variant, n, {_r('mean', 'mean', 4)}, {_r('variance', 'variance', 4)} FROM moments"
    q["arm_moments"] = _with(f"{commerce}, {_moments(_METRIC_LONG)}", described)
    q["arm_moments_from_buckets"] = q["arm_moments"]
    q["difference_tests"] = _with(
        _COMMERCE_TESTS,
        f"""SELECT metric, {_TESTS_ROUNDED}, {_r("standard_error", "standard_error")}, n_control, n_treatment
        FROM tests""",
    )
    interval = f"SELECT metric, {_r('ci_low', 'ci_low')}, {_r('ci_high', 'ci_high')} FROM intervals"
    q["bootstrap_intervals"] = _with(f"{commerce}, {_bootstrap(_METRIC_LONG, 2000, 1000)}", interval)
    q["bootstrap_intervals_per_user"] = _with(f"{commerce}, {_bootstrap(_METRIC_LONG, 2000, None)}", interval)
    q["ab_results"] = _with(
        f"{_COMMERCE_TESTS}, {_bootstrap(_METRIC_LONG, 2000, 1000)}",
        f"""SELECT metric, {_TESTS_ROUNDED}, {_r("ci_low", "ci_low")}, {_r("ci_high", "ci_high")}, n_control,
            n_treatment, 'difference_in_means + bootstrap_ci' AS analysis_method
        FROM tests JOIN intervals USING (metric)""",
    )
    q["ab_results_with_fdr"] = _with(
        f"""{_COMMERCE_TESTS},
        family AS (SELECT *, metric = 'activated_within_7d' AS is_primary FROM tests),
        {_q_values("family", "is_primary", "metric", "adjusted_p")}""",
        f"""SELECT metric, {_r("effect_abs", "effect_abs")}, {_r("p_value", "p_value")},
            {_r("CASE WHEN is_primary THEN p_value ELSE p_value_fdr END", "p_value_fdr")},
            CASE WHEN is_primary THEN p_value ELSE p_value_fdr END <= 0.05 AS significant_fdr_05
        FROM adjusted_p""",
    )
    q["segment_q_values"] = _with(
        f"""{commerce}, {_moments(_segment_long(METRICS), _SEGMENT_KEYS)}, {_tests(_SEGMENT_KEYS)},
        {_q_values("tests", "segment_dimension", "segment_value, metric", "adjusted_p")}""",
        f"""SELECT segment_dimension, segment_value, metric, {_r("p_value", "p_value")},
            {_r("p_value_fdr", "p_value_fdr")} FROM adjusted_p""",
    )
    q["segment_tests"] = _with(_segment_tests(140), "SELECT * FROM segment_results")
    q["segment_tests_high_gate"] = _with(_segment_tests(200), "SELECT * FROM segment_results")
    q["cuped_adjusted"] = _with(
        f"""{COMMERCE_UM},
        slope AS (SELECT covar_samp(activated_within_7d, pre_treatment_sessions_30d)
                / var_samp(pre_treatment_sessions_30d) AS theta, avg(pre_treatment_sessions_30d) AS x_mean FROM um)""",
        f"""SELECT user_id, assigned_variant, activated_within_7d, pre_treatment_sessions_30d,
            {_r("activated_within_7d - theta * (pre_treatment_sessions_30d - x_mean)", "cuped_outcome")}
        FROM um, slope""",
    )
    q["cuped_results"] = _with(f"{COMMERCE_UM}, {_cuped('baseline_score')}", "SELECT * FROM cuped")
    q["cuped_results_sessions"] = _with(
        f"{COMMERCE_UM}, {_cuped('pre_treatment_sessions_30d')}", "SELECT * FROM cuped"
    )
    q["required_sample_sizes"] = _with(
        _SEGMENT_RATES,
        f"""SELECT segment_dimension, segment_value, {_needed("control_mean", "0.01::DOUBLE")} AS n_for_1pp,
            {_needed("control_mean", "0.03::DOUBLE")} AS n_for_3pp FROM segment_rates""",
    )
    q["detectable_lifts"] = _with(
        f"{_SEGMENT_RATES}, {_search('segment_rates', 'segment_dimension, segment_value')}",
        f"SELECT segment_dimension, segment_value, {_r("CASE WHEN control_mean IS NOT NULL THEN high END", "observed_mde_abs", 9)} FROM search WHERE step = 40",
    )
    q["power_table"] = _with(
        f"{_COMMERCE_TESTS}, {_POWER}",
        f"""SELECT metric, 0.05::DOUBLE AS alpha, 0.8::DOUBLE AS power,
            {_r("t.control_mean", "baseline_rate_control", 9)}, n_control, n_treatment,
            {_r("high", "observed_mde_abs", 9)},
            {_needed("t.control_mean", "0.01::DOUBLE")} AS required_n_per_group_for_1pp_lift
        FROM primary_test t JOIN search USING (metric) WHERE step = 40""",
    )

    q["guardrail_regressions"] = _with(
        _COMMERCE_TESTS,
        f"""SELECT metric, {_r("effect_abs", "effect_abs")}, {_r("p_value", "p_value")},
            metric || ' worsened (effect=' || printf('%.4f', effect_abs) || ', p=' || printf('%.4f', p_value) || ')'
                AS issue
        FROM tests WHERE {_WORSE}""",
    )
    q["decision_by_pvalue"] = _with(
        f"""{_COMMERCE_TESTS},
        flags AS (SELECT bool_or(metric = 'activated_within_7d' AND effect_abs > 0 AND p_value < 0.05) AS primary_win,
            count(*) FILTER ({_WORSE}) AS guardrail_issues FROM tests)""",
        f"""SELECT CASE WHEN primary_win AND guardrail_issues = 0 THEN {_text(PVALUE_ROLLOUT)}
            WHEN primary_win THEN {_text(PVALUE_MITIGATE)} ELSE {_text(PVALUE_STOP)} END AS decision,
            primary_win, guardrail_issues FROM flags""",
    )
    q["decision_by_tolerance"] = _with(
        f"""{PRODUCT_UM}, {_DASHBOARD_SUMMARY},
        deltas AS (SELECT {_delta("activation_rate_7d")} AS lift, {_delta("cancellation_rate_30d")} AS c,
            {_delta("avg_match_latency_hours")} AS l, {_delta("support_tickets_per_user")} AS t FROM summary),
        checked AS (SELECT *, c <= 0.003::DOUBLE AS ok_c, l <= 1 AS ok_l, t <= 0.01::DOUBLE AS ok_t FROM deltas)""",
        f"""SELECT {_tolerance_text(0)} AS decision, {_tolerance_text(1)} AS rationale,
            {_tolerance_text(2)} AS action_plan, {_r("100 * lift", "activation_lift_pp")},
            {_r("100 * c", "cancellation_delta_pp")}, {_r("l", "match_latency_delta_hours")},
            {_r("t", "support_ticket_delta")}, ok_c AS guardrail_cancellation_within_tolerance,
            ok_l AS guardrail_latency_within_tolerance, ok_t AS guardrail_support_within_tolerance
        FROM checked""",
    )
    harmless = (
        "activated_within_7d = 1 AND cancelled_30d = 0 AND support_tickets_30d = 0 OR user_id % 4 = 0"
        " OR time_to_first_match_hours < 500 AND cancelled_30d = 0 AND support_tickets_30d = 0"
    )
    costly_rule = "activated_within_7d = 1 OR cancelled_30d = 1 OR support_tickets_30d > 0 OR user_id % 4 = 0"
    for name, rule in (("decision_by_tolerance_costly", costly_rule), ("decision_by_tolerance_winning", harmless)):
        arms = f"SELECT * REPLACE (CASE WHEN {rule} THEN 'treatment' ELSE 'control' END AS assigned_variant) FROM all_users"
        users = COMMERCE_UM.rsplit("um AS (", 1)
        q[name] = q["decision_by_tolerance"].replace(PRODUCT_UM, f"all_users AS (".join(users) + f", um AS ({arms})", 1)
    q["exact_resample_totals"] = _with(
        f"{COMMERCE_UM}, {_IN_ARMS}",
        f"""SELECT metric, assigned_variant, 2000::BIGINT AS replicates, count(y) AS least_draws, count(y) AS most_draws
        FROM ({_METRIC_LONG}) GROUP BY ALL""",
    )
    q["order_q_values"] = """
        WITH tests AS (SELECT o_orderkey, round(o_totalprice / 1e6, 9) AS p_value FROM orders),
        ranked AS (SELECT *, p_value * count(*) OVER () / row_number() OVER (ORDER BY p_value, o_orderkey) AS scaled FROM tests)
        SELECT o_orderkey, p_value, round(least(1.0, min(scaled) OVER (ORDER BY p_value DESC, o_orderkey DESC)), 9) + 0.0 AS p_value_fdr
        FROM ranked"""
    costly, winning = (
        f"um0 AS (SELECT * REPLACE (CASE WHEN {rule} THEN 'treatment' ELSE 'control' END AS assigned_variant) FROM in_arms)"
        for rule in (
            "activated_within_7d = 1 OR cancelled_30d = 1 OR support_tickets_30d > 0 OR user_id % 4 = 0",
            "activated_within_7d = 1 AND cancelled_30d = 0 AND support_tickets_30d = 0 OR user_id % 4 = 0",
        )
    )
    for name, like, arms in (
        ("guardrail_regressions_found", "guardrail_regressions", costly),
        ("decision_by_pvalue_costly", "decision_by_pvalue", costly),
        ("decision_by_pvalue_winning", "decision_by_pvalue", winning),
    ):
        q[name] = q[like].replace(_IN_ARMS, f"{_IN_ARMS.replace('um0', 'in_arms', 1)}, {arms}")
    q["strongest_segment_found"] = _with(
        _segment_tests(140, 0.05).replace(_IN_ARMS, f"{_IN_ARMS.replace('um0', 'in_arms', 1)}, {winning}"),
        "SELECT * FROM segment_results WHERE significant_fdr_05"
        " ORDER BY effect_abs DESC, segment_dimension, segment_value LIMIT 1",
    )
    q["kpi_snapshot"] = _with(
        f"""{_COMMERCE_TESTS}, {_POWER}, {_bootstrap(_METRIC_LONG, 2000, 1000)},
        reductions AS (SELECT 100 * (1 - var_samp(y - theta * (x - x_mean)) / var_samp(y)) AS reduction
            FROM (SELECT metric, y, baseline_score AS x FROM ({_METRIC_LONG}) JOIN um0 USING (user_id))
            JOIN (SELECT metric, covar_samp(y, baseline_score) / var_samp(baseline_score) AS theta,
                    avg(baseline_score) AS x_mean
                  FROM ({_METRIC_LONG}) JOIN um0 USING (user_id) GROUP BY metric) USING (metric)
            WHERE metric IN ('activated_within_7d', 'retained_d7', 'retained_d30') GROUP BY metric)""",
        f"""SELECT metric AS primary_metric, {_r("t.control_mean", "control_rate")},
            {_r("treatment_mean", "treatment_rate")}, {_r("effect_abs", "absolute_lift")}, {_r("p_value", "p_value")},
            {_r("ci_low", "ci_low")}, {_r("ci_high", "ci_high")}, {_r("high", "observed_mde_abs")},
            {_r("(SELECT avg(reduction) FROM reductions)", "mean_cuped_variance_reduction_pct")}
        FROM primary_test t JOIN search USING (metric) JOIN intervals USING (metric) WHERE step = 40""",
    )
    q["strongest_segment"] = _with(
        _segment_tests(140, 1.0),
        "SELECT * FROM segment_results ORDER BY effect_abs DESC, segment_dimension, segment_value LIMIT 1",
    )
    values = ", ".join(f"({', '.join(_text(v) for v in (r[0], r[1], r[2], r[5]))})" for r in DICTIONARY)
    q["labelled_results"] = _with(
        f"""{_COMMERCE_TESTS},
        names(metric, business_metric, category, desired_direction) AS (VALUES {values})""",
        f"""SELECT metric, business_metric, category, desired_direction, {_r("effect_abs", "effect_abs")},
            {_r("p_value", "p_value")} FROM tests LEFT JOIN names USING (metric)""",
    )
    return q
