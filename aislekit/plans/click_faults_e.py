"""Clickstream corruption queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import click_faults as CF
from aislekit.operators import click_sequence as CS
from aislekit.operators.faults import arith_u_sql
from aislekit.operators.profile import ERR
from aislekit.plans.clickstream_k import ENR, enriched
from aislekit.plans.derived import cut
from aislekit.plans.registry import query

MODE = "arith"
VIEWS = ("clickstreams", "products")


def U(seed: int) -> str:
    return arith_u_sql("event_id", seed)


def _poisson(u: str, mean: float) -> str:
    from math import exp, factorial
    parts, cdf = [], 0.0
    for k in range(21):
        cdf += exp(-mean) * mean ** k / factorial(k)
        parts.append(f"WHEN {u} < {cdf!r} THEN {k}")
    return "CASE " + " ".join(parts) + " ELSE 20 END"


SK = "customer_id * 10000 + datediff('day', DATE '2024-01-01', CAST(event_timestamp AS DATE))"
PROF = f"""CASE WHEN {arith_u_sql(SK, 11)} < 0.65 THEN 'clean' WHEN {arith_u_sql(SK, 11)} < 0.85 THEN 'light_noise'
  WHEN {arith_u_sql(SK, 11)} < 0.95 THEN 'moderate_noise' ELSE 'heavy_corruption' END"""


def _budget_cte() -> str:
    sel = []
    for i, s in enumerate(CF.STEPS):
        rank = " + ".join(f"CAST({U(40 + j)} < {U(40 + i)} AS INTEGER)" for j in range(len(CF.STEPS)) if j != i)
        sel.append(f"({rank}) < b AS sel_{s}")
    return f"""SELECT *, {', '.join(sel)} FROM (
  SELECT *, CASE WHEN prof = 'clean' THEN 0 WHEN prof = 'light_noise' THEN {_poisson(U(12), 1)} WHEN prof = 'moderate_noise' THEN {_poisson(U(12), 2)}
    ELSE {_poisson(U(12), 4)} END AS b FROM (SELECT *, {PROF} AS prof, CAST([] AS VARCHAR[]) AS error_types FROM enr))"""


def _add(errs: str, cond: str, label: str) -> str:
    return (f"CASE WHEN coalesce({cond}, false) AND len(list_distinct({errs})) < 4 AND NOT list_contains({errs}, '{label}') "
            f"THEN list_append({errs}, '{label}') ELSE {errs} END")


def _step_query(step: str, body: str, cols: str):
    """Register e-query for one step applied alone to the selected events."""
    def fn(t, _s=step, _c=cols):
        b = CF.with_budget(enriched(t), MODE)
        if _s == "time_anomaly":
            from aislekit.operators.sequence import neighbour
            b = neighbour(b, ["session_id"], ["event_timestamp", "event_id"], ["event_timestamp"], "prev",
                          bucket=F.date_trunc("hour", F.col("event_timestamp")))
        return CF.apply_steps(b, [_s], MODE).select(*[c.strip() for c in _c.split(",")])
    return fn


E_IDS = {"populate_wrong_fields": "e08", "mismatch_fields": "e09", "field_corruption": "e10", "time_anomaly": "e11",
         "break_cart": "e12", "messy_search_term": "e13", "wrong_event_sequence": "e14"}


def _sql_for(step: str) -> tuple[str, str]:
    """Oracle text for one step on the selected events -> (body, output columns)."""
    on = f"sel_{step}"
    if step == "populate_wrong_fields":
        e = "error_types"
        e = _add(e, f"{on} AND scroll_depth IS NULL", "populate scroll depth")
        e = _add(e, f"{on} AND category IS NULL", "populate category")
        e = _add(e, f"{on} AND product_id IS NULL", "populate product id")
        e = _add(e, f"{on} AND cart_size IS NULL", "populate cart size")
        body = f"""SELECT event_id, CASE WHEN {on} AND scroll_depth IS NULL THEN CAST(floor({U(50)} * 101) AS DOUBLE) ELSE scroll_depth END AS scroll_depth,
  CASE WHEN {on} AND category IS NULL THEN ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'][CAST(floor({U(51)} * 6) + 1 AS INTEGER)] ELSE category END AS category,
  CASE WHEN {on} AND product_id IS NULL THEN CAST(floor({U(52)} * 50) AS BIGINT) ELSE product_id END AS product_id,
  {e} AS error_types FROM bud"""
        return body, "event_id, scroll_depth, category, product_id, error_types"
    if step == "mismatch_fields":
        c1 = f"{on} AND {U(60)} < 0.3 AND event_type IN ('Product View', 'Add to Cart', 'Remove from Cart')"
        c2 = f"{on} AND {U(62)} < 0.3 AND cart_size IS NOT NULL"
        c3 = f"{on} AND {U(64)} < 0.2 AND scroll_depth IS NOT NULL"
        e = _add(_add(_add("error_types", c1, "mismatch product"), c2, "mismatch cart size"), c3, "mismatch scroll depth")
        body = f"""SELECT event_id, CASE WHEN {c1} THEN CAST(floor({U(61)} * 50) AS BIGINT) ELSE product_id END AS product_id,
  CASE WHEN {c2} THEN CAST(floor({U(63)} * 21) AS BIGINT) ELSE cart_size END AS cart_size,
  round(CASE WHEN {c3} THEN scroll_depth + {U(65)} * 50 - 25 ELSE scroll_depth END, 6) AS scroll_depth, {e} AS error_types FROM bud"""
        return body, "event_id, product_id, cart_size, scroll_depth, error_types"
    if step == "field_corruption":
        c1 = f"{on} AND {U(70)} < 0.2 AND scroll_depth IS NOT NULL"
        c2 = f"{on} AND {U(73)} < 0.3 AND category IS NOT NULL"
        c3 = f"{on} AND {U(74)} < 0.2 AND bounce_flag IS NOT NULL"
        c4 = f"{on} AND {U(75)} < 0.3 AND event_type = 'Checkout Start'"
        c5 = f"{on} AND {U(76)} < 0.03 AND event_type = 'Add to Cart'"
        e = "error_types"
        for c, l in [(c1, "scroll out of bound"), (c2, "category corruption"), (c3, "bounce flag corruption"),
                     (c4, "checkout without cart"), (c5, "missing add to cart product")]:
            e = _add(e, c, l)
        body = f"""SELECT event_id, round(CASE WHEN {c1} THEN CASE WHEN {U(71)} < 0.5 THEN 100.1 + {U(72)} * 49.9 ELSE -20 + {U(72)} * 19.9 END ELSE scroll_depth END, 6) AS scroll_depth,
  CASE WHEN {c2} THEN 'lorem' ELSE category END AS category, CASE WHEN {c3} THEN 'Bounced' ELSE CAST(bounce_flag AS VARCHAR) END AS bounce_flag,
  CASE WHEN {c4} THEN CAST(0 AS BIGINT) ELSE cart_size END AS cart_size, CASE WHEN {c5} THEN NULL ELSE product_id END AS product_id,
  {e} AS error_types FROM bud"""
        return body, "event_id, scroll_depth, category, bounce_flag, cart_size, product_id, error_types"
    if step == "break_cart":
        r = U(90)
        c1, c2 = f"{on} AND {r} < 0.3 AND cart_size > 0", f"{on} AND {r} >= 0.3 AND {r} < 0.9 AND cart_size > 0"
        c3, c4 = f"{on} AND {r} >= 0.9 AND {r} < 0.95", f"{on} AND {r} >= 0.95 AND cart_size > 0"
        e = _add(_add(_add(_add("error_types", c1, "partial cart loss"), c2, "cart reset"), c3, "cart is none"), c4, "cart explosion")
        body = f"""SELECT event_id, CASE WHEN {c1} THEN CAST(floor(cart_size / 2) AS BIGINT) WHEN {c2} THEN CAST(0 AS BIGINT) WHEN {c3} THEN NULL
  WHEN {c4} THEN cart_size + 10 + CAST(floor({U(91)} * 21) AS BIGINT) ELSE cart_size END AS cart_size, {e} AS error_types FROM bud"""
        return body, "event_id, cart_size, error_types"
    if step == "messy_search_term":
        c1 = f"{on} AND event_type = 'Search View'"
        body = f"SELECT event_id, CASE WHEN {c1} THEN page || '!' ELSE page END AS page, {_add('error_types', c1, 'messy search term')} AS error_types FROM bud"
        return body, "event_id, page, error_types"
    if step == "wrong_event_sequence":
        c1 = f"{on} AND {U(100)} < 0.05"
        body = f"""SELECT event_id, CASE WHEN {c1} THEN ['Payment Attempt', 'Checkout Start', 'Add to Cart', 'Cart View', 'Home View'][CAST(floor({U(101)} * 5) + 1 AS INTEGER)]
  ELSE event_type END AS event_type, {_add('error_types', c1, 'impossible event sequence')} AS error_types FROM bud"""
        return body, "event_id, event_type, error_types"
    if step == "time_anomaly":
        prev = "lag(event_timestamp) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id)"
        c1 = f"{on} AND pv IS NOT NULL AND {U(80)} < 0.3"
        c2 = f"{on} AND pv IS NOT NULL AND NOT ({U(80)} < 0.3) AND {U(83)} < 0.02"
        shift = (f"[1 + floor({U(81)} * 3), 30 + floor({U(81)} * 91), 300 + floor({U(81)} * 901), -(5 + floor({U(81)} * 296)), "
                 f"86400 + floor({U(81)} * 777601)][CAST(floor({U(82)} * 5) + 1 AS INTEGER)]")
        e = _add(_add("error_types", c1, "timestamp gap anomaly"), c2, "future timestamp")
        body = f"""SELECT event_id, CASE WHEN {c1} THEN pv + to_seconds(CAST({shift} AS BIGINT))
  WHEN {c2} THEN TIMESTAMP '2025-01-01 00:00:00' + to_days(CAST(1 + floor({U(84)} * 3650) AS INTEGER)) ELSE event_timestamp END AS event_timestamp,
  {e} AS error_types FROM (SELECT *, {prev} AS pv FROM bud)"""
        return body, "event_id, event_timestamp, error_types"
    raise KeyError(step)


for _step, _eid in E_IDS.items():
    _body, _cols = _sql_for(_step)
    _fn = _step_query(_step, _body, _cols)
    _fn.__doc__ = f"{_eid.upper()}: the {_step.replace('_', ' ')} corruption on events whose budget picks it."
    query(f"{_eid}_{_step}", VIEWS, _body, {**ENR, "bud": _budget_cte()})(_fn)


def D(seed: int) -> str:
    return arith_u_sql("k", seed)


_CATEGORY = "['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'][CAST(floor({u} * 6) + 1 AS INTEGER)]"
_PAGE = """CASE WHEN event_type = 'Home View' THEN '/' WHEN event_type = 'Search View' THEN '/search?q=term' WHEN event_type = 'Category View' THEN '/category/' || c
  WHEN event_type = 'Cart View' THEN '/cart' WHEN event_type IN ('Product View', 'Add to Cart') THEN '/product/' || CAST(p AS VARCHAR) ELSE '/checkout' END"""
BOT_SQL = f"""SELECT 'bot_' || CAST(event_id AS VARCHAR) AS session_id, -2 * (event_id * 1000 + i) AS event_id,
  event_timestamp + to_microseconds(CAST(1000 * sum(ms) OVER (PARTITION BY event_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS BIGINT)) AS event_timestamp, event_type,
  CASE WHEN event_type = 'Product View' THEN p END AS product_id, {_PAGE} AS page, ['bot traffic'] AS error_types
FROM (SELECT *, CAST(floor(delay * 1000) AS BIGINT) AS ms, CASE WHEN w < 10 THEN 'Home View' WHEN w < 35 THEN 'Search View' WHEN w < 55 THEN 'Category View'
    WHEN w < 95 THEN 'Product View' ELSE 'Cart View' END AS event_type FROM (
  SELECT *, [0.1 + {D(112)} * 0.4, 1 + {D(112)} * 4, 10 + {D(112)} * 50][CAST(floor({D(113)} * 3) + 1 AS INTEGER)] AS delay, {D(114)} * 100 AS w,
    CAST(floor({D(115)} * 50) AS BIGINT) AS p, {_CATEGORY.format(u=D(117))} AS c
  FROM (SELECT *, event_id * 100 + i AS k FROM (SELECT event_id, event_timestamp, unnest(range(1, 6 + CAST(floor({U(111)} * 16) AS BIGINT))) AS i FROM bud
    WHERE {U(110)} < CASE prof WHEN 'clean' THEN 0.0 WHEN 'light_noise' THEN 0.01 WHEN 'moderate_noise' THEN 0.12 ELSE 0.25 END))))"""
_E = "e"
ORPHAN_SQL = f"""SELECT 'orphan_' || session_id AS session_id, -2 * (e * 1000 + i) - 1 AS event_id,
  t + to_seconds(CAST(sum(gap) OVER (PARTITION BY e ORDER BY i ROWS UNBOUNDED PRECEDING) AS BIGINT)) AS event_timestamp, event_type,
  CASE WHEN event_type IN ('Product View', 'Add to Cart') THEN p END AS product_id, {_PAGE} AS page, ['orphan session'] AS error_types
FROM (SELECT *, ['Product View', 'Add to Cart', 'Cart View', 'Search View', 'Category View', 'Checkout Start', 'Payment Attempt'][CAST(floor({D(122)} * 7) + 1 AS INTEGER)] AS event_type,
    CAST(floor({D(123)} * 50) AS BIGINT) AS p, {_CATEGORY.format(u=D(126))} AS c, 10 + floor({D(124)} * 291) AS gap
  FROM (SELECT *, e * 100 + i AS k FROM (SELECT session_id, t, e, unnest(range(1, 4 + CAST(floor({arith_u_sql(_E, 121)} * 10) AS BIGINT))) AS i
    FROM (SELECT session_id, customer_id, min(event_timestamp) AS t, min(event_id) AS e FROM enr GROUP BY 1, 2) WHERE {arith_u_sql(_E, 120)} < 0.02)))"""
_MADE = ["session_id", "event_id", "event_timestamp", "event_type", "product_id", "page", ERR]


@query("e16_bot_traffic", VIEWS, BOT_SQL, {**ENR, "bud": _budget_cte()})
def e16(t):
    """Bot sessions: 5-20 rapid events after rows picked at the profile's bot rate."""
    b = CF.with_budget(enriched(t), MODE)
    return CF.bot_sessions(b, MODE).select(*_MADE)


@query("e17_orphan_sessions", VIEWS, ORPHAN_SQL, ENR)
def e17(t):
    """Orphan sessions: 3-12 mid-funnel events without a landing event."""
    return CF.orphan_sessions(enriched(t), mode=MODE).select(*_MADE)


# Rates high enough that a small table holds every kind
SEQ_RATES = {"impossible": 0.2, "repeat": 0.2, "backtrack": 0.25, "replay": 0.4}
_PICKED = f"""SELECT *, count(*) OVER (PARTITION BY session_id) AS n, count(*) FILTER (event_type = 'Product View') OVER (PARTITION BY session_id) AS nv,
  CASE WHEN event_type = 'Product View' THEN count(*) FILTER (event_type = 'Product View') OVER (PARTITION BY session_id ORDER BY event_order ROWS UNBOUNDED PRECEDING) END AS vp
FROM bud"""
_KINDS = f"""SELECT *, CASE kind WHEN 'repeat' THEN event_order - 1 WHEN 'backtrack' THEN 1 + CAST(floor({U(106)} * n) AS BIGINT)
  WHEN 'replay' THEN 1 + CAST(floor({U(107)} * nv) AS BIGINT) END AS pick FROM (
  SELECT *, CASE WHEN NOT sel_wrong_event_sequence THEN NULL WHEN event_order > 1 AND {U(102)} < {SEQ_RATES['repeat']} THEN 'repeat'
    WHEN {U(103)} < {SEQ_RATES['backtrack']} THEN 'backtrack' WHEN nv > 0 AND {U(104)} < {SEQ_RATES['replay']} THEN 'replay' END AS kind FROM pk)"""
SEQ_SQL = f"""SELECT event_id, session_id, row_number() OVER (PARTITION BY session_id ORDER BY event_order, ins) AS event_order, event_type, event_timestamp,
  product_id, category, page, error_types FROM (
SELECT event_id, session_id, event_order, 0 AS ins, event_timestamp, product_id, category, page,
  CASE WHEN sel_wrong_event_sequence AND {U(100)} < {SEQ_RATES['impossible']} THEN
    ['Payment Attempt', 'Checkout Start', 'Add to Cart', 'Cart View', 'Home View'][CAST(floor({U(101)} * 5) + 1 AS INTEGER)] ELSE event_type END AS event_type,
  CASE WHEN sel_wrong_event_sequence AND {U(100)} < {SEQ_RATES['impossible']} THEN ['impossible event sequence'] ELSE CAST([] AS VARCHAR[]) END AS error_types FROM kd
UNION ALL
SELECT -(k.event_id + 1), k.session_id, k.event_order, 1,
  CASE WHEN kind = 'repeat' THEN k.event_timestamp + to_seconds(CAST(1 + floor({U(105).replace('event_id', 'k.event_id')} * 10) AS BIGINT)) ELSE k.event_timestamp END,
  o.product_id, o.category, o.page, CASE WHEN kind = 'repeat' THEN o.event_type ELSE k.event_type END,
  [CASE kind WHEN 'repeat' THEN 'event repeat' WHEN 'backtrack' THEN 'random backtracking' ELSE 'replay event' END]
FROM kd k JOIN pk o ON o.session_id = k.session_id AND CASE WHEN k.kind = 'replay' THEN o.vp = k.pick ELSE o.event_order = k.pick END)"""


@query("e14_sequence_faults", VIEWS, SEQ_SQL, {**ENR, "bud": _budget_cte(), "pk": _PICKED, "kd": _KINDS})
def e14_all(t):
    """Impossible types, repeats, backtracking and replays, inserted into their sessions and numbered anew."""
    return CS.sequence_faults(CF.with_budget(_events(t), MODE), MODE, SEQ_RATES)


# the detector's input: every event, its copies at the duplicate rate, bot and orphan sessions
_DIRTY = f"""SELECT event_id * 4 AS row_id, session_id, event_timestamp, event_type, product_id, page, CAST([] AS VARCHAR[]) AS error_types FROM bud
UNION ALL SELECT event_id * 4 + 1, session_id, event_timestamp + to_seconds(CAST(1 + floor({U(32)} * 3) AS BIGINT)), event_type, product_id, page, ['duplicate event'] FROM bud
  WHERE {U(31)} < CASE prof WHEN 'clean' THEN 0.01 WHEN 'light_noise' THEN 0.03 WHEN 'moderate_noise' THEN 0.08 ELSE 0.15 END
UNION ALL SELECT event_id, session_id, event_timestamp, event_type, product_id, page, error_types FROM bots
UNION ALL SELECT event_id, session_id, event_timestamp, event_type, product_id, page, error_types FROM orphans"""
_FOUND = """SELECT d.*, list_filter([CASE WHEN gap_ms <= 3000 THEN 'duplicate event' END, CASE WHEN burst THEN 'bot traffic' END, CASE WHEN stray AND NOT burst THEN 'orphan session' END],
  lambda x: x IS NOT NULL) AS detected FROM (
 SELECT *, date_diff('millisecond', lag(event_timestamp) OVER (PARTITION BY session_id, event_type, product_id, page ORDER BY event_timestamp, row_id), event_timestamp) AS gap_ms,
  bool_or(near >= 4) OVER (PARTITION BY session_id) AS burst,
  count(*) OVER s >= 3 AND date_diff('millisecond', min(event_timestamp) OVER s, max(event_timestamp) OVER s) < 3601000
    AND NOT bool_or(event_type = 'Home View') OVER s AND NOT bool_or(event_type IN ('Payment Successful', 'Payment Failed')) OVER s AS stray
 FROM (SELECT *, count(*) OVER (PARTITION BY session_id ORDER BY event_timestamp RANGE BETWEEN INTERVAL 120 SECOND PRECEDING AND CURRENT ROW) AS near FROM dirty)
 WINDOW s AS (PARTITION BY session_id)) d"""
_DETECT = {**ENR, "bud": _budget_cte(), "bots": BOT_SQL, "orphans": ORPHAN_SQL, "dirty": _DIRTY, "found": _FOUND}


def _events(t):
    """The enriched clicks, cut: copies, bots and orphans read them again and again."""
    return cut(t, "__enriched_cut", lambda: enriched(t))


def inserted_rows(t):
    return cut(t, "__inserted_rows", lambda: _inserted_rows(t))


def _inserted_rows(t):
    b = CF.with_budget(_events(t), MODE).withColumn(ERR, F.array().cast("array<string>"))
    cols = ["session_id", "event_timestamp", "event_type", "product_id", "page", ERR]
    base = b.select((F.col("event_id") * 4).alias("row_id"), *cols)
    dup = CF.duplicate_events(b, MODE).select((F.col("event_id") * 4 + 1).alias("row_id"), *cols)
    made = CF.bot_sessions(b, MODE).select(F.col("event_id").alias("row_id"), *cols).unionByName(
        CF.orphan_sessions(_events(t), mode=MODE).select(F.col("event_id").alias("row_id"), *cols))
    return base.unionByName(dup).unionByName(made)


@query("t12_detected_sessions", VIEWS, "SELECT row_id, error_types, detected FROM found", _DETECT)
def t12_detected(t):
    """Duplicate, bot and orphan labels found from values alone, beside the injected ones."""
    return CS.detect_sessions(inserted_rows(t)).select("row_id", ERR, "detected")


@query("t12_detector_quality", VIEWS, """
SELECT label, count(*) FILTER (i) AS injected, count(*) FILTER (d) AS detected, count(*) FILTER (i AND d) AS both,
  round(count(*) FILTER (i AND d) / nullif(count(*) FILTER (i), 0), 6) AS recall, round(count(*) FILTER (i AND d) / nullif(count(*) FILTER (d), 0), 6) AS precision
FROM (SELECT label, list_contains(error_types, label) AS i, list_contains(detected, label) AS d FROM (
  SELECT *, unnest(list_distinct(list_concat(error_types, detected))) AS label FROM found)) GROUP BY 1""", _DETECT)
def t12_quality(t):
    """Recall and precision of the session detector per label."""
    return CS.detector_quality(CS.detect_sessions(inserted_rows(t)))


@query("t12_clickstreams_faults", VIEWS, None)
def t12(t):
    """The clickstream after all corruption steps, duplicates, bots and orphans."""
    return CF.dirty_clickstream(enriched(t), MODE).select("event_id", "session_id", "event_type", "event_timestamp", ERR)
