"""Seeded fault injection (E01-E18) and per-table fault plans.

Every random choice of the source is a hash of (row key, step seed), so a
faulted table is a pure function of its input: it repeats at any
partitioning and after a lost executor.  Two draw modes: ``xxhash``
(default) and ``arith`` (an integer hash that SQL engines can reproduce,
used by the oracle-tested queries).  Each step is a column expression;
duplicates are a filtered copy unioned back, so nothing leaves the
executors.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil, exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislekit.operators.profile import ERR, with_error_types

MAX_ERRORS_PER_ROW = 4
MOD = 1000003

# Session noise profiles with weights, duplicate and bot
# rates per profile, and the Poisson mean of the corruption budget.
SESSION_PROFILES = [("clean", 0.65), ("light_noise", 0.2), ("moderate_noise", 0.1), ("heavy_corruption", 0.05)]
DUP_PROB = {"clean": 0.01, "light_noise": 0.03, "moderate_noise": 0.08, "heavy_corruption": 0.15}
BOT_PROB = {"clean": 0.0, "light_noise": 0.01, "moderate_noise": 0.12, "heavy_corruption": 0.25}
# Fields a missing-field fault may blank, in order.
MISSING_FIELDS = ["product_id", "category", "scroll_depth", "location", "cart_content", "cart_size",
                  "event_timestamp", "event_order", "event_type", "page", "device_category"]
IMPOSSIBLE_EVENTS = ["Payment Attempt", "Checkout Start", "Add to Cart", "Cart View", "Home View"]
BOT_EVENTS = [("Home View", 10), ("Search View", 25), ("Category View", 20), ("Product View", 40), ("Cart View", 5)]
MID_FUNNEL_EVENTS = ["Product View", "Add to Cart", "Cart View", "Search View", "Category View", "Checkout Start", "Payment Attempt"]


def arith_u_sql(key_sql: str, seed: int) -> str:
    """SQL text of the ``arith`` draw (same digits as ``draw``)."""
    return (f"(CAST('0x' || substr(md5(CAST(({key_sql}) AS VARCHAR) || '|{seed}'), 1, 12) AS BIGINT)"
            " / CAST(281474976710656 AS DOUBLE))")


def _digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")).cast("binary"))


def draw(key: Column, seed: int, mode: str = "xxhash") -> Column:
    """Uniform [0, 1) from (key, seed).  ``arith``: the first 12 hex digits of
    an md5 of the whole key and the seed, which SQL engines reproduce; keys
    of any distance draw independently."""
    if mode == "arith":
        return F.conv(F.substring(_digest(key, seed), 1, 12), 16, 10).cast("long").cast("double") / F.lit(2.0 ** 48)
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(MOD)).cast("double") / MOD


def drawn_under(key: Column, seed: int, rate: float, mode: str = "xxhash") -> Column:
    """``draw(key, seed, mode) < rate``, without making a number of every digest.

    Digits of equal length are ordered like the numbers they spell, so an
    ``arith`` digest is under the rate if it sorts before the rate's digits.
    """
    if mode != "arith":
        return draw(key, seed, mode) < rate
    n = ceil(rate * 2.0 ** 48)
    return _digest(key, seed) < F.lit("g" if n >= 1 << 48 else f"{max(n, 0):012x}")


def under_cap(errors: Column, cap: int = MAX_ERRORS_PER_ROW) -> Column:
    return F.size(F.array_distinct(errors)) < cap


def add_error(errors: Column, cond: Column, label: str, cap: int = MAX_ERRORS_PER_ROW) -> Column:
    """Add ``label`` once where ``cond`` holds and the row is under the cap."""
    ok = F.coalesce(cond, F.lit(False)) & under_cap(errors, cap)
    return F.when(ok & ~F.array_contains(errors, F.lit(label)), F.concat(errors, F.array(F.lit(label)))).otherwise(errors)


def inject_nulls(df: DataFrame, col: str, rate: float, label: str, key: Column, seed: int,
                 mask: Column | None = None, mode: str = "xxhash") -> DataFrame:
    """Null ``col`` on rows of ``mask`` under the cap with draw < rate."""
    d = with_error_types(df)
    m = F.coalesce(mask, F.lit(False)) if mask is not None else F.lit(True)
    d = d.withColumn("__hit", m & drawn_under(key, seed, rate, mode) & under_cap(F.col(ERR)))  # few rows come to the cap
    hit = F.col("__hit")
    return (d.withColumn(col, F.when(hit, F.lit(None)).otherwise(F.col(col))).withColumn(ERR, add_error(F.col(ERR), hit, label))
            .drop("__hit"))


def inject_whitespace(df: DataFrame, col: str, rate: float, label: str, key: Column, seed: int,
                      mode: str = "xxhash") -> DataFrame:
    """Non-null text under the cap with draw < rate gets one of: two
    leading spaces, three trailing spaces, upper case, lower case."""
    d = with_error_types(df)
    d = d.withColumn("__hit", F.col(col).isNotNull() & drawn_under(key, seed, rate, mode) & under_cap(F.col(ERR)))
    hit = F.col("__hit")
    k = F.floor(draw(key, seed + 1, mode) * 4)
    s = F.col(col).cast("string")
    distorted = (F.when(k == 0, F.concat(F.lit("  "), s)).when(k == 1, F.concat(s, F.lit("   ")))
                 .when(k == 2, F.upper(s)).otherwise(F.lower(s)))
    return (d.withColumn(col, F.when(hit, distorted).otherwise(s))
            .withColumn(ERR, add_error(F.col(ERR), hit, label)).drop("__hit"))


def corrupt_values(df: DataFrame, col: str, rate: float, label: str, value: Column, key: Column, seed: int,
                   mask: Column | None = None, mode: str = "xxhash") -> DataFrame:
    """Sampled value fault: rows of ``mask`` with draw < rate take ``value``
    (whatever the cap); the label is added only under the cap (E01)."""
    d = with_error_types(df)
    m = F.coalesce(mask, F.lit(False)) if mask is not None else F.lit(True)
    d = d.withColumn("__hit", m & drawn_under(key, seed, rate, mode))
    hit = F.col("__hit")
    return (d.withColumn(col, F.when(hit, value).otherwise(F.col(col))).withColumn(ERR, add_error(F.col(ERR), hit, label))
            .drop("__hit"))


def messy_terms(df: DataFrame, term: str, key: Column, mode: str = "xxhash") -> DataFrame:
    """``messy``, one of six seeded edits of a search term, and ``op``, which one.

    0 a mark at the end, 1 every a doubled, 2 the last letter lost, 3 the
    letters in another order, 4 one to five blanks, 5 three to ten random
    letters.  Terms too short for an edit stay.
    """
    x, n = F.col(term), F.length(term)
    op = F.floor(draw(key, 201, mode) * 6).cast("int")
    at = lambda i: F.concat_ws("-", key.cast("string"), i.cast("string"))
    letters = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(draw(at(i), 203, mode).alias("u"), i.alias("i"), F.substring(x, i, 1).alias("c")))
    shuffled = F.array_join(F.transform(F.array_sort(letters), lambda s: s["c"]), "")
    random_letters = F.array_join(F.transform(F.sequence(F.lit(1), (3 + F.floor(draw(key, 204, mode) * 8)).cast("int")),
                                              lambda i: F.chr((97 + F.floor(draw(at(i), 205, mode) * 26)).cast("long"))), "")
    mark = F.element_at(F.array(F.lit("!"), F.lit("??"), F.lit(".")), (F.floor(draw(key, 202, mode) * 3) + 1).cast("int"))
    messy = (F.when(op == 0, F.concat(x, mark)).when(op == 1, F.replace(x, F.lit("a"), F.lit("aa")))
             .when(op == 2, F.when(n > 1, F.substring(x, F.lit(1), n - 1)).otherwise(x)).when(op == 3, F.when(n > 2, shuffled).otherwise(x))
             .when(op == 4, F.repeat(F.lit(" "), (1 + F.floor(draw(key, 204, mode) * 5)).cast("int"))).otherwise(random_letters))
    return df.select("*", messy.alias("messy"), op.alias("op"))


def duplicate_rows(df: DataFrame, rate: float, label: str, key: Column, seed: int, mode: str = "xxhash") -> DataFrame:
    """Rows with draw < rate are copied; copies carry ``label`` (not
    capped).  Rate mode: no global count or sort is needed, and a row and
    its copy come out of one pass over ``df``."""
    d = with_error_types(df)
    one, two = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
    d = d.select("*", F.explode(F.when(drawn_under(key, seed, rate, mode), two).otherwise(one)).alias("__copy"))
    labelled = F.when(F.col("__copy") & ~F.array_contains(F.col(ERR), F.lit(label)), F.concat(F.col(ERR), F.array(F.lit(label))))
    return d.withColumn(ERR, labelled.otherwise(F.col(ERR))).drop("__copy")


def session_profile(key: Column, seed: int = 11, mode: str = "xxhash") -> Column:
    """Session noise profile from the cumulative weights."""
    u = draw(key, seed, mode)
    expr, acc = None, 0.0
    for name, w in SESSION_PROFILES:
        acc += w
        expr = F.when(u < acc, name) if expr is None else expr.when(u < acc, name)
    return expr.otherwise(SESSION_PROFILES[-1][0])


def poisson_quantile(u: Column, mean: float, max_k: int = 20) -> Column:
    """Inverse CDF of Poisson(mean) at u (table built from the formula)."""
    if mean <= 0:
        return F.lit(0)
    expr, cdf = None, 0.0
    for k in range(max_k + 1):
        cdf += exp(-mean) * mean ** k / factorial(k)
        expr = F.when(u < cdf, k) if expr is None else expr.when(u < cdf, k)
    return expr.otherwise(max_k)


def corruption_budget(profile: Column, key: Column, seed: int = 12, mode: str = "xxhash") -> Column:
    """Clean 0, else Poisson draw with the profile's mean (1, 2, 4)."""
    u = draw(key, seed, mode)
    return (F.when(profile == "clean", 0).when(profile == "light_noise", poisson_quantile(u, 1))
            .when(profile == "moderate_noise", poisson_quantile(u, 2)).otherwise(poisson_quantile(u, 4)))


@dataclass
class Step:
    kind: str                 # null | ws | set | dup
    col: str | None
    rate: float
    label: str
    value: object = None      # callable(u: Column) -> Column, for "set"
    mask: object = None       # callable() -> Column
    sql_value: str | None = None   # oracle text, "{u}" is the draw
    sql_mask: str | None = None
    extra: dict = field(default_factory=dict)


def apply_plan(df: DataFrame, steps: list[Step], key: str, mode: str = "xxhash", seed0: int = 100) -> DataFrame:
    """Tn: apply the steps in order (step i uses seed seed0 + 10 i)."""
    d = with_error_types(df)
    k = F.col(key)
    for i, s in enumerate(steps):
        seed = seed0 + 10 * i
        mask = s.mask() if s.mask is not None else None
        if s.kind == "null":
            d = inject_nulls(d, s.col, s.rate, s.label, k, seed, mask, mode)
        elif s.kind == "ws":
            d = inject_whitespace(d, s.col, s.rate, s.label, k, seed, mode)
        elif s.kind == "set":
            d = corrupt_values(d, s.col, s.rate, s.label, s.value(draw(k, seed + 1, mode)), k, seed, mask, mode)
        elif s.kind == "dup":
            d = duplicate_rows(d, s.rate, s.label, k, seed, mode)
        elif s.kind == "flag":
            d = d.withColumn(ERR, add_error(F.col(ERR), mask, s.label))
        elif s.kind == "swap":
            other = s.extra["with"]
            m = F.coalesce(mask, F.lit(False)) if mask is not None else F.lit(True)
            d = d.withColumn("__hit", m & drawn_under(k, seed, s.rate, mode))
            hit = F.col("__hit")
            d = d.select(*[F.when(hit, F.col(other)).otherwise(F.col(c)).alias(c) if c == s.col else
                           F.when(hit, F.col(s.col)).otherwise(F.col(c)).alias(c) if c == other else F.col(c)
                           for c in d.columns])
            d = d.withColumn(ERR, add_error(F.col(ERR), hit, s.label)).drop("__hit")
        else:
            raise ValueError(s.kind)
    return d


def detect(df: DataFrame, rules: list[tuple[str, object]]) -> DataFrame:
    """Detector: a fresh ``error_types`` holding the label of every rule
    whose predicate (a callable returning a Column) is true on the row."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(r(), F.lit(False)), F.lit(lbl)) for lbl, r in rules]))
    return df.withColumn("detected", found)


def plan_sql(table: str, steps: list[Step], key: str, columns: list[str], seed0: int = 100) -> tuple[dict, str]:
    """Oracle: the same step list written as DuckDB CTEs (arith draws)."""
    def u(seed: int) -> str:
        return arith_u_sql(key, seed)

    def add(cond: str, label: str) -> str:
        return (f"CASE WHEN coalesce({cond}, false) AND len(list_distinct(error_types)) < {MAX_ERRORS_PER_ROW} "
                f"AND NOT list_contains(error_types, '{label}') THEN list_append(error_types, '{label}') ELSE error_types END")

    ctes = {f"{table}_s0": f"SELECT *, CAST([] AS VARCHAR[]) AS error_types FROM {table}"}
    prev = f"{table}_s0"
    for i, s in enumerate(steps):
        seed = seed0 + 10 * i
        name = f"{table}_s{i + 1}"
        m = f"coalesce({s.sql_mask}, false)" if s.sql_mask else "true"
        cap = f"len(list_distinct(error_types)) < {MAX_ERRORS_PER_ROW}"
        if s.kind == "null":
            hit = f"({m} AND {cap} AND {u(seed)} < {s.rate})"
            body = f"SELECT * REPLACE (CASE WHEN {hit} THEN NULL ELSE {s.col} END AS {s.col}, {add(hit, s.label)} AS error_types) FROM {prev}"
        elif s.kind == "ws":
            hit = f"({s.col} IS NOT NULL AND {cap} AND {u(seed)} < {s.rate})"
            k = f"floor({u(seed + 1)} * 4)"
            dist = (f"CASE WHEN {k} = 0 THEN '  ' || CAST({s.col} AS VARCHAR) WHEN {k} = 1 THEN CAST({s.col} AS VARCHAR) || '   ' "
                    f"WHEN {k} = 2 THEN upper(CAST({s.col} AS VARCHAR)) ELSE lower(CAST({s.col} AS VARCHAR)) END")
            body = f"SELECT * REPLACE (CASE WHEN {hit} THEN {dist} ELSE CAST({s.col} AS VARCHAR) END AS {s.col}, {add(hit, s.label)} AS error_types) FROM {prev}"
        elif s.kind == "set":
            hit = f"({m} AND {u(seed)} < {s.rate})"
            val = s.sql_value.format(u=u(seed + 1))
            body = f"SELECT * REPLACE (CASE WHEN {hit} THEN {val} ELSE {s.col} END AS {s.col}, {add(hit, s.label)} AS error_types) FROM {prev}"
        elif s.kind == "dup":
            body = (f"SELECT * FROM {prev} UNION ALL SELECT * REPLACE (CASE WHEN list_contains(error_types, '{s.label}') THEN error_types "
                    f"ELSE list_append(error_types, '{s.label}') END AS error_types) FROM {prev} WHERE {u(seed)} < {s.rate}")
        elif s.kind == "flag":
            body = f"SELECT * REPLACE ({add(s.sql_mask, s.label)} AS error_types) FROM {prev}"
        elif s.kind == "swap":
            other = s.extra["with"]
            hit = f"({m} AND {u(seed)} < {s.rate})"
            body = (f"SELECT * REPLACE (CASE WHEN {hit} THEN {other} ELSE {s.col} END AS {s.col}, "
                    f"CASE WHEN {hit} THEN {s.col} ELSE {other} END AS {other}, {add(hit, s.label)} AS error_types) FROM {prev}")
        else:
            raise ValueError(s.kind)
        ctes[name] = body
        prev = name
    return ctes, prev
