"""Queries over the whole span of the events: tick features without a cut, whole snapshots, backfilled history, replayed books; and coercions of the texts of a table. Each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce
from ..operators import datasets, windows
from ..operators.windows import FLOW
from ..sources.adaptor import table, trades
from . import snapshots
from .backfill import EMPTY
from .queries import _GRID, _WIDE, EV, HOUR, ORACLE_SQL, _all_ticks, query, r6
from .snapshots import COMPLETENESS_KEYS, MICRO_KEYS, SIDES

STEP = 6 * HOUR
_ALL = f"""WITH {EV}, k AS (SELECT symbol, CAST(g*{STEP} AS BIGINT) AS t FROM (SELECT DISTINCT symbol FROM ev), (SELECT unnest(range(CAST(ceil(lo/{STEP}.0) AS BIGINT), CAST(ceil(hi/{STEP}.0) AS BIGINT)+1)) AS g FROM (SELECT min(t) AS lo, max(t) AS hi FROM ev)))"""


def whole(name: str) -> str:
    """The SQL of a query over some ticks, for all of them."""
    return ORACLE_SQL[name].replace(_GRID, _ALL)


@query(whole("t1_tick_grid"))
def t1_all_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return r6(snapshots.latest_value(_all_ticks(spark, sf), trades(spark, sf), {"price": "last"}, "ageMs"))


@query(whole("t2_flow_at_ticks"))
def t2_flow_at_all_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return r6(snapshots.flow_at(_all_ticks(spark, sf), trades(spark, sf), [HOUR]).select("symbol", "t", "flowBuyQty_3600s", "flowSellQty_3600s"))


@query(whole("w3_trend_at_ticks"))
def w3_trend_at_all_ticks(spark: SparkSession, sf: str) -> DataFrame:
    x = trades(spark, sf).select("symbol", "t", "seq", "price")
    return r6(windows.trend_at(_all_ticks(spark, sf), x, "1h", HOUR).filter("trend1h IS NOT NULL"))


@query(whole("j3_w9_w10_context"))
def j3_w9_w10_context_all(spark: SparkSession, sf: str) -> DataFrame:
    return r6(datasets.context_features(_all_ticks(spark, sf), trades(spark, sf), ["view"], {"180m": 3 * HOUR}, 2 * HOUR))


_JS = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)$"
_PIECES = """SELECT event_id, props AS a, substr(props, 7, length(props) - 7) AS b, ' ' || event_id || '.50 ' AS c, CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN '-' || event_id || 'e1' WHEN 3 THEN event_id || 'd' ELSE NULL END AS d FROM events"""


@query(rf"""WITH p AS ({_PIECES}), x AS (SELECT event_id, unnest([a, b, c, d]) AS x, unnest([1, 2, 3, 4]) AS n FROM p), y AS (SELECT *, regexp_matches(trim(x), '{_JS}') AS number FROM x)
SELECT event_id, CAST(n AS INTEGER) AS n, CASE WHEN trim(x) = '' THEN 0.0 WHEN number THEN CAST(trim(x) AS DOUBLE) END AS js, CASE WHEN number THEN CAST(trim(x) AS DOUBLE) END AS py, CASE WHEN number THEN CAST(trunc(CAST(trim(x) AS DOUBLE)) AS BIGINT) END AS whole FROM y""")
def f1_f2_f3_coercions_of_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Each event's property text, the number in it, and texts made from its id."""
    e, i = table(spark, sf, "events"), F.col("event_id").cast("string")
    number = F.expr("substring(props, 7, length(props) - 7)")
    made = F.element_at(F.array(F.lit(""), F.lit("nan"), F.concat(F.lit("-"), i, F.lit("e1")), F.concat(i, F.lit("d")), F.lit(None)), (F.col("event_id") % 5 + 1).cast("int"))
    x = e.select("event_id", F.posexplode(F.array("props", number, F.concat(F.lit(" "), i, F.lit(".50 ")), made)).alias("n", "x"))
    x = x.select("event_id", (F.col("n") + 1).cast("int").alias("n"), "x")
    return x.select("event_id", "n", coerce.safe_num_js(F.col("x")).alias("js"), coerce.safe_float(F.col("x")).alias("py"), coerce.safe_int(F.col("x")).alias("whole"))


# ---- whole rows of snapshots


def _shown(name: str, expression: str) -> str:
    return f'round({expression}{" + 1e-9" if "VWAP" in name else ""}, 6) + 0.0 AS "{name}"'


def _with_deltas(base: str, doubles: list[str], longs: list[str], ages: bool, keys: str = "symbol, t", more: str = "") -> str:
    """All columns of ``base`` rounded, with their difference from the symbol's row before."""
    cols = [keys] + [_shown(n, f'"{n}"') for n in doubles] + [f'"{n}"' for n in longs]
    for n in [*doubles, *longs]:
        none = not ages and n.endswith(("AgeMs", "Completeness"))
        cols.append(f'NULL::DOUBLE AS "{n}Delta"' if none else _shown(f"{n}Delta", f'(CAST("{n}" AS DOUBLE) - lag(CAST("{n}" AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY t))'))
    return f"SELECT {', '.join(cols)}{more} FROM {base}"


def _share(keys: tuple[str, ...], have: set[str]) -> str:
    return "(" + " + ".join(f'(CASE WHEN "{k}" IS NULL THEN 0 ELSE 1 END)' if k in have else "0" for k in keys) + f") / {len(keys)}.0"


def _moves(symbol: str, at: str, w: int) -> str:
    """Prices of a symbol in the window that ends at a time."""
    return f"(SELECT list(e.price ORDER BY e.t, e.seq) FROM ev e WHERE e.symbol = {symbol} AND e.t BETWEEN {at} - {w} AND {at})"


_CHANGES = "[({0}[i+1]-{0}[i])/{0}[i]*100 FOR i IN range(1, len({0}))]"


def _vol(ps: str) -> str:
    return f"CASE WHEN len({ps}) >= 4 THEN list_aggregate({_CHANGES.format(ps)}, 'stddev_samp') END"


def _trend(last: str, ps: str, old: str) -> str:
    return f"({last} - coalesce({ps}[1], {old}[1])) / coalesce({ps}[1], {old}[1]) * 100"


def _snapshot_sql() -> str:
    windows_, trends = (HOUR, 6 * HOUR), {"5m": HOUR, "15m": 3 * HOUR}
    flows, metrics = "", {}
    for w in windows_:
        tail = f"_{w // 1000}s"
        s = lambda x: f"coalesce(sum({x}), 0)"
        flows += f""", f{tail} AS (SELECT k.symbol, k.t, {s("qty * (side = 'BUY')::INT")} AS bq, {s("qty * (side = 'SELL')::INT")} AS sq, count(CASE WHEN side = 'BUY' THEN 1 END) AS bc, count(CASE WHEN side = 'SELL' THEN 1 END) AS sc, {s("price * qty")} AS pq, {s("qty")} AS q,
            {s("price * qty * (side = 'BUY')::INT")} AS bn, {s("price * qty * (side = 'SELL')::INT")} AS sn FROM k LEFT JOIN (SELECT * FROM ev WHERE qty > 0) e ON e.symbol = k.symbol AND e.t BETWEEN k.t - {w} AND k.t GROUP BY ALL)"""
        a = f"f{tail}"
        made = (f"{a}.bq", f"{a}.sq", f"{a}.bc", f"{a}.sc", f"CASE WHEN {a}.q > 0 THEN {a}.pq / {a}.q END", f"CASE WHEN {a}.sq > 0 THEN {a}.bq / {a}.sq END", f"{a}.bq - {a}.sq", f"{a}.bn - {a}.sn")
        metrics |= {f"flow{m}{tail}": e for m, e in zip(FLOW, made)}
    metrics |= {f"agg{m}": metrics[f"flow{m}_3600s"] for m in FLOW}
    nulls = [c for n, (columns, _) in SIDES.items() for c in columns.values() if n not in ("book", "kline1m") and c != "last"] + ["basisPct"]
    nulls += [f"liq{m}{t}" for t in ("", "_3600s", "_21600s") for m in FLOW]
    values = metrics | {
        "price": "coalesce(l.bid, l.ask, l.price)", "bestBid": "l.bid", "bestAsk": "l.ask", "kline1mClose": "l.price", "kline1mVol": "l.qty", "spreadPct": "(l.ask - l.bid) / ((l.ask + l.bid) / 2) * 100",
        "imbalance": "CASE WHEN l.qty + l.qty + 1 <> 0 THEN (l.qty - (l.qty + 1)) / (l.qty + l.qty + 1) END", "bookAgeMs": "l.t - l.lt", "kline1mAgeMs": "l.t - l.lt", "flowAgeMs": "l.t - tr.lt",
        "ctx_view_price": "c.price", "ctx_view_trend_180m": _trend("c.price", "c.ps", "c.old"), "ctx_view_vol_180m": _vol("c.ps"),
    } | {n: "NULL" for n in nulls} | {age: "NULL" for n, (_, age) in SIDES.items() if n not in ("book", "kline1m", "trades")}
    for n in trends:
        values |= {f"trend{n}": _trend("l.price", f"l.ps{n}", "l.old"), f"vol{n}": _vol(f"l.ps{n}")}
    longs = [n for n in values if n.endswith("AgeMs") or "Count" in n]
    base = ", ".join(f'CAST({e} AS {"BIGINT" if n in longs else "DOUBLE"}) AS "{n}"' for n, e in values.items())
    doubles = [n for n in values if n not in longs] + ["featureCompleteness", "microCompleteness"]
    lists = ", ".join(f"{_moves('a.symbol', 'a.t', w)} AS ps{n}" for n, w in trends.items())
    return f"""{_ALL}, s AS (SELECT symbol, t, seq, price, qty, CASE WHEN seq%7<>0 THEN price-0.5 END AS bid, CASE WHEN seq%5<>0 THEN price+0.5 END AS ask FROM ev){flows},
        a AS (SELECT k.symbol, k.t, s.t AS lt, s.price, s.qty, s.bid, s.ask FROM k ASOF JOIN s ON k.symbol = s.symbol AND k.t >= s.t), l AS (SELECT a.*, {lists}, {_moves('a.symbol', 'a.lt', 1_800_000)} AS old FROM a),
        tr AS (SELECT k.symbol, k.t, e.t AS lt FROM k ASOF LEFT JOIN (SELECT * FROM ev WHERE qty > 0) e ON k.symbol = e.symbol AND k.t >= e.t),
        v AS (SELECT DISTINCT k.t, e.t AS lt, e.price FROM k ASOF LEFT JOIN (SELECT * FROM ev WHERE symbol = 'view') e ON k.t >= e.t), c AS (SELECT v.*, {_moves("'view'", 'v.t', 3 * HOUR)} AS ps, {_moves("'view'", 'v.lt', 1_800_000)} AS old FROM v),
        base AS (SELECT l.symbol, l.t, {base} FROM l JOIN f_3600s USING (symbol, t) JOIN f_21600s USING (symbol, t) JOIN tr USING (symbol, t) JOIN c ON c.t = l.t),
        snap AS (SELECT *, {_share(COMPLETENESS_KEYS, set(values))} AS "featureCompleteness", {_share(MICRO_KEYS, set(values))} AS "microCompleteness" FROM base WHERE price IS NOT NULL)
        {_with_deltas("snap", doubles, longs, False)}"""


def _backfill_sql() -> str:
    day = "OVER (PARTITION BY symbol ORDER BY t RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW)"
    values = {
        "price": "price", "kline1mClose": "price", "kline1mVol": "qty", "changePct24h": f"(price - first_value(price) {day}) / first_value(price) {day} * 100", "high24h": f"max(price + 1) {day}", "low24h": f"min(price - 1) {day}",
        "volume24h": f"nullif(sum(qty) {day}, 0)", "quoteVolume24h": f"nullif(sum(price * qty) {day}, 0)", "kline5mClose": "NULL", "kline5mVol": "NULL", "fundingRate": "fr", "nextFundingTime": "ft + 28800000", "openInterest": "NULL",
        "markPrice": "price", "indexPrice": "price", "basisPct": "0", "kline5mAgeMs": "NULL", "fundingAgeMs": "b.t - ft", "openInterestAgeMs": "NULL", "markAgeMs": "0", "stats24hAgeMs": "0", "kline1mAgeMs": "0",
    }
    for n, w in {"5m": 300_000, "15m": 900_000}.items():
        values |= {f"trend{n}": _trend("price", f"ps{n}", f"ps{n}"), f"vol{n}": _vol(f"ps{n}")}
    longs = [n for n in values if n.endswith("AgeMs")] + ["nextFundingTime"]
    doubles = [n for n in values if n not in longs] + ["featureCompleteness", "microCompleteness"]
    base = ", ".join(f'CAST({e} AS {"BIGINT" if n in longs else "DOUBLE"}) AS "{n}"' for n, e in values.items())
    empty = "".join(f', NULL::DOUBLE AS "{c}{d}"' for c in EMPTY for d in ("", "Delta"))
    return f"""WITH {EV}, bars AS (SELECT symbol, t + 59999 AS t, t AS own, price, qty FROM ev),
        b AS (SELECT bars.*, f.t AS ft, f.qty / 1e4 AS fr, {_moves('bars.symbol', 'bars.own', 300_000)} AS ps5m, {_moves('bars.symbol', 'bars.own', 900_000)} AS ps15m FROM bars ASOF JOIN ev f ON bars.symbol = f.symbol AND bars.t >= f.t),
        base AS (SELECT symbol, b.t, {base} FROM b), snap AS (SELECT *, {_share(COMPLETENESS_KEYS, set(values))} AS "featureCompleteness", {_share(MICRO_KEYS, set(values))} AS "microCompleteness" FROM base)
        {_with_deltas("snap", doubles, longs, True, more=f", 'backfill' AS source{empty}")}"""


#: The books of ``t4_depth_replay``, whose ids are sequence numbers: after a snapshot p, numbers to p + 20 are old, then those without a gap are links; from the first gap on all are held.
_BOOKS = f"""WITH RECURSIVE {EV}, x AS (SELECT symbol, t, seq, seq%97=0 AS snap, round(price) AS price, qty FROM ev),
    p AS (SELECT *, max(CASE WHEN snap THEN seq END) OVER (PARTITION BY symbol ORDER BY seq ROWS UNBOUNDED PRECEDING) AS p FROM x),
    r AS (SELECT *, NOT snap AND seq > p+20 AS ahead, count(CASE WHEN NOT snap AND seq > p+20 THEN 1 END) OVER (PARTITION BY symbol, p ORDER BY seq ROWS UNBOUNDED PRECEDING) AS nth FROM p),
    c AS (SELECT *, coalesce(ahead AND seq = p+20+nth, false) AS linked, coalesce(ahead AND seq > p+20+nth, false) AS gap FROM r),
    levels AS (SELECT c.symbol, c.seq, j.price, arg_max(j.qty, j.seq) AS q FROM c JOIN c j ON j.symbol = c.symbol AND j.p = c.p AND j.seq <= c.seq AND (j.snap OR j.linked) GROUP BY ALL HAVING q <> 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol, seq ORDER BY price DESC) AS bid, row_number() OVER (PARTITION BY symbol, seq ORDER BY price) AS ask FROM levels),
    sums AS (SELECT symbol, seq, sum(CASE WHEN bid <= 5 THEN q END) AS b, sum(CASE WHEN ask <= 5 THEN q END) AS a FROM ranked GROUP BY ALL),
    wish AS MATERIALIZED (SELECT symbol, t, seq FROM c WHERE gap OR (p IS NULL AND NOT snap)), nxt AS MATERIALIZED (SELECT w.symbol, w.seq, min(n.seq) AS after FROM wish w LEFT JOIN wish n ON w.symbol = n.symbol AND w.t + 10000 <= n.t GROUP BY ALL),
    due AS (SELECT symbol, min(seq) AS seq FROM wish GROUP BY symbol UNION ALL SELECT nxt.symbol, nxt.after FROM due JOIN nxt ON due.symbol = nxt.symbol AND due.seq = nxt.seq WHERE nxt.after IS NOT NULL)
    SELECT c.symbol, c.t, c.seq, CASE WHEN snap THEN 'snapshot' ELSE 'event' END AS kind, p IS NOT NULL AS ready, CASE WHEN p IS NULL THEN true ELSE bool_or(gap) OVER (PARTITION BY c.symbol, p ORDER BY c.seq ROWS UNBOUNDED PRECEDING) END AS stale,
    p + 20 + count(CASE WHEN linked THEN 1 END) OVER (PARTITION BY c.symbol, p ORDER BY c.seq ROWS UNBOUNDED PRECEDING) AS "lastUpdateId", CASE WHEN p IS NOT NULL THEN coalesce(b, 0.0) END AS "depthBidQty", CASE WHEN p IS NOT NULL THEN coalesce(a, 0.0) END AS "depthAskQty",
    round(CASE WHEN p IS NOT NULL AND b + a > 0 THEN (b - a) / (b + a) END, 6) + 0.0 AS "depthImbalance", CASE WHEN due.seq IS NOT NULL THEN CASE WHEN p IS NULL THEN 'not_ready' ELSE 'gap_detected' END END AS resync
    FROM c LEFT JOIN sums ON sums.symbol = c.symbol AND sums.seq = c.seq LEFT JOIN due ON due.symbol = c.symbol AND due.seq = c.seq"""

ORACLE_SQL["t4_depth_replay"] = _BOOKS
ORACLE_SQL["t2_snapshots"] = _snapshot_sql()
ORACLE_SQL["backfill_snapshots"] = _backfill_sql()
