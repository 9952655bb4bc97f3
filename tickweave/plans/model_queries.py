"""First trees of the boosted models over all trades, which SQL can find by trying every cut. Lots of zero are missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting, models
from ..sources.adaptor import trades
from .queries import EV, HOUR, query

_ROWS = f"""WITH {EV}, x AS (SELECT symbol, t, seq, price, (t//{HOUR})%24 AS hour, CASE WHEN qty>0 THEN floor(qty/10) END AS lot, CASE WHEN side='BUY' THEN 1 ELSE 0 END AS buy FROM ev)"""


def _cut_sql(target: str, value: str) -> str:
    """For the rows (k, seq, y) of ``target``: the best of all cuts of each k as (k, f, v, missing_left, lv, rv). ``y`` is centred; ``value`` is a side's value from its sum s and its rows n."""
    side = lambda s, n: value.replace("$s", s).replace("$n", n)
    return f"""{target}, long AS (SELECT seq, 1 AS f, hour AS v FROM x UNION ALL SELECT seq, 2, lot FROM x UNION ALL SELECT seq, 3, buy FROM x),
each AS (SELECT k, f, v, sum(y) AS s, count(*) AS n FROM y JOIN long USING (seq) GROUP BY k, f, v), total AS (SELECT k, f, sum(s) AS st, sum(n) AS nt, sum(CASE WHEN v IS NULL THEN s ELSE 0 END) AS sm, sum(CASE WHEN v IS NULL THEN n ELSE 0 END) AS nm FROM each GROUP BY k, f),
run AS (SELECT k, f, v, sum(s) OVER w AS s, sum(n) OVER w AS n FROM each WHERE v IS NOT NULL WINDOW w AS (PARTITION BY k, f ORDER BY v ROWS UNBOUNDED PRECEDING)),
cand AS (SELECT k, f, v, FALSE AS missing_left, s, n, st, nt FROM run JOIN total USING (k, f) UNION ALL SELECT k, f, v, TRUE, s + sm, n + nm, st, nt FROM run JOIN total USING (k, f)),
best AS (SELECT k, f, v, missing_left, {side('s', 'n')} AS lv, {side('(st-s)', '(nt-n)')} AS rv FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY s*s/n + (st-s)*(st-s)/(nt-n) DESC, f, v, missing_left) AS place FROM cand WHERE n >= 20 AND nt - n >= 20) WHERE place = 1),
leaf AS (SELECT k, x.symbol, x.t, x.seq, CASE WHEN (CASE f WHEN 1 THEN hour WHEN 2 THEN lot ELSE buy END) <= v OR ((CASE f WHEN 1 THEN hour WHEN 2 THEN lot ELSE buy END) IS NULL AND missing_left) THEN lv ELSE rv END AS add FROM best, x)"""


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    hour = F.expr(f"(t div {HOUR}) % 24")
    return trades(spark, sf).select("symbol", "t", "seq", "price", hour.alias("hour"), F.when(F.col("qty") > 0, F.floor(F.col("qty") / 10)).alias("lot"), (F.col("side") == "BUY").cast("int").alias("buy"))


_NAMES = ["hour", "lot", "buy"]


@query(f"""{_cut_sql(_ROWS + ", y AS (SELECT 0 AS k, seq, price - (SELECT avg(price) FROM x) AS y FROM x)", "$s/$n")} SELECT symbol, t, seq, round((SELECT avg(price) FROM x) + add, 3) AS prediction FROM leaf""")
def m1_first_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Prices predicted by the regression of one tree with one cut."""
    x = _rows(spark, sf)
    model, meta = models.train_regressor(x, _NAMES, "price", depth=1, rate=1.0, rounds=1, bins=255)
    return models.predict(model, meta, x).select("symbol", "t", "seq", F.round("prediction", 3).alias("prediction"))


_CLASS = "CASE WHEN price < 110 THEN 0 WHEN price < 150 THEN 1 ELSE 2 END"


@query(f"""{_cut_sql(_ROWS + f", prior AS (SELECT {_CLASS} AS k, count(*)/(SELECT count(*) FROM x)::DOUBLE AS p FROM x GROUP BY 1), y AS (SELECT k, seq, CASE WHEN {_CLASS} = k THEN 1 ELSE 0 END - p AS y FROM x, prior)", "$s/($n*(SELECT p*(1-p) FROM prior WHERE prior.k=ranked.k))").replace("place FROM cand WHERE n >= 20 AND nt - n >= 20)", "place FROM cand WHERE n >= 20 AND nt - n >= 20) AS ranked")} SELECT symbol, t, seq, {", ".join(f"round(sum(CASE WHEN k={k} THEN p*exp(add) END)/sum(p*exp(add)), 4) AS p{k}" for k in range(3))} FROM leaf JOIN prior USING (k) GROUP BY symbol, t, seq""")
def m2_first_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Probabilities of three price classes by one tree with one cut for each class."""
    x = _rows(spark, sf)
    code = F.when(F.col("price") < 110, 0).when(F.col("price") < 150, 1).otherwise(2)
    model, _ = models.train_classifier(x.withColumn("target", code), _NAMES, depth=1, rate=1.0, rounds=1, bins=255)
    return boosting.probabilities(model, x).select("symbol", "t", "seq", *[F.round(F.col("probabilities")[k], 4).alias(f"p{k}") for k in range(3)])
