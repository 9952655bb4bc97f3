"""A backtest works its candidates out once, however often it reads them."""

import os
import uuid

from tickweave.operators import backtest


def test_candidates_are_worked_out_once(spark, tmp_path):
    seen = str(tmp_path)

    def mark(batches):
        open(os.path.join(seen, uuid.uuid4().hex), "w").close()
        yield from batches

    data = [("A", t, t, 10, 1.0, 0.5, 0.5, -0.5) for t in range(0, 100, 3)]
    rows = spark.createDataFrame(data, "symbol string, entryTime bigint, seq bigint, horizonMs bigint, prediction double, returnPct double, longReturnPct double, shortReturnPct double")
    rows = rows.coalesce(1).mapInArrow(mark, rows.schema)
    assert [r["entryTime"] for r in backtest.run_backtest(rows, 0.5).orderBy("entryTime").collect()] == list(range(0, 100, 12))
    assert len(os.listdir(seen)) == 1
