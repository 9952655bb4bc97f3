"""Symbol refresh: a running feed is restarted when the ordered universe changes."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

REFRESH_MS = 300_000


def refreshed(current: list[str], universe: DataFrame) -> list[str] | None:
    """The symbols of a universe (symbol, pos, and rank if it has one) in their order, if they are not the current ones; None for an empty universe or no change."""
    order = [c for c in ("rank", "pos") if c in universe.columns]
    found = [r["symbol"] for r in universe.select("symbol", *order).orderBy(*order).collect()]  # one row a symbol
    return found if found and found != current else None


def keep_fresh(start: Callable[[list[str]], StreamingQuery], universe: Callable[[], DataFrame], every_ms: int = REFRESH_MS, going: Callable[[], bool] = lambda: True, wait: Callable[[float], None] = time.sleep) -> list[str]:
    """Runs ``start(symbols)`` and asks for the universe every ``every_ms``; when it changes, the query is stopped after its batch and started anew (with the same checkpoint if ``start`` gives one).

    Ends when ``going`` says so, and returns the last symbols.
    """
    symbols: list[str] = []
    query = None
    while going():
        found = refreshed(symbols, universe())
        if found is not None:
            if query is not None:
                query.processAllAvailable()
                query.stop()
            symbols, query = found, start(found)
        wait(every_ms / 1000)
    if query is not None:
        query.stop()
    return symbols
