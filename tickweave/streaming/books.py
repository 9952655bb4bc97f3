"""Streaming order books: the book of each symbol is the state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.book import STATES, Book, state_frame, step


def _advance(level: int, partial: bool):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        book = Book.load(state.get[0]) if state.exists else Book()
        rows = pd.concat(list(batches)).sort_values(["t", "seq"], kind="stable")
        out = [step(book, row, level, partial) for row in rows.to_dict("records")]
        state.update((book.dump(),))
        yield state_frame(out)

    return run


def book_states(events: DataFrame, level: int = 5, partial: bool = False) -> DataFrame:
    """A stream of book events and snapshots -> the state after each; rows with ``resync`` ask for a snapshot."""
    return events.groupBy("symbol").applyInPandasWithState(_advance(level, partial), STATES, "book string", "append", GroupStateTimeout.NoTimeout)
