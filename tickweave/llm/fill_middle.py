"""Fill-in-the-middle documents: a table-driven byte automaton finds units and sentinels in one scan, a second pass locates the cuts.

A unit is a run of white space with the word after it, or white space at the end of the text. The automaton reads UTF-8 bytes of many documents as one string, each ended by byte 255, which
no UTF-8 text has. Its transitions emit three events: a code point begins (not on continuation bytes), a unit ends before this byte, a sentinel ends with this byte. What it is in depends on
the last ``Automaton.memory`` bytes alone, so a block of bytes is cut into lanes that start that many bytes early and go through the tables side by side. Counts of events give units and characters of each
document; the cut after unit k is where the k-th unit event stands.

Where the cuts lie and which form a document takes are drawn from SHA-256 of ``seed:doc_id``: equal on every run and every machine. No shuffle; a task holds a block of documents, or one long one.

Edge cases: null and empty text, and text that holds a sentinel, stay plain; a null id is drawn as an empty one; rows with equal ids are drawn alike; a prefix, middle or suffix may be empty; texts are read whole;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
END = 255
CHAR, UNIT, MARK = 1, 2, 4  # events
BLOCK = 1 << 22
LANES = 4096
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Automaton:
    """States, and for each state and byte the next state and the events."""

    START, GAP, WORD, OPEN, NAMED = range(5)  # at the start; in white space; in a word, in it after "<", and after the letter behind that
    memory = 2

    def __init__(self) -> None:
        n = self.NAMED + 1
        to, emits = np.full((n, 256), self.WORD, np.int64), np.full((n, 256), CHAR, np.uint8)
        emits[:, 0x80:0xC0] = 0
        white = [0x20, *range(0x09, 0x0E)]
        to[:, white] = self.GAP
        emits[self.WORD :, white] |= UNIT
        to[:, ord("<")] = self.OPEN
        to[self.OPEN, [ord(s[1]) for s in (PREFIX, SUFFIX, MIDDLE)]] = self.NAMED
        emits[self.NAMED, ord(">")] |= MARK
        to[:, END] = self.START
        emits[:, END] = UNIT
        emits[self.START, END] = 0
        self.next, self.emits = (to * 256).astype(np.uint16).ravel(), emits.ravel()

    def events(self, raw: np.ndarray) -> np.ndarray:
        """The events at each byte of documents that are each ended by ``END``."""
        steps = max(64, -(-len(raw) // LANES))
        lanes = -(-len(raw) // steps)
        padded = np.full(self.memory + lanes * steps, END, np.uint8)
        padded[self.memory : self.memory + len(raw)] = raw
        first = np.arange(lanes) * steps
        at = np.full(lanes, self.WORD * 256, np.uint16)
        for k in range(self.memory):
            at = self.next[at + padded[first + k]]
        columns = np.ascontiguousarray(padded[self.memory :].reshape(lanes, steps).T)
        out = np.empty((steps, lanes), np.uint8)
        for k in range(steps):
            place = at + columns[k]
            out[k] = self.emits[place]
            at = self.next[place]
        return np.ascontiguousarray(out.T).ravel()[: len(raw)]


@dataclass(frozen=True)
class Draw:
    """How often and in which form documents are rearranged: percent of documents, and of those percent in suffix-first form."""

    seed: int = 42
    rate: int = 50
    suffix_first: int = 80

    def __call__(self, doc_id: int | None, n: int, whole: bool) -> tuple[str, int, int]:
        """(form, units before the first cut, units before the second cut) of a document of n units; ``whole`` ones stay plain."""
        digest = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
        h = [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]
        if whole or h[2] % 100 >= self.rate:
            return "plain", 0, 0
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        return ("spm" if h[3] % 100 < self.suffix_first else "psm"), a, b


def _rearranged(ids: list, texts: list[bytes], draw: Draw, automaton: Automaton) -> pa.RecordBatch:
    raw = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    events = automaton.events(raw)
    ends = np.cumsum([len(t) + 1 for t in texts])
    units = np.flatnonzero(events & UNIT)  # where each unit of the block ends
    upto = np.searchsorted(units, ends - 1, "right")  # units of the block up to each document's end
    marks = np.searchsorted(np.flatnonzero(events & MARK), ends)
    rows = []
    for k, (doc_id, text) in enumerate(zip(ids, texts)):
        start, before = (int(ends[k - 1]), int(upto[k - 1])) if k else (0, 0)
        n = int(upto[k]) - before
        form, *cuts = draw(doc_id, n, not text or marks[k] > (marks[k - 1] if k else 0))
        if form == "plain":
            rows.append((doc_id, n, form, None, None, text.decode()))
            continue
        a, b = (int(units[before + c - 1]) - start if c else 0 for c in cuts)
        chars = [int(np.count_nonzero(events[start + i : start + j] & CHAR)) for i, j in ((0, a), (a, b))]
        prefix, middle, suffix = (x.decode() for x in (text[:a], text[a:b], text[b:]))
        output = PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle if form == "psm" else SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
        rows.append((doc_id, n, form, *chars, output))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def fill_in_middle(docs: DataFrame, draw: Draw = Draw(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """Per document: its units, form, lengths of prefix and middle in characters (null if plain), and the rearranged text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                held += len(texts[-1])
                if held >= BLOCK:
                    yield _rearranged(ids, texts, draw, automaton)
                    ids, texts, held = [], [], 0
            if ids:
                yield _rearranged(ids, texts, draw, automaton)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    return rows.mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text before it was rearranged. Texts that hold sentinels are plain, so the three of a rearranged one are its own."""
    part = F.split(output, "<[PSM]>")
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
