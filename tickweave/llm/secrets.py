"""Secret scan: fixed patterns, and dictionary-primed zstandard novelty for strings that no pattern covers.

A candidate is a run of ``least`` (16) or more key-like characters of two classes or more (lower case, upper case, digits) whose pieces of one kind are short (``PIECE`` characters on average: words
and dates are not) and ten or more of them without ``.``, ``_`` or ``-``, with a sensitive word at most ``reach`` characters before or after it, on any line; within a block between BEGIN and END PRIVATE KEY every run counts.
Its novelty is its marginal compressed bytes per character: the growth of the zstandard frame of the text before it when it is appended, with the compressor primed by a dictionary of common
identifiers and by ``surroundings`` characters of the text on both sides, from which other copies of the candidate are taken out. Candidates of ``NOVELTY`` or more are reported as ``novel``.
Strings of one letter case without digits are never candidates: they cannot be told from words.

Edge cases: null text counts as empty; an empty text has no spans; null doc_id passes through; repeated rows get equal results; long texts are scanned whole, in time linear
in their length; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import texts_of

KINDS = ("assign", "access", "hex", "novel")
#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SENSITIVE = re.compile(r"password|passwd|secret|token|api_?key|credential|bearer|authorization|private|access", re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{12,}")
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Identifiers that prime the compressor, in lower case.
DICTIONARY = " ".join("""
password passwd secret token api key apikey access private client secret id authorization bearer credential username user name database host port
example sample default placeholder changeme your here config configuration settings environment variable export import return function class public static string value null true false
http https localhost com org net test admin root development production staging aws begin end rsa openssh certificate account service session cookie header request response
server cluster region bucket index table column field query filter result error message status update create delete insert select version release build number count total
first second last next previous current internal external global local main master branch feature module package library application component controller manager handler
factory builder provider repository document template resource process thread timeout retry connection storage backup archive directory folder file path image upload download
""".split()).encode()
NOVELTY = 0.7
LEAST = 16
REACH = 200  # characters between a candidate and a sensitive word
PIECE = 3.6
SURROUNDINGS = 4096  # characters on either side that prime the compressor
BEFORE = 64  # characters whose frame the candidate is appended to

_HEX_BYTES = np.zeros(256, bool)
_HEX_BYTES[list(b"0123456789abcdef")] = True


def rows_with_runs(raw: np.ndarray, offsets: np.ndarray, of: np.ndarray, least: int) -> np.ndarray:
    """Which texts have a run of ``least`` bytes of a class (found across text ends too: a superset)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], of[raw], [False]]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    at = start[end - start >= least]
    stop = end[end - start >= least]
    out = np.zeros(len(offsets), bool)
    if len(at):
        first, last = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, stop - 1, "right") - 1
        for a, b in zip(first, last):
            out[a : b + 1] = True
    return out[:-1]


def base_spans(text: str, hexes: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping by kind."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if hexes:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class Novelty:
    """Marginal compressed bytes per character of a string behind its surroundings; letter case does not count."""

    def __init__(self, prime: bytes = DICTIONARY):
        import zstandard as z

        self.make = lambda more: z.ZstdCompressor(level=9, dict_data=z.ZstdCompressionDict(more + prime, dict_type=z.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)

    def __call__(self, around: str, context: str, string: str) -> float:
        around, context, string = around.lower(), context.lower(), string.lower()
        zip_ = self.make(around.replace(string, " ").encode())
        context = context.replace(string, " ")
        return (len(zip_.compress((context + string).encode())) - len(zip_.compress(context.encode()))) / max(1, len(string))


def key_blocks(text: str) -> list[tuple[int, int]]:
    """Bodies of PRIVATE KEY blocks."""
    out, at = [], text.find("PRIVATE KEY-----")
    while at >= 0:
        stop = text.find("-----END", at)
        if stop < 0:
            break
        if text.rfind("-----BEGIN", max(0, at - 40), at) >= 0:
            out.append((at + 16, stop))
        at = text.find("PRIVATE KEY-----", stop + 8)
    return out


def random_looking(s: str, piece: float = PIECE) -> bool:
    kinds = any(c.islower() for c in s) + any(c.isupper() for c in s) + any(c.isdigit() for c in s)
    found = PIECES.findall(s)
    return kinds > 1 and sum(map(len, found)) <= piece * len(found) and max(map(len, re.split("[._-]", s))) >= 10


def novel_spans(text: str, taken: list[tuple[int, int, int]], novelty: Novelty, threshold: float = NOVELTY, reach: int = REACH, least: int = LEAST, surroundings: int = SURROUNDINGS) -> list[tuple[int, int, int]]:
    marks = [(m.start(), m.end()) for m in SENSITIVE.finditer(text)]
    if not marks:
        return []
    starts, blocks = [a for a, _ in marks], key_blocks(text)
    out, busy, k, b = [], sorted((a, e) for a, _, e in taken), 0, 0
    covered = 0  # base spans before this one end here at the latest
    for m in CANDIDATE.finditer(text):
        s = m.group().strip(".-")
        at = m.start() + m.group().find(s[:1]) if s else m.start()
        end = at + len(s)
        while k < len(busy) and busy[k][0] < end:
            covered = max(covered, busy[k][1])
            k += 1
        while b < len(blocks) and blocks[b][1] <= at:
            b += 1
        inside = b < len(blocks) and blocks[b][0] <= at
        if len(s) < least or covered > at or not (inside or random_looking(s)):
            continue
        n = bisect_left(starts, at)
        # a mark inside the candidate itself is no context
        near = inside or (n > 0 and at - marks[n - 1][1] <= reach) or (bisect_left(starts, end) < len(marks) and starts[bisect_left(starts, end)] - end <= reach)
        if near:
            around = text[max(0, at - surroundings) : at] + " " + text[end : end + surroundings]
            if novelty(around, text[max(0, at - BEFORE) : at], s) >= threshold:
                out.append((at, 3, end))
    return out


def _scan(how: dict):
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            raw, offsets = texts_of(batch.column(1))
            hexes, out = rows_with_runs(raw, offsets, _HEX_BYTES, 24), []
            for doc_id, text, has_hex in zip(batch.column(0).to_pylist(), batch.column(1), hexes):
                text = text.as_py() or ""
                base = base_spans(text, has_hex)
                every = sorted(base + novel_spans(text, base, novelty, **how))
                said = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
                kinds = [k for _, k, _ in every]
                out.append((doc_id, kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(said(base).encode()).hexdigest(), said(every), kinds.count(3)))
            if out:
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def scan_secrets(docs: DataFrame, threshold: float = NOVELTY, reach: int = REACH, least: int = LEAST, surroundings: int = SURROUNDINGS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (``kind:start:end``, code points), n_novel."""
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    how = {"threshold": threshold, "reach": reach, "least": least, "surroundings": surroundings}
    return cols.mapInArrow(_scan(how), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")
