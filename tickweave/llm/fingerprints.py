"""Document fingerprints by consistent weighted sampling: equal samples are as likely as two weighted term sets are alike.

Terms are pairs of neighbouring words (the words themselves in a text of one word), weighted by their count. For each of ``SAMPLES`` positions a term draws r and c from Gamma(2, 1) and b from U(0, 1), derived from
the term alone; with t = floor(ln weight / r + b) the term with the least ln c - r (t - b) - r is the sample (Ioffe, 2010). The chance that two texts
draw the same (term, t) is their generalised Jaccard similarity, sum of minima over sum of maxima. A gamma draw is the sum of two exponential draws taken from two seeded
tables at independent hashes of the term, so no per-term generator is needed. A sample is kept as 16 bits of a hash of (term, t).

The neighbour in descending doc_id is found without sorting everything in one place: documents are dealt into id ranges (by quantiles), the largest
document of each range is also sent to the next range above, and each range is read in order.

Edge cases: null text counts as empty; empty texts have a fingerprint of their own kind, alike with each other; null doc_id sorts below all others; of rows with the same doc_id the order is
that of their texts; a single document is its own next; long texts are read whole, in slices of terms; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix, word_hashes

SAMPLES = 64
TABLE = 1 << 12
SLICE = 4096  # terms weighed at a time
DOCS_A_RANGE = 4096
MAX_RANGES = 50_000
LEAST = -(2**63)  # stands for a null id


class Sampler:
    """Fingerprints of texts; the same for the same seed everywhere."""

    def __init__(self, samples: int = SAMPLES, seed: int = 1):
        g = np.random.Generator(np.random.Philox(seed))
        self.k = samples
        self.r, self.c = (g.standard_exponential((2, TABLE, samples), dtype=np.float32) + np.float32(1e-6) for _ in range(2))
        self.b = g.random((2, TABLE, samples), dtype=np.float32)
        self.lane = mix(np.arange(samples, dtype=np.uint64), 77)

    def terms(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(text.encode(), np.uint8)
        w = word_hashes(raw, np.array([0, len(raw)]), lower=False)[0]
        if len(w) > 1:
            w = mix(mix(w[:-1], 1) + mix(w[1:], 2))
        return np.unique(w, return_counts=True)

    def draw(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """SAMPLES 16-bit samples."""
        if not len(terms):
            return np.zeros(self.k, np.uint16)
        best, which, level = np.full(self.k, np.inf, np.float32), np.zeros(self.k, np.uint64), np.zeros(self.k, np.int64)
        lanes = np.arange(self.k)
        for lo in range(0, len(terms), SLICE):
            t, s = terms[lo : lo + SLICE], np.log(weights[lo : lo + SLICE]).astype(np.float32)
            one, two = (t & np.uint64(TABLE - 1)).astype(int), (t >> np.uint64(40) & np.uint64(TABLE - 1)).astype(int)
            r, c, b = self.r[0][one] + self.r[1][two], self.c[0][one] + self.c[1][two], self.b[0][one] + self.b[1][two]
            b -= np.floor(b)
            step = np.zeros_like(r)
            more = s > 0
            step[more] = np.floor(s[more, None] / r[more] + b[more])
            a = np.log(c) - r * (step - b) - r
            at = a.argmin(0)
            low = a[at, lanes]
            better = low < best
            best, which, level = np.where(better, low, best), np.where(better, t[at], which), np.where(better, step[at, lanes].astype(np.int64), level)
        return (mix(which + mix(level.astype(np.uint64), 5) + self.lane) >> np.uint64(48)).astype(np.uint16)

    def __call__(self, text: str) -> np.ndarray:
        return self.draw(*self.terms(text))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many characters of ``following``, or all it has."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _chain(samples: int, seed: int):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, held = Sampler(samples, seed), None  # held: (range, doc_id, text, fingerprint, lent)
        for batch in batches:
            out = []
            for place, doc_id, lent, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                text = text.as_py()
                mark = sampler(text)
                if held is not None and held[0] == place:
                    changed = edited(held[2], text)
                    other = sampler(changed)
                    out.append((held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), held[3].tobytes().hex(), other.tobytes().hex(), likeness(held[3], other), likeness(held[3], mark)))
                held = None if lent else (place, doc_id, text, mark)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def fingerprints(docs: DataFrame, samples: int = SAMPLES, seed: int = 1, per_range: int = DOCS_A_RANGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = rows.count()
    # Range edges are quantiles of the ids, at most MAX_RANGES of them. Any edges give the same result.
    ids = rows.select(F.coalesce("doc_id", F.lit(LEAST)).alias("doc_id"))
    k = max(1, min(n // per_range, MAX_RANGES))
    inner = ids.agg(F.percentile_approx("doc_id", [i / k for i in range(1, k)], 20 * k)).first()[0] if k > 1 else None
    cuts = np.unique(np.array([LEAST, *(inner or [])], np.int64))

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, doc_id.to_numpy(np.int64), "right") - 1)

    tops = {r[0]: r[1] for r in ids.groupBy(range_of("doc_id").alias("place")).agg(F.max("doc_id")).collect()}
    order = sorted(tops)
    top = np.array([tops.get(p, LEAST) for p in range(len(cuts))], np.int64)
    lends_to = np.full(len(cuts), -1)
    for p, q in zip(order, order[1:] + order[:1]):
        lends_to[p] = q

    @F.pandas_udf("lent int, place int")
    def dealt(doc_id: pd.Series) -> pd.DataFrame:
        x = doc_id.to_numpy(np.int64)
        place = np.searchsorted(cuts, x, "right") - 1
        return pd.DataFrame({"lent": np.where(x == top[place], lends_to[place], -1), "place": place})

    to = rows.withColumn("d", dealt(F.coalesce("doc_id", F.lit(LEAST))))
    own = F.struct(F.col("d.place").alias("place"), F.lit(False).alias("lent"))
    copy = F.struct(F.col("d.lent").alias("place"), F.lit(True).alias("lent"))
    sent = to.select("doc_id", "text", F.explode(F.when(F.col("d.lent") >= 0, F.array(own, copy)).otherwise(F.array(own))).alias("s"))
    spread = sent.select("s.place", "doc_id", "s.lent", "text").repartition(max(1, len(cuts)), "place")
    ordered = spread.sortWithinPartitions("place", "lent", F.desc_nulls_last("doc_id"), F.desc("text"))
    return ordered.mapInArrow(_chain(samples, seed), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
