"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from URLs that a rule labels (a bounded sample: the ``max_train`` rows with the smallest hash; both verdicts weigh the same) and judge those that no rule fits.
Features: lengths, path depth, digit ratio, character entropy, parameter count, marks, host prefix, suffix statistics and the block rate of the path's first part.
Suffix statistics are taken over all URLs, for the last one and last two labels of the host: how many URLs share the suffix (in powers of two) and how far this URL's length and
digits are from their mean. They hold no verdicts: as a rule names a suffix, a rate of verdicts by suffix would only restate it, and answer one constant for every URL of a suffix without labels. Suffixes are
counted in ``SLOTS`` hash slots, so what is sent to tasks has a fixed size. The block rate of a first path part comes from other hosts than the URL's own (five folds by host) and is drawn to
one half where it is seldom seen.

Edge cases: a null URL, or one without ``://``, has empty host and path and is judged by the trees; equal URLs get equal verdicts; null page_id passes through;
without labelled URLs, or with one label only, the trees answer that label's constant (allow if there is none); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees
from .common import smallest

Rule = tuple[str, str, str]
MAX_TRAIN = 10_000
SLOTS = 4_096  # of suffix statistics
DRAW = 20.0  # rows of one half that a first path part's block rate starts from
#: Fixed values: (verdict, host, path).
RULES: list[Rule] = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def suffix_slots(host: Column) -> list[Column]:
    """Hash slots of the last label of a host and of its last two."""
    return [F.pmod(F.xxhash64(F.lit(k), F.substring_index(host, ".", -k)), F.lit(SLOTS)).cast("int") for k in (1, 2)]


def suffix_statistics(parsed: DataFrame) -> np.ndarray:
    """(slot, [URLs, mean length, mean digits]) over all rows: ``SLOTS`` rows at most."""
    digits = F.length("url") - F.length(F.translate("url", "0123456789", ""))
    each = parsed.select(F.explode(F.array("s1", "s2")).alias("slot"), F.length("url").alias("n"), digits.alias("d"))
    out = np.zeros((SLOTS, 3))
    for r in each.groupBy("slot").agg(F.count(F.lit(1)).alias("k"), F.avg("n").alias("n"), F.avg("d").alias("d")).collect():
        out[r["slot"]] = r["k"], r["n"] or 0.0, r["d"] or 0.0
    return out


def entropy(urls: list[str]) -> np.ndarray:
    """Bits a character."""
    out = np.zeros(len(urls))
    for n, u in enumerate(urls):
        if u:
            c = np.bincount(np.frombuffer(u.encode("utf-16-le", "surrogatepass"), np.uint16))
            p = c[c > 0] / c.sum()
            out[n] = -(p * np.log2(p)).sum()
    return out


def first_part(path: str) -> str:
    return path[1:].partition("/")[0]


def fold_of(host: str) -> int:
    return zlib.crc32(host.encode("utf-8", "surrogatepass")) % 5


class Rates:
    """Block rates of first path parts, without a fold of hosts."""

    def __init__(self, parts: list[str], hosts: list[str], y: np.ndarray, weight: np.ndarray):
        self.by: dict[str, np.ndarray] = {}
        for part, host, v, w in zip(parts, hosts, y, weight):
            self.by.setdefault(part, np.zeros((2, 5)))[int(v), fold_of(host)] += w

    def __call__(self, part: str, host: str) -> float:
        got = self.by.get(part)
        if got is None:
            return 0.5
        allow, block = got.sum(1) - got[:, fold_of(host)]
        return (block + DRAW / 2) / (allow + block + DRAW)


def features(rows: pd.DataFrame, stats: np.ndarray, rates: Rates) -> np.ndarray:
    """Of columns url, host, path, s1, s2."""
    urls = [u if isinstance(u, str) else "" for u in rows["url"]]
    hosts, paths = list(rows["host"]), list(rows["path"])
    n = np.array([len(u) for u in urls], float)
    digits = np.array([sum(map(u.count, "0123456789")) for u in urls], float)
    query = [u.partition("#")[0].partition("?")[2] for u in urls]
    cols = [n, [len(h) for h in hosts], [len(p) for p in paths], [p.count("/") for p in paths], [h.count(".") for h in hosts], digits / np.maximum(n, 1), entropy(urls), [q.count("&") + bool(q) for q in query]]
    cols += [[u.count("-") for u in urls], [u.startswith("https") for u in urls], ["#" in u for u in urls], [p.endswith(".html") for p in paths], [len(q) for q in query], [h.startswith("www.") for h in hosts]]
    cols.append([rates(first_part(p), h) for p, h in zip(paths, hosts)])
    for s in ("s1", "s2"):
        k, length, of = stats[rows[s].to_numpy(int)].T
        cols += [np.round(np.log2(1 + k)), n - length, digits - of]
    return np.stack([np.asarray(c, float) for c in cols], 1) if len(urls) else np.zeros((0, 21))


def train(labelled: pd.DataFrame, stats: np.ndarray) -> tuple[BoostedTrees, Rates]:
    """Trees and rates from columns url, host, path, s1, s2, verdict."""
    y = (labelled["verdict"] == "block").to_numpy(float)
    share = y.mean() if len(y) else 0.0
    weight = np.where(y > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) if 0 < share < 1 else np.ones(len(y))
    rates = Rates([first_part(p) for p in labelled["path"]], list(labelled["host"]), y, weight)
    return BoostedTrees().fit(features(labelled, stats, rates), y, weight), rates


def url_filter(pages: DataFrame, rules: list[Rule] = RULES, max_train: int = MAX_TRAIN, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, score (the trees' probability of block; null where a rule decides)."""
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    one, two = suffix_slots(F.col("host"))
    judged = parsed.withColumns({"rule": name, "verdict": verdict, "s1": one, "s2": two})
    stats = suffix_statistics(judged)
    sample = smallest(judged.filter("rule IS NOT NULL"), ["page_id", "url"], max_train).select("url", "host", "path", "s1", "s2", "verdict").toPandas()
    model, rates = train(sample, stats)
    cut = 0.5 if len(sample) else 2.0

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            open_ = rows["rule"].isna().to_numpy()
            s = np.full(len(rows), np.nan)
            if open_.any():
                s[open_] = model.predict(features(rows[open_], stats, rates))
            rows["verdict"] = np.where(open_, np.where(s >= cut, "block", "allow"), rows["verdict"])
            rows["score"] = s
            yield rows[["page_id", "host", "path", "rule", "verdict", "score"]]

    out = judged.mapInPandas(score, "page_id long, host string, path string, rule string, verdict string, score double")
    return out.withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
