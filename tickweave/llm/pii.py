"""Personal data: fixed patterns, and a skip-chain conditional random field that adds labels they miss.

Nodes are a document's mentions: numbers, with their groups joined over marks and single spaces up to 19 digits, so that one number is one node, and addresses with ``@`` or ``[at]``. Labels are none, email, ip,
card and phone. Node features are shape (digits, groups, marks, Luhn sum) and the words before and after. Neighbouring mentions share a transition potential; mentions of equal content
(same digits or address, however punctuated) and of similar content (one digit differs, one is the end of the other, same user of an address) share skip potentials, wherever they stand. All
potentials are fitted jointly by pseudo-likelihood; mentions in base spans keep their labels, and the others' marginals come from loopy message passing over the whole document. A mention of 4 or more digits, or with an address mark, that no
base span touches is added when its best label reaches ``ADD_AT``.

Training rows: the ``max_train`` documents with mentions that have the smallest hash (those of more than ``MAX_MENTIONS`` mentions are passed over), labelled by the base patterns. As those label
only what the patterns know, mentions are also learned in disguise (other marks between groups, no plus sign, a spelled-out ``@``), next to the original or without it, and numbers of other
kinds (dates, amounts, serial numbers) are mixed in as none. A mention equal to a labelled one takes its label; one that is only similar to it is left out.

Edge cases: null text counts as empty; null doc_id passes through; repeated rows get equal results; long texts are read whole, in linear time (atomic patterns); without training rows
nothing is added; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_cut
from .hashing import texts_of
from .secrets import rows_with_runs

KINDS = ("email", "ip", "card", "phone")
LABELS = 5
MAX_TRAIN = 2_000
MAX_MENTIONS = 2_000
ADD_AT = 0.9
ROUNDS = 10  # of message passing
#: The base patterns, written so that no run is tried twice.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]+(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]+)*", re.IGNORECASE | re.ASCII)
ADDRESS = re.compile(r"(?<!\S)[^\s@]*+@\S*+")
DIGITS = re.compile(r"[0-9]+")
GAP = re.compile(r"(?:[^\w\s]|_){0,4}(?: (?:[^\w\s]|_){0,4}){0,2}")
WORD = re.compile(r"\w+")
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True
_AT = np.zeros(256, bool)
_AT[64] = True


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if n % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1  # no later match can reach back over this mark
        at = text.find("@", max(at + 1, free))
    return out


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str, digits: bool = True, ats: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping by kind."""
    out = [(a, 0, b) for a, b in emails(text)] if ats else []
    if digits:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
        out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 14 and 14 <= len(d := only_digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(only_digits(m.group())) <= 15]
    return sorted(out)


Mention = tuple[int, int, str, str, str]  # start, end, string, word before, word after


def mentions(text: str) -> list[Mention]:
    """The numbers and addresses of a text, in order, without overlap."""
    spans = []
    for m in ADDRESS.finditer(text):
        s = m.group()
        left, right = len(s) - len(s.lstrip("\"'([{<,;:!?#$%&*|.`")), len(s.rstrip("\"')]}>,;:!?#$%&*|.`"))
        if left < right:
            spans.append((m.start() + left, m.start() + right))
    if "at]" in text.lower() or "at)" in text.lower():
        spans += [m.span() for m in SPELLED.finditer(text)]
    spans.sort()
    taken, k, free, runs = [], 0, 0, []
    for a, b in spans:
        if a >= free:
            taken.append((a, b))
            free = b
    for m in DIGITS.finditer(text):
        a, b = m.span()
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k < len(taken) and taken[k][0] < b or (a and text[a - 1].isalpha()) or text[b : b + 1].isalpha():
            continue  # part of an address or of a word
        if runs:
            first, last, size, digits = runs[-1]
            gap = text[last:a]
            if digits + b - a <= 19 and len(gap) <= 10 and GAP.fullmatch(gap) and ((b - a <= 6 and size <= 6) if " " in gap else gap != ""):
                runs[-1] = (first, b, b - a, digits + b - a)
                continue
        runs.append((a, b, b - a, b - a))
    for a, b, _, _ in runs:
        while a and text[a - 1] in "+([":
            a -= 1
        taken.append((a, b))
    out = []
    for a, b in sorted(taken):
        before, after = WORD.findall(text[max(0, a - 40) : a]), WORD.search(text, b, b + 40)
        out.append((a, b, text[a:b], before[-1].lower() if before else "", after.group().lower() if after else ""))
    return out


SHAPES, HASHED = 24, 64
FEATURES = SHAPES + 3 * HASHED
STEPS = (1, 4, 7, 10, 12, 14, 20)


def slot(s: str) -> int:
    return zlib.crc32(s.encode()) % HASHED


def shape(m: Mention) -> list[int]:
    """Indices of the features that a mention has."""
    s, groups = m[2], DIGITS.findall(m[2])
    d, address = sum(map(len, groups)), "@" in m[2] or not m[2][-1:].isdigit()
    f = [0, 1 + sum(d >= k for k in STEPS)]
    if address:
        user, _, host = address_of(s).partition("@")
        f += [9] + [10] * bool(user and host) + [11] * ("." in host.strip(".")) + [12] * ("@" not in s)
    else:
        f += [13] * s.startswith("+") + [14] * ("(" in s) + [15] * ("-" in s) + [16] * ("." in s) + [17] * (" " in s) + [18] * (len(groups) == 1)
        f += [19] * (len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)) + [20] * (14 <= d <= 19 and luhn("".join(groups))) + [21] * (10 <= d <= 15)
        f += [22] * (len(set(re.sub(r"[0-9]", "", s))) > 1) + [SHAPES + slot(".".join(str(min(len(g), 9)) for g in groups[:8]))]
    return f + [SHAPES + HASHED + slot("<" + m[3]), SHAPES + 2 * HASHED + slot(">" + m[4])]


def address_of(s: str) -> str:
    """An address in plain spelling, lower case."""
    return re.sub(r" ?[\[(]dot[\])] ?", ".", re.sub(r" ?[\[(]at[\])] ?", "@", s.lower()))


def labels_of(found: list[Mention], spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Label of each mention: that of the first span which touches it."""
    out, ends = np.zeros(len(found), int), [m[1] for m in found]
    for s, kind, e in spans:
        n = bisect_right(ends, s)
        while n < len(found) and found[n][0] < e:
            out[n] = out[n] or kind + 1
            n += 1
    return out


def design(found: list[Mention]) -> np.ndarray:
    x = np.zeros((len(found), FEATURES))
    for n, m in enumerate(found):
        x[n, shape(m)] = 1
    return x


def skips(found: list[Mention]) -> list[tuple[int, int, int]]:
    """(earlier, later, 0: equal or 1: similar content): each mention with the latest earlier one of every key it shares."""
    last: dict[tuple, int] = {}
    out = []
    for n, m in enumerate(found):
        s = m[2]
        if "@" in s or not s[-1:].isdigit():
            plain = address_of(s)
            user = plain.partition("@")[0]
            keys = [("a", plain)] + [("u", user)] * (len(user) >= 4)
        else:
            d = only_digits(s)
            keys = [("d", d)] if len(d) >= 4 else []
            if len(d) >= 7:
                keys += [("e", d[-7:])]
            if len(d) >= 10:
                keys += [("l", len(d), d[: len(d) // 2]), ("r", len(d), d[len(d) // 2 :])]
        met: dict[int, int] = {}
        for key in keys:
            j = last.get(key)
            if j is not None and j not in met:
                if key[0] in "ad":
                    met[j] = 0
                elif key[0] in "ue" or sum(x != y for x, y in zip(only_digits(found[j][2]), d)) <= 1:
                    met[j] = 1
            last[key] = n
        out += [(j, n, kind) for j, kind in met.items()]
    return out


def near_by(found: list[Mention], reach: int = 60) -> list[tuple[int, int]]:
    """Neighbouring mentions not more than ``reach`` characters apart."""
    return [(n, n + 1) for n in range(len(found) - 1) if found[n + 1][0] - found[n][1] <= reach]


def disguised(s: str, kind: int, rng: np.random.Generator) -> str:
    """The same content written as no pattern expects it."""
    groups = DIGITS.findall(s)
    if kind == 1:
        user, _, host = s.partition("@")
        return [f"{user} [at] {host}", f"{user}(at){host.replace('.', ' [dot] ')}", f"{user}@{host.partition('.')[0]}", f"{user} (at) {host.replace('.', ' (dot) ')}"][rng.integers(4)]
    if kind == 2:
        return ["[.]", "-", " . ", ",", "_"][rng.integers(5)].join(groups)
    if kind == 3:
        d = "".join(groups)
        return [".", "/", " - ", "_", ""][rng.integers(4)].join(d[k : k + 4] for k in range(0, len(d), 4))
    groups = groups if rng.random() < 0.5 or len(groups) < 3 else groups[1:]
    return ["-", ".", "/", "*** ", " - ", " "][rng.integers(6)].join(groups)


def other_number(rng: np.random.Generator) -> str:
    """A number that is no personal datum: date, time, amount, serial number."""
    n = lambda low, high: int(rng.integers(low, high))
    return [
        lambda: f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", lambda: f"{n(1, 29):02}/{n(1, 13):02}/{n(1900, 2100)}", lambda: f"{n(0, 24):02}:{n(0, 60):02}", lambda: f"{n(1, 999)},{n(0, 999):03}.{n(0, 99):02}",
        lambda: str(n(0, 10 ** n(1, 10))), lambda: f"{n(0, 20)}.{n(0, 20)}.{n(0, 20)}", lambda: str(n(10**15, 10**16)), lambda: f"{n(1, 999)} {n(1, 999)}", lambda: f"{n(1900, 2100)}-{n(1900, 2100)}", lambda: f"{n(100, 999)}-{n(10, 99)}",
    ][rng.integers(10)]()


def marginals(node: np.ndarray, edges: np.ndarray, pair: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Loopy sum-product: node log potentials (n, L), edges (m, 2), their log potentials (m, L, L) from first to second end."""
    unary = np.exp(node - node.max(1, keepdims=True))
    if not len(edges):
        return unary / unary.sum(1, keepdims=True)
    forth = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
    m = len(edges)
    # messages 0..m-1 go to the second end, m..2m-1 to the first
    to, src = np.concatenate([edges[:, 1], edges[:, 0]]), np.concatenate([edges[:, 0], edges[:, 1]])
    kernel = np.concatenate([forth, forth.transpose(0, 2, 1)])
    message = np.full((2 * m, node.shape[1]), 1 / node.shape[1])
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    for _ in range(rounds):
        logs = np.log(message + 1e-12)
        total = np.zeros_like(node)
        np.add.at(total, to, logs)
        cavity = np.log(unary[src] + 1e-12) + total[src] - logs[back]
        cavity = np.exp(cavity - cavity.max(1, keepdims=True))
        new = np.einsum("mi,mij->mj", cavity, kernel)
        message = 0.5 * message + 0.5 * new / new.sum(1, keepdims=True)
    total = np.log(unary + 1e-12)
    np.add.at(total, to, np.log(message + 1e-12))
    belief = np.exp(total - total.max(1, keepdims=True))
    return belief / belief.sum(1, keepdims=True)


class SkipChain:
    """Potentials and inference."""

    def __init__(self, weights: np.ndarray, follow: np.ndarray, same: np.ndarray, like: np.ndarray):
        self.weights, self.follow, self.skip = weights, follow, (same, like)

    @classmethod
    def fit(cls, docs: list[tuple[list[Mention], np.ndarray]], seed: int = 1, steps: int = 400, rate: float = 0.4) -> "SkipChain":
        """Maximises the pseudo-likelihood, each label given its neighbours', of all potentials together."""
        rng, xs, ys = np.random.default_rng(seed), [], []
        links: tuple[list, list, list] = ([], [], [])  # transitions, equal, similar
        at = 0
        for found, labels in docs:
            rows, y = [], []
            labels, unsure = labels.copy(), set()
            for i, j, kind in skips(found):  # what is equal to a labelled mention takes its label; what is only similar is no example
                if bool(labels[i]) != bool(labels[j]):
                    n = j if labels[i] else i
                    if kind == 0:
                        labels[n] = labels[i] or labels[j]
                    else:
                        unsure.add(n)
            for n, (m, k) in enumerate(zip(found, labels)):
                if n in unsure and not k:
                    continue
                way = rng.random()
                if k and m[2] and way < 0.5:  # in disguise, after the original or without it
                    other = (m[0], m[1], disguised(m[2], int(k), rng), m[3], m[4])
                    rows, y = (rows + [m, other], y + [k, k]) if way < 0.3 else (rows + [other], y + [k])
                else:
                    rows, y = rows + [m], y + [k]
                if rng.random() < 0.5:
                    rows, y = rows + [(m[1], m[1], other_number(rng), m[4], m[3])], y + [0]
            if not rows:
                continue
            links[0].extend((at + i, at + j) for i, j in near_by(rows))
            for i, j, kind in skips(rows):
                links[1 + kind].append((at + i, at + j))
            xs.append(design(rows))
            ys += y
            at += len(rows)
        x, seen = np.concatenate(xs), np.eye(LABELS)[np.array(ys)]
        edges = [np.array(e, int).reshape(-1, 2) for e in links]
        left, right = (np.zeros_like(seen) for _ in range(2))
        np.add.at(left, edges[0][:, 1], seen[edges[0][:, 0]])
        np.add.at(right, edges[0][:, 0], seen[edges[0][:, 1]])
        tied = []
        for e in edges[1:]:
            t = np.zeros_like(seen)
            np.add.at(t, e[:, 0], seen[e[:, 1]])
            np.add.at(t, e[:, 1], seen[e[:, 0]])
            tied.append(t)
        n, size = len(x), FEATURES
        par, speed = np.zeros((size + 3 * LABELS, LABELS)), np.zeros((size + 3 * LABELS, LABELS))
        cut = [slice(0, size)] + [slice(size + k * LABELS, size + (k + 1) * LABELS) for k in range(3)]  # node weights, transitions, equal, similar
        for _ in range(steps):
            par += 0.9 * speed
            z = x @ par[cut[0]] + left @ par[cut[1]] + right @ par[cut[1]].T + tied[0] @ par[cut[2]] + tied[1] @ par[cut[3]]
            p = np.exp(z - z.max(1, keepdims=True))
            r = seen - p / p.sum(1, keepdims=True)
            g = np.concatenate([x.T @ r, left.T @ r + (right.T @ r).T, *(t.T @ r + (t.T @ r).T for t in tied)]) / n - 5e-5 * par
            par += rate * g
            speed = 0.9 * speed + rate * g
        pairs = [par[c] for c in cut]
        return cls(*pairs)

    def __call__(self, found: list[Mention], known: np.ndarray | None = None) -> np.ndarray:
        """Marginals; mentions with a ``known`` label (not 0) keep it."""
        chain, far = near_by(found), skips(found)
        edges = np.array(chain + [(i, j) for i, j, _ in far], int).reshape(-1, 2)
        pair = np.array([self.follow] * len(chain) + [self.skip[kind] for _, _, kind in far]).reshape(-1, LABELS, LABELS)
        node = design(found) @ self.weights
        if known is not None:
            node[known > 0, known[known > 0]] += 30.0
        return marginals(node, edges, pair, ROUNDS)


def added_spans(text: str, base: list[tuple[int, int, int]], model: SkipChain | None, at: float = ADD_AT) -> list[tuple[int, int, int]]:
    found = mentions(text) if model is not None else []
    if not found:
        return []
    known = labels_of(found, base)
    open_ = (known == 0) & np.array([len(only_digits(m[2])) >= 4 or "@" in m[2] or not m[2][-1:].isdigit() for m in found])
    if not open_.any():
        return []
    p = model(found, known)
    return [(m[0], int(k) - 1, m[1]) for m, row, k, free in zip(found, p, p.argmax(1), open_) if free and k and row[k] >= at]


def _rows_of_interest(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = texts_of(column)
    return rows_with_runs(raw, offsets, _DIGITS, 1), rows_with_runs(raw, offsets, _AT, 1)


def _examples(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, h in zip(batch.column(0), batch.column(1).to_pylist()):
                text = text.as_py()
                found = mentions(text)
                if 0 < len(found) <= most:
                    out.append((h, json.dumps([found, labels_of(found, base_spans(text)).tolist()])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.string()])], names=["h", "example"])

    return run


def train(docs: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> SkipChain | None:
    """Fits on at most ``max_train`` documents that hold a number of four digits or an address mark."""
    known = docs.select(F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h")).filter(F.col("text").rlike("[0-9]{4}|@"))
    near = known.filter(F.col("h") <= F.lit(hash_cut(known.count(), 2 * max_train)))
    rows = near.mapInArrow(_examples(MAX_MENTIONS), "h long, example string").orderBy("h", "example").limit(max_train).collect()
    got = [([tuple(m) for m in found], np.array(labels)) for found, labels in (json.loads(r["example"]) for r in rows)]
    return SkipChain.fit(got) if got else None


def _scan(model: SkipChain | None, at: float):
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            digits, ats = _rows_of_interest(batch.column(1))
            out = []
            for doc_id, text, d, a in zip(batch.column(0).to_pylist(), batch.column(1), digits, ats):
                if not d and not a:
                    out.append((doc_id, 0, 0, 0, 0, nothing, "", 0))
                    continue
                text = text.as_py() or ""
                base = base_spans(text, d, a)
                more = added_spans(text, base, model, at)
                said = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
                kinds = [k for _, k, _ in base]
                out.append((doc_id, *(kinds.count(k) for k in range(4)), hashlib.sha256(said(base).encode()).hexdigest(), said(sorted(base + more)), len(more)))
            if out:
                types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def scan_pii(docs: DataFrame, max_train: int = MAX_TRAIN, at: float = ADD_AT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (``kind:start:end``, code points), n_added."""
    model = train(docs, max_train, id_col, text_col)
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(_scan(model, at), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
