"""Toxicity scores: a lexicon trie met by Levenshtein automata, context windows, and a logistic model over the hits.

The lexicon is learned from a bounded sample of labelled training documents: whole words and word stems (4 to 9 leading letters) that many toxic documents hold (1 % and three at least) and whose rate in
them is many times that in others. It is a trie; a word is matched by running the trie's Levenshtein automaton (one insertion, deletion or substitution; words of five letters or more, the
beginnings of words against stems of six or more) as a lazily built deterministic automaton whose states are sets of (trie node, edits). Terms that clean training words resemble too often are matched
exactly only, and a clean training word is never a misspelling. A hit inside paired quotation marks, or up to ``REACH`` words after a reporting word, counts as quoted; others as direct. Apostrophes
and single quotes are no quotation marks, and straight ones open before a word and close after one. A misspelled hit counts as ``MISSPELLED`` of a direct one. A logistic model on counts and
rates of direct and quoted hits gives the score.

Edge cases: null text counts as empty and gets the model's score for no hits; labels, lang, source and doc_id are never inputs; null doc_id is never a training row; an id with several
labels is toxic if one says so, and gives one training text; training passes over documents of more than ``MAX_DOC_CHARS`` characters, each by itself; without
training rows of both labels every score is the share of toxic ones (0 if there are none); long texts are read whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import smallest

MAX_TRAIN = 4_000  # documents, at most half of them toxic
MAX_DOC_CHARS = 100_000
FOLDS = 5  # rows whose crc32 modulo this is 0 are held out
TERMS = 400
SURE = 8.0  # least log rate ratio times root of documents of a term
REACH = 6
CACHE = 400_000
MARKS = ".,|?!;:()[]{}<>#$%&*\"'«»“”„‘’_~^=+/\\-"
OPENING, CLOSING = frozenset("\"“„«»"), frozenset("\"”“»«")
LONGEST_QUOTE = 60  # words
MISSPELLED = 0.7
RESEMBLED = 0.1  # clean near matches a toxic use from which on a term is matched exactly only

#: Words that report speech.
REPORTING = frozenset("said says wrote writes quote quoted called quoting sagte schrieb zitat dit écrit citation dijo escribió cita".split())


@dataclass
class Node:
    down: dict
    word: float = 0.0  # weight of the term that ends here
    stem: float = 0.0  # weight of the stem that ends here
    term: str = ""
    loose: bool = False  # whether it may be misspelled


class Lexicon:
    """The trie and its automaton. ``loose``: the terms that may be misspelled (None: all that are long enough); ``clean``: words that are no misspellings."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], loose: set[str] | None = None, clean: frozenset[str] = frozenset()):
        self.nodes, self.clean = [Node({})], clean
        for terms, kind in ((words, "word"), (stems, "stem")):
            for term, weight in terms.items():
                at = 0
                for c in term:
                    if c not in self.nodes[at].down:
                        self.nodes[at].down[c] = len(self.nodes)
                        self.nodes.append(Node({}))
                    at = self.nodes[at].down[c]
                setattr(self.nodes[at], kind, weight)
                self.nodes[at].term = term
                self.nodes[at].loose = len(term) >= (5 if kind == "word" else 6) if loose is None else term in loose
        self.states: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[float, float, str]] = []  # weight of an exact word, of a misspelled one, that term
        self.stemmed: list[tuple[float, float, str]] = []  # the same of stems
        self.start = self._state({(0, 0)})
        self.dead = self._state(set())
        self.known: dict[str, tuple[int, float] | None] = {}

    def _state(self, pairs: set) -> int:
        todo = list(pairs)
        for node, edits in todo:  # skipping a letter of the term costs one edit
            if edits == 0:
                for nxt in self.nodes[node].down.values():
                    if (nxt, 1) not in pairs:
                        pairs.add((nxt, 1))
        key = frozenset(p for p in pairs if p[1] == 0 or (p[0], 0) not in pairs)
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            for kind, out in (("word", self.found), ("stem", self.stemmed)):
                exact = max((getattr(self.nodes[n], kind) for n, e in key if e == 0), default=0.0)
                near = max(((getattr(self.nodes[n], kind), self.nodes[n].term) for n, e in key if e == 1 and self.nodes[n].loose), default=(0.0, ""))
                out.append((exact, *near))
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        out = set()
        for node, edits in self.states[state]:
            nxt = self.nodes[node].down.get(c)
            if nxt is not None:
                out.add((nxt, edits))
            if edits == 0:
                out.add((node, 1))  # one letter too many
                out.update((n, 1) for n in self.nodes[node].down.values())  # another letter
        got = self.steps[state][c] = self._state(out)
        return got

    def match(self, word: str) -> tuple[int, float, str] | None:
        """(1: exact or stem, 2: misspelled; weight; the misspelled term), or None."""
        state, stem, near, steps = self.start, 0.0, (0.0, ""), self.steps
        for c in word:
            nxt = steps[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if state == self.dead:
                break
            got = self.stemmed[state]
            stem, near = max(stem, got[0]), max(near, got[1:])
        exact, *loose = self.found[state] if state != self.dead else (0.0, 0.0, "")
        if exact > 0 or stem > 0:
            return 1, max(exact, stem), ""
        near = max(near, tuple(loose))
        return (2, *near) if near[0] > 0 and word not in self.clean else None

    def lookup(self, raw: str) -> tuple[int, float, str] | None:
        try:
            return self.known[raw]
        except KeyError:
            word = raw.strip(MARKS)
            got = self.match(word) if len(word) >= 4 else None
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[raw] = got
            return got


FEATURES = 6


def quoted_words(words: list[str]) -> np.ndarray:
    """Which words stand inside paired quotation marks: one opens at the beginning of a word and the next that closes does so at the end of one."""
    inside, opened = np.zeros(len(words), bool), None
    for n, w in enumerate(words):
        core = w.strip(MARKS)
        at = w.find(core) if core else len(w)
        before, after = w[:at], w[at + len(core) :]
        if opened is None and any(c in OPENING for c in before):
            opened = n
        if opened is not None and any(c in CLOSING for c in (after if core else before if n > opened else "")):
            if n - opened <= LONGEST_QUOTE:
                inside[opened : n + 1] = True
            opened = None
        if opened is not None and n - opened > LONGEST_QUOTE:
            opened = None
    return inside


def features(text: str, lexicon: Lexicon) -> list[float]:
    """1, count and rate of direct hits, quoted hits, summed weights, distinct terms hit directly."""
    words = text.lower().split()
    hits = {w: got for w in set(words) if (got := lexicon.lookup(w)) is not None}
    direct = quoted = weight = 0.0
    terms: dict[str, float] = {}
    if hits:
        inside = quoted_words(words)
        for n, w in enumerate(words):
            got = hits.get(w)
            if got is None:
                continue
            if inside[n] or any(x.strip(MARKS) in REPORTING for x in words[max(0, n - REACH) : n]):
                quoted += 1
                continue
            size = 1.0 if got[0] == 1 else MISSPELLED
            direct, weight = direct + size, weight + size * got[1]
            terms[got[2] or w.strip(MARKS)] = max(size, terms.get(got[2] or w.strip(MARKS), 0.0))
    n = len(words) + 10
    return [1.0, math.log1p(direct), min(5.0, 100 * direct / n), math.log1p(quoted), min(20.0, weight / 5), min(6.0, sum(terms.values()))]


def learn_lexicon(texts: list[str], toxic: list[bool], terms: int = TERMS) -> Lexicon:
    """Words and stems by how much more often they stand in toxic documents."""
    seen, docs, total = (Counter(), Counter()), (Counter(), Counter()), [0, 0]
    whole: Counter = Counter()
    for text, y in zip(texts, toxic):
        counts = Counter(w for x in text.lower().split() if len(w := x.strip(MARKS)) >= 4)
        total[y] += sum(counts.values())
        here: Counter = Counter()
        for w, c in counts.items():
            whole[w] += c
            for k in range(4, min(9, len(w)) + 1):
                here[w[:k]] += c
        seen[y].update(here)
        docs[y].update(here.keys())
    n_toxic = max(1, sum(toxic))
    least = max(3, round(0.01 * n_toxic))
    rows = []
    for s, d in docs[1].items():
        if d >= least:
            ratio = ((seen[1][s] + 0.5) / (total[1] + 1)) / ((seen[0][s] + 0.5) / (total[0] + 1))
            by_doc = ((d + 0.5) / (n_toxic + 1)) / ((docs[0][s] + 0.5) / (len(texts) - n_toxic + 1))
            if ratio >= 8 and by_doc >= 5 and math.log(ratio) * math.sqrt(d) >= SURE:
                rows.append((math.log(ratio), d, s))
    rows.sort(key=lambda r: (-r[0] * math.sqrt(r[1]), -len(r[2]), r[2]))
    words: dict[str, float] = {}
    stems: dict[str, float] = {}
    starts: dict[str, list[str]] = {}
    for w in whole:
        starts.setdefault(w[:4], []).append(w)
    for weight, _, s in rows:
        if len(words) + len(stems) >= terms:
            break
        count = seen[0][s] + seen[1][s]
        if any(s.startswith(t) or t.startswith(s) for t in (*words, *stems)):
            continue
        longer = [t for t in starts[s[:4]] if t.startswith(s) and whole[t] >= 0.8 * count]
        if longer:
            words[longer[0]] = weight
        else:
            stems[s] = weight
    # Which terms do clean words resemble?
    clean: Counter = Counter()
    for text, y in zip(texts, toxic):
        if not y:
            clean.update(w for x in text.lower().split() if len(w := x.strip(MARKS)) >= 4)
    first, resembled = Lexicon(words, stems), Counter()
    known = {w: got[2] for w in clean if (got := first.match(w)) is not None and got[0] == 2}
    for w, term in known.items():
        resembled[term] += clean[w]
    used = Counter({t: seen[1][t[:9]] for t in (*words, *stems)})
    loose = {t for t in (*words, *stems) if len(t) >= (5 if t in words else 6) and resembled[t] <= RESEMBLED * used[t] * total[0] / max(1, total[1])}
    return Lexicon(words, stems, loose, frozenset(known))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 40) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge * max(1.0, len(y) / 1000))
    pull[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * w)
        w += np.clip(step, -4, 4)
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: str) -> float:
        z = float(np.dot(self.weights, features(text, self.lexicon)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_chars: int = MAX_DOC_CHARS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model from at most ``max_train`` labelled documents (half of them toxic at most), smallest hash first; held-out rows and texts of more than ``max_chars`` characters never."""
    ids = labels.select(F.col("doc_id").alias("_id"), (F.col("toxic") == 1).alias("_toxic")).filter(F.col("_id").isNotNull() & F.col("_toxic").isNotNull() & ~held_out(F.col("_id")))
    ids = ids.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    few = [smallest(ids.filter(kind), ["_id"], max_train // 2) for kind in ("_toxic", "NOT _toxic")]
    chosen = few[0].unionByName(few[1])
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).filter(F.length("_text") <= max_chars)
    got = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "_toxic").agg(F.min("_text").alias("_text")).toPandas()  # at most max_train ids
    got = got.sort_values(["_toxic", "_id"])
    texts, toxic = list(got["_text"]), [bool(v) for v in got["_toxic"]]
    if len(set(toxic)) < 2:
        share = float(np.mean(toxic)) if toxic else 0.0
        return Model(Lexicon({}, {}), np.array([math.log((share + 1e-6) / (1 - share + 1e-6))] + [0.0] * (FEATURES - 1)))
    # The lexicon comes from one half and the weights from the other, in both ways, so that the weights don't trust the lexicon too much.
    half = np.arange(len(texts)) % 2 == 0
    x = np.zeros((len(texts), FEATURES))
    for mine in (half, ~half):
        lexicon = learn_lexicon([t for t, h in zip(texts, mine) if h], [y for y, h in zip(toxic, mine) if h])
        for n in np.flatnonzero(~mine):
            x[n] = features(texts[n], lexicon)
    # The two classes were drawn in other shares than they have; the weight of the intercept is corrected for that.
    y = np.array(toxic, float)
    counts = ids.groupBy("_toxic").count().collect()
    size = {bool(r["_toxic"]): r["count"] for r in counts}
    w = fit(x, y)
    w[0] += math.log(size[True] / y.sum()) - math.log(size[False] / (len(y) - y.sum()))
    return Model(learn_lexicon(texts, toxic), w)


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [model.score(t.as_py() or "") for t in batch.column(2)]
            p = pa.array([int(v >= 0.5) for v in s], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64()), p], names=["doc_id", "held_out", "score", "predicted"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_chars: int = MAX_DOC_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 at 0.5 or more)."""
    model = train(docs, labels, max_train, max_chars, id_col, text_col)
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return cols.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, at: float = 0.5, max_train: int = MAX_TRAIN, max_chars: int = MAX_DOC_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score under ``at``, all columns."""
    import pyarrow.compute as pc

    model = train(docs, labels, max_train, max_chars, id_col, text_col)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pc.less(pa.array([model.score(t.as_py() or "") for t in batch.column(place)], pa.float64()), at))

    return docs.mapInArrow(run, docs.schema)
