"""Fill-in-the-middle, top-k search and conversation repair against brute force and SQL."""

import glob
import hashlib
import os
import random
import re
import sys
import zlib
from functools import lru_cache

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import conversations as cv
from tickweave.llm import fill_middle as fm
from tickweave.llm import queries
from tickweave.llm import vector_search as vs

from .conftest import ODD

TABLES = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_top_k", "op13_repair"])
@pytest.mark.parametrize("tables", TABLES)
def test_query_matches_sql(spark, tables, name):
    con = duckdb.connect()
    for path in glob.glob(f"{tables}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got, want = queries.QUERIES[name](spark, tables), con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(want.columns)
    text = lambda v: "NULL" if v is None or v != v else str(int(v)) if isinstance(v, float) else str(v)
    rows = lambda found: sorted(tuple(text(v) for v in r) for r in found)
    assert rows(tuple(r) for r in got.select(cols).collect()) == rows(want.select(", ".join(cols)).fetchall())


# ---- fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def rearranged(doc_id, text):
    h = [int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check_middles(docs):
    got = fm.fill_in_middle(docs).withColumn("back", fm.restored(F.col("output"), F.col("form"))).collect()
    want = [(r["doc_id"], *rearranged(r["doc_id"], r["text"] or ""), r["text"] or "") for r in docs.collect()]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    return got


def test_middles_of_the_corpus(corpus):
    forms = [r["form"] for r in check_middles(corpus)]
    assert {"plain", "psm", "spm"} == set(forms)


def test_middles_of_odd_texts(docs_of):
    rng = random.Random(3)
    bits = ["<", "<P", "<P>", ">", "<<S>", "<S", "P>", " ", "\t\n", "\x0b\x0c\r", "é", "你好", "😀", "\x00", "\x1c", "\x85", " ", "\xa0", "ab", "<X>", "a.b"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    docs = docs_of(*ODD, *texts, "😀 " * 300_000, ids=[None, None, 5, 5, *range(4, len(ODD) + len(texts) + 1)]).withColumn("output", F.lit("x"))
    got = check_middles(docs)
    assert sum(r["form"] != "plain" for r in got) > 100
    assert fm.fill_in_middle(docs.limit(0)).count() == 0


def test_automaton_forgets(docs_of):
    """After ``memory`` bytes the state does not depend on where it began; lanes of any number give the events of one."""
    a = fm.Automaton()
    classes = [ord(c) for c in "< P>xé"] + [0x80, 0xC3, 255]
    for one in classes:
        for two in classes:
            seen = {int(a.next[a.next[s * 256 + one] + two]) for s in range(a.NAMED + 1)}
            assert len(seen) == 1
    raw = np.random.default_rng(0).choice(np.array(classes, np.uint8), 50_000)
    plain, state = np.empty(len(raw), np.uint8), 0
    for k, b in enumerate(raw.tolist()):
        plain[k], state = a.emits[state + b], int(a.next[state + b])
    assert (a.events(raw) == plain).all()


# ---- search


def brute_top(rows, k, every):
    out = []
    for i, (q, v) in enumerate(rows):
        if q is not None and v is not None and q % every == 0:
            score = lambda c: sum(x * y for x, y in zip(v, c))
            all_ = sorted((-score(c), n is None, n or 0) for j, (n, c) in enumerate(rows) if j != i and c is not None)
            out += [(q, r + 1, None if none else n, -s) for r, (s, none, n) in enumerate(all_[:k])]
    return sorted(map(str, out))


def whole(v):
    if not v or any(x is None or x != x or abs(x) == float("inf") for x in v):
        return None
    return [int(np.floor(x * 64.0)) for x in v]


def check_top(spark, rows, k=3, every=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = vs.top_k(df, k=k, every=every)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == brute_top([(i, whole(v)) for i, v in rows], k, every)


def test_search_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vs, "SHARD", 16)
    monkeypatch.setattr(vs, "BLOCK", 7)
    monkeypatch.setattr(vs, "RUN", 2)
    monkeypatch.setattr(vs, "FAN", 2)
    rng = np.random.default_rng(1)
    odd = [(0, None), (5, []), (10, [1.0, None]), (15, [float("nan"), 1.0]), (20, [float("inf"), 0.0]), (None, [0.5, 0.5]), (None, None), (25, [0.5, 0.5]), (25, [0.5, 0.5]), (25, [0.1, -0.9]), (-5, [0.7]), (30, [0.1, 0.2, 0.3])]
    ties = [(100 + n, [0.25, -0.5]) for n in range(120)]  # a third of the rows are one vector
    rest = [(300 + n, rng.normal(size=2).tolist()) for n in range(180)]
    check_top(spark, odd + ties + rest)
    check_top(spark, [(n, [float(rng.integers(-(2**24), 2**24)), 1.0]) for n in range(60)])  # doubles are too short
    check_top(spark, [(0, [1.0]), (5, [2.0])], k=20)
    check_top(spark, [(5, [1.0])])
    assert vs.top_k(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")).count() == 0
    assert vs.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for top in (2, 2**10, 2**20, 2**30, 2**45):
        q, c = (rng.integers(-top, top, (9, 33)).astype(float) for _ in range(2))
        want = [[max(-(2**63) + 1, min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(a, b)))) for b in c] for a in q]
        assert [[int(x) for x in r] for r in vs.products(q, c)] == want


# ---- conversations


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


sys.setrecursionlimit(20_000)


def mended(turns):
    """From the end backwards: of all edits from a turn and a state on, the cheapest and then the first."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
    seen, faults = set(), []
    for _, role, text in turns:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(k, state, left):
        ways = [(0, "", ())] if k == len(turns) and state in ("", "a") else []
        for c in "ua" if left else "":
            if (state, c) in step:
                cost, letters, kept = best(k, step[state, c], left - 1)
                ways.append((cost + 2, "I" + letters, (({"u": "user", "a": "assistant"}[c], ""), *kept)))
        if k < len(turns):
            _, role, text = turns[k]
            cost, letters, kept = best(k + 1, state, 2)
            ways.append((cost + 3, "D" + letters, kept))
            if faults[k] not in ("blank", "duplicate"):
                for letter, c, name, extra in (("K", role[:1], role, 0), ("R", "u", "user", 2), ("R", "a", "assistant", 2)):
                    if (state, c) in step:
                        cost, letters, kept = best(k + 1, step[state, c], 2)
                        ways.append((cost + extra + (faults[k] == "truncated"), letter + letters, ((name, text), *kept)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    cost, audit, kept = best(0, "", 2)
    numbers = [t for t, *_ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in kept))


def check_repair(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit("x"))
    got = cv.repair(cv.damage(df)).withColumn("digest", F.sha2(cv.repaired_text(F.col("repaired")).cast("binary"), 256)).drop("repaired")
    want = [(conv, *mended(turns)) for conv, turns in damaged(rows).items()]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_repair_against_brute_force(spark):
    rng = random.Random(5)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "u", "sx"], ["Yes.", "No", "ok?  ", " \t", "", None, "Hm!\n", "a.b", "x. ", "x.\x85", "é。", "Go. "]
    rows = []
    for c in range(500):
        for t in range(rng.randint(1, 12)):
            text = rng.choice(texts)
            rows.append((c if c else None, rng.choice([t, t, t, t + 3, None, 2]), rng.choice(roles), f"{text or ''}{rng.randint(0, 3)}." if rng.random() < 0.5 else text))
    check_repair(spark, rows)


def test_long_conversations_are_folded_in_slices(spark, monkeypatch):
    monkeypatch.setattr(cv, "LONG", 5)
    monkeypatch.setattr(cv, "SLICE", 3)
    rng = random.Random(6)
    check_repair(spark, [(c, t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a", "b.", "c!", "d?", ""]) + str(rng.randint(0, 40)) + rng.choice(["", "."])) for c in range(60) for t in range(rng.randint(1, 30))])


def test_one_long_conversation(spark):
    """Conversations beyond one slice: 300 faulty turns, 3,000 sound ones; and an empty table."""
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{t} " + "x" * 1000 + rng.choice([".", ""])) for t in range(300)]
    check_repair(spark, rows)
    many = spark.range(3000).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat(id, repeat('x', 1000), '.') AS text")
    r = cv.repair(many).collect()[0]
    assert (r["cost"], r["audit"], len(r["repaired"])) == (0, "K" * 3000, 3000)
    assert cv.repair(cv.damage(many.limit(0))).count() == 0
