"""Exact copies, similar sets, repeated passages, against brute force."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import common
from tickweave.llm import similarity_join as sj
from tickweave.llm import substring_dedup as sd
from tickweave.llm.common import connected_components, exclusive_prefix
from tickweave.llm.exact_dedup import busiest, directory, drop_copies, exact_dedup

from .conftest import ODD


def test_directory_doubles_only_where_needed(spark):
    keys = [(-(2**63) + (5 << 60) + n,) for n in range(100)] + [((p << 60) - (2**64 if p >= 8 else 0),) for p in range(16)]
    table = spark.createDataFrame(list({k for k in keys}), "key long")
    bits, slots = directory(table, 20)
    of = {r["slot"]: r["bucket"] for r in slots.collect()}
    assert bits > 50 and len(set(of.values())) < len(of)
    held = {}
    for (k,) in set(keys):
        held.setdefault(of[(k % 2**64) >> (64 - bits)], []).append(k)
    assert max(map(len, held.values())) <= 20
    assert directory(table.limit(0), 20)[0] == 0 and directory(table.limit(15), 20)[0] == 0


def exact_brute(rows):
    best = {}
    for i, t in rows:
        best.setdefault(t or "", []).append(i)
    return best


def test_exact_on_corpus(corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    want = exact_brute(rows)
    got = exact_dedup(corpus, capacity=16).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        g = want[text[r["doc_id"]] or ""]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(g), len(g), r["doc_id"] == max(g))
        assert r["text_sha256"] == hashlib.sha256((text[r["doc_id"]] or "").encode()).hexdigest()


@pytest.mark.parametrize("how", [{"key_bits": 3, "hot": 5}, {"key_bits": 64, "hot": 2, "capacity": 2}])
def test_chains_compare_bytes(docs_of, how):
    """Keys that many texts share: chains of several links, hot or not, give the same groups."""
    texts = [f"text {n % 40}" for n in range(160)] + ["crowd"] * 300
    docs = docs_of(*texts)
    want = exact_brute(list(enumerate(texts)))
    got = exact_dedup(docs, **how).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got} == {(i, max(want[t]), len(want[t]), i == max(want[t])) for i, t in enumerate(texts)}
    assert how["key_bits"] == 64 or max(r["chain"] for r in got) > 1
    assert {r["doc_id"] for r in drop_copies(docs, **how).collect()} == {max(g) for g in want.values()}


@pytest.mark.parametrize("bound", [0, 1, 3])
def test_hot_lists_past_the_broadcast_bound(docs_of, monkeypatch, bound):
    """More hot keys than may be broadcast: the hottest alone are, and the groups are the same; rows without an id spread too."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", bound)
    texts = [f"text {n % 30}" for n in range(240)] + ["crowd"] * 400
    ids = [None if n % 7 == 0 else n for n in range(len(texts))]
    want = exact_brute(zip(ids, texts))
    docs = docs_of(*texts, ids=ids)
    got = exact_dedup(docs, hot=4).collect()
    assert len(got) == len(texts) and sum(r["kept"] for r in got) == len(want)
    for r in got:
        mine = next(g for t, g in want.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        assert (r["keep_id"], r["group_size"]) == (max(i for i in mine if i is not None), len(mine))
    assert sorted(r["doc_id"] for r in drop_copies(docs, hot=4).collect()) == sorted(max(i for i in g if i is not None) for g in want.values())
    counted = docs.groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    top = {r["text"] for r in busiest(counted, "n", 4).collect()}
    assert len(top) <= bound and (bound == 0 or top == {"crowd"})


def test_exact_odd_rows(docs_of, spark):
    docs = docs_of(*ODD, ids=[None, 1, 2, 3, 4, 5, 6, 7, 8]).unionByName(docs_of("again", "again", ids=[9, 9])).unionByName(docs_of("alone", "alone", ids=[None, None]))
    for name in ("key", "bucket", "row", "_dedup_key", "_dedup_row", "_sha2", "_first"):
        docs = docs.withColumn(name, F.lit("x"))
    got = exact_dedup(docs).collect()
    by = {(r["doc_id"], r["text_sha256"]): r for r in got}
    empty, lone = (hashlib.sha256(t.encode()).hexdigest() for t in ("", "alone"))
    assert len(got) == 13 and by[None, empty]["keep_id"] == 1 and not by[None, empty]["kept"]
    assert sorted(r["kept"] for r in got if r["doc_id"] == 9) == [False, True]
    assert sorted(r["kept"] for r in got if r["text_sha256"] == lone) == [False, True]
    assert exact_dedup(docs.limit(0)).count() == 0
    kept = drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == 9 and drop_copies(docs.limit(0)).count() == 0


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components_brute(rows):
    s = {i: sets_of(t) for i, t in rows}
    up = {i: i for i in s}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(s, 2):
        if s[a] and s[b]:
            both = len(s[a] & s[b])
            if 100 * both >= 80 * (len(s[a]) + len(s[b]) - both):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (len(s[i]), find(i)) for i in s}


def check_join(docs, **how):
    want = components_brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in sj.jaccard_join(docs, **how).collect()}
    assert got == want


def test_jaccard_on_corpus(corpus):
    check_join(corpus)


def test_jaccard_near_copies_in_blocks(docs_of):
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for n in range(60):
        w = list(base)
        for k in rng.choice(60, n % 4, replace=False):
            w[k] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(w))
    texts += [" ".join(f"u{n}_{k}" for k in range(30)) for n in range(10)]
    check_join(docs_of(*texts), block=7)


def test_jaccard_large_group_of_few_links(docs_of):
    """One candidate group by closure, joined in blocks: a chain of edits, two families of near copies, strangers with common boilerplate."""
    rng = np.random.default_rng(4)
    chain = [f"c{k}" for k in range(60)]
    texts = []
    for n in range(40):
        chain[(7 * n) % 60] = f"d{n}"
        texts.append(" ".join(chain))
    for f in range(2):
        base = [f"f{f}_{k}" for k in range(40)] + [f"c{k}" for k in range(12)]
        for n in range(50):
            w = list(base)
            for k in rng.choice(40, n % 3, replace=False):
                w[k] = f"x{rng.integers(10**6)}"
            texts.append(" ".join(w))
    boiler = [f"b{k}" for k in range(30)]
    texts += [" ".join(boiler + [f"s{n // 2}_{k}" for k in range(9 + n % 2)]) for n in range(60)]
    for block in (6, 20, 500):
        check_join(docs_of(*texts), block=block)


def test_jaccard_threshold_is_inclusive(docs_of):
    a = " ".join(f"t{k}" for k in range(12))  # 8 shingles
    check_join(docs_of(a, a + " x", a + " x y", a + " x y z", a.upper()))


def test_jaccard_odd_rows(docs_of):
    docs = docs_of(*ODD).withColumn("cls", F.lit(1)).withColumn("root", F.lit(2))
    check_join(docs)
    got = {r["doc_id"]: r for r in sj.jaccard_join(docs_of("a b c d e f", "a b c d e f", None, ids=[None, 7, 8])).collect()}
    assert got[None]["component_id"] == 7 and got[8]["component_id"] == 8 and got[8]["n_shingles"] == 0
    assert sj.jaccard_join(docs.limit(0)).count() == 0
    assert sj.keep_one_of_each(docs_of("a b c d e f", "A b c d e f", "z")).count() == 2


def test_trie_prunes_nothing_that_links():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30))).astype(np.uint64) for _ in range(80)]
    got = {frozenset(x) for x in sj.join_group(list(range(80)), [len(s) for s in sets], sets, 80)}
    up = list(range(80))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in got:
        up[find(a)] = find(b)
    for a, b in itertools.combinations(range(80), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            assert find(a) == find(b)


def test_components_and_prefix_sums(spark):
    edges = [(n, n + 1) for n in range(50)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{n: 0 for n in range(51)}, 100: 100, 101: 100, 102: 100}
    df = spark.range(100).select("id", (F.col("id") * 3 % 7).alias("v"))
    vals = [n * 3 % 7 for n in range(100)]
    assert [r["s"] for r in exclusive_prefix(df, "id", "v", "s", fan=4).orderBy("id").collect()] == [sum(vals[:n]) for n in range(100)]


def words(tag, n):
    return " ".join(f"{tag}{k}" + ("." if k % 9 == 8 else "") for k in range(n))


def test_passages_pasted_into_other_text(docs_of):
    shared = words("p", 60)
    docs = docs_of(words("a", 40) + " " + shared + " " + words("b", 40), words("c", 25) + "\n" + shared + " " + words("d", 30), words("e", 120), words("f", 80), None, "")
    got = sd.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in got} == {0, 1}
    assert {r["doc_id"] for r in got if r["removed"]} == {1}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        assert "p20" in text[r["doc_id"]][r["start"] : r["end"]]


def test_passages_without_sentence_ends_are_found_each(docs_of):
    rng = np.random.default_rng(5)
    texts, places = [], []
    for n in range(60):
        size = 51 + n % 30
        shared = [f"s{n}_{k}" + ("." if n % 3 == 0 and k in (24, 30) else "") for k in range(size)]  # at most one short whole sentence
        for side in "ab":
            fill = [f"{side}{n}_{k}" for k in range(int(rng.integers(20, 60)))]
            texts.append(" ".join([*fill, *shared, *[w + "z" for w in fill]]))
            places.append(shared)
    got = {r["doc_id"]: r for r in sd.repeated_passages(docs_of(*texts)).collect()}
    assert set(got) == set(range(120))
    for i, shared in enumerate(places):
        found = texts[i][got[i]["start"] : got[i]["end"]].split()
        assert set(found) <= set(shared) and len(found) >= len(shared) - 2 * (sd.WINDOW - 1) and got[i]["removed"] == bool(i % 2)


def test_alike_paragraphs(docs_of):
    line = words("p", 60).replace(".", "")
    docs = docs_of(line, line.replace("p30", "q30"), words("z", 50).replace(".", ""))
    got = sd.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in got} == {0, 1} and len({r["component_id"] for r in got}) == 1


@pytest.mark.parametrize("block", [500, 40])
def test_families_of_partly_alike_lines(docs_of, block):
    rng = np.random.default_rng(7)
    texts = []
    for member in rng.choice(2**9, 300, replace=False).tolist():  # neighbours, one word apart: 0.84; members at random: under 0.8
        texts.append(" ".join(f"w{k}" + ("x" if k % 6 == 3 and member >> (k // 6) & 1 else "") for k in range(60)))
    want = {i: root for i, (_, root) in components_brute(list(enumerate(texts))).items()}
    lines = [sd.word_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0] for t in texts]
    name = {int(sd.names_of(h, np.array([0]), np.array([len(h)])).view(np.int64)[0]): i for i, h in enumerate(lines)}
    got = {name[r["node"]]: r["root"] for r in sd.alike_lines(docs_of(*texts).select("text"), block=block).collect()}
    groups = lambda of: {frozenset(i for i in of if of[i] == r) for r in of.values()}
    assert groups(got) == {g for g in groups(want) if len(g) > 1}


def test_bands_are_tuned():
    bands, rows = sd.tune()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.995 and bands * rows <= sd.MINIMA


def test_passages_recall_on_corpus(corpus):
    rows = {r["doc_id"]: (r["text"] or "").split() for r in corpus.collect()}
    seen = {}
    for i, w in rows.items():
        for k in range(len(w) - 54):
            seen.setdefault(tuple(w[k : k + 55]), set()).add(i)
    want = {i for s in seen.values() if len(s) > 1 for i in s}
    got = {r["doc_id"] for r in sd.repeated_passages(corpus).collect()}
    assert len(want & got) >= 0.97 * len(want)


def spans_brute(rows, least=sd.LEAST_SPAN):
    """(doc, first word, last word) of the maximal runs of words that lie in some repeated run of ``least`` words."""
    w = {i: (t or "").lower().split() for i, t in rows}
    seen = {}
    for i, x in w.items():
        for k in range(len(x) - least + 1):
            seen.setdefault(tuple(x[k : k + least]), []).append((i, k))
    inside = {i: [False] * len(x) for i, x in w.items()}
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                inside[i][k : k + least] = [True] * least
    return {i: [list(g) for v, g in itertools.groupby(range(len(m)), key=lambda k: m[k]) if v] for i, m in inside.items()}


def test_passages_against_brute_force(corpus):
    """Each exactly repeated passage of 51 words or more lies in a span but for its torn ends; documents without 33 words on end that repeat in runs of 12 have none, alike lines apart."""
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    want, some = spans_brute(rows), {i: [g for g in groups if len(g) >= sd.LEAST_SPAN - 2 * (sd.WINDOW - 1)] for i, groups in spans_brute(rows, sd.RUN).items()}
    text, got = dict(rows), {}
    for r in sd.repeated_passages(corpus).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    for i, groups in want.items():
        at = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text[i] or "")]
        for g in groups:
            core = g[sd.WINDOW - 1 : len(g) - sd.WINDOW + 1]
            assert any(a <= at[core[0]][0] and at[core[-1]][1] <= b for a, b in got.get(i, [])), i
    extra = [i for i in got if not some[i]]
    lines = [(i, line) for i, t in rows for line in (t or "").split("\n") if len(line.split()) >= sd.LEAST_LINE]
    alike = {}
    for n, (_, c) in components_brute([(n, line) for n, (_, line) in enumerate(lines)]).items() if extra else ():
        alike.setdefault(c, set()).add(lines[n][0])
    assert set(extra) <= set().union(*(g for g in alike.values() if len(g) > 1), set())


def test_spreading_frequent_names_changes_no_span(docs_of, monkeypatch):
    rng = np.random.default_rng(8)
    common, own = words("c", 60), [" ".join(f"o{rng.integers(10**9)}" for _ in range(30)) for _ in range(40)]
    docs = docs_of(*[f"{own[n]} {common} {own[-1 - n]}" for n in range(20)], *[common] * 20, None, "")
    of = lambda: sorted(map(tuple, sd.repeated_passages(docs).collect()))
    want = of()
    for name, value in (("ONE_IN", 1), ("OFTEN", 2), ("SALTS", 7), ("BUSY", 3)):
        monkeypatch.setattr(sd, name, value)
    assert want and of() == want
    monkeypatch.setattr(sd, "BROADCAST_ROWS", 0)
    assert of() == want


def test_short_repeated_lines_are_left_alone(docs_of):
    license_ = words("l", 40)
    got = sd.repeated_passages(docs_of(*[words(f"a{n}_", 30) + "\n" + license_ + "\n" + words(f"b{n}_", 30) for n in range(30)])).collect()
    assert got == []
    longer = words("l", 51)
    got = sd.repeated_passages(docs_of(*[words(f"a{n}_", 30) + "\n" + longer + "\n" + words(f"b{n}_", 30) for n in range(3)])).collect()
    assert len(got) == 3 and sorted(r["removed"] for r in got) == [False, True, True] and {r["n_words"] for r in got} == {51} and {r["n_occurrences"] for r in got} == {3}


def test_rows_without_or_with_equal_ids_keep_their_spans(docs_of):
    shared = words("p", 60)
    texts = [words("a", 30) + " " + shared, shared + " " + words("b", 10), words("c", 80) + " " + shared]
    for ids in ([None] * 3, [5] * 3):
        got = sd.repeated_passages(docs_of(*texts, ids=ids)).collect()
        assert len(got) == 3 and sum(r["removed"] for r in got) == 2 and {r["doc_id"] for r in got} == {ids[0]}
        assert all(r["n_words"] <= 60 for r in got)


def test_passages_odd_rows(docs_of):
    docs = docs_of(*ODD).withColumn("name", F.lit("x"))
    assert {r["doc_id"] for r in sd.repeated_passages(docs).collect()} <= set(range(9))
    assert sd.repeated_passages(docs.limit(0)).count() == 0


def test_band_keys_are_of_the_minima():
    """Lines whose permutations have equal minima share a key; a line's keys do not depend on what else is in the block."""
    from tickweave.llm import substring_dedup as sd

    rng = np.random.default_rng(0)
    lines = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (16, 1, 700, 33)]
    lines.append(np.concatenate([lines[0], lines[0][::-1]]))  # the same set
    cut = np.cumsum([0, *map(len, lines)])
    got = sd.bands_of_lines(np.concatenate(lines), cut, 8, 3)
    for x, keys in zip(lines, got):
        assert (sd.bands_of_lines(x, np.array([0, len(x)]), 8, 3)[0] == keys).all()
    assert (got[0] == got[4]).all() and not (got[0] == got[3]).any()
    near = np.concatenate([lines[2][:690], rng.integers(0, 2**63, 10).astype(np.uint64)])
    assert (sd.bands_of_lines(near, np.array([0, 700]), 8, 3)[0] == got[2]).sum() >= 5
