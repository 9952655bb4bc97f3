"""The corpus pipeline, stage by stage, against plain versions."""

from pyspark.sql import functions as F

import corpus_pipeline
from tickweave.llm import queries

from .test_dedup import components_brute


def test_stages_and_registration(spark, sf):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns
        kept[name] = {r["doc_id"] for r in docs.collect()}
        if name == "exact_dedup":
            best = {}
            for i, t in before.items():
                best[t] = max(best.get(t, i), i)
            assert kept[name] == set(best.values())
        if name == "ngram_jaccard_join":
            assert kept[name] == {i for i, (_, c) in components_brute(list(before.items())).items() if i == c}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == kept["mixing"]


def test_run_ends_in_pieces(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert "sequence_id" in got.columns and got.count() > 0


def words(seed, n=40):
    return " ".join(f"w{seed}x{k}" for k in range(n))


def test_near_stage_tells_rows_of_one_id_apart(spark, docs_of):
    """Rows that share an id or have none: one row of each component stays, whatever its id; rows without words all stay."""
    from tickweave.llm.similarity_join import keep_one_of_each

    near = lambda seed, k: words(seed) + f" tail{k}"
    texts = [near(1, 0), near(1, 1), near(2, 0), near(1, 2), near(2, 1), near(3, 0), near(4, 0), near(4, 1), near(5, 0), near(5, 1), "", None, " "]
    ids = [7, 7, 7, 9, 8, 1, None, None, None, 12, 7, None, 3]
    docs = docs_of(*texts, ids=ids).withColumn("cls", F.lit("x"))
    got = sorted(((r["doc_id"], r["text"]) for r in keep_one_of_each(docs).collect()), key=str)
    assert keep_one_of_each(docs).columns == docs.columns
    assert got == sorted([(7, near(1, 0)), (7, near(2, 0)), (1, near(3, 0)), (None, near(4, 0)), (12, near(5, 1)), (7, ""), (None, None), (3, " ")], key=str)


def test_stages_on_odd_rows(spark, sf, docs_of):
    """Null ids and texts, repeated rows and ids, empty texts, a very long text and a clashing column go through all five stages; an empty table gives none."""
    texts = [None, "", "a", "a", words(1), words(1), words(1) + " more", words(2, 30_000), words(3), "fine words " * 50]
    docs = docs_of(*texts, ids=[None, None, 1, 1, 2, 3, 4, 5, None, 5]).withColumn("root", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf).cache()
        if name != "packing":
            assert docs.columns == before.columns
            assert docs.exceptAll(before).isEmpty()
        if name == "ngram_jaccard_join":
            kept = sorted(r["text"] or "" for r in docs.collect())  # null counts as empty
            assert kept == sorted(["", "a", words(1), words(2, 30_000), words(3), "fine words " * 50])
    pieces = docs.collect()
    assert {r["doc_id"] for r in pieces} <= {None, 1, 2, 3, 4, 5} and all(r["length"] > 0 for r in pieces)
    docs = before.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.isEmpty()
