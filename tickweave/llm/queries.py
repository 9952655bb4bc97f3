"""The registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .conversations import damage, repair, repaired_text
from .exact_dedup import exact_dedup
from .fill_middle import fill_in_middle, restored
from .fingerprints import fingerprints
from .mixing import mix_to_targets
from .packing import pack
from .pii import scan_pii
from .secrets import scan_secrets
from .similarity_join import jaccard_join
from .substring_dedup import repeated_passages
from .toxicity import score_toxicity
from .url_filter import url_filter
from .vector_search import top_k


def _tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), _tokenizer(), with_ids=False).drop("ids")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_to_targets(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read_table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_pii(read_table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(read_table(spark, sf_dir, "documents"))
    digests = [F.sha2(c.cast("binary"), 256).alias(n) for c, n in ((F.col("output"), "output_sha256"), (restored(F.col("output"), F.col("form")), "restored_sha256"))]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair(damage(read_table(spark, sf_dir, "conversations")))
    return rows.withColumn("repaired_sha256", F.sha2(repaired_text(F.col("repaired")).cast("binary"), 256)).drop("repaired")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_url_filter": op6_url_filter,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_secrets": op8_secrets,
    "op9_pii": op9_pii,
    "op10_fingerprints": op10_fingerprints,
    "op11_fill_middle": op11_fill_middle,
    "op12_top_k": op12_top_k,
    "op13_repair": op13_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY text)""",
    "op11_fill_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
            FROM documents
        ), drawn AS (
            SELECT doc_id, text, units, len(units) AS n, [('0x' || substr(h, 8 * k + 1, 8))::BIGINT FOR k IN range(4)] AS h FROM d
        ), cut AS (
            SELECT doc_id, text, n, units, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), parts AS (
            SELECT doc_id, text, n, form, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m, coalesce(array_to_string(units[b + 1:], ''), '') AS s FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
        FROM parts""",
    "op12_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20""",
}


def _repair_sql() -> str:
    """A way is its cost in twelve digits, then its edits, each letter naming the turn it leaves; the least string is the cheapest way and the first of those."""

    def ins(way: str, cost: object, letters: str) -> str:
        return f"(lpad((substr({way}, 1, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({way}, 13) || '{letters}')"

    return rf"""
        WITH RECURSIVE crc_table AS (
            SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, byte) ORDER BY byte) AS crc FROM range(256) t(byte)
        ), hashed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
        ), kinds AS (
            SELECT conv_id, turn, role, text,
                xor(list_reduce([ascii(x)::BIGINT FOR x IN string_split(key, '')], lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS kind
            FROM hashed, crc_table
        ), turns AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM kinds, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0
        ), placed AS (
            SELECT *, row_number() OVER w AS place, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), faults AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
            FROM placed
        ), convs AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank')::BIGINT AS blank, count_if(fault = 'duplicate')::BIGINT AS duplicate, count_if(fault = 'truncated')::BIGINT AS truncated,
                count_if(place > 1 AND before || initial NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, count(place) AS n, list({{r: role, t: text, i: initial, gone: fault IN ('blank', 'duplicate'), extra: (fault = 'truncated')::INT}} ORDER BY place) FILTER (place IS NOT NULL) AS turns
            FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f USING (conv_id) GROUP BY conv_id
        ), steps AS (
            SELECT conv_id, 0 AS k, '000000000000' AS s, NULL::VARCHAR AS y, '000000000002I' AS u, '000000000004IJ' AS a FROM convs
            UNION ALL
            SELECT conv_id, k + 1, s, y, least(u, {ins("s", 2, "I")}, {ins("y", 2, "I")}, {ins("a", 2, "I")}), least(a, {ins("u", 2, "J")}, {ins("s", 4, "IJ")}, {ins("y", 4, "IJ")})
            FROM (
                SELECT conv_id, k, {ins("s", 3, "D")} AS s, least({ins("y", 3, "D")}, CASE WHEN i = 's' AND NOT gone THEN {ins("s", "extra", "K")} END) AS y,
                    least({ins("u", 3, "D")}, CASE WHEN gone THEN NULL WHEN i = 'u' THEN least({ins("s", "extra", "K")}, {ins("y", "extra", "K")}, {ins("a", "extra", "K")})
                        ELSE least({ins("s", "extra + 2", "R")}, {ins("y", "extra + 2", "R")}, {ins("a", "extra + 2", "R")}) END) AS u,
                    least({ins("a", 3, "D")}, CASE WHEN gone THEN NULL WHEN i = 'a' THEN {ins("u", "extra", "K")} ELSE {ins("u", "extra + 2", "S")} END) AS a
                FROM (SELECT w.*, c.turns[k + 1].i AS i, c.turns[k + 1].gone AS gone, c.turns[k + 1].extra AS extra FROM steps w JOIN convs c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE k < c.n)
            )
        ), ways AS (
            SELECT c.*, substr(least(w.s, w.a), 1, 12)::BIGINT AS cost, substr(least(w.s, w.a), 13) AS edits FROM steps w JOIN convs c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND k = n
        ), split AS (SELECT *, list_concat(regexp_extract_all(edits, '[IJ]*[DKRS]'), [regexp_extract(edits, '[IJ]*$')]) AS each FROM ways)
        SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, translate(edits, 'JS', 'IR') AS audit,
            sha256(array_to_string(flatten([[CASE c WHEN 'I' THEN 'user:' WHEN 'J' THEN 'assistant:' WHEN 'K' THEN turns[k].r || ':' || turns[k].t WHEN 'R' THEN 'user:' || turns[k].t WHEN 'S' THEN 'assistant:' || turns[k].t END
                FOR c IN string_split(each[k], '')] FOR k IN range(1, n + 2)]), chr(10))) AS repaired_sha256
        FROM split"""


ORACLE_SQL["op13_repair"] = _repair_sql()
