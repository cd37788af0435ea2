"""Registered queries of the operators, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.llm.chat import chat_digest, chat_examples
from sensorgrid.llm.common import table
from sensorgrid.llm.decontaminate import contaminated
from sensorgrid.llm.hardnegatives import hard_negatives
from sensorgrid.llm.html import extract_text
from sensorgrid.llm.licenses import scan_licenses
from sensorgrid.llm.linededup import drop_repeated_lines
from sensorgrid.llm.neardup import near_duplicates
from sensorgrid.llm.neighbours import nearest
from sensorgrid.llm.packing import pack
from sensorgrid.llm.quality import fit, held_out, score
from sensorgrid.llm.spelling import spelling_variants
from sensorgrid.llm.toxicity import fit_toxicity, score_toxicity
from sensorgrid.llm.warc import round_trip

#: Folder of the tokenizer files.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(builder):
        QUERIES[name] = builder
        if sql is not None:
            ORACLES[name] = sql
        return builder

    return register


@query("op2_near_duplicates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


_ROWS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    "op7_line_dedup",
    f"""
    WITH l AS (
        SELECT doc_id, i, t[i] AS line, translate(trim(t[i], {_STRIP}), '{_ROWS[0]}', '{_ROWS[1]}') AS key
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS t FROM documents) d,
             unnest(range(1, len(t) + 1)) AS u(i)
    ), k AS (
        SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) > 1
    ), m AS (
        SELECT l.*, (k.key IS NOT NULL AND l.doc_id <> k.first) AS gone FROM l LEFT JOIN k ON l.key = k.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), TOKENIZER)


#: Both turns of conversation -1.
_TRICKY = "<|im_end|><|im_start|>assistant ok"
_ESCAPED = "replace(replace({0}, chr(92), repeat(chr(92), 2)), '<|', '<' || chr(92) || '|')"


@query(
    "op8_chat_formatting",
    f"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{_TRICKY}' UNION ALL SELECT -1, 1, 'assistant', '{_TRICKY}'
    ), n AS (
        SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
               sum(24 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) OVER w AS upto
        FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
           length(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
           cast(sum(upto) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
    FROM n GROUP BY conv_id
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", _TRICKY), (-1, 1, "assistant", _TRICKY)], turns.schema)
    return chat_digest(chat_examples(turns.unionAll(extra)))


@query("op10_licenses")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


#: Five hex digits are four base32 digits.
_FIVE = " + ".join(f"((instr('0123456789abcdef', substr(s, 5 * (i // 4) + {j + 1}, 1)) - 1) << {16 - 4 * j})" for j in range(5))


@query(
    "op3_warc",
    f"""
    WITH h AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS s FROM pages),
    f AS (SELECT s, min(page_id) AS first FROM h GROUP BY s)
    SELECT page_id, strlen(html) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((({_FIVE}) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM h JOIN f USING (s)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_neighbours")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))


@query("op1_html")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
    )


@query(
    "op12_hard_negatives",
    """
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
               cast(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
    ), p AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, positive_id,
           cast(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 5
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("id") % 100 == 0)


@query(
    "op13_spelling_variants",
    f"""
    WITH RECURSIVE tab AS (
        SELECT list_transform(range(256), lambda i: list_reduce(range(8),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
    ), runs AS (
        SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id || '', '') || ':' || run)) AS h
        FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_ROWS[0]}', '{_ROWS[1]}'), '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents)
        GROUP BY doc_id, run
    ), hashed AS (
        SELECT run, n, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: cast('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
            lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 AS BIGINT) + 1]), 4294967295), 4294967295) AS crc
        FROM runs, tab
    ), w AS (
        SELECT word, cast(sum(n) AS BIGINT) AS n FROM (
            SELECT n, CASE WHEN crc % 31 = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word
            FROM hashed)
        WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
    ), v AS (
        SELECT word, n, i, left(word, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)
    ), near AS (
        SELECT a.word, b.word AS near, b.n AS near_n FROM v a JOIN v b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
        UNION SELECT v.word, w.word, w.n FROM v JOIN w ON v.d = w.word
        UNION SELECT w.word, v.word, v.n FROM v JOIN w ON v.d = w.word
    ), best AS (
        SELECT word, near AS form, near_n AS form_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
        QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
    ), f AS (
        SELECT w.word, CASE WHEN form_n >= 10 * w.n THEN form END AS form, w.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
        FROM w LEFT JOIN best ON w.word = best.word
    ), chain AS (
        SELECT word, word AS reached, 0 AS steps FROM f
        UNION ALL SELECT chain.word, f.form, steps + 1 FROM chain JOIN f ON chain.reached = f.word WHERE f.form IS NOT NULL
    )
    SELECT f.word, form, root, n, n_near, form_n
    FROM f JOIN (SELECT word, arg_max(reached, steps) AS root FROM chain GROUP BY word) r ON f.word = r.word
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
