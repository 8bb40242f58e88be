"""The corpus operators as queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .align import align_tokenizers
from .bpe import bpe_decode, bpe_encode
from .chat import rotate_perspectives
from .common import table
from .embedding import embedding_groups
from .inverted import decontaminate
from .langid import classify_language
from .line_dedup import line_dedup
from .pack import pack
from .quality import classify_quality
from .records import tokenize_to_records
from .resample import importance_resample
from .simhash import simhash_groups
from .substring import substring_dedup


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=13, one_in=20)
    n_items, digest = F.size("items").cast("long"), F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return out.select(
        "doc_id", "n_words", "n_hit", n_items.alias("n_items"), digest.alias("items_sha256"), "contaminated"
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_groups(table(spark, sf_dir, "documents"), words=3, seed=42, max_bits=3)
    return out.select("doc_id", "fingerprint", "component_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"), n=20)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op7_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.array_join(
        F.transform("mask", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"))), ","
    )
    return out.select(
        "conv_id", "speaker", "n_turns", "n_own", F.sha2("text", 256).alias("text_sha256"),
        F.sha2(spans, 256).alias("mask_sha256")
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_language(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1, window=2048, packet=128)


def op10_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tokenize_to_records(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return align_tokenizers(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"),
        keep={"groups_sha256": digest},
    ).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    out = bpe_decode(bpe_encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance_resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), orders=(1, 1), buckets=10_000, min_words=20,
        percent=10, seed=2024
    )
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_simhash": op2_simhash,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality": op6_quality,
    "op7_chat_rotation": op7_chat_rotation,
    "op8_language": op8_language,
    "op9_packing": op9_packing,
    "op10_binary_records": op10_binary_records,
    "op11_alignment": op11_alignment,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_importance_resampling": op13_importance_resampling,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": r"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
        ), item AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
        ), test AS (
            SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(words[i:i + 12], ' ') AS phrase
            FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 12, 1))) AS i FROM item WHERE
            len(words) > 0)
        ), word AS (
            SELECT doc_id, words, unnest(generate_series(1, len(words))) AS i FROM doc
        ), hit AS (
            SELECT doc_id, i, word.n, item_id
            FROM (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS phrase
                  FROM word, (SELECT DISTINCT n FROM test) WHERE i + n - 1 <= len(words)) AS word
            JOIN test ON test.n = word.n AND test.phrase = word.phrase
        ), covered AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS
            place FROM hit) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS
        n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >=
               len(words) AS contaminated
        FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op3_substring_dedup": r"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), word AS (
            SELECT doc_id, i, words[i] AS word, len(words) AS n FROM (SELECT doc_id, words, unnest(generate_series(1,
            len(words))) AS i FROM doc)
        ), coded AS (
            SELECT doc_id, list(id ORDER BY i) AS ids FROM (SELECT doc_id, i, dense_rank() OVER (ORDER BY word) AS id
            FROM word) GROUP BY doc_id
        ), window_at AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY ids[i:i + 19] ORDER BY doc_id, i) AS nth
            FROM (SELECT doc_id, ids, unnest(generate_series(1, len(ids) - 19)) AS i FROM coded)
        ), near AS (
            SELECT doc_id, i, word, coalesce(max(CASE WHEN nth > 1 THEN i END)
                   OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
            FROM word LEFT JOIN window_at USING (doc_id, i)
        ), kept AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text
            FROM near GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text,
        '')) AS kept_sha256
        FROM documents LEFT JOIN kept USING (doc_id)
    """,
    "op5_line_dedup": r"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), line AS (
            SELECT doc_id, i AS pos, lines[i] AS line,
                   translate(trim(lines[i], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM split)
        ), common AS (
            SELECT key FROM line WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.key IS NULL), '')) AS
               kept_sha256
        FROM line LEFT JOIN common USING (key) GROUP BY doc_id
    """,
    "op4_embedding_dedup": r"""
        WITH RECURSIVE sound AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT
            isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
            AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93
        ), reach AS (
            SELECT a AS vec_id, b AS other FROM link UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON
            reach.other = link.a
        ), least AS (
            SELECT vec_id, min(other) AS other FROM reach GROUP BY vec_id
        ), degree AS (
            SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a
        )
        SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
               least(vec_id, coalesce(other, vec_id)) = vec_id AS kept
        FROM embeddings LEFT JOIN degree USING (vec_id) LEFT JOIN least USING (vec_id)
    """,
    "op7_chat_rotation": r"""
        WITH turn AS (
            SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'),
                   coalesce(text, '')) AS n
            FROM conversations
        ), told AS (
            SELECT turn.*, speaker, role = speaker AS own, CASE WHEN role = 'system' THEN '<|system|>' WHEN role =
            speaker THEN '<|assistant|>'
                   ELSE concat('<|user:', role, '|>') END AS head
            FROM turn JOIN (SELECT DISTINCT conv_id, role AS speaker FROM turn WHERE role <> 'system') USING (conv_id)
        ), placed AS (
            SELECT *, sum(length(head) + 1 + length(text) + 8) OVER (PARTITION BY conv_id, speaker ORDER BY n) AS upto
            FROM told
        )
        SELECT conv_id, speaker, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
               sha256(string_agg(concat(head, chr(10), text, '<|end|>', chr(10)), '' ORDER BY n)) AS text_sha256,
               sha256(string_agg(concat(CAST(upto - length(text) - 8 AS BIGINT), '-', CAST(upto AS BIGINT)), ',' ORDER
               BY n) FILTER (WHERE own)) AS mask_sha256
        FROM placed GROUP BY conv_id, speaker
    """,
    "op13_importance_resampling": r"""
        WITH feature AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
        ), wanted AS (
            SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
        ), crc_table AS (
            SELECT list(list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN
                   xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS entry
            FROM (SELECT unnest(generate_series(0, 255)) AS n)
        ), coded AS (
            SELECT word, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
                   generate_series(1, strlen(word)), lambda i: CAST(16 * (instr('0123456789ABCDEF', hex(encode(word))[2 *
                   i - 1]) - 1) + instr('0123456789ABCDEF', hex(encode(word))[2 * i]) - 1 AS BIGINT))),
                   lambda c, b: xor(c >> 8, entry[xor(c, b) % 256 + 1]))) % 10000 AS bucket
            FROM (SELECT word FROM feature UNION SELECT word FROM wanted), crc_table
        ), held AS (
            SELECT bucket, count(*) AS s FROM feature JOIN coded USING (word) GROUP BY bucket
        ), sought AS (
            SELECT bucket, count(*) AS t FROM wanted JOIN coded USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM feature) +
                   10000.0::DOUBLE) / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM wanted) +
                   10000.0::DOUBLE)))) AS BIGINT) AS gain
            FROM (SELECT DISTINCT bucket FROM coded) LEFT JOIN held USING (bucket) LEFT JOIN sought USING (bucket)
        ), weighed AS (
            SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
            FROM feature JOIN coded USING (word) JOIN gains USING (bucket) GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) +
                   CAST(floor(-1000 * ln(-ln((CAST(concat('0x', substr(sha256(concat('2024:', doc_id)), 1, 8)) AS BIGINT)
                   + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
            FROM documents LEFT JOIN weighed USING (doc_id)
        ), ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able
            FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= able * 10 // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)
    """,
}
