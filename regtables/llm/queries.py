"""The registered queries of the operators, with the SQL that gives their rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.llm import chat_format, decontaminate, exact_dedup, language, lsh_forest, merkle, packing, quality, resampling, secret_scan, token_counts, token_files, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"))


@query(
    "op3_exact_dedup",
    """
    WITH t AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
      FROM documents
    )
    SELECT doc_id,
           max(doc_id) OVER (PARTITION BY body) AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
           sha256(body) AS text_sha256
    FROM t
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"))


@query("op8_decontaminate")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_lsh_forest")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_copies(table(spark, sf_dir, "documents"), size=3, percent=85)


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query(
    "op4_chat_format",
    """
    WITH rows AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), t AS (
      SELECT *, coalesce(role <> lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), true) AS opens,
             length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) AS n,
             length(regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) AS role_n
      FROM rows
    )
    SELECT conv_id,
           count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(n + CASE WHEN opens THEN role_n + 23 ELSE 8 END) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    more = F.explode(F.array(*(F.struct(F.lit(turn).cast("bigint").alias("turn"), F.lit(role).alias("role")) for turn, role in ((0, "user"), (1, "assistant")))))
    own = spark.range(1).select(more.alias("t")).select(F.lit(-1).cast("bigint").alias("conv_id"), "t.turn", "t.role", said.alias("text"))
    return chat_format.digests(chat_format.formatted(rows.unionAll(own)))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.revised_counts(table(spark, sf_dir, "documents"))


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


# crc32 of a text's UTF-8 bytes in SQL: the table by its rule, then a byte at a time.
_CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc"
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(hex({0})) // 2),
          lambda k: (instr('0123456789ABCDEF', substr(hex({0}), 2 * k + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(hex({0}), 2 * k + 2, 1)) - 1)),
        lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])))"""


@query(
    "op13_resampling",
    f"""
    WITH tab AS ({_CRC_TABLE}),
    words AS (
      SELECT which, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
      FROM (SELECT 's' AS which, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark)
    ), bucket AS (
      SELECT word, {_CRC.format('word')} % 10000 AS b FROM (SELECT DISTINCT word FROM words), tab
    ), counts AS (
      SELECT b, count(*) FILTER (which = 's') AS s, count(*) FILTER (which = 't') AS t FROM words JOIN bucket USING (word) GROUP BY b
    ), gains AS (
      SELECT b, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM counts
    ), weights AS (
      SELECT doc_id, count(*) AS n, sum(gain) AS w FROM words JOIN bucket USING (word) JOIN gains USING (b) WHERE which = 's' GROUP BY doc_id
    ), scored AS (
      SELECT doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(w, 0) AS BIGINT) AS weight,
             CAST(coalesce(w, 0) + floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM documents LEFT JOIN weights USING (doc_id)
    )
    SELECT doc_id, n_features AS n_words, n_features, weight, score,
           CASE WHEN n_features >= 20 AND row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id) <= 10 * count(*) FILTER (n_features >= 20) OVER () // 100
                THEN row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id) END AS rank
    FROM scored
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _levels(nodes: str, paths: str, n: int) -> str:
    """SQL that goes up a tree of three: from ``nodes``0 (tree, pos, d) and ``paths``0 (doc_id, tree, pos, d, proof) to those of level ``n``."""
    return ",".join(
        f"""
    {nodes}{k + 1} AS (
      SELECT tree, pos // 3 AS pos, CASE WHEN any_value(n) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d
      FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {nodes}{k}) GROUP BY tree, pos // 3
    ), {paths}{k + 1} AS (
      SELECT p.doc_id, p.tree, p.pos // 3 AS pos,
             CASE WHEN any_value(n.n) = 1 THEN any_value(p.d) ELSE sha256(string_agg(CASE WHEN n.pos = p.pos THEN p.d ELSE n.d END, '' ORDER BY n.pos)) END AS d,
             any_value(p.proof) || coalesce(string_agg(n.d, '' ORDER BY n.pos) FILTER (n.pos <> p.pos), '') AS proof
      FROM {paths}{k} p JOIN (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {nodes}{k}) n
        ON n.tree IS NOT DISTINCT FROM p.tree AND n.pos // 3 = p.pos // 3
      GROUP BY p.doc_id, p.tree, p.pos // 3
    )"""
        for k in range(n)
    )


_HASHED = "sha256(concat({}))".format(", ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")))


@query(
    "op12_merkle",
    f"""
    WITH tab AS ({_CRC_TABLE}),
    leaves AS (
      SELECT doc_id, source, {_HASHED.format(text='text')} AS leaf,
             {_HASHED.format(text='shown')} AS told
      FROM (SELECT d.*, CASE WHEN {_CRC.format('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown FROM documents d, tab)
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos FROM leaves
    ), n0 AS (SELECT source AS tree, pos, leaf AS d FROM placed),
    p0 AS (SELECT doc_id, source AS tree, pos, told AS d, '' AS proof FROM placed),
    {_levels('n', 'p', 12)},
    subroots AS (SELECT tree AS source, d, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos FROM n12),
    m0 AS (SELECT 1 AS tree, pos, d FROM subroots),
    q0 AS (SELECT doc_id, 1 AS tree, s.pos, p.d, proof FROM p12 p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.tree),
    {_levels('m', 'q', 8)}
    SELECT doc_id, leaf, s.d AS subroot, m.d AS root, sha256(proof) AS proof_sha256, q.d AS folded_root, q.d = m.d AS verified
    FROM placed JOIN q8 q USING (doc_id) JOIN subroots s ON s.source IS NOT DISTINCT FROM placed.source, m8 m
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    shown = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.proofs(table(spark, sf_dir, "documents"), {"text": shown})
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


@query("op11_language")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))
