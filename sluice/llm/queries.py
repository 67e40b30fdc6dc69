"""The registered queries of the numbered operators; each derives its contract's columns from its operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import centroids, chat_format, decontaminate, line_dedup, lm_score, packing, quality_rules, rule_classifier, simhash_dedup, substring_dedup, token_files, toxicity, whitening
from sluice.llm.common import new_folder, remove_folder, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("_removed").cast("long").alias("n_removed"), F.col("_removed").alias("removed_lines"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_dedup.groups(table(spark, sf_dir, "documents"), shingle=3, max_distance=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    fold = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    out = lm_score.score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), trains=~fold(), class_col="lang")
    return out.select("doc_id", fold().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))))).alias("x"))
    own = own.select(F.lit(-1).cast("long").alias("conv_id"), "x.turn", "x.role", F.lit("</s>[INST] ok [/INST]").alias("text"))
    chats = chat_format.format_chats(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own))
    turns = chat_format.parse_chats(F.col("formatted"))
    read = chats.withColumns({"_turns": turns, "_loss": chat_format.loss_text(F.col("segments"))})
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, x.turn, x.role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(turn, role)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM rows
), moves AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY k) AS before,
    length(replace(replace(replace(replace(replace(role || chr(0) || text, '&', '&amp;'), '<s>', '&lt;s>'), '</s>', '&lt;/s>'), '[INST]', '&lsqb;INST]'), '[/INST]', '&lsqb;/INST]')) + 21 AS chars
  FROM numbered
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user' WHEN before = 'user' THEN role = 'assistant' ELSE before = 'assistant' AND role = 'user' END)
    AND max_by(role, k) = 'assistant' AS valid
FROM moves GROUP BY conv_id
"""


def op6_rule_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    out = rule_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), trains=~fold())
    return out.select("doc_id", fold().alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.score(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_cols=["doc_id"])
    failed = quality_rules.base_failed()
    return scored.select(
        "doc_id",
        *(F.col(f"_{n}").alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= 0.5)).alias("kept"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )


OP5_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(2, len(w) - 8)), lambda i: array_to_string(w[i:i + 9], ' '))) AS k, least(10, len(w)) AS n
  FROM items WHERE len(w) > 0
), lengths AS (
  SELECT DISTINCT n FROM windows
), starts AS (
  SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {'i': i, 'k': array_to_string(w[i:i + n - 1], ' ')})) AS s
  FROM words, lengths WHERE len(w) >= n
), hits AS (
  SELECT doc_id, s.i AS i, y.n AS n, item_id FROM starts x JOIN windows y ON y.n = x.n AND y.k = x.s.k
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.cut_repeats(table(spark, sf_dir, "documents"), length=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda i: {'i': i, 'k': md5_number(array_to_string(w[i:i + 12], ' '))})) AS s
  FROM words WHERE len(w) >= 13
), firsts AS (
  SELECT s.k AS k, min(doc_id) AS first FROM windows GROUP BY s.k
), gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(s.i, s.i + 13)))) AS p
  FROM windows JOIN firsts ON firsts.k = windows.s.k WHERE doc_id > first GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(p), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN p IS NULL THEN array_to_string(w, ' ') ELSE coalesce(array_to_string(list_filter(list_transform(w, lambda x, i: CASE WHEN list_contains(p, i) THEN NULL ELSE x END), lambda x: x IS NOT NULL), ' '), '') END) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def packing_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations under three limits that differ: up to the first answer, text bears no loss."""
    import public_tokenizers

    chats = chat_format.format_chats(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    at = F.array_position(F.transform("segments", lambda s: s["loss"]), F.lit(True)).cast("int")
    said = chats.select("conv_id", F.transform("segments", lambda s: s["text"]).alias("s"), F.when(at > 0, at - 1).otherwise(F.size("segments")).alias("k"))
    parts = said.select("conv_id", F.array_join(F.slice("s", F.lit(1), F.col("k")), "").alias("lead"), F.array_join(F.slice("s", F.col("k") + 1, F.size("s")), "").alias("text"))
    limits = packing.Limits(tokens=2048, segments=12, loss_tokens=1536)
    return packing.pack(parts, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, id_col="conv_id", prompt_text_col="lead", limits=limits)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, factor=256, salt="2:")
    text = F.array_join(F.transform("centroid", lambda c: c.cast("string")), ",")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(text, 256).alias("centroid_sha256"))


def _op11_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """The rounds one after the other, on (row, dimension) rows."""
    parts = [
        f"""kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"x AS MATERIALIZED (SELECT r, unnest(range({dims})) AS i, unnest(v) AS x FROM kept)",
        f"""c0 AS MATERIALIZED (SELECT k, unnest(range({dims})) AS i, unnest(v) AS c FROM (SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k FROM kept) WHERE k < {k})""",
    ]
    for t in range(rounds + 1):
        parts.append(f"d{t} AS (SELECT r, k, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c{t} USING (i) GROUP BY r, k)")
        parts.append(f"a{t} AS MATERIALIZED (SELECT r, min(d) AS d, arg_min(k, (d, k)) AS k FROM d{t} GROUP BY r)")
        if t < rounds:
            parts.append(f"m{t} AS (SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{t} JOIN x USING (r) GROUP BY k, i)")
            parts.append(f"c{t + 1} AS MATERIALIZED (SELECT k, i, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM c{t} LEFT JOIN m{t} USING (k, i))")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, k::BIGINT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k) USING (k)"""


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_folder(spark, "token-files")
    token_files.write_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    out = token_files.read_documents(spark, path)
    remove_folder(spark, path)
    return out


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=32, factor=64)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_chat_format": op4_chat_format,
    "op5_decontaminate": op5_decontaminate,
    "op6_rule_classifier": op6_rule_classifier,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_packing": op10_packing,
    "packing_chats": packing_chats,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_token_files": op12_token_files,
    "op13_embedding_whitening": op13_embedding_whitening,
}
SQL = {"op4_chat_format": OP4_SQL, "op5_decontaminate": OP5_SQL, "op9_substring_dedup": OP9_SQL, "op11_centroid_clustering": _op11_sql()}
