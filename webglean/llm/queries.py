"""Registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_dir
from . import (
    bpe, chat, clusters, decontam, embed_neardup, jaccard_join, mixing, pii, quality, resampling,
    sharding, token_files, toxicity,
)
from .labels import held_out

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scored(df: DataFrame, cut: float) -> DataFrame:
    return df.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _scored(toxicity.score(docs, model), toxicity.REJECT)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _scored(quality.score(docs, model), 0.5)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.flag(docs, table(spark, sf_dir, "benchmark")).drop("text")


def op4_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to eight shards whose row counts differ by one at most."""
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=8)


def op5_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all embeddings of one label."""
    return embed_neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to token files and back."""
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    files = token_files.write_tokens(
        table(spark, sf_dir, "documents"), folder, BYTE_BPE, public_tokenizers.PATTERN
    )
    return token_files.read_tokens(spark, files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


# Fixed value: the text of both turns of the conversation that is added to the table.
ODD_TEXT = "\\### Assistant: </turn> ok"


def chat_records(rows: DataFrame) -> DataFrame:
    """A record a conversation of ``rows(conv_id, turn, role, text)``, in the layout that its id and its
    roles choose: lists of messages under three names, or prompt and instruction fields where there
    is one question and one answer."""
    fields = F.struct("turn", "role", "text")
    records = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(fields)).alias("all"))
    roles = F.transform("all", lambda t: F.coalesce(t["role"], F.lit("")))
    led = roles == F.array(*map(F.lit, ("system", "user", "assistant")))
    pair = led | (roles == F.array(F.lit("user"), F.lit("assistant")))
    renamed = F.exists(roles, lambda r: r.isin(*chat.ROLES))
    turn = F.coalesce(F.pmod("conv_id", F.lit(3)), F.lit(0))
    layout = (
        F.when(pair & (turn == 1), "prompt").when(pair & (turn == 2), "instruction")
        .when(turn == 1, "messages").when((turn == 2) & ~renamed, "conversations").otherwise("turns")
    )

    def listed(name: str, role: str, text: str) -> Column:
        new = F.transform("all", lambda t: F.struct(
            (F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"])
             if role == "from" else t["role"]).alias(role), t["text"].alias(text),
        ))
        return F.when(layout == name, new).alias(name)

    def field(place: int, *names: str) -> list[Column]:
        text = F.coalesce(F.element_at("all", place)["text"], F.lit(""))
        return [F.when(layout == name, text).alias(to) for name, to in zip(("prompt", "instruction"), names)]

    system = F.when(led & layout.isin("prompt", "instruction"), F.coalesce(F.get("all", F.lit(0))["text"], F.lit("")))
    return records.select(
        "conv_id", listed("turns", "role", "text"), listed("messages", "role", "content"),
        listed("conversations", "from", "value"), system.alias("system"),
        *field(-2, "prompt", "instruction"), *field(-1, "completion", "output"),
    )


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, in several layouts, to the template and read back from it."""
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ODD_TEXT).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(odd)
    written = chat.format_turns(chat.canonical_turns(chat_records(rows)))
    back = chat.parse_turns(written.select("conv_id", "formatted", "loss_spans"), to="back")
    lines = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.loss_text()
    return back.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP7_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + length(regexp_replace(role, '[^\\\\#<:]', '', 'g'))
    + length(text) + length(regexp_replace(text, '[^\\\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


# The key of the registered query and of the pipeline. Real use takes a secret one.
PII_KEY = "webglean surrogates"


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data and secrets replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_pii(docs, PII_KEY)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all documents by their sets of five-word shingles."""
    return jaccard_join.join_components(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM w
), u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT s.doc_id, len(s.s) AS n_shingles,
  least(s.doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = s.doc_id), s.doc_id)) AS component_id
FROM s
"""


def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to token ids and back."""
    ids = bpe.encode(
        table(spark, sf_dir, "documents").select("doc_id", "text"), MULTI_RANKS,
        public_tokenizers.PATTERN,
    )
    return bpe.decode(ids, MULTI_RANKS).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights of 5, 2, 1 in turn, each source at most three times."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.cycled_weights(docs, (5, 2, 1)))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# Sources in the order in which they are clamped: the first that is not sets the level.
OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS draw FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS DOUBLE) AS cap,
    CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM d GROUP BY source
), f AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM s WINDOW o AS (ORDER BY cap / weight, source)
), l AS (
  SELECT CAST(words_left AS DOUBLE) AS words_left, weight_left FROM f
  WHERE weight * words_left <= cap * weight_left ORDER BY cap / weight, source LIMIT 1
), t AS (
  SELECT source, source_size, least(cap, weight * words_left / weight_left) AS target,
    coalesce(floor(least(cap, weight * words_left / weight_left) / nullif(CAST(source_size AS DOUBLE), 0)), 0) AS whole
  FROM s, l
), u AS (
  SELECT d.*, target, source_size, whole, target - whole * source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY draw RANGE UNBOUNDED PRECEDING) AS ends,
    sum(size) OVER (PARTITION BY d.source, draw) AS unit
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN 2 * ends - unit <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM u
"""


def op12_geometric_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in eight clusters after ten rounds."""
    found = clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return clusters.with_inertia(found).withColumnRenamed("key", "vec_id")


def _rounds_sql(rounds: int) -> str:
    """Every round as two tables: the centroids ``c``, and the assignment ``a`` of all vectors."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, d * 8 + c) AS c, min(d) AS d FROM (
    SELECT vec_id, c, sum((x - y) * (x - y)) AS d FROM k JOIN c{r} USING (i) GROUP BY vec_id, c) GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, i, coalesce((total - ((total % n) + n) % n) // n, y) AS y FROM c{r} LEFT JOIN (
    SELECT c, i, CAST(sum(x) AS BIGINT) AS total, count(*) AS n FROM k JOIN a{r} USING (vec_id) GROUP BY c, i) USING (c, i))""")
    return ",\n".join(steps)


OP12_SQL = f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, unnest(range(1, 65)) AS i,
    unnest(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS x
  FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = 64 AND len(embedding) = 64
), c0 AS MATERIALIZED (
  SELECT c, i, x AS y FROM k JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM (SELECT DISTINCT vec_id FROM k)
    QUALIFY c < 8) USING (vec_id)
), {_rounds_sql(10)}, names AS (
  SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c10 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  centroid_sha256 FROM a10 JOIN names USING (c)
"""


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents that have 20 words, drawn towards the benchmark texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gain = resampling.gains(
        resampling.bucket_counts(docs), resampling.bucket_counts(table(spark, sf_dir, "benchmark"))
    )
    return resampling.draw(resampling.score(docs, gain).drop("text")).drop("n_words")


# The checksum is taken once for every different word: byte by byte, with its table made by shifts.
OP13_SQL = r"""
WITH step AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc),
words AS MATERIALIZED (
  SELECT side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT 's' AS side, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark)
), hashed AS MATERIALIZED (
  SELECT w, (4294967295 - list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c // 256, crc[xor(c, b) % 256 + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM words), step
), counts AS (
  SELECT bucket, CAST(count(*) FILTER (side = 's') AS DOUBLE) AS s, CAST(count(*) FILTER (side = 't') AS DOUBLE) AS t
  FROM words JOIN hashed USING (w) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((sum(s) OVER ()) + 10000) / ((s + 1) * ((sum(t) OVER ()) + 10000)))) AS BIGINT) AS gain FROM counts
), weights AS (
  SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS g FROM words JOIN hashed USING (w) JOIN gains USING (bucket)
  WHERE side = 's' GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce((g - ((g % n) + n) % n) // n, 0) AS weight,
    CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || d.doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS noise
  FROM documents d LEFT JOIN weights USING (doc_id)
), placed AS (
  SELECT doc_id, n_features, weight, weight + noise AS score,
    row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) AS place FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100 THEN place END AS rank
FROM placed
"""


REGISTERED = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_decontamination": op3_decontamination,
    "op4_label_propagation": op4_label_propagation,
    "op5_sorted_projections": op5_sorted_projections,
    "op6_token_files": op6_token_files,
    "op7_chat": op7_chat,
    "op8_surrogates": op8_surrogates,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_prefix_bpe": op10_prefix_bpe,
    "op11_water_filling": op11_water_filling,
    "op12_geometric_drift": op12_geometric_drift,
    "op13_importance": op13_importance,
}

SQL: dict[str, str] = {
    "op7_chat": OP7_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op11_water_filling": OP11_SQL,
    "op12_geometric_drift": OP12_SQL,
    "op13_importance": OP13_SQL,
}
