"""The registered queries of the corpus operators, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import (
    centroid_clusters,
    conversation_repair,
    fingerprints,
    host_rules,
    language_id,
    mixing,
    near_dedup,
    packing,
    pitman_yor,
    token_files,
    toxicity,
    url_filter,
    weak_labels,
)
from threadloom.llm.words import fold, only
from threadloom.operators.lookup import fits_broadcast, lookup_join
from threadloom.plans.materialize import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return only(spark.read.parquet(f"{sf_dir}/{name}.parquet"), *columns)


@registered()
def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("train", fold("doc_id", 7) != 2)
    scored = pitman_yor.score_documents(docs)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


@registered()
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "passes")


HOST_RULES_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 3)) AS pos, ws FROM texts WHERE len(ws) >= 6),
keyed AS (SELECT doc_id, pos, array_to_string(ws[pos:pos + 4], ' ') AS five FROM windows),
twice AS (
  SELECT doc_id, pos FROM keyed
  QUALIFY count(*) OVER (PARTITION BY doc_id, five) >= 2),
inside AS (SELECT DISTINCT doc_id, pos + k AS pos FROM twice, (SELECT unnest(range(0, 5)) AS k)),
repeats AS (SELECT doc_id, count(*) AS n FROM inside GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts),
line_counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (
  SELECT doc_id, host, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM texts LEFT JOIN repeats USING (doc_id) LEFT JOIN line_counts USING (doc_id)),
failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base,
         100 * n_symbols > 10 * n_words AS symbols,
         100 * n_dup_lines > 30 * n_lines AS dup,
         word_chars < 2 * n_words OR word_chars > 20 * n_words AS chars
  FROM counts),
rates AS (
  SELECT host, count(*) AS n, 'base' AS rule, sum(base::INT) AS f FROM failed GROUP BY host
  UNION ALL SELECT host, count(*), 'symbols', sum(symbols::INT) FROM failed GROUP BY host
  UNION ALL SELECT host, count(*), 'lines', sum(dup::INT) FROM failed GROUP BY host
  UNION ALL SELECT host, count(*), 'length', sum(chars::INT) FROM failed GROUP BY host),
moments AS (
  SELECT rule, avg(f / n) AS mean, var_pop(f / n) AS spread, avg(1 / n) AS per_doc FROM rates GROUP BY rule),
priors AS (
  SELECT rule, mean, least(greatest(
    CASE WHEN spread - mean * (1 - mean) * per_doc > 0
         THEN mean * (1 - mean) / (spread - mean * (1 - mean) * per_doc) - 1 ELSE 10000 END, 2), 10000) AS weight
  FROM moments),
shrunk AS (
  SELECT host, n + weight AS size, (f + weight * mean) / (n + weight) AS rate FROM rates JOIN priors USING (rule)),
refused AS (SELECT DISTINCT host FROM shrunk WHERE rate - 2 * sqrt(rate * (1 - rate) / (size + 1)) > 0.5)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base AS base_failed,
       NOT base AND host NOT IN (SELECT host FROM refused) AS kept
FROM failed
"""


@registered(HOST_RULES_SQL)
def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.apply_host_rules(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *(F.col(f"_counts.{name}") for name in names), "base_failed", "kept")


@registered()
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group_near_copies(table(spark, sf_dir, "documents", "doc_id", "text"))


@registered()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@registered()
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


@registered()
def op7_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    judged = docs.withColumn("judged", weak_labels.judge(weak_labels.fit(docs))(F.col("text")))
    return judged.select(
        "doc_id", "judged.votes", "judged.weak", "judged.score", (F.col("judged.score") >= 0.5).alias("kept")
    )


@registered()
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


@registered()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 4) == 2)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(fold("doc_id", 4) != 2)
    labelled = lookup_join(docs.where("not held_out"), labels, ["doc_id"], fits_broadcast(labels))
    model = toxicity.fit(labelled)
    scored = docs.withColumn("score", toxicity.scorer(model)(F.col("text")))
    flagged = F.col("score") >= toxicity.threshold(model, F.col("lang"))
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), flagged.alias("flagged")
    )


@registered()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 3) == 1)
    model = language_id.fit(docs.where("not held_out"))
    found = docs.withColumn("found", language_id.identify(model)(F.col("text")))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def clusters_sql(clusters: int = centroid_clusters.CLUSTERS, rounds: int = centroid_clusters.ROUNDS) -> str:
    """The rounds one after another; a sum is divided exactly, rounding down."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS v, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS xs FROM embeddings
  WHERE len(embedding) = 64 AND list_count(embedding) = 64 AND len([x FOR x IN embedding IF NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, xs) - 1)::INTEGER AS cluster, xs
  FROM (SELECT xs, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h FROM kept ORDER BY h, xs LIMIT {clusters}))"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT v, min(d) AS distance, arg_min(cluster, (d, cluster)) AS cluster
  FROM (SELECT v, cluster, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN zipped]) AS d FROM (
    SELECT v, c.cluster, list_zip(k.xs, c.xs) AS zipped FROM kept k, c{n} c))
  GROUP BY v)""")
        if n < rounds:
            steps.append(f"""m{n} AS MATERIALIZED (
  SELECT cluster, list(m ORDER BY k) AS xs FROM (
    SELECT cluster, k, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) / count(*))::BIGINT AS m
    FROM (SELECT a.cluster, unnest(xs) AS x, unnest(range(64)) AS k FROM kept JOIN a{n} a USING (v)) GROUP BY cluster, k)
  GROUP BY cluster),
c{n + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.xs, c.xs) AS xs FROM c{n} c LEFT JOIN m{n} m USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a.cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.xs, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} a USING (v) JOIN c{rounds} c USING (cluster)"""


@registered(clusters_sql())
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clusters.cluster_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    named = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid_sha256", named).drop("centroid")


def _add(value: str, cost: str, letter: str) -> str:
    """SQL: a value is its cost in twelve digits and its audit, so values compare as texts."""
    return f"lpad((left({value}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({value}, 13) || '{letter}'"


def repair_sql() -> str:
    """Row by row, the least value for each of the four states; a list holds them."""
    opened = f"least({_add('v[1]', '5', 'I')}, {_add('v[2]', '5', 'I')}, {_add('v[4]', '5', 'I')})"
    replied = _add("v[3]", "5", "I")
    closed = f"[v[1], v[2], least(v[3], o[1], {_add('o[2]', '5', 'I')}), least(v[4], o[2], {_add('o[1]', '5', 'I')})]"

    def inserted(values: str) -> str:
        pairs = f"list_transform([{values}], lambda v: [v, [{opened}, {replied}]])[1]"
        return f"list_transform([{pairs}], lambda p: list_transform([p[1]], lambda v: list_transform([p[2]], lambda o: {closed})[1])[1])[1]"

    more = "(CASE WHEN e[1] IN ('S', 'U', 'A', 'X') THEN 5 ELSE 0 END)"
    to_user = "least(c[1], c[2], c[4])"
    never = "'999999999999'"

    def either(test: str, value: str) -> str:
        return f"CASE WHEN {test} THEN {value} ELSE {never} END"

    stepped = f"""[
      {_add('c[1]', '2', 'D')},
      least({_add('c[2]', '2', 'D')}, {either("lower(e[1]) = 's'", _add('c[1]', more, 'K'))}),
      least({_add('c[3]', '2', 'D')}, {either("e[1] <> 'd'", _add(to_user, '1 + ' + more, 'R'))},
            {either("lower(e[1]) = 'u'", _add(to_user, more, 'K'))}),
      least({_add('c[4]', '2', 'D')}, {either("e[1] <> 'd'", _add('c[3]', '1 + ' + more, 'R'))},
            {either("lower(e[1]) = 'a'", _add('c[3]', more, 'K'))})]"""
    start = "['000000000000', '500000000000', '500000000000', '500000000000']"
    return rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce([4294967295] || [ord(c)::BIGINT FOR c IN string_split(
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
           lambda x, b: list_reduce([xor(x, b)] || range(8), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM given),
placed AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         left(lag(role) OVER w, 1) || left(role, 1) AS pair, lag(role) OVER w IS NOT NULL AS follows,
         regexp_replace(text, '[ 	-
]+$', '') AS ended
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faulted AS (
  SELECT *, CASE WHEN ended = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS letter
  FROM placed),
grouped AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (follows AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list(CASE fault WHEN '' THEN letter WHEN 'truncated' THEN upper(letter) ELSE 'd' END ORDER BY i) AS kinds,
         list(role ORDER BY i) AS roles, list(text ORDER BY i) AS texts
  FROM faulted GROUP BY conv_id),
valued AS (
  SELECT *, list_reduce([{start}] || [[k] FOR k IN kinds], lambda a, e: list_transform([{inserted("a")}], lambda c: {stepped})[1]) AS ends
  FROM grouped),
goals AS (
  SELECT *, list_transform([{inserted("ends")}], lambda c: least(c[1], c[4]))[1] AS goal FROM valued),
replayed AS (
  SELECT *, left(goal, 12)::BIGINT AS cost, substr(goal, 13) AS audit,
         list_reduce([['', '1']] || [[x] FOR x IN string_split(substr(goal, 13), '') IF x <> ''], lambda h, e: CASE e[1]
           WHEN 'D' THEN [h[1], (h[2]::INT + 1)::VARCHAR] || h[3:]
           WHEN 'I' THEN CASE h[1] WHEN 'u' THEN ['a', h[2]] || h[3:] || ['assistant:'] ELSE ['u', h[2]] || h[3:] || ['user:'] END
           WHEN 'R' THEN CASE h[1] WHEN 'u' THEN ['a', (h[2]::INT + 1)::VARCHAR] || h[3:] || ['assistant:' || texts[h[2]::INT]]
                                   ELSE ['u', (h[2]::INT + 1)::VARCHAR] || h[3:] || ['user:' || texts[h[2]::INT]] END
           ELSE [left(roles[h[2]::INT], 1), (h[2]::INT + 1)::VARCHAR] || h[3:] || [roles[h[2]::INT] || ':' || texts[h[2]::INT]] END) AS held
  FROM goals),
found AS (
  SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256(array_to_string(held[3:], chr(10))) AS repaired_sha256
  FROM replayed)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN found f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
"""


@registered(repair_sql())
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return conversation_repair.digests(conversation_repair.repair_conversations(damaged, present=F.col("present")))


@registered()
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    path = token_files.write_token_files(docs, scratch_path(spark, "token-files"))
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
