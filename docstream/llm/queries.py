"""The registered queries of the corpus operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docstream.llm import alignment, chat, decontamination, jaccard_join, licenses, lm, merkle, packing, pii, quality, token_counts, toxicity, warc
from docstream.llm.tokenizing import tokenizer_path
from docstream.session import scratch_dir

#: The key of the pseudonyms in the registered query; a real job takes its own from a secret store.
PII_KEY = "registered-query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back through the index."""
    typed = warc.with_types(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    records = warc.read_records(warc.write_archives(typed, scratch_dir(spark, "warc")), payloads=False)
    return records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its numbers and dates pseudonymised."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).select("doc_id", "n_found", "text")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose four-word shingles are similar to 0.85 or more."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which benchmark items each document holds, and how far the nearest passage is."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_items(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_distinct(F.transform("matches", lambda m: m["item_id"]))
    distance = F.array_min(F.transform("matches", lambda m: m["distance"]))
    return found.select("doc_id", decontamination.contaminated().alias("contaminated"), items.alias("item_ids"), distance.alias("distance"))


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs of the conversations, formatted."""
    found = chat.format_preferences(chat.reply_pairs(table(spark, sf_dir, "conversations")), "conv_id")
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return found.withColumn("chosen_spans", spans("chosen_spans")).withColumn("rejected_spans", spans("rejected_spans"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality.STATISTICS, "base_failed", "kept")


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document under a model of those outside the held-out fold."""
    return lm.score(table(spark, sf_dir, "documents"), fold(7) == 2)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learnt from the labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    machine = toxicity.train(docs.filter(~held_out).join(labels.filter(~held_out), "doc_id"))
    found = toxicity.score(docs, machine)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    found = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return found.withColumn("over_limit", token_counts.over(1024))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by two tokenizers, aligned, with the counts of linked pairs in all documents."""
    return alignment.linked(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every document; those of even checksums are folded up again without their line ends."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.when(fold(2) == 0, merkle.leaf([*fields[:-1], F.replace("text", F.lit("\n"), F.lit(""))]))
    found = merkle.manifest(table(spark, sf_dir, "documents"), "source", "doc_id", merkle.leaf(fields), tampered)
    return found.withColumnRenamed("key", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: F.concat(p["label"], F.lit(":"), p["notice"]).isin([f"{n.label}:{n.text}" for n in licenses.PHRASES]))
    starts = F.transform(base, lambda p: p["first_word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        licenses.labels(base).alias("base_labels"),
        licenses.labels(F.col("places")).alias("labels"),
        licenses.likeness(F.col("places")).alias("score"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_warc, op2_pii, op3_jaccard_join, op4_decontamination, op5_preferences, op6_quality, op7_lm, op8_packing, op9_toxicity, op10_token_counts, op11_alignment, op12_merkle, op13_licenses)
    return {query.__name__: query for query in found}


_LETTERS = " || ".join(
    f"substr('{warc.BASE32}', ((('0x' || substr(sha1(p), {1 + 5 * k}, 5))::INT >> {15 - 5 * j}) & 31) + 1, 1)" for k in range(8) for j in range(4)
)
OP1_SQL = f"""
WITH pages_ AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
told AS (SELECT page_id, strlen(p)::BIGINT AS payload_bytes, {_LETTERS} AS payload_digest FROM pages_),
headed AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS head FROM told)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM headed
"""

OP3_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s FROM cut),
sets AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM shingled),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
  FROM sets a JOIN sets b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs WHERE 100 * common >= 85 * (n + m - common)
  UNION ALL SELECT b, a FROM pairs WHERE 100 * common >= 85 * (n + m - common)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(b) AS component_id FROM shingled JOIN reached ON a = doc_id GROUP BY doc_id, len(s)
"""

OP5_SQL = """
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
ended AS (
  SELECT conv_id, t[1:list_max([CASE WHEN t[i].role = 'assistant' THEN i END FOR i IN range(1, len(t) + 1)])] AS chosen
  FROM turns WHERE list_contains([x.role FOR x IN t], 'assistant')),
pairs AS (
  SELECT a.conv_id, a.chosen, list_append(a.chosen[1:len(a.chosen) - 1], b.chosen[len(b.chosen)]) AS rejected
  FROM ended a JOIN ended b ON a.conv_id = xor(b.conv_id, 1)),
cut AS (
  SELECT *, CASE WHEN chosen[len(chosen)] = rejected[len(rejected)] THEN len(chosen) ELSE len(chosen) - 1 END AS n FROM pairs),
said AS (
  SELECT conv_id, n, [('<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)) FOR x IN chosen[1:n]] AS p,
    [('<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)) FOR x IN chosen[n + 1:]] AS c,
    [('<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)) FOR x IN rejected[n + 1:]] AS r
  FROM cut)
SELECT conv_id, n::INT AS n_prompt_turns, list_aggregate(list_concat([''], p), 'string_agg', '') AS prompt,
  list_aggregate(list_concat([''], c), 'string_agg', '') AS chosen,
  CASE WHEN len(c) = 1 THEN '22-' || length(c[1]) ELSE '' END AS chosen_spans,
  list_aggregate(list_concat([''], r), 'string_agg', '') AS rejected,
  CASE WHEN len(r) = 1 THEN '22-' || length(r[1]) ELSE '' END AS rejected_spans
FROM said
"""

OP6_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
placed AS (SELECT doc_id, row_number() OVER () AS r, t, w, l FROM cut),
windows AS (SELECT r, i, w[i] || chr(32) || w[i + 1] || chr(32) || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM placed)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
told AS (
  SELECT doc_id, w, l, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words FROM placed LEFT JOIN covered USING (r)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM told)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 100 * n_symbols > 10 * n_words
    OR (n_dup_lines > 1 AND 100 * n_dup_lines > 30 * len(l)) OR 100 * len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) > 20 * n_words
    OR (dots > 2 AND 100 * dots > 30 * len(l)) OR (bullets > 2 AND 100 * bullets > 90 * len(l)) OR (filler > 2 AND 100 * filler > 10 * len(l))) AS kept
FROM (SELECT *, len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS dots,
  len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•●]'))) AS bullets,
  len(list_filter(l, lambda x: regexp_matches(x, '(?i)lorem ipsum|(enable|activate|turn on|requires) javascript|javascript is (disabled|required)'))) AS filler FROM based)
"""


def _merkle_sql(leaf_levels: int = 14, group_levels: int = 10) -> str:
    """The levels of both trees one by one; 3**14 documents of a source and 3**10 sources at most."""
    said = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(said(c) for c in ("doc_id", "source", "lang", "n_chars"))
    # CRC-32 of the decimal digits: eight steps for each of them.
    text = "list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)"
    byte = "list_reduce(list_prepend(xor(s & 255, c), range(8)), lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {text}), lambda s, c: xor(s >> 8, {byte})), 4294967295)"
    steps = [
        f"base AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS g, sha256({head} || {said('text')}) AS leaf, "
        f"CASE WHEN {crc} % 2 = 0 THEN sha256({head} || {said("replace(text, chr(10), '')")}) END AS other FROM documents)",
        "s0 AS MATERIALIZED (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS c FROM (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h FROM base))",
        "m0 AS MATERIALIZED (SELECT r, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, coalesce(other, leaf) AS f, '' AS proof FROM base)",
    ]

    def level(s: str, m: str, to: str, into: str) -> list[str]:
        return [
            f"{to} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM (SELECT g, i // 3 AS i, CASE WHEN max(c) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h FROM {s} GROUP BY g, i // 3))",
            f"{into} AS MATERIALIZED (SELECT r, m.g, m.i // 3 AS i, CASE WHEN max(c) > 1 THEN sha256(string_agg(CASE WHEN s.i = m.i THEN f ELSE h END, '' ORDER BY s.i)) ELSE max(f) END AS f, "
            f"proof || coalesce(string_agg(h, '' ORDER BY s.i) FILTER (s.i <> m.i), '') AS proof FROM {m} m JOIN {s} s ON s.g = m.g AND s.i // 3 = m.i // 3 GROUP BY r, m.g, m.i, proof)",
        ]

    for k in range(leaf_levels):
        steps += level(f"s{k}", f"m{k}", f"s{k + 1}", f"m{k + 1}")
    steps += [
        f"tops AS MATERIALIZED (SELECT g AS name, row_number() OVER (ORDER BY g) - 1 AS i, h FROM s{leaf_levels})",
        "t0 AS MATERIALIZED (SELECT '' AS g, i, h, count(*) OVER () AS c FROM tops)",
        f"n0 AS MATERIALIZED (SELECT r, '' AS g, tops.i, f, proof FROM m{leaf_levels} JOIN tops ON name = g)",
    ]
    for k in range(group_levels):
        steps += level(f"t{k}", f"n{k}", f"t{k + 1}", f"n{k + 1}")
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, tops.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM base JOIN n{group_levels} n USING (r) JOIN tops ON tops.name = base.g CROSS JOIN t{group_levels} t"""
    )


OP12_SQL = _merkle_sql()


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op3_jaccard_join": OP3_SQL, "op5_preferences": OP5_SQL, "op6_quality": OP6_SQL, "op12_merkle": OP12_SQL}
