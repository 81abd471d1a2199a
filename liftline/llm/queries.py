"""One query per operator over whole tables, with production parameters, and the same answers in SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from liftline.llm import (
    decontaminate, line_dedup, merkle, near_dedup, packing, personal_data, quality, secret_scan, suffix_dedup, token_output, toxicity, vector_codes,
    vector_search,
)
from liftline.llm.common import table
from liftline.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedupe(table(spark, sf_dir, "documents"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_output.read_documents(spark, path, with_ids=False)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("tie")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    sample = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", remainder != 0, toxicity.PER_LABEL)
    found = toxicity.scored(docs, toxicity.learn(sample))
    # the text is not returned: a score is computed once per row and used twice
    return found.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "score").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    sample = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", remainder != 1, quality.PER_LABEL)
    found = quality.scored(docs, quality.learn(sample))
    return found.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.scan(table(spark, sf_dir, "documents")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(*vector_codes.compress(table(spark, sf_dir, "embeddings")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = merkle.verified(merkle.documents_manifest(table(spark, sf_dir, "documents"), tampered))
    return found.withColumnRenamed("id", "doc_id").drop("copies")


DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), item_words AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), doc_parts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words WHERE len(w) >= 5
), item_parts AS (
  SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words WHERE len(w) >= 5
), ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM doc_parts),
   qs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM item_parts),
   sizes AS (SELECT item_id, count(*) AS n_shingles FROM qs GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles AS containment
FROM ds JOIN qs USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) / n_shingles >= 0.8
"""

LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), counts AS (
  SELECT k, min(doc_id) AS first, count(DISTINCT doc_id) AS n FROM keyed WHERE length(k) >= 10 GROUP BY k
), marked AS (
  SELECT keyed.*, counts.n >= 2 AND keyed.doc_id <> counts.first AS gone FROM keyed LEFT JOIN counts USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE coalesce(gone, false)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT coalesce(gone, false)), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _nearest(k: int) -> str:
    return f"""
near{k} AS (
  SELECT r, parts.p, x, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT r, parts.p, x, e, list_sum(list_transform(list_zip(x, b), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts JOIN book{k} USING (p)
  ) AS parts GROUP BY ALL
)"""


def _book(k: int) -> str:
    return f"""
sums{k} AS (
  SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM near{k - 1}, (SELECT unnest(range(1, 1025)) AS i) WHERE i <= len(x) GROUP BY ALL
), means{k} AS (
  SELECT p, e, list((s - ((s % n + n) % n)) // n ORDER BY i) AS b FROM sums{k} GROUP BY p, e
), book{k} AS (SELECT p, e, coalesce(m.b, o.b) AS b FROM book{k - 1} AS o LEFT JOIN means{k} AS m USING (p, e))"""


VECTOR_CODES = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT r, p, v[(p * (len(v) // 16) + 1):((p + 1) * (len(v) // 16))] AS x FROM kept, (SELECT unnest(range(16)) AS p)
), book0 AS (SELECT p, r - 1 AS e, x AS b FROM parts WHERE r <= 64),
{_nearest(0)}, {_book(1)}, {_nearest(1)}, {_book(2)}, {_nearest(2)},
named AS (
  SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
), coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (r), named
"""

MANIFEST = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text, concat(
      coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
      coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-')
    ) AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small,
    -- crc32 of the id as text, eight shifts a byte
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) AS crc
  FROM documents
), leaves AS (
  SELECT *, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(octet_length(encode(small)) || ':' || small, '-')) AS small_leaf,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM fields
), nodes AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, any_value(lvl) + 1, pos // 16, any_value(n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY source, pos // 16
), subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS lvl, place AS pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 16, any_value(n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY pos // 16
), runs AS (
  SELECT 'in ' || coalesce('+' || source, '') AS tree, lvl, pos // 16 AS run, list(digest ORDER BY pos) AS d FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT 'top', lvl, pos // 16, list(digest ORDER BY pos) FROM tops WHERE n > 1 GROUP BY ALL
), steps AS (
  SELECT doc_id, lvl, d, pos // (16 ** lvl)::BIGINT % 16 + 1 AS nth
  FROM leaves JOIN runs ON tree = 'in ' || coalesce('+' || source, '') AND run = pos // (16 ** (lvl + 1))::BIGINT
  UNION ALL
  SELECT doc_id, 100 + lvl, d, place // (16 ** lvl)::BIGINT % 16 + 1
  FROM leaves JOIN subroots ON leaves.source IS NOT DISTINCT FROM subroots.source JOIN runs ON tree = 'top' AND run = place // (16 ** (lvl + 1))::BIGINT
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lvl) AS step FROM steps
), proofs AS (
  SELECT doc_id, sha256(string_agg(array_to_string(list_concat(d[:nth - 1], d[nth + 1:]), ''), '' ORDER BY step)) AS proof_sha256 FROM numbered GROUP BY doc_id
), folds AS (
  SELECT doc_id, 0 AS step, CASE WHEN crc % 5 = 0 THEN small_leaf ELSE leaf END AS digest FROM leaves
  UNION ALL
  SELECT doc_id, folds.step + 1, sha256(array_to_string(list_concat(d[:nth - 1], [digest], d[nth + 1:]), ''))
  FROM folds JOIN numbered USING (doc_id) WHERE numbered.step = folds.step + 1
), folded AS (SELECT doc_id, arg_max(digest, step) AS folded_root FROM folds GROUP BY doc_id),
root AS (SELECT digest AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots ON leaves.source IS NOT DISTINCT FROM subroots.source LEFT JOIN proofs USING (doc_id) JOIN folded USING (doc_id), root
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_vector_search": op1_vector_search,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_token_output": op3_token_output,
        "op4_decontamination": op4_decontamination,
        "op5_toxicity": op5_toxicity,
        "op6_quality": op6_quality,
        "op7_sum_of_squares_packing": op7_sum_of_squares_packing,
        "op8_near_dedup": op8_near_dedup,
        "op9_line_dedup": op9_line_dedup,
        "op10_secret_scan": op10_secret_scan,
        "op11_personal_data": op11_personal_data,
        "op12_vector_codes": op12_vector_codes,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontamination": DECONTAMINATION,
        "op9_line_dedup": LINE_DEDUP,
        "op12_vector_codes": VECTOR_CODES,
        "op13_merkle_manifest": MANIFEST,
    }
