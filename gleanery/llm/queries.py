"""The registered queries of this subpackage, with checking SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import (
    ann, code_compression, exact_dedup, filter_audit, mixing, packing, preference, sharding, simhash, substring,
    token_counts, token_store, toxicity,
)

QUERIES: dict = {}
ORACLES: dict = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_substring_dedup", r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM spots),
again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows WHERE s IN (SELECT s FROM again)),
out AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(coalesce(g, []))::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(g, []), i)), ' '), ''))
         AS kept_sha256
FROM words LEFT JOIN out USING (doc_id)
""")
def op1_substring_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs, window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_mixing")
def op2_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, mixing.words_in(F.col("text"))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


@query("op3_neighbours")
def op3_neighbours(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, lambda vec_id: vec_id % 100 == 0, k=10)


@query("op4_preference", """
WITH told AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i,
         count(*) OVER (PARTITION BY conv_id) AS n, coalesce(role, '') AS role,
         coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ends AS (SELECT DISTINCT conv_id AS pair_id, n - 1 - conv_id % n AS cut FROM told),
other AS (
  SELECT e.pair_id, t.i, t.role, t.text FROM ends e JOIN told t
    ON t.conv_id = CASE WHEN t.i < e.cut THEN e.pair_id ELSE xor(e.pair_id, 1) END),
mine AS (SELECT conv_id AS pair_id, i, role, text FROM told),
differ AS (
  SELECT coalesce(m.pair_id, o.pair_id) AS pair_id, coalesce(m.i, o.i) AS i
  FROM mine m FULL JOIN other o ON m.pair_id = o.pair_id AND m.i = o.i
  WHERE m.role IS DISTINCT FROM o.role OR m.text IS DISTINCT FROM o.text),
common AS (
  SELECT e.pair_id, coalesce(min(d.i), (SELECT count(*) FROM mine m WHERE m.pair_id = e.pair_id)) AS k
  FROM ends e LEFT JOIN differ d ON d.pair_id = e.pair_id GROUP BY e.pair_id),
shown AS (
  SELECT s.side, s.pair_id, s.i, k, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line,
         length(text) + 8 AS said
  FROM (SELECT 'c' AS side, * FROM mine UNION ALL SELECT 'r', * FROM other) s
  JOIN common c ON c.pair_id = s.pair_id),
placed AS (
  SELECT *, sum(length(line)) OVER (PARTITION BY side, pair_id, i >= k ORDER BY i) AS stop FROM shown),
told_all AS (
  SELECT pair_id, side,
         string_agg(line, '' ORDER BY i) FILTER (WHERE i < k) AS before,
         string_agg(line, '' ORDER BY i) FILTER (WHERE i >= k) AS after,
         string_agg((stop - said)::BIGINT || '-' || stop::BIGINT, ',' ORDER BY i)
           FILTER (WHERE i >= k AND role = 'assistant') AS mask
  FROM placed GROUP BY pair_id, side)
SELECT e.pair_id, e.k::INTEGER AS n_prompt_turns, coalesce(c.before, '') AS prompt,
       coalesce(c.after, '') AS chosen, coalesce(r.after, '') AS rejected,
       coalesce(c.mask, '') AS chosen_mask, coalesce(r.mask, '') AS rejected_mask
FROM common e LEFT JOIN told_all c ON c.pair_id = e.pair_id AND c.side = 'c'
LEFT JOIN told_all r ON r.pair_id = e.pair_id AND r.side = 'r'
""")
def op4_preference(spark, folder):
    pairs = preference.branch_pairs(table(spark, folder, "conversations"))
    spans = lambda mask: F.array_join(F.transform(
        mask, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return (preference.format_pairs(pairs).withColumn("chosen_mask", spans("chosen_mask"))
            .withColumn("rejected_mask", spans("rejected_mask")))


@query("op5_sharding")
def op5_sharding(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    shards = [f"shard-{i:03d}" for i in range(256)]
    return sharding.place(docs, "doc_id", shards).select(
        "row.doc_id", "row.source", "slot", "shard")


@query("op6_simhash")
def op6_simhash(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op7_token_store")
def op7_token_store(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_store.read(token_store.write(docs, vocabulary(), end_id=0))


@query("op8_packing")
def op8_packing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, vocabulary(), capacity=1024, end_id=2)


@query("op9_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""")
def op9_exact_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return exact_dedup.exact_groups(docs).select(
        "row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op10_toxicity")
def op10_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "row.doc_id", toxicity.held_out("row.doc_id").alias("held_out"), "score", "predicted")


@query("op11_token_counts")
def op11_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary(), limit=1024).select(
        "row.doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op12_code_compression", """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x
  FROM kept, (SELECT unnest(range(16)) AS p)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64),
book0 AS (SELECT p, e, x AS c FROM parts JOIN firsts USING (vec_id)),
""" + "".join(f"""
near{i} AS (
  SELECT vec_id, p, x, min(far * 64 + e) % 64 AS e, min(far * 64 + e) // 64 AS far
  FROM (SELECT vec_id, parts.p, x, e,
               list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
        FROM parts JOIN book{i} ON book{i}.p = parts.p)
  GROUP BY vec_id, p, x),
""" + (f"""
sums{i} AS (
  SELECT p, e, j, sum(x[j])::BIGINT AS s, count(*) AS n
  FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS j FROM near{i}) GROUP BY p, e, j),
moved{i} AS (
  SELECT p, e, list((s - (s % n + n) % n) // n ORDER BY j) AS c FROM sums{i} GROUP BY p, e),
book{i + 1} AS (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN moved{i} m USING (p, e)),
""" if i < 2 else "") for i in range(3)) + """
coded AS (
  SELECT vec_id, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(far)::BIGINT AS error
  FROM near2 GROUP BY vec_id),
hashed AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), hashed
""")
def op12_code_compression(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    coded = code_compression.with_group_error(code_compression.compress(vectors), "label")
    return coded.select("row.vec_id", "code", "error", "label_error", "codebooks_sha256")


@query("op13_filter_audit", r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
flags AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS f
  FROM docs LEFT JOIN marks USING (doc_id)),
held AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good,
                count(*) FILTER (WHERE toxic) AS toxic FROM flags GROUP BY part, f),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS prior
  FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)),
told AS (
  SELECT part, filter_order, step, x, n, good, toxic, f,
         f = '' OR NOT regexp_matches(f, '[' || prior || x || ']') AS stays,
         contains(f, x) AS fails, prior <> '' AND regexp_matches(f, '[' || prior || '-]') AS gone
  FROM steps, held),
figures AS (
  SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (WHERE stays), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE fails AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE fails AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE f = x), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE fails AND NOT gone), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE fails AND NOT gone), 0) AS toxic_lost
  FROM told GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM figures
""")
def op13_filter_audit(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return filter_audit.audit(docs, table(spark, folder, "labels"))
