"""The registered queries of this subpackage and, where SQL can express them, their checks."""

from pyspark.sql import functions as F

from barworks.llm.bpe import decode, encode
from barworks.llm.clustering import centroid_clusters, centroid_digest
from barworks.llm.common import held_out, table
from barworks.llm.decontaminate import find_contamination
from barworks.llm.html_text import extract_text
from barworks.llm.language import predict, train as train_languages
from barworks.llm.line_dedup import dedup_lines
from barworks.llm.minhash import compare_edited
from barworks.llm.pii import ADDED_KINDS, BASE_KINDS, find_personal_data, span_text
from barworks.llm.quality import THRESHOLD, score, train
from barworks.llm.resampling import resample
from barworks.llm.sharding import assign_shards
from barworks.llm.simhash import near_components
from barworks.llm.url_filter import filter_urls

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark, sf):
    encoded = encode(table(spark, sf, "documents").select("doc_id", "text"), vocabulary_path())
    decoded = decode(encoded.drop("text"), vocabulary_path())
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_decontaminate(spark, sf):
    found = find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_html(spark, sf):
    return extract_text(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


def op5_pii(spark, sf):
    found = find_personal_data(table(spark, sf, "documents").select("doc_id", "text"))
    counts = [F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(span_text(BASE_KINDS), 256).alias("base_sha256"),
                        span_text(BASE_KINDS + ADDED_KINDS).alias("spans"))


def op6_line_dedup(spark, sf):
    return dedup_lines(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: The rules of the query: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op7_url_filter(spark, sf):
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS rules(host, path, verdict)")
    judged = filter_urls(table(spark, sf, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_language(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = train_languages(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs.drop("lang"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_simhash(spark, sf):
    return near_components(table(spark, sf, "documents"))


def op10_minhash(spark, sf):
    made = compare_edited(table(spark, sf, "documents"))
    return made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next")


def op11_sharding(spark, sf):
    placed = assign_shards(table(spark, sf, "documents"), keep=["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_clustering(spark, sf):
    placed = centroid_clusters(table(spark, sf, "embeddings"))
    return placed.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid_digest(F.col("centroid")).alias("centroid_sha256"))


def op13_resampling(spark, sf):
    ranked = resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


def queries():
    return {
        "op1_bpe": op1_bpe,
        "op2_quality": op2_quality,
        "op3_decontaminate": op3_decontaminate,
        "op4_html": op4_html,
        "op5_pii": op5_pii,
        "op6_line_dedup": op6_line_dedup,
        "op7_url_filter": op7_url_filter,
        "op8_language": op8_language,
        "op9_simhash": op9_simhash,
        "op10_minhash": op10_minhash,
        "op11_sharding": op11_sharding,
        "op12_clustering": op12_clustering,
        "op13_resampling": op13_resampling,
        "pipeline": pipeline,
    }


OP3_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWERED}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWERED}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, item_id, s, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES_SQL = f"""
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT doc_id, pos, line, translate(trim(line, {WHITE}), '{UPPER}', '{LOWERED}') AS k FROM lines),
frequent AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT keyed.*, frequent.k IS NOT NULL AND doc_id <> keeper AS dropped FROM keyed LEFT JOIN frequent USING (k))"""

OP6_SQL = f"""
WITH {LINES_SQL.strip()}
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


OP7_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWERED}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(h, p, v) AS (VALUES {", ".join(map(str, URL_RULES))}),
fits AS (SELECT parts.*, h || p AS rule, v FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
best AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS n FROM fits)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM best WHERE n = 1
"""


def _floor_div(a, b):
    return f"(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"


def _clusters_sql(dimensions=64, centroids=8, rounds=10):
    """The rounds one after the other, every vector against every centroid."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, v, k, d FROM (
    SELECT vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{k})
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT k, coalesce(m.c, c{k}.c) AS c FROM c{k} LEFT JOIN (
    SELECT k, list(x ORDER BY p) AS c FROM (
      SELECT k, p, ({_floor_div("sum(x)::HUGEINT", "count(*)::HUGEINT")})::BIGINT AS x
      FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{k}) GROUP BY k, p) GROUP BY k) m USING (k))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS k, v AS c FROM kept QUALIFY k < {centroids}),
{", ".join(steps)}
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (k)
"""


def _words_sql(text):
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWERED}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


#: CRC-32 by a table of 256 entries, made by its rule; bytes come from the hex digits.
OP13_SQL = f"""
WITH crc AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
d AS MATERIALIZED (SELECT doc_id, {_words_sql("text")} AS w FROM documents),
b AS MATERIALIZED (SELECT {_words_sql("text")} AS w FROM benchmark),
df AS MATERIALIZED (SELECT doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM d),
bf AS MATERIALIZED (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM b),
bytes AS (SELECT f, list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT) AS x FROM (SELECT f, hex(f) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf))),
hashed AS MATERIALIZED (
  SELECT f, xor(4294967295, list_reduce([4294967295] || x, lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]))) % 10000 AS k FROM bytes, crc),
raw AS (SELECT k, count(*) AS s FROM df JOIN hashed USING (f) GROUP BY k),
target AS (SELECT k, count(*) AS t FROM bf JOIN hashed USING (f) GROUP BY k),
gains AS MATERIALIZED (
  SELECT k, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT count(*) FROM df) + 10000))::DOUBLE / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM bf) + 10000))::DOUBLE))::BIGINT AS gain
  FROM (SELECT DISTINCT k FROM hashed) LEFT JOIN raw USING (k) LEFT JOIN target USING (k)),
weighed AS (SELECT doc_id, count(*) AS n, ({_floor_div("sum(gain)::HUGEINT", "count(*)::HUGEINT")})::BIGINT AS weight FROM df JOIN hashed USING (f) JOIN gains USING (k) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weighed USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS n, count(*) OVER () AS total FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN n <= 25 * total // 100 THEN n END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


def oracle_sql():
    return {"op12_clustering": _clusters_sql(), "op13_resampling": OP13_SQL,
            "op3_decontaminate": OP3_SQL, "op6_line_dedup": OP6_SQL, "op7_url_filter": OP7_SQL}
