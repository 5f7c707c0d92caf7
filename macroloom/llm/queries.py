"""The operators bound to the driver's tables, and the SQL they have to equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macroloom.llm import bpe, decontaminate, embeddup, langid, licenses, neardup, negatives, periodic, quality, repeats, secrets, tokenfiles, urls
from macroloom.llm.common import stored, table
from macroloom.work import new_folder

#: Public vocabulary files; a parameter of every operator that reads one.
TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"
MULTI_BPE = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"

URL_RULES = """
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
"""


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()), MULTI_BPE)
    return langid.identify(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP2_SQL = f"""
WITH item_words AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, list_slice(w, i, i + least(10, len(w)) - 1) AS win
  FROM item_words, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s(i) WHERE len(w) > 0
),
doc_words AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
widths AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT doc_id, i, k, list_slice(w, i, i + k - 1) AS win
  FROM doc_words, widths, unnest(generate_series(1, len(w) - k + 1)) AS s(i) WHERE len(w) >= k
),
found AS (SELECT p.doc_id, p.i, p.k, x.item_id FROM places p JOIN windows x ON p.k = x.k AND p.win = x.win),
hits AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(generate_series(i, i + k - 1)) AS s(j) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP4_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, unnest(generate_series(0, n - 50)) AS t(i) WHERE n >= 50),
firsts AS (SELECT s, min(doc_id) AS f FROM strings GROUP BY s),
repeated AS (SELECT doc_id, i FROM strings JOIN firsts USING (s) WHERE f < doc_id),
places AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS b FROM d, unnest(generate_series(0, n - 1)) AS t(i) WHERE n > 0),
judged AS (
  SELECT p.doc_id, p.i, b, coalesce(max(r.i) OVER (PARTITION BY p.doc_id ORDER BY p.i), -100) >= p.i - 49 AS gone
  FROM places p LEFT JOIN repeated r ON p.doc_id = r.doc_id AND p.i = r.i
),
marked AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM judged),
sums AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
    coalesce(string_agg(b, '' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id)
"""


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {URL_RULES} AS rules(host, path, verdict)")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


OP5_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {URL_RULES}),
asked AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
fitting AS (
  SELECT a.n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM asked a JOIN rules r ON (a.host = r.host OR ends_with(a.host, '.' || r.host)) AND starts_with(a.path, r.path)
  GROUP BY a.n
)
SELECT a.page_id, a.host, a.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM asked a LEFT JOIN fitting f ON a.n = f.n
"""


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = secrets.dictionary(spark, MULTI_BPE)
    model = secrets.train(secrets.labelled_findings(spark), words)
    return secrets.find_secrets(table(spark, sf_dir, "documents"), words, model)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), BYTE_BPE).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))[0]


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    tokenfiles.write_tokens(table(spark, sf_dir, "documents"), folder, BYTE_BPE)
    return tokenfiles.read_tokens(spark, folder).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, known = table(spark, sf_dir, "documents"), licenses.templates(spark)
    # Texts are cut into words once, for training and for judging.
    lines = licenses.vectors(licenses.paragraphs(docs), known)
    part = F.pmod(F.xxhash64("text"), F.lit(1000)).cast("int").alias("part")
    lines = stored(lines.select("id", "paragraph", part, "features"), "license-lines")
    return licenses.judge(lines, known, licenses.train(lines, known)).withColumnRenamed("id", "doc_id")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = quality.train(docs, labels.where(~held_out))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.find_periodic(table(spark, sf_dir, "documents"), repeat_tails=True).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")
    )


#: Words on their distance: windows of nine words that recur name the distances at which words may go on being equal.
OP12_SQL = r"""
WITH bits AS (SELECT list(n ORDER BY b) AS t FROM (
  SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS n FROM range(256) AS r(b))),
split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
hashed AS (
  SELECT doc_id, w, len(w) AS n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h
  FROM split, bits
),
tails AS (SELECT doc_id, w, n, h % 10 = 0 AND n > 0 AS tail, CASE WHEN n > 0 THEN (h // 10) % n END AS a, h // 10 AS g FROM hashed),
sized AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM tails),
words AS (
  SELECT doc_id, n, i, CASE WHEN tail AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM sized, unnest(range(n)) AS s(i)
),
windows AS (
  SELECT doc_id, n, i, hash(list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 8 FOLLOWING)) AS name FROM words
),
distances AS (
  SELECT DISTINCT x.doc_id, y.i - x.i AS q FROM windows x JOIN windows y ON x.doc_id = y.doc_id AND x.name = y.name AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
),
equal AS (
  SELECT d.doc_id, d.q, x.i, x.i - row_number() OVER (PARTITION BY d.doc_id, d.q ORDER BY x.i) AS stretch
  FROM distances d JOIN words x ON d.doc_id = x.doc_id JOIN words y ON y.doc_id = x.doc_id AND y.i = x.i + d.q AND y.word = x.word
),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM equal GROUP BY doc_id, q, stretch HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, i FROM runs, unnest(range(start + period, start + length)) AS s(i)),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS collapsed FROM words x ANTI JOIN gone g ON x.doc_id = g.doc_id AND x.i = g.i GROUP BY x.doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
    list({'s': start, 'l': length, 'p': period} ORDER BY length / period DESC, start, period)[1] AS best
  FROM runs GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, 1000 * best.l // best.p AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM split d LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(vectors.withColumn("label", label), "vec_id % 50 = 0")


OP13_SQL = """
WITH sound AS (
  SELECT row_number() OVER () AS key, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.key AS anchor, a.id AS anchor_id, b.id, b.key, a.label = b.label AS alike, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM sound a JOIN sound b ON a.key <> b.key WHERE a.id % 50 = 0
),
positives AS (SELECT * FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, key) <= 5),
found AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.key ORDER BY n.score DESC, n.id, n.key) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.alike AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3
"""

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_url_filter": op5_url_filter,
    "op6_secrets": op6_secrets,
    "op7_bpe": op7_bpe,
    "op8_near_vectors": op8_near_vectors,
    "op9_token_files": op9_token_files,
    "op10_licenses": op10_licenses,
    "op11_quality": op11_quality,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op2_decontamination": OP2_SQL,
    "op4_repeated_passages": OP4_SQL,
    "op5_url_filter": OP5_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
