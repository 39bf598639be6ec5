"""The subpackage's queries: operators with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL if it has one."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op3_direct_codes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.direct_codes import read_documents, write_tokens
    from corpuslens.llm.scratch import shared_folder

    path = shared_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return read_documents(spark, path)


OP8_SQL = r"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') FROM benchmark
), grams AS (
  SELECT side, id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ') || ' #short'] ELSE [] END) AS g FROM words
), d AS (SELECT DISTINCT id, g FROM grams WHERE side = 'd'),
   b AS (SELECT DISTINCT id, g FROM grams WHERE side = 'b'),
   n AS (SELECT id, count(*) AS n_item FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, any_value(n_item) AS n_item, count(*) / any_value(n_item) AS containment
FROM d JOIN b ON d.g = b.g JOIN n ON n.id = b.id
GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(n_item)
"""


@query("op8_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]

OP9_SQL = r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), hits AS (
  SELECT s.page_id, s.host, s.path, r.*,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST) AS n
  FROM split s LEFT JOIN rules r ON ('.' || s.host) LIKE ('%.' || r.rule_host) AND starts_with(s.path, r.rule_path)
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
FROM hits WHERE n = 1
"""


@query("op9_url_rules", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.url_rules import url_verdicts

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


@query("op5_language_spans")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.language import detect, train

    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = train(docs, ~held)
    return detect(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


OP7_SQL = r"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""


@query("op7_topk_threshold", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.topk import quantized, top_k

    vectors = quantized(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query("op10_toxicity_grammar")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.toxicity import score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = train(docs, table(spark, sf_dir, "labels"), ~held)
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Production takes the key from its secret store; this one only makes results repeatable.
SURROGATE_KEY = b"corpuslens surrogate key 1"


@query("op1_surrogates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.pii import pseudonymize

    done = pseudonymize(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return done.select("doc_id", "text", F.size("entity_kinds").cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct("entity_kinds")), ",").alias("kinds"))


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ') || ' #short'] ELSE [] END) AS g FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
rare AS (
  SELECT g.doc_id, g.g, s.n, row_number() OVER (PARTITION BY g.doc_id ORDER BY f.c, g.g) AS place
  FROM grams g JOIN (SELECT g, count(*) AS c FROM grams GROUP BY g) f ON g.g = f.g JOIN sizes s ON s.doc_id = g.doc_id
), pairs AS (
  SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM rare a JOIN rare b ON a.g = b.g AND a.doc_id < b.doc_id
  WHERE a.place <= a.n - ceil(0.85 * a.n) + 1 AND b.place <= b.n - ceil(0.85 * b.n) + 1 AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
), links AS (
  SELECT p.x, p.y FROM pairs p JOIN grams a ON a.doc_id = p.x JOIN grams b ON b.doc_id = p.y AND a.g = b.g
  JOIN sizes s ON s.doc_id = p.x JOIN sizes t ON t.doc_id = p.y
  GROUP BY p.x, p.y, s.n, t.n HAVING 100 * count(*) >= 85 * (s.n + t.n - count(*))
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.y) AS component_id, d.doc_id = min(r.y) AS kept
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op4_tensored_minhash", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85, widths=(3, 3)).drop("version")


@query("op6_license_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpuslens.llm.license import license_documents

    return license_documents(table(spark, sf_dir, "documents"))
