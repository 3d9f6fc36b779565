"""The queries of these operators over the test tables, with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import byte_bpe, language, toxicity
from tidewell.llm.centroid_clusters import cluster
from tidewell.llm.decontamination import contaminated
from tidewell.llm.html_text import extract
from tidewell.llm.packing import pack
from tidewell.llm.simhash import near_duplicates
from tidewell.llm.suffix_dedup import remove_repeats
from tidewell.llm.token_counts import count_tokens
from tidewell.llm.url_filter import first_segment, host_of, judge, path_of
from tidewell.llm.vector_codes import compress
from tidewell.llm.vector_search import top_k
from tidewell.llm.worker import small_batches
from tidewell.operators.lookup import lookup
from tidewell.session import stage

TOKEN_LIMIT = 1024


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _remainder(key: str, of: int) -> Column:
    """The crc32 of the key as text, modulo ``of``."""
    return F.crc32(F.col(key).cast("string")) % of


def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(_read(spark, folder, "pages"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, held_out = _read(spark, folder, "documents"), F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    machine = toxicity.learn(documents, _read(spark, folder, "labels"), ~held_out, most_rows=20_000)
    scored = toxicity.score(documents, machine)
    predicted = (F.col("score") >= 0.7).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = remove_repeats(_read(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(_read(spark, folder, "documents"), width=4, distance=4)
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", fingerprint, F.col("component").alias("component_id"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    documents, held_out = _read(spark, folder, "documents"), F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    model = language.learn(documents, public_tokenizers.path("piece_bpe_32k.model"), ~held_out, per_language=400)
    found = language.identify(documents, model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page is a capture with a day, and brings one dated entry of one of two lists."""
    pages = _read(spark, folder, "pages")
    start, page = F.lit("2024-01-01").cast("date"), F.col("page_id")

    def day(times: int, plus: int) -> Column:
        return F.date_add(start, ((page * times + plus) % 90).cast("int"))

    host, path = host_of(F.col("url")), path_of(F.col("url"))
    kind = page % 20
    pattern = (
        F.when(kind == 0, host)
        .when(kind == 1, F.regexp_extract(host, r"([^.]+[.][^.]+[.][^.]+)$", 1))
        .when(kind == 2, F.concat(host, first_segment(path)))
        .otherwise(F.concat(host, path))
    )
    entries = pages.where(host != "").select(
        F.when(F.expr("page_id div 20") % 2 == 0, "spam").otherwise("malware").alias("list"),
        F.when(pattern != "", pattern).alias("pattern"),
        day(37, 0).alias("day"),
        (F.expr("page_id div 40") % 4 != 3).alias("listed"),
    )
    captures = pages.select("page_id", "url", day(53, 11).alias("fetched_on"))
    return judge(captures, entries, key="page_id", url="url", day="fetched_on")


OP6_SQL = r"""
WITH p AS (
  SELECT page_id, url,
    coalesce(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '') AS host,
    coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)', 1), '') AS path,
    DATE '2024-01-01' + CAST((page_id * 53 + 11) % 90 AS INTEGER) AS fetched_on,
    DATE '2024-01-01' + CAST((page_id * 37) % 90 AS INTEGER) AS day,
    CASE WHEN (page_id // 20) % 2 = 0 THEN 'spam' ELSE 'malware' END AS list,
    (page_id // 40) % 4 <> 3 AS listed
  FROM pages
), e AS (
  SELECT list, pattern, day, max(listed) AS listed FROM (
    SELECT list, day, listed, CASE page_id % 20
      WHEN 0 THEN host
      WHEN 1 THEN regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1)
      WHEN 2 THEN host || regexp_extract(path, '^(/[^/]*)', 1)
      ELSE host || path END AS pattern
    FROM p WHERE host <> '') WHERE pattern <> '' AND day IS NOT NULL GROUP BY ALL
), i AS (
  SELECT list, pattern, listed, day AS valid_from,
    lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS valid_until FROM e
), hits AS (
  SELECT DISTINCT p.page_id, p.url, p.fetched_on, i.list || ':' || i.pattern AS rule
  FROM p JOIN i ON i.listed AND p.fetched_on >= i.valid_from AND (i.valid_until IS NULL OR p.fetched_on < i.valid_until)
    AND p.host <> '' AND (i.pattern IN (p.host || p.path, p.host || regexp_extract(p.path, '^(/[^/]*)', 1), p.host)
      OR (contains(i.pattern, '.') AND ends_with(p.host, '.' || i.pattern)))
), r AS (
  SELECT page_id, url, fetched_on, string_agg(rule, ' ' ORDER BY rule) AS rules, CAST(count(*) AS INTEGER) AS n_rules FROM hits GROUP BY ALL
)
SELECT p.page_id, p.url, p.host, p.fetched_on, r.rules IS NOT NULL AS blocked, coalesce(r.rules, '') AS rules,
  coalesce(r.n_rules, 0) AS n_rules
FROM p LEFT JOIN r ON r.page_id = p.page_id AND r.url IS NOT DISTINCT FROM p.url
"""


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"), share=0.8)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(
        _read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=TOKEN_LIMIT
    )
    over = F.col("n_tokens") > TOKEN_LIMIT
    return counted.select("doc_id", "n_bytes", "n_tokens", over.alias("over_limit"), "cut_bytes")


def op9_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(_read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


OP9_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.r <> q.r AND len(c.v) = len(q.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(_read(spark, folder, "documents"), tokenizer, most=4096, closing_id=2, with_ids=False)


def _digest(numbers: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = compress(_read(spark, folder, "embeddings"), parts=4, entries=256, rounds=4, scale=1024, keep=("label",))
    hex_codes = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    rows = stage(coded.select("vec_id", "label", hex_codes.alias("code"), "error"), "codes")
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))  # keeps null joinable
    per_label = stage(rows.groupBy(label.alias("key")).agg(F.sum("error").alias("label_error")), "label-errors")
    summed = lookup(rows, per_label, {"key": label}, {"label_error": "label_error"})
    digest = F.lit(_digest([int(x) for book in books for entry in book for x in entry]))
    return summed.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _op11_sql() -> str:
    """The rounds written out one after the other."""

    def assigned(round_: int) -> str:
        apart = "list_inner_product(w, w) - 2 * list_inner_product(w, c.c) + list_inner_product(c.c, c.c)"
        return f"""a{round_} AS MATERIALIZED (
  SELECT r, p, any_value(w) AS w, min({{'d': CAST({apart} AS BIGINT), 'e': e}}) AS best
  FROM parts JOIN c{round_} c USING (p) GROUP BY r, p
)"""

    def improved(round_: int) -> str:
        return f"""c{round_ + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, old.c) AS c FROM c{round_} old LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS c FROM (
      SELECT p, best.e AS e, i, floor(sum(w[i]) / count(*)) AS x FROM a{round_}, range(1, 17) g(i) GROUP BY ALL
    ) GROUP BY p, e) m USING (p, e)
)"""

    rounds = ",\n".join(f"{assigned(i)},\n{improved(i)}" for i in range(4))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), parts AS MATERIALIZED (
  SELECT r, CAST(p AS INTEGER) AS p, v[16 * p + 1 : 16 * p + 16] AS w FROM k, range(4) g(p)
), c0 AS MATERIALIZED (
  SELECT p, e, w AS c FROM parts JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM k) USING (r) WHERE e < 256
), {rounds},
{assigned(4)}, books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY p, e)) AS codebooks_sha256
  FROM c4
), coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a4 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN k USING (r), books
"""


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found, centroids = cluster(_read(spark, folder, "embeddings"), clusters=40, rounds=5, dims=64, scale=256, salt="2:")
    rows = stage(found, "clusters")
    inertia = {r["cluster"]: int(r["sum"]) for r in rows.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()}
    total = sum(inertia.values())
    about = [(c, i, total, _digest(centroids[c].tolist())) for c, i in inertia.items()]
    table = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = rows.join(F.broadcast(table), "cluster")  # a row per centroid
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op12_sql() -> str:
    """The rounds written out one after the other."""

    def assigned(round_: int) -> str:
        apart = "list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c)"
        return f"""a{round_} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': CAST({apart} AS BIGINT), 'e': e}}) AS best FROM k, c{round_} GROUP BY r
)"""

    def improved(round_: int) -> str:
        return f"""c{round_ + 1} AS MATERIALIZED (
  SELECT e, coalesce(m.c, old.c) AS c FROM c{round_} old LEFT JOIN (
    SELECT e, list(x ORDER BY i) AS c FROM (
      SELECT best.e AS e, i, floor(sum(v[i]) / count(*)) AS x FROM a{round_}, range(1, 65) g(i) GROUP BY ALL
    ) GROUP BY e) m USING (e)
)"""

    rounds = ",\n".join(f"{assigned(i)},\n{improved(i)}" for i in range(5))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT e, v AS c FROM (SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS e FROM k WHERE vec_id IS NOT NULL)
  WHERE e < 40
), {rounds},
{assigned(5)}
SELECT vec_id, CAST(best.e AS INTEGER) AS cluster, best.d AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.e) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a5 JOIN c5 ON e = best.e
"""


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = _read(spark, folder, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(documents, ranks, public_tokenizers.PATTERN, most_words=1 << 18)
    listed = F.to_json("ids")  # [1,2,3]
    joined = F.substring(listed, F.lit(2), F.length(listed) - 2)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(spark, F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (
        op1_html_text, op2_toxicity, op3_suffix_dedup, op4_simhash, op5_language, op6_url_filter, op7_decontamination, op8_token_counts, op9_top_k, op10_packing,
        op11_vector_codes, op12_centroid_clusters, op13_byte_bpe,
    )
    return {q.__name__: q for q in made}


def llm_oracles() -> dict[str, str]:
    return {
        "op6_url_filter": OP6_SQL,
        "op9_top_k": OP9_SQL,
        "op11_vector_codes": _op11_sql(),
        "op12_centroid_clusters": _op12_sql(),
    }
