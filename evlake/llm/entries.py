"""The training-data operators as registered queries over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from evlake.llm.chat import read_back, windows
from evlake.llm.clustering import cluster
from evlake.llm.common import table
from evlake.llm.decontaminate import leaks
from evlake.llm.embedding_dedup import near_vectors
from evlake.llm.exact_dedup import exact_duplicates
from evlake.llm.html_text import extracted
from evlake.llm.language_model import scores as text_scores
from evlake.llm.mixing import mix
from evlake.llm.near_dedup import near_duplicates
from evlake.llm.oracles import NEIGHBOUR_SQL, TRIE_SQL, cluster_sql
from evlake.llm.pii import personal_data
from evlake.llm.prefix_trie import prefix_trie, rebuilt, turns_of
from evlake.llm.sharding import shards
from evlake.llm.toxicity import fit, scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op10_exact_dedup",
    """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY text)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op6_minhash_near_dedup",
    """
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (
      SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4
             THEN [array_to_string(ws, ' ')]
             ELSE [array_to_string(ws[i:i+3], ' ') FOR i IN range(1, len(ws) - 2)] END)) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (
      SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * k >= 80 * (x.n + y.n - k)),
    e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    r AS (SELECT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach),
    c AS (SELECT node, min(reach) AS root FROM r GROUP BY node)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id,
           d.doc_id = coalesce(c.root, d.doc_id) AS kept
    FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Labels in the order of the chain; the last decides.
CHAIN = ["quality", "toxic"]


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents rejected as toxic, with their probabilities."""
    docs = table(spark, sf_dir, "documents")
    return scores(docs, fit(docs, table(spark, sf_dir, "labels"), CHAIN)).where("rejected")


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


@query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


@query("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query("op9_chat_formatting")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    awkward = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return read_back(windows(rows.unionByName(awkward)))


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


@query("op7_lm_scoring")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_scores(table(spark, sf_dir, "documents"))


@query("op11_centroid_clustering", cluster_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "embeddings"), width=64, k=8, rounds=10, seed=3, scale=1024)
    return found.with_totals().withColumnRenamed("id", "vec_id")


@query("op12_embedding_near_dedup", NEIGHBOUR_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


@query("op13_prefix_trie", TRIE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(turns_of(table(spark, sf_dir, "conversations"))))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
