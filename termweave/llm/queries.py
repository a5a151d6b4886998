"""The registered queries of this subpackage and the SQL that checks them, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.llm import bpe, html, jaccard, langid, lm, multi_index, packing, periodic, quality, search, secrets, toxicity, transducer
from termweave.llm.shared import ship

#: Fixed value: the added token of the vocabulary byte_bpe_50k.
ADDED = {b"<|endoftext|>": 50256}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_REACHED = """
    , reached AS (
        SELECT {id} AS node, {id} AS root FROM nodes
        UNION
        SELECT links.b, root FROM reached JOIN links ON links.a = node
    ),
    classes AS (SELECT node, min(root) AS component_id FROM reached GROUP BY node)
"""

ORACLES["op1_inverted_multi_index"] = f"""
    WITH RECURSIVE nodes AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    fit AS (SELECT * FROM nodes WHERE list_dot_product(v, v) > 0 AND isfinite(list_dot_product(v, v))),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM fit x JOIN fit y
            ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.95
    )
    {_REACHED.format(id="vec_id")}
    SELECT node AS vec_id, (SELECT count(*) FROM links WHERE a = node) AS n_links, component_id,
        node = component_id AS kept
    FROM classes
"""

ORACLES["op8_jaccard_tiles"] = f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ),
    nodes AS (
        SELECT doc_id, CASE WHEN len(w) >= 5
            THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' '))))
            WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END AS s
        FROM words
    ),
    items AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM nodes),
    links AS (
        SELECT x.doc_id AS a, y.doc_id AS b
        FROM items x JOIN items y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
        GROUP BY x.doc_id, y.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
    )
    {_REACHED.format(id="doc_id")}
    SELECT doc_id, len(s) AS n_shingles, component_id FROM nodes JOIN classes ON node = doc_id
"""

ORACLES["op11_reversed_search"] = """
    WITH read AS (
        SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
    ),
    words AS (
        SELECT kind, id, row_number() OVER () AS r, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
        FROM read
    ),
    counts AS (
        SELECT kind, id, r, len(w) AS n, term, count(*) AS tf
        FROM (SELECT *, unnest(w) AS term FROM words) GROUP BY kind, id, r, len(w), term
    ),
    totals AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS length FROM words WHERE kind = 'd' AND len(w) > 0),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
        FROM counts, totals WHERE kind = 'd' GROUP BY term, docs
    ),
    scores AS (
        SELECT i.r AS item, i.id AS item_id, d.r, d.id AS doc_id,
            CAST(sum(i.tf * weight * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + (75 * d.n * docs) // length)))) AS BIGINT) AS score
        FROM counts i JOIN counts d USING (term) JOIN weights USING (term), totals
        WHERE i.kind = 'i' AND d.kind = 'd' GROUP BY i.r, i.id, d.r, d.id
    ),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""


@query
def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return multi_index.classes(table(spark, sf_dir, "embeddings"))


@query
def op2_html_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extracted(table(spark, sf_dir, "pages"))


@query
def op3_bpe_prefix_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document's text, and the bytes that they decode to, as digests."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.Bpe(ranks))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = quality.judged(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "p_good")


@query
def op5_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document; a tenth of them is held out from learning."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    lattice = lm.Lattice.from_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))
    scored = lm.scored(docs.select("doc_id", "text", (~held_out).alias("train")), lattice, "train")
    return scored.select("doc_id", held_out.alias("held_out"), *scored.columns[1:])


@query
def op6_language_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a third of them is held out from training."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = langid.fit(docs.where(~held_out))
    keyed = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predicted(keyed, model, ("doc_id", "held_out"))


@query
def op7_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.digests(table(spark, sf_dir, "documents"))


@query
def op8_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that share most of their shingles."""
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query
def op9_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op10_grouping_genetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.sequences(table(spark, sf_dir, "documents"), bpe.Bpe(ranks), added=ADDED)


@query
def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and what is left without repeats, as digests."""
    return periodic.digests(periodic.with_planted(table(spark, sf_dir, "documents")))


@query
def op13_token_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    vocabulary = transducer.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"))
    counted = transducer.counted(table(spark, sf_dir, "documents"), vocabulary)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)
