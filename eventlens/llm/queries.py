"""Registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict on every document."""
    from .quality_rules import verdicts
    return verdicts(table(spark, sf_dir, "documents"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms in all documents."""
    from .pii import digests
    return digests(table(spark, sf_dir, "documents"))


@query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from .near_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages found in all documents."""
    from .decontamination import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as ARC files, converted to WARC files, read back."""
    from .archives import convert, read_warc, write_arc
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(table(spark, sf_dir, "pages"), arc)
    convert(spark, arc, warc)
    return read_warc(spark, warc)


ORACLES["op5_archives"] = """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                      sha1(coalesce(html, '')) AS payload_digest FROM pages),
    k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
    FROM k"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later copies of repeated runs of lines."""
    from .line_dedup import without_repeats
    return without_repeats(table(spark, sf_dir, "documents"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    from .mixing import mixed_sizes
    return mixed_sizes(table(spark, sf_dir, "documents"))


ORACLES["op7_mixing"] = r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                      ('0x' || substr(md5(concat_ws(':', '7', doc_id)), 1, 15))::BIGINT AS rank FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (SELECT *, list_extract([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE], 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) AS weight,
                 row_number() OVER (ORDER BY source NULLS LAST) AS place, (2 * source_size)::DOUBLE AS cap FROM s),
    l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER o - cap))
                    / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM w WINDOW o AS (ORDER BY cap / weight, place)),
    t AS (SELECT source, source_size, CASE WHEN level * weight >= cap THEN cap
                 ELSE max(CASE WHEN level * weight < cap THEN level END) OVER () * weight END AS target FROM l),
    b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, size
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d)
    SELECT doc_id, size, source_size, target,
           (size * ((before + size / 2.0::DOUBLE <= target)::INT + (before + source_size + size / 2.0::DOUBLE <= target)::INT))::BIGINT AS taken
    FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source"""


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    from .html_text import extracted
    return extracted(table(spark, sf_dir, "pages"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-ID files of all documents, read back."""
    from .token_files import read_token_index, write_token_files
    out = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), out,
                      tokenizer_path=tokenizer_file("word_bpe_49k.json"), end_id=2)
    return read_token_index(spark, out)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    from .toxicity import scored, train
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels")))


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    from .token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), limit=1024)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    from .hard_negatives import mined
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, relabel=relabel)


ORACLES["op12_hard_negatives"] = """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      [floor(256 * x::DOUBLE) for x in embedding] AS v
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                 AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
                 list_inner_product(a.v, r.v)::BIGINT AS score
          FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
    n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank
          FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
               AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors."""
    from .vector_codes import digests
    return digests(table(spark, sf_dir, "embeddings"))


def _lloyd_sql(rounds: int = 4) -> str:
    """The rounds of op13 as one chain of tables."""
    steps = ["""
    k AS MATERIALIZED (SELECT vec_id, label, [floor(1024 * x::DOUBLE) for x in embedding] AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    parts AS MATERIALIZED (SELECT vec_id, label, p AS part, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x
              FROM k, range(4) t(p)),
    ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k QUALIFY entry < 256),
    b0 AS MATERIALIZED (SELECT part, entry, x AS c FROM parts JOIN ids USING (vec_id))"""]
    for r in range(rounds + 1):
        steps.append(f"""
    a{r} AS MATERIALIZED (SELECT vec_id, label, part, x, min(struct_pack(
                d := list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), e := entry)) AS m
              FROM parts JOIN b{r} USING (part) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""
    m{r} AS (SELECT part, m.e AS entry, unnest(x) AS x, unnest(range(len(x))) AS place FROM a{r}),
    s{r} AS (SELECT part, entry, list(q ORDER BY place) AS c
             FROM (SELECT part, entry, place, floor(sum(x) / count(*)) AS q FROM m{r} GROUP BY ALL) GROUP BY ALL),
    b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(s{r}.c, b{r}.c) AS c
                              FROM b{r} LEFT JOIN s{r} USING (part, entry))""")
    return "WITH " + ",".join(steps) + f""",
    sha AS (SELECT sha256(string_agg(list_aggregate([x::BIGINT::VARCHAR for x in c], 'string_agg', ','), ','
                                     ORDER BY part, entry)) AS h FROM b{rounds}),
    r AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code,
                 sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
    FROM r, sha"""


ORACLES["op13_vector_codes"] = _lloyd_sql()
