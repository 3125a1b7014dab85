"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.llm import exact_dedup, fingerprints, jaccard_join, languages, line_dedup, lm_scoring, mixing, packing, pii, quality, url_filter
from jornada.llm.inputs import DOCUMENTS, LABELS, PAGES, documents  # noqa: F401
from jornada.llm.merkle_query import OP12_SQL, op12_merkle_manifest
from jornada.llm.spelling_query import OP13_SQL, op13_spelling_variants
from jornada.llm.words import or_empty


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = spark.read.schema(LABELS).parquet(f"{folder}/labels.parquet")
    values, model = quality.ranked(docs, labels)
    scored = values.withColumn("score", quality.score_of(F.col("value"), model))
    accepted = (F.col("score") >= quality.ACCEPT_FROM).cast("int")
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", accepted.alias("predicted"))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.fingerprint_documents(documents(spark, folder))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("print")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, folder))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.schema(PAGES).parquet(f"{folder}/pages.parquet")
    return url_filter.judge(pages)


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = exact_dedup.scratch_index(spark)
    found = exact_dedup.dedup(documents(spark, folder), index)
    index.close()
    return found.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


OP5_SQL = r"""
with digests as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) text_sha256
    from documents
)
select doc_id, min(doc_id) over same keep_id, count(*) over same group_size,
    doc_id = min(doc_id) over same kept, text_sha256
from digests window same as (partition by text_sha256)
"""


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder), carry=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_texts(documents(spark, folder))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(documents(spark, folder))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(documents(spark, folder))
    plain = F.filter("spans", lambda x: x["plain"])

    def told(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.withColumn("_plain", plain).select(
        "doc_id",
        *[F.size(F.filter("_plain", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(told(F.col("_plain")), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, folder).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(or_empty(), 256).alias("kept_sha256"))


OP10_SQL = r"""
with lines as (
    select doc_id, pos, line, lower_key from (
        select doc_id, unnest(list) line, unnest(range(len(list))) pos from (
            select doc_id, string_split(coalesce(text, ''), chr(10)) list from documents)
    ) x, lateral (select translate(trim(x.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') lower_key) y
), shared as (
    select lower_key, min(doc_id) first_doc from lines where length(lower_key) >= 10
    group by lower_key having count(distinct doc_id) >= 2
), marked as (
    select l.doc_id, pos, line, s.first_doc is not null and l.doc_id > s.first_doc as gone
    from lines l left join shared s using (lower_key)
)
select doc_id, count(*) n_lines, cast(count(*) filter (gone) as bigint) n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from marked group by doc_id
"""

def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = languages.label_languages(docs, languages.learn(docs))
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_fingerprints": op2_fingerprints,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_url_filter": op4_url_filter,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mixing": op6_mixing,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_packing": op8_packing,
    "op9_pii": op9_pii,
    "op10_line_dedup": op10_line_dedup,
    "op11_language_id": op11_language_id,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLES = {
    "op5_exact_dedup": OP5_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
