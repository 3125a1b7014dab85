"""The query of the manifest: each row's proof, tried on rows of which some were changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.llm import merkle
from jornada.llm.crc_sql import CRC_TABLE, crc_of
from jornada.llm.inputs import documents

TAMPERED_EACH = 7


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED_EACH == 0
    tampered = F.when(hit, merkle.leaf({"n_chars": F.col("n_chars") + 1}))
    found = merkle.manifest(documents(spark, folder), _tampered=tampered)
    found = found.withColumn("folded_root", merkle.folded(F.coalesce("_tampered", "leaf"), F.col("proof")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


OP12_SQL = f"""
with recursive {CRC_TABLE},
rows as (
    select doc_id, lang, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') head,
        n_chars, coalesce(strlen(text) || ':' || text, '-') tail,
        {crc_of("list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)")} % 7 = 0 hit
    from documents, crc_table
), leaves as (
    select doc_id, lang, hit, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) leaf,
        sha256(head || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || tail) other
    from rows
), placed as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 pos,
        count(*) over (partition by lang) n, row_number() over () id
    from leaves
), nodes as (
    select lang, 0 level, pos, n, leaf hash from placed
    union all
    select lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(hash, '' order by pos))
    from nodes where n > 1 group by lang, level, n, pos // 2
), subroots as (
    select lang, hash subroot, row_number() over (order by lang nulls first) - 1 pos, count(*) over () n
    from nodes where n = 1
), tops as (
    select 0 level, pos, n, subroot hash from subroots
    union all
    select level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(hash, '' order by pos))
    from tops where n > 1 group by level, n, pos // 2
), steps as (
    select p.id, a.level seq, p.pos >> a.level & 1 slot, coalesce(b.hash, '') sibling
    from placed p
    join nodes a on a.lang is not distinct from p.lang and a.pos = p.pos >> a.level and a.n > 1
    left join nodes b on b.lang is not distinct from p.lang and b.level = a.level and b.pos = xor(a.pos, 1)
    union all
    select p.id, 1000 + a.level, s.pos >> a.level & 1, coalesce(b.hash, '')
    from placed p
    join subroots s on s.lang is not distinct from p.lang
    join tops a on a.pos = s.pos >> a.level and a.n > 1
    left join tops b on b.level = a.level and b.pos = xor(a.pos, 1)
), ordered as (
    select id, row_number() over (partition by id order by seq) step, slot, sibling from steps
), folds as (
    select id, 0 step, case when hit then other else leaf end hash from placed
    union all
    select f.id, o.step, sha256(case when o.slot = 1 then o.sibling || f.hash else f.hash || o.sibling end)
    from folds f join ordered o on o.id = f.id and o.step = f.step + 1
), ends as (
    select id, max_by(hash, step) folded_root from folds group by id
), proofs as (
    select id, sha256(string_agg(sibling, '' order by step)) proof_sha256 from ordered group by id
)
select doc_id, leaf, subroot, t.hash root, coalesce(proof_sha256, sha256('')) proof_sha256, folded_root,
    folded_root = t.hash verified
from placed p
join subroots s on s.lang is not distinct from p.lang
join tops t on t.n = 1
join ends using (id)
left join proofs using (id)
"""
