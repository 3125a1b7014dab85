"""The query of the spelling variants, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jornada.llm.crc_sql import CRC_TABLE, crc_of
from jornada.llm.inputs import documents
from jornada.llm.spelling import spelling_groups


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups(documents(spark, folder))


_BYTES = """list_transform(range(length(code) // 2), lambda i:
        (instr('123456789ABCDEF', code[2 * i + 1]) * 16 + instr('123456789ABCDEF', code[2 * i + 2]))::bigint)"""

OP13_SQL = rf"""
with recursive {CRC_TABLE},
runs as (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run, count(*) n
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) run from documents)
    where length(run) >= 7 group by all
), coded as (
    select run, n, hex(doc_id::varchar || ':' || run) code from runs
), hashed as (
    select run, n, {crc_of(_BYTES)} h from coded, crc_table
), words as (
    select word, sum(n)::bigint n from (
        select case when h % 31 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end word, n from hashed
    ) where length(word) >= 7 group by word having sum(n) >= 2
), places as (
    select word, n, unnest(range(length(word))) place from words
), without as (
    select word, n, place, word[:place] || word[place + 2:] rest from places
), pairs as (
    select a.word, b.word other, b.n other_n from without a join without b on a.place = b.place and a.rest = b.rest and a.word <> b.word
    union
    select a.word, b.word, b.n from without a join words b on a.rest = b.word
    union
    select b.word, a.word, a.n from without a join words b on a.rest = b.word
), best as (
    select word, count(*) n_near, min(row(-other_n, other)) first from pairs group by word
), forms as (
    select w.word, w.n, coalesce(n_near, 0) n_near, case when -first[1] >= 10 * w.n then first[2] end form,
        case when -first[1] >= 10 * w.n then -first[1] end form_n
    from words w left join best b on b.word = w.word
), chain as (
    select word, form root, 1 step from forms where form is not null
    union all
    select c.word, f.form, step + 1 from chain c join forms f on f.word = c.root where f.form is not null
), ends as (
    select word, max_by(root, step) root from chain group by word
)
select f.word, form, coalesce(e.root, f.word) root, n, n_near, form_n from forms f left join ends e on e.word = f.word
"""
