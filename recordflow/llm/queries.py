"""The registered queries of this subpackage, with SQL where SQL expresses them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recordflow.llm import (
    decontamination, filter_audit, language_id, language_model, mixing, nearest, quality_classifier, quality_rules, simhash, spelling,
    suffix_dedup, token_counts, url_filters,
)
from recordflow.llm.base import remainder
from recordflow.plans.registry import query, table

TOKENIZER = "piece_bpe_32k.model"


def learned():
    """Documents that classifiers may learn from; those with remainder 1 are held out."""
    return remainder(F.col("doc_id"), 3) != 1


@query("op1_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs, learned()))


@query("op4_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_url_filters")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_language_model")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"))


@query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), learned())
    return quality_classifier.score_documents(docs, model)


@query("op11_spelling_variants", """
with recursive crc_bits as (
    select i as byte, 0 as k, i as c from range(256) r(i)
    union all
    select byte, k + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc_bits where k < 8
), crc_table as (
    select byte, c as value from crc_bits where k = 8
), runs as (
    select coalesce(cast(doc_id as varchar), '') as id,
           translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as times
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents)
    where length(run) >= 6
    group by 1, 2
), bytes as (
    select *, flatten(list_transform(string_split(id || ':' || run, ''),
              lambda c: case when ord(c) < 128 then [ord(c)] else [195, ord(c) - 64] end)) as b
    from runs
), crc as (
    select id, run, times, b, 1 as pos, cast(4294967295 as bigint) as c from bytes
    union all
    select id, run, times, b, pos + 1, xor(c >> 8, value)
    from crc join crc_table on byte = (xor(c, b[pos]) & 255)
    where pos <= len(b)
), hashed as (
    select run, times, xor(c, 4294967295) as h from crc where pos = len(b) + 1
), words as (
    select word, cast(sum(times) as bigint) as n
    from (
        select times, case when h % 199 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
        from hashed
    )
    where length(word) >= 6
    group by word
    having sum(times) >= 5
), shorter as (
    select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest from words, lateral (select unnest(range(1, length(word) + 1)) as i)
), pairs as (
    select a.word, b.word as other, b.n as other_n from shorter a join shorter b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union
    select a.word, b.word, b.n from shorter a join words b on a.rest = b.word
    union
    select b.word, a.word, a.n from shorter a join words b on a.rest = b.word
), near as (
    select word, count(*) as n_near, max(other_n) as best_n, arg_min(other, (-other_n, other)) as best from pairs group by word
), formed as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when best_n >= 5 * w.n then best end as form,
           case when best_n >= 5 * w.n then best_n end as form_n
    from words w left join near using (word)
), chain as (
    select word, word as root, 0 as d from formed
    union all
    select c.word, f.form, d + 1 from chain c join formed f on c.root = f.word where f.form is not null
)
select f.word, f.n, f.n_near, f.form, f.form_n, (select arg_max(root, d) from chain c where c.word = f.word) as root from formed f
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op12_filter_audit", """
with recursive texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words
    from documents
), flags as (
    select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
    from labels where doc_id is not null group by doc_id
), masks as (
    select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
           cast(len(words) < 100 as int) + 2 * cast(100 * len(list_distinct(words)) < 80 * len(words) as int)
           + 4 * cast(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) as int)
           + 8 * cast(regexp_matches(text, '[#$%&*|]') as int)
           + 16 * cast(coalesce(min(t.doc_id) over (partition by text) < t.doc_id, false) as int) as mask
    from texts t left join flags f on t.doc_id = f.doc_id
), counts as (
    select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from masks group by part, mask
), orders as (
    select '' as o, 0 as step, 0 as earlier, 0 as bit
    union all
    select o || letter, step + 1, earlier | bit, b
    from orders, (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) f(letter, b)
    where (earlier | bit) & b = 0
), steps as (
    select full_order.o as filter_order, s.step, s.bit, s.earlier
    from orders full_order join orders s on full_order.step = 5 and s.step > 0 and full_order.o[1:s.step] = s.o
)
select part, filter_order, cast(step as int) as step,
       cast(coalesce(sum(n) filter (mask & (earlier | bit) = 0), 0) as bigint) as kept,
       cast(coalesce(sum(n) filter (mask & bit > 0 and mask & earlier = 0), 0) as bigint) as removed,
       cast(coalesce(sum(n) filter (mask & bit > 0 and mask & earlier > 0), 0) as bigint) as redundant,
       cast(coalesce(sum(n) filter (mask = bit), 0) as bigint) as unique_fails,
       cast(coalesce(sum(good) filter (mask & bit > 0 and mask & earlier = 0), 0) as bigint) as good_lost,
       cast(coalesce(sum(toxic) filter (mask & bit > 0 and mask & earlier = 0), 0) as bigint) as toxic_lost,
       cast(coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) filter (mask & bit > 0), 0) as bigint) as shapley
from counts, steps
group by part, filter_order, step, bit, earlier
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


@query("op13_nearest_neighbours")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
