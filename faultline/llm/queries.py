"""Registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import (
    best_fit,
    cross_parse,
    curriculum,
    decontaminate,
    grammar_tokens,
    hard_negatives,
    line_runs,
    main_text,
    near_dups,
    surrogates,
    syncmers,
    vantage,
    whitening,
)
from faultline.llm.common import table

#: Key of the surrogates in the registered query; a run brings its own.
SURROGATE_KEY = "registered-query"


def word_bpe_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_grammar_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return grammar_tokens.token_ids(docs, word_bpe_file())


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = curriculum.place(table(spark, sf_dir, "documents"))
    position = F.get("copies", 0)["position"]
    return placed.select(
        "doc_id", "size", "source_size", "target", "taken", position.alias("first_position")
    )


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op5_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(table(spark, sf_dir, "embeddings"))


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(table(spark, sf_dir, "documents"))


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_lines", "n_deleted"
    )


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_pages(table(spark, sf_dir, "pages"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_private(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op10_cross_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_parse.identify(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        decontaminate.items_digest("item_ids").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    return hard_negatives.mine(
        table(spark, sf_dir, "embeddings"), relabel=shifted.otherwise(F.col("label"))
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_grammar_tokens,
        op2_curriculum_mix,
        op3_syncmers,
        op4_near_dups,
        op5_vantage,
        op6_best_fit,
        op7_line_runs,
        op8_main_text,
        op9_surrogates,
        op10_cross_parse,
        op11_whitening,
        op12_decontaminate,
        op13_hard_negatives,
    )
}

_WORDS = (
    "regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SQL: dict[str, str] = {
    "op12_decontaminate": f"""with item_words as (
      select item_id, {_WORDS.format(text="text")} as w from benchmark where text is not null),
    item_windows as (
      select distinct item_id, least(len(w), 10) as n,
        array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as s
      from (select *, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from item_words where len(w) > 0)),
    doc_words as (
      select row_number() over () as r, doc_id, coalesce({_WORDS.format(text="text")}, []) as w from documents),
    places as (
      select r, n, w, unnest(range(1, len(w) - n + 2)) as i
      from doc_words join (select distinct n from item_windows) on len(w) >= n),
    finds as (
      select r, i, p.n, item_id from (select r, n, i, array_to_string(w[i : i + n - 1], ' ') as s from places) p
      join item_windows t on p.n = t.n and p.s = t.s),
    hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from finds) group by r),
    named as (
      select r, count(*) as n_items, string_agg(id, ',' order by id) as ids
      from (select distinct r, cast(item_id as varchar) as id from finds) group by r)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
      sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from doc_words left join hit using (r) left join named using (r)""",
    "op13_hard_negatives": """with rows_ as (
      select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
        list_transform(embedding, lambda v: floor(256 * v::double)) as x
      from embeddings
      where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
    scored as (
      select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
        cast(list_inner_product(a.x, b.x) as bigint) as score
      from rows_ a join rows_ b on a.vec_id <> b.vec_id and len(a.x) = len(b.x) where a.vec_id % 100 = 0),
    positives as (
      select * from scored where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select p.anchor_id, p.vec_id as positive_id,
      cast(row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) as integer) as rank,
      n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
    from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
      and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
    qualify rank <= 5""",
}
