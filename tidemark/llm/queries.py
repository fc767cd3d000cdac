"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    collocations,
    decontamination,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    spelling_variants,
    token_counts,
    token_files,
    topk_search,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return token_counts.count_with_edits(docs, token_counts.revision_edits())


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(_documents(spark, sf_dir), end_id=2)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.scored(docs, quality_classifier.train(docs, labels))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_documents(spark, sf_dir))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_documents(spark, sf_dir), n=5, percent=75)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.judge(docs.select("doc_id", "text"), quality_rules.train(docs, labels)).select(
        "doc_id", *quality_rules.STATISTICS, "base_failed", "kept")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_documents(spark, sf_dir))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk_search.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    text = F.coalesce("clean_text", F.lit(""))
    return found.select("doc_id", "n_lines", "n_dropped", F.char_length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), capacity=2048, end_id=0)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(_documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_token_files": op2_token_files,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_license_scan": op4_license_scan,
    "op5_ngram_join": op5_ngram_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_bpe": op7_bpe,
    "op8_topk_search": op8_topk_search,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_collocations": op12_collocations,
    "op13_decontamination": op13_decontamination,
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL: dict[str, str] = {
    "op5_ngram_join": f"""
        with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
        sets as (select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words),
        shingles as (select doc_id, unnest(s) as x from sets),
        pairs as (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2),
        links as (select a, b from pairs join sets x on x.doc_id = a join sets y on y.doc_id = b where 100 * n >= 75 * (len(x.s) + len(y.s) - n)),
        reached as (select doc_id, doc_id as other from sets union select doc_id, b from reached join links on other = a)
        select doc_id, cast(len(s) as bigint) as n_shingles, min(other) as component_id from sets join reached using (doc_id) group by doc_id, len(s)""",
    "op8_topk_search": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
            where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
        scores as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
        select query_id, rank, vec_id, score from (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scores) where rank <= 5""",
    "op12_collocations": f"""
        with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
        lists as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
        totals as (select lang, sum(len(w)) as n from lists group by 1),
        grams as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
            from lists, (select unnest([1, 2, 3, 4, 5]) as k) where len(w) >= k),
        found as (select lang, k, phrase, count(*) as f, string_split(phrase, ' ') as w from grams group by 1, 2, 3 having count(*) >= 100),
        candidates as (select * from found where k > 1),
        inner_ones as (select lang, f, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) as phrase from candidates where k > 2),
        kept as (select * from candidates c where not exists (select 1 from inner_ones i where i.lang = c.lang and i.phrase = c.phrase and 100 * i.f >= 100 * c.f)),
        cuts as (select lang, phrase, w, f, unnest(range(1, k)) as cut from kept),
        parts as (select c.lang, c.phrase, c.cut, c.f as a, x.f as l, y.f as r, t.n, (1000::hugeint * c.f * t.n) // (x.f::hugeint * y.f) as score from cuts c
            join found x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.cut], ' ') join found y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
            join totals t on t.lang = c.lang),
        best as (select * from parts qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
        select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
        from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best) where rank <= 2000""",
    "op13_decontamination": f"""
        with items as (select cast(item_id as varchar) as item, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') as w from benchmark where item_id is not null and text is not null),
        windows as (select distinct item, least(10, len(w)) as size, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2), lambda i: array_to_string(w[i:i + 9], ' '))) as x from items where len(w) > 0),
        lists as (select row_number() over () as id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w from documents),
        places as (select id, size, unnest(range(1, len(w) - size + 2)) as i from lists, (select distinct size from windows) where len(w) >= size),
        grams as (select id, size, i, array_to_string(w[i:i + size - 1], ' ') as x from places join lists using (id)),
        hits as (select g.id, g.i, g.size, v.item from grams g join windows v on v.size = g.size and v.x = g.x),
        words as (select id, count(distinct j) as n_hit from (select id, unnest(range(i, i + size)) as j from (select distinct id, i, size from hits)) group by 1),
        names as (select id, count(*) as n_items, string_agg(item, ',' order by item) as found from (select distinct id, item from hits) group by 1)
        select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
            sha256(coalesce(found, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from lists left join words using (id) left join names using (id)""",
}
