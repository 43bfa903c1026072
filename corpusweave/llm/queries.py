"""Registered queries of this package, each over its whole tables, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm import (
    chat_format,
    collocations,
    edit_counts,
    fill_middle,
    mixing,
    quality,
    sentencepieces,
    substring_dedup,
    token_files,
    top_k,
    toxicity,
    web_archives,
    weighted_minhash,
)
from corpusweave.llm.batches import drop_folder
from corpusweave.plans.registry import Query, table
from corpusweave.session import durable, scratch_path

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = Query(name, run, sql)
        return run

    return register


@query("op1_edit_counts")
def op1_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    edited = docs.withColumn("edits", edit_counts.sample_edits(F.col("doc_id"), F.col("text")))
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return edit_counts.count(edited, ranks, public_tokenizers.PATTERN, keep=["doc_id"])


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query("op3_chat_format")
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(marks).alias("text"),
    )
    records = chat_format.mixed_layouts(rows.unionByName(planted))
    # The roles of the table are canonical already, whatever they are called.
    return chat_format.read_back(chat_format.render(chat_format.canonical_turns(records, roles={})))


TOP_K_SQL = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from whole q join whole c on q.vec_id <> c.vec_id
    where q.vec_id % 50 = 0
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""


@query("op4_block_top_k", TOP_K_SQL)
def op4_block_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = top_k.quantised(table(spark, sf_dir, "embeddings"))
    return top_k.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


@query("op5_weighted_minhash")
def op5_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.assign(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = token_files.folder_uri(spark, scratch_path(spark, "token-files"))
    files = token_files.write(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    read = durable(token_files.read_back(files))
    drop_folder(spark, folder)
    return read


WARC_SQL = """
with marked as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
    from pages
), targeted as (
    select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end as target
    from marked
)
select page_id, payload_bytes, payload_digest,
    case when target is null or target is not distinct from page_id then 'response' else 'revisit' end as record_type,
    case when target is null or target is not distinct from page_id then null else target end as refers_to
from targeted
"""


@query("op7_web_archives", WARC_SQL)
def op7_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = web_archives.planned(table(spark, sf_dir, "pages"))
    folder = token_files.folder_uri(spark, scratch_path(spark, "warc-packages"))
    files = web_archives.write(plan, folder)
    read = web_archives.read_records(web_archives.ranges(files))
    number = lambda c: F.when(F.col(c) != "null", F.col(c)).cast("long").alias(c)
    result = durable(
        read.select(number("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))
    )
    drop_folder(spark, folder)
    return result


MIX_SQL = r"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
    from documents
), totals as (
    select source, sum(size)::hugeint as source_size from sized group by source
), ranked as (
    select source, source_size, 3 * source_size as cap,
        [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::hugeint as weight
    from totals
), walked as (
    select *, sum(source_size) over () as words, sum(weight) over () as weights,
        coalesce(sum(weight) over before, 0) as weight_before, coalesce(sum(cap) over before, 0) as cap_before
    from ranked
    window before as (order by source_size::double / weight::double, source nulls last
        rows between unbounded preceding and 1 preceding)
), stopped as (
    select *, cap * (weights - weight_before) < weight * (words - cap_before) as stops from walked
), level as (
    select (any_value(words) - coalesce(sum(cap) filter (stops), 0))::double
        / (sum(weight) filter (not stops))::double as height
    from stopped
), targets as (
    select source, source_size::bigint as source_size,
        case when stops then cap::double else weight::double * height end as target
    from stopped, level
), rated as (
    select doc_id, size, t.source_size, target,
        case when t.source_size > 0 then target / t.source_size else 0 end as rate,
        ('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint / 4503599627370496.0 as draw
    from sized s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
    (size * least(floor(rate) + (draw < rate - floor(rate))::int, 3))::bigint as taken
from rated
"""


@query("op8_mix_sources", MIX_SQL)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.plan(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "whole_ratio", "n_chunks", "n_bad_chunks",
    )


SUBSTRING_SQL = r"""
with words as (
    select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos
    from (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents)
), windows as (
    select *, case when count(*) over w = 20 then string_agg(word, ' ') over w end as window_text
    from words
    window w as (partition by doc_id order by pos rows between current row and 19 following)
), judged as (
    select *, window_text is not null
        and row_number() over (partition by window_text order by doc_id, pos) > 1 as repeated
    from windows
), covered as (
    select *, max(repeated::int) over (partition by doc_id order by pos rows between 19 preceding and current row) as gone
    from judged
), summed as (
    select doc_id, count(*) as n_words, sum(gone)::bigint as n_removed,
        string_agg(word, ' ' order by pos) filter (gone = 0) as kept
    from covered group by doc_id
)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from documents d left join summed s on d.doc_id = s.doc_id
"""


@query("op11_substring_dedup", SUBSTRING_SQL)
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


MIDDLE_SQL = r"""
with cut as (
    select doc_id, coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines,
        sha256('7:' || coalesce(doc_id::varchar, '')) as digest
    from documents
), drawn as (
    select *, len(lines) as n, [('0x' || substr(digest, 8 * k + 1, 8))::bigint for k in range(4)] as h from cut
), placed as (
    select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
        case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>') or h[3] % 100 >= 100
            then 'plain' when h[4] % 100 < 50 then 'spm' else 'psm' end as form
    from drawn
), parts as (
    select *, array_to_string(lines[1:a], '') as prefix, array_to_string(lines[a + 1:b], '') as middle,
        array_to_string(lines[b + 1:n], '') as suffix
    from placed
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
    case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then body when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(body) as restored_sha256
from parts
"""


@query("op12_fill_middle", MIDDLE_SQL)
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return fill_middle.restore(formed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored")
    )


PHRASE_SQL = r"""
with texts as (
    select row_number() over () as doc, coalesce(lang, 'und') as lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
    from documents
), pieces as (
    select lang, row_number() over () as piece, words from (
        select lang, regexp_extract_all(unnest(string_split_regex(body, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as words
        from texts)
    where len(words) > 0
), placed as (
    select lang, piece, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from pieces
), led as (
    select lang, word as w1, lead(word, 1) over w as w2, lead(word, 2) over w as w3, lead(word, 3) over w as w4
    from placed window w as (partition by lang, piece order by pos)
), totals as (
    select lang, count(*) as n from led group by lang
), grams as (
    select lang, [w1] as p, count(*) as f from led group by all
    union all select lang, [w1, w2], count(*) from led where w2 is not null group by all
    union all select lang, [w1, w2, w3], count(*) from led where w3 is not null group by all
    union all select lang, [w1, w2, w3, w4], count(*) from led where w4 is not null group by all
), often as (
    select lang, p, len(p) as words, f from grams where f >= 30
), cuts as (
    select lang, p, f as a, unnest(range(1, words)) as k from often where words > 1
), scored as (
    select c.lang, c.p, c.a, c.k, x.f as l, y.f as r,
        ((2000000::hugeint * c.a) // (x.f + y.f)::hugeint)::bigint as score
    from cuts c join often x on x.lang = c.lang and x.p = c.p[1:c.k]
        join often y on y.lang = c.lang and y.p = c.p[c.k + 1:]
), weakest as (
    select * from scored qualify row_number() over (partition by lang, p order by score, k) = 1
), inner_parts as (
    select lang, p[s:s + size - 1] as p, f from (
        select lang, p, words, f, size, unnest(range(1, words - size + 2)) as s
        from (select *, unnest(range(2, words)) as size from often where words > 2))
), covering as (
    select lang, p, max(f) as most from inner_parts group by all
), kept as (
    select w.*, array_to_string(w.p, ' ') as phrase from weakest w left join covering c on c.lang = w.lang and c.p = w.p
    where c.most is null or 100 * c.most < 80 * w.a
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select r.lang, rank, phrase, a, l, r, n, score from ranked r join totals t on t.lang = r.lang where rank <= 2000
"""


@query("op13_collocations", PHRASE_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents").select("lang", "text"))
