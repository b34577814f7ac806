"""Registered queries of the operators and, where SQL expresses them, their DuckDB SQL.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanflow.llm import (
    byte_cnn, extendible_hash, gam, nn_descent, packing, periodic_runs, positional_index, revisits, rns_gemm, suffix_buckets, suffix_trees,
    superminhash, token_counts,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: One page in ten stands under this address, which so is asked for by a tenth of the archive.
HOT_URL = "https://www.hot.example/front"


def archive_records(pages: DataFrame) -> DataFrame:
    """Archive records made of each page: three full responses two days apart, of which odd
    pages change from one to the next, and a revisit of another spelling of its URL at a
    day before, between or after them, with equal, weak, changed, other or no validators.
    Times are to the millisecond."""
    at = "timestamp_millis((1704067200 + page_id * 37) * 1000 + page_id % 4 * 250)"
    url = f"case when page_id % 10 = 3 then '{HOT_URL}' else url end"
    tag = "concat('\"', md5(html), {version}, '\"')"
    own, known = tag.format(version="page_id % 2 * capture"), tag.format(version="page_id % 2 * (page_id % 3)")
    response = pages.selectExpr("*", "explode(array(0, 1, 2)) as capture").selectExpr(
        "page_id * 8 + capture as record_id", "'response' as kind", f"{url} as url",
        f"{at} + make_dt_interval(capture * 2) as at",
        f"map('ETag', {own}, 'Last-Modified', concat('T', page_id % 3), 'Content-Type', 'text/html',"
        " 'Content-Length', cast(octet_length(html) as string), 'Cache-Control', 'max-age=60', 'Date', cast(page_id as string)) as headers",
    )
    revisit = pages.selectExpr(
        "page_id * 8 + 7 as record_id", "'revisit' as kind",
        f"case page_id % 3 when 0 then concat({url}, '#seen') when 1 then replace({url}, 'https://', 'http://') else {url} end as url",
        f"{at} + make_dt_interval(int(page_id % 7) - 1, 0, 0, 0.5) as at",
        f"map_filter(map('etag', case page_id % 7 when 0 then concat('W/', {known}) when 1 then '\"old\"' when 2 then null when 3 then null else {known} end,"
        " 'last-modified', case page_id % 7 when 2 then concat('T', page_id % 4) end, 'content-length', '0', 'connection', 'close',"
        " 'cache-control', 'max-age=600', 'age', cast(page_id % 11 as string)), (k, v) -> v is not null) as headers",
    )
    return response.union(revisit)


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve_revisits(archive_records(table(spark, sf_dir, "pages")))
    fields = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return found.select(
        F.expr("record_id div 8").alias("page_id"), F.col("url").alias("canonical_url"),
        F.expr("response_id div 8").alias("response_page_id"), (F.col("response_id") % 8).alias("response_capture"), "status", F.array_join(fields, ";").alias("headers"),
    )


def op2_neighbour_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = nn_descent.linked_vectors(table(spark, sf_dir, "embeddings"))
    return links.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = superminhash.near_duplicate_groups(table(spark, sf_dir, "documents"), width=4)
    return groups.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.languages(table(spark, sf_dir, "documents"))


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_least_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = gam.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.drop("key_text")


def op7_resynchronised_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return token_counts.with_limit(counts)


def op8_suffix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_buckets.without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_trees.without_repeated_windows(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_rns_gemm(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return rns_gemm.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op12_extendible_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_hash.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_maximal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_periods(table(spark, sf_dir, "documents")))
    # The first run of greatest exponent: length * period of the other, multiplied crosswise.
    better = lambda a, b: (a["length"] * b["period"]) > (b["length"] * a["period"])
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(better(b, a), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_revisits": op1_revisits,
    "op2_neighbour_descent": op2_neighbour_descent,
    "op3_superminhash": op3_superminhash,
    "op4_byte_cnn": op4_byte_cnn,
    "op5_least_squares_packing": op5_least_squares_packing,
    "op6_additive_quality": op6_additive_quality,
    "op7_resynchronised_counts": op7_resynchronised_counts,
    "op8_suffix_buckets": op8_suffix_buckets,
    "op9_positional_index": op9_positional_index,
    "op10_suffix_trees": op10_suffix_trees,
    "op11_rns_gemm": op11_rns_gemm,
    "op12_extendible_hash": op12_extendible_hash,
    "op13_maximal_pairs": op13_maximal_pairs,
}

#: DuckDB SQL over the registered tables. Where SQL cannot express an operator (trained
#: models, tokenizers, packing, cut UTF-8 bytes), tests compare it with a brute-force version.
CANONICAL = """
    with bare as (
        select *, regexp_replace(regexp_replace(trim(raw), '#.*$', ''), '^(?i)[a-z][a-z0-9+.-]*://([^/?@]*@)?', '') as b from {source}
    ), parts as (
        select *, regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), ':(80|443)$', ''), '^(www|m)[.]', '') as host,
            regexp_replace(regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/index[.]html?$', '/'), '/+$', '') as path,
            list_sort(list_filter(string_split(regexp_extract(b, '[?](.*)$', 1), '&'),
                lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) as query
        from bare
    )
    select * exclude (b, host, path, query), host || path || case when len(query) > 0 then '?' || array_to_string(query, '&') else '' end as url from parts
"""

ORACLES: dict[str, str] = {
    "op1_revisits": f"""
with p as (
    select page_id, html, case when page_id % 10 = 3 then '{HOT_URL}' else url end as address, page_id * 37000 + page_id % 4 * 250 as moment from pages
),
responses as ({CANONICAL.format(source="""(select page_id, address as raw, html, k as capture, moment + k * 172800000 as at,
    '"' || md5(html) || (page_id % 2 * k) || '"' as tag from p, (select unnest([0, 1, 2]) as k))""")}),
revisits as ({CANONICAL.format(source="""(select page_id, case page_id % 3 when 0 then address || '#seen' when 1 then replace(address, 'https://', 'http://') else address end as raw,
    moment + (page_id % 7 - 1) * 86400000 + 500 as at, '"' || md5(html) || (page_id % 2 * (page_id % 3)) || '"' as known from p)""")}),
tagged as (
    select *, case page_id % 7 when 0 then known when 1 then '"old"' when 2 then null when 3 then null else known end as tag,
        case when page_id % 7 = 0 then 'W/' else '' end as weak, case when page_id % 7 = 2 then 'T' || page_id % 4 end as modified
    from revisits
),
found as (
    select v.page_id, v.url, v.tag, v.weak, v.modified, r.page_id as response_page, r.capture, r.tag as own, r.html as body,
        row_number() over (partition by v.page_id order by r.at desc, r.page_id desc, r.capture desc) as n
    from tagged v left join responses r on r.url = v.url and r.at < v.at
),
judged as (
    select *, case when response_page is null then 'no response'
        when case when tag is not null then tag = own when modified is not null then modified = 'T' || response_page % 3 else true end then 'resolved'
        else 'validators differ' end as status
    from found where n = 1
)
select page_id, url as canonical_url, case when status = 'resolved' then response_page end as response_page_id,
    case when status = 'resolved' then capture end as response_capture, status,
    case when status = 'resolved' then 'age=' || page_id % 11 || ';cache-control=max-age=600;content-length=' || strlen(body) || ';content-type=text/html;date='
        || response_page || ';etag=' || weak || own || ';last-modified=' || coalesce(modified, 'T' || response_page % 3) end as headers
from judged
""",
    "op2_neighbour_descent": """
with recursive v as (
    select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
    where label is not null and embedding is not null
), links as (
    select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.e, b.e) >= 0.93
), reach(id, other) as (
    select vec_id, vec_id from embeddings union select r.id, l.b from reach r join links l on l.a = r.other
), least as (select id, min(other) as component_id from reach group by id)
select id as vec_id, (select count(*) from links l where l.a = least.id) as n_links, component_id, id = component_id as kept from least
""",
    "op3_superminhash": r"""
with recursive w as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D ]+'), lambda x: x <> '') as words from documents
), s as (
    select distinct doc_id, unnest(case when len(words) >= 4 then list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
        when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as shingle from w
), n as (select doc_id, count(*) as n from s group by doc_id),
links as (
    select x.doc_id as a, y.doc_id as b from s x join s y on x.shingle = y.shingle and x.doc_id <> y.doc_id
    join n p on p.doc_id = x.doc_id join n q on q.doc_id = y.doc_id
    group by x.doc_id, y.doc_id, p.n, q.n having 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reach(id, other) as (
    select doc_id, doc_id from documents union select r.id, l.b from reach r join links l on l.a = r.other
), least as (select id, min(other) as component_id from reach group by id)
select least.id as doc_id, coalesce(n.n, 0) as n_shingles, component_id, least.id = component_id as kept from least left join n on n.doc_id = least.id
""",
    "op9_positional_index": r"""
with d as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents
), b as (
    select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark
), windows as (
    select distinct item_id, least(len(w), 10) as k, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) as window_text from b where len(w) > 0
), lengths as (select distinct k from windows),
places as (
    select doc_id, k, unnest(range(1, len(w) - k + 2)) as i, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as window_text
    from d, lengths where len(w) >= k
), hits as (select p.doc_id, p.i, p.k, x.item_id from places p join windows x on x.window_text = p.window_text and x.k = p.k),
covered as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(i, i + k)) as word from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join items using (doc_id)
""",
    "op10_suffix_trees": r"""
with d as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D ]+'), lambda x: x <> '') as w from documents
), places as (
    select doc_id, unnest(range(1, len(w) - 18)) as i, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) as window_text from d where len(w) >= 20
), ranked as (select doc_id, i, row_number() over (partition by window_text order by doc_id, i) as n from places),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as word from ranked where n > 1),
words as (select doc_id, unnest(range(1, len(w) + 1)) as word, unnest(w) as text from d),
kept as (
    select w.doc_id, string_agg(w.text, ' ' order by w.word) as text, count(*) as n from words w left join gone g on g.doc_id = w.doc_id and g.word = w.word
    where g.word is null group by w.doc_id
)
select d.doc_id, len(w) as n_words, len(w) - coalesce(k.n, 0) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256 from d left join kept k using (doc_id)
""",
    "op11_rns_gemm": """
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as e
    from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), a as (select * from v where vec_id % 50 = 0),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_inner_product(a.e, b.e)::bigint as score from a join v b on a.vec_id <> b.vec_id),
p as (select anchor_id, id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (
    select p.*, s.id as negative_id, s.score as negative_score, row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.id) as rank
    from p join s on s.anchor_id = p.anchor_id and not s.same and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 3
""",
    "op12_extendible_hash": """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
    doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256 from d
""",
}
