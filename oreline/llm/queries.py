"""The operators applied to their whole tables, with production parameters, and the same results in SQL where SQL has them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm import decontaminate, language_id, line_dedup, mixing, near_join, phrases, pii, retrieval_packing, token_counts, url_filter, vector_links, warc_zip, whitening
from oreline.llm.common import ship, table
from oreline.paths import scratch_path

TOKEN_LIMIT = 512
TOKENIZER = "byte_bpe_50k.json"
PACK_TOKENIZER = "word_bpe_49k.json"
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: A host is blocked if its bad rate is above this with some 95 % of the posterior.
BAD_RATE = 0.3


def tokenizer_definition(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache of its own for each call, so that every distinct text is encoded."""
    cache = scratch_path(spark, "token-cache")
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_definition(), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over documents: their ``lang`` is what was declared, their source stands in for the host."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, F.col("text"), F.col("lang"), F.col("lang"), F.col("source")).drop("row")


def op7_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.link_vectors(table(spark, sf_dir, "embeddings"))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc_zip.write_packages(table(spark, sf_dir, "pages"), scratch_path(spark, "packages"))
    return warc_zip.read_packages(spark, manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is that of the document with its number: bad if toxic or of low quality."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    host, _ = url_filter.address(F.col("url"))
    bad = F.expr("cast(coalesce(toxic = 1, false) or coalesce(quality = 0, false) as int)")
    outcomes = pages.select("page_id", host.alias("host")).join(labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")), "page_id").select("host", "bad")
    return url_filter.judge_urls(pages, url_filter.host_reputation(outcomes), URL_RULES, BAD_RATE).drop("bad_rate")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_vectors(table(spark, sf_dir, "embeddings")).drop("size")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = retrieval_packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_definition(PACK_TOKENIZER))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _shipped(q)
    for q in (
        op1_decontaminate,
        op2_token_counts,
        op3_line_dedup,
        op4_mix_sources,
        op5_near_duplicates,
        op6_language_id,
        op7_vector_links,
        op8_warc_zip,
        op9_personal_data,
        op10_url_filter,
        op11_whitening,
        op12_packing,
        op13_phrases,
        pipeline,
    )
}

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {
    # Links by brute force over all pairs that share a shingle; components by following links.
    "op5_near_duplicates": rf"""
        with recursive w as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
          from documents),
        s as (
          select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as g
          from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from w where len(w) > 0)),
        n as (select doc_id, count(*) as n from s group by doc_id),
        sets as (select md5(string_agg(g, chr(10) order by g)) as k, doc_id from s group by doc_id),
        heads as (select k, min(doc_id) as head from sets group by k),
        hs as (select s.* from s join heads on s.doc_id = heads.head),
        common as (select a.doc_id as a, b.doc_id as b, count(*) as c from hs a join hs b on a.g = b.g and a.doc_id < b.doc_id group by all),
        l as (
          select a, b from common join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 80 * (na.n + nb.n - c)),
        e as (select a, b from l union select b, a from l),
        r as (select head as a, head as b from heads union select r.a, e.b from r join e on r.b = e.a),
        comp as (select a, min(b) as c from r group by a)
        select documents.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(comp.c, documents.doc_id) as component_id
        from documents left join n using (doc_id) left join sets using (doc_id) left join heads using (k) left join comp on comp.a = heads.head
    """,
    "op7_vector_links": """
        with recursive v as (
          select vec_id, label, embedding::double[] as e from embeddings
          where label is not null and embedding is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
            and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l as (
          select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
          where list_cosine_similarity(a.e, b.e) >= 0.93),
        r as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from r join l on r.b = l.a),
        c as (select a, min(b) as component_id from r group by a),
        d as (select a, count(distinct b) as n from l group by a)
        select vec_id, coalesce(d.n, 0) as n_links, component_id, vec_id = component_id as kept
        from embeddings join c on c.a = vec_id left join d on d.a = vec_id
    """,
    "op8_warc_zip": """
        with p as (select page_id, coalesce(html, '') as h from pages),
        d as (select page_id, octet_length(encode(h)) as payload_bytes, sha1(h) as payload_digest from p),
        m as (select *, max(page_id) over (partition by payload_digest, payload_bytes) as top from d)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 1000 and page_id < top then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 1000 and page_id < top then top end as refers_to
        from m
    """,
    "op10_url_filter": """
        with u as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) end as rest from pages),
        h as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from u),
        a as (
          select page_id, coalesce(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
                 coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') as path
          from h),
        x as (
          select host, (coalesce(toxic = 1, false) or coalesce(quality = 0, false))::int as bad from a join labels on doc_id = page_id),
        hosts as (select host, sum(bad)::double as bad, count(*)::double as n from x group by host),
        g as (
          select *, case when numeric then host else array_to_string(parts[-2:], '.') end as domain, case when numeric then '' else parts[-1] end as suffix
          from (select *, regexp_full_match(host, '[0-9.]+(:[0-9]+)?') as numeric, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') as parts from hosts)),
        o as (select coalesce(sum(bad), 0) + 0.5 as al, coalesce(sum(n - bad), 0) + 0.5 as be from g),
        s1 as (select suffix as name, sum(bad) as bad, sum(n) as n, (select al / (al + be) from o) as mean from g group by suffix),
        k1 as (select (sum(n * pow(bad / n - mean, 2)) - sum(mean * (1 - mean))) / nullif(sum(mean * (1 - mean) * (n - 1)), 0) as rho from s1),
        t1 as (select case when rho is null then 10 when rho > 0 then least(1000, greatest(1, 1 / rho - 1)) else 1000 end as st from k1),
        p1 as (select name, mean * st + bad as al, (1 - mean) * st + n - bad as be from s1, t1),
        s2 as (select d.*, al / (al + be) as mean from (select domain as name, sum(bad) as bad, sum(n) as n, max(suffix) as up from g group by domain) d join p1 on p1.name = d.up),
        k2 as (select (sum(n * pow(bad / n - mean, 2)) - sum(mean * (1 - mean))) / nullif(sum(mean * (1 - mean) * (n - 1)), 0) as rho from s2),
        t2 as (select case when rho is null then 10 when rho > 0 then least(1000, greatest(1, 1 / rho - 1)) else 1000 end as st from k2),
        p2 as (select name, mean * st + bad as al, (1 - mean) * st + n - bad as be from s2, t2),
        s3 as (select d.*, al / (al + be) as mean from (select host as name, bad, n, domain as up from g) d join p2 on p2.name = d.up),
        k3 as (select (sum(n * pow(bad / n - mean, 2)) - sum(mean * (1 - mean))) / nullif(sum(mean * (1 - mean) * (n - 1)), 0) as rho from s3),
        t3 as (select case when rho is null then 10 when rho > 0 then least(1000, greatest(1, 1 / rho - 1)) else 1000 end as st from k3),
        p3 as (select name, mean * st + bad as al, (1 - mean) * st + n - bad as be from s3, t3),
        names as (
          select distinct host, case when numeric then host else array_to_string(parts[-2:], '.') end as domain, case when numeric then '' else parts[-1] end as suffix
          from (select host, regexp_full_match(host, '[0-9.]+(:[0-9]+)?') as numeric, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') as parts from a)),
        b as (
          select host, coalesce(p3.al, p2.al, p1.al, o.al) as al, coalesce(p3.be, p2.be, p1.be, o.be) as be
          from names left join p3 on p3.name = host left join p2 on p2.name = domain left join p1 on p1.name = suffix, o),
        j as (select host, al / (al + be) - 1.645 * sqrt(al * be / (pow(al + be, 2) * (al + be + 1))) as rate from b),
        rules(kind, rhost, rpath) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        f as (
          select page_id, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(kind, length(rhost || rpath)) as kind
          from a join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
        select a.page_id, host, path, f.rule, coalesce(f.kind, case when rate > 0.3 then 'block' else 'allow' end) as verdict
        from a join j using (host) left join f using (page_id)
    """,
    "op13_phrases": r"""
        with p as (
          select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
          from documents),
        w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from p),
        g as materialized (
          select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f, lang || chr(31) || phrase as id
          from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (values (1), (2), (3)) ks(k) where len(w) >= k)
          group by all),
        often as materialized (select id, f from g where f >= 10),
        n as (select lang, sum(f)::bigint as n from g where k = 1 group by lang),
        c as materialized (select lang, k, phrase, f as a, string_split(phrase, ' ') as ws from g where k > 1 and f >= 10),
        cuts as materialized (
          select c.*, cut, lang || chr(31) || array_to_string(ws[1:cut], ' ') as first, lang || chr(31) || array_to_string(ws[cut + 1:], ' ') as rest
          from c, (values (1), (2)) x(cut) where cut < k),
        s as (
          select cuts.*, x.f as l, y.f as r, (1000000 * a::hugeint * a::hugeint) // (x.f::hugeint * y.f::hugeint) as score
          from cuts join often x on x.id = first join often y on y.id = rest),
        best as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
        longer as (
          select lang, phrase, max(a) as m from (
            select lang, array_to_string(ws[1:2], ' ') as phrase, a from c where k = 3 union all
            select lang, array_to_string(ws[2:3], ' '), a from c where k = 3) group by all),
        kept as (select best.* from best left join longer using (lang, phrase) where m is null or 100 * m < 50 * a),
        ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
        select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join n using (lang) where rank <= 2000
    """,
}
