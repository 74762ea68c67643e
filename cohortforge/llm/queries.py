"""The operators as registered queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortforge.llm import chat, imatch, warc
from cohortforge.llm.bpe import round_trip_digests
from cohortforge.llm.collocations import collocations
from cohortforge.llm.decontaminate import contaminated
from cohortforge.llm.grammar import write_and_read
from cohortforge.llm.language import identify
from cohortforge.llm.near_dedup import near_duplicates
from cohortforge.llm.pii import report
from cohortforge.llm.quality import classify
from cohortforge.llm.url_filters import judge
from cohortforge.llm.whitening import whiten
from cohortforge.session import configure

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    # texts are long: small batches keep what a Python worker holds at once bounded
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document for quality, and whether its label was held out."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document encoded and decoded."""
    return round_trip_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


@query
def op3_grammar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, read back from Re-Pair grammar files."""
    return write_and_read(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, copied or edited."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, written and read back, with one that holds control strings."""
    trap = spark.sql(
        "select * from values (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), "
        "(-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') as t(conv_id, turn, role, text)"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(turns.unionByName(trap))


@query
def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they and the next are."""
    return imatch.compare(table(spark, sf_dir, "documents"))


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets reach a similarity of 0.75."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a byte convolutional network."""
    return identify(table(spark, sf_dir, "documents"))


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, indexed and read back through the capture index."""
    return warc.write_and_read(table(spark, sf_dir, "pages"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and what the trained classifier adds."""
    return report(table(spark, sf_dir, "documents"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first whitened components of every embedding."""
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict by rules and by what its host links to and is linked from."""
    return judge(table(spark, sf_dir, "pages"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two and three words in each language."""
    return collocations(table(spark, sf_dir, "documents"))


SQL: dict[str, str] = {
    "op7_near_dedup": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') as w
            from documents
        ), sets as (
            select doc_id, case
                when len(w) >= 5 then list_distinct(
                    list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                when len(w) > 0 then [array_to_string(w, ' ')]
                else [] end as s
            from words
        ), grams as (
            select doc_id, len(s) as n, unnest(s) as g from sets
        ), links as (
            select a.doc_id as x, b.doc_id as y from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id, a.n, b.n
            having 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), reach as (
            select doc_id, doc_id as other from sets
            union
            select r.doc_id, l.y from reach r join links l on r.other = l.x
        ), least as (
            select doc_id, min(other) as component_id from reach group by doc_id
        )
        select doc_id, len(s) as n_shingles, component_id, doc_id = component_id as kept
        from sets join least using (doc_id)
    """,
    "op9_warc": """
        with digests as (
            select page_id, strlen(coalesce(html, '')) as payload_bytes,
                sha1(coalesce(html, '')) as payload_digest
            from pages
        ), typed as (
            select *, max(page_id) over (partition by payload_digest, payload_bytes) as last from digests
        )
        select page_id, payload_bytes, payload_digest,
            case when payload_bytes >= 1000 and page_id <> last then 'revisit' else 'response' end as record_type,
            case when payload_bytes >= 1000 and page_id <> last then last end as refers_to
        from typed
    """,
    "op12_url_filters": r"""
        with recursive urls as (
            select page_id, html,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
            from pages
        ), rules as (
            select * from (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
                ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) t(ruled, h, p)
        ), fitting as (
            select page_id, host, path, h || p as rule, ruled
            from urls join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
            qualify row_number() over (partition by page_id order by length(h || p) desc, length(h) desc) = 1
        ), judged as (
            select page_id, u.host, u.path, rule, ruled from urls u left join fitting using (page_id)
        ), seeds as (
            select host, 1000000000 * count(*) filter (ruled = 'allow') // count(*) * 15 // 100 as trust,
                1000000000 * count(*) filter (ruled = 'block') // count(*) * 15 // 100 as distrust
            from judged where host <> '' group by host
        ), targets as (
            select host as src, unnest(list_distinct(list_transform(regexp_extract_all(html,
                '[\x09-\x0D\x20"''/](?:[Hh][Rr][Ee][Ff]|[Ss][Rr][Cc])[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["'']?[\x09-\x0D\x20]*(?:[Hh][Tt][Tt][Pp][Ss]?:)?//([^/?#"''\x09-\x0D\x20>\\]+)', 1),
                lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) as dst
            from urls
        ), links as (
            select src, dst, count(*) as weight from targets where src <> '' and src <> dst group by src, dst
        ), edges as (
            select 'trust' as kind, src, dst, weight, sum(weight) over (partition by src) as total from links
            union all
            select 'distrust', dst, src, weight, sum(weight) over (partition by dst) from links
        ), own as (
            select 'trust' as kind, host, trust as score from seeds where trust > 0
            union all select 'distrust', host, distrust from seeds where distrust > 0
        ), rounds as (
            select kind, host, score::hugeint as score, 0 as k from own
            union all
            select kind, host, sum(score)::hugeint, k from (
                select e.kind, e.dst as host, (r.score * 85 * e.weight) // (e.total * 100) as score, r.k + 1 as k
                from rounds r join edges e on e.kind = r.kind and e.src = r.host where r.k < 40
                union all
                select o.kind, o.host, o.score, n.k + 1
                from own o, (select distinct kind, k from rounds where k < 40) n where n.kind = o.kind
            ) group by kind, host, k
        ), last as (
            select host, coalesce(max(score) filter (kind = 'trust'), 0)::bigint as trust,
                coalesce(max(score) filter (kind = 'distrust'), 0)::bigint as distrust
            from rounds where k = 40 group by host
        )
        select page_id, j.host, path, rule,
            coalesce(ruled, case when distrust >= trust + 10000000 then 'block' else 'allow' end) as verdict,
            coalesce(trust, 0) as trust, coalesce(distrust, 0) as distrust
        from judged j left join last using (host)
    """,
    "op13_collocations": r"""
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) as piece
            from documents
        ), lists as (
            select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces
        ), places as (
            select lang, w, unnest(range(1, len(w) + 1)) as i from lists
        ), f1 as (
            select lang, w[i] as x, count(*) as f from places group by all
        ), f2 as (
            select lang, w[i] as x, w[i + 1] as y, count(*) as f from places where i < len(w) group by all having f >= 10
        ), f3 as (
            select lang, w[i] as x, w[i + 1] as y, w[i + 2] as z, count(*) as f
            from places where i + 1 < len(w) group by all having f >= 10
        ), cuts as (
            select lang, x || ' ' || y as phrase, p.f as a, 1 as k, a.f as l, b.f as r,
                coalesce(greatest(
                    (select max(f) from f3 where f3.lang = p.lang and f3.x = p.x and f3.y = p.y),
                    (select max(f) from f3 where f3.lang = p.lang and f3.y = p.x and f3.z = p.y)), 0) as most
            from f2 p join f1 a using (lang, x) join (select lang, x as y, f from f1) b using (lang, y)
            union all
            select lang, x || ' ' || y || ' ' || z, t.f, 1, a.f, b.f, 0
            from f3 t join f1 a using (lang, x) join (select lang, x as y, y as z, f from f2) b using (lang, y, z)
            union all
            select lang, x || ' ' || y || ' ' || z, t.f, 2, a.f, b.f, 0
            from f3 t join f2 a using (lang, x, y) join (select lang, x as z, f from f1) b using (lang, z)
        ), scored as (
            select *, (1000000::hugeint * a * a) // (l::hugeint * r) as score from cuts
        ), lowest as (
            select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
        ), ranked as (
            select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
            from lowest where 100 * most < 50 * a
        )
        select lang, rank, phrase, a, l, r, n, score::bigint as score
        from ranked join (select lang, sum(f)::bigint as n from f1 group by lang) using (lang)
        where rank <= 2000
    """,
    # the template below is the operator's default one
    "op5_chat": """
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
            from conversations
            union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
            union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), placed as (
            select *, row_number() over (partition by conv_id order by turn, role, text) as k,
                lag(role) over (partition by conv_id order by turn, role, text) as before,
                length(role) + length(text) + 3 * (length(text) - length(replace(text, '<', '')))
                    + 4 * (length(text) - length(replace(text, '&', '')))
                    + 4 * (length(text) - length(replace(text, '[', ''))) + 16 as chars,
            from turns
        ), whole as (
            select conv_id, count(*) as n_turns,
                string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as lines,
                coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
                sum(chars)::bigint as formatted_chars,
                bool_and(case role when 'system' then before is null
                    when 'user' then before is null or before in ('system', 'assistant')
                    when 'assistant' then before is not distinct from 'user' else false end)
                    and max_by(role, k) = 'assistant' as valid
            from placed group by conv_id
        )
        select conv_id, n_turns, sha256(lines) as turns_sha256, length(loss) as loss_chars,
            sha256(loss) as loss_sha256, formatted_chars, valid
        from whole
    """,
}
