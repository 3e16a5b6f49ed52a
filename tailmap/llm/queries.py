"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align
from .common import table
from .conversations import repair_digests
from .exact_dedup import exact_groups
from .jaccard_join import joined_groups
from .langid import identify
from .minhash import near_groups
from .mixing import mix
from .pieces import Model, encode_decode
from .pii import pii_digests
from .secrets import secret_digests
from .token_output import token_digests
from .topk import search
from .url_filter import filter_urls


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by hyperdimensional profiles."""
    return identify(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the checksum of the text that they are decoded to."""
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), Model.load(public_tokenizers.path("piece_bpe_32k.model")))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_digests(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return filter_urls(table(spark, sf_dir, "pages"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best by inner product for every vector whose id is divisible by 100."""
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at a similarity of 0.85."""
    return near_groups(table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of all documents takes of each."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii_digests(table(spark, sf_dir, "documents"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as sorted-string-table shards and read back."""
    import public_tokenizers

    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents by chunk recipes."""
    return exact_groups(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return repair_digests(table(spark, sf_dir, "conversations"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers overlap in every document."""
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))[0]


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents that are linked by 3-word shingles at a similarity of 0.9."""
    return joined_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_language_id, op2_sentencepiece, op3_secret_scan, op4_url_filter, op5_topk_search, op6_minhash_dedup, op7_source_mix, op8_pii, op9_token_output, op10_exact_dedup,
              op11_conversation_repair, op12_tokenizer_alignment, op13_ngram_jaccard)
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The alias graph is walked from every explicit decision; see ``url_filter`` for what the parts mean.
_URL_SQL = r"""
    with recursive raw as (
        select page_id, url, html from pages),
    links as (
        select url as src, regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*[\x22\x27]?canonical\b[^>]*>', 0), '(?is)\bhref\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)', 1) as target from raw
        union all
        select url, regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\x22\x27]?refresh\b[^>]*>', 0), '(?is)\burl\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)', 1) from raw),
    whole as (
        select src, case when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') then target
                         when starts_with(target, '//') then 'http:' || target
                         when starts_with(target, '/') then 'http://' || regexp_extract(src, '://([^/?#]*)', 1) || target
                         else 'http://' || regexp_extract(src, '://([^/?#]*)', 1)
                              || case when regexp_extract(src, '://[^/?#]*([^?#]*/)', 1) = '' then '/' else regexp_extract(src, '://[^/?#]*([^?#]*/)', 1) end || target end as dst
        from links where target <> ''),
    urls as (
        select distinct url from (select url from raw union all select src from whole union all select dst from whole)),
    rest as (
        select url, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r from urls),
    parts as (
        select url, translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(r, '^[^?#]*\?([^#]*)', 1) as query from rest),
    ruled as (
        select url, host, path,
               case when host <> '' then host || regexp_replace(path, '/+\z', '') || case when kept <> '' then '?' || kept else '' end end as node,
               case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
                    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
                    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
                    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
                    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
        from (select *, array_to_string(list_filter(string_split(query, '&'), lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid)(=|\z)')), '&') as kept from parts)),
    said as (
        select *, case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block' end as verdict from ruled),
    edges as (
        select distinct a.node as u, b.node as v from whole join said a on a.url = src join said b on b.url = dst where a.node <> b.node),
    reach as (
        select node, verdict from said where node is not null and verdict is not null
        union
        select case when e.u = reach.node then e.v else e.u end, reach.verdict from reach join edges e on reach.node in (e.u, e.v)),
    alias as (
        select node, min(verdict) as verdict from reach group by node)
    select page_id, coalesce(s.host, '') as host, coalesce(s.path, '') as path, s.rule, coalesce(s.verdict, a.verdict, 'allow') as verdict,
           s.rule is null and a.verdict is not null as propagated
    from raw left join said s on s.url = raw.url left join alias a on a.node = s.node"""

_VECTORS = "select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(1024.0 * x::double)::double) as v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

#: One byte of a CRC-32, bit by bit.
_CRC_BYTE = "list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, byte))"
_CRC = f"xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::bigint), lambda crc, byte: {_CRC_BYTE}, 4294967295::bigint), 4294967295)"


def _sql_on(way: str, cost: str, letter: str) -> str:
    """A way (twelve digits of cost, then its letters) with an edit more."""
    return f"lpad((left({way}, 12)::bigint + {cost})::varchar, 12, '0') || substr({way}, 13) || '{letter}'"


def _sql_inserted(source: str) -> str:
    """The ways e, s, u, a of a relation after inserts: those to u first, as a second insert can only follow it."""
    user = f"least(u, {_sql_on('e', '5', 'I')}, {_sql_on('s', '5', 'I')}, {_sql_on('a', '5', 'I')})"
    return f"select c, i, e, s, u, least(a, {_sql_on('u', '5', 'I')}) as a from (select c, i, e, s, {user} as u, a from {source})"


def _sql_kept(way: str, initial: str) -> str:
    return f"case when initial = '{initial}' then {_sql_on(way, 'more', 'K')} end"


_REPAIR_SQL = rf"""
    with recursive source as (
        select conv_id, dense_rank() over (order by conv_id nulls first) as c, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
    kinds as (select *, {_CRC} % 20 as kind from source),
    rows as (
        select c, turn, case when kind = 4 then 'user' else role end as role, case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
        from kinds, unnest(case when kind = 3 then [1, 2] else [1] end) as copy(n) where kind <> 0),
    placed as (select *, row_number() over (partition by c order by turn nulls first, role, text) as i from rows),
    flagged as (
        select *, left(role, 1) as initial, regexp_extract(text, '([^ 	-
])[ 	-
]*\z', 1) as last, row_number() over (partition by c, role, text order by i) > 1 as repeated, lag(left(role, 1)) over (partition by c order by i) as before from placed),
    faults as (
        select *, last = '' as blank, last <> '' and repeated as duplicate, last <> '' and not repeated and last not in ('.', '!', '?') as truncated, case when last in ('.', '!', '?') then 0 else 5 end as more, last = '' or repeated as gone from flagged),
    steps(c, i, e, s, u, a) as (
        {_sql_inserted("(select distinct c, 0::bigint as i, lpad('0', 12, '0') as e, null::varchar as s, null::varchar as u, null::varchar as a from rows)")}
        union all
        {_sql_inserted(f"""(
            select c, f.i,
                   {_sql_on('e', '2', 'D')} as e,
                   least({_sql_on('s', '2', 'D')}, case when not gone then {_sql_kept('e', 's')} end) as s,
                   least({_sql_on('u', '2', 'D')}, case when not gone then least({_sql_kept('e', 'u')}, {_sql_kept('s', 'u')}, {_sql_kept('a', 'u')}, {_sql_on('e', 'more + 1', 'R')}, {_sql_on('s', 'more + 1', 'R')}, {_sql_on('a', 'more + 1', 'R')}) end) as u,
                   least({_sql_on('a', '2', 'D')}, case when not gone then least({_sql_kept('u', 'a')}, {_sql_on('u', 'more + 1', 'R')}) end) as a
            from steps join faults f using (c) where f.i = steps.i + 1)""")}),
    best as (
        select c, least(e, a) as way, string_split(substr(least(e, a), 13), '') as letters from steps semi join (select c, max(i) as i from placed group by c) n using (c, i)),
    edits as (
        select c, p, letter, sum((letter <> 'I')::int) over w as i, sum((letter <> 'D')::int) over w as made, sum((letter <> 'D')::int) over (partition by c) % 2 as system
        from (select c, unnest(letters) as letter, generate_subscripts(letters, 1) as p from best) window w as (partition by c order by p)),
    repaired as (
        select c, sha256(string_agg(case when letter = 'K' then f.role when (made - system) % 2 = 1 then 'user' else 'assistant' end || ':' || case when letter = 'I' then '' else f.text end, chr(10) order by p)) as repaired_sha256
        from edits left join faults f using (c, i) where letter <> 'D' group by c),
    counts as (
        select c, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
               count(*) filter (where truncated) as truncated, count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au')) as illegal from faults group by c)
    select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
           coalesce(left(way, 12)::bigint, 0) as cost, coalesce(substr(way, 13), '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
    from (select distinct conv_id, c from source) left join counts using (c) left join best using (c) left join repaired using (c)"""

_SHINGLES_SQL = rf"""
    with recursive words as (
        select doc_id, list_filter(string_split_regex({_LOWERED}, '[ 	-
]+'), lambda w: w <> '') as w from documents),
    sets as (
        select doc_id, list_distinct(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) when len(w) > 0 then [array_to_string(w, ' ')] else []::varchar[] end) as s from words),
    held as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
    links as (
        select a.doc_id as u, b.doc_id as v from held a join held b using (shingle) where a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
        group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
    reach as (select doc_id as node, doc_id as other from sets union select reach.node, links.v from reach join links on links.u = reach.other)
    select doc_id, len(s)::bigint as n_shingles, component_id from sets join (select node, min(other) as component_id from reach group by node) on node = doc_id"""

ORACLES: dict[str, str] = {
    "op4_url_filter": _URL_SQL,
    "op5_topk_search": f"""
        with v as materialized ({_VECTORS}),
        pairs as (select q.r, q.vec_id as query_id, x.vec_id, list_dot_product(q.v, x.v)::bigint as score from v q join v x on q.r <> x.r where q.vec_id % 100 = 0)
        select query_id, rank::integer as rank, vec_id, score
        from (select *, row_number() over (partition by r order by score desc, vec_id) as rank from pairs) where rank <= 10""",
    "op10_exact_dedup": f"""
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
        from (select doc_id, {_LOWERED} as t from documents)""",
    "op11_conversation_repair": _REPAIR_SQL,
    "op13_ngram_jaccard": _SHINGLES_SQL,
}
