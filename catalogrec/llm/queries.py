"""Registered queries of this folder: one per operator, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_encode
from .collisions import near_vectors
from .common import held_out, table
from .extraction import extract_main_text
from .forest import nearest_neighbours
from .jaccard import jaccard_classes
from .langid import identify_language, language_profiles
from .lexical import rank_documents
from .mixing import mix
from .pii import find_pii, fit_pii
from .quality import fit_quality, score_quality
from .runs import detect_runs
from .toxicity import fit_toxicity, score_toxicity
from .transducer import count_tokens


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


OP1_SQL = """
with recursive usable as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))
), unit as (
  select vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) as u from usable
), links as (
  select a.vec_id as a, b.vec_id as b from unit a join unit b on a.vec_id <> b.vec_id and list_inner_product(a.u, b.u) >= 0.9
), reach(node, other) as (
  select a, b from links union select r.node, l.b from reach r join links l on r.other = l.a
)
select e.vec_id, (select count(*) from links where a = e.vec_id) as n_links,
       least(e.vec_id, coalesce((select min(other) from reach where node = e.vec_id), e.vec_id)) as component_id,
       e.vec_id <= coalesce((select min(other) from reach where node = e.vec_id), e.vec_id) as kept
from embeddings e
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out("doc_id", 4, 2))
    model = fit_toxicity(docs, labels, "toxic")
    scored = score_toxicity(docs.withColumn("held_out", held_out("doc_id", 4, 2)), model, keep=["doc_id", "held_out"], threshold=0.3)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", 20)


BPE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_encode(docs, public_tokenizers.path(BPE_VOCABULARY), public_tokenizers.PATTERN, keep=["doc_id"])
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out("doc_id", 4, 2))
    model = fit_quality(docs, labels, "quality")
    scored = score_quality(docs.withColumn("held_out", held_out("doc_id", 4, 2)), model, keep=["doc_id", "held_out"], threshold=0.7)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
with rows as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents
), sizes as (
  select source, sum(size)::bigint as source_size,
         [3.0, 1.0, 2.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as weight
  from rows group by source
), filling as (
  select *, 2.0::double * source_size as lim, 1.5::double * sum(source_size) over () as budget,
         coalesce(sum(2.0::double * source_size) over before, 0) as limits_before,
         sum(weight) over () - coalesce(sum(weight) over before, 0) as weight_left
  from sizes
  window before as (order by 2.0::double * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)
), stops as (
  select *, lim / weight <= (budget - limits_before) / weight_left as stop from filling
), targets as (
  select source, source_size,
         case when stop then lim
              else (budget - sum(case when stop then lim else 0 end) over ()) * weight
                   / sum(case when stop then 0 else weight end) over () end as target
  from stops
), placed as (
  select doc_id, source, size,
         (sum(size) over (partition by source order by md5(coalesce(doc_id::varchar, '')), size
                          rows between unbounded preceding and current row) - size)::bigint as first
  from rows
), needs as (
  select *, least(round(target)::bigint, 2 * source_size) as need from targets
)
select p.doc_id, p.size, n.source_size, n.target,
       (case when p.size = 0 then 0
             else (need // source_size) * p.size + greatest(0, least(first + p.size, need % source_size) - first) end)::bigint as taken
from placed p join needs n on p.source is not distinct from n.source
"""


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_classes(docs).select("doc_id", "n_shingles", "component_id")


OP7_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	-
]+') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then []
                      when len(w) < 5 then [array_to_string(w, ' ')]
                      else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as g
  from words
), elements as (
  select doc_id, len(g) as n, unnest(g) as e from sets
), pairs as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as shared
  from elements a join elements b on a.e = b.e and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
), links as (
  select a, b from pairs where 100 * shared >= 80 * (n + m - shared)
), reach(node, other) as (
  select a, b from links union select r.node, l.b from reach r join links l on r.other = l.a
)
select s.doc_id, len(g)::bigint as n_shingles,
       least(s.doc_id, coalesce((select min(other) from reach where node = s.doc_id), s.doc_id)) as component_id
from sets s
"""


PIECE_MODEL = "piece_bpe_32k.model"


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path(PIECE_MODEL), keep=["doc_id"], limit=4096)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out("doc_id", 3, 1))
    profiles = language_profiles(docs.where("not held_out"))
    found = identify_language(docs.select("doc_id", "text", "held_out"), profiles, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages, keep=["page_id", "url"]).select("page_id", "url", "text", "n_chars")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, fit_pii(docs), keep=["doc_id"])
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


# Base spans by the contract's patterns and tests. ``spans`` also holds the spans the method adds (two
# cards that the base pattern takes as one failing match, written-out addresses), which SQL cannot
# tell; so this is no registered oracle: the tests compare the base columns with it.
BASE_PII_SQL = r"""
with kinds(kind, ord, pat) as (
  values ('email', 1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
         ('ip', 2, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
         ('card', 3, '[0-9]([ -]?[0-9])+'),
         ('phone', 4, '\+[0-9][ ().0-9-]+[0-9]')
), docs as (
  select row_number() over () as row_key, doc_id, coalesce(text, '') as t from documents
), found as (
  select d.row_key, k.kind, k.ord, regexp_extract_all(d.t, k.pat) as hits, regexp_split_to_array(d.t, k.pat) as gaps
  from docs d, kinds k
), spans as (
  select row_key, kind, ord, hits[i] as hit,
         list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) as start
  from found, range(1, len(hits) + 1) r(i)
), checked as (
  select *, regexp_replace(hit, '[^0-9]', '', 'g') as dg from spans
), valid as (
  select row_key, kind, ord, start, start + length(hit) as stop from checked
  where case kind
    when 'email' then true
    when 'ip' then list_bool_and(list_transform(string_split(hit, '.'), lambda x: length(ltrim(x, '0')) <= 3 and coalesce(nullif(ltrim(x, '0'), ''), '0')::int <= 255))
    when 'card' then length(dg) between 13 and 19
      and list_sum(list_transform(range(0, length(dg)), lambda i: case when i % 2 = 0 then substr(dg, length(dg) - i, 1)::int
                                                           else (2 * substr(dg, length(dg) - i, 1)::int) % 10 + (2 * substr(dg, length(dg) - i, 1)::int) // 10 end)) % 10 = 0
    else length(dg) between 9 and 15 end
), joined as (
  select row_key, string_agg(kind || ':' || start || ':' || stop, ',' order by ord, start) as base,
         count(*) filter (where kind = 'email') as n_email, count(*) filter (where kind = 'ip') as n_ip,
         count(*) filter (where kind = 'card') as n_card, count(*) filter (where kind = 'phone') as n_phone
  from valid group by row_key
)
select d.doc_id, coalesce(n_email, 0)::bigint as n_email, coalesce(n_ip, 0)::bigint as n_ip, coalesce(n_card, 0)::bigint as n_card,
       coalesce(n_phone, 0)::bigint as n_phone, sha256(coalesce(base, '')) as base_sha256, coalesce(base, '') as spans
from docs d left join joined j on d.row_key = j.row_key
"""


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return rank_documents(docs, items, k=10)


OP12_SQL = r"""
with docs as (
  select row_number() over () as rk, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), stats as (
  select count(*) filter (where len(terms) > 0)::bigint as big_n, coalesce(sum(len(terms)), 0)::bigint as big_l from docs
), occurrences as (
  select rk, doc_id, len(terms)::bigint as n, unnest(terms) as term from docs
), tf as (
  select rk, doc_id, n, term, count(*)::bigint as tf from occurrences group by rk, doc_id, n, term
), df as (
  select term, count(*)::bigint as df from tf group by term
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), scored as (
  select a.item_id, t.rk, t.doc_id,
         sum(floor(1000.0 * ln((2.0 * s.big_n + 2) / (2.0 * d.df + 1)))::bigint
             * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * t.n * s.big_n) // s.big_l))))::bigint as score
  from asked a join tf t on a.term = t.term join df d on d.term = t.term cross join stats s
  group by a.item_id, t.rk, t.doc_id
), ranked as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id asc nulls last, rk) as rank
  from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = detect_runs(docs, keep=["doc_id"])
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


QUERIES = {
    "op1_near_vectors": (op1_near_vectors, OP1_SQL),
    "op2_toxicity": (op2_toxicity, None),
    "op3_neighbours": (op3_neighbours, None),
    "op4_bpe": (op4_bpe, None),
    "op5_quality": (op5_quality, None),
    "op6_mixing": (op6_mixing, OP6_SQL),
    "op7_jaccard": (op7_jaccard, OP7_SQL),
    "op8_token_counts": (op8_token_counts, None),
    "op9_language": (op9_language, None),
    "op10_extraction": (op10_extraction, None),
    "op11_pii": (op11_pii, None),
    "op12_search": (op12_search, OP12_SQL),
    "op13_runs": (op13_runs, None),
}


def llm_queries() -> dict:
    return {name: run for name, (run, _) in QUERIES.items()}


def llm_oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}
