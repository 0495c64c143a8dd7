"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    compression,
    covertree,
    licences,
    mixing,
    neighbours,
    phrases,
    pii,
    recompression,
    residues,
    sketches,
    suffixes,
    toxicity,
)
from .common import read

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_rules(read(spark, sf_dir, "documents"))


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.close_vectors(read(spark, sf_dir, "embeddings"))


def op3_licence_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_paragraphs(read(spark, sf_dir, "documents"))


def op4_sorted_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_digests(read(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return bpe.encoding_digests(docs, VOCABULARY, public_tokenizers.PATTERN)


def op7_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op9_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = sketches.near_duplicates(docs, sketches.Settings(words=2))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.removal_digests(read(spark, sf_dir, "documents"))


def op12_residue_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residues.hard_negatives(read(spark, sf_dir, "embeddings"))


def op13_rolled_up_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_compression_bands,
        op2_cover_tree,
        op3_licence_classifier,
        op4_sorted_suffixes,
        op5_personal_data,
        op6_byte_bpe,
        op7_clause_grammar,
        op8_entropy_mix,
        op9_bottom_k,
        op10_neighbour_vote,
        op11_recompression,
        op12_residue_products,
        op13_rolled_up_phrases,
    )
}

# The documents that still fit, in the order of their digests, as long as they do.
_FILLING = """
open_{before} as (
    select *, not taken_more and size > 0 and size <= remaining as fits from filled_{before}
), summed_{before} as (
    select *, sum(case when fits then size else 0 end)
        over (partition by source order by digest) as upto from open_{before}
), filled_{after} as (
    select * exclude (fits, upto, taken_more, remaining),
        taken_more or fits and upto <= remaining as taken_more,
        remaining - max(case when upto <= remaining then upto else 0 end)
            over (partition by source) as remaining
    from summed_{before}
)"""

_MIX = (
    r"""
with sized as (
    select doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
        substr(md5(coalesce(doc_id::varchar, text, '')), 1, 6) as digest
    from documents
), sizes as (
    select source, sum(size)::bigint as source_size,
        (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
    from sized group by source
), levels as (
    -- The level at which caps and shares add up, tried with every source as the last capped.
    select max((total - capped) / nullif(weights, 0)) as level
    from (
        select
            (select sum(source_size) from sizes) as total,
            coalesce((select sum(3 * s.source_size) from sizes s
                      where s.source_size / s.weight < t.source_size / t.weight), 0) as capped,
            (select sum(s.weight) from sizes s
             where s.source_size / s.weight >= t.source_size / t.weight) as weights,
            3 * t.source_size / t.weight as own
        from sizes t
    ) where (total - capped) / nullif(weights, 0) <= own
), targets as (
    select source, source_size, least(3.0 * source_size, weight * level)::double as target
    from sizes, levels
), wanted as (
    select source, source_size, target,
        case when source_size > 0 then floor(target / source_size + 1e-9) else 0 end as whole
    from targets
), filled_0 as (
    select d.*, w.source_size, w.target, w.whole, target - whole * source_size as remaining,
        false as taken_more
    from sized d join wanted w on d.source is not distinct from w.source
), """
    + ", ".join(_FILLING.format(before=turn, after=turn + 1) for turn in range(16))
    + r""",
nearest as (
    -- One more, by digest, where that misses the target by less than what is left does.
    select source, min({'missed': abs(words - remaining), 'digest': digest}).digest as extra
    from (select source, digest, remaining, sum(size) as words from filled_16
          where not taken_more and size > 0 and size < 2 * remaining
          group by source, digest, remaining)
    where abs(words - remaining) < remaining group by source
), dealt as (
    select f.*, (whole + (taken_more or coalesce(digest = extra, false))::integer)::integer as copies
    from filled_16 f left join nearest n on f.source is not distinct from n.source
)
select doc_id, size, source_size, target, (copies * size)::bigint as taken, copies from dealt
"""
)

_PASSAGES = r"""
with listed as materialized (
    select row_number() over () as r, doc_id,
        coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::varchar[]) as w
    from documents
), windows as materialized (
    select r, i, array_to_string(w[i:i + 34], ' ') as passage
    from (select r, w, unnest(range(1, len(w) - 33)) as i from listed where len(w) >= 35)
), repeated as (
    select passage from windows group by passage having count(*) > 1
), gone as (
    select distinct r, unnest(range(i, i + 35)) as p
    from windows where passage in (select passage from repeated)
), placed as (
    select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from listed
), kept as (
    select r, string_agg(word, ' ' order by p) as words, count(*) as n
    from placed anti join gone using (r, p) group by r
)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
    sha256(coalesce(words, '')) as kept_sha256
from listed left join kept using (r)
"""

_NEGATIVES = """
with vectors as materialized (
    select row_number() over () as r, vec_id,
        case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as materialized (
    select a.r as anchor, a.vec_id as anchor_id, o.r as other, o.vec_id as other_id,
        a.label = o.label as same, list_dot_product(a.v, o.v)::bigint as score
    from vectors a join vectors o on a.vec_id % 50 = 0 and a.r <> o.r
), positives as (
    select anchor, anchor_id, other as positive, other_id as positive_id, score as positive_score
    from scored where same
    qualify row_number() over (partition by anchor order by score desc, other_id) <= 5
)
select p.anchor_id, p.positive_id,
    row_number() over (partition by p.anchor, p.positive order by s.score desc, s.other_id)::integer
        as rank,
    s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor = p.anchor and not s.same
    and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
qualify rank <= 3
"""

_COLLOCATIONS = r"""
with pieces as materialized (
    select lang, row_number() over () as r, regexp_extract_all(piece, '[^\x20\x09]+') as w
    from (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as piece
        from documents where text is not null
    )
), grams as (
    select lang, w[i:i + size - 1] as words
    from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
          from pieces cross join (values (1), (2), (3), (4)) sizes(size))
), counts as materialized (
    select lang, words, len(words) as size, count(*) as f from grams group by lang, words
), totals as (
    select lang, sum(f)::bigint as n from counts where size = 1 group by lang
), frequent as materialized (
    select * from counts where f >= 30
), candidates as materialized (
    select lang, words, size, f as a from frequent where size >= 2
), cuts as (
    select c.lang, c.words, c.size, c.a, k, h.f as l, t.f as r,
        ((2000000::hugeint * c.a) // (h.f + t.f))::bigint as score
    from (select *, unnest(range(1, size)) as k from candidates) c
    join frequent h on h.lang = c.lang and h.words = c.words[1:k]
    join frequent t on t.lang = c.lang and t.words = c.words[k + 1:c.size]
), scored as (
    select * from cuts
    qualify row_number() over (partition by lang, words order by score, k) = 1
), inner_parts as (
    select lang, words[p:p + m - 1] as words, a as longer
    from (select *, unnest(range(1, size - m + 2)) as p
          from (select *, unnest(range(2, size)) as m from candidates))
), most as (
    select lang, words, max(longer) as longer from inner_parts group by lang, words
)
select lang, row_number() over (partition by lang
        order by score desc, a desc, array_to_string(words, ' ')) as rank,
    array_to_string(words, ' ') as phrase, a, l, r, n, score
from scored left join most using (lang, words) join totals using (lang)
where longer is null or 100 * longer < 80 * a
qualify rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op13_rolled_up_phrases": _COLLOCATIONS,
    "op8_entropy_mix": _MIX,
    "op11_recompression": _PASSAGES,
    "op12_residue_products": _NEGATIVES,
}
