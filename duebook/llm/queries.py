"""One query for each operator, with production parameters over whole tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, lexical, mixing, near_dedup, pii, prefix_join, quality, tokencount, topk, toxicity, trie, urlrules
from .staging import class_labels, crc_fold, shared_root, table

URL_RULES = (
    urlrules.ListRule("allow", "com/"),
    urlrules.ListRule("block", "example.com/en/"),
    urlrules.ListRule("allow", "www.example.com/en/"),
    urlrules.ListRule("block", "net/es/"),
    urlrules.ListRule("block", "net/fr/"),
)


def _predicted(scores: DataFrame, folds: int, held: int, *more: str) -> DataFrame:
    return scores.select(
        "doc_id",
        (crc_fold("doc_id", folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        *more,
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = class_labels(table(spark, sf_dir, "labels"), "toxic").where(crc_fold("doc_id", 3) != 1)
    scores = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), labels)
    return _predicted(scores, 3, 1, "threshold", "toxic")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = class_labels(table(spark, sf_dir, "labels"), "quality").where(crc_fold("doc_id", 4) != 2)
    return _predicted(quality.quality_scores(table(spark, sf_dir, "documents"), labels), 4, 2)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.NearDedup(percent=85))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learnt = documents.where(crc_fold("doc_id", 4) != 2)
    found = langid.languages(documents, learnt)
    return found.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))

    def joined(kinds: tuple[str, ...]):
        base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.BASE_KINDS]
    digest = F.sha2(joined(pii.BASE_KINDS), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, joined(pii.KINDS).alias("spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where("doc_id is not null")
    bad = F.max((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0))
    judged = urlrules.judge(
        table(spark, sf_dir, "pages"), labels.groupBy("doc_id").agg(bad.alias("bad")), URL_RULES
    )
    return judged.select("page_id", "host", "path", "rule", "verdict", "confidence", F.array_join("matched", " ").alias("matched"))


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own for each call; a user names a lasting one."""
    import uuid

    import public_tokenizers

    cache = f"{shared_root(spark)}/token-cache-{uuid.uuid4().hex}"
    return tokencount.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), cache
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over conversations that start with up to five turns of the one whose id ends their hundred."""
    places = trie.turn_places(table(spark, sf_dir, "conversations"))
    base = F.col("conv_id") - F.col("conv_id") % 100
    return trie.prefix_nodes(*trie.spliced(places, base, F.crc32(F.col("conv_id").cast("string")) % 6))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_join.prefix_join(table(spark, sf_dir, "documents"), prefix_join.PrefixJoin(percent=85, size=4))
    return found.select("doc_id", "n_shingles", "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_near_dedup": op3_near_dedup,
    "op4_topk": op4_topk,
    "op5_language": op5_language,
    "op6_pii": op6_pii,
    "op7_decontamination": op7_decontamination,
    "op8_mixing": op8_mixing,
    "op9_url_filter": op9_url_filter,
    "op10_token_count": op10_token_count,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_ngram_join": op13_ngram_join,
}


def _joined_sql(size: int, more: str) -> str:
    """Components of texts whose sets of ``size``-word shingles are linked at 85 %, as SQL; empty sets stay alone."""
    places = ", ".join(f"w[{i}:]" for i in range(1, size + 1))
    words = ", ".join(f"z[{i}]" for i in range(1, size + 1))
    return rf"""
        with recursive words as (
            select row_number() over () as row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') as w from documents
        ), sets as (
            select row, doc_id, list_sort(list_distinct(
                case when len(w) = 0 then [] when len(w) < {size} then [array_to_string(w, ' ')]
                     else list_transform(list_zip({places}, true), lambda z: concat_ws(' ', {words})) end)) as s
            from words
        ), keyed as (
            select row, doc_id, len(s) as n, s, case when len(s) = 0 then row::varchar else md5(array_to_string(s, chr(10))) end as key
            from sets
        ), classes as (
            select row_number() over () as class, key, any_value(s) as s, any_value(n) as n, min(doc_id) as id
            from keyed group by key
        ), grams as (
            select class, n, unnest(s) as gram from classes
        ), linked as (
            select a.class as x, b.class as y from grams a join grams b on a.gram = b.gram and a.class < b.class
            group by a.class, b.class, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), both_ways as (
            select x, y from linked union all select y, x from linked
        ), reach as (
            select class, class as seen from classes
            union
            select r.class, e.y from reach r join both_ways e on e.x = r.seen
        ), named as (
            select c.key, min(o.id) as component_id
            from classes c join reach r on r.class = c.class join classes o on o.class = r.seen group by c.key
        )
        select k.doc_id, k.n::bigint as n_shingles, c.component_id{more}
        from keyed k join named c on c.key = k.key
    """


ORACLE = {
    "op3_near_dedup": _joined_sql(5, ", k.doc_id is not distinct from c.component_id as kept"),
    "op4_topk": """
        with vectors as (
            select row_number() over () as row, vec_id,
                   list_transform(embedding, lambda x: floor(64 * x::double)) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scores as (
            select q.row, q.vec_id as query_id, d.vec_id, list_inner_product(q.v, d.v)::bigint as score
            from vectors q join vectors d on d.row <> q.row where q.vec_id % 20 = 0
        ), ranked as (
            select *, row_number() over (partition by row order by score desc, vec_id) as rank from scores
        )
        select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20
    """,
    "op13_ngram_join": _joined_sql(4, ""),
    "op8_mixing": r"""
        with docs as (
            select doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
                   ('0x' || substr(md5(coalesce(doc_id::varchar, text, '')), 1, 15))::bigint as h
            from documents
        ), per_source as (
            select source, sum(size)::bigint as source_size from docs group by source
        ), ranked as (
            select *, row_number() over (order by encode(source) nulls last) as place,
                   sum(source_size) over () * 1.5::double as all_words
            from per_source
        ), weighted as (
            select *, case (place - 1) % 3 when 0 then 3 when 1 then 1 else 2 end as weight from ranked
        ), factors as (
            select *, (all_words - coalesce(sum(2 * source_size) over before, 0))
                      / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as factor
            from weighted
            window before as (order by (2 * source_size)::double / weight, place
                              rows between unbounded preceding and 1 preceding)
        ), targets as (
            select source, source_size,
                   least((2 * source_size)::double, max(factor) over () * weight) as target
            from factors
        ), budgets as (
            select *, (target >= source_size)::int as base,
                   case when target >= source_size then target - source_size else target end as budget
            from targets
        ), summed as (
            select d.doc_id, d.size, d.h, b.*,
                   sum(d.size) over (partition by d.source order by d.h) as upto
            from docs d join budgets b on d.source is not distinct from b.source
        ), groups as (
            select source, budget, h, sum(size) as words, min(upto) as upto from summed group by source, budget, h
        ), cut as (
            select source, min_by(case when upto - budget < budget - (upto - words) then h else h - 1 end, h) as threshold
            from groups where upto > budget and upto - words <= budget group by source
        )
        select s.doc_id, s.size, s.source_size, s.target,
               (s.size * (s.base + (c.threshold is null or s.h <= c.threshold)::int))::bigint as taken
        from summed s left join cut c on s.source is not distinct from c.source
    """,
    "op11_prefix_trie": r"""
        with recursive own as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                   row_number() over (partition by conv_id order by turn nulls first) as place
            from conversations where conv_id is not null
        ), ids as (
            select distinct conv_id,
                   list_reduce(flatten(list_transform(string_split(conv_id::varchar, ''),
                                                      lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0])),
                               lambda crc, x: xor(xor(crc, x) >> 1, case when xor(crc, x) & 1 = 1 then 3988292384 else 0 end),
                               4294967295::bigint) as crc
            from own
        ), plans as (
            select conv_id, conv_id - conv_id % 100 as base, xor(crc, 4294967295) % 6 as heads from ids
        ), taken as (
            select p.conv_id, p.heads, count(o.place) as n
            from plans p left join own o on o.conv_id = p.base and o.place <= p.heads group by all
        ), turns as (
            select p.conv_id, o.place, role, text from plans p join own o on o.conv_id = p.base and o.place <= p.heads
            union all
            select t.conv_id, o.place - t.heads + t.n, role, text
            from taken t join own o on o.conv_id = t.conv_id and o.place > t.heads
        ), paths as (
            select conv_id, 0::bigint as depth, '' as key, null::varchar as up, 0::bigint as chars from ids
            union all
            select t.conv_id, t.place, md5(concat(p.key, '/', md5(t.role), md5(t.text))), p.key, length(t.text)
            from paths p join turns t on t.conv_id = p.conv_id and t.place = p.depth + 1
        ), lengths as (
            select conv_id, max(depth) as depth from paths group by conv_id
        ), nodes as (
            select p.key, any_value(p.up) as up, min(p.conv_id) as conv_id, p.depth, count(*) as n_convs,
                   any_value(p.chars) as chars,
                   coalesce(string_agg(p.conv_id::varchar, ',' order by p.conv_id) filter (where l.depth = p.depth), '') as ends
            from paths p join lengths l on l.conv_id = p.conv_id group by p.key, p.depth
        ), children as (
            select up, count(*) as n from nodes where up is not null group by up
        ), figures as (
            select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c on c.up = n.key
        ), totals as (
            select a.key, a.depth, sum((f.n_convs - 1) * f.chars) as saved, count(*) filter (where f.n_children = 0) as leaves
            from figures f join paths a on a.conv_id = f.conv_id and a.depth <= f.depth group by a.key, a.depth
        )
        select f.conv_id, f.depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, t.leaves as n_leaves,
               t.saved::bigint as saved_tokens, sha256(f.ends) as ends_sha256
        from figures f join totals t on t.key = f.key and t.depth = f.depth
        left join nodes u on u.key = f.up and u.depth = f.depth - 1
    """,
    "op12_lexical_search": r"""
        with docs as (
            select row_number() over () as row, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
        ), items as (
            select row_number() over () as item, item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
        ), wanted as (
            select item, any_value(item_id) as item_id, term, count(*) as times from items group by item, term
        ), sizes as (
            select count(*)::hugeint as n, sum(len(terms))::hugeint as l from docs where len(terms) > 0
        ), lengths as (
            select row, doc_id, 75 + ((25 * len(terms) * n) // l)::bigint as m from docs, sizes where len(terms) > 0
        ), counts as (
            select row, term, count(*) as tf from (select row, unnest(terms) as term from docs)
            where term in (select term from wanted) group by row, term
        ), weights as (
            select term, floor(1000 * ln((2 * n + 2)::double / (2 * df + 1)::double))::bigint as w
            from (select term, count(*) as df from counts group by term), sizes
        ), scores as (
            select q.item, q.item_id, l.doc_id, l.row,
                   sum(q.times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
            from counts c join weights using (term) join lengths l using (row) join wanted q using (term)
            group by q.item, q.item_id, l.doc_id, l.row
        ), ranked as (
            select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank
            from scores where score > 0
        )
        select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
    """,
}
