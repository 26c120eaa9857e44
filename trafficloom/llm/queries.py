"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann, chat, codebooks, filter_audit, mixing, near_dedup, packing, page_diff, pii, quality, secret_scan, tokens, topk,
)
from .common import WORD, table

#: The pseudonyms' key; a real run takes it from where it keeps its secrets.
KEY = "a key for tests and examples"
SEQUENCE = 1024


def of_kind(column: str, kind: str) -> Column:
    """Entries of the kind, as n_<kind>."""
    return F.size(F.filter(column, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), percent=85)


def nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), SEQUENCE)


def is_target() -> Column:
    """What the quality model is to favour: labelled good, and not toxic."""
    return (F.col("quality") == 1) & (F.col("toxic") == 0)


def is_toxic() -> Column:
    """What the sample is to be free of, however good the rest of its text."""
    return F.col("toxic") == 1


def quality_sample(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    sample = quality.resample(docs, labels, is_target(), unwanted=is_toxic())
    return sample.select("doc_id", "quality.*")


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = tokens.prefix_counts(table(spark, folder, "documents"), SEQUENCE)
    over = (F.col("n_tokens") > SEQUENCE).alias("over_limit")
    return counts.select("doc_id", "n_bytes", "n_tokens", over, "fits_chars")


def pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    made = pii.pseudonymise(table(spark, folder, "documents"), KEY)
    return made.select("doc_id", "text", *(of_kind("found", k) for k in pii.KINDS))


def exact_top(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_inner_products(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, k=10)


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    made = mixing.mix(table(spark, folder, "documents"))
    return made.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "mix.copies")


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return chat.collapse_and_render(table(spark, folder, "conversations"))


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    plain = ("assign", "access", "hex")
    base = F.filter("spans", lambda s: s["kind"].isin(*plain))
    return found.select(
        "doc_id",
        *(of_kind("spans", k) for k in plain),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codebooks.compress(table(spark, folder, "embeddings"))


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return page_diff.main_text(table(spark, folder, "pages")).drop("n_shared", "n_kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": near_duplicates,
    "op2_nearest_neighbours": nearest_neighbours,
    "op3_packing": packed,
    "op4_quality": quality_sample,
    "op5_token_counts": token_counts,
    "op6_pseudonyms": pseudonyms,
    "op7_exact_top": exact_top,
    "op8_mixing": mixture,
    "op9_conversations": conversations,
    "op10_secrets": secrets,
    "op11_filter_interactions": filter_interactions,
    "op12_vector_codes": vector_codes,
    "op13_page_texts": page_texts,
}

_LOWER = f"translate(text, '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"


def _assigned(n: int) -> str:
    """The nearest entry of every part in codebook b<n>, ties to the lower index."""
    return f"""
        a{n} as (
            select vec_id, p, min({{'d': list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(q, c)]), 'e': e}}) best
            from parts join b{n} using (p) group by all
        )"""


def _refitted(n: int) -> str:
    """Codebook b<n> from the parts assigned in b<n - 1>."""
    return f"""
        m{n} as (
            select p, best.e e, i, cast(floor(sum(q[i]) / count(*)) as bigint) x
            from parts join a{n - 1} using (vec_id, p), range(1, 5) r(i) group by all
        ),
        b{n} as (
            select p, e, coalesce(any_value(o.q), any_value(b.c)) c from b{n - 1} b
            left join (select p, e, list(x order by i) q from m{n} group by all) o using (p, e) group by all
        )"""


SQL = {
    "op1_near_duplicates": f"""
        with recursive words as (
            select doc_id, regexp_extract_all({_LOWER}, '{WORD}') w from documents
        ),
        shingles as (
            select doc_id, case
                when w is null or len(w) = 0 then []
                when len(w) < 5 then [array_to_string(w, ' ')]
                else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end s
            from words
        ),
        sizes as (select doc_id, len(s) n from shingles),
        items as (select doc_id, unnest(s) s from shingles),
        sets as (
            select doc_id, n, (select min(o.doc_id) from shingles o where list_sort(o.s) = list_sort(z.s)) head
            from sizes join shingles z using (doc_id) where n > 0
        ),
        heads as (select doc_id, n from sets where doc_id = head),
        shared as (
            select a.doc_id a, b.doc_id b, count(*) c from items a join items b on a.s = b.s and a.doc_id < b.doc_id
            where a.doc_id in (select doc_id from heads) and b.doc_id in (select doc_id from heads) group by all
        ),
        links as (
            select a, b from shared join heads x on x.doc_id = a join heads y on y.doc_id = b
            where 100 * c >= 85 * (x.n + y.n - c)
        ),
        ways as (select a, b from links union all select b, a from links),
        reach as (
            select doc_id node, doc_id r from heads
            union
            select ways.b, reach.r from reach join ways on ways.a = reach.node
        ),
        least as (select node, min(r) r from reach group by node)
        select s.doc_id, cast(s.n as bigint) n_shingles, coalesce(r, s.doc_id) component_id,
            s.doc_id = coalesce(r, s.doc_id) kept
        from sizes s left join sets h on h.doc_id = s.doc_id left join least on node = h.head
        """,
    "op7_exact_top": """
        with v as (
            select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] z from embeddings
            where embedding is not null and len(embedding) > 0
                and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
        ),
        scored as (
            select q.vec_id query_id, c.vec_id, cast(list_dot_product(q.z::double[], c.z::double[]) as bigint) score
            from v q join v c on q.vec_id <> c.vec_id and len(q.z) = len(c.z) where q.vec_id % 100 = 0
        )
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) rank,
            vec_id, score
        from scored qualify rank <= 10
        """,
    "op9_conversations": """
        with placed as (
            select conv_id, row_number() over (
                partition by conv_id order by turn nulls last, role nulls last, text nulls last) place,
                role, text
            from conversations where conv_id is not null
        ),
        whole as (
            select conv_id, count(*) n, list({'r': role, 't': text} order by place) turns,
                string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>'
                    || chr(10), '' order by place) as text
            from placed group by conv_id
        ),
        first as (select min(conv_id) conv_id from whole group by turns)
        select conv_id, n n_turns, text from whole w join first using (conv_id)
        where not exists (
            select 1 from whole o where o.n > w.n and o.turns[1] is not distinct from w.turns[1]
                and o.turns[1:w.n] = w.turns)
        """,
    "op11_filter_interactions": f"""
        with texts as (
            select doc_id, coalesce(lang, '') part, coalesce(text, '') t, min(doc_id) over (partition by coalesce(text, '')) first_id
            from documents
        ),
        worded as (select *, regexp_extract_all(t, '{WORD}') w from texts),
        failing as (
            select doc_id, part, [
                len(w) < 200,
                100 * len(list_distinct(w)) < 50 * len(w),
                100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t),
                regexp_matches(t, '[#$%&*|]'),
                coalesce(first_id < doc_id, false)] f
            from worded
        ),
        cells as (
            select part, f, count(*) n, count(*) filter (quality = 1) good, count(*) filter (toxic = 1) toxic
            from failing left join labels using (doc_id) group by all
        ),
        letters as (select unnest(['A', 'B', 'C', 'D', 'E']) l, generate_subscripts(['A', 'B', 'C', 'D', 'E'], 1) i),
        orders as (
            select a.l || b.l || c.l || d.l || e.l o, [a.i, b.i, c.i, d.i, e.i] places
            from letters a, letters b, letters c, letters d, letters e
            where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
        ),
        met as (
            select part, o, step, places[step] filter_place, n, good, toxic, f[places[step]] fails,
                len([x for x in places[:step - 1] if f[x]]) > 0 gone,
                f[places[step]] and len([x for x in f if x]) = 1 alone
            from cells, orders, range(1, 6) s(step)
        ),
        counted as (
            select part, o filter_order, cast(step as integer) step, filter_place,
                coalesce(sum(n) filter (not gone and not fails), 0) kept, coalesce(sum(n) filter (not gone and fails), 0) removed,
                coalesce(sum(n) filter (gone and fails), 0) redundant, coalesce(sum(n) filter (alone), 0) unique_fails,
                coalesce(sum(good) filter (not gone and fails), 0) good_lost,
                coalesce(sum(toxic) filter (not gone and fails), 0) toxic_lost
            from met group by all
        )
        select part, filter_order, step, cast(kept as bigint) kept, cast(removed as bigint) removed,
            cast(redundant as bigint) redundant, cast(unique_fails as bigint) unique_fails, cast(good_lost as bigint) good_lost,
            cast(toxic_lost as bigint) toxic_lost,
            cast(sum(removed) over (partition by part, filter_place) as bigint) shapley
        from counted
        """,
    "op12_vector_codes": f"""
        with rows as (
            select vec_id, label, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] z from embeddings
            where embedding is not null and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
        ),
        parts as (select vec_id, p, z[p * 4 + 1:p * 4 + 4] q from rows, range(16) r(p)),
        b0 as (
            select p, row_number() over (partition by p order by vec_id) - 1 e, q c from parts qualify e < 64
        ),{_assigned(0)},{_refitted(1)},{_assigned(1)},{_refitted(2)},{_assigned(2)},
        digest as (
            select sha256(string_agg(x, ',' order by p, e, i)) books
            from (select p, e, unnest(c) x, generate_subscripts(c, 1) i from b2)
        ),
        coded as (
            select vec_id, string_agg(printf('%02x', best.e), '' order by p) code, cast(sum(best.d) as bigint) error
            from a2 group by all
        )
        select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, books codebooks_sha256
        from coded join rows using (vec_id), digest
        """,
    # The pages of these tables declare their article by its element, so its blocks are the text.
    "op13_page_texts": r"""
        with inside as (select page_id, url, regexp_extract(html, '(?s)<article>(.*)</article>', 1) h from pages),
        blocks as (
            select page_id, url, [regexp_replace(regexp_replace(b, '<br>', ' ', 'g'), '</?b>', '', 'g')
                for b in regexp_split_to_array(h, '</?(?:p|h1)>')] b
            from inside
        ),
        plain as (
            select page_id, url, [trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x,
                '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) for x in b] b
            from blocks
        ),
        texts as (select page_id, url, array_to_string([x for x in b if x <> ''], chr(10)) as text from plain)
        select page_id, url, text, cast(length(text) as bigint) n_chars from texts
        """,
}
