"""One query per operator over the whole tables, with SQL for DuckDB where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tagloom.llm.bpe import bpe_round_trip
from tagloom.llm.common import table
from tagloom.llm.exact_dedup import exact_dedup
from tagloom.llm.fingerprints import fingerprint_chain
from tagloom.llm.hard_negatives import mine_hard_negatives
from tagloom.llm.html_text import extract_main_text
from tagloom.llm.jaccard_join import jaccard_classes
from tagloom.llm.language import fit_language_model, held_out, predict_language
from tagloom.llm.line_dedup import line_dedup
from tagloom.llm.mixing import mixing_plan
from tagloom.llm.near_vectors import near_vectors
from tagloom.llm.personal_data import KINDS, find_personal_data, fit_chain_field
from tagloom.llm.quality import KEEP, fit_label_model, fit_scorer, score_quality
from tagloom.llm.vector_codes import ENTRIES, PARTS, ROUNDS, codebooks_digest, compress_vectors

QUERIES, SQL = {}, {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_source_mixing(spark, sf):
    plan = mixing_plan(table(spark, sf, "documents"))
    return plan.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows")))).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").cast("double").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


@query
def op3_exact_dedup(spark, sf):
    return exact_dedup(table(spark, sf, "documents"))


SQL["op3_exact_dedup"] = r"""
    with t as (
        select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) text_sha256 from documents
    )
    select doc_id, min(doc_id) over same_text keep_id, count(*) over same_text group_size,
           doc_id = min(doc_id) over same_text kept, text_sha256
    from t window same_text as (partition by text_sha256)"""


@query
def op10_line_dedup(spark, sf):
    out = line_dedup(table(spark, sf, "documents"))
    return out.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


SQL["op10_line_dedup"] = r"""
    with lines as (
        select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) pos
        from documents
    ), keyed as (
        select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') line_key
        from lines
    ), shared as (
        select line_key, max(doc_id) last_id from keyed where length(line_key) >= 20
        group by line_key having count(distinct doc_id) >= 3
    ), marked as (
        select k.*, coalesce(doc_id <> last_id, false) dropped from keyed k left join shared using (line_key)
    )
    select doc_id, count(*) n_lines, count(case when dropped then 1 end) n_dropped,
           sha256(coalesce(string_agg(case when not dropped then line end, chr(10) order by pos), '')) kept_sha256
    from marked group by doc_id"""


@query
def op6_bpe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_html_text(spark, sf):
    pages = extract_main_text(table(spark, sf, "pages"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


@query
def op4_fingerprints(spark, sf):
    return fingerprint_chain(table(spark, sf, "documents"))


@query
def op2_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    network = fit_language_model(docs)
    out = predict_language(docs.select("doc_id", "text"), network)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def _written(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query
def op7_personal_data(spark, sf):
    docs = find_personal_data(table(spark, sf, "documents").select("doc_id", "text"), fit_chain_field()).drop("text")
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return docs.select("doc_id", *map(count, KINDS), F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


@query
def op5_jaccard_join(spark, sf):
    return jaccard_classes(table(spark, sf, "documents"))


@query
def op8_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = fit_label_model(docs)
    scored = score_quality(docs, model, fit_scorer(docs, model))
    return scored.select("doc_id", "quality", "weak_label", (F.col("quality") >= KEEP).alias("kept"))


@query
def op11_near_vectors(spark, sf):
    return near_vectors(table(spark, sf, "embeddings")).drop("label")


SQL["op11_near_vectors"] = """
    with recursive doubles as (
        select vec_id, label, embedding::double[] v from embeddings
    ), usable as (
        select vec_id, label, v from doubles
        where label is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
          and list_dot_product(v, v) > 0
    ), links as (
        select a.vec_id a, b.vec_id b from usable a join usable b on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
        where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93
    ), reached as (
        select vec_id, vec_id other from embeddings
        union
        select r.vec_id, l.b from reached r join links l on l.a = r.other
    ), counted as (
        select a, count(*) n from links group by a
    )
    select vec_id, coalesce(max(n), 0) n_links, min(other) component_id, vec_id = min(other) kept
    from reached left join counted on a = vec_id group by vec_id"""


@query
def op12_vector_codes(spark, sf):
    coded, books = compress_vectors(table(spark, sf, "embeddings"))
    return coded.drop("label").withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))


def _codes_sql() -> str:
    """Each round as two tables: the nearest entry of every part, and the entries after it."""
    width = f"(len(v) // {PARTS})"
    steps = [
        f"""whole as materialized (
            select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) v from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), parts as materialized (
            select vec_id, label, part, v[part * {width} + 1:(part + 1) * {width}] q from whole, range({PARTS}) p(part)
        ), book0 as materialized (
            select part, entry, q e from (
                select part, q, row_number() over (partition by part order by vec_id) - 1 entry from parts
            ) where entry < {ENTRIES}
        )"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""near{i} as materialized (
            select vec_id, label, part, any_value(q) q,
                   min({{'d': list_dot_product(q, q) - 2 * list_dot_product(q, e) + list_dot_product(e, e), 'entry': entry}}) best
            from parts join book{i} using (part) group by vec_id, label, part
        )"""
        )
        if i < ROUNDS:
            steps.append(
                f"""mean{i} as (
            select part, best.entry entry, pos, floor(sum(q[pos]) / count(*)) x
            from near{i}, range(1, 1000) r(pos) where pos <= len(q) group by all
        ), book{i + 1} as materialized (
            select part, entry, coalesce(list(x order by pos) filter (x is not null), any_value(e)) e
            from book{i} left join mean{i} using (part, entry) group by part, entry
        )"""
            )
    last = ROUNDS
    return f"""
        with {', '.join(steps)}, coded as (
            select vec_id, label, string_agg(printf('%02x', best.entry), '' order by part) code, sum(best.d)::bigint error
            from near{last} group by vec_id, label
        )
        select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error,
               (select sha256(string_agg(array_to_string(list_transform(e, lambda x: x::bigint), ','), ',' order by part, entry)) from book{last}) codebooks_sha256
        from coded"""


SQL["op12_vector_codes"] = _codes_sql()


@query
def op13_hard_negatives(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return mine_hard_negatives(vectors, lambda vec_id: vec_id % 50 == 0)


SQL["op13_hard_negatives"] = """
    with usable as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
               list_transform(embedding, lambda x: floor(256 * x::double)) v
        from embeddings
        where label is not null and embedding is not null and len(embedding) > 0
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select a.vec_id anchor_id, b.vec_id, a.label = b.label same, list_dot_product(a.v, b.v)::bigint score
        from usable a join usable b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    ), positives as (
        select anchor_id, vec_id positive_id, score positive_score from scored where same
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
    )
    select anchor_id, positive_id,
           (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::integer rank,
           vec_id negative_id, positive_score, score negative_score
    from positives join scored using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
    qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 3"""
