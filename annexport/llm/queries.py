"""One registered query per operator: each applies it, with production parameters, to a whole table
and derives the digest columns from its result. ``ORACLES`` holds SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from annexport.llm import (
    bpe, common, contexttree, decontaminate, filteraudit, hardnegatives, outliers, pii, quality, simhash,
    tokencount, trainingorder, urlfilter, warc,
)

BPE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_training_order(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = trainingorder.shard_folder(spark)
    shards = trainingorder.materialised(docs, bpe.read_ranks(public_tokenizers.path(BPE_VOCABULARY)), folder)
    return trainingorder.read_shards(shards, folder)


def op2_warc_revisits(spark, sf_dir):
    pages = common.table(spark, sf_dir, "pages")
    folder = warc.archive_folder(spark)
    rows = warc.read_archives(spark, folder, warc.write_archives(pages, folder), payloads=False)
    return rows.select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


HELD_OUT_SCORING = (7, 2)


def op3_context_tree(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = common.id_remainder(F.col("doc_id"), HELD_OUT_SCORING[0]) == HELD_OUT_SCORING[1]
    return contexttree.scored(docs, held_out)


def op4_byte_bpe(spark, sf_dir):
    ranks = bpe.read_ranks(public_tokenizers.path(BPE_VOCABULARY))
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.encoded(docs, ranks, keep_ids=False)
    return rows.select("doc_id", "encoded.n_tokens", "encoded.ids_sha256", "encoded.decoded_sha256")


def op5_decontamination(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontaminate.benchmark_matches(docs, common.table(spark, sf_dir, "benchmark"))
    m = F.col("matches")
    return rows.select(
        "doc_id", m["n_words"].alias("n_words"), m["n_hit"].alias("n_hit"),
        F.size(m["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", m["items"]).cast("binary"), 256).alias("items_sha256"),
        m["contaminated"].alias("contaminated"),
    )


HELD_OUT_QUALITY = (4, 2)  # divisor and remainder of ids that are never learnt from


def op6_quality_classifier(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.table(spark, sf_dir, "labels")
    held_out = common.id_remainder(F.col("doc_id"), HELD_OUT_QUALITY[0]) == HELD_OUT_QUALITY[1]
    weights = quality.train(docs, labels.where(~held_out))
    rows = quality.quality_score(docs, weights)
    return rows.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


WORD_VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048


def op7_token_counts(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = tokencount.token_counts(docs, public_tokenizers.path(WORD_VOCABULARY))
    return rows.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )


def op8_simhash(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op9_url_filter(spark, sf_dir):
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url")
    j = F.col("judged")
    return urlfilter.judged(pages, RULES).select(
        "page_id", j["host"].alias("host"), j["path"].alias("path"),
        F.concat(j["rule_host"], j["rule_path"]).alias("rule"), j["verdict"].alias("verdict"),
    )


def op10_robust_outliers(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = outliers.outlier_verdicts(outliers.with_statistics(docs).drop("text"))
    return rows.select("doc_id", *outliers.RESULT, "kept", "distance")


def op11_filter_audit(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filteraudit.audit(filteraudit.filter_masks(docs), common.table(spark, sf_dir, "labels"))


ANCHOR_IDS = 100  # anchors are the rows whose id this divides
RELABELLED = 7  # of ids that this divides the label is the next one


def op12_hard_negatives(spark, sf_dir):
    rows = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % RELABELLED == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.hard_negatives(rows.withColumn("label", label), F.col("id") % ANCHOR_IDS == 0)


def op13_pii(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("pii", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return pii.personal_data(docs).select(
        "doc_id", *[count(k) for k in pii.BASE],
        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("pii")).alias("spans"),
    )


QUERIES = {
    "op1_training_order": op1_training_order,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_context_tree": op3_context_tree,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_decontamination": op5_decontamination,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_token_counts": op7_token_counts,
    "op8_simhash": op8_simhash,
    "op9_url_filter": op9_url_filter,
    "op10_robust_outliers": op10_robust_outliers,
    "op11_filter_audit": op11_filter_audit,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_pii": op13_pii,
}

_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

ORACLES: dict[str, str] = {
    "op2_warc_revisits": """
        with b as (
            select page_id, encode(coalesce(html, '')) as body from pages
        ), p as (
            select page_id, octet_length(body) as payload_bytes, sha256(body) as payload_digest from b
        ), f as (
            select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by 1
        )
        select page_id, payload_bytes, p.payload_digest,
            case when first is null or page_id = first then 'response' else 'revisit' end as record_type,
            case when first is null or page_id = first then null else first end as refers_to
        from p left join f on p.payload_digest = f.payload_digest and payload_bytes >= 100
    """,
    "op9_url_filter": f"""
        with r(rule_host, rule_path, v) as (values {_RULE_VALUES}),
        u as (
            select page_id, case when strpos(url, '://') > 0
                then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') else '' end as rest
            from pages
        ), h as (
            select page_id,
                translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) as path
            from u
        ), m as (
            select h.page_id, host, path, rule_host, rule_path, v,
                row_number() over (partition by h.page_id order by length(rule_host) desc nulls last, length(rule_path) desc) as k
            from h left join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        )
        select page_id, host, path, rule_host || rule_path as rule, coalesce(v, 'allow') as verdict from m where k = 1
    """,
    "op11_filter_audit": r"""
        with d as (
            select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents
        ), w as (
            select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by t) as least from d
        ), m as (
            select doc_id, part, (len(words) < 100) as a, (100 * len(list_distinct(words)) < 80 * len(words)) as b,
                (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t)) as c,
                regexp_matches(t, '[#$%&*|]') as d, coalesce(least < doc_id, false) as e
            from w
        ), l as (
            select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by 1
        ), s as (
            select part, (case when a then 'A' else '' end) || (case when b then 'B' else '' end) || (case when c then 'C' else '' end)
                || (case when d then 'D' else '' end) || (case when e then 'E' else '' end) as fails,
                count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
            from m left join l using (doc_id) group by 1, 2
        ), f(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')), o as (
            select f1.x || f2.x || f3.x || f4.x || f5.x as filter_order from f f1, f f2, f f3, f f4, f f5
            where len(list_distinct([f1.x, f2.x, f3.x, f4.x, f5.x])) = 5
        ), k as (
            select filter_order, step, filter_order[step] as own, filter_order[:step - 1] as before
            from o, (select unnest(range(1, 6))::int as step)
        ), r as (
            select part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) as hit,
                before <> '' and regexp_matches(fails, '[' || before || 'z]') as gone
            from s, k
        ), t as (
            select part, filter_order, step, own, cast(sum(case when not hit and not gone then n else 0 end) as bigint) as kept,
                cast(sum(case when hit and not gone then n else 0 end) as bigint) as removed,
                cast(sum(case when hit and gone then n else 0 end) as bigint) as redundant,
                cast(sum(case when fails = own then n else 0 end) as bigint) as unique_fails,
                cast(sum(case when hit and not gone then good else 0 end) as bigint) as good_lost,
                cast(sum(case when hit and not gone then toxic else 0 end) as bigint) as toxic_lost
            from r group by 1, 2, 3, 4
        )
        select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            cast(sum(removed) over (partition by part, own) as bigint) as shapley
        from t
    """,
    "op12_hard_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)) as e
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.e, b.e)::bigint as score
            from v a, v b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
        ), p as (
            select anchor_id, vec_id as positive_id, score as positive_score from s where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        )
        select anchor_id, positive_id, row_number() over (
                partition by anchor_id, positive_id order by score desc, vec_id
            )::int as rank, vec_id as negative_id, positive_score, score as negative_score
        from p join s using (anchor_id)
        where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
        qualify rank <= 5
    """,
}
