"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    decontaminate,
    jaccard,
    kneser_ney,
    licenses,
    line_dedup,
    pii,
    prefix_trie,
    quality,
    secret_scan,
    token_counts,
    token_files,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": decontaminate.query,
    "op2_bpe": bpe.query,
    "op3_token_counts": token_counts.query,
    "op4_jaccard": jaccard.query,
    "op5_token_files": token_files.query,
    "op6_pii": pii.query,
    "op7_line_dedup": line_dedup.query,
    "op8_quality": quality.query,
    "op9_secrets": secret_scan.query,
    "op10_licenses": licenses.query,
    "op11_whitening": whitening.query,
    "op12_prefix_trie": prefix_trie.query,
    "op13_kneser_ney": kneser_ney.query,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# The other operators need merges, hashes, offsets of matches or rounds; tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op1_decontaminate": f"""
        with d as (select doc_id, {_WORDS} as w from documents),
        b as (select item_id, w, least(len(w), 10) as n from (select item_id, {_WORDS} as w from benchmark) where len(w) > 0),
        spans as (
            select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as s
            from b, unnest(range(1, len(w) - n + 2)) as t(i)
        ),
        lengths as (select distinct n from spans),
        places as (
            select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as s
            from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths)
        ),
        found as (select places.* from places semi join spans using (n, s)),
        hits as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from found) group by doc_id),
        items as (
            select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
            from (select distinct doc_id, cast(item_id as varchar) as id from found join spans using (n, s)) group by doc_id
        )
        select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join hits using (doc_id) left join items using (doc_id)
    """,
}
