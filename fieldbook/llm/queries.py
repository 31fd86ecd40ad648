"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import (ann, chat, exact_dedup, html_wrapper, jaccard_join, mixing, periodic_runs, quality,
                           sentencepiece_codec, sharding, spelling, token_counts, warc)
from fieldbook.plans.tables import load

SHARDS = 24
CHAT_BUDGET, CHAT_HISTORY = 1024, 256


def learning_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that a classifier may learn from: crc32(doc_id as text) modulo 4 is not 2."""
    return load(spark, sf_dir, "labels", "doc_id", "quality").filter(~quality.held_out("doc_id"))


def op1_jump_sharding(spark, sf_dir):
    """Shards 0-23 of all documents by jump consistent hashing of doc_id."""
    return sharding.shard_rows(load(spark, sf_dir, "documents", "doc_id", "text"), SHARDS)


def op2_trie_token_counts(spark, sf_dir):
    """Unigram token counts of all documents."""
    return token_counts.token_counts(load(spark, sf_dir, "documents", "doc_id", "text"))


def op3_sentencepiece_suffix_array(spark, sf_dir):
    """Piece ids of all documents, and whether decoding gives the text back."""
    return sentencepiece_codec.encode_and_check(load(spark, sf_dir, "documents", "doc_id", "text"))


def op4_robust_pruned_graph(spark, sf_dir):
    """The 10 nearest vectors of every row whose vec_id is divisible by 100."""
    return ann.nearest(load(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_subset_sum_mixing(spark, sf_dir):
    """The mix of all documents: sources weigh 5, 2, 1 in turn, targets stop at 3 times the source."""
    return mixing.mix_sources(load(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op6_warc_revisits(spark, sf_dir):
    """All pages as WARC records, payload copies as revisits, read back from the archives."""
    return warc.warc_round_trip(load(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_wrapper_extraction(spark, sf_dir):
    """Main text of all pages through the wrappers of their hosts."""
    return html_wrapper.main_texts(load(spark, sf_dir, "pages", "page_id", "url", "html"))


def op8_ftrl_quality(spark, sf_dir):
    """Quality scores of all documents."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality.score(docs, quality.train(docs, learning_labels(spark, sf_dir)))
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_grouped_prefix_join(spark, sf_dir):
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return jaccard_join.similar_sets(load(spark, sf_dir, "documents", "doc_id", "text"), width=3, threshold=0.9)


def op10_golomb_exact_dedup(spark, sf_dir):
    """Which of equal texts stays, for all documents."""
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents", "doc_id", "text"))


def op11_budgeted_windows(spark, sf_dir):
    """All conversations, and one whose texts are control strings, as windows of a token budget, read back."""
    given = load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                                 "conv_id long, turn long, role string, text string")
    return chat.chat_report(given.unionByName(more), budget=CHAT_BUDGET, history=CHAT_HISTORY)


def op12_difference_cover_runs(spark, sf_dir):
    """Periodic runs of words in all documents, a tenth of which end in a repetition of their own words."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return periodic_runs.run_report(
        docs.select("doc_id", periodic_runs.repeated_stretch(F.col("doc_id"), F.col("text")).alias("text")))


def op13_trie_pair_variants(spark, sf_dir):
    """Spelling variants among the words of all documents, one occurrence in 199 of which lacks a letter."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return spelling.spelling_variants(spelling.count_words(docs, change=spelling.slipped))


SQL: dict[str, str] = {
    "op10_golomb_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
             g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256
        FROM t JOIN g USING (x)
    """,
    "op11_budgeted_windows": r"""
        WITH RECURSIVE t AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS x FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        c AS (
            SELECT conv_id, count(*) AS n,
                   sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY turn, role, x)) AS turns_sha256,
                   coalesce(sum(length(x)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
                   sha256(coalesce(string_agg(x, '' ORDER BY turn, role, x) FILTER (role = 'assistant'), '')) AS loss_sha256,
                   first(role ORDER BY turn, role, x) = 'system' AS led,
                   list((strlen(x) + 3) // 4 + 2 ORDER BY turn, role, x) AS tokens,
                   list(length(regexp_replace(x, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\])', '\1\\\2\3', 'g'))
                        + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                               ELSE 26 + length(role) END ORDER BY turn, role, x) AS chars
            FROM t GROUP BY conv_id),
        -- sums of the first 0, 1, ..., n turns
        q AS (
            SELECT conv_id, n, led, [coalesce(list_sum(tokens[1:k]), 0)::BIGINT FOR k IN range(0, n + 1)] AS e,
                   [coalesce(list_sum(chars[1:k]), 0)::BIGINT FOR k IN range(0, n + 1)] AS l
            FROM c),
        -- windows: history from h, new turns from s, end z
        w AS (
            SELECT conv_id, 0::BIGINT AS h, 0::BIGINT AS s, 0::BIGINT AS z FROM q
            UNION ALL
            SELECT conv_id, h, s, greatest(s + 1, coalesce(list_max([k FOR k IN range(s + 1, n + 1)
                   IF front + e[k + 1] - e[h + 1] <= BUDGET]), 0))
            FROM (
                SELECT conv_id, s, n, e, front,
                       coalesce(list_min([k FOR k IN range(low, s)
                                IF e[s + 1] - e[k + 1] <= HISTORY AND front + e[s + 2] - e[k + 1] <= BUDGET]), s) AS h
                FROM (
                    SELECT w.conv_id, w.z AS s, n, e, CASE WHEN led AND z > 0 THEN e[2] ELSE 0 END AS front,
                           CASE WHEN led AND z > 0 THEN 1 ELSE 0 END AS low
                    FROM w JOIN q USING (conv_id) WHERE z < n) AS reached) AS opened)
        SELECT c.conv_id, c.n AS n_turns, turns_sha256, loss_chars, loss_sha256, f.formatted_chars
        FROM c JOIN (
            SELECT conv_id, sum(l[z + 1] - l[h + 1] + CASE WHEN led AND s > 0 THEN l[2] ELSE 0 END)::BIGINT AS formatted_chars
            FROM w JOIN q USING (conv_id) WHERE z > 0 GROUP BY conv_id) AS f USING (conv_id)
    """.replace("BUDGET", str(CHAT_BUDGET)).replace("HISTORY", str(CHAT_HISTORY)),
}


def registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    """name -> (query, its DuckDB SQL or None)."""
    made = [op1_jump_sharding, op2_trie_token_counts, op3_sentencepiece_suffix_array, op4_robust_pruned_graph,
            op5_subset_sum_mixing, op6_warc_revisits, op7_wrapper_extraction, op8_ftrl_quality,
            op9_grouped_prefix_join, op10_golomb_exact_dedup, op11_budgeted_windows, op12_difference_cover_runs,
            op13_trie_pair_variants]
    return {f.__name__: (f, SQL.get(f.__name__)) for f in made}
