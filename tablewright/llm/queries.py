"""The registered queries over ``documents``, one for each operator, and their
SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import byte_bpe, conversation_trie, exact_dedup, fill_middle, fingerprints, hilbert, jaccard_join, license_scan, line_dedup, packing, quality_rules, token_counts, toxicity
from tablewright.llm.common import documents

JSON_50K, RANKS_50K = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).drop("spans")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeated_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "removed_lines", F.char_length("text").cast("long").alias("clean_chars"),
        F.sha2("text", 256).alias("clean_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(JSON_50K), public_tokenizers.PATTERN)


def op5_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard(documents(spark, sf_dir), ["text", "source", "lang"])


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(JSON_50K), public_tokenizers.PATTERN)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path(RANKS_50K),
                                     public_tokenizers.PATTERN, with_ids=False)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.transform(documents(spark, sf_dir))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("text", 256).alias("output_sha256"),
                      F.sha2(fill_middle.restored(F.col("text"), F.col("form")), 256).alias("restored_sha256"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.round("posterior", 6).alias("posterior"), F.array_join("votes", ",").alias("votes"))


def _quality_sql() -> str:
    """The statistics by unnested words and windows, and the model's rounds as a recursive query over the counts of ballots."""
    q = quality_rules
    n = range(len(q.RULES))
    believed = {"fg": q.FOR_GOOD, "fb": q.FOR_BAD, "ag": q.AGAINST_GOOD, "ab": q.AGAINST_BAD}
    names = [f"{k}{j}" for k in believed for j in n]
    score = "ln(share / (1 - share)) + " + " + ".join(
        f"CASE v{j} WHEN 1 THEN greatest(ln(fg{j} / fb{j}), 0) WHEN -1 THEN least(ln(ag{j} / ab{j}), 0) ELSE 0 END" for j in n)
    weight, vote = {"g": "good", "b": "(n - good)"}, {"f": 1, "a": -1}
    rates = [f"({q.SEEN * believed[k]} + coalesce(sum({weight[k[1]]}) FILTER (v{j} = {vote[k[0]]}), 0)) / ({q.SEEN} + sum({weight[k[1]]}))"
             for k in believed for j in n]
    return rf"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM documents),
        g AS (SELECT r, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i, unnest(list_transform(range(1, len(w) - {q.WINDOW - 2}), lambda k: array_to_string(w[k:k + {q.WINDOW - 1}], ' '))) AS x
              FROM d WHERE len(w) >= {q.WINDOW}),
        again AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {q.WINDOW})) AS p
                  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS c FROM g) WHERE c > 1) GROUP BY r),
        s AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
                     coalesce(again.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals,
                     length(regexp_replace(t, '[^!]+', '', 'g')) AS n_shouts, len(list_filter(w, lambda x: regexp_matches(x, '^\p{{L}}+[.,;:?!]?\z'))) AS n_plain,
                     len(list_filter(w, lambda x: regexp_matches(x, '[.?!]\z'))) AS n_ends, len(list_distinct(w)) AS n_distinct
              FROM d LEFT JOIN again ON again.r = d.r),
        v AS (SELECT *, {", ".join(f"({r.vote})::INT AS v{j}" for j, r in enumerate(q.RULES))} FROM s),
        b AS (SELECT {", ".join(f"v{j}" for j in n)}, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
        em AS (SELECT 0 AS k, {q.SHARE}::DOUBLE AS share, {", ".join(f"{believed[k]}::DOUBLE AS {k}{j}" for k in believed for j in n)}
               UNION ALL
               SELECT k + 1, ({q.SEEN * q.SHARE} + sum(good)) / ({q.SEEN} + sum(n)), {", ".join(rates)}
               FROM (SELECT k, b.*, n / (1 + exp(-({score}))) AS good FROM em, b WHERE k < {q.ROUNDS}) GROUP BY k),
        m AS (SELECT share, {", ".join(names)} FROM em WHERE k = {q.ROUNDS}),
        o AS (SELECT v.*, ({q.BASE_FAILED}) AS base_failed, 1 / (1 + exp(-({score}))) AS p FROM v, m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND p >= {q.THRESHOLD} AS kept,
               round(p, 6) AS posterior, concat_ws(',', {", ".join(f"v{j}" for j in n)}) AS votes FROM o"""


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rebuilt on the first turns (0 to 3) of the first of their twenty."""
    conv = F.col("conv")
    return conversation_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), from_conv=conv - conv % 20,
                                         from_turns=F.crc32(F.encode(conv.cast("string"), "UTF-8")) % 4, most_from=3)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_license_scan, op3_line_dedup, op4_packing, op5_hilbert_sharding,
                                    op6_jaccard_join, op7_token_counts, op8_exact_dedup, op9_fingerprints, op10_byte_bpe, op11_fill_middle,
                                    op12_quality_rules, op13_conversation_trie)}

SQL = {
    "op6_jaccard_join": """
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE
                  WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
        reach(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN e ON e.a = r.c)
        SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
        FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""",
    "op8_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op11_fill_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                          sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        x AS (SELECT doc_id, t, u, len(u) AS n, [('0x' || h[1:8])::BIGINT, ('0x' || h[9:16])::BIGINT, ('0x' || h[17:24])::BIGINT,
                     ('0x' || h[25:32])::BIGINT] AS r FROM d),
        c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
                     CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
                          WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
        p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256 FROM p""",
    "op12_quality_rules": _quality_sql(),
    "op13_conversation_trie": """
        WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
                          sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS s
                   FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, s[1:32]) AS i FROM t),
        r AS (SELECT DISTINCT c, c - c % 20 AS b, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::UBIGINT)),
                  lambda z, x: list_reduce(list_prepend(xor(z, x), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                           lambda a, y: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))) AS z FROM t),
        h AS (SELECT c, b, (xor(z, 4294967295::UBIGINT) % 4)::BIGINT AS h FROM r),
        parts AS (SELECT h.c, 0 AS own, o.i, o.s, o.text FROM h JOIN o ON o.c = h.b AND o.i <= h.h
                  UNION ALL SELECT h.c, 1, o.i, o.s, o.text FROM h JOIN o ON o.c = h.c AND o.i > h.h),
        p AS (SELECT c, s, text, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d FROM parts),
        m AS (SELECT c, 0 AS d, []::VARCHAR[] AS k, 0 AS words FROM h
              UNION ALL SELECT c, d, list(s) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING),
                               len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM p),
        l AS (SELECT *, max(d) OVER (PARTITION BY c) AS last FROM m),
        n AS (SELECT k, d, any_value(words) AS words, min(c) AS conv_id, count(*) AS n_convs,
                     sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last = d), '')) AS ends_sha256 FROM l GROUP BY k, d),
        kids AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
        x AS (SELECT n.*, coalesce(kids.n, 0) AS n_children, up.conv_id AS parent_conv_id FROM n LEFT JOIN kids ON kids.k = n.k
              LEFT JOIN n up ON n.d > 0 AND up.k = n.k[1:n.d - 1] AND up.d = n.d - 1),
        under AS (SELECT a.k, count(*) FILTER (x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.words)::BIGINT AS saved_tokens
                  FROM x JOIN m a ON a.c = x.conv_id AND a.d <= x.d GROUP BY a.k)
        SELECT x.conv_id, x.d AS depth, x.parent_conv_id, x.n_convs, x.n_children, under.n_leaves, under.saved_tokens, x.ends_sha256
        FROM x JOIN under ON under.k = x.k""",
}
