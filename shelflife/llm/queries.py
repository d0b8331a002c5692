"""One registered query per operator, over whole tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.llm import (
    conversations,
    decontaminate,
    exact,
    language,
    lines,
    mixing,
    simhash,
    substrings,
    tokens,
    toxicity,
    warc,
    whitening,
    wrapper,
)
from shelflife.llm.shared import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs, items))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_groups(table(spark, sf_dir, "documents")))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substrings.digest(substrings.without_repeats(docs, with_kept=False))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.round_trip(table(spark, sf_dir, "pages")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, sf_dir, "documents"), hash_all=True)
    return groups.withColumnsRenamed({"id": "doc_id", "hash": "text_sha256"})


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixing.document_order(mixed).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        "taken",
        F.round("place", 6).alias("place"),
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.digest(
        wrapper.main_texts(table(spark, sf_dir, "pages"), columns=["page_id", "url"])
    )


#: The labels know two categories; junk is predicted first, as it explains odd wording.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    scored = toxicity.score(docs, chain, CATEGORIES).withColumnRenamed("id", "doc_id")
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.by_section(tokens.token_sections(table(spark, sf_dir, "documents")))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs)).withColumnRenamed("id", "doc_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    return whitening.by_component(whitening.whiten(vectors, model), model).withColumnRenamed("id", "vec_id")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    report = conversations.repair_report(conversations.damaged(rows), ids=rows)
    return report.withColumnRenamed("conv", "conv_id")


def op13_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.judged(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _put(state: str, letter: str, cost: str, line: str) -> str:
    """SQL of a path longer by an edit; null stays null."""
    return (
        f"CASE WHEN {state} IS NOT NULL THEN {{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}',"
        f" 'lines': {state}.lines || {line}}} END"
    )


def _insert(state: str, *roles: str) -> str:
    """SQL of a path longer by inserted rows."""
    lines_, letters = "".join(f"chr(10) || '{r}:' || " for r in roles) + "''", "I" * len(roles)
    return _put(state, letters, str(2 * len(roles)), f"({lines_})")


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_simhash": op2_simhash,
    "op3_suffix_array": op3_suffix_array,
    "op4_warc": op4_warc,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mixing": op6_mixing,
    "op7_html": op7_html,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_line_quality": op13_line_quality,
}

ORACLE = {
    "op1_decontamination": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
            FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), item_windows AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
            FROM (SELECT *, least(len(w), 13) AS n FROM items WHERE len(w) > 0),
                 unnest(range(1, len(w) - n + 2)) AS t(i)
        ), lengths AS (
            SELECT DISTINCT n FROM item_windows
        ), doc_windows AS (
            SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
            FROM docs, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)
        ), hits AS (
            SELECT r, d.n, i, item_id FROM doc_windows d JOIN item_windows USING (win)
            WHERE d.n = item_windows.n
        ), hit_words AS (
            SELECT r, count(DISTINCT p) AS n_hit
            FROM (SELECT DISTINCT r, n, i FROM hits), unnest(range(i, i + n)) AS t(p) GROUP BY r
        ), hit_items AS (
            SELECT r, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM hits GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
        FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
    """,
    "op3_suffix_array": """
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h,
                   CAST(strlen(coalesce(text, '')) AS BIGINT) AS n
            FROM documents
        ), strings AS (
            SELECT r, doc_id, i, substring(h, 2 * i + 1, 100) AS s
            FROM docs, unnest(range(0, n - 49)) AS t(i)
        ), firsts AS (
            SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING count(*) > 1
        ), starts AS (
            SELECT r, i FROM strings JOIN firsts USING (s) WHERE first < doc_id
        ), runs AS (
            SELECT r, min(i) AS lo, max(i) + 50 AS hi
            FROM (SELECT *, sum(gap) OVER (PARTITION BY r ORDER BY i) AS run
                  FROM (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50
                                       THEN 0 ELSE 1 END AS gap FROM starts))
            GROUP BY r, run
        ), edges AS (
            SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS before FROM runs
        ), cut AS (
            SELECT r, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
                   string_agg(substring(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS head
            FROM edges JOIN docs USING (r) GROUP BY r
        )
        SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(head, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM docs LEFT JOIN cut USING (r)
    """,
    "op4_warc": """
        WITH sized AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n
            FROM pages
        ), firsts AS (
            SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first
            FROM sized
        )
        SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM firsts
    """,
    "op5_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                   md5(concat_ws(':', CAST(doc_id AS VARCHAR), 'mix')) AS key
            FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
            FROM sized GROUP BY source
        ), levels AS (
            SELECT *, 3 * source_size AS cap,
                   (sum(source_size) OVER ()
                    - coalesce(sum(3 * source_size) OVER (filling
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                   / (sum(weight) OVER (filling
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
            FROM sources
            WINDOW filling AS (
                ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, source NULLS LAST)
        ), targets AS (
            SELECT source, source_size, weight,
                   CASE WHEN cap <= level * weight THEN cap::DOUBLE
                        ELSE max(CASE WHEN cap > level * weight THEN level END) OVER () * weight
                   END AS target
            FROM levels
        ), placed AS (
            SELECT s.doc_id, s.size, t.source_size, t.target, t.weight,
                   CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
                   CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                       ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS begin
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ), taking AS (
            SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS passes
            FROM placed
        ), taken AS (
            SELECT *, passes * size
                      + greatest(0, least(goal - passes * source_size - begin, size)) AS taken,
                   begin::DOUBLE / goal AS share
            FROM taking
        )
        SELECT doc_id, size, source_size, target, taken,
               CASE WHEN taken > 0 THEN round(CASE weight
                   WHEN 1 THEN 2 * share / (1.5 + sqrt(2.25 - 2 * share))
                   WHEN 2 THEN share
                   ELSE 2 * share / (0.5 + sqrt(0.25 + 2 * share)) END, 6) END AS place
        FROM taken
    """,
    "op12_conversation_repair": rf"""
        WITH RECURSIVE checksums AS (
            SELECT list(value ORDER BY byte) AS entries FROM (
                SELECT byte, list_reduce(list_prepend(byte, range(8)), lambda c, i:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS value
                FROM range(256) AS bytes(byte))
        ), given AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations
        ), diced AS (
            SELECT *, xor(4294967295, list_reduce(
                       list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: CAST(ord(key[i]) AS BIGINT))),
                       lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) % 20 AS dice
            FROM given, checksums
        ), hurt AS (
            SELECT conv_id, turn, CASE WHEN dice = 4 THEN 'user' ELSE role END AS role,
                   CASE dice WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN dice = 3 THEN 2 ELSE 1 END)) AS copy
            FROM diced WHERE dice <> 0
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(strlen(role) || ':' || role || text)) AS n
            FROM hurt
        ), judged AS (
            SELECT conv_id, n, turn, role, text, role[1] AS initial,
                   lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1] AS pair,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault
            FROM ordered
        ), steps AS (
            SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS forced,
                   CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS extra
            FROM judged
        ), found AS (
            SELECT conv_id, count(*) AS n,
                   CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (n > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        ), walk AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS done,
                   CAST({{'cost': 0, 'audit': '', 'lines': ''}} AS STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR)) AS s0,
                   CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR)) AS s1,
                   CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR)) AS s2,
                   CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR)) AS s3
            FROM found
            UNION ALL
            SELECT conv_id, done + 1, {_put("t0", "D", "3", "''")},
                   list_min([{_put("t1", "D", "3", "''")},
                             CASE WHEN NOT forced AND initial = 's' THEN {_put("t0", "K", "extra", "line")} END]),
                   list_min([{_put("t2", "D", "3", "''")},
                             CASE WHEN NOT forced AND initial = 'u' THEN {_put("t013", "K", "extra", "line")} END,
                             CASE WHEN NOT forced THEN {_put("t013", "R", "2 + extra", "chr(10) || 'user:' || text")} END]),
                   list_min([{_put("t3", "D", "3", "''")},
                             CASE WHEN NOT forced AND initial = 'a' THEN {_put("t2", "K", "extra", "line")} END,
                             CASE WHEN NOT forced THEN {_put("t2", "R", "2 + extra", "chr(10) || 'assistant:' || text")} END])
            FROM (
                SELECT *, list_min([t0, t1, t3]) AS t013 FROM (
                    SELECT w.conv_id, done, forced, extra, initial, text, chr(10) || role || ':' || text AS line,
                           s0 AS t0, s1 AS t1,
                           list_min([s2, {_insert("s0", "user")}, {_insert("s1", "user")}, {_insert("s3", "user")}]) AS t2,
                           list_min([s3, {_insert("s2", "assistant")}, {_insert("s0", "user", "assistant")},
                                     {_insert("s1", "user", "assistant")}]) AS t3
                    FROM walk w JOIN steps ON steps.conv_id IS NOT DISTINCT FROM w.conv_id AND steps.n = done + 1))
        ), ended AS (
            SELECT w.conv_id, list_min([s0, s3, {_insert("s2", "assistant")}, {_insert("s1", "user", "assistant")}]) AS best
            FROM walk w JOIN found ON found.conv_id IS NOT DISTINCT FROM w.conv_id AND found.n = done
        )
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
               coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.lines, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
    "op13_line_quality": rf"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
        ), words AS (
            SELECT r, unnest(all_words) AS w, generate_subscripts(all_words, 1) AS i
            FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS all_words FROM docs)
        ), windows AS (
            SELECT r, i, w, lead(w, 1) OVER text_order AS w2, lead(w, 2) OVER text_order AS w3
            FROM words WINDOW text_order AS (PARTITION BY r ORDER BY i)
        ), often AS (
            SELECT r, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY r, w, w2, w3) > 1 AS again
            FROM windows
        ), covered AS (
            SELECT r, again OR coalesce(lag(again, 1) OVER text_order, false)
                      OR coalesce(lag(again, 2) OVER text_order, false) AS inside
            FROM often WINDOW text_order AS (PARTITION BY r ORDER BY i)
        ), word_counts AS (
            SELECT r, count(*) AS n_words, count(*) FILTER (inside) AS n_repeat_words
            FROM covered GROUP BY r
        ), split AS (
            SELECT r, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
            FROM (SELECT r, string_split(text, chr(10)) AS parts FROM docs)
        ), measured AS (
            SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
                   length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
                   len(regexp_extract_all(line, {_sql(lines.SEPARATORS)})) AS separators,
                   row_number() OVER (PARTITION BY r, line ORDER BY i) AS nth
            FROM split
        ), verdicts AS (
            SELECT *,
                   NOT regexp_matches(line, {_sql(lines.SENTENCE_END)})
                   OR 10 * len(regexp_extract_all(line, {_sql(lines.MARKS)})) > 3 * n AS punctuation,
                   separators >= 2 AND n <= 4 * (separators + 1)
                   OR regexp_matches(line, {_sql(lines.MENU)}) AS navigation,
                   n <= {lines.NOTICE_WORDS} AND regexp_matches(line, {_sql(lines.NOTICE)}) AS boilerplate
            FROM measured WHERE n > 0
        ), line_counts AS (
            SELECT r, count(*) AS n_lines, count(*) FILTER (nth > 1) AS n_dup_lines,
                   count(*) FILTER (punctuation) AS punctuation_lines,
                   count(*) FILTER (navigation) AS navigation_lines,
                   count(*) FILTER (boilerplate) AS boilerplate_lines,
                   sum(chars) FILTER (punctuation OR navigation OR boilerplate) AS lost_chars
            FROM verdicts GROUP BY r
        ), counts AS (
            SELECT doc_id, coalesce(n_words, 0) AS n_words,
                   length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(n_lines, 0) AS n_lines,
                   coalesce(punctuation_lines, 0) AS punctuation_lines,
                   coalesce(navigation_lines, 0) AS navigation_lines,
                   coalesce(boilerplate_lines, 0) AS boilerplate_lines,
                   CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars
            FROM docs LEFT JOIN word_counts USING (r) LEFT JOIN line_counts USING (r)
        ), base AS (
            SELECT *, n_words < {lines.MIN_WORDS}
                      OR 100 * n_repeat_words > {lines.MAX_REPEATED} * n_words AS base_failed
            FROM counts
        )
        SELECT *, NOT base_failed AND 100 * lost_chars <= {lines.MAX_LOST} * word_chars AS kept
        FROM base
    """,
}
