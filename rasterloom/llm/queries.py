"""Queries over the driver's tables, one for each operator, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm import chat, decontam, html_extract, lang_id, ngram_join, packing, quality, secrets, substring_dedup, topk


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = lang_id.fit(docs.where(~lang_id.held_out()).select("doc_id", "text", "lang"))
    found = lang_id.predict(docs, model)
    return found.select("doc_id", lang_id.held_out().alias("held_out"), "lang_pred", "score")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, classes=ngram_join.classes(docs))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]
    extra = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    logs = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_events(chat.as_events(logs)))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_lang_id": op2_lang_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_chat_format": op5_chat_format,
    "op6_decontamination": op6_decontamination,
    "op7_html_extract": op7_html_extract,
    "op8_exact_topk": op8_exact_topk,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality": op10_quality,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_UNITS = "|".join(decontam.UNITS)
_NUM, _NAME, _UNIT = "chr(57344)", "chr(57345)", "chr(57346)"
_SLOT = f"('[' || {_NUM} || {_NAME} || {_UNIT} || ']')"


def _bare_sql(text: str) -> str:
    return rf"string_split(trim(regexp_replace(regexp_replace(lower({text}), '[\p{{P}}\p{{S}}' || chr(1) || ']+', '', 'g'), ' +', ' ', 'g')), ' ')"


_DECONTAMINATION = rf"""
    WITH texts AS (SELECT DISTINCT 'doc' AS kind, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
        UNION SELECT 'item', item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
    spaced AS (SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM texts),
    numbers AS (SELECT *, regexp_replace(s, '[0-9]+([.,:/][0-9]+)*', {_NUM}, 'g') AS n FROM spaced),
    units AS (SELECT *, regexp_replace(regexp_replace(n, {_NUM} || '({_UNITS})\b', {_NUM} || {_UNIT}, 'g'), {_NUM} || ' ({_UNITS})\b', {_NUM} || ' ' || {_UNIT}, 'g') AS u FROM numbers),
    names AS (SELECT *, regexp_replace(regexp_replace(u, '([.!?:]) (\p{{Lu}})', '\1 ' || chr(1) || '\2', 'g'), ' \p{{Lu}}[\p{{Lu}}''’-]*\p{{Ll}}[\p{{L}}''’-]*', ' ' || {_NAME}, 'g') AS t FROM units),
    words AS (SELECT kind, id, {_bare_sql("t")} AS t, {_bare_sql("s")} AS w FROM names),
    wins AS (SELECT kind, id, unnest(range(1, len(t) - 6)) AS p, unnest(list_transform(range(1, len(t) - 6), lambda i: array_to_string(t[i:i+7], ' '))) AS g,
        unnest(list_transform(range(1, len(t) - 6), lambda i: len(list_filter(t[i:i+7], lambda x: regexp_matches(x, {_SLOT}))))) AS slots FROM words WHERE len(t) >= 8),
    items AS (SELECT *, count(*) OVER (PARTITION BY id) AS total FROM wins WHERE kind = 'item' AND slots <= 4),
    hits AS (SELECT d.id AS doc_id, i.id AS item_id, d.p AS dp, i.p AS ip, i.slots, total FROM wins d JOIN items i USING (g) WHERE d.kind = 'doc'),
    pairs AS (SELECT doc_id, item_id, dp - ip AS shift, b.w[ip + k] AS x, a.w[dp + k] AS y FROM hits, range(8) r(k), words a, words b
        WHERE slots > 0 AND a.kind = 'doc' AND a.id = doc_id AND b.kind = 'item' AND b.id = item_id AND regexp_matches(a.t[dp + k], {_SLOT})),
    fine AS (SELECT doc_id, item_id, shift FROM pairs GROUP BY ALL HAVING count(DISTINCT (x, y)) = count(DISTINCT x) AND count(DISTINCT (x, y)) = count(DISTINCT y)),
    good AS (SELECT * FROM hits WHERE slots = 0 OR (doc_id, item_id, dp - ip) IN (SELECT (doc_id, item_id, shift) FROM fine))
    SELECT doc_id, item_id, count(DISTINCT ip) AS n_matched, max(total) AS n_windows FROM good GROUP BY doc_id, item_id HAVING count(DISTINCT ip) >= least(6, max(total))"""

ORACLE: dict[str, str] = {
    "op6_decontamination": _DECONTAMINATION,
    "op1_ngram_join": rf"""
        WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b, c, x.n AS na, y.n AS nb FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c)),
        reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
        class AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id),
        copy AS (SELECT a AS doc_id, min(b) AS o FROM links WHERE c = na AND c = nb GROUP BY a),
        n AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
        SELECT doc_id, class_id, least(doc_id, coalesce(o, doc_id)) AS copy_of, coalesce(n, 0) AS n_links
        FROM class LEFT JOIN copy USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op3_substring_dedup": rf"""
        WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        wins AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i+12], ' '))) AS g
                 FROM words WHERE len(w) >= 13),
        firsts AS (SELECT g, min(doc_id) AS lo FROM wins GROUP BY g),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM wins JOIN firsts USING (g) WHERE doc_id > lo),
        cut AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
               sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, j: NOT list_contains(ps, j)) END, ' '), '')) AS kept_sha256
        FROM words LEFT JOIN cut USING (doc_id)""",
    "op5_chat_format": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        sized AS (
            SELECT *, length(regexp_replace(text, '(\\|</?s>|\[/?INST\]|\[/ROLE\])', '\1.', 'g')) AS n,
                   length(regexp_replace(role, '(\\|</?s>|\[/?INST\]|\[/ROLE\])', '\1.', 'g')) AS m FROM rows)
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(n + CASE WHEN role = 'assistant' THEN 7 ELSE m + 20 END)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op8_exact_topk": r"""
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
}
