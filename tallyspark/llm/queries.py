"""The named queries of these operators, and their SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (
    decontamination,
    filter_audit,
    fixity,
    importance,
    infilling,
    language_id,
    line_dedup,
    near_duplicates,
    pieces,
    sharding,
    top_k,
    toxicity,
    url_filter,
)
from tallyspark.llm.common import crc_of_id, in_remainder, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLE_SQL[run.__name__] = sql
        return run

    return add


# ASCII lower case and the words of op10, in DuckDB.
_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS}, []) AS w FROM documents),
    b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    pattern AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS p
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    place AS (
        SELECT r, n, i, list_slice(w, i, i + n - 1) AS p
        FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i
              FROM d, (SELECT DISTINCT n FROM pattern) WHERE len(w) >= n)),
    hit AS (SELECT r, i, place.n, item_id FROM place JOIN pattern ON place.n = pattern.n AND place.p = pattern.p),
    word AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
    item AS (
        SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)
    """
)
def op10_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        decontamination.items_digest("items").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op2_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"), keep_text=False)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op9_simhash_golay(spark, sf_dir):
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", near_duplicates.hex_of("fingerprint"))


@query()
def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = language_id.learn(docs, F.coalesce(crc_of_id("doc_id") % 4 != 2, F.lit(False)))
    found = language_id.identify(docs.select("doc_id", "text"), filters, keep_text=False)
    return found.withColumn("held_out", in_remainder("doc_id", 4, 2))


@query()
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    allowed = F.coalesce(crc_of_id("doc_id") % 3 != 1, F.lit(False))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), allowed)
    return toxicity.score(docs, model, keep_text=False).withColumn("held_out", in_remainder("doc_id", 3, 1))


@query()
def op8_hilbert_sharding(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"))


# The rules of the url filter.
URL_RULES = [
    url_filter.rule("allow", "com/"),
    url_filter.rule("block", "example.com/en/"),
    url_filter.rule("allow", "www.example.com/en/"),
    url_filter.rule("block", "net/es/"),
    url_filter.rule("block", "net/fr/"),
]


@query()
def op4_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).drop("url")


@query(
    """
    WITH v AS (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    p AS (
        SELECT a.vec_id AS query_id, a.r AS own, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
    r AS (
        SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id NULLS LAST) AS n FROM p)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
    """
)
def op7_top_k(spark, sf_dir):
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query(
    r"""
    WITH r AS (
        SELECT page_id, url, page_id // 1000 AS file,
            concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:page:',
                page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10),
                'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', strlen(coalesce(html, '')),
                chr(13), chr(10), chr(13), chr(10), coalesce(html, ''), chr(13), chr(10), chr(13), chr(10)) AS record
        FROM pages),
    a AS (
        SELECT *, strlen(record) AS n, CASE page_id % 97 WHEN 0 THEN 'w' || substr(record, 2)
            WHEN 1 THEN left(record, CAST(length(record) // 2 AS BIGINT)) ELSE record END AS copy FROM r),
    o AS (
        SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY file ORDER BY page_id, url
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM a)
    SELECT file, start AS "offset", page_id, CASE WHEN page_id % 97 < 2 THEN 'changed' ELSE 'missing' END AS status,
        n AS primary_length, CASE WHEN page_id % 97 < 2 THEN strlen(copy) END AS replica_length,
        sha256(record) AS primary_digest, CASE WHEN page_id % 97 < 2 THEN sha256(copy) END AS replica_digest
    FROM o WHERE page_id % 97 < 4
    UNION ALL
    SELECT file, start + 1, page_id, 'extra', NULL, strlen(copy), NULL, sha256(copy) FROM o WHERE page_id % 97 = 3
    """
)
def op1_warc_fixity(spark, sf_dir):
    """Audit of the archive of all pages against a replica with known damage:
    by the remainder of the page id a letter changed, a record cut to half,
    lost, or shifted by one byte."""
    pages = table(spark, sf_dir, "pages")
    record = fixity.response_record(F.col("url"), F.col("html"), F.col("page_id"))
    fault = F.col("page_id") % 97
    damaged = (
        F.when(fault == 0, F.concat(F.lit("w"), F.expr("substring(record, 2)")))
        .when(fault == 1, F.expr("left(record, CAST(floor(length(record) / 2) AS INT))"))
        .otherwise(F.col("record"))
    )
    # Texts are hashed here, once for both replicas; from here on rows are slim.
    slim = (
        pages.select("page_id", "url", record.alias("record"))
        .withColumn("copy", damaged)
        .select(
            "page_id",
            "url",
            F.floor(F.col("page_id") / fixity.RECORDS_PER_FILE).alias("file"),
            F.octet_length("record").cast("bigint").alias("length"),
            F.sha2(F.col("record").cast("binary"), 256).alias("digest"),
            F.octet_length("copy").cast("bigint").alias("copy_length"),
            F.sha2(F.col("copy").cast("binary"), 256).alias("copy_digest"),
        )
    )
    archive = written(fixity.placed(slim, "file", ["page_id", "url"]), "archive")
    replica = archive.filter(F.coalesce(fault != 2, F.lit(True))).select(
        "file",
        (F.col("offset") + F.when(fault == 3, 1).otherwise(0)).alias("offset"),
        F.col("copy_length").alias("length"),
        F.col("copy_digest").alias("digest"),
        "page_id",
    )
    return fixity.audit(archive, replica, "page_id")


@query()
def op5_importance(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "labels"))


# The first four groups of eight digits of a hash, as numbers, in DuckDB.
_DRAWS = ", ".join(f"CAST('0x' || substr(s, {1 + 8 * i}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))


@query(
    rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
            sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s
        FROM documents),
    h AS (SELECT *, CAST(len(u) AS BIGINT) AS n, {_DRAWS} FROM d),
    c AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM h),
    p AS (
        SELECT *, array_to_string(list_slice(u, 1, a), '') AS prefix, array_to_string(list_slice(u, a + 1, b), '') AS middle,
            array_to_string(list_slice(u, b + 1, n), '') AS suffix
        FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM p
    """
)
def op11_infilling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = infilling.restore(infilling.transform(docs, keep_text=False))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


@query(
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS doc,
            string_split(coalesce(text, ''), chr(10)) AS lines
        FROM documents),
    l AS (SELECT r, doc, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
    k AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM l),
    c AS (
        SELECT key, max(doc) AS keeper FROM k WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc) >= 3),
    m AS (SELECT r, pos, line, keeper IS NOT NULL AND doc <> keeper AS gone FROM k LEFT JOIN c USING (key))
    SELECT doc_id, CAST(any_value(len(lines)) AS BIGINT) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM m JOIN d USING (r) GROUP BY r, doc_id
    """
)
def op12_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.without_repeated_lines(docs, line_dedup.keep_bitmaps(docs))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


@query(
    r"""
    WITH w AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words
        FROM documents),
    e AS (SELECT t, min(doc_id) AS first FROM w GROUP BY t),
    g AS (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
        FROM labels GROUP BY doc_id),
    f AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
            concat(CASE WHEN len(words) < 200 THEN 'A' END,
                CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
                CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
                CASE WHEN doc_id > first THEN 'E' END) AS fails
        FROM w LEFT JOIN g USING (doc_id) JOIN e USING (t)),
    n AS (SELECT part, good, bad, fails, count(*) AS n FROM f GROUP BY ALL),
    x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s AS (
        SELECT part, filter_order, step, letter, n, good, bad, fails, contains(fails, letter) AS failed,
            len(list_filter(string_split(left(filter_order, step - 1), ''), lambda z: z <> '' AND contains(fails, z))) > 0 AS gone
        FROM (SELECT filter_order, step, substr(filter_order, step, 1) AS letter
              FROM o, (SELECT unnest(range(1, 6)) AS step)), n),
    r AS (
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, any_value(letter) AS letter,
            coalesce(sum(n) FILTER (NOT failed AND NOT gone), 0) AS kept,
            coalesce(sum(n) FILTER (failed AND NOT gone), 0) AS removed,
            coalesce(sum(n) FILTER (failed AND gone), 0) AS redundant,
            coalesce(sum(n) FILTER (fails = letter), 0) AS unique_fails,
            coalesce(sum(n) FILTER (failed AND NOT gone AND good = 1), 0) AS good_lost,
            coalesce(sum(n) FILTER (failed AND NOT gone AND bad = 1), 0) AS toxic_lost
        FROM s GROUP BY part, filter_order, step)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
        CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
        CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM r
    """
)
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
