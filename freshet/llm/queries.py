"""One query for each operator, over the whole given tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import aligning, ann, blobs, bpe, chats, cws, lbl, lexical, neardup, packing, quality, urls, warc
from freshet.session import configure, shared_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
BATCH_ROWS = "2000"


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)  # texts may be long
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query()
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe.decode(bpe.encode(table(spark, folder, "documents"), tokenizer), tokenizer)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


# The rules of the url filter.
RULES = (
    urls.Rule("net/", "block"),
    urls.Rule("example.net/en/", "allow"),
    urls.Rule("example.com/de/", "block"),
    urls.Rule("org/fr/", "allow"),
)


@query(
    """
    WITH split AS (
        SELECT page_id,
            translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    rules AS (
        SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) r(rule_host, rule_path, said)),
    fitting AS (
        SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS n
        FROM split LEFT JOIN rules
            ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path))
    SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(said, 'allow') AS verdict
    FROM fitting WHERE n = 1
    """
)
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(table(spark, folder, "pages"), list(RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query()
def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = blobs.scan(table(spark, folder, "documents"))

    def kinds(kind: str):
        return F.size(F.filter("hits", lambda h: h["kind"] == kind)).cast("long").alias(f"n_{kind}")

    spans = F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["kind"], h["start"], h["stop"])), ",")
    return found.select(
        "doc_id",
        kinds("assign"),
        kinds("access"),
        kinds("hex"),
        F.sha2(spans.cast("binary"), 256).alias("base_sha256"),
        spans.alias("spans"),
    )


@query(
    """
    WITH digests AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
    coded AS (
        SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(hex, (5 * i + 1)::INT, 5))::BIGINT) AS fives
        FROM digests),
    named AS (
        SELECT page_id, payload_bytes, hex, array_to_string(list_transform(fives, lambda v:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 32768 + 1)::INT, 1)
            || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 1024 % 32 + 1)::INT, 1)
            || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 32 % 32 + 1)::INT, 1)
            || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v % 32 + 1)::INT, 1)), '') AS payload_digest
        FROM coded),
    held AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS holder FROM named)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> holder THEN holder END AS refers_to
    FROM held
    """
)
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    pages = warc.read_archives(spark, path)
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    space = quality.fit(docs, table(spark, folder, "labels").filter(~held_out))
    scored = quality.score(docs.select("doc_id", "text", held_out.alias("held_out")), space)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op4_lbl(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return lbl.score_corpus(docs, docs.filter("NOT held_out")).drop("text")


@query()
def op9_ann(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 50 = 0")).withColumn("rank", F.col("rank").cast("int"))


@query(
    """
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
        FROM words),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets),
    rare AS (SELECT sh FROM shingles GROUP BY sh HAVING count(*) > 1),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS both_have
        FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id < b.doc_id
        WHERE a.sh IN (SELECT sh FROM rare) GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM common WHERE 100 * both_have >= 80 * (na + nb - both_have)
        UNION ALL SELECT b, a FROM common WHERE 100 * both_have >= 80 * (na + nb - both_have)),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM sets
        UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT s.doc_id, len(s.s) AS n_shingles, r.c AS component_id, s.doc_id = r.c AS kept
    FROM sets s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON s.doc_id = r.a
    """
)
def op2_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.linked(table(spark, folder, "documents"), percent=80, width=4)


@query()
def op8_cws(spark: SparkSession, folder: str) -> DataFrame:
    return cws.fingerprint_edits(table(spark, folder, "documents"))


@query()
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    tokenizers = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return aligning.align(table(spark, folder, "documents"), *tokenizers)


@query(
    """
    WITH words AS (
        SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
        FROM documents),
    totals AS (SELECT count(*) FILTER (len(w) > 0) AS nn, sum(len(w))::BIGINT AS ll FROM words),
    asked AS (
        SELECT item_id, term, count(*) AS q FROM (
            SELECT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM benchmark) GROUP BY ALL),
    held AS (
        SELECT d, doc_id, n, term, count(*) AS tf
        FROM (SELECT d, doc_id, len(w) AS n, unnest(w) AS term FROM words)
        WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weighed AS (
        SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT AS weight
        FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals),
    scored AS (
        SELECT item_id, d, doc_id, sum(q * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))))::BIGINT AS score
        FROM asked JOIN held USING (term) JOIN weighed USING (term), totals GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """
)
def op13_dual_tree(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


PROBE = r"\### Assistant: </turn> ok"


@query(
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    long AS (
        SELECT *, CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
            ELSE 21 + length(role) + len(regexp_extract_all(role, signs)) END
            + length(text) + len(regexp_extract_all(text, signs)) + 9 AS chars
        FROM turns, (SELECT '\\|### System:|### User:|### Assistant:|### Role:|### Text:|</turn>' AS signs))
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(chars)::BIGINT AS formatted_chars
    FROM long GROUP BY conv_id
    """
)
def op12_chat(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    return chats.read_back(chats.assembled(turns.union(probe), tokenizer), tokenizer, together=True)
