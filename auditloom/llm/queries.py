"""The registered queries of the training-data operators, and their DuckDB texts."""

from pyspark.sql import functions as F

from auditloom.llm import (
    chat, markov_secrets, mixing, nearest, packing, pii, resample, search, simhash, stream_dedup, token_output, toxicity,
    warc)
from auditloom.llm.common import let_workers_import, table
from auditloom.storage import new_path

TOKENIZER = "word_bpe_49k.json"
QUERY_EVERY = 20     # vec_ids divisible by it are the queries
PLANTED = -7, r"\### Assistant: </turn> ok"     # a conversation whose texts hold control strings


def tokenizer_path(name=TOKENIZER):
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark, sf_dir):
    path = new_path(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_output.token_index(token_output.read_tokens(spark, path))


def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark, sf_dir):
    found = stream_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "keep_id", F.col("group_size").cast("bigint").alias("group_size"), "kept",
        F.col("digest").alias("text_sha256"))


def _count(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op4_secrets(spark, sf_dir):
    found = markov_secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *[_count("spans", k) for k in markov_secrets.KINDS],
        F.sha2(markov_secrets.written(base), 256).alias("base_sha256"),
        markov_secrets.written(F.col("spans")).alias("spans"))


def op5_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_warc(spark, sf_dir):
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc.*", "copy", "shuffle_key")


def op9_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["place"] < pii.BASE_KINDS)
    return found.select(
        "doc_id", *[_count("spans", k) for k in pii.KINDS], F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"))


def op10_nearest(spark, sf_dir):
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


def op11_resample(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_search(spark, sf_dir):
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_chat(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, text = PLANTED
    planted = spark.createDataFrame(
        [(conv_id, 0, "user", text), (conv_id, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    path = chat.write_conversations(given.unionByName(planted))
    return chat.digest_conversations(chat.read_conversations(spark, path))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _ready(query):
    def run(spark, sf_dir):
        let_workers_import(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {q.__name__: _ready(q) for q in (
    op1_token_output, op2_simhash, op3_exact_dedup, op4_secrets, op5_packing, op6_toxicity, op7_warc, op8_mixing,
    op9_pii, op10_nearest, op11_resample, op12_search, op13_chat, pipeline)}

ORACLE = {
    "op3_exact_dedup": """
        WITH rows AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM rows WINDOW same AS (PARTITION BY text_sha256)""",
    "op8_mixing": """
        WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        rates AS (
            SELECT source, sum(n) OVER () * sqrt(n) / sum(sqrt(n)) OVER () / n AS rate FROM counts),
        chances AS (
            SELECT source, rate, 0 AS k, exp(-rate) AS p FROM rates
            UNION ALL
            SELECT source, rate, k + 1, p * rate / (k + 1) FROM chances WHERE k < 60 + 3 * rate),
        steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS below FROM chances),
        drawn AS (
            SELECT d.*, coalesce(cast(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, ''))) AS key,
                cast(('0x' || substr(md5('mix-1|' || key), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
            FROM documents d),
        times AS (
            SELECT d.doc_id, d.key, count(*) AS n FROM drawn d
            JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.below <= d.u GROUP BY ALL)
        SELECT d.* EXCLUDE (key, u), cast(copies.c AS INTEGER) AS copy,
            md5('mix-1|order|' || d.key || '|' || copies.c) AS shuffle_key
        FROM drawn d JOIN times t ON t.key = d.key, LATERAL (SELECT unnest(range(t.n)) AS c) copies""",
    "op10_nearest": """
        WITH rows AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
            FROM rows q JOIN rows c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
        SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
            vec_id, score
        FROM scored QUALIFY rank <= 20""",
    "op11_resample": r"""
        WITH words AS (
            SELECT 'd' AS side, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM documents
            UNION ALL
            SELECT 'b', item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
            FROM benchmark),
        steps AS (
            SELECT list_transform(range(256), lambda b: list_reduce(range(8),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc_of),
        hashed AS (
            SELECT word, xor(4294967295, list_reduce(
                list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT),
                lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1]), 4294967295)) % 10000 AS bucket
            FROM (SELECT DISTINCT word FROM words), steps),
        cells AS (
            SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
            FROM words JOIN hashed USING (word) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000)
                / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)))) AS gain
            FROM cells),
        means AS (
            SELECT doc_id, count(*) AS n_features, floor(sum(gain) / count(*)) AS weight
            FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id),
        scored AS (
            SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                    / 4294967296::DOUBLE))))::BIGINT AS score
            FROM documents d LEFT JOIN means USING (doc_id)),
        placed AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS wanted
            FROM scored WHERE n_features >= 20)
        SELECT s.*, CASE WHEN place <= wanted THEN place END AS rank FROM scored s LEFT JOIN placed USING (doc_id)""",
    "op12_search": r"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        asked AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        tfs AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
        sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
        corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS length FROM sizes),
        lengths AS (SELECT doc_id, 75 + (25 * n * n_docs) // length AS m FROM sizes, corpus),
        weights AS (
            SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
            FROM tfs, corpus GROUP BY term),
        impacts AS (
            SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS impact
            FROM tfs JOIN lengths USING (doc_id) JOIN weights USING (term)),
        scored AS (
            SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL)
        SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
            doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 20""",
    "op13_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) planted(turn, role))
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length('<turn >' || chr(10) || '</turn>' || chr(10))
                + length(replace(replace(replace(role, '\', '\\'), '<', '\<'), '>', '\>'))
                + length(replace(replace(replace(text, '\', '\\'), '</turn', '<\/turn'), '<turn', '<\turn')))::BIGINT
                AS formatted_chars
        FROM turns GROUP BY conv_id""",
}
