"""The operators as named queries over the whole test tables, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from telmart.llm import alignment, chat, decontaminate, exact, jaccard, katz, neighbours, pieces, quality, suffixes, tokenfiles, warc, whitening
from telmart.llm.shared import remainder, table, vocabulary
from telmart.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(table(spark, sf_dir, "documents"), jaccard.Rule(words=4, percent=85)).drop("first")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encode_texts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return rows.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    manifest = tokenfiles.write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"))
    rows = tokenfiles.read_tokens(spark, manifest, folder)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_copies(table(spark, sf_dir, "documents"))


def op6_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles are learned from the conversations with crc32(conv_id) % 10 > 0."""
    conversations = table(spark, sf_dir, "conversations")
    model = chat.train(conversations.where(remainder(F.col("conv_id"), 10) != 0))
    return chat.canonical_turns(conversations, model).select(
        "conv_id", "turn", "segment", "role", (remainder(F.col("conv_id"), 10) == 0).alias("held_out"), "rendered"
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(documents, labels.where(remainder(F.col("doc_id"), 3) != 1))
    return quality.score(documents, model).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted"
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "bundles")
    bundles = warc.write_bundles(table(spark, sf_dir, "pages"), folder)
    return warc.read_bundles(spark, bundles, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), order=3)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_tokens(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    )


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 20."""
    embeddings = table(spark, sf_dir, "embeddings")
    index = neighbours.build(embeddings)
    nearest = neighbours.search(index, embeddings.where(F.col("vec_id") % 20 == 0), 20)
    index.remove()
    return nearest


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    named = (
        op1_decontamination, op2_ngram_jaccard, op3_sentencepiece, op4_token_files, op5_exact_dedup, op6_chat_turns, op7_quality, op8_warc,
        op9_katz, op10_suffix_dedup, op11_alignment, op12_neighbours, op13_whitening,
    )
    return {query.__name__: query for query in named}


def _shingle_sql(table_name: str, key: str, n: int) -> str:
    """The different n-word shingles of each row of a table."""
    return rf"""
    SELECT {key}, unnest(list_distinct(CASE
        WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END)) AS shingle
    FROM (
        SELECT {key}, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM {table_name})"""


CONTAINED_SQL = f"""
WITH d AS ({_shingle_sql("documents", "doc_id", 5)}), i AS ({_shingle_sql("benchmark", "item_id", 5)}),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_shingles) AS n_shingles
FROM d JOIN i USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING 5 * count(*) >= 4 * any_value(n_shingles)"""

JACCARD_SQL = f"""
WITH RECURSIVE s AS ({_shingle_sql("documents", "doc_id", 4)}),
sizes AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM s AS x JOIN s AS y USING (shingle)
    JOIN sizes AS p ON p.doc_id = x.doc_id JOIN sizes AS q ON q.doc_id = y.doc_id
    WHERE x.doc_id <> y.doc_id
        AND 100 * p.n_shingles >= 85 * q.n_shingles AND 100 * q.n_shingles >= 85 * p.n_shingles
    GROUP BY x.doc_id, y.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(p.n_shingles) + any_value(q.n_shingles) - count(*))),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
degrees AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(any_value(n_shingles), 0) AS n_shingles, min(b) AS component_id,
    coalesce(any_value(n_links), 0) AS n_links
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN degrees USING (doc_id) JOIN reach ON reach.a = doc_id
GROUP BY doc_id"""

EXACT_SQL = r"""
WITH normal AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents
)
SELECT doc_id,
    min(doc_id) OVER same AS keep_id,
    count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept,
    sha256(content) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY content)"""

WARC_SQL = """
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), first AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
    FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    nullif(first, page_id) AS refers_to
FROM first"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": CONTAINED_SQL, "op2_ngram_jaccard": JACCARD_SQL, "op5_exact_dedup": EXACT_SQL, "op8_warc": WARC_SQL}
