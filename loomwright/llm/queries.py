"""The thin queries over the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.llm.alignment import align_tokens
from loomwright.llm.exact_dedup import mark_duplicates
from loomwright.llm.fingerprints import compare_edited
from loomwright.llm.lexical_search import search
from loomwright.llm.ngram_join import jaccard_classes
from loomwright.llm.packing import pack_documents
from loomwright.llm.page_language import identify
from loomwright.llm.piece_codec import encode_texts
from loomwright.llm.repeats import remove_repeats
from loomwright.llm.resampling import resample
from loomwright.llm.secret_scan import find_secrets, n_of, span_list
from loomwright.llm.token_counts import count_tokens
from loomwright.llm.toxicity import score_toxicity


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_texts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.concat_ws(" ", F.col("ids").cast("array<string>")), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_duplicates(documents(spark, sf_dir)).drop("rid")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir)).drop("rid")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare_edited(documents(spark, sf_dir))
    return found.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(documents(spark, sf_dir))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cleaned.select("doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), documents(spark, sf_dir))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), with_ids=False)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))
    counts = (n_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex"))
    return found.select("doc_id", *counts, F.sha2(F.encode(span_list(F.col("spans"), base=True), "UTF-8"), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_piece_codec": op1_piece_codec,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_fingerprints": op5_fingerprints,
    "op6_token_counts": op6_token_counts,
    "op7_importance_resampling": op7_importance_resampling,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_page_language": op9_page_language,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_secret_scan": op11_secret_scan,
    "op12_token_alignment": op12_token_alignment,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op4_ngram_jaccard": """
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
        t AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
        p AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
        c(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT c.doc_id, p.b FROM c JOIN p ON p.a = c.root)
        SELECT doc_id, min(root) AS class_id, (SELECT count(*) FROM p WHERE p.a = c.doc_id) AS n_links FROM c GROUP BY doc_id
    """,
    "op13_lexical_search": """
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        len AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
        world AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM len),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        scored AS (
            SELECT item_id, doc_id, sum(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
                * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))))::BIGINT AS score
            FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN len USING (doc_id), world GROUP BY ALL),
        ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
}
