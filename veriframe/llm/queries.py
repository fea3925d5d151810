"""The registered queries of the operators, their SQL where there is one, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.llm import alignment, byte_bpe, decontaminate, language_id, lexical, line_dedup, masked_lm, pii, quality, simhash, topk, toxicity, warc
from veriframe.llm.shared import stored
from veriframe.sources.workspace import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(function):
        QUERIES[key] = function
        if sql:
            SQL[key] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_line_dedup", """
    WITH l AS (SELECT doc_id, line, no FROM (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no
            FROM documents WHERE text IS NOT NULL)),
    w AS (SELECT doc_id, no, line, list_filter(regexp_split_to_array(line, '[ \\t\\r\\f\\x0B]+'), lambda x: x <> '') AS words FROM l),
    u AS (SELECT words, min(doc_id::HUGEINT * 4294967296 + no) AS place FROM w WHERE len(words) > 0 GROUP BY words),
    g AS (SELECT place, words, unnest(range(0, len(words) + 1)) AS gap FROM u WHERE len(words) >= 5),
    v AS (SELECT place, gap, CASE WHEN gap = 0 THEN words ELSE list_concat(words[1:gap - 1], words[gap + 1:]) END AS key FROM g),
    least AS (SELECT key, gap, min(place) AS place FROM v GROUP BY key, gap),
    near AS (
        SELECT v.place FROM v JOIN least o ON v.key = o.key AND v.gap = o.gap AND v.gap > 0 AND o.place < v.place
        UNION SELECT v.place FROM v JOIN least o ON v.key = o.key AND v.gap = 0 AND o.gap > 0 AND o.place < v.place
        UNION SELECT v.place FROM v JOIN least o ON v.key = o.key AND v.gap > 0 AND o.gap = 0 AND o.place < v.place),
    stay AS (SELECT place FROM u WHERE place NOT IN (SELECT place FROM near)),
    marked AS (SELECT w.*, stay.place IS NOT NULL AS stays FROM w LEFT JOIN stay ON w.doc_id::HUGEINT * 4294967296 + w.no = stay.place),
    d AS (SELECT doc_id, count(*) FILTER (len(words) > 0) AS n_lines, count(*) FILTER (stays) AS n_kept,
                 coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (stays OR len(words) = 0), '') AS rest FROM marked GROUP BY doc_id)
    SELECT documents.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_kept, 0)::BIGINT AS n_kept,
           CASE WHEN text IS NOT NULL THEN sha256(CASE WHEN n_lines > 0 AND n_kept = 0 THEN '' ELSE rest END) END AS text_sha256
    FROM documents LEFT JOIN d ON documents.doc_id = d.doc_id""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that earlier lines repeat, its text as a digest."""
    left = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), counts=("n_lines", "n_kept"))
    return left.select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("text_sha256"))


@query("op2_language_id")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text, learnt from two thirds of the rows."""
    docs = table(spark, folder, "documents")
    model = language_id.fit(language_id.sample(docs.where(remainder("doc_id", 3) != 1)))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op3_byte_bpe")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every text as digests."""
    return bpe_digests(table(spark, folder, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    encoded = byte_bpe.encode(
        docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded="decoded")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_pii")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every text, counted and listed with its scores."""
    found = pii.find_pii(table(spark, folder, "documents").select("doc_id", "text"))
    listed = F.lit(list(pii.BASE))
    base = F.filter("pii", lambda s: F.array_contains(listed, s["kind"]))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[F.size(F.expr(f"filter(pii, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"),
        F.array_join(F.col("pii.score").cast("array<string>"), ",").alias("scores"))


@query("op5_topk", """
    WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best rows for every hundredth vector."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


@query("op6_masked_lm")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Pseudo-likelihood of every text under a model of all texts."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return masked_lm.score(docs, masked_lm.train(docs, spread=["doc_id"]), carry=False).select(
        "doc_id", "n_words", "log_prob", F.expr("if(n_words > 0, exp(-log_prob / n_words), null)").alias("perplexity"))


@query("op7_decontamination")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, and where."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from three quarters of the labels."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxic_model(spark, folder))
    return scored.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def remainder(column: str, by: int):
    """crc32 of the number as text, modulo; null without a number."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


def toxic_model(spark: SparkSession, folder: str):
    fold = remainder("doc_id", 4) != 2
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.train(docs.select("doc_id", "text").where(fold), labels.select("doc_id", "toxic").where(fold))


@query("op9_simhash")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op10_warc", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    d AS (SELECT page_id, payload, strlen(payload) AS payload_bytes, min(page_id) OVER (PARTITION BY payload) AS first FROM p),
    h AS (SELECT *, sha1(payload) AS hex FROM d),
    b AS (SELECT *, list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + CAST((('0x' || substr(hex, 10 * CAST(k // 8 AS INTEGER) + 1, 10))::BIGINT >> CAST(35 - 5 * (k % 8) AS INTEGER)) & 31 AS INTEGER), 1)) AS letters FROM h)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, array_to_string(letters, '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
    FROM b""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back."""
    path = work_dir(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    pages = stored(warc.read_archives(spark, path).withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload"), "read")
    return warc.resolved(pages)


_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_lexical_search", f"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS terms FROM documents WHERE text IS NOT NULL),
    s AS (SELECT count(*)::BIGINT AS nn, sum(len(terms))::BIGINT AS ll FROM d WHERE len(terms) > 0),
    i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
    p AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY doc_id, term),
    w AS (SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, nn),
    m AS (SELECT doc_id, 10 + (90 * len(terms)::BIGINT * nn) // ll AS m FROM d, s WHERE len(terms) > 0),
    r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
          FROM i JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
    k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical.search(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"), 10)


@query("op12_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """How two tokenizers cut every text, and how common the pairs are that they make."""
    found = alignment.align(
        table(spark, folder, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


_GRADES = {
    "symbols": "1000 * n_symbols // greatest(1, n_words) // 10",
    "short_words": "(1000 - 100 * word_chars // greatest(1, n_words)) // 10",
    "long_words": "(100 * word_chars // greatest(1, n_words) - 400) // 10",
    "repeated_lines": "1000 * n_dup_lines // greatest(1, n_lines) // 10",
    "repeated_words": "1000 * n_repeat_words // greatest(1, n_words) // 10",
}


@query("op13_quality", f"""
    WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
    a AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
    g AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, words[k], words[k + 1], words[k + 2]) AS times
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS k FROM a)),
    c AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS place FROM g WHERE times > 1) GROUP BY doc_id),
    m AS (SELECT a.doc_id, lang, text, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                 (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                 coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines FROM a LEFT JOIN c ON a.doc_id = c.doc_id),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
    l AS (SELECT doc_id, min(quality = 1) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
    h AS (SELECT lang, text, min(good) AS good, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols,
                 any_value(n_dup_lines) AS n_dup_lines, any_value(n_repeat_words) AS n_repeat_words, any_value(n_lines) AS n_lines
          FROM b JOIN l ON b.doc_id = l.doc_id WHERE NOT base_failed GROUP BY lang, text),
    e AS ({" UNION ALL ".join(f"SELECT lang, good, '{rule}' AS rule, greatest(0, least(200, {sql})) AS grade FROM h" for rule, sql in _GRADES.items())}),
    n AS (SELECT lang, count(*) FILTER (good) AS n FROM h GROUP BY lang),
    k AS (SELECT lang, n, unnest(range(0, floor(n * 0.01)::BIGINT + 1)) AS k FROM n),
    t AS (SELECT lang, k, sum(exp(lgamma(n + 1) - CASE WHEN k > 0 THEN lgamma(k + 1) ELSE 0 END - lgamma(n - k + 1) + k * ln(0.01) + (n - k) * ln(0.99)))
                 OVER (PARTITION BY lang ORDER BY k) AS tail FROM k WHERE n > 0),
    x AS (SELECT lang, max(k) AS most FROM t WHERE tail <= 0.05 / (5 * (SELECT count(*) FROM n)) GROUP BY lang),
    u AS (SELECT e.lang, e.rule, e.grade, (SELECT count(*) FILTER (o.good) FROM e o WHERE o.lang IS NOT DISTINCT FROM e.lang AND o.rule = e.rule AND o.grade >= e.grade) AS good,
                 (SELECT count(*) FILTER (NOT o.good) FROM e o WHERE o.lang IS NOT DISTINCT FROM e.lang AND o.rule = e.rule AND o.grade >= e.grade) AS bad
          FROM (SELECT DISTINCT lang, rule, grade FROM e WHERE grade > 0) e),
    best AS (SELECT u.lang, rule, max({{'gain': bad - good, 'grade': grade}}).grade AS cut
             FROM u JOIN x ON u.lang IS NOT DISTINCT FROM x.lang WHERE good <= most AND bad > good GROUP BY u.lang, rule),
    v AS ({" UNION ALL ".join(f"SELECT doc_id FROM b JOIN best ON b.lang IS NOT DISTINCT FROM best.lang AND rule = '{rule}' WHERE greatest(0, least(200, {sql})) >= cut" for rule, sql in _GRADES.items())})
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM v) AS kept FROM b""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of every document and whether it stays, by cutoffs learnt from the quality labels of each language."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return quality.keep_good(docs, table(spark, folder, "labels")).select(
        "row.doc_id", *[m for m in quality.MEASURES if m != "n_lines"], "base_failed", "kept")
