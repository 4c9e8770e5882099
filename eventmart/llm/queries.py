"""Queries of the operators in this folder, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import backoff, bytebpe, decontam, langid, mixing, neardup, quality, search, sharding, suffixes, tokens, variants, warc
from eventmart.llm.common import load, prepare


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under a byte-level vocabulary of 50,257 entries."""
    import public_tokenizers

    prepare(spark)
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return tokens.count_tokens(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back."""
    area = prepare(spark)
    warc.write_archive(load(spark, sf_dir, "pages", "page_id", "url", "html"), area.path("warc"))
    pages = area.table(warc.payloads_of(warc.read_records(spark, area.path("warc"))).drop("payload"), "pages")
    broken = warc.broken_revisits(pages).first()
    if broken:
        raise ValueError(f"revisit of page {broken.refers_to} without a response")
    return pages


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the adaptive verdict of every document."""
    area = prepare(spark)
    return quality.quality(load(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"), area)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    prepare(spark)
    docs = load(spark, sf_dir, "documents", "doc_id", "n_chars")
    return sharding.place(docs, sharding.shard_names())


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    prepare(spark)
    return langid.identify(load(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain memberships, rate and copies of every document."""
    area = prepare(spark)
    return mixing.mix(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "labels", "doc_id", "quality", "toxic"), area)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and the benchmark items they hold."""
    area = prepare(spark)
    return decontam.matches(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "item_id", "text"), area)


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return neardup.group(load(spark, sf_dir, "documents", "doc_id", "text"), prepare(spark))


def op4_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under the trigram counts of all others."""
    return backoff.scores(load(spark, sf_dir, "documents", "doc_id", "text"), prepare(spark), order=3)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings found elsewhere cover."""
    return suffixes.removed(load(spark, sf_dir, "documents", "doc_id", "text"), prepare(spark)).drop("kept")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by a vocabulary for many languages, and decoded again."""
    import public_tokenizers

    prepare(spark)
    path = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bytebpe.encode(load(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(bytebpe.little_endian("ids"), 256).alias("ids_sha256"),
        F.sha2(bytebpe.decoder(path)("ids"), 256).alias("decoded_sha256"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with the form it is a variant of."""
    return variants.group_variants(load(spark, sf_dir, "documents", "doc_id", "text"), prepare(spark))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    return search.search(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "item_id", "text"), prepare(spark))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_warc": op2_warc,
    "op6_quality": op6_quality,
    "op8_sharding": op8_sharding,
    "op10_langid": op10_langid,
    "op5_mixing": op5_mixing,
    "op9_decontamination": op9_decontamination,
    "op3_neardup": op3_neardup,
    "op4_backoff": op4_backoff,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_variants": op12_variants,
    "op13_search": op13_search,
}

ORACLES = {
    "op2_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), h AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS holder FROM p
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN holder <> page_id THEN holder END AS refers_to
        FROM h""",
    "op6_quality": """
        WITH w AS (
            SELECT doc_id, lang, source, coalesce(text, '') AS text,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS words
            FROM documents
        ), runs AS (
            SELECT doc_id, p, array_to_string(words[p : p + 7], ' ') AS run
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM w WHERE len(words) >= 8)
        ), seen AS (
            SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs
        ), covered AS (
            SELECT doc_id, count(DISTINCT p + k) AS n_repeat_words
            FROM (SELECT doc_id, p, unnest(range(0, 8)) AS k FROM seen WHERE n > 1) GROUP BY doc_id
        ), lined AS (
            SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
            WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY doc_id
        ), m AS (
            SELECT w.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(n_lines, 0) AS n_lines
            FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lined USING (doc_id)
        ), j AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                   CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbol_rate,
                   CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_line_rate,
                   CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat_rate,
                   CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length
            FROM m
        ), v AS (
            SELECT lang, source, unnest([
                {'rate': 'symbol_rate', 'v': symbol_rate}, {'rate': 'dup_line_rate', 'v': dup_line_rate},
                {'rate': 'repeat_rate', 'v': repeat_rate}, {'rate': 'word_length', 'v': word_length}]) AS x
            FROM j WHERE NOT base_failed
        ), b AS (
            SELECT lang, source, x.rate AS rate,
                   (x.v >> greatest(length(bin(x.v)) - 7, 0)) << greatest(length(bin(x.v)) - 7, 0) AS v FROM v
        ), q AS (
            SELECT lang, source, rate, GROUPING(source) + GROUPING(lang) AS up, count(*) AS n,
                   quantile_disc(v, 0.125) AS e1, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.5) AS q2, quantile_disc(v, 0.75) AS q3
            FROM b GROUP BY GROUPING SETS ((lang, source, rate), (lang, rate), (rate))
        ), l AS (
            SELECT l.lang, l.rate, (l.n * l.e1 + 30 * a.e1) // (l.n + 30) AS e1, (l.n * l.q1 + 30 * a.q1) // (l.n + 30) AS q1,
                   (l.n * l.q2 + 30 * a.q2) // (l.n + 30) AS q2, (l.n * l.q3 + 30 * a.q3) // (l.n + 30) AS q3
            FROM (SELECT * FROM q WHERE up = 1) l JOIN (SELECT * FROM q WHERE up = 2) a ON l.rate = a.rate
        ), g AS (
            SELECT g.lang, g.source, g.rate, (g.n * g.e1 + 30 * l.e1) // (g.n + 30) AS e1, (g.n * g.q1 + 30 * l.q1) // (g.n + 30) AS q1,
                   (g.n * g.q2 + 30 * l.q2) // (g.n + 30) AS q2, (g.n * g.q3 + 30 * l.q3) // (g.n + 30) AS q3,
                   CASE g.rate WHEN 'symbol_rate' THEN 60 WHEN 'dup_line_rate' THEN 300 WHEN 'repeat_rate' THEN 150 ELSE 300 END AS slack
            FROM (SELECT * FROM q WHERE up = 0) g JOIN l ON g.rate = l.rate AND g.lang IS NOT DISTINCT FROM l.lang
        ), s AS (
            SELECT *, q1 + greatest(11 * (q1 - e1), slack) AS high, greatest(6 * least(q3 - q2, q2 - q1), slack) AS spread FROM g
        ), f AS (
            SELECT lang, source, max(high) FILTER (rate = 'symbol_rate') AS s_high,
                   max(high) FILTER (rate = 'dup_line_rate') AS d_high, max(high) FILTER (rate = 'repeat_rate') AS r_high,
                   max(least(q3, q2 + greatest(3 * (q2 - q1), slack)) + spread) FILTER (rate = 'word_length') AS l_high,
                   max(greatest(q1, q2 - greatest(3 * (q3 - q2), slack)) - spread) FILTER (rate = 'word_length') AS l_low
            FROM s GROUP BY lang, source
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND coalesce(symbol_rate <= s_high AND dup_line_rate <= d_high AND repeat_rate <= r_high
                                            AND word_length <= l_high AND word_length >= l_low, false) AS kept
        FROM j LEFT JOIN f ON j.lang IS NOT DISTINCT FROM f.lang AND j.source IS NOT DISTINCT FROM f.source""",
    "op12_variants": r"""
        WITH RECURSIVE bits AS (
            SELECT i, 0 AS k, CAST(i AS BIGINT) AS v FROM range(256) t(i)
            UNION ALL
            SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
        ), crc AS (
            SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8
        ), runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
            FROM documents
        ), counted AS (
            SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run
        ), hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
            FROM counted, crc
        ), words AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
            FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
        ), gaps AS (
            SELECT word, length(word) AS size, p, substr(word, 1, p) || substr(word, p + 2) AS rest FROM words, range(200) r(p) WHERE p < length(word)
        ), pairs AS (
            SELECT a.word AS word, b.word AS near FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.p = b.p AND a.size = b.size AND a.word <> b.word
            UNION SELECT a.word, b.rest FROM words a JOIN gaps b ON a.word = b.word SEMI JOIN words w ON b.rest = w.word
            UNION SELECT b.rest, a.word FROM words a JOIN gaps b ON a.word = b.word SEMI JOIN words w ON b.rest = w.word
        ), ranked AS (
            SELECT p.word, near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, encode(near)) AS place
            FROM pairs p JOIN words v ON p.near = v.word
        ), judged AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
            FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON w.word = r.word
        ), steps AS (
            SELECT word, word AS root, form AS next FROM judged
            UNION ALL
            SELECT s.word, j.word, j.form FROM steps s JOIN judged j ON s.next = j.word
        )
        SELECT j.word, form, s.root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM judged j JOIN steps s ON s.word = j.word AND s.next IS NULL""",
    "op13_search": r"""
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), d AS (
            SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY doc_id
        ), s AS (
            SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d
        ), tf AS (
            SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM t GROUP BY doc_id, term
        ), w AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY term
        ), q AS (
            SELECT item_id, term, count(*) AS k
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY item_id, term
        ), scored AS (
            SELECT item_id, doc_id, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l)))) AS BIGINT) AS score
            FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (doc_id), s GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
        )
        SELECT * FROM ranked WHERE rank <= 20""",
}
