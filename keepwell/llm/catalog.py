"""The registered queries of the operators, and the SQL of those that DuckDB can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.llm import (
    ball_search, bpe, classifier, collocations, line_dedup, minhash, mixing, packing, quality_rules, sharding, simhash, token_counts,
    warc,
)

QUERIES = {}
ORACLE = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


@_query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


@_query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, folder, "documents", "doc_id", "text"), ["doc_id"])
    return judged.drop("rejected_by")


@_query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.draws(_table(spark, folder, "documents", "doc_id", "text", "source"), repetition_limit=1.5)


@_query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), 4096)


@_query
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents", "doc_id", "text"), 8)


@_query
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    automaton = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.round_trip(_table(spark, folder, "documents", "doc_id", "text"), automaton, "doc_id")


@_query
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text", "source", "lang")
    labels = _table(spark, folder, "labels", "doc_id", "quality")
    found = classifier.classify(docs, labels, F.col("source"), F.col("lang"))
    numbers = ("score", "host_posterior", "path_posterior", "quality")
    return found.withColumns({c: F.round(c, 6) for c in numbers})


@_query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(_table(spark, folder, "documents", "doc_id", "text"))
    return kept.select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


@_query
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.fingerprints_with_edits(_table(spark, folder, "documents", "doc_id", "text"))
    shown = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(shown)


@_query
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.archive(spark, _table(spark, folder, "pages", "page_id", "url", "html"), min_bytes=0)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op11_ball_search(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = _table(spark, folder, "documents", "doc_id", "text"), _table(spark, folder, "benchmark", "item_id", "text")
    return ball_search.search(docs, items, top=10)


@_query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents", "text", "lang"), min_count=10, top=2000)


@_query
def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=1024, end_id=0)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


_STRIP = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op8_line_dedup"] = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT r, doc_id, i, lines[i] AS line, {_LOWER.format(f"trim(lines[i], {_STRIP})")} AS key
    FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)
), common AS (
    SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), marked AS (
    SELECT r, doc_id, i, line, key IN (SELECT key FROM common) AS gone FROM lines
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE["op2_quality_rules"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), windows AS (
    SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM docs)
), repeated AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1
), covered AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM repeated) GROUP BY r
), lines AS (
    SELECT r, count(line) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS worded,
           count(DISTINCT line) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS different, count(*) AS n
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) GROUP BY r
), base AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, worded - different AS n_dup_lines,
           coalesce(c.n, 0) AS n_repeat_words, l.n AS n_lines,
           length(regexp_replace(text, '[^!]+', '', 'g')) AS n_shouts,
           length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_capitals,
           length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS n_letters,
           len(list_filter(words, lambda w: NOT regexp_matches(w, '\p{{L}}'))) AS n_wordless
    FROM docs JOIN lines l USING (r) LEFT JOIN covered c USING (r)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > 3 * n_words
            OR 10 * n_dup_lines > 5 * n_lines OR 10 * n_shouts > 5 * n_words OR 10 * n_capitals > 5 * word_chars
            OR 10 * n_letters < 5 * word_chars OR 10 * n_wordless > 4 * n_words) AS kept
FROM judged
"""

ORACLE["op10_warc"] = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, unhex(sha1(payload))::BIT::VARCHAR AS bits FROM payloads
), named AS (
    SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda k: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda b:
            CASE WHEN substr(bits, (5 * k + b + 1)::INT, 1) = '1' THEN (16 >> b::INT) ELSE 0 END))::INT, 1
    )), 'string_agg', '') AS payload_digest
    FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER (PARTITION BY payload_digest) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER (PARTITION BY payload_digest)
            THEN min(page_id) OVER (PARTITION BY payload_digest) END AS refers_to
FROM named
"""

ORACLE["op3_mixing"] = rf"""
WITH RECURSIVE measured AS (
    SELECT doc_id, source, greatest(len({_WORDS}), 1)::BIGINT AS tokens, md5(coalesce(text, '')) AS content FROM documents
), sources AS (
    SELECT source, sum(tokens)::BIGINT AS pass, sum(tokens) / (SELECT sum(tokens) FROM measured)::DOUBLE AS share
    FROM measured GROUP BY source
), ends AS (
    SELECT min(share) AS small, max(share) AS large FROM sources
), halving(step, low, high) AS (
    SELECT 0, 0::DOUBLE, CASE WHEN 1 / small <= 1.5 / large THEN 0 ELSE 1 END::DOUBLE FROM ends
    UNION ALL
    SELECT step + 1, CASE WHEN fits THEN low ELSE middle END, CASE WHEN fits THEN middle ELSE high END
    FROM (SELECT *, pow(small, middle) / small <= 1.5 * (pow(large, middle) / large) AS fits
          FROM (SELECT *, (low + high) / 2 AS middle FROM halving, ends WHERE step < 20))
), powers AS (
    SELECT source, pass, pow(share, (SELECT high FROM halving WHERE step = 20)) / share AS power FROM sources
), budgets AS (
    SELECT source, pass, round(power / (SELECT min(power) FROM powers) * pass)::BIGINT AS budget FROM powers
), planned AS (
    SELECT source, pass, budget, budget // pass AS epochs, budget % pass AS rest,
           round(budget / (SELECT sum(budget) FROM budgets)::DOUBLE, 9) AS weight,
           greatest(ceil((SELECT sum(budget) FROM budgets) / 65536), 1)::BIGINT AS blocks
    FROM budgets
), epochs AS (
    SELECT *, unnest(range(epochs + 1)) AS epoch FROM planned
), passes AS (
    SELECT doc_id, source, tokens, weight, budget, blocks, pass, epoch, epoch = epochs AS ending, rest,
           md5('17:' || epoch || ':' || coalesce(doc_id::VARCHAR, 'none') || ':' || content) AS key
    FROM measured JOIN epochs USING (source)
), ranked AS (
    SELECT *, coalesce(sum(tokens) OVER (
        PARTITION BY source, epoch ORDER BY key, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM passes
), drawn AS (
    SELECT *, least(floor((epoch * pass + before)::BIGINT / budget * blocks), blocks - 1)::BIGINT AS block
    FROM ranked WHERE NOT ending OR before < rest
)
SELECT doc_id, source, tokens, weight, epoch::BIGINT AS epoch, block,
       row_number() OVER (PARTITION BY block ORDER BY md5(key || ':' || source), tokens, doc_id) - 1 AS place
FROM drawn
"""

_TERMS = rf"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE["op11_ball_search"] = f"""
WITH texts AS (
    SELECT row_number() OVER () AS d, doc_id,
           {_TERMS} AS terms
    FROM documents
), lengths AS (
    SELECT d, doc_id, len(terms)::BIGINT AS n FROM texts WHERE len(terms) > 0
), totals AS (
    SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM lengths
), frequencies AS (
    SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM texts) GROUP BY d, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM frequencies, totals GROUP BY term, all_docs
), asked AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (SELECT row_number() OVER () AS item, item_id,
                 unnest({_TERMS}) AS term
          FROM benchmark)
    GROUP BY item, item_id, term
), scored AS (
    SELECT item, item_id, doc_id, d,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN frequencies USING (term) JOIN lengths USING (d), totals
    GROUP BY item, item_id, doc_id, d
), ranked AS (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE["op12_collocations"] = rf"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)
), places AS (
    SELECT lang, unnest(words) AS x, unnest(words[2:]) AS y, unnest(words[3:]) AS z FROM pieces
), one AS (
    SELECT lang, x, count(*) AS f FROM places WHERE x IS NOT NULL GROUP BY lang, x
), two AS (
    SELECT lang, x, y, count(*) AS f FROM places WHERE y IS NOT NULL GROUP BY lang, x, y
), three AS (
    SELECT lang, x, y, z, count(*) AS f FROM places WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= 10
), cuts AS (
    SELECT c.lang, c.x || ' ' || c.y AS phrase, c.f AS a, 1 AS k, p.f AS l, q.f AS r
    FROM two c JOIN one p ON p.lang = c.lang AND p.x = c.x JOIN one q ON q.lang = c.lang AND q.x = c.y
    WHERE c.f >= 10 AND NOT EXISTS (SELECT 1 FROM three o WHERE o.lang = c.lang AND o.x = c.x AND o.y = c.y AND 100 * o.f >= 50 * c.f)
      AND NOT EXISTS (SELECT 1 FROM three o WHERE o.lang = c.lang AND o.y = c.x AND o.z = c.y AND 100 * o.f >= 50 * c.f)
    UNION ALL
    SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 1, p.f, q.f
    FROM three c JOIN one p ON p.lang = c.lang AND p.x = c.x JOIN two q ON q.lang = c.lang AND q.x = c.y AND q.y = c.z
    UNION ALL
    SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 2, p.f, q.f
    FROM three c JOIN two p ON p.lang = c.lang AND p.x = c.x AND p.y = c.y JOIN one q ON q.lang = c.lang AND q.x = c.z
), scored AS (
    SELECT *, (1000000 * a::HUGEINT * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT lang, phrase, a, l, r, score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank
    FROM lowest
)
SELECT lang, rank, phrase, a, l, r, (SELECT sum(f)::BIGINT FROM one WHERE one.lang = ranked.lang) AS n, score
FROM ranked WHERE rank <= 2000
"""
