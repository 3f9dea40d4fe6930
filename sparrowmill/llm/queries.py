"""The published queries of the subpackage: each runs its operator over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.llm import (
    byte_bpe,
    conversation_trie,
    fingerprints,
    jaccard_join,
    license_scan,
    line_dedup,
    packing,
    quality,
    secret_scan,
    sharding,
    token_alignment,
    topk_search,
    url_filters,
)
from sparrowmill.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The rules that op7 judges by, as (verdict, host, path).
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def vocabulary(name: str) -> str:
    """A file of the tokenizers that the executors have installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


@query(
    "op1_line_dedup",
    r"""
    WITH lines AS (
        SELECT doc_id, i, parts[i] AS line,
            translate(regexp_replace(parts[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
        FROM (
            SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
        )
    ), shared AS (
        SELECT line_key, max(doc_id) AS keeper FROM lines WHERE length(line_key) >= 40
        GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5
    ), marked AS (
        SELECT lines.*, coalesce(keeper <> doc_id, false) AS gone
        FROM lines LEFT JOIN shared USING (line_key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), ''))
            AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    )


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_hilbert_shards")
def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=40, law="rows")
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7
    )


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, size=2048, with_ids=False)


@query(
    "op6_exact_topk",
    """
    WITH vectors AS (
        SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
        WHERE embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, d.vec_id,
            CAST(coalesce(list_sum([q.v[i] * d.v[i] FOR i IN range(1, len(q.v) + 1)]), 0) AS BIGINT)
                AS score
        FROM vectors q JOIN vectors d
            ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id AND len(q.v) = len(d.v)
    ), ranked AS (
        SELECT query_id, vec_id, score,
            CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
                AS rank
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query(
    "op7_url_filters",
    """
    WITH urls AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0
            THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
        FROM pages
    ), parts AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS host,
            CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
        FROM urls
    ), rules(verdict, rule_host, rule_path) AS (
        VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
            ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
    ), fitting AS (
        SELECT page_id, parts.host, path, rule_host || rule_path AS rule, verdict,
            row_number() OVER (PARTITION BY page_id
                ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS nth
        FROM parts LEFT JOIN rules ON starts_with(path, rule_path)
            AND (host = rule_host OR ends_with(host, '.' || rule_host))
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM fitting WHERE nth = 1
    """,
)
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "verdict string, host string, path string")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


@query("op8_phrase_fingerprints")
def op8_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def _notice_rows() -> str:
    quoted = ((a.replace("'", "''"), b.replace("'", "''")) for a, b in license_scan.NOTICES)
    return ", ".join(f"('{a}', '{b}')" for a, b in quoted)


@query(
    "op9_license_scan",
    rf"""
    WITH notices(license, text) AS (VALUES {_notice_rows()}
    ), notice_words AS (
        SELECT license, [w FOR w IN regexp_split_to_array(lower(text), '[^\pL\pN]+') IF w <> ''] AS w
        FROM notices
    ), wanted AS (
        -- a notice of less than five words is one shingle of its own length
        SELECT DISTINCT license, n, greatest(len(w) - 4, 1) AS size, array_to_string(w[i : i + n - 1], ' ') AS shingle
        FROM (
            SELECT *, least(len(w), 5) AS n, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
            FROM notice_words WHERE len(w) > 0
        )
    ), counted AS (
        SELECT license, count(*) AS shingles FROM wanted GROUP BY license
    ), document_words AS (
        SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(text), '[^\pL\pN]+') IF w <> ''] AS w
        FROM documents
    ), found AS (
        SELECT doc_id, license, size, i, shingle
        FROM (
            SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS shingle
            FROM (
                SELECT *, unnest(range(1, len(w) - n + 2)) AS i
                FROM document_words, (SELECT DISTINCT n FROM wanted)
            )
        ) JOIN wanted USING (n, shingle)
    ), windows AS (
        SELECT a.doc_id, a.license, a.i, count(DISTINCT b.shingle) AS held
        FROM found a JOIN found b
            ON a.doc_id = b.doc_id AND a.license = b.license AND b.i BETWEEN a.i AND a.i + a.size - 1
        GROUP BY a.doc_id, a.license, a.i
    )
    SELECT doc_id, license, max(held / shingles) AS containment
    FROM windows JOIN counted USING (license) GROUP BY doc_id, license
    HAVING max(held / shingles) >= 0.8
    """,
)
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"), license_scan.notices(spark))
    return found.select("doc_id", "license", "containment")


@query(
    "op10_jaccard_join",
    r"""
    WITH RECURSIVE document_words AS (
        SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(text), '[^\pL\pN]+') IF w <> ''] AS w
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 4], ' ')) AS shingle
        FROM (
            SELECT *, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i
            FROM document_words
        )
    ), sizes AS (
        SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id
    ), pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id
    ), links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE common / (x.size + y.size - common) >= 0.8
    ), reached AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
    )
    SELECT doc_id, (SELECT min(b) FROM reached WHERE a = doc_id) AS class_id,
        (SELECT count(*) FROM links WHERE a = doc_id) AS n_links
    FROM documents
    """,
)
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_classes(table(spark, sf_dir, "documents"), threshold=0.8)


@query(
    "op11_conversation_trie",
    r"""
    WITH turns AS (
        SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
                AS turn_key,
            len([w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> '']) AS words,
            turn
        FROM conversations WHERE conv_id IS NOT NULL
    ), whole AS (
        SELECT conv_id, list({'k': turn_key, 'w': words} ORDER BY turn NULLS FIRST, turn_key) AS turns,
            -- crc32 of the decimal id, bit by bit
            xor(list_reduce([4294967295] || flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1]
                    FOR c IN string_split(conv_id::VARCHAR, '')]), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 4 AS h
        FROM turns GROUP BY conv_id
    ), rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(b.turns[1 : c.h], []), c.turns[c.h + 1 :]) AS turns
        FROM whole c LEFT JOIN whole b ON b.conv_id = c.conv_id - c.conv_id % 20
    ), starts AS (
        SELECT conv_id, turns, d, array_to_string([t.k FOR t IN turns[1 : d]], ',') AS path
        FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
    ), nodes AS (
        SELECT path, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
            min_by(turns[1 : d], conv_id) AS turns,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = len(turns)), ''))
                AS ends_sha256
        FROM starts GROUP BY path
    ), shares AS (
        SELECT *, array_to_string([t.k FOR t IN turns[1 : depth - 1]], ',') AS parent_path,
            CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * turns[depth].w END AS share
        FROM nodes
    ), counted AS (
        SELECT s.*, p.conv_id AS parent_conv_id,
            (SELECT count(*) FROM shares c WHERE c.parent_path = s.path AND c.depth = s.depth + 1) AS n_children
        FROM shares s LEFT JOIN shares p ON s.depth > 0 AND p.path = s.parent_path AND p.depth = s.depth - 1
    ), below AS (
        SELECT array_to_string([t.k FOR t IN turns[1 : d]], ',') AS path,
            count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(share) AS saved_tokens
        FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1
    )
    SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves,
        CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
    FROM counted JOIN below USING (path)
    """,
)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(conversation_trie.numbered_turns(table(spark, sf_dir, "conversations")))
    trie = conversation_trie.prefix_trie(conversation_trie.with_borrowed_starts(turns))
    return trie.drop("node", "parent")


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
        vocabulary("piece_bpe_32k.model"), with_groups=False,
    )
    return aligned.drop("groups", "a_ids", "b_ids")


def _rule_rows() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    return ", ".join(
        f"({quoted(r.kind)}, {place}, {quoted(r.pattern)}, {r.group}, {r.least})"
        for place, r in enumerate(secret_scan.RULES)
    )


@query(
    "op13_secret_scan",
    rf"""
    WITH rules(kind, place, pattern, part, least) AS (VALUES {_rule_rows()}
    ), texts AS (
        SELECT row_number() OVER () AS path, doc_id, coalesce(text, '') AS text FROM documents
    ), pieces AS (
        SELECT path, kind, place, least, regexp_split_to_array(text, pattern) AS gaps,
            regexp_extract_all(text, pattern, 0) AS found,
            CASE part WHEN 0 THEN regexp_extract_all(text, pattern, 0)
                ELSE regexp_extract_all(text, pattern, 2) END AS held
        FROM texts, rules
    ), matches AS (
        SELECT path, kind, place, least, unnest(range(1, len(found) + 1)) AS nth,
            unnest(gaps[1 : len(found)]) AS gap, unnest(found) AS match, unnest(held) AS held
        FROM pieces
    ), placed AS (
        SELECT *, CAST(sum(length(gap) + length(match)) OVER (PARTITION BY path, kind ORDER BY nth) AS BIGINT)
            AS ending
        FROM matches
    ), listed AS (
        SELECT path, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
            count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
            string_agg(kind || ':' || (ending - length(match)) || ':' || ending, ','
                ORDER BY ending - length(match), place) AS spans
        FROM placed WHERE length(held) >= least GROUP BY path
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
        coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN listed USING (path)
    """,
)
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    listed = secret_scan.listed(F.col("spans"))
    return found.select(
        "doc_id", *[number(r.kind) for r in secret_scan.RULES],
        F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"),
    )
