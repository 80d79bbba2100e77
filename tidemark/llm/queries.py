"""Registered queries of the operators, with production parameters, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chat import chat_format
from tidemark.llm.common import read_table, stage
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.fill_middle import fill_middle, restore
from tidemark.llm.language_id import language_id
from tidemark.llm.license_scan import license_scan
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.lm_scoring import lm_score
from tidemark.llm.mixing import mix
from tidemark.llm.prefix_trie import light, placed, trie
from tidemark.llm.simhash import simhash_dedup
from tidemark.llm.url_filter import ALLOW, BLOCK, Rule, url_filter
from tidemark.llm.warc import ALPHABET, read_archives, write_archives
from tidemark.session import fresh_dir


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return (line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", "n_lines", "n_removed", F.length(text).cast("bigint").alias("n_chars"), F.sha2(text, 256).alias("text_sha256")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format(read_table(spark, sf_dir, "conversations")).withColumn("text_sha256", F.sha2("text", 256)).drop("text")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read_table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(read_table(spark, sf_dir, "documents"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read_table(spark, sf_dir, "documents"))


def rebuilt(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from ``placed`` turns: the first h turns of the block's first one, then the
    own turns after the first h. Returns their turns and the ids of all of them."""
    ids = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumns(
        {"h": F.crc32(F.col("conv_id").cast("string")) % most, "base": F.col("conv_id") - F.col("conv_id") % block})
    heads = (turns.filter((F.col("conv_id") % block == 0) & (F.col("place") < most - 1)).groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("first")))     # at most most - 1 entries
    ids = stage(ids.join(heads, "base", "left").withColumn("taken", F.filter(F.coalesce("first", F.array()), lambda x: x["place"] < F.col("h")))
                .select("conv_id", "h", "taken"), "rebuilt-ids")
    own = (turns.join(ids.select("conv_id", "h", F.size("taken").alias("n_taken")), "conv_id").filter("place >= h")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("n_taken")).alias("place"), "digest", "chars"))
    return ids.select("conv_id", F.inline("taken")).unionByName(own), ids.select("conv_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(placed(light(read_table(spark, sf_dir, "conversations")))))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (fill_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                    F.sha2(restore(), 256).alias("restored_sha256")))


#: Fixed values of the rules.
URL_RULES = (Rule("org", "/", ALLOW), Rule("example.org", "/es/", BLOCK), Rule("example.org", "/en/1", BLOCK), Rule("com", "/fr/", ALLOW),
             Rule("com", "/de/", BLOCK))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (url_filter(read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
            .select("page_id", "host", "path", "rule", "verdict", "score"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_exact_dedup, op3_license_scan, op4_chat_formatting, op5_language_id, op6_lm_scoring, op7_warc_revisits,
    op8_source_mixing, op9_benchmark_decontamination, op10_simhash_dedup, op11_prefix_trie, op12_fill_middle, op13_url_filters)}

ORACLES: dict[str, str] = {
    "op1_line_dedup": r"""
        WITH l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p
                   FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
        w AS (SELECT doc_id, p, line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o AS s
              FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
        r AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS first_doc, min(p) OVER (PARTITION BY s, doc_id) AS first_p
              FROM w WHERE s IS NOT NULL AND regexp_matches(s, '[^\x09-\x0D\x20]')),
        gone AS (SELECT DISTINCT doc_id, p + k AS p FROM r, (SELECT unnest([0, 1, 2]) AS k)
                 WHERE doc_id > first_doc OR p > first_p),
        t AS (SELECT l.doc_id, count(*) AS n_lines, count(gone.p) AS n_removed,
                     string_agg(line, chr(10) ORDER BY l.p) FILTER (WHERE gone.p IS NULL) AS text
              FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.p = gone.p GROUP BY l.doc_id)
        SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
               length(coalesce(t.text, ''))::BIGINT AS n_chars, sha256(coalesce(t.text, '')) AS text_sha256
        FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id""",
    "op2_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY s) AS kept, sha256(s) AS text_sha256
        FROM t""",
    "op7_warc_revisits": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS s, sha1(coalesce(html, '')) AS hex FROM pages),
        r AS (SELECT page_id, strlen(s)::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY s) AS original, hex FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('{ALPHABET}',
                   1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
               CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> original THEN original END AS refers_to
        FROM r""",
    "op8_source_mixing": r"""
        WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                          substr(md5(doc_id::VARCHAR), 1, 15) AS digits FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size,
                     [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3)::INT]::DOUBLE AS weight
              FROM d GROUP BY source),
        f AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio, sum(source_size) OVER () * 1.5::DOUBLE AS pool FROM s),
        g AS (SELECT *, (pool - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                        / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM f),
        lv AS (SELECT ratio AS r0, rate AS rate0 FROM g WHERE rate * weight <= cap ORDER BY ratio, rate LIMIT 1),
        t AS (SELECT source, source_size, CASE WHEN ratio >= r0 THEN least(weight * rate0, cap) ELSE cap END AS target
              FROM g LEFT JOIN lv ON true),
        x AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
                     CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS passes,
                     sum(size) OVER (PARTITION BY d.source ORDER BY digits) AS upto, sum(size) OVER (PARTITION BY d.source, digits) AS words,
                     t.target - CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT * t.source_size AS budget
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, source, size, source_size, target,
               (size * (passes + CASE WHEN upto <= budget OR (upto - words <= budget AND words < 2 * (budget - (upto - words))) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM x""",
    "op11_prefix_trie": """
        WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
                          md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS m
                   FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT conv_id, m, length(text)::BIGINT AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) - 1 AS place FROM t),
        c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, conv_id::VARCHAR AS digits FROM o),
        h AS (SELECT conv_id, base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(digits) + 1), lambda i: ord(substr(digits, i::INT, 1))::BIGINT)),
                     lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                              lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 6 AS h FROM c),
        r AS (SELECT h.conv_id, o.m, o.chars, 0 AS own, place FROM h JOIN o ON o.conv_id = h.base AND o.place < h.h
              UNION ALL SELECT h.conv_id, o.m, o.chars, 1, place FROM h JOIN o ON o.conv_id = h.conv_id AND o.place >= h.h),
        w AS (SELECT conv_id, chars, row_number() OVER p AS depth, md5(string_agg(m, '') OVER p) AS key FROM r WINDOW p AS (PARTITION BY conv_id ORDER BY own, place)),
        k AS (SELECT conv_id, chars, depth, key FROM w UNION ALL SELECT conv_id, 0, 0, '' FROM c),
        l AS (SELECT conv_id, chars, depth, key, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
                     depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM k),
        n AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, any_value(parent) AS parent,
                     sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM l GROUP BY depth, key),
        f AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n AS x WHERE x.depth = n.depth + 1 AND x.parent = n.key) AS n_children
              FROM n LEFT JOIN n AS p ON p.key = n.parent AND p.depth = n.depth - 1),
        s AS (SELECT l.depth, l.key, sum((f.n_convs - 1) * f.chars) AS saved, count(*) FILTER (WHERE f.n_children = 0) AS leaves
              FROM f JOIN l ON l.conv_id = f.conv_id AND l.depth <= f.depth GROUP BY l.depth, l.key)
        SELECT f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, f.ends_sha256
        FROM f JOIN s ON s.depth = f.depth AND s.key = f.key""",
    "op12_fill_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        g AS (SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
                     ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
        c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
        p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                                WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p""",
}
