"""The registered queries of this package: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, knn_quality, mixing, preferences, repeated_bytes, repetition, simhash, token_counts, token_files, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_mix_to_target_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(_table(spark, sf_dir, "documents"), weights=(3.0, 1.0, 2.0), share=1.5, epochs=2.0))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repetition.quality_rules(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words", "longest_repeat"
    )


#: The longest rule that fits a url decides.
URL_RULES = (
    urls.Rule("org", "/", True),
    urls.Rule("example.org", "/es/", False),
    urls.Rule("example.org", "/en/1", False),
    urls.Rule("com", "/fr/", True),
    urls.Rule("com", "/de/", False),
)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.remove_repeats(_table(spark, sf_dir, "documents"), length=200, with_text=False)


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    store = token_files.write_store(docs, tokenizer=token_files.vocabulary_path(), end_id=1)
    return token_files.documents_of(store).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_counts(_table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", "file", "ordinal")


def op9_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = preferences.format_preferences(preferences.reply_pairs(_table(spark, sf_dir, "conversations")))
    return out.select(F.col("id").alias("conv_id"), "n_common_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask", "chosen_loss", "rejected_loss", "usable")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_mix_to_target_weights": op2_mix_to_target_weights,
    "op3_quality_rules": op3_quality_rules,
    "op4_url_filters": op4_url_filters,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_token_id_output": op6_token_id_output,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_counts": op8_token_counts,
    "op9_preference_formatting": op9_preference_formatting,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
}

ORACLE: dict[str, str] = {
    "op2_mix_to_target_weights": r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap, (CASE (sid - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS weight FROM s),
f AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
l AS (SELECT arg_min(level, (cap / weight, sid)) AS level FROM f WHERE level <= cap / weight),
t AS (SELECT sid, source, source_size, CASE WHEN l.level IS NULL OR l.level * weight >= cap THEN cap ELSE l.level * weight END AS target FROM f, l),
n AS (SELECT floor(sum(target) + 0.25)::BIGINT AS wanted FROM t),
b AS (SELECT wanted, greatest(4, length(bin(greatest(1, wanted // 256))))::INT AS bits FROM n),
k AS (SELECT greatest(1, ceil(wanted / (1::BIGINT << bits)))::BIGINT AS block FROM b),
u AS (SELECT t.*, round(target)::BIGINT AS words, ceil(round(target)::BIGINT / block)::BIGINT AS slots, block FROM t, k),
v AS (SELECT *, sum(slots) OVER (ORDER BY sid)::BIGINT AS high, greatest(1, length(bin(sum(slots) OVER ()::BIGINT)))::INT AS bits FROM u),
x AS (SELECT sid, bits, unnest(range(high - slots, high)) AS point FROM v),
y AS (SELECT sid, list_sum([((point >> j) & 1) << (bits - 1 - j) for j in range(bits)])::BIGINT AS slot FROM x),
z AS (SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank FROM y),
p AS (SELECT row_number() OVER () AS rid, doc_id, size, v.sid, source_size, target, words, block, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS stop FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source),
e AS (SELECT rid, sid, block, stop - size + i * source_size AS a, least(stop + i * source_size, words) AS z FROM p, range(2) r(i) WHERE size > 0),
c AS (SELECT rid, sid, block, a, z, unnest(range((a // block)::BIGINT, ((z - 1) // block)::BIGINT + 1)) AS rank FROM e WHERE a < z),
m AS (SELECT rid, min(slot) AS first_slot, count(*) AS n_slots, sum(least(z, (c.rank + 1) * block) - greatest(a, c.rank * block)) AS taken FROM c JOIN z ON z.sid = c.sid AND z.rank = c.rank GROUP BY rid)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_slot, coalesce(n_slots, 0)::BIGINT AS n_slots FROM p LEFT JOIN m ON m.rid = p.rid
""",
    # A word is in a maximal repeat of two words or more where a pair of words that it is in repeats.
    "op3_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS g1 FROM d),
a AS (SELECT doc_id, i, g1, lead(g1, 1) OVER o AS b1, lead(g1, 2) OVER o AS b2, lead(g1, 3) OVER o AS b3, lead(g1, 4) OVER o AS b4 FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT doc_id, i, g1, g1 || ' ' || b1 AS g2, g1 || ' ' || b1 || ' ' || b2 AS g3, g1 || ' ' || b1 || ' ' || b2 || ' ' || b3 AS g4, g1 || ' ' || b1 || ' ' || b2 || ' ' || b3 || ' ' || b4 AS g5 FROM a),
k AS (SELECT doc_id, i, 1 AS k, g1 AS g FROM e UNION ALL SELECT doc_id, i, 2, g2 FROM e WHERE g2 IS NOT NULL UNION ALL SELECT doc_id, i, 3, g3 FROM e WHERE g3 IS NOT NULL UNION ALL SELECT doc_id, i, 4, g4 FROM e WHERE g4 IS NOT NULL UNION ALL SELECT doc_id, i, 5, g5 FROM e WHERE g5 IS NOT NULL),
r AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k, g) AS n FROM k) WHERE n > 1),
s AS (SELECT doc_id, max(k) AS k FROM r GROUP BY doc_id),
c AS (SELECT doc_id, coalesce(sum(least(5, coalesce(next - i, 5))) FILTER (WHERE k = 5), 0) AS repeated, coalesce(sum(least(2, coalesce(next - i, 2))) FILTER (WHERE k = 2), 0) AS covered FROM (SELECT doc_id, k, i, lead(i) OVER (PARTITION BY doc_id, k ORDER BY i) AS next FROM r WHERE k IN (2, 5)) GROUP BY doc_id),
q AS (SELECT a.doc_id, b.i - a.i AS gap, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS run FROM r a JOIN r b ON a.doc_id = b.doc_id AND a.g = b.g AND a.i < b.i WHERE a.k = 5 AND b.k = 5),
m AS (SELECT doc_id, max(n) + 4 AS longest FROM (SELECT doc_id, count(*) AS n FROM q GROUP BY doc_id, gap, run) GROUP BY doc_id),
f AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeated, 0)::BIGINT AS n_repeat_words, coalesce(covered, 0)::BIGINT AS covered_words, coalesce(longest, s.k, 0)::BIGINT AS longest_repeat FROM d JOIN l ON d.doc_id = l.doc_id LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR covered_words > 0.2::DOUBLE * n_words OR longest_repeat > 50) AS kept FROM f
""",
    # The tables hold no links between hosts: trust and distrust stay on the hosts of the urls that rules decide.
    "op4_url_filters": r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) t(site, prefix, says)),
m AS (SELECT page_id, host, path, arg_max(site || prefix, length(site || prefix)) AS rule, arg_max(says, length(site || prefix)) AS said FROM h LEFT JOIN f ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, prefix) GROUP BY page_id, host, path),
s AS (SELECT host, count(*) FILTER (WHERE said = 'block') AS bad, count(*) FILTER (WHERE said = 'allow') AS good FROM m WHERE host <> '' GROUP BY host)
SELECT page_id, m.host, path, rule, coalesce(said, CASE WHEN bad > good THEN 'block' ELSE 'allow' END) AS verdict FROM m LEFT JOIN s ON s.host = m.host
""",
    "op5_suffix_array_dedup": r"""
WITH h AS (SELECT doc_id, encode(coalesce(text, '')) AS x FROM documents),
w AS (SELECT doc_id, p, md5(x[p + 1:p + 200]) AS g FROM (SELECT doc_id, x, unnest(range(0, greatest(0, octet_length(x) - 199))) AS p FROM h)),
r AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM w) WHERE n > 1),
i AS (SELECT doc_id, p, sum(first) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 200 THEN 0 ELSE 1 END AS first FROM r)),
b AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS z FROM i GROUP BY doc_id, span),
k AS (SELECT b.doc_id, sum(z - a) AS removed, count(*) AS spans, string_agg(hex(x[before + 1:a]), '' ORDER BY a) AS head, max(z) AS last FROM (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM b) b JOIN h ON h.doc_id = b.doc_id GROUP BY b.doc_id)
SELECT h.doc_id, octet_length(x)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, CASE WHEN removed IS NULL THEN sha256(x) ELSE sha256(unhex(head || hex(x[last + 1:octet_length(x)]))) END AS kept_sha256
FROM h LEFT JOIN k ON k.doc_id = h.doc_id
""",
    "op9_preference_formatting": r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM t),
a AS (SELECT conv_id, pos, row_number() OVER (PARTITION BY conv_id ORDER BY pos) - 1 AS nth, count(*) OVER (PARTITION BY conv_id) AS m, max(pos) OVER (PARTITION BY conv_id) AS last FROM n WHERE role = 'assistant' AND pos > 1),
k AS (SELECT conv_id, pos AS k, last FROM a WHERE nth = ('0x' || substr(md5(conv_id::VARCHAR), 1, 8))::BIGINT % m),
p AS (SELECT n.*, lag(text) OVER (PARTITION BY n.conv_id ORDER BY pos) AS before, k, last FROM n JOIN k ON n.conv_id = k.conv_id),
c AS (SELECT conv_id, pos, role, text AS chosen, CASE WHEN pos = k THEN before ELSE text END AS rejected, last, '<' || role || '>' || chr(10) AS head, chr(10) || '<end>' || chr(10) AS tail, (role = 'assistant')::INT AS loss FROM p WHERE pos <= last),
e AS (SELECT *, coalesce(min(pos) FILTER (WHERE chosen <> rejected) OVER (PARTITION BY conv_id) - 1, last) AS common FROM c)
SELECT conv_id, max(common)::INTEGER AS n_common_turns,
  coalesce(string_agg(head || chosen || tail, '' ORDER BY pos) FILTER (WHERE pos <= common), '') AS prompt,
  coalesce(string_agg(head || chosen || tail, '' ORDER BY pos) FILTER (WHERE pos > common), '') AS chosen,
  coalesce(string_agg(head || rejected || tail, '' ORDER BY pos) FILTER (WHERE pos > common), '') AS rejected,
  coalesce(string_agg('0*' || length(head) || ' ' || loss || '*' || length(chosen || tail), ' ' ORDER BY pos) FILTER (WHERE pos > common), '') AS chosen_mask,
  coalesce(string_agg('0*' || length(head) || ' ' || loss || '*' || length(rejected || tail), ' ' ORDER BY pos) FILTER (WHERE pos > common), '') AS rejected_mask,
  coalesce(sum(length(chosen) + 7) FILTER (WHERE pos > common AND loss = 1), 0)::BIGINT AS chosen_loss,
  coalesce(sum(length(rejected) + 7) FILTER (WHERE pos > common AND loss = 1), 0)::BIGINT AS rejected_loss,
  max(last) > max(common) AS usable
FROM e GROUP BY conv_id
""",
}
