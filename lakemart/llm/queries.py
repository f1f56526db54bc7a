"""Registered queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemart.llm import centroids, contamination, heavylight, manifest, mixing, perplexity, repair, reputation, revisits, sharding, simhash, suffixes, toxicity
from lakemart.llm.common import load, text_crc32, utf8_bytes, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


#: CRC-32 of a text, in SQL: a table of the 256 byte steps, then one step per byte.
CRC_SQL = """
crc_step AS (
  SELECT list(list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b))
"""
_CRC = """xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(x.text)), '..'),
  lambda h: ('0x' || h)::BIGINT), lambda c, b: xor(c >> 8, s.t[1 + (xor(c, b) & 255)])))"""

N_SHARDS = 40

OP2_SQL = f"""
WITH {CRC_SQL},
x AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
sized AS (SELECT x.doc_id, strlen(x.text) + 16 AS size, {_CRC} AS text_crc32 FROM x, crc_step s),
placed AS (
  SELECT *, coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(size) OVER () AS total, row_number() OVER (o) AS n
  FROM sized WINDOW o AS (ORDER BY doc_id NULLS FIRST, size, text_crc32)),
cut AS (SELECT *, least(({N_SHARDS} * (2 * before + size)) // (2 * total), {N_SHARDS} - 1)::INTEGER AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       (n - min(n) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""


@register("op2_sharding", OP2_SQL)
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    sized = docs.select("doc_id", (utf8_bytes(F.col("text")) + sharding.OVERHEAD).alias("size"),
                        text_crc32(F.col("text")).alias("text_crc32"))     # the texts themselves need not move
    return sharding.place(sized, N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::HUGEINT AS source_size, 3 * sum(size)::HUGEINT AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
levels AS (   -- every possible set of capped sources: those whose cap per weight is below a given source's
  SELECT a.source, sum(a2.cap) AS caps, sum(a2.w) AS ws
  FROM sources a LEFT JOIN sources a2 ON a2.cap * a.w < a.cap * a2.w GROUP BY a.source),
tot AS (SELECT sum(source_size) AS t, sum(w) AS w FROM sources),
judged AS (
  SELECT s.*, tot.t - coalesce(l.caps, 0) AS rest, tot.w - coalesce(l.ws, 0) AS wrest
  FROM sources s JOIN levels l ON s.source IS NOT DISTINCT FROM l.source, tot),
level AS (SELECT arg_min(rest, cap / w) AS rest, arg_min(wrest, cap / w) AS wrest FROM judged WHERE cap * wrest > w * rest),
targets AS (
  SELECT j.source, j.source_size::BIGINT AS source_size,
         CASE WHEN j.cap * j.wrest > j.w * j.rest THEN (j.w * level.rest)::DOUBLE / level.wrest::DOUBLE ELSE j.cap::DOUBLE END AS target
  FROM judged j, level),
placed AS (
  SELECT s.*, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken
FROM placed
"""


@register("op4_mixing", OP4_SQL)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text_crc32(F.col("text")).alias("_lm_crc"))
    return mixing.take(sized).select("doc_id", "size", "source_size", "target", "taken")


#: The rules of the contract.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}

OP8_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
rules(r, rhost, rpath, verdict) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
ruled AS (
  SELECT p.page_id, p.host, p.path, arg_max(r.r, length(r.r)) AS rule, arg_max(r.verdict, length(r.r)) AS rv
  FROM p LEFT JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
  GROUP BY ALL),
lab AS (
  SELECT doc_id, max(CASE WHEN quality IS NULL AND toxic IS NULL THEN NULL
                          WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS bad,
         CASE WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ('ac.uk', 'co.jp', 'co.nz', 'co.uk', 'com.au', 'com.br', 'org.uk')
              THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE array_to_string(string_split(host, '.')[-2:], '.') END AS domain,
         CASE WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ('ac.uk', 'co.jp', 'co.nz', 'co.uk', 'com.au', 'com.br', 'org.uk')
              THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE string_split(host, '.')[-1] END AS suffix
  FROM p LEFT JOIN lab ON lab.doc_id = TRY_CAST(nullif(regexp_extract(path, '/([0-9]{1,18})(?:\.[a-z]+)?/?$', 1), '') AS BIGINT)
  GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT CASE WHEN sum(n) > 0 THEN sum(bad)::DOUBLE / sum(n) ELSE 0.5 END FROM hosts) AS mu
             FROM domains GROUP BY suffix),
ks AS (SELECT 1 / least(greatest(CASE WHEN sum((n - 1) * mu * (1 - mu)) > 0 THEN (sum(n * (bad / n - mu) * (bad / n - mu)) - sum(mu * (1 - mu)))
         / sum((n - 1) * mu * (1 - mu)) ELSE 1e-4 END, 1e-4), 0.5) - 1 AS k FROM suffixes WHERE n > 0),
sm AS (SELECT suffix, (bad + k * mu) / (n + k) AS mu FROM suffixes, ks),
dm0 AS (SELECT d.*, sm.mu FROM domains d JOIN sm USING (suffix)),
kd AS (SELECT 1 / least(greatest(CASE WHEN sum((n - 1) * mu * (1 - mu)) > 0 THEN (sum(n * (bad / n - mu) * (bad / n - mu)) - sum(mu * (1 - mu)))
         / sum((n - 1) * mu * (1 - mu)) ELSE 1e-4 END, 1e-4), 0.5) - 1 AS k FROM dm0 WHERE n > 0),
dm AS (SELECT domain, (bad + k * mu) / (n + k) AS mu FROM dm0, kd),
hm0 AS (SELECT h.host, h.n, h.bad, dm.mu FROM hosts h JOIN dm USING (domain)),
kh AS (SELECT 1 / least(greatest(CASE WHEN sum((n - 1) * mu * (1 - mu)) > 0 THEN (sum(n * (bad / n - mu) * (bad / n - mu)) - sum(mu * (1 - mu)))
         / sum((n - 1) * mu * (1 - mu)) ELSE 1e-4 END, 1e-4), 0.5) - 1 AS k FROM hm0 WHERE n > 0),
post AS (SELECT host, (bad + k * mu) / (n + k) AS m, n + k AS t FROM hm0, kh)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN rv WHEN m - 1.645 * sqrt(m * (1 - m) / (t + 1)) > 0.25 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN post USING (host)
"""


@register("op8_host_reputation", OP8_SQL)
def op8_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = load(spark, sf_dir, "pages").select("page_id", "url"), load(spark, sf_dir, "labels")
    return reputation.judge_pages(pages, labels, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def capture_records(pages: DataFrame) -> DataFrame:
    """WARC-like capture records from crawled pages, two visits each.

    The first visit of a page is a full response (for every fifth page it is
    missing); the second, 5,000 seconds later, a revisit.  Every seventh
    revisit has another entity tag (the page changed), every eleventh has none.
    """
    etag = F.concat(F.lit('"'), F.md5(F.coalesce(F.col("html"), F.lit(""))), F.lit('"'))
    day = lambda s: F.concat(F.lit("day-"), F.floor((F.col("page_id") + s) / 86400).cast("string"))
    none = F.lit(None).cast("string")
    tag2 = F.when(F.col("page_id") % 7 == 0, F.lit('"changed"')).when(F.col("page_id") % 11 == 0, none).otherwise(F.concat(F.lit("W/"), etag))
    first = F.struct((F.col("page_id") * 2).alias("record_id"), F.col("page_id").alias("ts"), F.lit("response").alias("kind"), etag.alias("etag"),
                     day(0).alias("last_modified"),
                     F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), etag, F.lit("date"), day(0),
                                  F.lit("content-length"), F.octet_length(F.coalesce(F.col("html"), F.lit(""))).cast("string")).alias("headers"))
    second = F.struct((F.col("page_id") * 2 + 1).alias("record_id"), (F.col("page_id") + 5000).alias("ts"), F.lit("revisit").alias("kind"),
                      tag2.alias("etag"), day(0).alias("last_modified"),
                      F.create_map(F.lit("date"), day(5000), F.lit("cache-control"), F.concat(F.lit("max-age="), (F.col("page_id") % 100).cast("string")),
                                   F.lit("content-length"), F.lit("0"), F.lit("x-cache"), F.lit("hit")).alias("headers"))
    return (pages.select("url", F.explode(F.array(first, second)).alias("r"), "page_id")
            .where("not (r.kind = 'response' and page_id % 5 = 0)").select("url", "r.*"))


OP3_SQL = r"""
WITH c AS (
  SELECT page_id, html,
    CASE WHEN instr(url, '://') > 0 THEN
      regexp_replace(regexp_replace(translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www\.', ''), ':(80|443)$', '')
      || regexp_replace(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1), '/+$', '')
      || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]*|gclid|fbclid)(=|$)'))), '&'), ''), '') END AS curl
  FROM pages),
full_ AS (
  SELECT curl, page_id AS ts, max(page_id * 2) AS base_id FROM c WHERE page_id % 5 <> 0 GROUP BY ALL),
base AS (SELECT f.*, c.html FROM full_ f JOIN c ON c.page_id * 2 = f.base_id),
rev AS (
  SELECT c.*, page_id + 5000 AS ts, CASE WHEN page_id % 7 = 0 THEN '"changed"' WHEN page_id % 11 = 0 THEN NULL
    ELSE '"' || md5(coalesce(html, '')) || '"' END AS etag FROM c),
found AS (
  SELECT r.*, b.base_id, b.ts AS base_ts, '"' || md5(coalesce(b.html, '')) || '"' AS base_etag, strlen(coalesce(b.html, '')) AS base_len
  FROM rev r ASOF LEFT JOIN base b ON r.curl = b.curl AND r.ts > b.ts),
judged AS (
  SELECT *, CASE WHEN base_id IS NULL THEN 'no_base' WHEN etag IS NOT NULL THEN CASE WHEN etag = base_etag THEN 'resolved' ELSE 'mismatch' END
    WHEN floor(page_id / 86400) = floor(base_ts / 86400) THEN 'resolved' ELSE 'mismatch' END AS status FROM found)
SELECT page_id * 2 + 1 AS record_id, curl AS canonical_url, ts, status, base_id AS base_record_id, base_ts,
  CASE WHEN status = 'resolved' THEN 'cache-control: max-age=' || (page_id % 100)::VARCHAR || chr(10) || 'content-length: ' || base_len::VARCHAR
    || chr(10) || 'content-type: text/html' || chr(10) || 'date: day-' || floor(ts / 86400)::BIGINT::VARCHAR || chr(10) || 'etag: ' || base_etag END AS merged_headers
FROM judged
"""


@register("op3_revisits", OP3_SQL)
def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = revisits.resolve_revisits(capture_records(load(spark, sf_dir, "pages").select("page_id", "url", "html")))
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return r.withColumn("merged_headers", lines).drop("headers")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM d, ks, unnest(range(1, greatest(len(w) - k + 1, 0) + 1)) AS t(i)),
hits AS (SELECT dw.doc_id, dw.i, dw.k, bw.item FROM dw JOIN bw USING (k, win)),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(k)) AS t(j) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@register("op9_decontamination", OP9_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.contaminated(docs, load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@register("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op1_repair_tokens")
def op1_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = repair.write_shards(load(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return repair.read_documents(shards)


@register("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"))
    runs = F.transform("removed", lambda r: r["end"] - r["start"])
    return cut.select("doc_id", utf8_bytes(F.col("text")).alias("n_bytes"),
                      F.aggregate(runs, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def held_out(doc_id) -> Column:
    """Documents whose labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    return toxicity.score_documents(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")


@register("op6_perplexity")
def op6_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.judge_quality(load(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity")


#: The columns of a document that its leaf covers, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _sql_field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(text if c == "text" else c) for c in LEAF_COLUMNS) + ")"


OP13_SQL = f"""
WITH RECURSIVE {CRC_SQL},
leaves AS (
  SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
    CASE WHEN {_CRC.replace("x.text", "coalesce(doc_id::VARCHAR, '')")} % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")}
         ELSE {_sql_leaf("text")} END AS shown
  FROM documents x, crc_step s),
placed AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaves
           WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)),
tree AS (
  SELECT source, 0 AS lvl, i, n, leaf AS node FROM placed
  UNION ALL
  SELECT source, any_value(lvl) + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY source, i // 3),
subroots AS (
  SELECT source, node AS subroot, lvl AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, i, n, subroot AS node FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY i // 3),
steps AS (
  SELECT p.doc_id, p.source, p.i, t.lvl,
         coalesce(string_agg(t.node, '' ORDER BY t.i) FILTER (WHERE t.i < p.i // (3 ** t.lvl)::BIGINT), '') AS l,
         coalesce(string_agg(t.node, '' ORDER BY t.i) FILTER (WHERE t.i > p.i // (3 ** t.lvl)::BIGINT), '') AS r
  FROM (SELECT doc_id, source, i FROM placed) p JOIN (SELECT * FROM tree WHERE n > 1) t
    ON p.source IS NOT DISTINCT FROM t.source AND t.i // 3 = (p.i // (3 ** t.lvl)::BIGINT) // 3
  GROUP BY ALL
  UNION ALL
  SELECT p.doc_id, p.source, p.i, s.height + t.lvl,
         coalesce(string_agg(t.node, '' ORDER BY t.i) FILTER (WHERE t.i < s.i // (3 ** t.lvl)::BIGINT), ''),
         coalesce(string_agg(t.node, '' ORDER BY t.i) FILTER (WHERE t.i > s.i // (3 ** t.lvl)::BIGINT), '')
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
    JOIN (SELECT * FROM top WHERE n > 1) t ON t.i // 3 = (s.i // (3 ** t.lvl)::BIGINT) // 3
  GROUP BY p.doc_id, p.source, p.i, s.height, t.lvl),
proofs AS (SELECT source, i, sha256(string_agg(l || r, '' ORDER BY lvl)) AS proof_sha256,
                  list(l ORDER BY lvl) AS ls, list(r ORDER BY lvl) AS rs, count(*) AS steps FROM steps GROUP BY source, i),
fold AS (
  SELECT p.source, p.i, 0 AS k, p.shown AS node, q.ls, q.rs, coalesce(q.steps, 0) AS steps
  FROM placed p LEFT JOIN proofs q ON p.source IS NOT DISTINCT FROM q.source AND p.i = q.i
  UNION ALL
  SELECT source, i, k + 1, sha256(ls[k + 1] || node || rs[k + 1]), ls, rs, steps FROM fold WHERE k < steps)
SELECT p.doc_id, p.leaf, s.subroot, t.node AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = t.node AS verified
FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
  JOIN fold f ON p.source IS NOT DISTINCT FROM f.source AND p.i = f.i AND f.k = f.steps
  LEFT JOIN proofs q ON p.source IS NOT DISTINCT FROM q.source AND p.i = q.i, (SELECT node FROM top WHERE n = 1) t
"""


@register("op13_merkle_manifest", OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    shown = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    proved = manifest.manifest(docs, "doc_id", "source", manifest.row_digest(LEAF_COLUMNS),
                               {"shown": manifest.row_digest(LEAF_COLUMNS, {"text": shown})})
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("proof")), 256).alias("proof_sha256"),
                         manifest.folded(F.col("shown"), F.col("proof")).alias("folded_root")).withColumn(
                             "verified", F.col("folded_root") == F.col("root"))


_NEAREST = """SELECT v.vec_id, v.q, arg_min(c.c, (list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))::BIGINT, c.c)) AS c,
    min(list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))::BIGINT) AS distance
  FROM v, c{0} c GROUP BY v.vec_id, v.q"""
_MOVED = """SELECT c.c, coalesce(n.q, c.q) AS q FROM c{0} c LEFT JOIN (
    SELECT c, list(m ORDER BY i) AS q FROM (SELECT c, i, (sum(q[i]) - ((sum(q[i]) % count(*)) + count(*)) % count(*)) // count(*) AS m
                                           FROM a{0}, unnest(range(1, 65)) AS t(i) GROUP BY c, i) GROUP BY c) n ON n.c = c.c"""

OP12_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, q FROM v ORDER BY c LIMIT 40),
{"".join(f"a{r} AS MATERIALIZED ({_NEAREST.format(r)}), c{r + 1} AS MATERIALIZED ({_MOVED.format(r)}), " for r in range(5))}
last AS MATERIALIZED ({_NEAREST.format(5)})
SELECT vec_id, l.c::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY l.c)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c5.q::BIGINT[], ',')) AS centroid_sha256
FROM last l JOIN c5 ON c5.c = l.c
"""


@register("op12_centroids", OP12_SQL)
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters, found = centroids.cluster(load(spark, sf_dir, "embeddings"))
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found]
    name = F.element_at(F.array(*map(F.lit, names)), F.col("cluster") + 1) if names else F.lit(None).cast("string")
    return centroids.with_inertia(clusters).withColumn("centroid_sha256", name).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


OP11_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
items AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s FROM words, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM items GROUP BY r),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS k FROM items x JOIN items y ON x.s = y.s AND x.r <> y.r GROUP BY ALL) p
    JOIN sizes sa ON sa.r = p.a JOIN sizes sb ON sb.r = p.b WHERE 100 * k >= 85 * (sa.n + sb.n - k)),
reach AS (SELECT r, r AS to_ FROM sizes UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.to_)
SELECT words.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, words.doc_id) AS component_id
FROM words LEFT JOIN sizes USING (r)
  LEFT JOIN (SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN words o ON o.r = reach.to_ GROUP BY reach.r) c ON c.r = words.r
"""


@register("op11_ngram_jaccard", OP11_SQL)
def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavylight.similar_sets(load(spark, sf_dir, "documents").select("doc_id", "text"))
