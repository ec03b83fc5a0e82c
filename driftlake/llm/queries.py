"""The queries of this subpackage, each with the SQL that checks it where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm import (
    decontaminate, exact_dedup, jaccard_join, lang_id, license_scan, packing, sharding, suffix_dedup, token_alignment,
    token_count, turn_repair, url_filter, warc,
)
from driftlake.llm.common import table
from driftlake.session import scratch_dir

# Rules of the URL query (fixed values).
URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]

# Phrases every licence scan looks for (fixed values).
BASE_LICENSES = [
    license_scan.Template("cc-by", "cc by", base=True),
    license_scan.Template("gpl", "general public license", base=True),
    license_scan.Template("reserved", "all rights reserved", base=True),
]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), capacity=4096, end_id=1)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS k
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
f AS (SELECT md5(k) AS m, min(doc_id) AS first FROM g GROUP BY 1),
hit AS (SELECT g.doc_id, g.i FROM g JOIN f ON md5(g.k) = f.m WHERE g.doc_id > f.first),
edge AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER w + 50, -1) AS fresh FROM hit
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
run AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM edge),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY 1, 2),
keep AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM span),
part AS (
  SELECT k.doc_id, string_agg(substr(d.h, 2 * k.before + 1, 2 * (k.a - k.before)), '' ORDER BY k.a) AS kept,
         max(k.b) AS last, sum(k.b - k.a) AS removed, count(*) AS spans
  FROM keep k JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
       coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(d.h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN part USING (doc_id)
"""


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"), shards=24)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find(docs.select("doc_id", "text"), items)
    listed = F.array_join(F.array_sort("items"), ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS k
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms WHERE len(w) >= m)),
hits AS (SELECT dw.doc_id, dw.i, dw.m, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.k = bw.k),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM
  (SELECT doc_id, unnest(range(i, i + m)) AS j FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit,
       coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.near_duplicates(docs, k=5, threshold=(75, 100)).select(
        "doc_id", "n_shingles", "component_id")


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
r AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION
  SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.other)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY 1
"""


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return lang_id.identify(docs).select(
        F.col("row.doc_id").alias("doc_id"), "held_out", "lang_pred", "score"
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(length(text), 0) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, text_sha256,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept
FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), f"{folder}/archives")
    return warc.read_archives(spark, f"{folder}/archives", with_html=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_count.count_tokens(docs, vocabulary("word_bpe_49k.json"), limit=2048)


OP10_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex
  FROM pages),
d AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(8), lambda i:
           list_aggregate(list_transform(range(4), lambda j:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((('0x' || substr(hex, 1 + 5 * i::INT, 5))::INT >> (15 - 5 * j::INT)) & 31), 1)),
             'string_agg', '')), '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER g THEN min(page_id) OVER g END AS refers_to
FROM d WINDOW g AS (PARTITION BY payload_digest, payload_bytes)
"""


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = turn_repair.damage(table(spark, sf_dir, "conversations"))
    return turn_repair.repair(rows, copies)


# The damage's CRC-32 bit by bit; then all edits of a row after another, the best for each state
# (0 nothing yet, 1 after system, 2 after user, 3 after assistant) carried on.
OP11_SQL = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                        lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations),
dealt AS (
  SELECT * EXCLUDE (bytes), xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b:
    list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: i::BIGINT)), lambda d, i:
      xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) % 20 AS k
  FROM raw),
hurt AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS c FROM dealt WHERE k <> 0)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM hurt),
judged AS (
  SELECT *, substr(role, 1, 1) AS c,
         CASE WHEN trim(text, E' 	

') = '' THEN 'b'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
              WHEN right(trim(text, E' 	

'), 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'k' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY 1),
put(s, m, e, line) AS (  -- states after inserts
  SELECT s, 0, s, ''::VARCHAR FROM range(4) t(s)
  UNION ALL
  SELECT s, m + 1, CASE WHEN e = 2 THEN 3 ELSE 2 END,
         line || CASE WHEN e = 2 THEN E'
assistant:' ELSE E'
user:' END FROM put WHERE m < 3),
states(conv_id, i, s, cost, audit, line) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0::BIGINT, 0::BIGINT, ''::VARCHAR, ''::VARCHAR FROM judged
  UNION ALL
  SELECT conv_id, i, e, min(cost), min(audit), min(line) FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, e ORDER BY cost, audit) AS best FROM (
      SELECT j.conv_id, j.i, s.cost + 3 * p.m + o.price AS cost,
             s.audit || repeat('I', p.m::BIGINT) || o.letter AS audit,
             s.line || p.line || o.line AS line,
             CASE o.out WHEN '-' THEN p.e WHEN 's' THEN CASE WHEN p.e = 0 THEN 1 END
                        WHEN 'u' THEN CASE WHEN p.e IN (0, 1, 3) THEN 2 END
                        WHEN 'a' THEN CASE WHEN p.e = 2 THEN 3 END END AS e
      FROM states s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.i = s.i + 1
      JOIN put p ON p.s = s.s,
      LATERAL (
        SELECT 'D' AS letter, 4 AS price, '-' AS out, '' AS line
        UNION ALL SELECT 'K', CASE WHEN j.fault = 't' THEN 3 ELSE 0 END, j.c, E'
' || j.role || ':' || j.text
        WHERE j.fault IN ('k', 't')
        UNION ALL SELECT 'R', CASE WHEN j.fault = 't' THEN 6 ELSE 3 END, r[1:1], E'
' || r || ':' || j.text
        FROM unnest(['user', 'assistant']) u(r) WHERE j.fault IN ('k', 't')) o)
    WHERE e IS NOT NULL) WHERE best = 1 GROUP BY ALL),
ends AS (
  SELECT s.conv_id, s.cost + 3 * m AS cost, s.audit || repeat('I', m::BIGINT) AS audit, s.line || p.line AS line,
         row_number() OVER (PARTITION BY s.conv_id ORDER BY s.cost + 3 * m, s.audit || repeat('I', m::BIGINT)) AS best
  FROM states s JOIN (SELECT conv_id, max(i) AS i FROM judged GROUP BY 1) n
    ON n.conv_id IS NOT DISTINCT FROM s.conv_id AND n.i = s.i
  JOIN put p ON p.s = s.s WHERE p.e IN (0, 3))
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
       sha256(substr(coalesce(line, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.best = 1
"""


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = license_scan.find(docs, BASE_LICENSES + license_scan.TEMPLATES)
    base = F.filter("places", lambda p: p["base"])
    return found.select("doc_id", "n_words", "places", base.alias("base")).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base.start")).alias("first_word"), F.array_max(F.col("base.start")).alias("last_word"),
        license_scan.labels(F.col("base")).alias("base_labels"), license_scan.labels(F.col("places")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.col("places.score")), F.lit(0.0)), 9).alias("score"))


def _license_rows() -> str:
    """Templates as SQL rows: number, label, base, words, key phrases."""
    rows = []
    for t, x in enumerate(BASE_LICENSES + license_scan.TEMPLATES):
        keys = ", ".join(f"'{k}'" for k in x.keys or (x.text,))
        rows.append(f"({t}, '{x.label}', {x.base}, '{x.text}', {bool(x.keys)}, [{keys}])")
    return ",\n    ".join(rows)


OP12_SQL = r"""
WITH tpl(t, label, base, text, keyed, keys) AS (VALUES
    %s),
tw AS (
  SELECT t, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word
  FROM (SELECT t, string_split(text, ' ') AS w FROM tpl)),
kw AS (
  SELECT DISTINCT t, length(regexp_replace(substr(text, 1, strpos(' ' || text || ' ', ' ' || k || ' ') - 1), '[^ ]', '', 'g'))
                     + i AS pos, word
  FROM (SELECT t, text, k, generate_subscripts(string_split(k, ' '), 1) - 1 AS i, unnest(string_split(k, ' ')) AS word
        FROM (SELECT t, text, unnest(keys) AS k FROM tpl))),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (
  SELECT r, i, word FROM (SELECT r, generate_subscripts(w, 1) - 1 AS i, unnest(w) AS word FROM d)
  WHERE word IN (SELECT word FROM tw)),
df AS (SELECT word, count(DISTINCT r) AS n FROM dw GROUP BY 1),
weight AS (
  SELECT word, ln(1 + ((SELECT count(*) FROM d) + 1) / (coalesce(df.n, 0) + 1)) AS x
  FROM (SELECT DISTINCT word FROM tw) LEFT JOIN df USING (word)),
rare AS (
  SELECT t, pos, word FROM (
    SELECT t, word, min(pos) AS pos, row_number() OVER (PARTITION BY t ORDER BY any_value(x) DESC, min(pos)) AS nth
    FROM tw JOIN weight USING (word) GROUP BY t, word) JOIN tpl USING (t)
  WHERE nth <= CASE WHEN keyed THEN 4 ELSE 1 END),
need AS (SELECT t, (count(*) + 1) // 2 AS need FROM rare GROUP BY 1),
prop AS (SELECT DISTINCT r, t, i - pos AS start FROM dw JOIN rare USING (word)),
hit AS (
  SELECT p.r, p.t, p.start, sum(x) AS got,
         count(*) FILTER ((p.t, tw.pos, tw.word) IN (SELECT (t, pos, word) FROM rare)) AS agreed,
         count(*) FILTER ((p.t, tw.pos, tw.word) IN (SELECT (t, pos, word) FROM kw)) AS keyed_at
  FROM prop p JOIN tw USING (t) JOIN dw ON dw.r = p.r AND dw.i = p.start + tw.pos AND dw.word = tw.word
  JOIN weight ON weight.word = tw.word GROUP BY 1, 2, 3),
place AS (
  SELECT r, label, base, start, least(got / total, 1.0) AS score
  FROM hit JOIN tpl USING (t) JOIN need USING (t)
  JOIN (SELECT t, count(*) AS n_keys FROM kw GROUP BY 1) USING (t)
  JOIN (SELECT t, sum(x) AS total FROM tw JOIN weight USING (word) GROUP BY 1) USING (t)
  WHERE agreed >= need AND keyed_at = n_keys AND got / total >= 0.6),
found AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM place GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(coalesce(score, 0.0), 9)::DOUBLE AS score
FROM d LEFT JOIN found USING (r)
""" % _license_rows()


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES = {
    "op1_packing": (op1_packing, None),
    "op2_url_filters": (op2_url_filters, None),
    "op3_suffix_dedup": (op3_suffix_dedup, OP3_SQL),
    "op4_sharding": (op4_sharding, None),
    "op5_decontamination": (op5_decontamination, OP5_SQL),
    "op6_jaccard_join": (op6_jaccard_join, OP6_SQL),
    "op7_language_id": (op7_language_id, None),
    "op8_exact_dedup": (op8_exact_dedup, OP8_SQL),
    "op9_token_counts": (op9_token_counts, None),
    "op10_warc": (op10_warc, OP10_SQL),
    "op11_turn_repair": (op11_turn_repair, OP11_SQL),
    "op12_license_scan": (op12_license_scan, OP12_SQL),
    "op13_token_alignment": (op13_token_alignment, None),
}
