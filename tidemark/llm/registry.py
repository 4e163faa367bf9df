"""The queries of this subpackage and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, compression_quality, conversation_repair, decontamination, filter_audit, near_duplicates, packing, pii, pitman_yor, quality_rules, substring_dedup, token_counts, url_filter
from .common import crc32_mod, table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file; it is read on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontamination.build_index(_documents(spark, sf_dir))
    found = decontamination.search(index, table(spark, sf_dir, "benchmark").select("item_id", "text"), window=13)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


_ALNUM = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
OP1_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '{_ALNUM}'), []) AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '{_ALNUM}') AS w
  FROM benchmark WHERE text IS NOT NULL),
sizes AS (SELECT DISTINCT least(13, len(w)) AS k FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(i) WHERE len(w) > 0),
starts AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM d, sizes, unnest(range(1, len(w) - k + 2)) AS u(i) WHERE len(w) >= k),
hits AS (SELECT r, k, i, item FROM starts JOIN windows USING (k, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + k)) AS u(p) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(_documents(spark, sf_dir), crc32_mod(F.col("doc_id"), 7) == 2)


#: (host, path, verdict): the rules of the url query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
         row_number() OVER () AS n FROM pages),
parts AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (
  SELECT n, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (n)
"""


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return pii.find(docs, pii.train(docs)).drop("text")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.load_vocabulary(tokenizer_file("piece_bpe_32k.model"))
    return token_counts.count_tokens(_documents(spark, sf_dir), vocabulary).drop("text")


def op6_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = crc32_mod(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    model = compression_quality.train(docs, labels)
    scored = compression_quality.score(docs, model, threshold=0.3)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("text", "lang")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(_documents(spark, sf_dir), window=13)


OP8_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM d, unnest(range(1, len(w) - 11)) AS u(i)
      WHERE len(w) >= 13),
f AS (SELECT win, min(doc_id) AS first_doc FROM s GROUP BY win),
p AS (SELECT DISTINCT doc_id, p FROM s JOIN f USING (win), unnest(range(i, i + 13)) AS u(p) WHERE first_doc < doc_id),
g AS (SELECT doc_id, list(p) AS gone, count(*) AS n FROM p GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w
         ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.groups(_documents(spark, sf_dir), shingle=2, percent=80)


OP9_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'),
         '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
-- with so many shingles ignored, a similar pair still shares one of the others; rare ones first
f AS (SELECT g, count(*) AS df FROM x GROUP BY g),
p AS (SELECT doc_id, n, g, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS k FROM x JOIN f USING (g)),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM p a JOIN p b USING (g)
      WHERE a.doc_id < b.doc_id AND a.k <= a.n - ceil(0.8 * a.n) + 1 AND b.k <= b.n - ceil(0.8 * b.n) + 1
        AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
e AS (
  SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT u.b, r.root FROM r JOIN u ON u.a = r.doc_id WHERE r.root < u.b)
SELECT doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM s JOIN r USING (doc_id) GROUP BY doc_id, s.s
"""


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), capacity=4096, end_id=1)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(_documents(spark, sf_dir), path, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.report(conversation_repair.repair(conversation_repair.damage(rows)))
    found = found.withColumnRenamed("conv_id", "own")
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return (
        rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("own")), "left")
        .select("conv_id", *(F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in found.columns[1:]))
    )


_INITIALS = "left(role, 1)"


def _step(value: str, cost: str, letter: str) -> str:
    return f"{{'c': {value}.c + {cost}, 's': {value}.s || '{letter}'}}"


def _least(*values: str) -> str:
    return f"list_sort([{', '.join(values)}])[1]"


# q0: nothing yet, q1: after a system row, q2: after a user row, q3: after an assistant row; each holds the least
# (cost, letters) that ends there. "K" and "R" give a row of the role that stands before the state they end in.
_FAR = "{'c': 1000000000, 's': ''}"
_KEPT = "(CASE WHEN sym = '{c}' THEN extra ELSE 1000000000 END)"
_PUT = "(CASE WHEN sym = '' THEN 1000000000 ELSE 3 + extra END)"
OP12_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
  FROM range(256) AS t(i)),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (
  SELECT raw.*, xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), lambda i: CAST(ord(substr(k, i, 1)) AS BIGINT))),
           lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) % 20 AS fault FROM raw, crc),
rows AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, unnest(CASE WHEN fault = 0 THEN [] WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS u(n)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv FROM rows),
judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
         lag({_INITIALS}) OVER (PARTITION BY conv ORDER BY i) || {_INITIALS} AS pair FROM numbered),
marked AS (
  SELECT conv, i, role, text, CASE WHEN blank OR again THEN '' ELSE 'x' || {_INITIALS} END AS mark,
         CASE WHEN cut THEN 3 ELSE 0 END AS extra FROM judged),
steps AS (SELECT conv, i, CASE WHEN mark = '' THEN '' WHEN substr(mark, 2) IN ('s', 'u', 'a') THEN substr(mark, 2) ELSE 'o' END AS sym, extra FROM marked),
dp AS (
  SELECT DISTINCT conv, CAST(0 AS BIGINT) AS i, {{'c': 0, 's': ''}} AS q0, {_FAR} AS q1, {{'c': 3, 's': 'I'}} AS q2, {{'c': 6, 's': 'II'}} AS q3 FROM steps
  UNION ALL
  SELECT conv, i, q0, q1, q2, {_least("q3", _step("q2", "3", "I"))} AS q3 FROM (
    SELECT conv, i, q0, q1, {_least("q2", _step("q0", "3", "I"), _step("q1", "3", "I"), _step("q3", "3", "I"))} AS q2, q3 FROM (
      SELECT conv, steps.i, {_step("q0", "4", "D")} AS q0,
        {_least(_step("q1", "4", "D"), _step("q0", _KEPT.format(c="s"), "K"))} AS q1,
        {_least(_step("q2", "4", "D"), *(_step(q, c, x) for q in ("q0", "q1", "q3") for c, x in ((_KEPT.format(c="u"), "K"), (_PUT, "R"))))} AS q2,
        {_least(_step("q3", "4", "D"), _step("q2", _KEPT.format(c="a"), "K"), _step("q2", _PUT, "R"))} AS q3
      FROM dp JOIN steps USING (conv) WHERE steps.i = dp.i + 1))),
ends AS (SELECT conv, max(i) AS i FROM steps GROUP BY conv),
best AS (SELECT conv, {_least("q0", "q3")} AS b FROM dp JOIN ends USING (conv, i)),
letters AS (SELECT conv, p, substr(b.s, p, 1) AS x FROM best, unnest(range(1, length(b.s) + 1)) AS u(p)),
placed AS (
  SELECT *, count(*) FILTER (x <> 'I') OVER (PARTITION BY conv ORDER BY p) AS i,
         count(*) FILTER (x <> 'D') OVER (PARTITION BY conv ORDER BY p) AS o FROM letters),
made AS (
  SELECT l.conv, l.p, l.x, l.o, r.role, CASE WHEN l.x = 'I' THEN '' ELSE r.text END AS text,
         max(CASE WHEN l.o = 1 AND l.x = 'K' AND left(r.role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv) AS shift
  FROM placed l LEFT JOIN marked r ON r.conv = l.conv AND r.i = l.i AND l.x <> 'I'),
lines AS (
  SELECT conv, string_agg(CASE WHEN x = 'K' THEN role WHEN (o - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
         chr(10) ORDER BY p) AS body FROM made WHERE x <> 'D' GROUP BY conv),
counts AS (
  SELECT conv, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
         count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv),
convs AS (SELECT DISTINCT conv_id FROM conversations)
SELECT convs.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.s, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM convs LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM convs.conv_id LEFT JOIN best USING (conv) LEFT JOIN lines USING (conv)
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return filter_audit.audit(filter_audit.survivors(filter_audit.facts(docs, labels)))


OP13_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS bad FROM d),
g AS (
  SELECT part, bad, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
o(filter_order) AS (
  SELECT '' UNION ALL
  SELECT filter_order || c FROM o, unnest(['A', 'B', 'C', 'D', 'E']) AS u(c) WHERE length(filter_order) < 5 AND NOT contains(filter_order, c)),
s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS c, left(filter_order, step - 1) AS before
  FROM o, unnest(range(1, 6)) AS u(step) WHERE length(filter_order) = 5),
x AS (
  SELECT part, filter_order, step, c, n, good, toxic, contains(bad, c) AS fails, bad = c AS only_this,
         length(translate(bad, before, '')) < length(bad) AS gone FROM g, s),
y AS (
  SELECT part, filter_order, step, c,
         sum(CASE WHEN gone OR fails THEN 0 ELSE n END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN only_this THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT gone AND good = 1 THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails AND NOT gone AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM x GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM y
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_pitman_yor": op2_pitman_yor,
    "op3_url_filter": op3_url_filter,
    "op4_pii": op4_pii,
    "op5_token_counts": op5_token_counts,
    "op6_compression_quality": op6_compression_quality,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op3_url_filter": OP3_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op9_minhash_near_dedup": OP9_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
