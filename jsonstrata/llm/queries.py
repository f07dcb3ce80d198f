"""The operators over the test tables, with their SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from jsonstrata.llm import covertree, decontamination, kdtree, langid, lines, mixing, neardup, personal, secrets, sentences, sharding, suffixes, trie
from jsonstrata.llm.frames import table
from jsonstrata.queries.frames import Query


def held_out() -> Column:
    """Documents that language identification must not learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    found = langid.identify(docs, model)
    return found.select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans")
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_site_lines(table(spark, sf_dir, "pages"))


OP2_SQL = rf"""
WITH shown AS (
  SELECT row_number() OVER () AS r, page_id,
         coalesce(lower(regexp_extract(url, '{lines.HOST}', 1)), '') AS host,
         regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '{lines.HIDDEN}', chr(10), 'g'),
           '{lines.BREAKS}', chr(10), 'g'), '{lines.TAGS}', '', 'g') AS shown
  FROM pages),
split AS (
  SELECT r, page_id, host, list_filter(list_transform(string_split_regex(shown, '[\r\n]+'),
         lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'), ' ')), lambda x: x <> '') AS lines
  FROM shown),
counted AS (
  SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM split) GROUP BY ALL),
hosts AS (SELECT host, count(*) AS pages FROM split GROUP BY host),
dropped AS (
  SELECT host, list(line) AS dropped FROM counted JOIN hosts USING (host)
  WHERE n >= 3 AND n > 0.2 * pages GROUP BY host),
kept AS (
  SELECT page_id, host, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(dropped, []), x)) AS stays
  FROM split LEFT JOIN dropped USING (host))
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(stays))::BIGINT AS n_removed,
       array_to_string(stays, chr(10)) AS kept
FROM kept"""


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentences.drop_repeated_sentences(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.col("kept").cast("string").alias("kept"),
    )


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.drop_repeated_strings(table(spark, sf_dir, "documents"), length=50)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: Bytes are pairs of hexadecimal digits here.
OP4_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS p FROM d),
strings AS (SELECT doc_id, p, md5(h[2 * p + 1:2 * p + 100]) AS s FROM starts),
firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s),
hits AS (SELECT doc_id, p FROM strings JOIN firsts USING (s) WHERE first < doc_id),
marked AS (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 50, true)::INT AS new FROM hits),
numbered AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY doc_id, run),
edges AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs
  UNION ALL
  SELECT doc_id, len(h) // 2, NULL, coalesce((SELECT max(b) FROM runs WHERE runs.doc_id = d.doc_id), 0) FROM d),
kept AS (
  SELECT doc_id, string_agg(h[2 * before + 1:2 * a], '' ORDER BY a, b NULLS LAST) AS k, count(b) AS n_spans
  FROM edges JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, ((len(h) - len(k)) // 2)::BIGINT AS n_removed,
       n_spans::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id)"""


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return kdtree.nearest(rows, rows.where("vec_id % 50 = 0"), k=5)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ordered WHERE rank <= 5"""


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Shards of the contract.
SHARDS = 40


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents"), None
    # Two increments over all documents: a rule is new in the second, so only its pairs are scanned then.
    for rules in (secrets.RULES[:-1], secrets.RULES):
        paths, ledger = secrets.update(docs, ledger, rules)
    found = ledger.current()
    spans = F.coalesce(F.col("spans"), F.array().cast("array<struct<start:bigint,rule:bigint,kind:string,end:bigint>>"))
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return secrets.per_path(paths, found).select(
        F.col("path").alias("doc_id"),
        *(count(rule.kind).alias(f"n_{rule.kind}") for rule in secrets.RULES),
        F.sha2(text.cast("binary"), 256).alias("base_sha256"),
        text.alias("spans"),
    )


def _op8_sql() -> str:
    parts = []
    for number, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT r, {number} AS rule, '{rule.kind}' AS kind, unnest(range(1, len(whole) + 1)) AS i, gaps, whole, tested, {rule.least} AS least
  FROM (SELECT r, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS whole,
               regexp_extract_all(t, '{pattern}', {rule.group}) AS tested
        FROM docs WHERE regexp_matches(t, '{pattern}'))""")
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matched AS ({" UNION ALL ".join(parts)}),
placed AS (
  SELECT r, rule, kind, tested[i] AS tested, least, length(whole[i]) AS n,
         sum(length(gaps[i]) + length(whole[i])) OVER (PARTITION BY r, rule ORDER BY i) AS stop
  FROM matched),
held AS (
  SELECT r, rule, kind, (stop - n)::BIGINT AS start, stop::BIGINT AS stop FROM placed WHERE length(tested) >= least),
joined AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c,
         count(*) FILTER (kind = 'hex') AS h,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rule) AS spans
  FROM held GROUP BY r)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)"""


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), most=3, seed=0)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"), F.col("sources")[0].alias("source")
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


OP10_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM split),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS k
  FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 85 * (n + m - k)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN lowest ON doc_id = a"""


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_personal(table(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *(F.size(of([kind.name])).cast("long").alias(f"n_{kind.name}") for kind in personal.KINDS),
        F.sha2(text(of(personal.BASE)).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0)).cast("long").alias("max_score"),
    )


#: The plain patterns, the group that is tested, and the test, apart from those of the operator.
_OP11_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "len(list_filter(string_split(m, '.'), lambda p: len(ltrim(p, '0')) > 3 OR try_cast('0' || right(p, 3) AS INT) > 255)) = 0",
    ),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        "len(translate(m, ' -', '')) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, len(translate(m, ' -', '')) + 1),"
        " lambda i: CASE WHEN i % 2 = 1 THEN reverse(translate(m, ' -', ''))[i]::INT"
        " ELSE 2 * reverse(translate(m, ' -', ''))[i]::INT - 9 * (reverse(translate(m, ' -', ''))[i]::INT > 4)::INT END)) % 10 = 0",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 8 AND 15"),
    "iban": (
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,}|(?:\x20[A-Z0-9]{4})+(?:\x20[A-Z0-9]{1,3})?)",
        "len(replace(m, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform("
        "string_split_regex(substr(replace(m, ' ', ''), 5) || left(replace(m, ' ', ''), 4), ''), lambda c: ascii(c))),"
        " lambda a, c: CASE WHEN c < 65 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1"
        " AND NOT regexp_matches(b, '[A-Za-z0-9]$') AND NOT regexp_matches(f, '^[A-Za-z0-9]')",
    ),
    "ssn": (
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$') AND NOT regexp_matches(b, '[A-Za-z0-9]$') AND NOT regexp_matches(f, '^[A-Za-z0-9]')",
    ),
}


def _op11_sql() -> str:
    parts, judged, counts = [], [], []
    for number, kind in enumerate(personal.KINDS):
        pattern, valid = _OP11_KINDS[kind.name]
        near = personal.near_pattern(kind)
        lower = f"translate({{}}, '{personal.UPPER}', '{personal.UPPER.lower()}')"
        raised = " OR ".join(f"regexp_matches({lower.format(x)}, '{near}')" for x in (f"right(b, {personal.NEAR})", f"left(f, {personal.NEAR})"))
        parts.append(f"""
  SELECT r, {number} AS rank, unnest(range(1, len(whole) + 1)) AS i, gaps, whole
  FROM (SELECT r, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS whole
        FROM docs WHERE regexp_matches(t, '{pattern}'))""")
        judged.append(f"""
  SELECT r, rank, '{kind.name}' AS kind, stop - len(m) AS start, stop, {kind.score} + CASE WHEN {raised} THEN {personal.NEARBY} ELSE 0 END AS score
  FROM placed WHERE rank = {number} AND CASE WHEN rank = {number} THEN {valid} END""")
        counts.append(f"coalesce(count(kind) FILTER (kind = '{kind.name}'), 0)::BIGINT AS n_{kind.name}")
    spans = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY rank, start) {}, '')"
    base = ", ".join(f"'{kind}'" for kind in personal.BASE)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matched AS ({" UNION ALL ".join(parts)}),
placed AS (
  SELECT r, rank, whole[i] AS m, gaps[i] AS b, gaps[i + 1] AS f,
         (sum(length(gaps[i]) + length(whole[i])) OVER (PARTITION BY r, rank ORDER BY i))::BIGINT AS stop
  FROM matched),
held AS ({" UNION ALL ".join(judged)})
SELECT doc_id, {", ".join(counts)}, sha256({spans.format(f"FILTER (kind IN ({base}))")}) AS base_sha256, {spans.format("")} AS spans,
       coalesce(max(score), 0)::BIGINT AS max_score
FROM docs LEFT JOIN (SELECT * FROM held WHERE score >= 40) USING (r) GROUP BY r, doc_id"""


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return covertree.hard_negatives(rows, rows.where("vec_id % 50 = 0"))


OP12_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.steps(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(*trie.with_heads(turns))


#: CRC-32 bit by bit: each byte enters with the first of its eight steps.
OP13_SQL = """
WITH turns AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         strlen(coalesce(text, '')) AS n_bytes
  FROM conversations WHERE conv_id IS NOT NULL),
steps AS (SELECT conv_id, k, n_bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS at FROM turns),
convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS head,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
           string_split_regex(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, v: xor(xor(a, v) >> 1, CASE WHEN xor(a, v) % 2 = 1 THEN 3988292384 ELSE 0 END))) % 9 AS h
  FROM steps),
built AS (
  SELECT c.conv_id, s.at AS depth, k, n_bytes FROM convs c JOIN steps s ON s.conv_id = c.head AND s.at <= c.h
  UNION ALL
  SELECT c.conv_id, s.at - c.h + (SELECT count(*) FROM steps t WHERE t.conv_id = c.head AND t.at <= c.h), k, n_bytes
  FROM convs c JOIN steps s ON s.conv_id = c.conv_id AND s.at > c.h),
paths AS (
  SELECT conv_id, depth, n_bytes, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth) AS p FROM built
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
nodes AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(n_bytes) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends
  FROM paths JOIN lengths USING (conv_id) GROUP BY p, depth),
linked AS (
  SELECT n.*, u.p AS above, u.conv_id AS parent FROM nodes n LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.p = left(n.p, 32 * u.depth)),
children AS (SELECT above, count(*) AS n FROM linked WHERE depth > 0 GROUP BY above),
totals AS (
  SELECT a.p, sum(n.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM nodes n JOIN paths a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN children c ON c.above = n.p GROUP BY a.p)
SELECT conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs, coalesce(c.n, 0)::BIGINT AS n_children, t.leaves::BIGINT AS n_leaves,
       t.saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM linked l JOIN totals t ON t.p = l.p LEFT JOIN children c ON c.above = l.p"""


CATALOGUE: dict[str, Query] = {
    "op1_language_spans": Query(op1, None),
    "op2_site_line_dedup": Query(op2, OP2_SQL),
    "op3_sentence_spans": Query(op3, None),
    "op4_bucket_refinement": Query(op4, OP4_SQL),
    "op5_kdtree_top_k": Query(op5, OP5_SQL),
    "op6_string_tiling": Query(op6, None),
    "op7_best_fit_shards": Query(op7, None),
    "op8_blob_ledger": Query(op8, _op8_sql()),
    "op9_flow_mix": Query(op9, None),
    "op10_similarity_sketch": Query(op10, OP10_SQL),
    "op11_personal_spans": Query(op11, _op11_sql()),
    "op12_cover_tree_negatives": Query(op12, OP12_SQL),
    "op13_prefix_trie": Query(op13, OP13_SQL),
    "pipeline": Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
