"""Registered queries of the operators: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, hard_negatives, jaccard_join, line_dedup, mixing, packing, quality_rules,
               ranked_search, secret_scans, simhash, token_counts, tool_calls, url_filters)
from .common import table

ORACLE: dict[str, str] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _hash(*parts: Column | str) -> Column:
    """24 bits of a digest that SQL can compute too: stands in for data that
    the tables lack (dates, tools)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 6), 16, 10).cast("long")


def _sql_hash(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 6) AS BIGINT)"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of each document."""
    import public_tokenizers
    return token_counts.count_lines(table(spark, sf_dir, "documents"),
                                    vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: The pages carry no fetch date and no list: both are derived from them.
FIRST_DAY = "2024-01-01"


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries for some of the hosts, domains and path prefixes of the
    pages: each is added, later removed or not, and may come back."""
    at = pages.select(F.coalesce(url_filters.host_of(F.col("url")), F.lit("")).alias("host"),
                      url_filters.segments(url_filters.path_of(F.col("url"))).alias("parts")
                      ).where("host <> ''")
    labels = F.split("host", r"\.")
    patterns = (
        at.select(F.lit("host").alias("kind"), F.col("host").alias("pattern"), F.lit(5).alias("every"))
        .unionByName(at.where(F.size(labels) >= 4).select(
            F.lit("domain").alias("kind"),
            F.array_join(F.slice(labels, -3, 3), ".").alias("pattern"), F.lit(6).alias("every")))
        .unionByName(at.where(F.size("parts") > 0).select(
            F.lit("prefix").alias("kind"),
            F.concat("host", F.lit("/"), F.get("parts", F.lit(0))).alias("pattern"),
            F.lit(7).alias("every")))
        .distinct().withColumn("h", _hash("kind", "pattern")).where("h % every = 0"))
    dated = patterns.withColumn("start", F.col("h") % 300)
    dated = dated.withColumn("events", F.expr("""concat(
        array(struct('add' AS action, start AS n)),
        if(h % 2 = 0, array(struct('remove' AS action, start + 20 + h % 60 AS n)), array()),
        if(h % 4 = 0, array(struct('add' AS action, start + 120 AS n)), array()))"""))
    event = F.explode("events").alias("event")
    return dated.select("kind", "pattern", event).select(
        "kind", "pattern", "event.action",
        F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("event.n").cast("int")).alias("day"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the entries active on its fetch day."""
    pages = table(spark, sf_dir, "pages")
    fetched = F.date_add(F.lit(FIRST_DAY).cast("date"), (_hash(F.col("page_id").cast("string")) % 366).cast("int"))
    out = url_filters.filter_captures(pages.withColumn("fetched", fetched), list_entries(pages))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("fetched", "since")})


ORACLE["op2_url_filters"] = rf"""
  WITH parts AS (
    SELECT page_id, url, date '{FIRST_DAY}' + CAST({_sql_hash('CAST(page_id AS VARCHAR)')} % 366 AS INT) AS fetched,
           rtrim(lower(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''),
             '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#\\]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '.') AS host,
           list_filter(string_split(regexp_extract(coalesce(url, ''),
             '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\\]*([^?#]*)', 1), '/'), lambda s: s <> '') AS segs
    FROM pages),
  pats AS (
    SELECT 'host' AS kind, host AS pattern, 5 AS every FROM parts WHERE host <> ''
    UNION SELECT 'domain', array_to_string(string_split(host, '.')[-3:], '.'), 6 FROM parts
      WHERE len(string_split(host, '.')) >= 4
    UNION SELECT 'prefix', host || '/' || segs[1], 7 FROM parts WHERE host <> '' AND len(segs) > 0),
  hashed AS (SELECT *, {_sql_hash('kind', 'pattern')} AS h FROM pats),
  events AS (
    SELECT kind, pattern, 'add' AS action, h % 300 AS n FROM hashed WHERE h % every = 0
    UNION ALL SELECT kind, pattern, 'remove', h % 300 + 20 + h % 60 FROM hashed WHERE h % every = 0 AND h % 2 = 0
    UNION ALL SELECT kind, pattern, 'add', h % 300 + 120 FROM hashed WHERE h % every = 0 AND h % 4 = 0),
  spans AS (
    SELECT kind, pattern, since, until FROM (
      SELECT *, lead(since) OVER (PARTITION BY kind, pattern ORDER BY since) AS until FROM (
        SELECT kind, pattern, date '{FIRST_DAY}' + CAST(n AS INT) AS since, bool_or(action = 'add') AS listed
        FROM events GROUP BY ALL))
    WHERE listed),
  hits AS (
    SELECT p.page_id, p.url, p.fetched, s.kind || ':' || s.pattern AS name, s.since
    FROM (SELECT DISTINCT page_id, url, fetched, host, segs FROM parts WHERE host <> '') p
    JOIN spans s ON s.since <= p.fetched AND (s.until IS NULL OR p.fetched < s.until)
     AND ((s.kind = 'host' AND p.host = s.pattern)
       OR (s.kind = 'domain' AND (p.host = s.pattern OR ends_with(p.host, '.' || s.pattern)))
       OR (s.kind = 'prefix' AND len(p.segs) > 0 AND p.host || '/' || p.segs[1] = s.pattern))),
  verdict AS (SELECT page_id, url, fetched, count(*) AS n_matches, min(name) AS matched, min(since) AS since
              FROM hits GROUP BY ALL)
  SELECT p.page_id, p.url, strftime(p.fetched, '%Y-%m-%d') AS fetched, p.host,
         v.n_matches IS NOT NULL AS blocked, coalesce(v.n_matches, 0) AS n_matches, v.matched,
         strftime(v.since, '%Y-%m-%d') AS since
  FROM parts p LEFT JOIN verdict v
    ON p.page_id IS NOT DISTINCT FROM v.page_id AND p.url = v.url AND p.fetched = v.fetched"""


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.scan(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents at root-tempered source weights, one epoch."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.tempered(docs))
    return mixed.select("doc_id", "source", "text", F.col("__copy").alias("copy"),
                        F.col("__copies").alias("copies"), F.col("__order").alias("shuffle_key"))


# Rates stay under one draw's step here, so the SQL draws once a document.
ORACLE["op5_mixing"] = """
  WITH s AS (SELECT source, count(*) AS n, sqrt(count(*)) AS w FROM documents GROUP BY source),
  r AS (SELECT source, w / sum(w) OVER () * sum(n) OVER () / n AS rate FROM s),
  k AS (SELECT source, rate, unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT))) AS k FROM r),
  c AS (SELECT source, sum(exp(-rate + k * ln(rate) - lgamma(k + 1)))
                 OVER (PARTITION BY source ORDER BY k) AS cdf FROM k),
  t AS (SELECT source, list(cdf) AS cdfs FROM c GROUP BY source),
  d AS (SELECT doc_id, d.source, text, cdfs,
               CAST('0x' || substr(md5('7|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|1'), 1, 13) AS BIGINT)
                 / 4503599627370496.0 AS u
        FROM documents d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
  e AS (SELECT doc_id, source, text, len(list_filter(cdfs, lambda c: c <= u)) AS copies FROM d)
  SELECT doc_id, source, text, copy, copies,
         md5('7s|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || CAST(copy AS VARCHAR)) AS shuffle_key
  FROM (SELECT *, unnest(generate_series(1, copies)) AS copy FROM e)"""


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op7_exact_dedup"] = """
  WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
  w AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
  SELECT doc_id, keep_id, group_size,
         doc_id IS NOT DISTINCT FROM keep_id
           AND row_number() OVER (PARTITION BY d.norm, doc_id) = 1 AS kept,
         sha256(d.norm) AS text_sha256
  FROM d JOIN w USING (norm)"""

def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_units(table(spark, sf_dir, "documents"), whole_lines=True)


#: Tools of the derived calls: (tool, arg, type, required, least, most).
TOOLS = (
    ("search", "query", "string", True, None, None),
    ("search", "limit", "integer", True, 1.0, 50.0),
    ("translate", "text", "string", True, None, None),
    ("translate", "to", "string", False, None, None),
    ("note", "body", "string", True, None, None),
    ("note", "words", "number", False, 0.0, None),
)


def tool_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from a chat: a user turn calls a tool with
    its text, the turn of the assistant behind it is the result.  Some calls
    use an earlier call's result, some are malformed, some form cycles."""
    turn = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))

    def ident(n):
        return F.concat(F.lit("call_"), F.substring(F.md5(F.concat_ws(
            "|", F.col("conv_id").cast("string"), n.cast("string"))), 1, 16))
    users = turn.where("role = 'user'").withColumn(
        "h", _hash(F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.lit("h")))
    words = F.size(F.split("text", " "))
    text = tool_calls.json_text(F.col("text"))
    tool = F.expr("element_at(array('search', 'translate', 'note', 'browse'), cast(h % 4 + 1 as int))")
    arguments = (
        F.when(F.col("h") % 11 == 0, F.concat(F.lit('{"query": '), text))
        .when((F.col("h") % 4 == 0) & (F.col("h") % 13 == 0), F.concat(F.lit('{"query": '), text, F.lit("}")))
        .when(F.col("h") % 4 == 0, F.concat(F.lit('{"query": '), text, F.lit(', "limit": '),
                                            words.cast("string"), F.lit("}")))
        .when(F.col("h") % 4 == 1, F.concat(F.lit('{ "to" : "en", "text" : '), text, F.lit(" }")))
        .when(F.col("h") % 4 == 2, F.concat(F.lit('{"words": "'), words.cast("string"), F.lit('", "body": '),
                                            text, F.lit(', "Tag": null}')))
        .otherwise(F.concat(F.lit('{"z": [1, true], "page": '), text, F.lit("}"))))
    after = F.when(F.col("h") % 29 == 0, ident(F.col("turn") + 2)).when(
        F.col("h") % 3 != 0, ident(F.col("turn") - 2))
    calls = users.select("conv_id", "turn", ident(F.col("turn")).alias("call_id"), tool.alias("tool"),
                         arguments.alias("arguments"), after.alias("after"))
    results = turn.where("role = 'assistant'").select(
        "conv_id", "turn", ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_turns(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(
        TOOLS, "tool string, arg string, type string, required boolean, least double, most double")
    return tool_calls.link(calls, results, schemas, later_rows=True)


def _sql_ident(turn: str) -> str:
    return f"'call_' || substr(md5(concat_ws('|', CAST(conv_id AS VARCHAR), CAST({turn} AS VARCHAR))), 1, 16)"


ORACLE["op10_tool_calls"] = f"""
  WITH RECURSIVE t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
  u AS (SELECT *, {_sql_hash("CAST(conv_id AS VARCHAR)", "CAST(turn AS VARCHAR)", "'h'")} AS h,
               {_sql_ident('turn')} AS call_id, len(string_split(text, ' ')) AS words,
               CAST(to_json(text) AS VARCHAR) AS j
        FROM t WHERE role = 'user'),
  c0 AS (SELECT conv_id, turn, call_id, ['search', 'translate', 'note', 'browse'][h % 4 + 1] AS tool,
           CASE WHEN h % 11 = 0 THEN CAST(to_json('{{"query": ' || j) AS VARCHAR)
                WHEN h % 4 = 0 AND h % 13 = 0 THEN '{{"query":' || j || '}}'
                WHEN h % 4 = 0 THEN '{{"limit":' || words || ',"query":' || j || '}}'
                WHEN h % 4 = 1 THEN '{{"text":' || j || ',"to":"en"}}'
                WHEN h % 4 = 2 THEN '{{"Tag":null,"body":' || j || ',"words":"' || words || '"}}'
                ELSE '{{"page":' || j || ',"z":[1,true]}}' END AS args,
           CASE WHEN h % 4 = 3 THEN 'unknown tool'
                WHEN h % 11 = 0 THEN 'bad arguments'
                WHEN h % 4 = 0 AND h % 13 = 0 THEN 'missing limit'
                WHEN h % 4 = 0 AND words > 50 THEN 'range limit'
                WHEN h % 4 = 2 THEN 'type words;unknown Tag' END AS fault,
           CASE WHEN h % 29 = 0 THEN {_sql_ident('turn + 2')}
                WHEN h % 3 <> 0 THEN {_sql_ident('turn - 2')} END AS after
         FROM u),
  c AS (SELECT c0.*, p.call_id AS up FROM c0 LEFT JOIN c0 p ON c0.after = p.call_id),
  l AS (SELECT call_id, 0 AS level FROM c WHERE up IS NULL
        UNION ALL SELECT c.call_id, l.level + 1 FROM c JOIN l ON c.up = l.call_id),
  a AS (SELECT conv_id, turn, {_sql_ident('turn - 1')} AS call_id, text AS content FROM t WHERE role = 'assistant'),
  f AS (SELECT coalesce(c.conv_id, a.conv_id) AS conv_id,
               CASE WHEN c.call_id IS NULL THEN a.turn ELSE c.turn END AS turn,
               coalesce(c.call_id, a.call_id) AS call_id, tool, args, fault, after, up, content,
               CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN a.call_id IS NULL THEN 'unanswered'
                    ELSE 'linked' END AS status,
               CASE WHEN c.call_id IS NOT NULL THEN coalesce(l.level, -1) END AS level
        FROM c LEFT JOIN l USING (call_id) FULL JOIN a ON c.call_id = a.call_id)
  SELECT conv_id, turn, call_id, tool, status, level,
         concat_ws(';', CASE WHEN after IS NOT NULL AND up IS NULL THEN 'after unknown' END,
                   CASE WHEN level = -1 THEN 'cycle' END, fault) AS errors,
         0 AS repeats,
         '{{"arguments":' || coalesce(args, 'null') || ',"call_id":"' || call_id || '","level":'
           || coalesce(CAST(level AS VARCHAR), 'null') || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null')
           || ',"tool":' || coalesce('"' || tool || '"', 'null') || '}}' AS record
  FROM f"""

def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

ORACLE["op11_ranked_search"] = f"""
  WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
  t AS (SELECT r, {_SQL_TERMS} FROM d),
  tf AS (SELECT r, term, count(*) AS tf FROM t GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  n AS (SELECT r, count(*) AS n FROM t GROUP BY r),
  total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
  m AS (SELECT r, 25 + (75 * n * docs) // terms AS m FROM n, total),
  items AS (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
  q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, {_SQL_TERMS} FROM items) GROUP BY ALL),
  s AS (SELECT i, item_id, r, CAST(sum(times * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
                 * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM q JOIN df USING (term) JOIN tf USING (term) JOIN m USING (r), total GROUP BY ALL),
  k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
        FROM s JOIN d USING (r) WHERE score > 0)
  SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM k WHERE rank <= 10"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; where the id is divisible by
    7, the label is the next one."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label))


ORACLE["op12_hard_negatives"] = """
  WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
           CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0) a JOIN v b ON a.vec_id <> b.vec_id),
  p AS (SELECT * FROM s WHERE own = label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
  SELECT p.anchor_id, p.vec_id AS positive_id,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank,
         n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM p JOIN s n ON p.anchor_id = n.anchor_id AND n.own <> n.label
   AND 80 * p.score <= 100 * n.score AND n.score <= p.score
  QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 5"""


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_url_filters, op3_secret_scans, op4_ngram_jaccard_join, op5_mixing, op6_packing,
    op7_exact_dedup, op8_quality_rules, op9_line_dedup, op10_tool_calls, op11_ranked_search,
    op12_hard_negatives, op13_simhash_near_dedup)}
