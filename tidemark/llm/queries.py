"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from . import conversations, exact_dedup, filter_audit, language, minhash, mixing, packing, secret_scan, sharding, substrings, vectors, warc, wordpiece
from .common import staged

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT norm, arg_max(doc_id, (points, -doc_id)) AS keep_id, count(*) AS group_size
  FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm""")
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


@register("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    return wordpiece.token_counts(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"))


@register("op3_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
last AS (SELECT html, max(page_id) AS last FROM p GROUP BY html)
SELECT page_id, strlen(p.html) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    (('0x' || substr(hex, 1 + 5 * (i // 4)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM p JOIN last ON p.html = last.html""")
def op3_warc(spark, sf_dir):
    """Archives every page, then reads the archives back, unpacking and verifying each payload."""
    path = fresh_path(spark, "warc")
    warc.write_archives(warc.planned_records(table(spark, sf_dir, "pages")), path)
    columns = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return warc.read_archives(spark, path, columns, verify=True)


#: Over bytes as pairs of hexadecimal digits; windows are cut from short pieces, as places in a long text are found by counting.
@register("op4_repeated_passages", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (
  SELECT doc_id, base, substr(h, 2 * base + 1, 1198) AS p
  FROM (SELECT doc_id, h, unnest(range(0, greatest(strlen(h) // 2 - 99, 0), 500)) AS base FROM d)),
w AS (
  SELECT doc_id, base + i AS i, substr(p, 2 * i + 1, 200) AS g
  FROM (SELECT doc_id, base, p, unnest(range(0, strlen(p) // 2 - 99)) AS i FROM pieces)),
again AS (SELECT g, min({'d': doc_id, 'i': i}) AS first FROM w GROUP BY g HAVING count(*) > 1),
covered AS (
  SELECT doc_id, i, i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 AS fresh
  FROM w JOIN again ON w.g = again.g WHERE first <> {'d': doc_id, 'i': i}),
runs AS (
  SELECT doc_id, min(i) AS low, max(i) + 100 AS high FROM (
    SELECT doc_id, i, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM covered)
  GROUP BY doc_id, run),
cuts AS (
  SELECT doc_id, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY low) AS low, low AS high FROM runs
  UNION ALL SELECT d.doc_id, coalesce(max(r.high), 0), any_value(strlen(d.h)) // 2
  FROM d LEFT JOIN runs r ON r.doc_id = d.doc_id GROUP BY d.doc_id),
kept AS (
  SELECT d.doc_id, string_agg(substr(d.h, 2 * c.low + 1, 2 * (c.high - c.low)), '' ORDER BY c.low) AS h, count(*) - 1 AS n
  FROM d JOIN cuts c ON c.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, strlen(d.h) // 2 AS n_bytes, strlen(d.h) // 2 - strlen(k.h) // 2 AS n_removed, k.n AS n_spans,
  sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN kept k ON k.doc_id = d.doc_id""")
def op4_repeated_passages(spark, sf_dir):
    cut = substrings.without_repeats(table(spark, sf_dir, "documents"), keep_text=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op5_language")
def op5_language(spark, sf_dir):
    """Learns from the rows that are not held out, and predicts all rows from their text alone."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    net = language.fit(docs.filter(~held_out))
    rows = docs.select(F.struct("doc_id", held_out.alias("held_out")).alias("row"), "text")
    return language.predicted(rows, net).select("row.*", "lang_pred", "score")


@register("op6_near_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a, b FROM ways UNION SELECT r.a, v.b FROM reached r JOIN ways v ON r.b = v.a),
least AS (SELECT a, min(b) AS low FROM reached GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) AS component_id,
  w.doc_id <= coalesce(low, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least ON a = w.doc_id""")
def op6_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op7_shuffle_shards")
def op7_shuffle_shards(spark, sf_dir):
    """Law ``rows``: the shards are stretches of one random order, with counts at most one apart."""
    shards = sharding.shuffled_shards(table(spark, sf_dir, "documents"), shards=24, seed=7)
    text = F.col("row.text").cast("binary")
    return shards.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op8_best_fit_packing")
def op8_best_fit_packing(spark, sf_dir):
    """Ids come by default from the vocabulary's rank file; ``tokens`` says why they are the same."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.packed(staged(narrow, "pieces"))


@register("op9_source_mix")
def op9_source_mix(spark, sf_dir):
    return mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents"), seed=9))


#: Every pair; on larger tables than the oracle's the index may miss some.
@register("op10_vector_links", """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
ok AS (
  SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0
    AND len(list_filter(x, lambda y: y <> 0)) > 0),
ways AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
reached AS (
  SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reached r JOIN ways w ON r.b = w.a),
least AS (SELECT a, min(b) AS low FROM reached GROUP BY a),
n AS (SELECT a, count(*) AS n FROM ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id <= coalesce(low, vec_id) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id""")
def op10_vector_links(spark, sf_dir):
    return vectors.linked_vectors(table(spark, sf_dir, "embeddings"))


@register("op11_conversation_repair", r"""
WITH RECURSIVE planted AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda s, b: list_reduce(list_prepend(xor(s, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda d, z: xor(d // 2, (d % 2) * 3988292384::BIGINT))), 4294967295::BIGINT) % 20 AS kind
  FROM conversations),
kept AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM planted WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending,
    role[1] AS initial FROM kept),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
faults AS (
  SELECT *, ending = '' AS blank, ending <> '' AND again AS duplicate,
    ending NOT IN ('', '.', '!', '?') AS cut FROM seen),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (cut AND NOT duplicate) AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
wanted(state, role, next) AS (VALUES ('0', 'user', 'u'), ('s', 'user', 'u'), ('u', 'assistant', 'a'), ('a', 'user', 'u')),
inserts AS (
  SELECT state AS prev, state AS mid, '' AS ext, '' AS lines, 0 AS more FROM wanted
  UNION ALL SELECT state, next, 'I', chr(10) || role || ':', 5 FROM wanted
  UNION ALL SELECT w.state, x.next, 'II', chr(10) || w.role || ':' || chr(10) || x.role || ':', 10
  FROM wanted w JOIN wanted x ON x.state = w.next),
paths AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '0' AS state, 0::BIGINT AS cost, '' AS audit, '' AS doc FROM conversations
  UNION ALL
  SELECT conv_id, i, state, cost, audit, doc FROM (
    SELECT p.conv_id, f.i, o.state, p.cost + s.more + o.cost AS cost, p.audit || s.ext || o.letter AS audit,
      p.doc || s.lines || o.line AS doc
    FROM paths p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
    JOIN inserts s ON s.prev = p.state JOIN wanted w ON w.state = s.mid,
    LATERAL (
      SELECT 'D' AS letter, s.mid AS state, 2 AS cost, '' AS line
      UNION ALL SELECT 'K', f.initial, CASE WHEN f.cut THEN 5 ELSE 0 END, chr(10) || f.role || ':' || f.text
        WHERE NOT f.blank AND NOT f.duplicate AND (f.initial = w.next OR s.mid = '0' AND f.initial = 's')
      UNION ALL SELECT 'R', w.next, CASE WHEN f.cut THEN 6 ELSE 1 END, chr(10) || w.role || ':' || f.text
        WHERE NOT f.blank AND NOT f.duplicate) o)
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
ends AS (
  SELECT p.conv_id, p.cost + s.more AS cost, p.audit || s.ext AS audit, p.doc || s.lines AS doc
  FROM paths p LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id
  JOIN inserts s ON s.prev = p.state AND s.mid IN ('0', 'a') WHERE p.i = coalesce(c.n, 0)
  QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + s.more, p.audit || s.ext) = 1)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(substr(doc, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id""")
def op11_conversation_repair(spark, sf_dir):
    turns = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.audits(turns, gone=F.col("gone"))


@register("op12_filter_audit", r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda w: w <> '') AS words FROM documents),
l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels
  WHERE doc_id IS NOT NULL GROUP BY doc_id),
least AS (SELECT text, min(doc_id) AS low FROM d GROUP BY text),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(l.toxic, false) AS toxic,
    [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
     100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 5 * length(d.text),
     regexp_matches(d.text, '[#$%&*|]'), coalesce(d.doc_id > low, false)] AS fails
  FROM d JOIN least ON d.text = least.text LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m GROUP BY part, fails),
letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own,
    list_transform(string_split(left(filter_order, step - 1), ''), lambda y: ascii(y) - 64) AS earlier
  FROM orders, range(1, 6) r(step)),
each AS (
  SELECT c.*, filter_order, step, fails[own] AS fail,
    len(list_filter(earlier, lambda i: i > 0 AND fails[i])) > 0 AS gone, len(list_filter(fails, lambda f: f)) AS failed
  FROM c, steps)
SELECT part, filter_order, step::INTEGER AS step,
  coalesce(sum(n) FILTER (NOT gone AND NOT fail), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (NOT gone AND fail), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (gone AND fail), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (fail AND failed = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (NOT gone AND fail), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (NOT gone AND fail), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * (120 // greatest(failed, 1))) FILTER (fail), 0)::BIGINT AS shapley
FROM each GROUP BY part, filter_order, step""")
def op12_filter_audit(spark, sf_dir):
    docs = filter_audit.stream_of(spark, f"{sf_dir}/documents.parquet")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"))


#: The contract's pattern, letters in either case written out, as a text in SQL.
_ASSIGN = (r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
           r"""|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


@register("op13_secret_scan", rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT r, 0 AS rank, 'assign' AS kind, 8 AS least, string_split_regex(text, '{_ASSIGN}') AS between,
    regexp_extract_all(text, '{_ASSIGN}', 0) AS whole, regexp_extract_all(text, '{_ASSIGN}', 2) AS judged FROM d
  UNION ALL SELECT r, 1, 'access', 16, string_split_regex(text, 'AKIA[A-Z0-9]+'),
    regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0), regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0) FROM d
  UNION ALL SELECT r, 2, 'hex', 32, string_split_regex(text, '[0-9a-f]+'),
    regexp_extract_all(text, '[0-9a-f]+', 0), regexp_extract_all(text, '[0-9a-f]+', 0) FROM d),
each AS (
  SELECT r, rank, kind, least, i, length(between[i]) AS skipped, length(whole[i]) AS long, length(judged[i]) AS size
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM found)),
ends AS (SELECT *, (sum(skipped + long) OVER (PARTITION BY r, rank ORDER BY i))::BIGINT AS stop FROM each),
lists AS (
  SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
    count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || (stop - long) || ':' || stop, ',' ORDER BY stop - long, rank) AS spans
  FROM ends WHERE size >= least GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN lists ON d.r = lists.r""")
def op13_secret_scan(spark, sf_dir):
    """The index adds no spans, so all are base ones."""
    found = secret_scan.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = secret_scan.listed(F.col("spans"))
    return found.select(
        "doc_id", *(secret_scan.counted(F.col("spans"), r.kind).alias(f"n_{r.kind}") for r in secret_scan.RULES),
        F.sha2(base, 256).alias("base_sha256"), base.alias("spans"))
