"""Registered queries of the package, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cover_search, hard_negatives, licenses, line_dedup, line_runs, packing, perplexity, piece_scan, secrets_forest, simhash, toxicity, url_globs, variants
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn=None, *, sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add(fn) if fn else add


@query
def op4_packing(spark, sf_dir):
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


@query
def op1_perplexity(spark, sf_dir):
    return perplexity.judge(table(spark, sf_dir, "documents"))


@query
def op2_simhash(spark, sf_dir):
    return simhash.near_copies(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op5_piece_scan(spark, sf_dir):
    """Chunks of every text: digests of the ids and of the text that decoding them gives back."""
    both = piece_scan.decode(piece_scan.encode(table(spark, sf_dir, "documents")))
    return both.select("doc_id", "chunk", "start", "n_chars", (F.length("ids") / 4).cast("long").alias("n_pieces"),
                       F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


@query(sql=r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i, len(string_split(text, chr(10))) AS m FROM documents
), placed AS (
  SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS b, CASE WHEN i < m THEN 1 ELSE 0 END AS tail,
         string_split(regexp_replace(line, '([.!?]+[ \t]+)', '\1' || chr(1), 'g'), chr(1)) AS parts
  FROM lines
), sentences AS (
  SELECT doc_id, i, b, tail, unnest(parts) AS line, generate_subscripts(parts, 1) AS j, len(parts) AS k FROM placed WHERE len(parts) > 1
), units AS (
  SELECT doc_id, b AS s, b + length(line) + tail AS e, line, 5 AS least FROM placed
  UNION ALL SELECT doc_id, b + sum(length(line)) OVER (PARTITION BY doc_id, i ORDER BY j) - length(line),
    b + sum(length(line)) OVER (PARTITION BY doc_id, i ORDER BY j) + CASE WHEN j = k THEN tail ELSE 0 END, line, 8 FROM sentences
), normed AS (
  SELECT *, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS norm FROM units
), ranked AS (
  SELECT *, first_value(doc_id) OVER g AS first_doc, first_value(s) OVER g AS first_s FROM normed
  WHERE len(string_split(norm, ' ')) >= least WINDOW g AS (PARTITION BY norm ORDER BY doc_id, s)
)
SELECT doc_id, CAST(s AS BIGINT) AS span_start, CAST(e AS BIGINT) AS span_end, first_doc AS first_doc_id, CAST(first_s AS BIGINT) AS first_start
FROM ranked WHERE doc_id > first_doc OR (doc_id = first_doc AND s > first_s)""")
def op6_line_dedup(spark, sf_dir):
    """Spans that go, with the place of the occurrence that stays; ``line_dedup.clean`` gives the cleaned texts."""
    found = line_dedup.find_repeats(table(spark, sf_dir, "documents"))
    return found.select(found["_doc"].alias("doc_id"), found["start"].alias("span_start"), found["end"].alias("span_end"),
                        found["first_doc"].alias("first_doc_id"), "first_start")


@query
def op7_licenses(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs.withColumn("_file", path), "_file")


@query
def op8_secrets_forest(spark, sf_dir):
    """Every candidate finding with the forest's score; ``secrets_forest.redact`` gives the cleaned texts."""
    found = secrets_forest.scan(table(spark, sf_dir, "documents"))
    end = found["start"] + F.length("candidate")
    return found.select(found["_doc"].alias("doc_id"), found["start"].alias("span_start"), end.alias("span_end"), "candidate", "score", "is_secret")


@query(sql="""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^([^/?#]*)([^?#]*)', 2) AS path
  FROM rest
), ruled AS (
  SELECT *, CASE
    WHEN '.' || host LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN '.' || host LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN '.' || host LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN '.' || host LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN '.' || host LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN host LIKE '%cheap-%' OR host LIKE '%spam-%' OR host LIKE '%casino%' THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""")
def op9_url_globs(spark, sf_dir):
    return url_globs.judge(table(spark, sf_dir, "pages"))


@query(sql="""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""")
def op10_cover_search(spark, sf_dir):
    return cover_search.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


@query(sql=r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT doc_id, line, i, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def op12_line_runs(spark, sf_dir):
    left = line_runs.drop_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query(sql=r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS t FROM range(256) r(i)
), bytes AS (
  SELECT *, flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c) - 64] END)) AS b FROM counted
), drawn AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, z: xor(c >> 8, t[1 + (xor(c, z) & 255)]))) AS h FROM bytes, crc_table
), words AS (
  SELECT w AS word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS w, n FROM drawn)
  WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2
), skips AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT x.word, y.word AS other, y.n FROM skips x JOIN skips y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM skips x JOIN words y ON x.a || x.z = y.word
  UNION SELECT y.word, x.word, x.n FROM skips x JOIN words y ON x.a || x.z = y.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near GROUP BY word
), formed AS (
  SELECT words.word, CASE WHEN other_n >= 10 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM words UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.root WHERE formed.form IS NOT NULL
), lasts AS (
  SELECT chain.word, root FROM chain JOIN formed ON formed.word = chain.root AND formed.form IS NULL
)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM formed JOIN lasts USING (word)""")
def op13_variants(spark, sf_dir):
    """Distinct words of all texts, each with its near words' number, its more frequent form and the end of the chain of forms."""
    return variants.variants(variants.word_counts(table(spark, sf_dir, "documents"), slip_every=31))


@query(sql="""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.row, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM a.vec_id
), positives AS (
  SELECT row, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
), ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY row, place ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (row, anchor_id) WHERE place <= 5 AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5""")
def op11_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), lambda i: i % 100 == 0)
