"""Registered queries of the training-data operators, with production
parameters over whole tables, and their DuckDB oracles where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.llm import (decontaminate, fill_middle, html_extract, jaccard_join, mixing, quality, spelling, substring_dedup, suffix_dedup, token_output,
                          topk_search, toxicity, url_filter)
from textkiln.llm.common import doc_remainder, table
from textkiln.llm.page_labels import labelled_pages
from textkiln.llm.url_labels import labelled_urls
from textkiln.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op3_decontaminate", r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
dw AS (SELECT doc_id, coalesce(ws, []) AS ws FROM w),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT item_id, least(10, len(ws)) AS size, unnest(list_transform(range(1, len(ws) - least(10, len(ws)) + 2), lambda i: list_slice(ws, i, i + least(10, len(ws)) - 1))) AS g
  FROM b WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM win),
dwin AS (
  SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS i, ws FROM dw, sizes WHERE len(ws) >= size),
hit AS (SELECT d.doc_id, d.i, d.size, w.item_id FROM dwin d JOIN win w ON d.size = w.size AND list_slice(d.ws, d.i, d.i + d.size - 1) = w.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
""")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


@query("op4_mix")
def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic").filter(doc_remainder("doc_id", 4) != 2))
    return toxicity.judged(toxicity.score(docs, lexicon), 4, 2).select("doc_id", "held_out", "score", "predicted", "n_hits")


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality").filter(doc_remainder("doc_id", 5) != 0))
    return toxicity.judged(quality.score(docs, model), 5, 0).select("doc_id", "held_out", "score", "predicted")


@query("op7_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(ws) - 3, 1) + 1), lambda i: array_to_string(list_slice(ws, i, i + 3), ' '))) AS g
  FROM w WHERE len(ws) > 0),
n AS (SELECT w.doc_id, coalesce(len(g), 0) AS n FROM w LEFT JOIN s USING (doc_id)),
classes AS (SELECT min(doc_id) AS rep, list_sort(g) AS g, len(g) AS n FROM s GROUP BY 2, 3),
members AS (SELECT s.doc_id, c.rep FROM s JOIN classes c ON list_sort(s.g) = c.g),
t AS (SELECT rep, n, unnest(g) AS h FROM classes),
links AS (
  SELECT a.rep AS x, b.rep AS y FROM t a JOIN t b ON a.h = b.h AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (SELECT rep, rep FROM classes UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x),
label AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, coalesce(label.c, n.doc_id) AS component_id
FROM n LEFT JOIN members USING (doc_id) LEFT JOIN label ON members.rep = label.a
""")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"), url_filter.fit(labelled_urls(spark)))


@query("op9_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


@query("op10_extract")
def op10_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"), html_extract.fit(labelled_pages()))


@query("op11_fill_middle", r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || CAST(doc_id AS VARCHAR)) AS s
  FROM documents),
h AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4
  FROM u),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT doc_id, n, form, text, array_to_string(list_slice(w, 1, a), '') AS pre, array_to_string(list_slice(w, a + 1, b), '') AS mid,
         array_to_string(list_slice(w, b + 1, n), '') AS suf
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
""")
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.report(table(spark, sf_dir, "documents", "doc_id", "text")).drop("n_lines")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op12_token_output")
def op12_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    token_output.write(table(spark, sf_dir, "documents", "doc_id", "text"), path, _tokenizer())
    return token_output.report(token_output.read(spark, path))


# Near words in SQL: words that agree but for one replaced character share the
# rest at the same place; a word is the rest of its longer neighbour.  The crc32
# goes over half bytes with a table of 16 values.
@query("op13_spelling", r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)),
own AS (SELECT run, count(*) AS n, hex(CAST(doc_id AS VARCHAR) || ':' || run) AS x FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || list_transform(range(1, strlen(x) + 1),
           lambda i: CAST(instr('0123456789ABCDEF', substr(x, CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END, 1)) - 1 AS BIGINT)),
           lambda c, d: xor(t[1 + (xor(c, d) & 15)], c >> 4))) AS h
  FROM own, crc_table),
kept AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM kept WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cut c JOIN w ON c.rest = w.word
  UNION
  SELECT w.word, c.word, c.n FROM cut c JOIN w ON c.rest = w.word),
best AS (
  SELECT word, n_near, other, other_n
  FROM (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS rk FROM near) WHERE rk = 1),
judged AS (
  SELECT w.word, CASE WHEN other_n >= 5 * w.n THEN other END AS form, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM w LEFT JOIN best USING (word)),
path(word, cur, step) AS (
  SELECT word, word, 0 FROM judged UNION ALL SELECT p.word, j.form, p.step + 1 FROM path p JOIN judged j ON j.word = p.cur WHERE j.form IS NOT NULL),
ends AS (SELECT word, arg_max(cur, step) AS root FROM path GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)
""")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents", "doc_id", "text"))
