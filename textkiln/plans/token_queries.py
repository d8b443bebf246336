"""Queries for pretokens, BPE, the id stream and the next-token model
(SURVEY 2.5, 2.6, 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions.bytelevel import SPECIAL_ID, SPECIAL_TOKEN
from textkiln.operators import bpe as B
from textkiln.operators import next_token as N
from textkiln.operators import pretokens as P
from textkiln.operators import token_stream as S
from textkiln.plans.catalog import query
from textkiln.session import scratch_path
from textkiln.sources.sinks import load_meta, load_tokenizer_files, save_meta, save_tokenizer
from textkiln.sources.tables import load

# Parameters of the registered queries (FIXTURES.md): windows of 64 rows x 128
# tokens, 200 generation steps, top-k 40 and temperature 0.8 are the operator
# defaults; 3,000 window steps are the reference's training run.  Queries train
# TRAIN_VOCAB entries; the SQL of a query's ``small`` follows BPE_VOCAB.
BPE_VOCAB = 257 + 64
TRAIN_VOCAB = B.VOCAB_SIZE
WIN_STEPS, WIN_BATCH, WIN_BLOCK, SEED = 3000, 64, 128, 42
GEN_STEPS = N.MAX_NEW_TOKENS
# Evaluations at steps 0, 250, ... of a training run, and the seed of their windows.
EVALS, EVAL_SEED = WIN_STEPS // N.EVAL_INTERVAL + 1, 43

# ----------------------------------------------------------------- SQL side
# Java (?U)\s is Unicode White_Space; RE2 \s is ASCII, so spell the class out.
_WS = r"\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_SQL_PAT = (
    r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^" + _WS + r"\p{L}\p{N}\x01]+|[" + _WS + "]+"
)
# RE2 has no look-ahead: mark the last blank of a run that precedes a
# non-blank with chr(1) so that `\s+` stops before it (see SURVEY 7.4).
_MARK = "regexp_replace({x}, '([" + _WS + "])([" + _WS + "][^" + _WS + "])', '\\1' || chr(1) || '\\2', 'g')"


def _pretok(x: str) -> str:
    return "regexp_extract_all(" + _MARK.replace("{x}", x) + ", '" + _SQL_PAT + "')"


SQL_TOKS = f"""
toks AS (
  SELECT doc_id, CAST(unnest(range(len(l))) AS BIGINT) AS pos_in_doc, unnest(l) AS token
  FROM (SELECT doc_id, {_pretok("text || chr(10) || chr(10)")} AS l FROM documents)
),
vocab AS (
  SELECT token, CAST(count(*) AS BIGINT) AS cnt,
         CAST(row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS INTEGER) AS token_id
  FROM toks GROUP BY token
),
ided AS (SELECT t.doc_id, t.pos_in_doc, t.token, v.token_id FROM toks t JOIN vocab v USING (token)),
doc_n AS (SELECT doc_id, count(*) AS n FROM toks GROUP BY doc_id),
doc_start AS (SELECT doc_id, CAST(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS BIGINT) AS doc_start FROM doc_n),
meta AS (SELECT CAST(sum(n) AS BIGINT) AS n_total, CAST((9 * sum(n)) // 10 AS BIGINT) AS split_at, (SELECT count(*) FROM vocab) AS v FROM doc_n),
positions AS (
  SELECT d.doc_start + i.pos_in_doc AS pos, i.doc_id, i.pos_in_doc, i.token_id,
         CASE WHEN d.doc_start + i.pos_in_doc < (SELECT split_at FROM meta) THEN 'train' ELSE 'val' END AS split
  FROM ided i JOIN doc_start d USING (doc_id)
),
pairs AS (
  SELECT split, pos, x, y
  FROM (SELECT split, pos, token_id AS x, lead(token_id) OVER (PARTITION BY split ORDER BY pos) AS y FROM positions) WHERE y IS NOT NULL
),
counts AS (SELECT x, y, CAST(count(*) AS BIGINT) AS c FROM pairs WHERE split = 'train' GROUP BY x, y),
topk AS (SELECT x, y, c FROM (SELECT *, rank() OVER (PARTITION BY x ORDER BY c DESC) AS r FROM counts) WHERE r <= 40),
probs AS (
  SELECT x, y, c, wt / sum(wt) OVER (PARTITION BY x) AS p
  FROM (SELECT *, exp((ln(c) - ln(max(c) OVER (PARTITION BY x))) / 0.8) AS wt FROM topk)
),
cum AS (
  SELECT *, coalesce(lag(hi) OVER (PARTITION BY x ORDER BY p DESC, y), 0.0) AS lo, max(hi) OVER (PARTITION BY x) AS tot
  FROM (SELECT *, sum(p) OVER (PARTITION BY x ORDER BY p DESC, y ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM probs)
)"""


def _uniform_sql(key: str, seed: int) -> str:
    h = f"((({seed} * 40503 + 12345) * 31 + {key}) % {N.U_MOD})"
    return f"(CAST(({h} * {N.U_MULT}) % {N.U_MOD} AS DOUBLE) / {N.U_MOD})"


def _byte_sql(h: str, i: str) -> str:
    d = "'0123456789ABCDEF'"
    return f"((instr({d}, substr({h}, 2 * ({i}) + 1, 1)) - 1) * 16 + instr({d}, substr({h}, 2 * ({i}) + 2, 1)) - 1)"


def _byte_id_sql(b: str) -> str:
    return (f"CASE WHEN {b} BETWEEN 33 AND 126 THEN {b} - 32 WHEN {b} BETWEEN 161 AND 172 THEN {b} - 66 "
            f"WHEN {b} BETWEEN 174 AND 255 THEN {b} - 67 WHEN {b} <= 32 THEN {b} + 189 "
            f"WHEN {b} BETWEEN 127 AND 160 THEN {b} + 95 ELSE 256 END")


SQL_LINE_COUNTS = f"""
lines AS (
  SELECT doc_id, unnest(list_transform(parts[1:len(parts) - 1], lambda s: s || chr(10))) AS line
  FROM (SELECT doc_id, string_split(text || chr(10) || chr(10), chr(10)) AS parts FROM documents)
),
line_toks AS (SELECT unnest({_pretok("line")}) AS token FROM lines),
line_counts AS (SELECT token, CAST(count(*) AS BIGINT) AS cnt FROM line_toks GROUP BY token)"""


# ----------------------------------------------------------------- shared Spark state
_CACHE: dict = {}


def _docs(spark, sf_dir):
    return load(spark, sf_dir, "documents", "doc_id", "text")


def _pretoken(spark, sf_dir):
    key = ("pretoken", spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = S.pretoken_stream(_docs(spark, sf_dir))
    return _CACHE[key]


def _model(spark, sf_dir):
    key = ("bpe", spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = B.train_bpe(_docs(spark, sf_dir), vocab_size=TRAIN_VOCAB)
    return _CACHE[key]


def _reloaded(spark, sf_dir):
    """The trained tokenizer saved and loaded from its two files, with the
    metadata saved beside the encoded data: what encoding and its check use."""
    key = ("reloaded", spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        path = scratch_path(spark, "tokenizer")
        save_tokenizer(spark, _model(spark, sf_dir), path)
        _CACHE[key] = path, load_tokenizer_files(spark, path)
    return _CACHE[key]


def _bpe_stream(spark, sf_dir):
    key = ("bpe_stream", spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = S.bpe_stream(_reloaded(spark, sf_dir)[1], _docs(spark, sf_dir))
    return _CACHE[key]


def _cum(spark, sf_dir):
    stream, _ = _pretoken(spark, sf_dir)
    counts = N.bigram_counts(stream.pairs())
    return N.cumulative(N.probabilities(N.top_k(counts, N.TOP_K, stream.vocab_size), N.TEMPERATURE))


# ----------------------------------------------------------------- pretokens / BPE counting
@query("pretoken_counts", f"""
WITH {SQL_LINE_COUNTS}
SELECT token, cnt FROM line_counts
""")
def pretoken_counts(spark, sf_dir):
    """T1 + A6 in training (lines) mode."""
    return P.pretoken_counts(P.line_pretokens(_docs(spark, sf_dir)))


@query("bpe_pair_counts", f"""
WITH {SQL_LINE_COUNTS},
wp AS (SELECT cnt, hex(token) AS h, unnest(range(strlen(token) - 1)) AS i FROM line_counts WHERE strlen(token) >= 2),
bp AS (SELECT cnt, {_byte_sql('h', 'i')} AS b1, {_byte_sql('h', 'i + 1')} AS b2 FROM wp)
SELECT CAST({_byte_id_sql('b1')} AS INTEGER) AS left_id, CAST({_byte_id_sql('b2')} AS INTEGER) AS right_id,
       CAST(sum(cnt) AS BIGINT) AS cnt
FROM bp GROUP BY 1, 2 HAVING sum(cnt) >= 2
""")
def bpe_pair_counts(spark, sf_dir):
    """A7 + F6: byte-pair counts of the first training round, weighted by word frequency."""
    words = B.training_words(_docs(spark, sf_dir))
    return P.split_pair(P.pair_counts(words)).select("left_id", "right_id", F.col("cnt").cast("long"))


def _byte_char_sql(b: str) -> str:
    """Code point of the byte-level character that stands for byte ``b``."""
    return (f"CASE WHEN {b} BETWEEN 33 AND 126 OR {b} BETWEEN 161 AND 172 OR {b} BETWEEN 174 AND 255 THEN {b} "
            f"WHEN {b} <= 32 THEN {b} + 256 WHEN {b} BETWEEN 127 AND 160 THEN {b} + 162 ELSE 323 END")


def _symbols_sql(tok: str, h: str) -> str:
    """A word as a string of symbols ``<byte id:hex>``, one per UTF-8 byte."""
    return (f"array_to_string(list_transform(range(strlen({tok})), lambda i: "
            f"'<' || CAST({_byte_id_sql(_byte_sql(h, 'i'))} AS VARCHAR) || ':' || substr({h}, 2 * i + 1, 2) || '>'), '')")


# Training, one merge per recursion step (the sequential definition).  A word
# is a string of symbols ``<id:hex>``; DuckDB's left-to-right ``replace`` of
# ``<l:hl><r:hr>`` by ``<new:hlhr>`` is the greedy merge, and the hex bytes
# give the learned token's text.  ``merges`` keeps pattern and replacement.
_SQL_BPE_MERGES = f"""{SQL_LINE_COUNTS},
w0 AS (
  SELECT cnt AS freq, {_symbols_sql('token', 'h')} AS syms
  FROM (SELECT cnt, token, hex(token) AS h FROM line_counts WHERE strlen(token) >= 2)
),
bpe(it, freq, syms, ml, mr, mh, mpat, mrep) AS (
  SELECT 0, freq, syms, NULL::INTEGER, NULL::INTEGER, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM w0
  UNION ALL
  SELECT b.it + 1, b.freq, replace(b.syms, x.pat, x.rep), x.best.l, x.best.r, x.best.lh || x.best.rh, x.pat, x.rep
  FROM bpe b, (
    SELECT best,
           '<' || best.l || ':' || best.lh || '><' || best.r || ':' || best.rh || '>' AS pat,
           '<' || CAST(257 + (SELECT max(it) FROM bpe) AS VARCHAR) || ':' || best.lh || best.rh || '>' AS rep
    FROM (SELECT (
      SELECT {{'l': l, 'r': r, 'lh': lh, 'rh': rh, 'c': c}}
      FROM (
        SELECT CAST(split_part(p.a, ':', 1) AS INTEGER) AS l, CAST(split_part(p.b, ':', 1) AS INTEGER) AS r,
               split_part(p.a, ':', 2) AS lh, split_part(p.b, ':', 2) AS rh, sum(freq) AS c
        FROM (
          SELECT freq, unnest(list_transform(range(1, len(t)), lambda i: {{'a': t[i], 'b': t[i + 1]}})) AS p
          FROM (SELECT freq, string_split(substr(syms, 2, strlen(syms) - 2), '><') AS t FROM bpe)
        )
        GROUP BY 1, 2, 3, 4
      )
      ORDER BY c DESC, l, r LIMIT 1
    ) AS best)
  ) x
  WHERE b.it < {BPE_VOCAB - 257} AND x.best.c >= 2
),
merges AS (
  SELECT DISTINCT CAST(it - 1 AS INTEGER) AS rank, ml AS left_id, mr AS right_id, CAST(256 + it AS INTEGER) AS new_id,
         mh, mpat, mrep
  FROM bpe WHERE it >= 1
)"""

_SQL_BPE_TRAIN = f"""
WITH RECURSIVE {_SQL_BPE_MERGES}
SELECT rank, left_id, right_id, new_id,
       array_to_string(list_transform(range(strlen(mh) // 2), lambda i: chr(CAST({_byte_char_sql(_byte_sql('mh', 'i'))} AS INTEGER))), '') AS token
FROM merges
"""

# Encoding: framed documents pretokenized in document mode; each distinct word gets the merges
# applied in rank order (equal to merging the lowest-ranked pair first).
def _bpe_enc_sql(more: str = "") -> str:
    """CTEs ending in ``encoded(doc_id, ids)``; ``more`` adds texts to the documents."""
    return f"""{_SQL_BPE_MERGES},
segs AS (
  SELECT doc_id, 0 AS si, text || chr(10) || chr(10) AS seg FROM documents{more}
),
dtoks AS (
  SELECT doc_id, si, unnest(range(len(l))) AS ti, unnest(l) AS token FROM (SELECT doc_id, si, {_pretok('seg')} AS l FROM segs)
),
enc(k, token, syms) AS (
  SELECT 0, token, {_symbols_sql('token', 'hex(token)')} FROM (SELECT DISTINCT token FROM dtoks)
  UNION ALL
  SELECT e.k + 1, e.token, replace(e.syms, m.mpat, m.mrep) FROM enc e JOIN merges m ON m.rank = e.k
),
word_ids AS (
  SELECT token, list_transform(string_split(substr(syms, 2, strlen(syms) - 2), '><'),
                               lambda x: CAST(split_part(x, ':', 1) AS INTEGER)) AS wids
  FROM enc WHERE k = (SELECT count(*) FROM merges)
),
pieces AS (
  SELECT d.doc_id, d.si, d.ti, w.wids FROM dtoks d JOIN word_ids w USING (token)
),
encoded AS (
  SELECT doc_id, flatten(list(wids ORDER BY si, ti)) AS ids FROM pieces GROUP BY doc_id
)"""


_SQL_BPE_ENC = _bpe_enc_sql()


@query("bpe_train", small=_SQL_BPE_TRAIN)
def bpe_train(spark, sf_dir):
    """A8 + L5: learned merges ``(rank, left_id, right_id, new_id, token)``."""
    return _model(spark, sf_dir).merges_df(spark)


@query("encode_documents", small=f"""
WITH RECURSIVE {_SQL_BPE_ENC}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, ids FROM encoded
""")
def encode_documents(spark, sf_dir):
    """BPE ids of every framed document."""
    enc = B.encode_documents(_reloaded(spark, sf_dir)[1], _docs(spark, sf_dir))
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


@query("decode_roundtrip", """
SELECT doc_id, text || chr(10) || chr(10) AS text FROM documents
""")
def decode_roundtrip(spark, sf_dir):
    """T3 + J5: decode(encode(text + "\\n\\n")) for every document."""
    m = _reloaded(spark, sf_dir)[1]
    enc = B.encode_documents(m, _docs(spark, sf_dir))
    return enc.select("doc_id", B.decode_ids(m, F.col("ids")).alias("text"))


@query("corpus_meta", small=f"""
WITH RECURSIVE {_SQL_BPE_ENC},
tot AS (SELECT CAST(sum(len(ids)) AS BIGINT) AS n FROM encoded),
nm AS (SELECT CAST(count(*) AS BIGINT) AS k FROM merges)
SELECT CAST(257 + k AS BIGINT) AS vocab_size, '{SPECIAL_TOKEN}' AS special_token, CAST({SPECIAL_ID} AS BIGINT) AS special_id,
       k AS n_merges, n AS n_tokens, CAST((9 * n) // 10 AS BIGINT) AS n_train, CAST(n - (9 * n) // 10 AS BIGINT) AS n_val
FROM tot, nm
""")
def corpus_meta(spark, sf_dir):
    """S13 + A9 + T4: vocabulary size, special token and split sizes."""
    stream = _bpe_stream(spark, sf_dir)
    m = _model(spark, sf_dir)
    row = [(m.vocab_size, SPECIAL_TOKEN, SPECIAL_ID, len(m.merges), stream.n_total, stream.split_at, stream.n_total - stream.split_at)]
    return spark.createDataFrame(row, "vocab_size long, special_token string, special_id long, n_merges long, n_tokens long, n_train long, n_val long")


@query("vocab_check", small=f"""
WITH RECURSIVE {_SQL_BPE_ENC},
nm AS (SELECT CAST(257 + count(*) AS BIGINT) AS v FROM merges),
mx AS (SELECT CAST(max(list_max(ids)) AS BIGINT) AS max_id FROM encoded)
SELECT v AS model_vocab, v AS data_vocab, max_id, max_id < v AS ok FROM nm, mx
""")
def vocab_check(spark, sf_dir):
    """T5: the saved metadata of the encoded data against the tokenizer loaded
    from its files (raises on mismatch)."""
    stream = _bpe_stream(spark, sf_dir)
    path, m = _reloaded(spark, sf_dir)
    found = stream.docs.agg(F.max(F.array_max("ids"))).first()[0]
    save_meta(spark, f"{path}/meta", stream.vocab_size, max_id=found)
    meta = load_meta(spark, f"{path}/meta")
    B.check_vocabulary(m.vocab_size, meta["vocab_size"], meta["max_id"])
    fits = meta["vocab_size"] == m.vocab_size and meta["max_id"] < m.vocab_size
    return spark.createDataFrame([(m.vocab_size, meta["vocab_size"], meta["max_id"], fits)],
                                 "model_vocab long, data_vocab long, max_id long, ok boolean")


@query("bpe_chars_per_token", small=f"""
WITH RECURSIVE {_SQL_BPE_ENC},
tot AS (SELECT CAST(sum(len(ids)) AS BIGINT) AS n FROM encoded),
ch AS (SELECT CAST(sum(length(text) + 2) AS BIGINT) AS c FROM documents)
SELECT c AS n_chars, n AS n_tokens, round(c / greatest(n, 1), 6) AS chars_per_token FROM tot, ch
""")
def bpe_chars_per_token(spark, sf_dir):
    """P7 for the BPE stream."""
    enc = _bpe_stream(spark, sf_dir).offsets
    chars = _docs(spark, sf_dir).select((F.length("text") + 2).alias("c"))
    n_chars = chars.agg(F.sum("c")).first()[0]
    tot = enc.agg(F.sum("n").cast("long").alias("n_tokens"))
    return tot.select(F.lit(n_chars).cast("long").alias("n_chars"), "n_tokens",
                      F.round(F.lit(n_chars) / F.greatest(F.col("n_tokens"), F.lit(1)), 6).alias("chars_per_token"))


# ----------------------------------------------------------------- id stream (pretoken level)
@query("token_id_lookup", f"""
WITH {SQL_TOKS}
SELECT doc_id, pos_in_doc, token, token_id FROM ided
""")
def token_id_lookup(spark, sf_dir):
    """Every pretoken of every framed document with its vocabulary id."""
    vocab = S.pretoken_vocab(_docs(spark, sf_dir))
    occ = P.doc_pretokens(_docs(spark, sf_dir))
    ided = occ.join(vocab.select("token", F.col("token_id").cast("int").alias("token_id")), "token")
    return ided.select("doc_id", F.col("pos_in_doc").cast("long"), "token", "token_id")


@query("chars_per_token", f"""
WITH {SQL_TOKS}
SELECT (SELECT CAST(sum(length(text) + 2) AS BIGINT) FROM documents) AS n_chars,
       n_total AS n_tokens,
       round((SELECT sum(length(text) + 2) FROM documents) / greatest(n_total, 1), 6) AS chars_per_token
FROM meta
""")
def chars_per_token(spark, sf_dir):
    """P7 at pretoken level."""
    stream, _ = _pretoken(spark, sf_dir)
    n_chars = _docs(spark, sf_dir).agg(F.sum(F.length("text") + 2)).first()[0]
    n = stream.n_total
    return spark.createDataFrame([(int(n_chars), int(n), round(n_chars / max(n, 1), 6))],
                                 "n_chars long, n_tokens long, chars_per_token double")


@query("token_positions", f"""
WITH {SQL_TOKS}
SELECT pos, doc_id, pos_in_doc, token_id, split FROM positions
""")
def token_positions(spark, sf_dir):
    """W4 + W5: global position and split of every token."""
    stream, _ = _pretoken(spark, sf_dir)
    return stream.tokens()


@query("split_summary", f"""
WITH {SQL_TOKS}
SELECT split, CAST(count(*) AS BIGINT) AS n_tokens, min(pos) AS first_pos, max(pos) AS last_pos
FROM positions GROUP BY split
""")
def split_summary(spark, sf_dir):
    """W5 + S12: contiguous 90/10 split sizes."""
    stream, _ = _pretoken(spark, sf_dir)
    return stream.split_summary()


@query("next_token_pairs", f"""
WITH {SQL_TOKS}
SELECT split, pos, x, y FROM pairs
""")
def next_token_pairs(spark, sf_dir):
    """input/target pairs shifted by one inside each split."""
    stream, _ = _pretoken(spark, sf_dir)
    return stream.pairs()


@query("training_windows", f"""
WITH {SQL_TOKS},
specs AS (SELECT 'train' AS split, 0 AS base, split_at AS n FROM meta
          UNION ALL SELECT 'val', split_at, n_total - split_at FROM meta),
w AS (SELECT split, CAST(k // {WIN_BATCH} AS BIGINT) AS step, CAST(k % {WIN_BATCH} AS BIGINT) AS b,
             CAST((k * {S.HASH_MULT} + {SEED}) % (n - {WIN_BLOCK}) AS BIGINT) AS start, base
      FROM specs, range({WIN_STEPS * WIN_BATCH}) r(k)),
blocks AS (SELECT pos // 512 AS k, list(token_id ORDER BY pos) AS ids FROM positions GROUP BY 1)
SELECT split, step, b, start, md5(array_to_string(list_slice(seq, o, o + {WIN_BLOCK - 1}), ' ')) AS x_md5,
       md5(array_to_string(list_slice(seq, o + 1, o + {WIN_BLOCK}), ' ')) AS y_md5
FROM (
  SELECT w.*, (base + start) % 512 + 1 AS o, list_concat(p.ids, coalesce(q.ids, [])) AS seq
  FROM w JOIN blocks p ON p.k = (base + start) // 512 LEFT JOIN blocks q ON q.k = p.k + 1)
""")
def training_windows(spark, sf_dir):
    """W6 + J7: the windows of 3,000 steps for either split, ``y`` = ``x``
    shifted by one; digests of the space-joined ids."""
    stream, _ = _pretoken(spark, sf_dir)
    w = stream.windows(WIN_STEPS, WIN_BATCH, WIN_BLOCK, SEED)
    return w.select("split", "step", "b", "start",
                    F.md5(F.array_join(F.col("x").cast("array<string>"), " ")).alias("x_md5"),
                    F.md5(F.array_join(F.col("y").cast("array<string>"), " ")).alias("y_md5"))


# ----------------------------------------------------------------- next-token model
@query("split_loss", f"""
WITH {SQL_TOKS},
g AS (SELECT split, x, y, count(*) AS m FROM pairs GROUP BY split, x, y),
tr AS (SELECT x, y, m AS c FROM g WHERE split = 'train'),
cx AS (SELECT x, sum(c) AS cx FROM tr GROUP BY x)
SELECT g.split, CAST(sum(m) AS BIGINT) AS n_pairs,
       round(sum(-ln((coalesce(tr.c, 0) + 1) / (coalesce(cx.cx, 0) + (SELECT v FROM meta))) * m) / sum(m), 6) AS loss
FROM g LEFT JOIN tr USING (x, y) LEFT JOIN cx USING (x)
GROUP BY g.split
""")
def split_loss(spark, sf_dir):
    """A10: mean next-token loss per split under the train-count model."""
    stream, _ = _pretoken(spark, sf_dir)
    return N.split_loss(stream.pairs(), stream.vocab_size)


@query("sampled_loss", f"""
WITH {SQL_TOKS},
specs AS (SELECT 'train' AS split, 0 AS base, split_at AS n FROM meta
          UNION ALL SELECT 'val', split_at, n_total - split_at FROM meta),
w AS (SELECT split, CAST(k // {N.EVAL_ITERS * WIN_BATCH} * {N.EVAL_INTERVAL} AS BIGINT) AS step,
             CAST(base + (k * {S.HASH_MULT} + {EVAL_SEED}) % (n - {WIN_BLOCK}) AS BIGINT) AS g0
      FROM specs, range({EVALS * N.EVAL_ITERS * WIN_BATCH}) r(k)),
g AS (SELECT x, y, count(*) FILTER (WHERE split = 'train') AS c FROM pairs GROUP BY x, y),
cx AS (SELECT x, sum(c) AS cx FROM g GROUP BY x),
l AS (SELECT pos, CAST(round(-ln((c + 1) / (cx + (SELECT v FROM meta))) * {N.LOSS_UNIT}) AS BIGINT) AS nll
      FROM pairs JOIN g USING (x, y) JOIN cx USING (x)),
run AS (SELECT pos, sum(coalesce(nll, 0)) OVER (ORDER BY pos) - coalesce(nll, 0) AS below
        FROM (SELECT pos FROM positions) LEFT JOIN l USING (pos))
SELECT split, step, CAST(count(*) AS BIGINT) AS n_windows,
       round(CAST(sum(b.below - a.below) AS DOUBLE) / (count(*) * {WIN_BLOCK * N.LOSS_UNIT}), 6) AS loss
FROM w JOIN run a ON a.pos = w.g0 JOIN run b ON b.pos = w.g0 + {WIN_BLOCK}
GROUP BY split, step
""")
def sampled_loss(spark, sf_dir):
    """A10: mean loss over sampled windows per split at every evaluation step."""
    stream, _ = _pretoken(spark, sf_dir)
    return N.sampled_loss(stream, EVALS, seed=EVAL_SEED)


@query("next_token_topk", f"""
WITH {SQL_TOKS}
SELECT x, y, c FROM topk
""")
def next_token_topk(spark, sf_dir):
    """Top-40 successors per context, ties at the 40th kept."""
    stream, _ = _pretoken(spark, sf_dir)
    return N.top_k(N.bigram_counts(stream.pairs()), N.TOP_K, stream.vocab_size)


@query("next_token_probs", f"""
WITH {SQL_TOKS}
SELECT x, y, c, round(p, 9) AS p FROM probs
""")
def next_token_probs(spark, sf_dir):
    """Temperature 0.8 softmax over the kept successors."""
    stream, _ = _pretoken(spark, sf_dir)
    probs = N.probabilities(N.top_k(N.bigram_counts(stream.pairs()), N.TOP_K, stream.vocab_size), N.TEMPERATURE)
    return probs.select("x", "y", "c", F.round("p", 9).alias("p"))


@query("sample_next_token", f"""
WITH {SQL_TOKS}
SELECT x, y FROM cum
WHERE lo <= {_uniform_sql('x', SEED)} * tot AND {_uniform_sql('x', SEED)} * tot < hi
""")
def sample_next_token(spark, sf_dir):
    """One seeded draw per context."""
    return N.sample(_cum(spark, sf_dir), SEED)


def _step_uniform_sql(seed: int) -> str:
    """``seeded_uniform(pid, step, ctx)`` over the recursive state ``g``."""
    h = f"({seed} * 40503 + 12345)"
    for k in ("g.pid", "g.step", "g.ctx"):
        h = f"(({h} * 31 + {k}) % {N.U_MOD})"
    return f"(CAST(({h} * {N.U_MULT}) % {N.U_MOD} AS DOUBLE) / {N.U_MOD})"


# Prompts are encoded with the corpus under negative keys; ``bcum`` is ``cum`` over BPE ids.
_PROMPT_KEY = "-1 - (CAST(conv_id AS BIGINT) * 1000 + turn)"
_SQL_GENERATE = f"""
WITH RECURSIVE {_bpe_enc_sql(f" UNION ALL SELECT {_PROMPT_KEY}, 0, text FROM conversations")},
prompts AS MATERIALIZED (
  SELECT -1 - t.k AS pid, CAST(coalesce(len(e.ids), 0) AS BIGINT) AS n_prompt, coalesce(e.ids[-1], -1) AS ctx
  FROM (SELECT {_PROMPT_KEY} AS k FROM conversations) t LEFT JOIN encoded e ON e.doc_id = t.k
),
btoks AS (
  SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT doc_id, unnest(range(len(ids))) AS i, unnest(ids) AS id FROM encoded WHERE doc_id >= 0)
),
btrain AS (SELECT id AS x, lead(id) OVER (ORDER BY pos) AS y FROM btoks WHERE pos < (9 * n) // 10),
bcounts AS (SELECT x, y, CAST(count(*) AS BIGINT) AS c FROM btrain WHERE y IS NOT NULL GROUP BY x, y),
btopk AS (SELECT x, y, c FROM (SELECT *, rank() OVER (PARTITION BY x ORDER BY c DESC) AS r FROM bcounts) WHERE r <= {N.TOP_K}),
bprobs AS (
  SELECT x, y, wt / sum(wt) OVER (PARTITION BY x) AS p
  FROM (SELECT *, exp((ln(c) - ln(max(c) OVER (PARTITION BY x))) / {N.TEMPERATURE}) AS wt FROM btopk)
),
bcum AS MATERIALIZED (
  SELECT *, coalesce(lag(hi) OVER (PARTITION BY x ORDER BY p DESC, y), 0.0) AS lo, max(hi) OVER (PARTITION BY x) AS tot
  FROM (SELECT *, sum(p) OVER (PARTITION BY x ORDER BY p DESC, y ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM bprobs)
),
gen(pid, step, ctx) AS (
  SELECT pid, 0, ctx FROM prompts
  UNION ALL
  SELECT g.pid, g.step + 1, c.y
  FROM gen g JOIN bcum c
    ON c.x = g.ctx AND c.lo <= {_step_uniform_sql(SEED)} * c.tot AND {_step_uniform_sql(SEED)} * c.tot < c.hi
  WHERE g.step < {GEN_STEPS}
)
SELECT p.pid, p.n_prompt,
       coalesce(string_agg(CAST(g.ctx AS VARCHAR), ' ' ORDER BY g.step) FILTER (WHERE g.step > 0), '') AS new_ids
FROM prompts p JOIN gen g USING (pid)
GROUP BY p.pid, p.n_prompt
"""


def _generated(spark, sf_dir):
    """``(pid, ids, new_ids)``: every turn of ``conversations`` encoded with the
    trained tokenizer (no text is unseen to it) and continued."""
    key = ("generated", spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        stream = _bpe_stream(spark, sf_dir)
        kept = N.top_k(N.bigram_counts(stream.pairs()), N.TOP_K, stream.vocab_size)
        cum = N.cumulative(N.probabilities(kept, N.TEMPERATURE))
        conv = load(spark, sf_dir, "conversations", "conv_id", "turn", "text")
        turns = conv.select((F.col("conv_id").cast("long") * 1000 + F.col("turn")).alias("pid"), "text")
        prompts = B.encode_texts(_reloaded(spark, sf_dir)[1], turns, "pid", F.col("text"), frame=False)
        _CACHE[key] = N.generate(prompts, cum, GEN_STEPS, SEED)
    return _CACHE[key]


@query("generate_batch", small=_SQL_GENERATE)
def generate_batch(spark, sf_dir):
    """Every turn of ``conversations`` continued by 200 BPE tokens."""
    return _generated(spark, sf_dir).select(
        "pid", F.size("ids").cast("long").alias("n_prompt"),
        F.array_join(F.col("new_ids").cast("array<string>"), " ").alias("new_ids"))


@query("generate_text")
def generate_text(spark, sf_dir):
    """W10 + J5: prompt and continuation decoded to text (bytes that are no
    UTF-8 become U+FFFD, which SQL has no function for)."""
    out = _generated(spark, sf_dir)
    return out.select("pid", B.decode_ids(_reloaded(spark, sf_dir)[1], F.concat("ids", "new_ids")).alias("text"))


def clear_caches() -> None:
    """Forget what queries share, so that each is timed with all its work."""
    _CACHE.clear()
