"""Fill-in-middle, token output and spelling variants against brute force and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from textkiln.llm import fill_middle, spelling, token_output

DOCS = "doc_id long, text string, output string, ids string, word string, n long"
WORDS = "harbour meadow lantern copper willow saddle thimble garden pepper velvet marble cotton ribbon basket candle über fenêtre niño".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", ",", "'s", ".", " 12", "\n"]) for _ in range(n))


ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "x" * 200_000), (5, "日本語 テキスト😀é̂ "), (6, "a <P> b"), (7, "<S>"), (8, "x<M>"), (9, "< P >S> <"),
    (10, "It's DON'T Σας ΑΣ. İstanbul ½ ²x ﬁ ſ"), (11, "<|endoftext|> a<|endoftext|>b"), (12, "a\x1cb\x85c\xa0d　e\x00f"), (13, "é ́x é"), (14, "é" * 3000),
    (15, prose(1, 30_000)), (None, "no id here, lantern"), (16, prose(2, 50)), (16, prose(2, 50)), (17, prose(3, 60)), (17, prose(4, 70)), (-5, "minus five"),
]
ROWS = [*ODD, *((100 + i, prose(100 + i, 5 + 9 * i)) for i in range(40))]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "o", "i", "w", 1) for r in rows], DOCS).repartition(4)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS)


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- 11 --------------------------------------------------------------------


def _expected_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    own = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, own, own
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), hashlib.sha256(out.encode()).hexdigest(), own


def test_fill_middle_like_brute_force(docs):
    found = plain(fill_middle.report(docs).drop("n_lines"))
    assert found == sorted((_expected_middle(*r) for r in ROWS), key=repr)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("error", [0, 3, fill_middle.ERROR])
def test_rank_index_is_exact(error):
    rng = np.random.default_rng(3)
    for steps in ([], [1], rng.integers(1, 5, 5000), np.where(rng.random(6000) < 0.01, 900, 1), np.repeat([1, 40, 2], 1500)):
        offsets = np.concatenate([[0], np.cumsum(steps)]).astype(np.int64)
        index = fill_middle.RankIndex.fit(offsets, error)
        assert [index.offset(r) for r in range(0, len(offsets), 7)] == offsets[::7].tolist()
        assert np.abs(index.residual).max() <= error + 1 and len(index.first) <= max(1, len(offsets) // 2 + 1)


def test_rank_index_is_small_on_prose():
    offsets = fill_middle.boundaries(prose(9, 20_000).encode())
    assert len(fill_middle.RankIndex.fit(offsets).first) < len(offsets) / 200


def test_fill_middle_of_nothing(spark):
    assert fill_middle.report(frame(spark, [])).count() == 0


# --- 12 --------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def _expected_tokens(rows, tokenizer):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    return [(i, [*(t.encode(x or "", add_special_tokens=False).ids), 1]) for i, x in rows]


def test_token_output_like_library(spark, docs, tokenizer, tmp_path):
    path = str(tmp_path / "ids")
    token_output.write(docs, path, tokenizer)
    rows = token_output.report(token_output.read(spark, path)).collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=repr) == sorted(((i, len(x), crc(x)) for i, x in _expected_tokens(ROWS, tokenizer)), key=repr)
    placed = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id is not None for r in placed] == [False] + [True] * (len(rows) - 1)
    ids = [r.doc_id for r in placed[1:]]
    assert ids == sorted(ids)
    at = 0
    for r in placed:
        assert r.start == at
        at += r.n_tokens


def test_token_words_like_library(tokenizer):
    import pyarrow as pa

    rng = random.Random(4)
    texts = ["".join(rng.choices("aBç \n\t\x0b\x1c\x85\xa0 'sΣ1²½_-̧́e<|>😀가ᄀſİŸ", k=rng.randint(0, 50))) for _ in range(2000)]
    encoder = token_output.WordEncoder(tokenizer)
    assert encoder.by_words
    ids, sizes = token_output.encode_batch(encoder, pa.array(texts), 1)
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [x for _, x in _expected_tokens(enumerate(texts), tokenizer)]


def test_other_tokenizers_encode_whole_texts(spark):
    import public_tokenizers
    import pyarrow as pa

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_output.WordEncoder(path)
    texts = ["two  blanks", "", "a\n\nb "]
    ids, sizes = token_output.encode_batch(encoder, pa.array(texts), 7)
    assert not encoder.by_words
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [[*x[:-1], 7] for _, x in _expected_tokens(enumerate(texts), path)]


def test_token_files_hold_stripes_indexes_and_bloom_filters(spark, tokenizer, tmp_path):
    path = str(tmp_path / "ids")
    many = spark.range(30_000).select((F.col("id") * 3).alias("doc_id"), F.concat(F.lit("lantern copper "), F.col("id").cast("string")).alias("text"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        token_output.write(many, path, tokenizer, stripe_bytes=1 << 14)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tokens = token_output.read(spark, path)
    hit = token_output.documents(tokens, [600, 601, 44_100])
    assert sorted(r.doc_id for r in hit.collect()) == [600, 44_100]
    assert "PushedFilters: [In(doc_id, [" in hit._jdf.queryExecution().toString()
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for file in (tmp_path / "ids").glob("*.orc"):
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(str(file)), jvm.org.apache.orc.OrcFile.readerOptions(conf))
        assert reader.getStripes().size() > 1 and reader.getRowIndexStride() == token_output.INDEX_ROWS
        footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
        kinds = {(s.getColumn(), s.getKind().toString()) for s in footer.getStreamsList()}
        assert (1, "BLOOM_FILTER_UTF8") in kinds and (1, "ROW_INDEX") in kinds and not any(k.startswith("BLOOM") and c != 1 for c, k in kinds)
        assert footer.getColumns(1).getKind().toString() == "DIRECT_V2"


def test_token_output_of_nothing(spark, tokenizer, tmp_path):
    path = str(tmp_path / "none")
    token_output.write(frame(spark, []), path, tokenizer)
    tokens = spark.read.schema(token_output.schema_of(LongType())).orc(path)
    assert token_output.report(tokens).count() == 0


# --- 13 --------------------------------------------------------------------


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _expected_variants(rows, least=6, times=5):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            count[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 199 == 0 else low] += 1
    words = {w: n for w, n in count.items() if len(w) >= least and n >= 5}
    near = {w: [v for v in words if _near(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= times * words[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def _misspelled(seed, n):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abÀéz", k=rng.randint(5, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab", "lantern", "lanterns", "Lanternss"]
    words = []
    for _ in range(n):
        w = stems[min(int(rng.expovariate(0.12)), len(stems) - 1)]
        for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
            i = rng.randint(0, len(w))
            w = rng.choice([w[:i] + rng.choice("abz") + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice("abÀ") + w[i + 1 :]])
        words.append(w)
    return " ".join(words)


CHAIN = " ".join(["chainaa"] * 6 + ["chainab"] * 40 + ["chainbb"] * 250 + ["chainsbb"] * 1500)
SPELT = [(4, CHAIN), (None, "Lantern lantern, ÀLANTERN"), (1, None), (2, ""), (3, "q" * 3000 + " " + " ".join(["w" * 2000] * 6 + ["w" * 2001] * 40)), *((10 + i, _misspelled(i, 900)) for i in range(30)), (10, _misspelled(0, 900))]


@pytest.mark.parametrize("limits", [{}, {"LEAST_BOUND": 0}, {"LEAST_BOUND": 3, "MAX_DICTIONARY": 40}, {"LEAST_BOUND": 10**9}])
def test_variants_like_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(spelling, name, value)
    found = plain(spelling.variants(frame(spark, SPELT)))
    want = _expected_variants(SPELT)
    assert found == want and len(want) > 300 and any(w[1] for w in want) and any(w[2] not in (w[0], w[1]) for w in want)


def test_near_words_share_the_key_of_their_place():
    rng = random.Random(8)
    for _ in range(3000):
        w = "".join(rng.choices("ab", k=rng.randint(6, 12)))
        frequent = frozenset("".join(rng.choices("ab" + spelling._FIRST + spelling._LAST, k=rng.randint(2, 5))) for _ in range(rng.randint(0, 150)))
        keys = spelling._keys(w, frequent, True)
        i = rng.randint(0, len(w) - 1)
        assert keys[i] == spelling._keys(w[:i] + rng.choice("abc") + w[i + 1 :], frequent, False)[i]
        i = rng.randint(0, len(w))
        assert keys[len(w) + i] == spelling._keys(w[:i] + rng.choice("abc") + w[i:], frequent, False)[i]


def test_dictionary_is_bounded(spark, monkeypatch):
    from textkiln.llm.common import Tables

    monkeypatch.setattr(spelling, "MAX_DICTIONARY", 30)
    words = spark.createDataFrame([("".join(random.Random(i).choices("abcd", k=8)),) for i in range(300)], "word string")
    held = spelling.gram_dictionary(words, Tables(spark, "test"))
    assert 10 < len(held) <= 30


def test_variants_of_nothing(spark):
    assert spelling.variants(frame(spark, [])).count() == 0
