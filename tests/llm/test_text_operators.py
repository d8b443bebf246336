"""Deduplication, decontamination, join, mixing and the classifiers against brute force and on odd rows."""

import hashlib
import math
import random
import re

import pytest
import regex

from textkiln.llm import decontaminate, jaccard_join, mixing, quality, substring_dedup, suffix_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "harbour meadow lantern copper willow saddle thimble garden pepper velvet marble cotton ribbon basket candle über fenêtre niño".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))


def corpus() -> list[tuple]:
    shared = prose(900, 60)
    rows = [(i, prose(i, 30 + 7 * i), "en", f"src{i % 3}", None) for i in range(12)]
    rows += [(20 + i, prose(50 + i, 40) + " " + shared + " " + prose(80 + i, 40), "en", "src0", 1) for i in range(5)]
    rows += [(40 + i, rows[5][1], "en", "src1", 5) for i in range(4)]
    near = rows[9][1].split()
    for i in range(4):
        copy = list(near)
        copy[10 + 5 * i] = "changed"
        rows.append((50 + i, " ".join(copy), None, None, None))
    rows += [
        (60, None, "en", "src0", None), (61, "", "en", "src0", 0), (62, " \n\t ", "en", None, 3), (63, "one", "en", "src2", 3), (64, "one two", "en", "src2", 7),
        (65, "one two", "en", "src2", 7), (66, "x" * 1500, "en", "src0", 1500), (67, "ab " * 700, "en", "src0", 2100), (None, shared, "en", "src0", 4),
        (70, prose(7, 4000), "en", "src1", None), (71, "日本語" * 120, "ja", "src1", None), (72, "é" * 50 + "日本語" * 120, "ja", "src1", None),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts() -> dict[int, bytes]:
    return {r[0]: (r[1] or "").encode() for r in corpus() if r[0] is not None}


# --- 1 ---------------------------------------------------------------------


def test_chunks_are_whole_and_resist_shifts():
    a = prose(1, 3000).encode()
    (ends,) = substring_dedup.chunk_ends([a])
    assert ends[-1] == len(a) and ends == sorted(set(ends))
    assert all(substring_dedup.MIN_CHUNK <= e - b <= substring_dedup.MAX_CHUNK for b, e in zip([0, *ends], ends[:-1], strict=False))
    shifted = a[:5000] + b"inserted words" + a[5000:]
    one, two = (set(substring_dedup._digests(t, e)) for t, e in zip([a, shifted], substring_dedup.chunk_ends([a, shifted]), strict=True))
    assert len(one - two) <= 6
    # The padding between texts keeps neighbours out of the hash.
    assert substring_dedup.chunk_ends([b"zz" * 40, a])[1] == ends
    assert substring_dedup.chunk_ends([]) == [] and substring_dedup.chunk_ends([b""]) == [[]]


def test_substring_dedup_equals_brute_force(docs):
    seen, want = set(), {}
    for i, t in sorted(texts().items()):
        (ends,) = substring_dedup.chunk_ends([t])
        digests = substring_dedup._digests(t, ends)
        known = {a for a, h in zip([0, *ends], digests, strict=False) if h in seen}
        seen.update(digests)
        runs = substring_dedup._runs(t, ends, known, substring_dedup.MIN_RUN)
        edges = [0, *(x for r in runs for x in r), len(t)]
        want[i] = (len(t), sum(e - b for b, e in runs), b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
    rows = substring_dedup.report(docs).collect()
    assert len(rows) == len(corpus())
    assert {r.doc_id: (r.n_bytes, r.n_removed, (r.text or "").encode()) for r in rows if r.doc_id is not None} == want
    assert next(r for r in rows if r.doc_id is None).n_removed == 0
    shared = prose(900, 60).split()
    kept = [r for r in rows if r.doc_id in range(20, 25) and " ".join(shared[15:45]) in r.text]
    assert [r.doc_id for r in kept] == [20]
    assert next(r for r in rows if r.doc_id == 3).n_removed == 0
    assert next(r for r in rows if r.doc_id == 60).text is None


def test_substring_dedup_removes_short_copies_and_passages(spark):
    """Planted copies, found by plain string search: whole short texts, and passages of 300 characters."""
    short = ["Thtion.", "Edstou reinan ed for.", "a", "日本", "fifty-nine bytes of text that are a document of their own"]
    rows = [(10 * i + k, t) for i, t in enumerate(short) for k in range(3)]
    rng = random.Random(5)
    planted = {}
    for k, letters in enumerate(("abcdefghijklmnopqrstuvwxyz     ", "абвгдежзиклмнопрстуфхцчшщыэюя     ", "日本語文字列重複除去検索言葉一二三四五六七八九十百千")):
        word = lambda n: "".join(rng.choice(letters) for _ in range(n))  # noqa: B023, E731
        for i in range(200):
            at = 10_000 * (k + 1) + 2 * i
            planted[at + 1] = word(300)
            rows += [(at, word(80) + planted[at + 1] + word(80)), (at + 1, word(90) + planted[at + 1] + word(90))]
    left = {r.doc_id: r.text for r in substring_dedup.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert all(left[10 * i] == t and left[10 * i + 1] == left[10 * i + 2] == "" for i, t in enumerate(short))
    texts = dict(rows)
    assert all(left[i] == texts[i] for i in texts if i >= 10_000 and i not in planted)
    for k in range(1, 4):
        whole = [i for i, p in planted.items() if i // 10_000 == k and p in left[i]]
        assert len(whole) <= 2, (k, len(whole))


def test_substring_dedup_keeps_columns(docs, none):
    clash = docs.withColumnsRenamed({"lang": "n_bytes", "n_chars": "spans"})
    assert substring_dedup.dedup(clash).columns == clash.columns
    assert substring_dedup.dedup(none).count() == 0


# --- 2 ---------------------------------------------------------------------


def brute_windows(rows: dict[int, bytes], depth: int = 100) -> dict:
    seen, out = set(), {}
    for i, t in sorted(rows.items()):
        gone = bytearray(len(t))
        for s in range(len(t) - depth + 1):
            if t[s : s + depth] in seen:
                gone[s : s + depth] = b"\1" * depth
            seen.add(t[s : s + depth])
        left = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for j in range(len(t)) if gone[j] and (not j or not gone[j - 1]))
        out[i] = (len(t), len(t) - len(left), spans, hashlib.sha256(left).hexdigest())
    return out


def test_suffix_dedup_equals_brute_force(docs, none):
    rows = suffix_dedup.report(docs.select("text", "lang", "doc_id")).collect()
    want = brute_windows(texts())
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows if r.doc_id is not None} == want
    assert next(r for r in rows if r.doc_id is None).n_removed == 0
    assert suffix_dedup.report(none).count() == 0


def test_suffix_dedup_repeated_rows(spark):
    t = prose(3, 80)
    df = spark.createDataFrame([(1, t), (1, t), (2, t[40:] + "end")], "doc_id long, text string")
    rows = sorted((r.doc_id, r.n_removed) for r in suffix_dedup.report(df).collect())
    assert rows[:2] == [(1, 0), (1, 0)] and rows[2][1] == len(t[40:].encode())
    kept = {r.doc_id: r.text for r in suffix_dedup.dedup(df).collect()}
    assert kept[1] == t and kept[2] == "end"


# --- 3 ---------------------------------------------------------------------


def brute_hits(text: str, items: dict[int, str], n: int = 10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    own, hit, found = words(text), set(), set()
    for item, t in items.items():
        ws = words(t)
        size = min(n, len(ws))
        for i in range(len(ws) - size + 1 if size else 0):
            for j in range(len(own) - size + 1):
                if own[j : j + size] == ws[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("block_words", [1_000_000, 5])
def test_decontaminate_equals_brute_force(spark, docs, none, block_words):
    items = {1: prose(900, 60), 2: prose(2, 12).upper(), 3: "one, TWO", 10: "Ab", 4: "", 5: "日本語" * 120, 6: prose(2, 12)}
    bench = spark.createDataFrame([*items.items(), (7, None), (None, "one"), (3, "one, TWO")], "item_id long, text string")
    got = decontaminate.report(docs.withColumn("items", docs.lang), bench, block_words=block_words).collect()
    want = {i: brute_hits(t.decode(), items) for i, t in texts().items()}
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got if r.doc_id is not None} == want
    assert all(r.contaminated == (r.n_hit > 0) for r in got) and len(got) == len(corpus())
    kept = decontaminate.decontaminate(docs, bench, "documents", block_words=block_words)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, w in want.items() if not w[1]}
    cut = decontaminate.decontaminate(docs, bench, "spans", block_words=block_words).collect()
    assert len(cut) == len(corpus()) and next(r for r in cut if r.doc_id == 60).text is None
    assert prose(900, 60) not in " ".join(r.text or "" for r in cut)
    assert decontaminate.report(none, bench).count() == 0
    assert not decontaminate.report(docs, bench.limit(0)).filter("contaminated").count()


def test_decontaminate_string_item_ids(spark):
    docs = spark.createDataFrame([(1, "red green blue"), (2, "red"), (3, "blue")], "doc_id long, text string")
    bench = spark.createDataFrame([("b-10", "green"), ("b-9", "red"), ("ü", "GREEN"), (None, "blue")], "item_id string, text string")
    for block_words in (1, 1000):
        got = {r.doc_id: r for r in decontaminate.report(docs, bench, block_words=block_words).collect()}
        ids = {1: "b-10,b-9,ü", 2: "b-9", 3: ""}
        assert {i: r.items_sha256 for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in ids.items()}
        assert {i: (r.n_hit, r.n_items, r.contaminated) for i, r in got.items()} == {1: (2, 3, True), 2: (1, 1, True), 3: (0, 0, False)}


# --- 4 ---------------------------------------------------------------------


def waterfill(sizes: dict, share: float = 1.5, cap: float = 2.0) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    rest = share * sum(sizes.values())
    while rest > 1e-9 and len(full) < len(names):
        open_ = [s for s in names if s not in full]
        unit, rest = rest / sum(weight[s] for s in open_), 0.0
        for s in open_:
            target[s] += unit * weight[s]
            if target[s] >= cap * sizes[s]:
                rest += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                full.add(s)
    return target


def test_mix_meets_targets(spark, none):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randint(1, 60))), "en", ("hot" if i % 3 == 0 else rng.choice(["a", "b", None])), None) for i in range(1200)]
    rows += [(5000, None, "en", "a", None), (5001, "  ", "en", "b", None), (5002, "", None, "empty", None), (7, rows[7][1], "en", rows[7][3], None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("size", mixing.F.lit("clash"))
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want = waterfill(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    assert mixing.mix(none).count() == 0
    out = mixing.mixed_documents(df)
    assert out.columns == [*df.columns, "copy"]
    assert out.count() >= sum(r.copies for r in got)


def test_mix_of_repeated_and_null_ids(spark):
    """40,000 rows of null id and equal size are one class: no leaf grows with them."""
    df = spark.range(41_000).selectExpr("if(id < 40000, null, id) AS doc_id", "'a b c' AS text", "if(id % 3 = 0, 'one', 'two') AS source")
    got = mixing.mix(df, share=0.7, weights=(1,)).groupBy("source", "doc_id", "target", "copies").agg(mixing.F.count("*").alias("n"), mixing.F.sum("taken").alias("taken")).collect()
    assert sum(r.n for r in got) == 41_000 and sum(r.n for r in got if r.doc_id is None) == 40_000
    for source in ("one", "two"):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 6
        none_copies = {r.copies for r in own if r.doc_id is None}
        assert max(none_copies) - min(none_copies) <= 1 and max(none_copies) <= 2


def test_spread_in_pieces(spark):
    classes = spark.createDataFrame([(1, "a", 5, 10, 23), (None, None, 5, 1, 2), (2, "a", 5, 4096, 1)], "doc_id long, source string, size long, same long, copies long")
    for largest in (0, 1 << 40):
        got = mixing._spread(classes, largest, piece=4).groupBy("doc_id").agg(
            mixing.F.count("*").alias("n"), mixing.F.sum("copies").alias("c"), mixing.F.max("copies").alias("most"), mixing.F.min("copies").alias("least")).collect()
        assert {(r.doc_id, r.n, r.c, r.most, r.least) for r in got} == {(1, 10, 23, 3, 2), (None, 1, 2, 2, 2), (2, 4096, 1, 1, 0)}


def test_rounding_is_fair(spark):
    """Over seeds a document's copies average its probability."""
    df = spark.createDataFrame([(i, "w " * (i % 7 + 1), "en", "one" if i % 2 else "two", None) for i in range(40)], DOCS)
    total: dict = {}
    seeds = 12
    for seed in range(seeds):
        for r in mixing.mix(df, seed=seed, share=0.5, weights=(1,)).collect():
            total[r.doc_id] = total.get(r.doc_id, 0) + r.copies
    assert 0.4 < sum(total.values()) / (40 * seeds) < 0.6
    assert sum(0 < v < seeds for v in total.values()) > 30


# --- 5 and 6 ---------------------------------------------------------------


def test_toxicity_learns_and_folds(spark, none):
    rng = random.Random(1)
    bad = ["grobnik", "snarfel", "plugh"]
    rows, labels = [], []
    for i in range(600):
        words = prose(i, 40).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(40), rng.choice(bad) + rng.choice(["", "", "s", "en"]))
        if i % 9 == 1:
            words[5:5] = ["snarfel", "bridge"]  # a clean phrase
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int").filter("doc_id < 400"))
    assert any(e.startswith("grob") for e in lexicon.weights)
    odd = [(1000, None), (1001, ""), (1002, "a GRÓBNIK and a snarf3l, plu​gh"), (1003, "grоbnik gr0bnik PLUGH"), (None, "x"), (1004, "calm " * 50_000 + "grobnik")]
    scored = {r.doc_id: r.score for r in toxicity.score(docs.union(spark.createDataFrame(odd, docs.schema)), lexicon).collect()}
    wrong = sum((scored[i] >= 0.3) != bool(y) for i, y in labels[400:])
    assert wrong <= 2
    assert scored[1000] == scored[1001] < 0.3 and scored[1002] >= 0.3 and scored[1003] >= 0.3
    assert toxicity.score(none, lexicon).count() == 0
    flat = toxicity.fit(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert len({r.score for r in toxicity.score(docs, flat).collect()}) == 1
    judged = toxicity.judged(toxicity.score(docs, flat), 4, 2).collect()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in judged)


def test_signs_at_a_words_edge():
    lexicon = toxicity.Lexicon({"bad": 2.0, "grob": 3.0}, frozenset(["bad"]), frozenset(["not bad"]))
    automaton = lexicon.automaton()

    def hits(text):
        return toxicity.evidence(toxicity.fold(text), automaton)[1]

    assert hits("you are bad") == hits("you are bad!") == hits("!bad") == hits("|bad|") == hits("bad+bad") + 1 == hits("BAD\u200b!!!") == 1
    assert toxicity.fold("k!ll s|t bu+t !a+ 1+1") == "kill sit butt !a+ iti"
    assert hits("not bad!") == 0 and hits("grobian! grob|") == 2 and hits("!" * 1_000_000 + "bad") == 1


def plain_toxicity(text, lexicon):
    """Every start of every word against every entry, without an automaton."""
    folded, found, covered = toxicity.fold(text), {}, []

    def ends(at):
        return at >= len(folded) or not folded[at].isalnum()

    entries = sorted(lexicon.weights, key=len)
    for at in range(len(folded)):
        if at == 0 or not folded[at - 1].isalnum():
            for e in entries:
                if folded.startswith(e, at) and (e not in lexicon.whole or ends(at + len(e))):
                    found[at] = lexicon.weights[e]
            covered += [(at, at + len(e)) for e in lexicon.exceptions if folded.startswith(e, at) and ends(at + len(e))]
    kept = [w for at, w in found.items() if not any(b <= at < e for b, e in covered)]
    total = sum(kept)
    x = (math.log(1 + max(total, 0)), math.log(1 + 1000 * max(total, 0) / (len(folded) + 200)), float(bool(kept)))
    return 1 / (1 + math.exp(-(lexicon.bias + sum(a * b for a, b in zip(lexicon.slopes, x, strict=True))))), len(kept)


def test_toxicity_equals_plain_scorer(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    lexicon = toxicity.fit(docs, labels)
    if not lexicon.weights:  # too few labelled rows for the marks of entries
        lexicon = toxicity.Lexicon({"th": 1.5, "ion": 0.5, "the": 2.0}, frozenset(["the"]), frozenset(["and the"]), -1.0, (0.5, 0.25, 0.1))
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = toxicity.score(docs, lexicon).collect()
    assert len(got) == len(texts) and any(r.n_hits for r in got)
    for r in got:
        score, n = plain_toxicity(texts[r.doc_id], lexicon)
        assert r.n_hits == n and r.score == pytest.approx(score, abs=1e-9)


def plain_statistics(text):
    """The statistics of a text in plain Python, blanks as the JVM's ``\\s``."""
    blank = "[ \\t\\n\\x0b\\f\\r]"
    t = text or ""
    n, words = max(len(t), 1), [w for w in re.split(blank + "+", t) if w]
    per = max(len(words), 1)
    repeats = 0
    for m in regex.finditer(r"(?<![^ \t\n\x0b\f\r])([^ \t\n\x0b\f\r]+)(?:[ \t\n\x0b\f\r]+\1(?![^ \t\n\x0b\f\r]))++", t):
        repeats += len(m[0]) - len(m[1])

    def share(chars):
        return sum(t.count(c) for c in chars) / n

    return {
        "n_words": float(len(words)), "word_length": len(t) / per, "distinct_words": len(set(words)) / per, "signs": share("#$%&*@^~=_<>{}[]\\/+"),
        "bars": share("|"), "shouts": share("!?"), "capitals": len(regex.findall(r"\p{Lu}", t)) / n, "digits": share("0123456789"), "stops": share(".,;:"),
        "lines": share("\n"), "spaces": len(re.findall(blank, t)) / n, "repeats": repeats / n,
    }


def test_quality_equals_plain_scorer(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    names = list(quality.statistics(quality.F.lit("")))
    # Every statistic takes part, also those that the fitted rules leave out.
    rules = [*model.rules, *[(quality.Rule(((name, True, x),)), 0.01 * (i + 1)) for i, (name, x) in enumerate(zip(names, [50, 6, 0.7, 0.001, 0.0, 0.001, 0.03, 0.001, 0.01, 0.001, 0.15, 0.001], strict=True))]]
    model = quality.Model(rules, model.bias)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.score(docs, model).collect():
        stats = plain_statistics(texts[r.doc_id])
        z = model.bias + sum(w for rule, w in model.rules if all(stats[k] > x if above else stats[k] <= x for k, above, x in rule.parts))
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_quality_rules(spark, none):
    rows, labels = [], []
    for i in range(500):
        text = prose(i, 60)
        if i % 5 == 0:
            text = [text.upper() + "!!", "spam " * 60, text.replace(" ", " | "), text.replace(" ", "$$$ ")][i // 5 % 4]
        rows.append((i, text))
        labels.append((i, int(i % 5 != 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int").filter("doc_id < 350"))
    assert model.rules and all(rule.parts for rule, _ in model.rules)
    odd = spark.createDataFrame([(1000, None), (1001, ""), (None, "x"), (1002, "word " * 100_000)], docs.schema)
    scored = {r.doc_id: r.score for r in quality.score(docs.union(odd), model).collect()}
    assert sum((scored[i] >= 0.3) != bool(y) for i, y in labels[350:]) <= 3
    assert scored[1000] == scored[1001] and len(scored) == 504
    wide = docs.withColumn("n_words", quality.F.lit("clash"))
    assert quality.keep(wide, model).columns == wide.columns
    assert quality.score(none, model).count() == 0
    assert quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int")).rules == []


# --- 7 ---------------------------------------------------------------------


def brute_components(rows: dict[int, bytes], words: int = 4, percent: int = 85) -> dict:
    sets = {}
    for i, t in rows.items():
        ws = [w for w in re.split(rb"[\x20\x09-\x0D]+", t.lower()) if w]
        sets[i] = {tuple(ws[j : j + words]) for j in range(max(1, len(ws) - words + 1))} if ws else set()
    label = {i: i for i in rows}
    changed = True
    links = [(a, b) for a in rows for b in rows if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i]) for i in rows}


def test_jaccard_join_equals_brute_force(docs, none):
    rows = jaccard_join.join(docs.withColumnRenamed("lang", "n")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == brute_components(texts())
    assert next(r for r in rows if r.doc_id is None).component_id is None
    assert len(rows) == len(corpus())
    assert jaccard_join.join(none).count() == 0
    kept = jaccard_join.keep_one(docs, 5, 80)
    want = brute_components(texts(), 5, 80)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if c == i} | {None}


def test_large_family(spark):
    """A family beyond every bucket bound: leaders, sketch blocks, and links that the leader does not have."""
    rng = random.Random(3)
    base = prose(1, 60).split()
    rows = {}
    for i in range(300):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(60)] = f"w{rng.randrange(6)}"
        rows[i] = " ".join(copy).encode()
    df = spark.createDataFrame([(i, t.decode()) for i, t in rows.items()], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(df).collect()}
    assert got == brute_components(rows)


def test_sketches_never_lose_a_link():
    rng = random.Random(2)
    import numpy as np

    for _ in range(300):
        n = rng.randint(1, 900)
        a = np.array([rng.getrandbits(63) for _ in range(n)], np.int64)
        keep = max(1, int(n * rng.uniform(0.7, 1)))
        b = np.concatenate([a[:keep], np.array([rng.getrandbits(63) for _ in range(rng.randint(0, n // 5))], np.int64)])
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 85 * (len(a) + len(b) - shared):
            assert jaccard_join.may_link(jaccard_join.sketch(a), jaccard_join.sketch(b), len(a), len(b))


def test_quality_of_long_repeats_and_repeated_fits(spark):
    """Long runs of one word, as documents and as labelled rows, with every statistic in use."""
    rows = [(i, ("a " * 200_000 if i % 2 else "b" * 300_000) if i < 4 else prose(i, 20) + (" !! $$ spam spam spam" * 5 if i % 2 else ""), i % 2) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(docs, docs.select("doc_id", "quality"))
    again = quality.fit(docs.repartition(7), docs.select("doc_id", "quality").repartition(5))
    assert model.rules and (model.rules, model.bias) == (again.rules, again.bias)
    every = [quality.Rule(((name, True, 0.5),)) for name in quality.statistics(quality.F.lit(""))]
    assert quality.score(docs, quality.Model([(r, 0.1) for r in every], 0.0)).count() == 60


def test_substring_dedup_keeps_clashing_columns(spark):
    row = prose(5, 80)
    docs = spark.createDataFrame([(1, row, 7, 8, 9, 3), (2, row, 70, 80, 90, 30)], "doc_id long, text string, _at int, _of int, _spans int, at int")
    out = sorted(map(tuple, substring_dedup.dedup(docs).collect()))
    assert out == [(1, row, 7, 8, 9, 3), (2, "", 70, 80, 90, 30)] and substring_dedup.dedup(docs).columns == docs.columns
