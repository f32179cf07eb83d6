"""Each operator against a brute-force version, an exact round trip or held-out labels."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from slotwise.llm import components, cover_search, licenses, line_dedup, near_texts, packing, perplexity, piece_scan, queries, secrets_forest, simhash, toxicity, url_globs

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.SQL[name])
    columns, rows = [d[0] for d in want.description], want.fetchall()
    df = queries.QUERIES[name](spark, SF)
    assert df.columns == columns
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, rows))


# 1: base rules, and a Kneser-Ney model computed from its definition


def test_base_rules(spark, texts):
    for r in queries.QUERIES["op1_perplexity"](spark, SF).collect():
        t = texts[r.doc_id]
        w = WORD.findall(t)
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        times, covered = Counter(windows), set()
        for i, x in enumerate(windows):
            if times[x] > 1:
                covered |= set(range(i, i + 5))
        lines = t.split("\n")
        dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert r.kept == (not r.base_failed and r.lower <= r.perplexity <= r.upper) or abs(r.perplexity / r.lower - 1) < 1e-5 or abs(r.perplexity / r.upper - 1) < 1e-5


def reference_cost(texts):
    """Modified Kneser-Ney over dictionaries: cost in nats of the last symbol of a 4-gram."""
    def symbols(t):
        return bytes(3) + t.encode().translate(perplexity.TABLE) + bytes(1)

    counts = {4: Counter(s[i:i + 4] for s in map(symbols, texts) for i in range(len(s) - 3))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount = {}
    for k, c in counts.items():
        n = Counter(min(v, 5) for v in c.values())
        y = n[1] / (n[1] + 2 * n[2])
        d3 = 3 - 4 * y * n[4] / n[3] if n[3] else 1.5
        discount[k] = [0, min(max(1 - 2 * y * n[2] / n[1], .05), .95), min(max(2 - 3 * y * n[3] / n[2], .05), 1.9), min(max(d3, .05), 2.9)] if n[1] and n[2] else [0, .5, .5, .5]
    after = {k: defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, v in c.items():
            after[k][g[:-1]].append(v)

    def p(g):
        if not g:
            return 1 / perplexity.CLASSES
        k, context = len(g), after[len(g)].get(g[:-1])
        if context is None:
            return p(g[1:])
        c, total = counts[k][g], sum(context)
        return (c - discount[k][min(c, 3)]) / total + sum(discount[k][min(v, 3)] for v in context) / total * p(g[1:])

    return p


def test_kneser_ney(spark):
    some = ["the one and the other", "another day, another way", "THE END 12", "é ü", "the the the the"]
    df = spark.createDataFrame([(0, t) for t in some], "_lang int, _text string")
    model, p = perplexity.train(df, 1), reference_cost(some)
    code = np.arange(perplexity.CLASSES**4)
    cost = model.cost(0, code)
    assert abs(np.exp(-cost / perplexity.UNIT).reshape(-1, perplexity.CLASSES).sum(1) - 1).max() < 1e-4
    rng = random.Random(1)
    seen = [s[i:i + 4] for s in (bytes(3) + t.encode().translate(perplexity.TABLE) + bytes(1) for t in some) for i in range(len(s) - 3)]
    for g in seen + [bytes(rng.randrange(32) for _ in range(4)) for _ in range(300)]:
        at = int(sum(int(x) << 5 * (3 - i) for i, x in enumerate(g)))
        assert abs(cost[at] / perplexity.UNIT + math.log(p(g))) < 1e-5


def test_bytes_of_every_script_are_told_apart(spark):
    """Shuffled Cyrillic letters have the classes of prose."""
    rng = random.Random(5)
    words = ["".join(rng.choice(("ка", "то", "ре", "ни", "ва", "ст", "ов")) for _ in range(rng.randint(1, 4))) for _ in range(200)]
    prose = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(120)]
    noise = ["".join(rng.choice("абвгдежзиклмнопрстуф") if c != " " else c for c in t) for t in prose[:6]]
    df = spark.createDataFrame([(i, t, "ru") for i, t in enumerate(prose + noise)], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in perplexity.judge(df).collect()}
    assert sum(kept[i] for i in range(120)) > 110 and not any(kept[i] for i in range(120, 126))


def test_model_of_bytes(spark):
    """Kneser-Ney over dictionaries for the n-grams that end in a non-ASCII byte; each fold by the counts of the other."""
    rng = random.Random(3)
    some = ["".join(rng.choice("éèüßжш a") for _ in range(rng.randint(0, 40))) for _ in range(40)]
    df = spark.createDataFrame([(0, t) for t in some * 2], "_lang int, _text string")
    totals = perplexity.total(perplexity.count_ngrams(df, 3, 5)).persist()
    fold = {r._text: r._hash & 1 for r in df.select("_text", perplexity.text_key()).collect()}
    counts, every = {6: [Counter(), Counter()]}, Counter()
    for t in set(some):
        x = b"\xff" * 5 + t.encode() + b"\xff"
        counts[6][fold[t]].update(x[i - 5:i + 1] for i in range(5, len(x)) if 128 <= x[i] < 255)
        every.update(b for b in x[5:] if 128 <= b < 255)
    for k in range(5, 1, -1):
        counts[k] = [Counter(g[1:] for g in c) for c in counts[k + 1]]

    def p(g, f):
        if len(g) == 1:
            return (every[g[0]] + 1) / (sum(every.values()) + 127)
        c = counts[len(g)][1 - f]
        n = Counter(c.values())
        d = perplexity.discounts_of([0.0, *(float(n[j]) for j in (1, 2, 3, 4))])
        after = [v for x, v in c.items() if x[:-1] == g[:-1]]
        if not after:
            return p(g[1:], f)
        return (c[g] - d[min(c[g], 3)] + sum(d[min(v, 3)] for v in after) * p(g[1:], f)) / sum(after)

    rows = perplexity.wide_model(totals, perplexity.byte_shares(totals)).collect()
    assert {r.code.to_bytes(6) for r in rows} == set(counts[6][0]) | set(counts[6][1])
    for r in rows:
        g = r.code.to_bytes(6)
        assert abs(r.p0 - p(g, 0)) < 1e-9 and abs(r.p1 - p(g, 1)) < 1e-9


def test_noise_is_rejected_and_prose_kept(spark):
    own = queries.QUERIES["op1_perplexity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    share = {r.quality: r.k for r in own.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert share[1] > 0.95 and share[0] < 0.3


def test_copies_do_not_move_the_bands(spark, docs):
    own = docs.where("lang = 'fr' and n_chars > 400").dropDuplicates(["text"])
    one = own.orderBy("doc_id").limit(1)
    copies = one.crossJoin(spark.range(own.count() + 10).select(F.col("id") + 1_000_000)).drop("doc_id").withColumnRenamed("(id + 1000000)", "doc_id")
    without, with_ = ({r.doc_id: (r.kept, r.perplexity, r.lower, r.upper) for r in perplexity.judge(d).collect() if r.doc_id < 1_000_000} for d in (own, own.unionByName(copies)))
    assert with_ == without and sum(k for k, *_ in without.values()) > len(without) / 2


# 2: fingerprints and classes


def slow_fingerprint(text):
    w = text.encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(points):
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1:] ^ points[i]) <= 3) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def test_near_copies(docs, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_copies(docs, shard=60, sample=400).collect()}
    ids = sorted(texts)
    points = np.array([slow_fingerprint(texts[i]) for i in ids], np.uint64)
    assert [got[i][0] for i in ids] == [f"{x:016x}" for x in points.tolist()]
    assert [got[i][1] for i in ids] == [ids[k] for k in classes(points)]


def test_dense_balls_and_blocks(spark):
    rng = np.random.default_rng(5)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(2500)]
    points = np.unique(np.concatenate([np.uint64(0x0123456789ABCDEF) ^ np.array(flips, np.uint64), rng.integers(0, 2**63, 500, dtype=np.uint64)]))
    want = classes(points)
    df = spark.createDataFrame(pd.DataFrame({"fp": points.view(np.int64)}))
    found = {r.u: r.v for r in components.connected(simhash.links(df, shard=300, sample=5000)).collect()}
    groups = defaultdict(set)
    for x, k in zip(points.view(np.int64).tolist(), want, strict=True):
        groups[k].add(found.get(x, x))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)
    at, label = simhash.ball_links(points)
    assert [int(x) for x in label] == want


def test_near_texts_of_the_pipeline(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    rows, want = [], set()
    for i in range(0, 120, 2):  # differing words cost five shingles each: similarities from 0.98 to 0.67
        own = [word() for _ in range(248)]
        other = own.copy()
        for k in range(1 + i // 2 % 10):
            other[12 + 24 * k] = word()
        sets = [{tuple(t[j:j + 5]) for j in range(len(t) - 4)} for t in (own, other)]
        rows += [(i, " ".join(own)), (i + 1, " ".join(other).upper())]
        want |= {i} if len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1]) else {i, i + 1}
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumns({"lang": F.lit("en"), "source": F.lit("x"), "n_chars": F.length("text")})
    assert 60 < len(want) < 120 and {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()} == want


def test_near_dedup_of_the_pipeline_compares_what_op2_links(spark, monkeypatch):
    """Without any MinHash key the fingerprints alone bring near copies up; texts that they link below 0.8 both stay."""
    rng = random.Random(5)
    own = [f"w{rng.random()}" for _ in range(300)]
    near = own[:150] + ["other"] + own[151:]
    a = " ".join(["one two three four five six seven"] * 12)
    b = a + " eight one two three four five six seven"
    docs = spark.createDataFrame(list(enumerate([" ".join(own), " ".join(near), a, b])), "doc_id int, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("x"), "n_chars": F.length("text")})
    near_copies = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    assert near_copies == {0: 0, 1: 0, 2: 2, 3: 2}
    keyed = near_texts.keyed
    monkeypatch.setattr(near_texts, "keyed", lambda *args: keyed(*args).withColumn("keys", F.array().cast("array<bigint>")))
    assert {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()} == {0, 2, 3}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5000 + rng.randrange(400), 5000 + rng.randrange(400)) for _ in range(250)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in list(parent) if find(x) != x}
    assert {r.u: r.v for r in components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()} == want


# 3: held-out labels


def test_toxicity_on_held_out_labels(spark):
    path = SF.replace("0.01", "0.1")
    got = queries.QUERIES["op3_toxicity"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out").toPandas()
    hit = ((got.predicted == 1) & (got.toxic == 1)).sum()
    assert hit / (got.toxic == 1).sum() > 0.85 and hit / (got.predicted == 1).sum() > 0.85
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    assert got.held_out.all() and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id)


def test_naive_bayes_features_are_presence():
    of, bucket = toxicity.present(["abcabc", "", "ABC abc"])
    want = [{t[i:i + n] for n in toxicity.SIZES for i in range(len(t) - n + 1)} for t in (" abcabc ", "  ", " abc abc ")]
    assert [int((of == i).sum()) for i in range(3)] == [len(w) for w in want]


# 4 and 5: exact round trips


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(docs).collect()
    by = defaultdict(list)
    for r in rows:
        assert r.length & (r.length - 1) == 0 and r.length <= 2048 and len(r.ids) == 4 * r.length
        by[r.doc_id].append(r)
    assert len({r.sequence_id for r in rows}) == len(rows)
    for i, text in texts.items():
        own = sorted(by[i], key=lambda r: r.start)
        ids = [x for r in own for x in struct.unpack(f"<{r.length}I", r.ids)]
        assert ids == [*t.encode(text, add_special_tokens=False).ids, 1]
        assert [r.start for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1]) and {r.doc_tokens for r in own} == {len(ids)}


@pytest.mark.parametrize("text", ["", "a", "it's 12% OFF... Ünïcode ÉÈ", "Σίγμα ΣΑΣ", "é İstanbul ﬁ", "<|endoftext|> x <|startoftext|>y", "a b c\x1cd\n\n e", "x" * 5000, "漢字かな交じり文 \U0001F600"])
def test_words_are_the_tokenizers(text):
    words = packing.words_of(public_tokenizers.path("word_bpe_49k.json"))
    assert packing.unpack(words.text(text)).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_decompose():
    for n in [1, 2, 3, 2047, 2048, 2049, 10_000]:
        cut = packing.decompose(n)
        assert sum(cut) == n and len(cut) == n // 2048 + bin(n % 2048).count("1")


def scanned(p, text, chunk):
    u = piece_scan.normalise(text)
    c = piece_scan.cuts(u, chunk)
    spans = list(zip(c[:-1], c[1:], strict=True))
    at = piece_scan.cut_states([piece_scan.transfer(p, u, a, b) for a, b in spans]) if spans else [0]
    out = b"".join(piece_scan.backtrace(p, u, a, b, i, j) for (a, b), i, j in zip(spans, at[:-1], at[1:], strict=True))
    return list(struct.unpack(f"<{len(out) // 4}I", out))


def test_scan_equals_library():
    p, rng = piece_scan.model(), random.Random(3)
    parts = ["a", "b", "th", "e", "er", " ", "  ", "\n", "é", "한", "\U0001F600", "\t", "1", "12", "==", "    ", "▁", "-", "ing", "tion", "A", "http://", "0", "<0x0A>", "</s>"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        for chunk in (1, 3, 8, 20):
            assert scanned(p, text, chunk) == p.sp.encode(text), (text, chunk)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz01") for _ in range(5000))
    assert scanned(p, text, 700) == p.sp.encode(text)


def test_max_plus_product_is_associative():
    rng = random.Random(4)
    m = [{(rng.randrange(5), rng.randrange(5)): float(rng.randrange(9)) for _ in range(12)} for _ in range(3)]
    assert piece_scan.combine(piece_scan.combine(m[0], m[1]), m[2]) == piece_scan.combine(m[0], piece_scan.combine(m[1], m[2]))


def test_encode_and_decode(docs, texts):
    by = defaultdict(list)
    for r in piece_scan.decode(piece_scan.encode(docs, chunk=3000)).collect():
        by[r.doc_id].append(r)
    sp = piece_scan.model().sp
    assert max(map(len, by.values())) > 3
    for i, text in texts.items():
        own = sorted(by[i], key=lambda r: r.chunk)
        ids = b"".join(r.ids for r in own)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == sp.encode(text) and "".join(r.text for r in own) == text


# 6: what is removed, from the definition; the SQL check has the offsets


def test_clean_removes_the_spans(docs, texts):
    seen, spans = {}, defaultdict(list)
    for i in sorted(texts):
        at = 0
        for line in re.findall(r"[^\n]*\n|[^\n]+$", texts[i]):
            found = [(at, at + len(line), line, 5)]
            parts = re.split(r"(?<=[.!?])(?=[ \t])", line.rstrip("\n"))
            begin = at
            if len(parts) > 1:
                parts = [re.sub(r"^[ \t]+", "", p) for p in parts]
                for p in parts:
                    begin = texts[i].index(p, begin)
                    end = begin + len(p)
                    while end < at + len(line) and texts[i][end] in " \t\n":
                        end += 1
                    found.append((begin, end, p, 8))
                    begin = end
            for b, e, unit, least in found:
                words = tuple(unit.lower().split())
                if len(words) >= least and seen.setdefault(words, (i, b)) < (i, b):
                    spans[i].append((b, e))
            at += len(line)
    for r in line_dedup.clean(docs).collect():
        gone = set()
        for b, e in spans[r.doc_id]:
            gone |= set(range(b, e))
        assert sorted((s.start, s.end) for s in r.removed) == sorted(spans[r.doc_id])
        assert r.text == "".join(c for k, c in enumerate(texts[r.doc_id]) if k not in gone)


def test_passage_within_lines(spark):
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage = f"{prose(20).capitalize()}. {prose(30)}! {prose(9)}."
    rows = [(1, f"{prose(12)}. {passage} {prose(5)}."), (2, f"{prose(3)}.\n{prose(7)} {passage} {prose(8)}")]
    got = {r.doc_id: r for r in line_dedup.clean(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[1].text == rows[0][1] and not got[1].removed
    assert passage[-200:] not in got[2].text and len(rows[1][1]) - len(got[2].text) > 0.6 * len(passage)
    assert all(rows[1][1][s.start:s.end] in rows[0][1] for s in got[2].removed)


# 7: cosines from the definition, and inheritance


def test_licenses(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(1, "a/LICENSE", f"Project\n{notice}\n" + "more words here " * 40), (2, "a/b/c.txt", "code"), (3, "a/b/d.txt", "some code that goes on for more than a line\nReleased under the MIT License."), (4, "z/e.txt", "code"),
            (5, "a/b/q/COPYING.md", "This work is licensed under the GNU General Public License, version 3."), (6, "a/b/q/r/f.txt", "code"), (7, "ab/c.txt", "code"), (8, "a/g.txt", "a license is needed for cats")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, p string, text string"), "p").collect()}
    assert {i: r.license for i, r in got.items()} == {1: "Apache-2.0", 2: "Apache-2.0", 3: "MIT", 4: None, 5: "GPL-3.0", 6: "GPL-3.0", 7: None, 8: "Apache-2.0"}
    assert (got[2].own, got[2].inherited_from, got[6].inherited_from, got[3].inherited) == (None, "a", "a/b/q", None)
    vocabulary = {t for forms in licenses.TEMPLATES.values() for f in forms for t in re.findall(r"[a-z0-9]+", f.lower())}
    texts = [set(re.findall(r"[a-z0-9]+", t.lower())) for _, _, t in rows]
    idf = lambda t: math.log(9 / (1 + (sum(t in x for x in texts) if t in vocabulary else 0))) + 1
    vector = lambda s: {t: n * idf(t) for t, n in Counter(re.findall(r"[a-z0-9]+", s.lower())).items()}
    dot = lambda a, b: sum(x * b.get(t, 0) for t, x in a.items())
    cat = vector("a license is needed for cats")
    best = max(dot(cat, v) / math.sqrt(dot(cat, cat) * dot(v, v)) for forms in licenses.TEMPLATES.values() for v in map(vector, forms))
    assert abs(got[8].similarity - best) < 1e-6


def test_license_lines_of_the_corpus(spark, texts):
    got = {r.doc_id: r.own for r in queries.QUERIES["op7_licenses"](spark, SF).collect()}
    marks = {"MIT License.": "MIT", "Apache License, Version 2.0.": "Apache-2.0", "General Public License, version 3.": "GPL-3.0", "CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    for i, t in texts.items():
        own = [name for mark, name in marks.items() if mark in t]
        assert got[i] in own if own else got[i] is None


# 8: candidates and their places, and findings kept from learning


def test_secret_candidates(spark, texts):
    found = queries.QUERIES["op8_secrets_forest"](spark, SF).collect()
    want = Counter((i, m.start(), m.end(), m[0]) for i, t in texts.items() for m in re.finditer(secrets_forest.CANDIDATE, t))
    assert Counter((r.doc_id, r.span_start, r.span_end, r.candidate) for r in found) == want
    true = {(i, m[1]) for i, t in texts.items() for m in re.finditer(r'token = "([0-9a-f]{40})"', t, re.I)}
    assert {(r.doc_id, r.candidate.lower()) for r in found if r.is_secret} == {(i, s.lower()) for i, s in true}


def test_forest_learns_from_given_labels(spark):
    rng = random.Random(6)
    secret = lambda: "".join(rng.choice("0123456789abcdefABCDEFxyzXYZ") for _ in range(24))
    rows = [(i, f'config with api_key = "{secret()}" set' if i % 2 else f"see commit {secret()} and averylongordinaryword in it", "app/x.yaml" if i % 2 else "docs/readme") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    words = secrets_forest.dictionary(df)
    featured = secrets_forest.with_features(secrets_forest.candidates(df), words)
    labelled = featured.withColumn("label", F.col("assigned")).select(*secrets_forest.FEATURES, "label", "candidate", "_doc")
    scored = secrets_forest.scan(df, labelled=labelled.where("_doc < 120")).where("_doc >= 120 and not candidate rlike '^[a-z]+$'").collect()
    assert len(scored) == 80 and all(r.is_secret == bool(r["_doc"] % 2) for r in scored)


def test_a_repeated_finding_neither_fills_nor_empties_the_draw(spark):
    blank = dict.fromkeys(secrets_forest.FEATURES, 0.0)
    rows = [blank | {"label": 1.0, "candidate": "hot", "assigned": 1.0}] * 4000
    rows += [blank | {"label": label, "candidate": f"{label}-{i}", "assigned": label, "length": float(i)} for label in (0.0, 1.0) for i in range(5)]
    few = spark.createDataFrame(pd.DataFrame(rows))
    for hot in ("hot", "warm", "cold", "tepid"):  # before, about half of the names left the label without a row
        forest = secrets_forest.grow(few.replace("hot", hot, "candidate"), sample=20)
        scored = forest.transform(secrets_forest._vectors(few.dropDuplicates(["candidate"]))).collect()
        assert all(r.prediction == r.label for r in scored)


def test_redact(docs, texts):
    for r in secrets_forest.redact(docs).collect():
        assert r.text == re.sub(r'(?i)(token = ")[0-9a-f]{40}"', r'\1[SECRET]"', texts[r.doc_id])


# 9: the automaton against regular expressions


def test_automaton():
    rng, letters = random.Random(7), "ab./-"
    globs = ["".join(rng.choice([*letters, "*", "**", "?"]) for _ in range(rng.randint(1, 14))) for _ in range(40)]
    pattern = lambda g: re.compile("".join({"**": r"[\s\S]*", "*": r"[^/]*", "?": r"[^/]"}.get(x, re.escape(x)) for x in re.findall(r"\*\*|.", g)))
    compiled, a = [pattern(g) for g in globs], url_globs.Automaton(globs)
    assert a.words > 2
    urls = ["".join(rng.choice(letters + "é") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    assert a.run(urls).tolist() == [[p.fullmatch(u) is not None for p in compiled] for u in urls]


# 10: pruned search against all pairs


def test_dual_tree_prunes_nothing_needed():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 12)) * 300
    x = np.floor(centres[rng.integers(0, 6, 900)] + rng.normal(size=(900, 12)) * 20)
    q, ids = x[:60], rng.permutation(900)
    got = defaultdict(list)
    for row, i, _, s in cover_search.dual_search(q, np.arange(60), x, ids, np.arange(900), 5, np.full(60, -np.inf)):
        got[row].append((-s, i))
    for r in range(60):
        want = sorted((-int(q[r] @ x[c]), int(ids[c])) for c in range(900) if c != r)[:5]
        assert got[r] == want


def test_search_in_small_blocks(spark):
    own = spark.read.parquet(f"{SF}/embeddings.parquet")
    whole = sorted(map(tuple, cover_search.top_k(own, lambda i: i % 50 == 0).collect()))
    assert sorted(map(tuple, cover_search.top_k(own, lambda i: i % 50 == 0, block=37, group=3).collect())) == whole


# the pipeline against the operators' own results, and its near-dedup against all pairs


def least_of_similar(texts, size=5, similarity=0.8):
    """The least id of each class of texts that exact Jaccard similarities of word shingles link."""
    def shingles(t):
        w = WORD.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()

    ids = defaultdict(list)
    for i, t in texts.items():
        ids[shingles(t)].append(i)
    sets, holders, both = list(ids), defaultdict(list), Counter()
    for n, s in enumerate(sets):
        for x in s:
            both.update((m, n) for m in holders[x])
            holders[x].append(n)
    root = list(range(len(sets)))
    for (m, n), k in both.items():
        if k >= similarity * (len(sets[m]) + len(sets[n]) - k) and root[m] != root[n]:
            root = [root[m] if r == root[n] else r for r in root]
    least = {}
    for n, s in enumerate(sets):
        least[root[n]] = min([least.get(root[n], min(ids[s])), *ids[s]])
    return set(least.values())


def test_a_key_of_many_unlike_texts(spark):
    """Edits of one text share many keys and partly reach 0.8; blocks of a key are smaller than its texts."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    texts = {i: " ".join(w if rng.random() > 0.03 else f"x{rng.random()}" for w in base) for i in range(150)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    block, near_texts.BLOCK = near_texts.BLOCK, 8
    try:
        kept = {r.doc_id for r in near_texts.firsts(df).collect()}
    finally:
        near_texts.BLOCK = block
    assert kept == least_of_similar(texts) and 5 < len(kept) < 145


def test_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(6)
    for sides in (np.zeros(40, int), rng.integers(0, 2, 40)):
        sets = [np.unique(rng.integers(0, 12, rng.integers(0, 9))).astype(np.uint64) for _ in range(40)]
        roots = np.where(rng.random(40) < .3, 99, np.arange(40))
        pairs = [(i, j) for i in range(40) for j in range(i) if roots[i] != roots[j] and (sides[i] != sides[j] or not sides.any())
                 and len(set(sets[i]) & set(sets[j])) >= .6 * len(set(sets[i]) | set(sets[j]))]
        found = near_texts.forest(sets, sides, roots, .6)
        assert set(map(frozenset, found)) <= set(map(frozenset, pairs))

        def classes(links):
            root = list(roots)
            for i, j in links:
                root = [root[i] if r == root[j] else r for r in root]
            return [root.index(r) for r in root]

        assert classes(found) == classes(pairs)


def test_pipeline(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "secrets", "packing"]
    own, labels = docs, spark.read.parquet(f"{SF}/labels.parquet")
    steps = []
    for _, stage in corpus_pipeline.STAGES:
        own = stage(spark, own, SF).cache()
        steps.append(own)
    rows = [{r.doc_id: r.text for r in s.collect()} for s in steps[:4]]
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 1").collect()}
    assert set(rows[0]) == {r.doc_id for r in docs.collect()} - toxic
    near = least_of_similar(rows[0])
    assert set(rows[1]) == near and set(rows[2]) == set(rows[3]) == near
    left = {r.doc_id: r.text for r in line_dedup.clean(steps[1]).collect()}
    assert rows[2] == left
    assert all(not re.search(r'(?i)token = "[0-9a-f]{40}"', t) for t in rows[3].values())
    assert all(s.columns == docs.columns for s in steps[:4])
    final = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, final.drop("sequence_id").collect())) == sorted(map(str, packing.digest(steps[4]).drop("sequence_id").collect()))
