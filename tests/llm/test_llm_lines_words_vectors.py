"""Line runs, spelling variants and hard negatives against brute force, with odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.llm import hard_negatives, line_runs, variants

CLASHES = ["_doc", "_text", "_hash", "_key", "_id", "_lines", "_gone", "_null", "line", "k1", "k2", "docs", "keeper", "c0", "word", "n", "rank"]
BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# 12: levelled runs of line hashes


def kept_lines(rows, min_chars=20, min_docs=3):
    """(id, text) -> (lines, dropped, text) by dictionaries."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    where = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                where[key(line)].add(i)
    top = {k: max(d, key=lambda i: (i is not None, i or 0)) for k, d in where.items() if len(d) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if key(x) not in top or top[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(keep), None if t is None else "\n".join(keep)))
    return out


def line_rows():
    rng = random.Random(3)
    shared = [f"Shared line number {i} with É and more of it" for i in range(12)] + ["short", "", "  \t", "漢字" * 11, "x" * 20]
    rows = []
    for i in range(60):
        lines = [rng.choice([rng.choice(shared), rng.choice(shared).upper(), f" \t{rng.choice(shared)}\x0b", f"a line of its own {i} {rng.random()}"]) for _ in range(rng.randrange(9))]
        rows.append((rng.choice([i, -i]), "\n".join(lines)))
    rows += [(None, "\n".join(shared)), (None, None), (100, None), (101, ""), (102, "\n\n"), (103, shared[0]), (103, shared[0]), (103, "\n".join([shared[1], "other", shared[0], shared[0]]))]
    return [*rows, (104, "the same line over and over again\n" * 20_000), (105, "the same line over and over again"), (106, "THE same line over and over again\nend")]


@pytest.mark.parametrize("how", [{}, {"batches": 1}, {"batches": 7, "fanout": 2}, {"batches": 30, "fanout": 3}])
def test_lines_that_go(spark, how):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *[F.lit(7).alias(c) for c in CLASHES])
    out = line_runs.drop_repeats(df, **how)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, kept_lines(rows)))
    assert any(n and i is not None for i, _, n, _ in got) and all(r.c0 == 7 for r in out.limit(3).collect())
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_lines_of_text_ids_and_empty_tables(spark):
    rows = [(i, "one line that all of them have\nend") for i in "dbca"]
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_runs.drop_repeats(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": ("end", 1), "b": ("end", 1), "c": ("end", 1), "d": ("one line that all of them have\nend", 0)}
    assert line_runs.drop_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_runs_are_merged_and_settled_keys_stay_out(spark):
    """One key stands in every document of 16 batches, the others in one each."""
    index = line_runs.LineRuns(spark, fanout=2, buckets=3)
    try:
        for b in range(16):
            rows = [(100 - 4 * b - i, k, 0) for i in range(4) for k in (1, 1000 + 4 * b + i)]
            index.absorb(spark.createDataFrame(rows, "_doc bigint, k1 bigint, k2 bigint"))
        assert [len(level) for level in index.levels] == [0, 0, 0, 0, 1]
        held = {r.k1: (r.docs, r.keeper.doc) for r in index.held().collect()}
        assert held[1] == (4, 100) and len(held) == 65 and held[1063] == (1, 37)
        more = spark.createDataFrame([(1, 1, 0), (2, 5, 0)], "_doc bigint, k1 bigint, k2 bigint")
        index.absorb(more)
        held = {r.k1: (r.docs, r.keeper.doc) for r in index.held().collect()}
        assert held[1] == (4, 100) and held[5] == (1, 2)
    finally:
        index.close()


# 13: trie-node pairs


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def all_variants(counts, ratio=10):
    best, sizes = {}, {}
    for w in counts:
        found = [v for v in counts if near(w, v)]
        sizes[w] = len(found)
        top = min(found, key=lambda v: (-counts[v], v), default=None)
        best[w] = top if top and counts[top] >= ratio * counts[w] else None
    root = lambda w: root(best[w]) if best[w] else w
    return sorted((w, best[w], root(w), n, sizes[w], counts.get(best[w])) for w, n in counts.items())


@pytest.fixture(scope="module")
def many_words():
    rng = random.Random(5)
    words = {"".join(rng.choice("aabé") for _ in range(rng.randrange(5, 9))) for _ in range(500)} | {"a" * 3000, "a" * 3001, "a" * 2999 + "b", "b" + "a" * 3000}
    return {w: rng.choice([2, 3, 20, 25, 300, 300, 4000]) for w in words}


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_variants_against_all_pairs(spark, many_words, parts):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.createDataFrame(list(many_words.items()), "word string, n bigint")
        out = variants.variants(df)
        assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == all_variants(many_words)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_node_numbers_of_cut_tries(many_words):
    """However the sorted words are cut, two prefixes have one number if and only if they are equal."""
    words = sorted(w for w in many_words if len(w) < 50)
    rng = random.Random(1)
    for cuts in (0, 1, 5, 60, len(words) - 1):
        at = [0, *sorted(rng.sample(range(1, len(words)), cuts)), len(words)]
        parts = [words[a:b] for a, b in zip(at, at[1:], strict=False)]
        ends = [(3 * i, p[0], p[-1]) for i, p in enumerate(parts)]
        names, number, prefix = variants.borders(ends), {}, {}
        for i, p in enumerate(parts):
            last = i + 1 == len(parts)
            for w, path in zip(p, variants.paths(iter(p), ends[i][0], names[i], None if last else parts[i + 1][0], [] if last else names[i + 1]), strict=True):
                for d, x in enumerate(path):
                    assert number.setdefault(w[:d], x) == x and prefix.setdefault(x, w[:d]) == w[:d]


def test_pair_groups_are_bounded_by_the_alphabet(spark):
    """Words that share a long prefix share no pair but those of their neighbours."""
    words = [f"commonprefix{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    df = spark.createDataFrame(list(enumerate(words)), "rank bigint, word string")
    pairs = variants.pair_dictionary(df)
    assert pairs.count() == sum(2 * len(w) + 1 for w in words)
    assert pairs.groupBy("p", "s").count().agg(F.max("count")).first()[0] == 8


@pytest.mark.parametrize("slip", [None, 2])
def test_word_counts(spark, slip):
    rows = [(1, "Größere größere GRÖSSERE straße× abcdefg abcdefgh"), (2, "GRößere the Abcdefg-abcdefg"), (None, "größere abcdefg1abcdefg"), (3, None), (4, ""), (4, "ñandúes ÑANDÚES " * 3000), (4, "abcdefg")]
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if slip and h % slip == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += len(w) >= 7
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(1))
    got = {r.word: r.n for r in variants.word_counts(df, slip_every=slip).collect()}
    assert got == {w: n for w, n in counts.items() if n >= 2} and got
    assert variants.variants(variants.word_counts(df.limit(0))).collect() == []


# 11: Strassen tiles


def test_strassen():
    rng = np.random.default_rng(2)
    for m, k, n in ((1, 1, 1), (17, 64, 33), (40, 33, 129), (3, 200, 90), (64, 64, 64), (0, 5, 7), (100, 0, 40)):
        a, b = (rng.integers(-2**15, 2**15, s) for s in ((m, k), (k, n)))
        assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all()
    a, b = (rng.integers(-2**62, 2**62, (30, 30)) for _ in "ab")  # sums wrap, and the results are equal modulo 2**64
    assert (hard_negatives.strassen(a, b, leaf=2) == a @ b).all()


def mined(rows, every, least=80, most=100, k=5):
    whole = lambda x: [int(np.floor(256 * float(c))) for c in x]
    own = [(i, y, whole(x)) for i, y, x in rows if y is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, y, x in own:
        if i is None or i % every:
            continue
        scored = [(dot(x, v), j, z) for j, z, v in own if j != i]
        for p, j, _ in sorted((r for r in scored if r[2] == y), key=order)[:k]:
            negatives = sorted((r for r in scored if r[2] != y and least * p <= 100 * r[0] <= most * p), key=order)[:k]
            out += [(i, j, n + 1, m, p, s) for n, (s, m, _) in enumerate(negatives)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("sizes", [{}, {"block": 7, "anchors": 2}, {"block": 50, "anchors": 1}])
def test_hard_negatives_against_all_pairs(spark, sizes):
    rng = random.Random(8)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 3, -5]), [rng.choice([-.5, 0., .25, .75, 1.]) for _ in range(3)]) for i in range(150)]
    rows += [(i, 0, [1., .5, .25]) for i in range(150, 170)] + [(10, 1, [1., 1., 1.]), (10, 1, [1., 1., 1.]), (12, 2, [1., 1., 1.]), (12, 2, [1., 1., 1.])]  # copies, repeated rows
    rows += [(None, 0, [1., 1., 1.]), (None, 2, [1., .5, .25]), (171, None, [1., 1., 1.]), (172, 1, None), (173, 1, [float("nan"), 1., 1.]), (180, 1, [float("inf"), 1., 1.]), (175, 1, [None, 1., 1.]),
             (176, 1, []), (190, 0, [1.]), (178, 0, [.5, .5]), (200, 99, [1., 1., 1.]), (179, 3, [40., 40., 40.]), (210, 3, [-1., -1., -1.])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").withColumn("id", F.lit(1)).withColumn("block", F.lit(2))
    got = hard_negatives.mine(df, lambda i: i % 10 == 0, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows, 10)
    assert sorted(map(repr, map(tuple, got.collect()))) == want and len(want) > 100


def test_hard_negatives_of_empty_tables_and_text_labels(spark):
    schema = "vec_id bigint, label string, embedding array<float>"
    assert hard_negatives.mine(spark.createDataFrame([], schema), lambda i: i % 10 == 0).collect() == []
    rows = [(0, "a", [1., 0.]), (1, "a", [1., 0.]), (2, "b", [.9, .1]), (3, "c", [.5, .1]), (4, "é", [1.1, 0.])]
    got = hard_negatives.mine(spark.createDataFrame(rows, schema), lambda i: i == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 2, 65536, 256 * 230)]
    assert hard_negatives.mine(spark.createDataFrame(rows, schema), lambda i: i > 50).collect() == []
