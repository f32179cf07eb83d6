"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import struct
import time
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from slotwise.llm import cover_search, licenses, line_dedup, packing, perplexity, piece_scan, secrets_forest, simhash, toxicity, url_globs
from slotwise.llm.common import CLEANUP, durable

LONG = "the one and the other of them went on and on " * 3000
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside.
CLASHES = ["_doc", "_text", "_hash", "_key", "_id", "_row", "start", "length", "unit", "score", "fp", "root", "ids", "chunk", "c0", "label", "candidate", "v", "removed_"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "some words that are here to be read by all of us", "en", "src", 48), (1, "some words that are here to be read by all of us", "en", "src", 48),
            (2, None, None, None, None), (None, "a text without an id but with words in it all the same", "en", "src", 5), (None, None, None, None, None),
            (3, "", "de", "src", 0), (4, " \t\n ", "xx", "src", 4), (5, LONG, "en", "src", len(LONG)), (6, "é ü 漢字 \U0001F600 🙂", "fr", "src", 9),
            (7, "some words that are here to be read by all of us", "en", "src", 48)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (5, 1, 0), (None, 1, 1), (7, None, None), (7, 0, 0), (7, 0, 1)], "doc_id bigint, quality int, toxic int")


def run_all(docs, labels):
    return {
        "perplexity": perplexity.judge(docs), "simhash": simhash.near_copies(docs), "firsts": simhash.firsts(docs),
        "toxicity": toxicity.score(docs, toxicity.fit(docs, labels)), "packing": packing.digest(packing.pack(docs)),
        "pieces": piece_scan.decode(piece_scan.encode(docs, chunk=1000)), "repeats": line_dedup.find_repeats(docs), "clean": line_dedup.clean(docs),
        "licenses": licenses.scan(docs, "source"), "secrets": secrets_forest.scan(docs), "redact": secrets_forest.redact(docs),
    }


def test_every_operator_takes_odd_rows(docs, labels):
    n = {k: len(df.collect()) for k, df in run_all(docs, labels).items()}
    assert n["perplexity"] == n["simhash"] == n["toxicity"] == n["clean"] == n["licenses"] == n["redact"] == 10
    assert n["secrets"] == 0 and n["packing"] >= 10


def test_every_operator_takes_empty_tables(docs, labels):
    for name, df in run_all(docs.limit(0), labels.limit(0)).items():
        assert df.collect() == [], name


def test_texts_and_other_columns_come_back(docs, labels):
    want = sorted(map(str, docs.collect()))
    assert sorted(map(str, secrets_forest.redact(docs).collect())) == want
    clean = line_dedup.clean(docs).drop("removed")
    assert clean.columns == docs.columns
    gone = {r.doc_id for r in clean.collect() if r.text == "" and r.doc_id not in (3,)}
    assert gone == {7}  # its one line is document 1's; the repeated rows of 1 both stay


def test_null_and_empty_results(docs, labels):
    rows = {r.doc_id: r for r in perplexity.judge(docs).collect() if r.doc_id}
    for i in (2, 3, 4):
        assert (rows[i].n_words, rows[i].base_failed, rows[i].kept) == (0, True, False)
    prints = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_copies(docs).collect()]
    zero = "0" * 16
    assert sorted(p for p in prints if p[0] in (2, 3, 4)) == [(i, zero, 2) for i in (2, 3, 4)]
    assert sorted(p[2] for p in prints if p[0] in (1, 7)) == [1, 1, 1]
    firsts = simhash.firsts(docs).collect()
    assert len(firsts) == len({p[1] for p in prints}) and {1, 2, 5, 6} <= {r.doc_id for r in firsts}
    one = [r for r in packing.pack(docs).collect() if r.doc_id == 2]
    assert [(r.start, r.length, bytes(r.ids)) for r in one] == [(0, 1, struct.pack("<I", 1))]


def test_urls(spark):
    rows = [(1, "http://Www.Example.COM/en/x?y#z"), (2, "https://a.example.com/en/"), (3, "http://example.com/de/"), (4, "http://x.net/es/1"), (5, "http://net/fr/"),
            (6, None), (7, "no scheme"), (8, "http://a.org/x.com/en/"), (9, "http://cheap-pills.org/"), (10, "http://example.com"), (11, "http://evilexample.com/en/"),
            (12, "http://a.org/" + "x" * 50_000), (12, "http://a.org/" + "x" * 50_000), (None, "://?"), (13, "http://h.com?a/b")]
    got = {(r.page_id, r.rule, r.verdict) for r in url_globs.judge(spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit(1))).collect()}
    assert got == {(1, "www.example.com/en/", "allow"), (2, "example.com/en/", "block"), (3, "com/", "allow"), (4, "net/es/", "block"), (5, "net/fr/", "block"),
                   (6, None, "allow"), (7, None, "allow"), (8, None, "allow"), (9, None, "block"), (10, None, "allow"), (11, "com/", "allow"), (12, None, "allow"),
                   (None, None, "allow"), (13, None, "allow")}


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (50, [0.5, -0.25]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [-1.0, 0.1]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(1))
    got = sorted(map(tuple, cover_search.top_k(df, lambda i: i % 50 == 0, k=3).collect()))
    s = lambda a, b: sum(int(256 * x // 1) * int(256 * y // 1) for x, y in zip(a, b, strict=True))
    assert got == [(0, 1, 1, s([.5, .25], [1, 1])), (0, 2, 2, s([.5, .25], [1, 1])), (0, 3, 50, s([.5, .25], [.5, -.25])),
                   (50, 1, 1, s([.5, -.25], [1, 1])), (50, 2, 2, s([.5, -.25], [1, 1])), (50, 3, 0, s([.5, -.25], [.5, .25]))]
    assert cover_search.top_k(df.limit(0), lambda i: i % 50 == 0).collect() == []


def test_pipeline_takes_odd_rows(spark, docs, labels, tmp_path):
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    labels = labels.withColumn("toxic", F.lit(0))  # no toxic label: the share of toxic texts is all that is learnt
    for part, df in (("full", own), ("none", own.limit(0))):
        folder = str(tmp_path / part)
        df.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        pieces = corpus_pipeline.run(spark, folder).collect()
        assert bool(pieces) == (part == "full")
        end = zlib.crc32(struct.pack("<I", 1))
        assert all(r.offset == 0 and (r.length > 1 or r.ids_crc32 == end or r.doc_tokens > 1) for r in pieces)


def test_few_edges_are_connected_without_shuffles(spark):
    """A round over few edges writes one checkpoint partition, however many shuffle partitions the session has."""
    from slotwise.llm.components import connected

    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint").repartition(8)
    out = connected(edges)
    assert {(r.u, r.v) for r in out.collect()} == {(i, 0) for i in range(1, 41)} | {(101, 100)}
    assert out.rdd.getNumPartitions() == 1


def test_a_durable_frame_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return sum(found.apply(i).isShuffle() for i in range(found.size()))

    spark.sparkContext._jvm.System.gc()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = files()
    out = durable(df)
    for _ in range(20):  # files are removed in the background
        if files() <= before:
            break
        time.sleep(0.5)
    assert files() <= before
    assert out.count() == 7 and df.collect() and sorted(durable(df).collect()) == sorted(out.collect())
    assert spark.conf.get(CLEANUP) == "false"
