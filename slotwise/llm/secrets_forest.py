"""Operator 8 (native): secret scan with a random forest against false positives.

Candidates are long runs of key characters. Their features are length, make-up, character
transitions and dictionary coverage (both learnt from all words of the corpus), path and
neighbouring words. A random forest, trained on labelled findings, decides which are secrets.
Everything is DataFrame and Spark ML code; no Python runs on the executors.

Labelled findings are a table with the features and ``label``. ``labelled_by_context`` derives one from the
corpus where none is given: a value assigned to a credential name is a secret; runs of
digits, plain words, and values named as hashes or ids are not; the rest has no label.

Bounds: the dictionary holds words with a share of at least ``1 / WORDS`` of all words, so at most ``WORDS``
of them; the transition table has 28 x 28 cells; the forest learns from about ``SAMPLE`` distinct findings a class.

Defined results: null and empty texts have no candidates; a null path has no path features; with findings of
one label only no forest is grown and the context rule decides alone (score 1 or 0); repeated rows give
repeated findings; an empty table gives none; only the named columns are read; texts are scanned whole.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}"
WORDS, SAMPLE = 100_000, 10_000
BEFORE, AFTER = 48, 32
#: Names that credentials are assigned to, names that hashes and ids follow, kinds of path.
CREDENTIAL = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|bearer|credential)[^\n]{0,12}$"
HARMLESS = r"(?i)(sha-?\d*|md5|commit|checksum|digest|uuid|guid|hash|isbn|card|phone)\W{0,4}$"
CONFIG_PATH, TEST_PATH = r"(?i)\.(env|ya?ml|json|ini|cfg|conf|toml|properties)$", r"(?i)(test|example|sample|mock|fixture|doc)"
FEATURES = ["length", "digits", "uppers", "marks", "variety", "hexadecimal", "transitions", "coverage", "assigned", "credential", "harmless", "quoted", "joined", "config", "test"]


def dictionary(docs: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """word, n: the frequent words of all texts (letters only, lower case, 3 to 12 letters)."""
    counts = (docs.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")).where("word <> ''")
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    counts = durable(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where((F.col("n") * words >= total) & F.length("word").between(3, 12))


def _class(c: Column) -> Column:
    """0-25 for a letter, 26 for a digit, 27 for any other character."""
    at = F.ascii(c)
    return F.when(at.between(97, 122), at - 97).when(at.between(48, 57), 26).otherwise(27)


def _pairs(c: Column) -> Column:
    """Transitions of a string as cell numbers of the 28 x 28 table."""
    chars = F.transform(F.split(F.lower(c), ""), _class)
    return F.zip_with(F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0))), F.slice(chars, 2, F.size(chars)), lambda a, b: a * 28 + b)


def transitions(words: DataFrame) -> list[float]:
    """Log-probability of each transition in the dictionary's words, add-one smoothed."""
    seen = dict(words.select("n", F.explode(_pairs(F.col("word"))).alias("cell")).groupBy("cell").agg(F.sum("n")).collect())  # 784 rows at most
    out = []
    for a in range(28):
        row = [seen.get(a * 28 + b, 0) + 1 for b in range(28)]
        out += [math.log(n / sum(row)) for n in row]
    return out


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """_doc, _text_hash, path, candidate, start, before, after: one row per candidate."""
    own = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"), F.col(path).cast("string").alias("path")).where(F.col("_text").rlike(CANDIDATE))
    own = own.select("_doc", F.xxhash64("_text").alias("_text_hash"), "path", F.monotonically_increasing_id().alias("_row"),
                     F.regexp_extract_all("_text", F.lit(CANDIDATE), F.lit(0)).alias("_found"), F.split("_text", CANDIDATE).alias("_gaps"))
    each = F.transform("_found", lambda c, i: F.struct(
        c.alias("candidate"), F.right(F.get("_gaps", i), F.lit(BEFORE)).alias("before"),
        F.left(F.get("_gaps", i + 1), F.lit(AFTER)).alias("after"), F.length(F.get("_gaps", i)).alias("gap")))
    rows = own.select("_doc", "_text_hash", "path", "_row", F.posexplode(each).alias("_pos", "c")).select("_doc", "_text_hash", "path", "_row", "_pos", "c.*")
    # One window per document row, over lengths only: where a candidate starts.
    w = Window.partitionBy("_row").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.length("candidate")).over(w) - F.length("candidate")
    return rows.withColumn("start", start).drop("_row", "_pos", "gap")


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """candidate, coverage: share of the characters of each distinct candidate that dictionary words cover."""
    parts = found.select("candidate").distinct().select("candidate", F.lower("candidate").alias("low"))
    at = parts.select("candidate", "low", F.explode(F.sequence(F.lit(1), F.length("low"))).alias("at"), F.sequence(F.lit(3), F.lit(12)).alias("sizes"))
    cut = at.select("candidate", "at", F.explode("sizes").alias("size"), "low").where("at + size - 1 <= length(low)")
    cut = cut.select("candidate", "at", "size", F.expr("substring(low, at, size)").alias("word")).where(F.col("word").rlike("^[a-z]+$"))
    hit = cut.join(F.broadcast(words.select("word")), "word", "left_semi")  # at most WORDS rows
    covered = hit.select("candidate", F.explode(F.expr("sequence(at, at + size - 1)")).alias("place")).distinct()
    return covered.groupBy("candidate").agg((F.count(F.lit(1)) / F.length("candidate")).alias("coverage"))


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    c, n = F.col("candidate"), F.length("candidate")
    share = lambda pattern: (F.length(F.regexp_replace(c, pattern, "")) / n).alias
    table = F.array(*[F.lit(x) for x in transitions(words)])
    pairs = _pairs(c)
    flag = lambda column, pattern: F.coalesce(F.col(column).rlike(pattern), F.lit(False)).cast("double")
    return found.join(coverage(found, words), "candidate", "left").select(
        *found.columns, n.cast("double").alias("length"), share(r"[^0-9]")("digits"), share(r"[^A-Z]")("uppers"), share(r"[A-Za-z0-9]")("marks"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("variety"), flag("candidate", r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$").alias("hexadecimal"),
        F.coalesce(F.aggregate(pairs, F.lit(0.0), lambda s, i: s + F.get(table, i)) / F.size(pairs), F.lit(0.0)).alias("transitions"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"), flag("before", r"""[:=]\s*["']?$""").alias("assigned"), flag("before", CREDENTIAL).alias("credential"),
        flag("before", HARMLESS).alias("harmless"), (flag("before", r"""["']$""") * flag("after", r"""^["']""")).alias("quoted"),
        flag("before", r"[/.@&?]$").alias("joined"), flag("path", CONFIG_PATH).alias("config"), flag("path", TEST_PATH).alias("test"))


def by_context() -> Column:
    """1 for a mixed value assigned to a credential name, 0 for harmless findings, else null."""
    mixed = F.col("digits").between(0.05, 0.95)
    return (F.when((F.col("assigned") + F.col("credential") == 2) & mixed, 1.0)
            .when((F.col("digits") == 1) | (F.col("harmless") == 1) | ((F.col("digits") == 0) & (F.col("assigned") == 0)), 0.0))


def labelled_by_context(featured: DataFrame) -> DataFrame:
    return featured.withColumn("label", by_context()).where("label IS NOT NULL").select(*FEATURES, "label", "candidate")


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def grow(labelled: DataFrame, sample: int = SAMPLE) -> RandomForestClassificationModel | None:
    """The forest, from about ``sample`` distinct labelled findings a class; None without both classes.

    Copies of a finding (candidate and features) count as one, so one that is repeated neither fills the draw nor empties it.
    """
    labelled = durable(labelled.select(*FEATURES, "label", "candidate").distinct())
    sizes = dict(labelled.groupBy("label").count().collect())
    if not sizes.get(0.0) or not sizes.get(1.0):
        return None
    draw = F.pmod(F.xxhash64("candidate", *FEATURES, F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    limit = F.when(F.col("label") == 1, min(1.0, sample / sizes[1.0])).otherwise(min(1.0, sample / sizes[0.0]))
    drawn = labelled.where(draw < limit).select(*FEATURES, "label")
    # Sorted in one small partition, so the trees' draws do not depend on how the rows lay.
    drawn = durable(drawn.coalesce(1).sortWithinPartitions("label", *FEATURES))
    if drawn.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=20, maxDepth=6, seed=11).fit(_vectors(drawn))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source",
         labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Every candidate with _doc, _text_hash, start, score and is_secret."""
    words = durable(dictionary(docs, text))
    featured = durable(with_features(durable(candidates(docs, doc_id, text, path)), words))
    forest = grow(labelled_by_context(featured) if labelled is None else labelled)
    if forest is None:
        scored = featured.withColumn("score", F.coalesce(by_context(), F.lit(0.0)))
    else:
        scored = forest.transform(_vectors(featured)).withColumn("score", F.round(F.get(vector_to_array("probability"), F.lit(1)), 6))
    return scored.select("_doc", "_text_hash", F.col("start").cast("long").alias("start"), "candidate", "score", (F.col("score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source", mark: str = "[SECRET]",
           labelled: DataFrame | None = None) -> DataFrame:
    """The documents with every secret replaced by ``mark``."""
    found = scan(docs, doc_id, text, path, labelled).where("is_secret")
    # Bounded by one text; longer secrets first, so none is left in part.
    own = found.groupBy("_doc", "_text_hash").agg(F.collect_set("candidate").alias("_secrets"))
    own = own.withColumn("_secrets", F.reverse(F.array_sort(F.transform("_secrets", lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))))))
    rest = [c for c in docs.columns if c != text]
    docs_ = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_key"), F.col(text).alias("_text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    both = docs_.join(own, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_text_hash")), "left")
    new = F.when(F.col("_secrets").isNull(), F.col("_text")).otherwise(F.aggregate("_secrets", F.col("_text"), lambda t, s: F.replace(t, s["s"], F.lit(mark))))
    back = {c: F.col(f"c{i}").alias(c) for i, c in enumerate(rest)} | {text: new.alias(text)}
    return both.select(*[back[c] for c in docs.columns])
