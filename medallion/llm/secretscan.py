"""Secret scanning with a random forest that removes false positives.

Method: candidates are runs of 16 or more characters that keys and encodings are written in,
with a digit; a token that white space bounds may have many of them. A forest, trained from labelled findings,
scores them on length, on how kinds of character follow each other, on how much of the token is
made of dictionary words, on the path, and on the neighbouring words.

Candidates and features are built-in expressions and the forest is Spark's own, so no Python
runs in a task. The dictionary is counted over all documents: words in several of them, reduced
per partition before the shuffle, and only words that candidates contain are kept. Training
takes at most about ``max_findings`` rows, chosen by hash; every candidate is scored.

Defined cases: null and empty texts have no candidates; a null path is the empty one; rows that
share an id are separate texts, of which equal findings in equal places are one; if the labels are of one kind only, every score is that label,
without any 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import stored

VALUE = "[A-Za-z0-9+/_=.@-]{16,}"
KEYWORDS = "token|secret|passw(or)?d|pwd|api_?key|access_?key|credential|auth|bearer|private"
MOCK = "example|sample|dummy|placeholder|changeme|test|xxxx"
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
FEATURES = (
    "length",
    "digits",
    "upper",
    "symbols",
    "distinct",
    "changes",
    "letter_to_digit",
    "longest_hex",
    "coverage",
    "path_group",
    "path_mock",
    "assigned",
    "keyword",
    "mock",
    "quoted",
    "neighbour_length",
)


def candidates(docs: DataFrame, id_column: str, path_column: str, text_column: str) -> DataFrame:
    """id, path, ``place`` (token number), ``part`` (number of the value among the candidates of
    its token), ``value``, ``lead`` (its token since the value before, with that if it has no
    digit), and what is ``before`` and ``after``: at the ends of a token two words and one,
    inside it nothing and the text up to the next value."""
    words = docs.select(
        docs[id_column].alias("id"),
        F.coalesce(docs[path_column].cast("string"), F.lit("")).alias("path"),
        F.split(docs[text_column], "[ \\t\\n\\x0B\\f\\r]+").alias("words"),
    )
    tokens = words.select("*", F.posexplode("words").alias("place", "token"))
    tokens = tokens.where((F.length("token") >= 16) & F.col("token").rlike("[0-9]") & F.col("token").rlike(VALUE))
    parted = tokens.select(
        "id",
        "path",
        F.col("place").cast("long").alias("place"),
        F.concat_ws(" ", F.get("words", F.col("place") - 2), F.get("words", F.col("place") - 1)).alias("words_before"),
        F.coalesce(F.get("words", F.col("place") + 1), F.lit("")).alias("word_after"),
        F.regexp_extract_all("token", F.lit(VALUE), F.lit(0)).alias("values"),
        F.split("token", VALUE).alias("gaps"),
    )

    def described(value: Column, k: Column) -> Column:
        earlier = F.coalesce(F.get("values", k - 1), F.lit(""))
        named = F.when(earlier.rlike("[0-9]"), F.lit("")).otherwise(earlier)
        last = k == F.size("values") - 1
        return F.struct(
            value.alias("value"),
            F.concat(named, F.get("gaps", k)).alias("lead"),
            F.when(k == 0, F.col("words_before")).otherwise(F.lit("")).alias("before"),
            F.when(last, F.col("word_after")).otherwise(F.get("gaps", k + 1)).alias("after"),
        )

    every = F.filter(F.transform("values", described), lambda c: c["value"].rlike("[0-9]"))
    found = parted.select("id", "path", "place", F.posexplode(every).alias("part", "c"))
    return found.select("id", "path", "place", F.col("part").cast("long").alias("part"), "c.*")


def dictionary(docs: DataFrame, found: DataFrame, text_column: str, min_count: int) -> DataFrame:
    """Letter words of at least three characters that ``min_count`` texts have outside of runs
    that could be candidates, and that stand somewhere in a candidate. A secret that is copied
    does not become a word by that."""
    wanted = found.select(F.explode(_pieces(F.col("value"))).alias("word")).distinct()
    prose = F.lower(F.regexp_replace(docs[text_column], VALUE, " "))
    words = docs.select(F.explode(F.array_distinct(F.split(prose, "[^a-z]+"))).alias("word"))
    counted = words.where(F.length("word") >= 3).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count).join(wanted, "word", "left_semi").select("word")


def _pieces(value: Column) -> Column:
    return F.filter(F.split(F.lower(value), "[^a-z]+"), lambda w: F.length(w) >= 3)


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with ``FEATURES`` as doubles."""
    numbered = stored(
        found.select("*", F.xxhash64("id", "place", "part", "value").alias("finding")).distinct(), "candidates"
    )
    pieces = numbered.select("finding", F.explode(F.array_distinct(_pieces(F.col("value")))).alias("word"), "value")
    size = F.length("word") * F.size(F.filter(_pieces(F.col("value")), lambda w: w == F.col("word")))
    covered = (
        pieces.join(words, "word")
        .select("finding", size.alias("size"))
        .groupBy("finding")
        .agg(F.sum("size").alias("covered"))
    )
    value = F.col("value")
    kinds = F.translate(F.translate(F.translate(value, UPPER, "U" * 26), LOWER, "L" * 26), DIGITS, "0" * 10)
    kinds = F.regexp_replace(kinds, "[^UL0]", "S")
    length = F.length("value")

    def share(kind: str) -> Column:
        return (length - F.length(F.replace(F.col("kinds"), F.lit(kind), F.lit("")))) / length

    near = F.concat_ws(" ", "before", "lead")
    hex_runs = F.regexp_extract_all(F.lower(value), F.lit("[0-9a-f]+"), F.lit(0))
    made = {
        "length": length,
        "digits": share("0"),
        "upper": share("U"),
        "symbols": share("S"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))),
        "changes": (F.length(F.regexp_replace("kinds", "(.)\\1+", "$1")) - 1) / length,
        "letter_to_digit": F.size(F.split("kinds", "[UL]0")) - 1,
        "longest_hex": F.array_max(F.transform(hex_runs, F.length)) / length,
        "coverage": F.coalesce("covered", F.lit(0)) / length,
        "path_group": F.pmod(F.xxhash64("path"), F.lit(16)),
        "path_mock": F.lower("path").rlike(f"{MOCK}|fixture|spec").cast("int"),
        "assigned": near.rlike("[=:]\\W*$").cast("int"),
        "keyword": F.lower(near).rlike(KEYWORDS).cast("int"),
        "mock": F.lower(F.concat_ws(" ", near, "value", "after")).rlike(MOCK).cast("int"),
        "quoted": F.col("lead").rlike("[\"'`]$").cast("int"),
        "neighbour_length": F.length("after"),
    }
    return (
        numbered.join(covered, "finding", "left")
        .select("*", kinds.alias("kinds"))
        .select(*numbered.columns, *(F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"f_{n}") for n, c in made.items()))
    )


def weak_label(found: DataFrame) -> Column:
    """A label by rule, for tables that come without labelled findings: a known format that is
    assigned to a name of a secret is one; cards, addresses and unnamed values are not."""
    value = F.col("value")
    known = value.rlike("^[0-9a-f]{32,64}$") | value.rlike("^(AKIA|ghp_|xox[bp]-|sk-|eyJ)")
    named = F.lower(F.concat_ws(" ", "before", "lead")).rlike(f"({KEYWORDS})\\W*[=:]\\W*$")
    mock = F.lower(F.concat_ws(" ", "before", "value")).rlike(MOCK)
    return (known & named & ~mock).cast("double")


def fit(findings: DataFrame, *, label_column: str = "label", max_findings: int = 20_000):
    """A forest over ``features`` of labelled findings, or the one label there is, or None."""
    findings = findings.where(F.col(label_column).isNotNull())
    sizes = {r[0]: r[1] for r in findings.groupBy(label_column).count().collect()}
    if len(sizes) < 2:
        return next(iter(sizes), None)
    draw = F.pmod(F.col("finding"), F.lit(1_000_000)) / F.lit(1_000_000.0)
    shares = [F.when(F.col(label_column) == k, max_findings / 2 / n) for k, n in sizes.items()]
    sample = findings.where(draw < F.coalesce(*shares))
    assembler = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="vector")
    sample = stored(sample.select("finding", label_column, *assembler.getInputCols()), "findings")
    forest = RandomForestClassifier(
        labelCol=label_column, featuresCol="vector", numTrees=24, maxDepth=7, subsamplingRate=0.7, seed=1
    )
    return forest.fit(assembler.transform(sample.orderBy("finding")))


def score(found: DataFrame, model) -> DataFrame:
    """``found`` with ``probability`` that it is a secret."""
    if model is None or isinstance(model, float):
        return found.select("*", F.lit(model or 0.0).alias("probability"))
    assembler = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="_vector")
    scored = model.setFeaturesCol("_vector").setProbabilityCol("_both").transform(assembler.transform(found))
    return scored.select(*found.columns, vector_to_array("_both")[1].alias("probability"))


def scan(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    path_column: str = "source",
    text_column: str = "text",
    labels: DataFrame | None = None,
    min_count: int = 3,
) -> DataFrame:
    """A row per candidate: the id, ``place``, ``part``, ``value_sha256``, ``length``, ``label``
    (null if unknown), ``held_out``, ``probability`` and ``is_secret``. ``labels``: id, place,
    part and label, where no ``part`` stands for the first; without it the label is
    ``weak_label``. Findings of every fourth id are not learned from. Equal findings at one place of rows that share an id are one finding."""
    found = candidates(docs, id_column, path_column, text_column)
    found = stored(found, "found")
    known = features(found, stored(dictionary(docs, found, text_column, min_count), "dictionary"))
    if labels is None:
        known = known.select("*", weak_label(known).alias("label"))
    else:
        part = F.col("part") if "part" in labels.columns else F.lit(0).cast("long")
        labels = labels.select(
            F.col(id_column).alias("id"), "place", part.alias("part"), F.col("label").cast("double")
        )
        known = known.join(labels, ["id", "place", "part"], "left")
    held_out = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % 4 == 0
    known = stored(known.select("*", held_out.alias("held_out")), "features")
    scored = score(known, fit(known.where("not held_out")))
    return scored.select(
        F.col("id").alias(id_column),
        "place",
        "part",
        F.sha2("value", 256).alias("value_sha256"),
        F.length("value").cast("long").alias("length"),
        "label",
        "held_out",
        "probability",
        (F.col("probability") >= 0.5).alias("is_secret"),
    )
