"""Secrets in text, with a random forest that removes false findings. Expressions and Spark ML only.

Candidates are all longest runs of ``[A-Za-z0-9+/_.~-]`` in a word (text between white space) that have
``MIN_LENGTH`` characters and a digit, or ``MIN_LETTERS`` characters without one. What stands before one is the
text from the last ``NEAR`` runs of its word on, or, if it has fewer, its word so far and ``NEAR`` words more; after
it comes the text to the next run, or the next word. Features:

- length, shares of digits, capitals and distinct characters, changes between digits and letters and between
  cases per character,
- dictionary coverage: the share of its characters in runs of 3 to 12 letters that stand alone as words in at least
  ``DICTIONARY_ROWS`` places of the corpus, counted over all documents,
- path: whether the source looks like tests or examples, or like settings or keys,
- neighbouring words: names of credentials, of digests, of contact data, an assignment, quotes.

The forest learns from labelled findings; ``labelled`` gives them for a corpus without any, by a reviewer's
rule on findings outside a fold, each true finding also once more as a digest of the same characters, which is
none. At most TRAINING_ROWS of each class train it, those with the smallest hash of their place. Without both
classes every score is the share of true ones, 0 if there are none.

Null and empty texts have no findings, a null source is an empty path, a null doc_id is kept with its findings.
Rows that repeat have the same findings each; other columns are ignored, whatever their names; an empty table gives no
rows. A long text, or a long word, may hold any number of candidates."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from regtables.functions.binding import let
from regtables.llm.common import work_folder, written
from regtables.operators.sizing import small_side

MIN_LENGTH = 16
MIN_LETTERS = 24
DICTIONARY_ROWS = 5
TRAINING_ROWS = 5000
THRESHOLD = 0.5
HELD_FOLD, FOLDS = 2, 4
NEAR = 3  # words or runs looked at before a candidate

RUN = r"[A-Za-z0-9+/_.~-]{16,}"
CREDENTIAL = r"(?i)(token|secret|passw|passphrase|pwd|credential|bearer|auth|api|key)"
DIGEST = r"(?i)(sha-?\d*|md5|commit|checksum|hash|digest|uuid|guid|etag|revision|integrity)\b"
CONTACT = r"(?i)(mail|phone|tel|fax|card|iban|account|order|invoice|isbn)"
EXAMPLE_PATH = r"(?i)(test|example|sample|mock|fixture|doc|vendor)"
SETTINGS_PATH = r"(?i)(\.env|config|settings|secret|\.pem|\.key|\.ya?ml|\.ini|\.properties|\.tfvars)"

FEATURES = [
    "length", "digits", "capitals", "distinct_chars", "digit_changes", "case_changes", "coverage",
    "example_path", "settings_path", "credential_near", "digest_near", "contact_near", "assigned", "quoted",
]


def _words(words: Column) -> Column:
    """Long words that hold a run: word_no, word, ``since`` (characters from the long word before, or the beginning, to
    it), and the words around. Words are one white space character apart; empty ones between are counted too."""
    long = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("word_no"), w.alias("word"))), lambda c: (F.length(c["word"]) >= MIN_LENGTH) & c["word"].rlike(RUN))

    def placed(all_long: Column) -> Column:
        def of_word(c: Column, j: Column) -> Column:
            # get() of the index before the first is null.
            last = F.coalesce(F.get(all_long, j - 1)["word_no"], F.lit(0))
            between = F.slice(words, last + 1, c["word_no"] - last)
            return F.struct(
                c["word_no"].alias("word_no"), c["word"].alias("word"),
                F.aggregate(between, F.lit(0).cast("bigint"), lambda acc, w: acc + F.length(w) + 1).alias("since"),
                F.array_join(F.slice(words, F.greatest(c["word_no"] + 1 - NEAR, F.lit(1)), F.least(c["word_no"], F.lit(NEAR))), " ").alias("before"),
                F.coalesce(F.get(words, c["word_no"] + 1), F.lit("")).alias("after"),
            )

        return F.transform(all_long, of_word)

    return let(long, placed)


def _runs(c: Column) -> Column:
    """The runs of a word. A gap stands before each run, and one after the last. ``step`` is what a run begins behind
    the one before it, or behind the word's beginning."""
    cut = F.struct(F.regexp_extract_all(c["word"], F.lit(RUN), F.lit(0)).alias("runs"), F.split(c["word"], RUN, -1).alias("gaps"))

    def of_word(w: Column) -> Column:
        def of_run(value: Column, k: Column) -> Column:
            first = F.greatest(k - NEAR, F.lit(0))
            pieces = F.zip_with(F.slice(w["gaps"], first + 1, k - first + 1), F.slice(w["runs"], first + 1, k - first), lambda gap, run: F.concat(gap, F.coalesce(run, F.lit(""))))
            return F.struct(
                c["word_no"].alias("word_no"), k.alias("k"), value.alias("value"),
                F.when(k == 0, c["since"]).otherwise(0).alias("since"),
                (F.length(F.get(w["gaps"], k)) + F.coalesce(F.length(F.get(w["runs"], k - 1)), F.lit(0))).cast("bigint").alias("step"),
                F.when(k < NEAR, c["before"]).otherwise("").alias("before"),
                F.array_join(pieces, "").alias("lead"),
                F.get(w["gaps"], k + 1).alias("tail"),
                F.when(k + 1 == F.size(w["runs"]), c["after"]).otherwise("").alias("after"),
            )

        return F.transform(w["runs"], of_run)

    return let(cut, of_word)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, path, word_no, start (in characters), value, before (words), lead and tail (around it in its word), after (word).

    Places are running sums over a text's runs, so work grows with the text, however many it has."""
    words = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("path"), F.split(F.coalesce("text", F.lit("")), r"\s").alias("words"))
    found = let(F.col("words"), lambda w: F.flatten(F.transform(_words(w), _runs)))
    rows = words.select("doc_id", "path", F.monotonically_increasing_id().alias("row"), found.alias("runs")).where(F.size("runs") > 0)
    rows = rows.select("doc_id", "path", "row", F.explode("runs").alias("c")).select("doc_id", "path", "row", "c.*")
    in_text = Window.partitionBy("row").orderBy("word_no", "k").rowsBetween(Window.unboundedPreceding, 0)
    in_word = Window.partitionBy("row", "word_no").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("start", F.sum("since").over(in_text) + F.sum("step").over(in_word))
    rows = rows.where(F.col("value").rlike("[0-9]") | (F.length("value") >= MIN_LETTERS))
    return rows.select("doc_id", "path", "word_no", "start", "value", "before", "lead", "tail", "after")


def dictionary(docs: DataFrame, parts: DataFrame, least: int = DICTIONARY_ROWS) -> DataFrame:
    """Those of ``parts`` (part) that stand alone as words at least ``least`` times in the texts of ``docs``."""
    alone = docs.select(F.explode(F.split(F.lower("text"), r"[\s.,;:!?\"'()]+")).alias("part")).where(F.length("part").between(3, 12))
    return alone.join(small_side(parts), "part", "left_semi").groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("part")


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def with_features(found: DataFrame, docs: DataFrame, folder: str) -> DataFrame:
    """Candidates with a column for each of FEATURES. Candidates are kept as a table in ``folder``."""
    found = written(found, f"{folder}/candidates")
    values = found.select("value").distinct()
    parts = values.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("([a-z]+)"), F.lit(1))).alias("part")).where(F.length("part").between(3, 12))
    parts = written(parts, f"{folder}/parts")
    known = written(dictionary(docs, parts.select("part").distinct()), f"{folder}/dictionary")
    covered = parts.join(known, "part", "left_semi").groupBy("value").agg(F.sum(F.length("part")).alias("covered"))
    v = F.col("value")
    near = F.concat_ws(" ", "before", F.concat("lead", "value", "tail"), "after")
    named = F.concat_ws(" ", "before", "lead")
    flag = lambda c: c.cast("double")
    rows = found.join(covered, "value", "left")
    return rows.select(
        "doc_id", "path", "word_no", "start", "value", "before", "lead", "tail", "after",
        F.length(v).cast("double").alias("length"),
        _share(v, "[0-9]").alias("digits"),
        _share(v, "[A-Z]").alias("capitals"),
        (F.size(F.array_distinct(F.split(v, ""))) / F.length(v)).alias("distinct_chars"),
        _share(v, r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])").alias("digit_changes"),
        _share(v, r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])").alias("case_changes"),
        (F.coalesce("covered", F.lit(0)) / F.length(v)).alias("coverage"),
        flag(F.col("path").rlike(EXAMPLE_PATH)).alias("example_path"),
        flag(F.col("path").rlike(SETTINGS_PATH)).alias("settings_path"),
        flag(named.rlike(CREDENTIAL)).alias("credential_near"),
        flag(named.rlike(DIGEST)).alias("digest_near"),
        flag(near.rlike(CONTACT)).alias("contact_near"),
        flag(named.rlike(r"[=:]\s*[\"']?$")).alias("assigned"),
        flag(F.col("lead").rlike("[\"'`]$")).alias("quoted"),
    )


def labelled(findings: DataFrame, fold: int = HELD_FOLD, folds: int = FOLDS) -> DataFrame:
    """Labelled findings by a reviewer's rule: true are those of 20 characters or more, hardly covered by the
    dictionary, and given to a name of credentials in a path that is no example."""
    true = (F.col("length") >= 20) & (F.col("coverage") < 0.5) & (F.col("credential_near") == 1) & (F.col("assigned") == 1) & (F.col("digest_near") == 0) & (F.col("example_path") == 0)
    seen = findings.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds != fold, F.lit(True)))
    seen = seen.withColumn("is_secret", true.cast("double"))
    digests = seen.where("is_secret = 1").withColumns({"credential_near": F.lit(0.0), "digest_near": F.lit(1.0), "is_secret": F.lit(0.0)})
    return seen.unionByName(digests)


def _bounded(labels: DataFrame, rows: int) -> DataFrame:
    turn = F.xxhash64("doc_id", "start", "digest_near")
    kinds = [labels.where(F.col("is_secret") == k).orderBy(turn, "doc_id", "start").limit(rows) for k in (0.0, 1.0)]
    return kinds[0].unionByName(kinds[1]).select("is_secret", *FEATURES)


def scored(findings: DataFrame, labels: DataFrame, folder: str, rows: int = TRAINING_ROWS) -> DataFrame:
    """Findings with ``score``: the forest's share of trees for a secret. labels: FEATURES and is_secret."""
    training = written(_bounded(labels, rows), f"{folder}/training")
    counts = {r.is_secret: r.n for r in training.groupBy("is_secret").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return findings.withColumn("score", F.lit(1.0 if 1.0 in counts else 0.0))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="__vector")
    forest = RandomForestClassifier(featuresCol="__vector", labelCol="is_secret", probabilityCol="__shares", rawPredictionCol="__raw", predictionCol="__class", numTrees=40, maxDepth=8, seed=17)
    model = forest.fit(assembler.transform(training))
    found = model.transform(assembler.transform(findings))
    return found.withColumn("score", vector_to_array("__shares")[1]).drop("__vector", "__shares", "__raw", "__class")


def secrets(docs: DataFrame, labels: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate: doc_id, word_no, start, length, value_sha256, score, is_secret. The value itself
    isn't given out."""
    folder = work_folder(docs.sparkSession, "secrets")
    findings = written(with_features(candidates(docs), docs, folder), f"{folder}/findings")
    found = scored(findings, labels if labels is not None else labelled(findings), folder)
    return found.select(
        "doc_id", "word_no", "start", F.col("length").cast("bigint").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= threshold).alias("is_secret")
    )
