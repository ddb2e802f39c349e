"""Secret scan: candidate strings, and a random forest that removes the false positives.

A candidate is

* a value given to a word that names a secret (``password=``, ``"token": ``, ``apiKey := ``), of any length and any signs, up to
  its closing quote, a blank, or the next ``&name=`` of a query string;
* any other run of at least ``min_length`` characters of ``A-Za-z0-9+/_-`` with a digit, and up to two ``=``, inside a word.

It is described by its length, the transitions between its character classes and how many of its letter pairs are usual in the
corpus' dictionary, by how much of it the dictionary covers, by the path around it and by its neighbouring words. A random
forest trained on labelled findings scores it.

Everything runs as DataFrame functions. Only candidates leave the map side, a few rows for the documents that
have any; the dictionary counts each word once per document and sums before the shuffle. A document with very many
candidates is just many rows; a text of any length is read whole, by one task, as an array of its words.

Defined results: a null or empty text has no candidates. Repeated rows repeat their candidates. If the labelled
findings lack one of the two classes, nothing can be learned: score and is_secret are null. A score equal to the threshold
is a secret. Findings without a label teach nothing. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.stages import stage

MIN_LENGTH = 16
WORD_BREAK = "[ \\t-\\r]+"
DICTIONARY_SHARE = 0.001  # of documents
TREES = 24
DEPTH = 6
MAX_FINDINGS = 20_000  # labelled findings of each class, those of lowest hash
THRESHOLD = 0.5
SEED = 11

# Words that name a secret, words that name a checksum or an id, and endings of file names.
SECRET_WORDS = ["token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "access_key", "secret_key",
                "private_key", "auth", "bearer", "credential", "credentials"]
DIGEST_WORDS = ["commit", "revision", "build", "checksum", "digest", "hash", "md5", "sha", "sha1", "sha256", "sha512", "etag", "uuid", "guid", "id"]
FILE_ENDINGS = "(?i)\\.(html?|php|js|css|png|jpe?g|gif|pdf|py|java|txt|xml|json|zip|gz)\\b"

FEATURES = ["length", "digit_share", "upper_share", "hex_only", "digits_only", "class_changes", "distinct_share", "usual_pairs",
            "dictionary_cover", "in_path", "file_ending", "named", "assigned", "quoted", "digest_named"]
CONTEXT = ["named", "assigned", "quoted"]  # hidden in half of what the scan labels itself by them

# A secret's name, whole, after _ or -, or as the last part of a camel-case name, and a sign that assigns.
_NAMES = "|".join(sorted(SECRET_WORDS, key=len, reverse=True)).replace("_", "[_-]?")
_CAMEL = "|".join(w.capitalize() for w in SECRET_WORDS if "_" not in w)
_ASSIGNING = f"(?:(?<![A-Za-z])(?i:{_NAMES})|(?<=[a-z0-9])(?:{_CAMEL}))[\"'`\\])]{{0,2}} ?(?::=|=>|={{1,2}}|:) ?"
_VALUE = "(\"[^ \"]+|'[^ ']+|`[^ `]+|(?:(?![&,;][A-Za-z_-]+[=:])[^ \"'`])+)"
ASSIGNED = f"{_ASSIGNING}{_VALUE}(?=[^ ]*$)"  # over words joined by one blank: the value stands in the last of them
MAY_ASSIGN = f"(?i)(?:{_NAMES})[\"'`\\])]{{0,2}}[ \\t-\\r]*[:=]"


def _value_pattern(min_length: int) -> str:
    return f"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{{{min_length},}}={{0,2}}"


def assigned_values(context: Column) -> Column:
    """Values that the last word of ``context`` gives to a secret's name, without quotes and closing punctuation."""
    plain = F.transform(F.regexp_extract_all(context, F.lit(ASSIGNED), F.lit(1)),
                        lambda v: F.when(F.rlike(v, F.lit("^[\"'`]")), F.substring(v, 2, 1 << 30)).otherwise(F.regexp_replace(v, "[,;.)\\]}]+$", "")))
    return F.array_distinct(F.filter(plain, lambda v: F.rlike(v, F.lit("[^=:>]"))))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, position, part, value, given, word, before, before2, after): ``position`` counts words from 0.

    ``part`` counts the values of a word: first those ``given`` to a secret's name, then runs that stand in none of them.
    """
    pattern = _value_pattern(min_length)
    text = F.col(text_col)
    rows = docs.filter(F.rlike(text, F.lit(pattern)) | F.rlike(text, F.lit(MAY_ASSIGN))).select(
        F.col(id_col).alias("doc_id"), F.split(text, WORD_BREAK).alias("words"))

    def near(position: Column, step: int) -> Column:
        return F.coalesce(F.get("words", position + step), F.lit(""))

    def signed(i: Column) -> Column:  # an assigning sign in the word or at the end of the one before
        return F.rlike(near(i, 0), F.lit("[=:]")) | F.rlike(near(i, -1), F.lit("[=:>]$"))

    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: signed(i) | F.rlike(near(i, 0), F.lit(pattern)))
    at = F.col("position")
    rows = rows.withColumn("position", F.explode(places)).select(
        "doc_id", "position", near(at, 0).alias("word"), near(at, -1).alias("before"), near(at, -2).alias("before2"), near(at, 1).alias("after"))
    given = assigned_values(F.concat_ws(" ", "before2", "before", "word"))
    rows = rows.withColumns({"__given": given, "__runs": F.regexp_extract_all("word", F.lit(pattern), F.lit(0))})
    others = F.filter("__runs", lambda run: ~F.exists("__given", lambda v: F.contains(v, run)))
    values = F.concat(F.transform("__given", lambda v: F.struct(v.alias("value"), F.lit(True).alias("given"))),
                      F.transform(others, lambda v: F.struct(v.alias("value"), F.lit(False).alias("given"))))
    return rows.select("doc_id", "position", "word", "before", "before2", "after", F.posexplode(values).alias("part", "found")).select(
        "doc_id", "position", "part", "found.value", "found.given", "word", "before", "before2", "after")


def dictionary(docs: DataFrame, text_col: str = "text", share: float = DICTIONARY_SHARE) -> DataFrame:
    """Words of 3 to 24 letters that stand in at least that share of all documents: at most words per document / share."""
    total = docs.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    words = F.array_distinct(F.filter(F.split(F.lower(text_col), "[^\\p{L}]+"), lambda w: F.length(w).between(3, 24)))
    counted = docs.select(F.explode(words).alias("entry")).groupBy("entry").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= F.greatest(F.lit(total * share), F.lit(2.0))).select("entry")


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns of FEATURES."""
    rows = stage(found.withColumn("row", F.monotonically_increasing_id()), "candidates")
    letters = F.explode(F.regexp_extract_all(F.lower("value"), F.lit("\\p{L}{2,}"), F.lit(0))).alias("run")
    runs = rows.select("row", letters)
    # how much of the value stands in the dictionary, run of letters by run of letters
    cover = runs.join(words, F.col("run") == F.col("entry")).groupBy("row").agg(F.sum(F.length("run")).alias("covered"))
    # letter pairs that the dictionary's words have; an alphabet's square at most
    pairs_of = lambda c: F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))
    usual = stage(words.select(F.explode(pairs_of(F.col("entry"))).alias("pair")).distinct(), "letter-pairs")
    seen = runs.select("row", F.explode(pairs_of(F.col("run"))).alias("pair"))
    usual_rows = seen.join(usual, "pair").groupBy("row").agg(F.count(F.lit(1)).alias("pairs_seen"))
    every = seen.groupBy("row").agg(F.count(F.lit(1)).alias("pairs_all"))
    # the word up to its value, and the two words before it
    ahead = F.concat_ws(" ", "before2", "before", F.expr("substring_index(word, value, 1)"))
    parts = F.split(F.lower(ahead), "[^a-z0-9_]+")

    def among(words: list[str]) -> Column:
        return F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words]))

    joined = rows.join(cover, "row", "left").join(usual_rows, "row", "left").join(every, "row", "left")
    number = lambda c: c.cast("double")
    return joined.withColumns({
        "length": number(F.length("value")), "digit_share": _share("[0-9]"), "upper_share": _share("[A-Z]"),
        "hex_only": number(F.rlike("value", F.lit("^([0-9a-f]+|[0-9A-F]+)$"))), "digits_only": number(F.rlike("value", F.lit("^[0-9_+/-]+$"))),
        "class_changes": _share("(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[0-9]|(?<=[0-9])[A-Za-z]"),
        "distinct_share": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"),
        "usual_pairs": F.coalesce(F.col("pairs_seen"), F.lit(0)) / F.greatest(F.coalesce("pairs_all", F.lit(0)), F.lit(1)),
        "dictionary_cover": F.coalesce("covered", F.lit(0)) / F.length("value"),
        "in_path": number(F.rlike("word", F.lit("://|^\\.{0,2}/|\\\\|(/[^/]+){2,}"))), "file_ending": number(F.rlike("word", F.lit(FILE_ENDINGS))),
        "named": number(F.col("given") | among(SECRET_WORDS)), "assigned": number(F.col("given") | F.rlike(ahead, F.lit("[=:]"))),
        "quoted": number(F.rlike("word", F.lit("[\"'`]"))), "digest_named": number(among(DIGEST_WORDS)),
    }).drop("row", "covered", "pairs_seen", "pairs_all")


def labelled(rows: DataFrame) -> DataFrame:
    """Findings whose label is beyond doubt: named, assigned and quoted values; words of the
    dictionary, and numbers, paths and checksums without a name.

    The names, signs and quotes that decide a label would decide the forest too. Each secret is therefore given twice, once
    as it stands and once without them, so that the forest has to know a secret by its own characters as well.
    """
    sure = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 1) & (F.col("digits_only") == 0) & (F.col("dictionary_cover") < 0.5)
    usual = F.col("dictionary_cover") >= 0.5
    never = usual | ((F.col("named") == 0) & ((F.col("digits_only") == 1) | (F.col("in_path") == 1) | (F.col("digest_named") == 1)))
    known = rows.withColumn("label", F.when(sure, 1.0).when(never, 0.0)).filter("label IS NOT NULL")
    return known.unionByName(known.filter("label = 1").withColumns({c: F.lit(0.0) for c in CONTEXT}))


def fit(findings: DataFrame, *, trees: int = TREES, depth: int = DEPTH, max_findings: int = MAX_FINDINGS):
    """A forest over labelled findings (FEATURES and label), or None if a class is missing."""
    order = [F.xxhash64("doc_id", "position", "part"), F.col("value"), *[F.col(c) for c in FEATURES]]
    sides = [findings.select("doc_id", "position", "part", "value", "label", *FEATURES).filter(F.col("label") == side).orderBy(*order).limit(max_findings) for side in (0.0, 1.0)]
    sample = stage(sides[0].unionByName(sides[1]).select("label", *FEATURES), "labelled-findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample))


def scored(rows: DataFrame, forest, threshold: float = THRESHOLD) -> DataFrame:
    if forest is None:
        out = rows.withColumn("score", F.lit(None).cast("double"))
    else:
        out = forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)).withColumn(
            "score", vector_to_array("probability")[1])
    return out.select("doc_id", "position", "part", "value", "score", (F.col("score") >= threshold).alias("is_secret"))


def scan(docs: DataFrame, findings: DataFrame | None = None, *, min_length: int = MIN_LENGTH, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, position, part, value, score, is_secret) of every candidate of ``docs``.

    ``findings``: (doc_id, position, part, label 0/1) of candidates that were looked at by hand. Without them the
    forest learns from the candidates whose label is beyond doubt.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = stage(described(candidates(docs, min_length=min_length), stage(dictionary(docs), "dictionary")), "described-candidates")
    known = labelled(rows) if findings is None else rows.join(
        findings.select("doc_id", "position", "part", F.col("label").cast("double").alias("label")), ["doc_id", "position", "part"])
    return scored(rows, fit(known, **options), threshold)
