"""Spelling variants: words one edit apart, found among sorted rotations of terminator-marked words.

A word A x B has the rotation B$Ax: what stands before its last character is the word without x, at x's place. Two
words that differ in one replaced character share that prefix; the word AB, one character shorter, has it as a whole
rotation. Rotations are sorted by the prefix, and each range of equal prefixes is scanned once: its members differ in
the skipped character only, so a range holds at most one whole rotation and one member for each character of the
alphabet. A range hands every member its number of neighbours and its best one; pairs are never listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.stages import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[a-zÀ-ÿ]+"  # after A-Z became a-z
TERMINATOR = "$"  # not in the alphabet
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10
ERROR_EVERY = 31


def word_counts(docs: DataFrame, error_every: int | None = ERROR_EVERY, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the runs of letters of whole texts, A-Z in lower case, at least ``min_length`` long and ``min_count`` often.

    With ``error_every`` a run loses one character where that number divides the CRC of ``<doc_id>:<run>``; a null
    doc_id counts as empty there. A null or empty text has no words. Counts are summed in the map task first.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= min_length)
    if error_every is not None:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = F.pmod(F.col("h"), F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % error_every == 0, cut).otherwise(F.col("run")).alias("run"))
    return (runs.filter(F.length("run") >= min_length).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, skipped, first, n) of every word: rotations without their last character, and whole ones.

    ``skipped`` is the last character, null in a whole rotation; ``first`` tells that the character before it in the
    word is another one, so that deleting one of several equal characters counts once.
    """
    w, size = F.col("word"), F.length("word")

    def part(i: Column, skip: int) -> Column:
        return F.concat(F.substring(w, i + 1 + skip, size), F.lit(TERMINATOR), F.substring(w, F.lit(1), i))

    def skipping(i: Column) -> Column:
        x = F.substring(w, i + 1, F.lit(1))
        return F.struct(part(i, 1).alias("prefix"), x.alias("skipped"), ((i == 0) | (F.substring(w, i, F.lit(1)) != x)).alias("first"))

    def whole(i: Column) -> Column:
        return F.struct(part(i, 0).alias("prefix"), F.lit(None).cast("string").alias("skipped"), F.lit(False).alias("first"))

    places = F.sequence(F.lit(0), size)
    each = F.concat(F.transform(F.slice(places, F.lit(1), size), skipping), F.transform(places, whole))
    return words.select("n", F.explode(each).alias("r")).select("r.prefix", "r.skipped", "r.first", "n")


def _word(prefix: Column, skipped: Column) -> Column:
    """The word a rotation came from."""
    cut = F.instr(prefix, TERMINATOR)
    return F.concat(F.substring(prefix, cut + 1, F.length(prefix)), F.coalesce(skipped, F.lit("")), F.substring(prefix, F.lit(1), cut - 1))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, n_near, near, near_n): number of words one edit apart and the most frequent of them, for words that have any.

    Ties go to the smallest word in code-point order. ``words`` has each word once.
    """
    ranges = rotations(words).groupBy("prefix").agg(F.collect_list(F.struct("n", "skipped", "first")).alias("members"))
    ranges = ranges.filter(F.size("members") > 1)
    spelled = F.transform("members", lambda m: F.struct(
        (-m["n"]).alias("minus_n"), _word(F.col("prefix"), m["skipped"]).alias("word"), m["skipped"].isNull().alias("whole"), m["first"].alias("first")))
    scanned = ranges.select(F.array_sort(spelled).alias("members")).select(
        "members",
        F.size(F.filter("members", lambda m: ~m["whole"])).alias("skipping"),
        F.size(F.filter("members", lambda m: m["first"])).alias("firsts"),
        F.exists("members", lambda m: m["whole"]).cast("int").alias("wholes"))
    found = scanned.select(F.explode("members").alias("m"), "skipping", "firsts", "wholes",
                           F.col("members")[0].alias("best"), F.col("members")[1].alias("second"))
    near = F.when(F.col("m.whole"), F.col("firsts")).otherwise(
        F.col("skipping") - 1 + F.when(F.col("m.first"), F.col("wholes")).otherwise(0))
    best = F.when(F.col("best.word") == F.col("m.word"), F.col("second")).otherwise(F.col("best"))
    found = found.select(F.col("m.word").alias("word"), near.cast("long").alias("near"),
                         F.struct(best["minus_n"].alias("minus_n"), best["word"].alias("word")).alias("best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")).select(
        "word", "n_near", F.col("best.word").alias("near"), (-F.col("best.minus_n")).alias("near_n"))


def variants(words: DataFrame, form_ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every one of ``words`` (word, n).

    The form is the most frequent near word if it stands at least ``form_ratio`` times as often, else null; the root
    is reached from form to form, the word itself where there is none. Words of any length take part; without words
    there are no rows.
    """
    words = stage(words.select("word", "n"), "spelling-words")
    near = neighbours(words)
    keyed = words.join(near, "word", "left")
    formed = F.col("near_n") >= form_ratio * F.col("n").cast("decimal(20,0)")
    out = stage(keyed.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("near")).alias("form"),
        F.when(formed, F.col("near_n")).alias("form_n")), "spelling-forms")
    roots = _roots(out.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) by pointer jumping: each round doubles the steps; counts rise tenfold a step, so rounds are few.

    A root is pointed at by its near words and theirs; no join key is larger than that family.
    """
    links = stage(links, "spelling-links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stage(links.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-links")
        if not links.filter("moved").limit(1).count():
            return links.select("word", "root")
        links = links.select("word", "root")
