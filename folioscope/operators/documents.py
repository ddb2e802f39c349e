"""Identity, duplicates and the expected set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.periods import label_period
from folioscope.functions.urls import base_name, destination_filename, identity_key, slug
from folioscope.scale import first_rows, ordered_scan, with_group_totals

UNIT = ["amc", "period"]


def with_identity(docs: DataFrame) -> DataFrame:
    """destination and identity of every document."""
    return docs.withColumns({
        "destination": destination_filename(F.col("filename"), F.col("url"), F.col("file_type")),
        "identity": identity_key(F.col("scheme"), F.col("period"), F.col("url")),
    })


def dedupe_documents(docs: DataFrame, keys: tuple[str, ...] = ("url",)) -> DataFrame:
    """One document per address: a primary one, else the first."""
    return first_rows(docs, keys, [F.desc(F.coalesce("primary", F.lit(False))), "ord"])


def only_period(docs: DataFrame, period: str) -> DataFrame:
    return docs.filter(F.col("period") == period)


def period_status(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Strict form of only_period: every wanted (amc, period) with its document count and a status."""
    counted = docs.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("documents"))
    return wanted.join(counted, UNIT, "left").select(
        *UNIT, F.coalesce("documents", F.lit(0)).alias("documents"),
        F.when(F.col("documents").isNull(), "no_documents").otherwise("ok").alias("status"))


def detect_duplicates(docs: DataFrame) -> DataFrame:
    """The four duplicate kinds in long form: (amc, period, kind, key, member, members, copies).

    One row per member, so a key with very many members is never gathered in one place.
    """
    work = docs if "identity" in docs.columns else with_identity(docs)

    def kind_rows(name: str, key: str, member: str) -> DataFrame:
        pairs = work.groupBy(*UNIT, F.col(key).alias("key"), F.col(member).alias("member")).agg(
            F.count(F.lit(1)).alias("n"))
        many = pairs.groupBy(*UNIT, "key").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("copies"))
        return pairs.drop("n").join(many, [*UNIT, "key"]).withColumn("kind", F.lit(name))

    by_url = kind_rows("repeated_url", "url", "destination")
    conflict = by_url.filter("members > 1").withColumn("kind", F.lit("url_filename_conflict"))
    repeated = by_url.filter("members = 1 and copies > 1")
    listing = kind_rows("duplicate_listing", "identity", "url").filter("members > 1")
    collision = kind_rows("filename_collision", "destination", "identity").filter("members > 1")
    cols = [*UNIT, "kind", "key", "member", "members", "copies"]
    out = repeated.select(*cols)
    for part in (conflict, listing, collision):
        out = out.unionByName(part.select(*cols))
    return out


def build_expected(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, alternates): one winner per identity, the first unless a primary one exists.

    Every losing address is kept in ``alternates`` (with its place in address order), also the
    first one when a primary document replaces it.
    """
    work = docs if "identity" in docs.columns else with_identity(docs)
    order = [F.desc(F.coalesce("primary", F.lit(False))), "ord"]
    winners = first_rows(work, [*UNIT, "identity"], order)
    items = winners.select(
        *UNIT, F.col("identity").alias("key"), "url", F.col("destination").alias("filename"), "scheme", "label",
        "source_page_url", F.when(F.lower("file_type") == "zip", "archive").otherwise("file").alias("kind"))
    won = items.select(*UNIT, F.col("key").alias("identity"), F.col("url").alias("won_url"))
    others = work.select(*UNIT, "identity", "url").distinct().join(won, [*UNIT, "identity"]).filter("url <> won_url")
    return items, others.select(*UNIT, F.col("identity").alias("key"), F.col("url").alias("alternate_url"))


def dedupe_records(records: DataFrame, keys: tuple[str, ...] = ("url",)) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): first record per address; dropped lists other ids, not paging overlaps."""
    first = first_rows(records, keys, ["ord"])
    kept_ids = first.select(*keys, F.col("record_id").alias("kept_id"))
    dropped = records.join(kept_ids, list(keys)).filter("record_id <> kept_id")
    return first, dropped.select(*keys, "record_id", "kept_id").distinct()


def assign_filenames(records: DataFrame, house: str, ending: str = ".xlsx") -> DataFrame:
    """Deterministic names per record: plain; with the label when a scheme has several documents of
    a period; with the record id for every record but the first when names still clash."""
    counted = with_group_totals(records, [*UNIT, "scheme"], {"__docs": F.count(F.lit(1))})
    own = F.regexp_replace("scheme", rf"(?i)^\s*{house}\s+", "")
    base = F.concat_ws("_", F.lit(house), slug(own), F.col("period"))
    base = F.when(F.col("__docs") > 1, F.concat_ws("_", base, slug(F.col("label")))).otherwise(base)
    work = counted.withColumn("__base", base)
    owner = work.groupBy("amc", "__base").agg(F.min_by("record_id", F.struct("ord", "record_id")).alias("__owner"))
    name = F.when(F.col("record_id") == F.col("__owner"), F.col("__base")).otherwise(
        F.concat_ws("_", "__base", "record_id"))
    return work.join(owner, ["amc", "__base"]).withColumn("filename", F.concat(name, F.lit(ending))).drop(
        "__docs", "__base", "__owner")


def snapshot_changes(before: DataFrame, after: DataFrame, keys: tuple[str, ...] = ("record_id", "url")) -> DataFrame:
    """Keys that only one of two snapshots has; no rows means the listing is stable."""
    def marked(df: DataFrame, a: int, b: int) -> DataFrame:
        return df.select(*keys, F.lit(a).alias("b4"), F.lit(b).alias("af"))

    both = marked(before, 1, 0).unionByName(marked(after, 0, 1)).groupBy(*keys).agg(
        F.max("b4").alias("b4"), F.max("af").alias("af"))
    return both.filter("b4 <> af").select(*keys, F.when(F.col("b4") == 1, "removed").otherwise("added").alias("change"))


def snapshot_stable(before: DataFrame, after: DataFrame, keys: tuple[str, ...] = ("record_id", "url")) -> bool:
    return snapshot_changes(before, after, keys).isEmpty()


def prefer_resolved(records: DataFrame, gaps: DataFrame | None = None,
                    keys: tuple[str, ...] = ("amc", "period", "title_key", "category_key")) -> dict[str, DataFrame]:
    """Equivalent records: a resolved one beats an HTML one; losers are reported and the gaps of a
    group with a resolved winner disappear. Needs title, category, status, record_id, ord."""
    work = records.withColumns({
        "title_key": F.lower(F.trim(F.regexp_replace("title", r"\s+", " "))), "category_key": F.lower(F.trim("category"))})
    work = work.withColumn("resolved", F.col("status") == "resolved")
    winners = first_rows(work, keys, [F.desc("resolved"), "ord"])
    won = winners.select(*keys, F.col("record_id").alias("winner_id"), F.col("resolved").alias("winner_resolved"))
    joined = work.join(won, list(keys))
    losers = joined.filter("record_id <> winner_id").withColumn("reason", F.when(
        F.col("winner_resolved"), "equivalent catalog record; preferred a non-HTML sibling"
    ).otherwise("equivalent duplicate; kept first HTML-only record"))
    out = {"winners": winners, "rejected": losers.select(*keys, "record_id", "reason")}
    if gaps is not None:
        settled = joined.filter("winner_resolved").select("record_id").distinct()
        out["gaps"] = gaps.join(settled, "record_id", "left_anti")
    return out


def dedupe_by_filename(docs: DataFrame) -> DataFrame:
    """First document per destination name."""
    return first_rows(docs, [*UNIT, "filename"], ["ord"])


def disambiguate_filenames(docs: DataFrame, folder_pattern: str = r"/(\d{4}-\d{2})/") -> DataFrame:
    """Same base name, different addresses: tag with the upload folder, else with the position."""
    work = docs.withColumn("__base", base_name(F.col("url")))
    per_url = work.groupBy(*UNIT, "__base", "url").agg(F.min("ord").alias("__first"))
    many = per_url.groupBy(*UNIT, "__base").agg(F.count(F.lit(1)).alias("__urls")).filter("__urls > 1")
    # position of an address among the addresses of its name, via the addresses before it
    clash = per_url.join(many, [*UNIT, "__base"])
    placed = ordered_scan(clash, [*UNIT, "__base"], ["__first", "url"], F.shiftright("__first", 12), position="place")
    joined = work.join(placed.select(*UNIT, "__base", "url", "place"), [*UNIT, "__base", "url"], "left")
    folder = F.regexp_extract("url", folder_pattern, 1)
    tag = F.when(folder != "", folder).otherwise(F.col("place").cast("string"))
    stem, end = F.regexp_extract("__base", r"^(.*)\.([^.]*)$", 1), F.regexp_extract("__base", r"^(.*)\.([^.]*)$", 2)
    tagged = F.when(end != "", F.concat(stem, F.lit(" ("), tag, F.lit(")."), end)).otherwise(
        F.concat("__base", F.lit(" ("), tag, F.lit(")")))
    return joined.withColumn("filename", F.when(F.col("place").isNotNull(), tagged).otherwise(F.col("__base"))).drop(
        "__base", "place")


def first_listing(records: DataFrame, label: str = "label", period: Column | None = None) -> DataFrame:
    """Per house and period the first record whose label resolves to the period."""
    work = records.withColumn("period", label_period(F.col(label)) if period is None else period)
    return first_rows(work.filter("period is not null"), UNIT, ["ord"])
