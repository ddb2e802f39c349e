"""Expected files against the manifest and the disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.urls import suffix_of

UNIT = ["amc", "period"]


def looks_like_html(head: Column) -> Column:
    """The first bytes of a file, after blank space of any length, are an HTML page."""
    text = F.lower(F.substring(F.ltrim(F.decode(head, "ISO-8859-1"), F.lit(" \t\n\v\f\r")), 1, 16))
    return text.startswith("<!doctype html") | text.startswith("<html")


def sniff_content(df: DataFrame) -> DataFrame:
    """Adds category and retryable for a response: ok, empty_response, html_response, invalid_payload.

    Needs head (binary), length, file_type; optional status and content_type.
    """
    status = F.col("status") if "status" in df.columns else F.lit(None).cast("int")
    content_type = F.col("content_type") if "content_type" in df.columns else F.lit("")
    magic = F.hex(F.substring("head", 1, 4))
    kind = F.lower("file_type")
    zipped, ole = magic.startswith("504B"), magic == "D0CF11E0"
    xml = F.decode("head", "ISO-8859-1").rlike(r"^(?:\u00ef\u00bb\u00bf)*<\?xml")
    biff = magic.isin("09000400", "09020600", "09040600")
    ooxml = kind.isin("xlsx", "xlsm", "xlsb", "zip")
    bad = (ooxml & ~(zipped | ((kind == "xlsx") & ole))) | ((kind == "xls") & ~(zipped | ole | xml | biff))
    category = (
        F.when((F.coalesce(status, F.lit(200)) == 204) | (F.coalesce("length", F.lit(0)) == 0), "empty_response")
        .when(F.lower(F.coalesce(content_type, F.lit(""))).contains("html") | looks_like_html(F.col("head")), "html_response")
        .when(bad, "invalid_payload").otherwise("ok")
    )
    return df.withColumn("category", category).withColumn(
        "retryable", F.col("category").isin("html_response", "invalid_payload"))


def match_expected(items: DataFrame, alternates: DataFrame, entries: DataFrame) -> DataFrame:
    """Each expected item with the manifest entry of its address, else of an alternate one in order.

    items (amc, period, key, url), alternates (amc, period, key, alternate_url), entries
    (amc, period, url, ...). Adds matched_url (null when nothing matches) and entry (struct).
    """
    addresses = items.select(*UNIT, "key", F.lit(0).alias("rank"), "url").unionByName(
        alternates.select(*UNIT, "key", F.lit(1).alias("rank"), F.col("alternate_url").alias("url")))
    data = [c for c in entries.columns if c not in (*UNIT, "url")]
    found = addresses.join(entries, [*UNIT, "url"]).groupBy(*UNIT, "key").agg(
        F.min_by(F.struct("url", *data), F.struct("rank", "url")).alias("entry"))
    return items.join(found, [*UNIT, "key"], "left").withColumn("matched_url", F.col("entry.url"))


def missing_reason(matched: DataFrame, alternates: DataFrame, failures: DataFrame) -> DataFrame:
    """Reasons of unmatched items: their recorded failure, else that they never appear."""
    missing = matched.filter("matched_url is null").select(*UNIT, "key", "url")
    addresses = missing.select(*UNIT, "key", F.lit(0).alias("rank"), "url").unionByName(
        alternates.join(missing.select(*UNIT, "key"), [*UNIT, "key"], "left_semi").select(
            *UNIT, "key", F.lit(1).alias("rank"), F.col("alternate_url").alias("url")))
    found = addresses.join(failures, [*UNIT, "url"]).groupBy(*UNIT, "key").agg(
        F.min_by(F.struct("category", "status", "error"), F.struct("rank", "url")).alias("f"))
    text = F.concat_ws(
        "; ", F.when(F.col("f.category") != "", F.concat(F.lit("category="), F.col("f.category"))),
        F.when(F.col("f.status").isNotNull(), F.concat(F.lit("status="), F.col("f.status").cast("string"))),
        F.coalesce(F.when(F.col("f.error") != "", F.col("f.error")), F.lit("download failed")))
    return missing.join(found, [*UNIT, "key"], "left").select(
        *UNIT, "key", F.when(F.col("f").isNotNull(), text).otherwise("never appears in manifest.json").alias("reason"))


def check_files(entries: DataFrame, facts: DataFrame) -> DataFrame:
    """Single-file entries (amc, period, key, path, bytes, sha256) against file facts.

    facts: (amc, period, path, length, sha256, head). Adds status ok / missing / corrupt and reasons.
    """
    disk = facts.select(*UNIT, "path", F.col("length").alias("d_length"), F.col("sha256").alias("d_sha"), "head")
    joined = entries.join(disk, [*UNIT, "path"], "left")
    size = F.col("d_length")
    no_path = F.coalesce("path", F.lit("")) == ""
    guarded = suffix_of(F.col("path")).isin(fv.NON_HTML_SUFFIXES)
    reasons = F.array_compact(F.array(
        F.when(no_path, F.lit("manifest entry has no path")),
        F.when(~no_path & size.isNull(), F.lit("manifest records a download but the file is gone from disk")),
        F.when(size == 0, F.lit("zero-byte file")),
        F.when(F.col("bytes").isNotNull() & (size != F.col("bytes")), F.concat(
            F.lit("size on disk ("), size.cast("string"), F.lit(") does not match manifest ("),
            F.col("bytes").cast("string"), F.lit(")"))),
        F.when((size > 0) & (F.col("sha256") != F.col("d_sha")),
               F.lit("sha256 on disk does not match manifest -- file was modified or overwritten")),
        F.when((size > 0) & guarded & looks_like_html(F.col("head")),
               F.lit("file content looks like an HTML page, not the expected file type")),
    ))
    status = F.when(no_path, "corrupt").when(size.isNull(), "missing").when(F.size("reasons") > 0, "corrupt").otherwise("ok")
    return joined.withColumn("reasons", reasons).withColumn("status", status).drop("d_length", "head").withColumnRenamed(
        "d_sha", "disk_sha256")


def check_archives(members: DataFrame, facts: DataFrame) -> DataFrame:
    """Archives through their extracted members; (amc, period, key) with no member rows are corrupt.

    members: (amc, period, key, path, sha256), one row with a null path for an empty archive.
    The worst member decides; bad_members counts them and first_reason names the first.
    """
    disk = facts.select(*UNIT, "path", F.col("length").alias("d_length"), F.col("sha256").alias("d_sha"))
    joined = members.join(disk, [*UNIT, "path"], "left")
    reason = (
        F.when(F.col("path").isNull(), F.lit("archive extracted zero usable files"))
        .when(F.col("d_length").isNull(), F.concat(F.lit("extracted member missing from disk: "), F.col("path")))
        .when(F.col("d_length") == 0, F.concat(F.col("path"), F.lit(": zero-byte file")))
        .when(F.col("sha256") != F.col("d_sha"), F.concat(F.col("path"), F.lit(": sha256 on disk does not match manifest")))
    )
    return joined.withColumn("reason", reason).groupBy(*UNIT, "key").agg(
        F.count("path").alias("members"), F.count("reason").alias("bad_members"),
        F.min_by("reason", F.when(F.col("reason").isNotNull(), F.col("path"))).alias("member_reason"),
        F.max(F.when(F.col("path").isNull(), F.col("reason"))).alias("empty_reason"),
    ).select(*UNIT, "key", "members", "bad_members", F.coalesce("empty_reason", "member_reason").alias("first_reason"),
             F.when(F.col("bad_members") > 0, "corrupt").otherwise("ok").alias("status"))


def stale_entries(entries: DataFrame, items: DataFrame, alternates: DataFrame) -> DataFrame:
    """Manifest entries that belong to no expected address."""
    expected = items.select(*UNIT, "url").unionByName(alternates.select(*UNIT, F.col("alternate_url").alias("url")))
    return entries.join(expected.distinct(), [*UNIT, "url"], "left_anti")


def unexpected_files(facts: DataFrame, accounted: DataFrame) -> DataFrame:
    """Files on disk that no entry accounts for; dotfiles and reserved names never count."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    real = facts.filter(~name.startswith(".") & ~name.isin(fv.RESERVED_FILE_NAMES))
    return real.join(accounted.select(*UNIT, "path").distinct(), [*UNIT, "path"], "left_anti")


def duplicate_content(df: DataFrame, keys: tuple[str, ...] = ("amc", "period"), sha: str = "sha256",
                      identity: str = "key") -> DataFrame:
    """(keys, sha, identity, identities): content stored under more than one identity, long form."""
    pairs = df.select(*keys, sha, identity).distinct()
    many = pairs.groupBy(*keys, sha).agg(F.count(F.lit(1)).alias("identities")).filter("identities > 1")
    return pairs.join(many, [*keys, sha])


def upstream_gaps(unavailable: DataFrame, entries: DataFrame) -> DataFrame:
    """Addresses reported unavailable that were not downloaded later."""
    return unavailable.join(entries.select(*UNIT, "url").distinct(), [*UNIT, "url"], "left_anti")


def status_fold(truncated: Column, gaps: Column, missing: Column, corrupt: Column, ok: Column,
                site_changed: Column) -> Column:
    """Status of a (house, month) from its counts, in order of precedence."""
    return (
        F.when(truncated, "PARTIAL_BY_CONFIG").when(gaps > 0, "UPSTREAM_GAP")
        .when((missing == 0) & (corrupt == 0), "SUCCESS").when(site_changed & (corrupt == 0), "SITE_CHANGED")
        .when(missing == 0, "CORRUPT").when((ok == 0) & (corrupt == 0), "DOWNLOAD_FAILED").otherwise("INCOMPLETE")
    )


def report_status(outcomes: DataFrame, gaps: DataFrame | None = None, truncated: DataFrame | None = None,
                  unexpected: DataFrame | None = None, duplicates: DataFrame | None = None,
                  site_changed: DataFrame | None = None) -> DataFrame:
    """One row per (house, month) from item outcomes (amc, period, key, status).

    A month whose only rows are gaps appears as well. ``truncated`` and ``site_changed`` list
    (amc, period).
    """
    base = outcomes.groupBy(*UNIT).agg(
        F.count(F.lit(1)).alias("discovered"),
        *[F.count_if(F.col("status") == s).alias(n) for s, n in (
            ("ok", "downloaded"), ("missing", "missing"), ("corrupt", "corrupt"))])

    def attach(df: DataFrame, extra: DataFrame | None, name: str, expr: Column, how: str = "left") -> DataFrame:
        if extra is None:
            return df.withColumn(name, F.lit(0).cast("bigint"))
        return df.join(extra.groupBy(*UNIT).agg(expr.alias(name)), UNIT, how)

    out = attach(base, gaps, "gaps", F.count(F.lit(1)), "full")
    out = attach(out, unexpected, "unexpected", F.count(F.lit(1)))
    out = attach(out, duplicates, "duplicates", F.count_distinct("sha256"))
    out = attach(out, truncated, "truncated", F.count(F.lit(1)))
    out = attach(out, site_changed, "site_changed", F.count(F.lit(1)))
    counts = ["discovered", "downloaded", "missing", "corrupt", "gaps", "unexpected", "duplicates", "truncated", "site_changed"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    status = status_fold(F.col("truncated") > 0, F.col("gaps"), F.col("missing"), F.col("corrupt"), F.col("downloaded"),
                         F.col("site_changed") > 0)
    return out.withColumn("status", status).drop("truncated", "site_changed")


def mark_site_changed(outcomes: DataFrame, fresh: DataFrame) -> DataFrame:
    """(amc, period) whose missing keys are all gone from a fresh listing and where nothing is corrupt."""
    listed = fresh.select(*UNIT, "key").distinct().withColumn("listed", F.lit(True))
    seen = outcomes.join(listed, [*UNIT, "key"], "left")
    missing = F.col("status") == "missing"
    return seen.groupBy(*UNIT).agg(
        F.count_if(missing).alias("m"), F.count_if(missing & F.col("listed").isNotNull()).alias("still"),
        F.count_if(F.col("status") == "corrupt").alias("c"),
    ).filter("m > 0 and still = 0 and c = 0").select(*UNIT)


def scheme_report(offered: DataFrame, found: DataFrame) -> DataFrame:
    """found / not_published per offered scheme; found schemes that are not offered stay."""
    have = found.groupBy(*UNIT, "scheme").agg(F.count(F.lit(1)).alias("documents"))
    both = offered.select(*UNIT, "scheme").distinct().withColumn("offered", F.lit(True)).join(
        have, [*UNIT, "scheme"], "full")
    return both.select(
        *UNIT, "scheme", F.coalesce("offered", F.lit(False)).alias("offered"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.when(F.col("documents").isNotNull(), "found").otherwise("not_published").alias("status"))


def report_digest(report: DataFrame) -> DataFrame:
    """Totals per (house, month); the unpublished names stay rows of the report itself."""
    return report.groupBy(*UNIT).agg(
        F.count(F.lit(1)).alias("total_schemes_offered"),
        F.count_if(F.col("status") == "found").alias("found"),
        F.count_if(F.col("status") == "not_published").alias("not_published"))


def absence_reason(years: Column, months: Column, period: Column) -> Column:
    """year_not_offered, month_not_offered or none_listed, from the site's own option lists."""
    month = F.date_format(F.concat(period, F.lit("-01")).try_cast("date"), "MMMM")
    no_year = (F.size(years) > 0) & ~F.array_contains(years, F.substring(period, 1, 4))
    no_month = (F.size(months) > 0) & ~F.array_contains(months, month)
    return F.when(F.coalesce(no_year, F.lit(False)), "year_not_offered").when(
        F.coalesce(no_month, F.lit(False)), "month_not_offered").otherwise("none_listed")


def layered_checks(layers: dict[str, DataFrame]) -> DataFrame:
    """Union of layers, each (amc, period, checked, failed), with passed and a short summary."""
    out = None
    for number, (name, df) in enumerate(layers.items(), 1):
        row = df.select(
            *UNIT, F.lit(number).alias("layer_no"), F.lit(name).alias("layer"), "checked", "failed",
            (F.col("failed") == 0).alias("passed"),
            F.concat((F.col("checked") - F.col("failed")).cast("string"), F.lit("/"), F.col("checked").cast("string"),
                     F.lit(" ok")).alias("summary"))
        out = row if out is None else out.unionByName(row)
    return out


def validation_totals(reports: DataFrame) -> DataFrame:
    """Sums per house and over all houses (null house)."""
    names = ["discovered", "downloaded", "missing", "corrupt", "duplicates", "unexpected"]
    return reports.rollup("amc").agg(*[F.sum(n).alias(n) for n in names], F.count(F.lit(1)).alias("months"))


def reconcile_rounds(snapshot: DataFrame, outcomes: DataFrame, keys: tuple[str, ...] = ("amc",)) -> DataFrame:
    """COMPLETE when every listed record is validated and nothing failed, else INCOMPLETE, with counts."""
    valid = outcomes.filter(F.col("status").isin("downloaded", "identical")).select(*keys, "record_id").distinct()
    listed = snapshot.select(*keys, "record_id").distinct()
    missing = listed.join(valid, [*keys, "record_id"], "left_anti").groupBy(*keys).agg(F.count(F.lit(1)).alias("missing"))
    done = outcomes.groupBy(*keys).agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("downloaded", "identical", "failed")])
    total = listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("listed"))
    out = total.join(done, list(keys), "left").join(missing, list(keys), "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("downloaded", "identical", "failed", "missing")})
    return out.withColumn("status", F.when((F.col("missing") == 0) & (F.col("failed") == 0), "COMPLETE").otherwise("INCOMPLETE"))


def combine_legs(legs: DataFrame) -> DataFrame:
    """Verdict over the legs of a (house, month): the first hard failure, unavailable if all are, else ok.

    legs: (amc, period, leg, exit_code).
    """
    hard = ~F.col("exit_code").isin(0, 2)
    return legs.groupBy(*UNIT).agg(
        F.min_by(F.when(hard, F.col("exit_code")), F.when(hard, F.col("leg"))).alias("hard"),
        F.bool_and(F.col("exit_code") == 2).alias("none"),
    ).select(*UNIT, F.coalesce("hard", F.when(F.col("none"), 2).otherwise(0)).alias("exit_code"))


def unavailable_or_broken(wanted: DataFrame, published: DataFrame, documents: DataFrame) -> DataFrame:
    """Per wanted (amc, period): ok, unavailable (other periods are listed) or broken (none is).

    published: (amc, published), see listing.published_periods.
    """
    have = documents.select(*UNIT).distinct().withColumn("have", F.lit(True))
    named = published.groupBy("amc").agg(F.count(F.lit(1)).alias("periods"), F.min("published").alias("first_listed"),
                                         F.max("published").alias("last_listed"))
    hit = published.select("amc", F.col("published").alias("period")).distinct().withColumn("named", F.lit(True))
    joined = wanted.join(have, UNIT, "left").join(named, "amc", "left").join(hit, UNIT, "left")
    verdict = F.when(F.col("have"), "ok").when((F.col("periods") > 0) & F.col("named").isNull(), "unavailable").otherwise("broken")
    return joined.select(*UNIT, verdict.alias("verdict"), "periods", "first_listed", "last_listed")
