"""Landing zone: one json object for each fetched record; nine feeds with their schemas and canonical projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import strip_tags
from tablewright.functions.values import location_text, parse_timestamp, remote_type

ENVELOPE = "source_name string, scope string, run_id string, page_no int, fetched_at timestamp, body string"

#: Where each feed keeps its fields (S02 to S10). A list means the first that is not blank.
FEEDS: dict[str, dict[str, list[str]]] = {
    "smartrecruiters_direct": {"id": ["$.id"], "title": ["$.name"], "company": ["$.company.name"], "description": ["$.jobAd.sections.jobDescription.text"], "city": ["$.location.city"], "country": ["$.location.country"], "mode": ["$.location.remote"], "employment": ["$.typeOfEmployment.label"], "url": ["$.postingUrl", "$.ref"], "published": ["$.releasedDate"]},
    "greenhouse_direct": {"id": ["$.id"], "title": ["$.title"], "company": ["$.company_name"], "description": ["$.content"], "city": ["$.location.name"], "country": ["$.offices[0].location"], "mode": ["$.location.name"], "employment": ["$.metadata[0].value"], "url": ["$.absolute_url"], "published": ["$.first_published", "$.updated_at"]},
    "workable_direct": {"id": ["$.shortcode", "$.id"], "title": ["$.title"], "company": ["$.company"], "description": ["$.description"], "city": ["$.city", "$.location.city"], "country": ["$.country", "$.location.country"], "mode": ["$.workplace_type", "$.workplace"], "employment": ["$.employment_type"], "url": ["$.url", "$.shortlink"], "published": ["$.published_on", "$.created_at"]},
    "ashby_direct": {"id": ["$.id"], "title": ["$.title"], "company": ["$.organization"], "description": ["$.descriptionPlain", "$.descriptionHtml"], "city": ["$.address.postalAddress.addressLocality", "$.location"], "country": ["$.address.postalAddress.addressCountry"], "mode": ["$.workplaceType", "$.isRemote"], "employment": ["$.employmentType"], "url": ["$.jobUrl"], "published": ["$.publishedAt"]},
    "lever_direct": {"id": ["$.id"], "title": ["$.text"], "company": ["$.company"], "description": ["$.descriptionPlain", "$.description"], "city": ["$.categories.location"], "country": ["$.country"], "mode": ["$.workplaceType"], "employment": ["$.categories.commitment"], "url": ["$.hostedUrl", "$.applyUrl"], "published": ["$.createdAt"]},
    "workday_direct": {"id": ["$.jobPostingInfo.jobReqId", "$.bulletFields[0]"], "title": ["$.jobPostingInfo.title", "$.title"], "company": ["$.hiringOrganization.name"], "description": ["$.jobPostingInfo.jobDescription"], "city": ["$.jobPostingInfo.location", "$.locationsText"], "country": ["$.jobPostingInfo.country.descriptor"], "mode": ["$.jobPostingInfo.remoteType"], "employment": ["$.jobPostingInfo.timeType"], "url": ["$.jobPostingInfo.externalUrl"], "published": ["$.jobPostingInfo.startDate"]},
    "successfactors_direct": {"id": ["$.id"], "title": ["$.title"], "company": ["$.brand"], "description": ["$.description"], "city": ["$.city"], "country": ["$.country"], "mode": ["$.workplace"], "employment": ["$.employmentType"], "url": ["$.url"], "published": ["$.datePosted"]},
    "fantastic_jobs_apify": {"id": ["$.id"], "title": ["$.title"], "company": ["$.organization"], "description": ["$.description_text"], "city": ["$.cities_derived[0]"], "country": ["$.countries_derived[0]"], "mode": ["$.location_type", "$.ai_work_arrangement"], "employment": ["$.employment_type[0]"], "url": ["$.url"], "published": ["$.date_posted"]},
    "jooble_direct": {"id": ["$.id"], "title": ["$.title"], "company": ["$.company"], "description": ["$.snippet"], "city": ["$.location"], "country": ["$.country"], "mode": ["$.type"], "employment": ["$.type"], "url": ["$.link"], "published": ["$.updated"]},
}


def read_landing(spark: SparkSession, path: str, schema: str = ENVELOPE) -> DataFrame:
    """Records of the landing zone; lines that are no record keep their text in _corrupt."""
    shape = T.StructType.fromDDL(schema).add("_corrupt", T.StringType())
    return spark.read.schema(shape).option("columnNameOfCorruptRecord", "_corrupt").option("mode", "PERMISSIVE").json(path)


def first_of(body: Column, paths: list[str]) -> Column:
    return F.coalesce(*[F.nullif(F.trim(F.get_json_object(body, p)), F.lit("")) for p in paths])


def stated_mode(body: Column, feed: str) -> Column:
    """The first path of a feed that states a mode its rules know."""
    stated = [F.nullif(remote_type(F.get_json_object(body, p), feed), F.lit("unknown")) for p in FEEDS[feed]["mode"]]
    return F.coalesce(*stated, F.lit("unknown"))


def project_canonical(rows: DataFrame, feed: str, body: str = "body") -> DataFrame:
    """A feed's payload as canonical columns; the payload itself stays as text."""
    at = {k: first_of(F.col(body), p) for k, p in FEEDS[feed].items()}
    more = MORE.get(feed, {})
    own = lambda k: first_of(F.col(body), [more[k]]) if k in more else F.lit(None).cast("string")
    skills = F.coalesce(F.from_json(own("skills"), "array<string>"), F.array().cast("array<string>"))
    return rows.select(
        F.lit(feed).alias("source_name"), "scope", at["id"].alias("native_id"), at["company"].alias("company"), F.coalesce(at["title"], F.lit("Unknown position")).alias("title"),
        strip_tags(at["description"]).alias("description"), location_text(F.array(at["city"], at["country"])).alias("location_text"), at["country"].alias("country"), stated_mode(F.col(body), feed).alias("remote_type"),
        at["employment"].alias("employment_type"), own("salary").alias("salary_text"), skills.alias("skills"), at["url"].alias("url"), parse_timestamp(at["published"]).alias("published_at"),
        parse_timestamp(own("expires")).alias("expires_at"), F.col(body).alias("raw_payload"),
    )


def route_invalid(rows: DataFrame, rules: list[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the first reason)."""
    reason = F.lit(None).cast("string")
    for cond, name in reversed(rules):
        reason = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(reason)
    marked = rows.withColumn("reject_reason", reason)
    return marked.where("reject_reason IS NULL").drop("reject_reason"), marked.where("reject_reason IS NOT NULL")


def only_listed(rows: DataFrame, flag: Column) -> DataFrame:
    """Rows whose visibility flag is not false."""
    return rows.where(F.coalesce(flag, F.lit(True)))


#: Where a feed's listing pages keep their records, and the total that they state.
LISTINGS: dict[str, tuple[str, str | None]] = {
    "smartrecruiters_direct": ("$.content", "$.totalFound"), "greenhouse_direct": ("$.jobs", "$.meta.total"), "workable_direct": ("$.jobs", None), "ashby_direct": ("$.jobs", None),
    "lever_direct": ("$", None), "workday_direct": ("$.jobPostings", "$.total"), "fantastic_jobs_apify": ("$", None), "jooble_direct": ("$.jobs", "$.totalCount"),
}
#: Fields that some feeds have beyond those of FEEDS.
MORE: dict[str, dict[str, str]] = {
    "smartrecruiters_direct": {"salary": "$.compensation"}, "lever_direct": {"salary": "$.salaryRange"}, "ashby_direct": {"salary": "$.compensation.compensationTierSummary", "listed": "$.isListed"},
    "greenhouse_direct": {"salary": "$.pay_input_ranges"}, "fantastic_jobs_apify": {"salary": "$.salary", "skills": "$.ai_key_skills", "expires": "$.date_validthrough"}, "jooble_direct": {"salary": "$.salary"},
}


def listed_records(pages: DataFrame, feed: str, body: str = "body") -> DataFrame:
    """One row for each record of a listing page: the page's other columns, position, the page's stated total, and the record as `body`."""
    path, total = LISTINGS[feed]
    listed = F.from_json(F.get_json_object(body, path), "array<variant>")
    stated = F.get_json_object(body, total).try_cast("long") if total else F.lit(None).cast("long")
    rest = [c for c in pages.columns if c != body]
    each = pages.select(*rest, stated.alias("stated_total"), F.posexplode(listed).alias("position", "_record"))
    return each.withColumn(body, F.to_json("_record")).drop("_record")


def feed_schema(feed: str) -> T.StructType:
    """The explicit schema of a feed's records: the fields that its projection reads, as text; the flags as booleans."""
    tree: dict = {}
    for path in [p for paths in FEEDS[feed].values() for p in paths] + list(MORE.get(feed, {}).values()):
        at = tree
        for part in path.removeprefix("$.").split("."):
            at = at.setdefault(part, {})

    def build(node: dict) -> T.StructType:
        fields: dict[str, T.DataType] = {}
        for key, below in node.items():
            kind: T.DataType = build(below) if below else T.BooleanType() if key in ("remote", "isRemote", "isListed") else T.StringType()
            fields[key.removesuffix("[0]")] = T.ArrayType(kind) if key.endswith("[0]") else kind
        return T.StructType([T.StructField(k, v) for k, v in fields.items()])

    return build(tree)


def check_records(rows: DataFrame, feed: str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(rows whose record has the feed's schema, the others)."""
    schema = feed_schema(feed).add("_corrupt", T.StringType())
    parsed = F.from_json(F.col(body), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    marked = rows.withColumn("_bad", F.coalesce(parsed["_corrupt"].isNotNull() | parsed.isNull(), F.lit(True)))
    return marked.where("NOT _bad").drop("_bad"), marked.where("_bad").drop("_bad")


def project_with_details(listed: DataFrame, details: DataFrame, feed: str) -> DataFrame:
    """The canonical rows of a listing, each field from the record's detail page where that states it. A record without a detail keeps
    what the listing says; details of records that are not listed are left out."""
    front, back = project_canonical(listed, feed), project_canonical(details, feed)
    key = ["source_name", "scope", "native_id"]
    values = [c for c in front.columns if c not in key]
    missing = {"title": "Unknown position", "remote_type": "unknown", "description": ""}
    said = lambda c: F.nullif(F.col(f"_{c}"), F.lit(missing[c])) if c in missing else F.col(f"_{c}")
    newest = back.select(*key, *[F.col(c).alias(f"_{c}") for c in values]).dropDuplicates(key)
    return front.join(newest, key, "left").select(*key, *[F.coalesce(said(c), c).alias(c) for c in values])


def posted_after(rows: DataFrame, day: Column) -> DataFrame:
    """Rows that were published on `day` or later; rows without a date are left out, as the feed does."""
    return rows.where(F.col("published_at") >= day)


def append_run(path: str, run: DataFrame) -> None:
    """The run ledger is append-only, a folder for each source."""
    run.write.mode("append").partitionBy("source_name").parquet(path)


def write_report(frames: dict[str, DataFrame], path: str) -> None:
    """Each frame as json lines and as csv."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").json(f"{path}/{name}.json")
        flat = frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])
        flat.write.mode("overwrite").option("header", True).csv(f"{path}/{name}.csv")
