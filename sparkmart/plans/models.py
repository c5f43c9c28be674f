"""Staging, star schema and the complaint mart as DataFrame plans."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.functions import casts
from sparkmart.operators.dedup import keep_first, keep_last, latest_snapshot, split_by_keys, split_marked, split_repeated
from sparkmart.operators.key_directory import COUNTED, KeyDirectory
from sparkmart.operators.median import exact_median
from sparkmart.operators.merge import append_partitions, apply_delete_insert
from sparkmart.sources.landed import read_or_empty
from sparkmart.sources.paths import delete, exists, file_names, file_states, partition_values

# The price bands.
PRICE_CUTS = [(25, "1. <$25"), (50, "2. $25-50"), (100, "3. $50-100")]
TOP_PRICE = "4. $100+"
EXCLUSIVE_FLAG = "store_exclusive"
# What makes a review: the raw values of these.
REVIEW_KEY = ("author_id", "product_id", "submission_time", "coalesce(review_text, '')")


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a table, replacing an older one, and read it back."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stg_products(raw: DataFrame, exclusive_flag: str = EXCLUSIVE_FLAG) -> DataFrame:
    """One typed row per product from the newest snapshot.

    ``exclusive_flag`` names the catalogue column that marks retailer exclusives.
    """
    text, num, whole = casts.blank_to_null, casts.try_double, casts.try_int
    typed = latest_snapshot(raw, "load_date").where("product_id is not null").select(
        F.trim("product_id").alias("product_id"),
        F.trim("product_name").alias("product_name"),
        whole("brand_id").alias("brand_id"),
        F.trim("brand_name").alias("brand_name"),
        num("price_usd").alias("price_usd"),
        num("sale_price_usd").alias("sale_price_usd"),
        num("rating").alias("catalog_rating"),
        whole("reviews").alias("catalog_review_count"),
        whole("loves_count").alias("loves_count"),
        text("size").alias("size"),
        "primary_category",
        "secondary_category",
        "tertiary_category",
        casts.flag("limited_edition").alias("is_limited_edition"),
        casts.flag("new").alias("is_new"),
        casts.flag("online_only").alias("is_online_only"),
        casts.flag("out_of_stock").alias("is_out_of_stock"),
        casts.flag(exclusive_flag).alias(f"is_{exclusive_flag}"),
        F.col("load_date").cast("date").alias("snapshot_date"),
        "_loaded_at",
    )
    return keep_last(typed, ["product_id"], ["_loaded_at"]).drop("_loaded_at")


RAW_REVIEW = (
    "author_id string, product_id string, submission_time string, review_text string, rating string, "
    "is_recommended string, helpfulness string, total_feedback_count string, total_neg_feedback_count string, "
    "total_pos_feedback_count string, review_title string, skin_tone string, skin_type string, eye_color string, "
    "hair_color string, price_usd string, _batch_id string, load_date date"
)


def typed_reviews(raw: DataFrame, *extra: Column) -> DataFrame:
    """Typed reviews; rows without a product, a rating of 1 to 5 or a date are dropped.

    The key is taken from the raw, untrimmed values. ``extra`` columns are handed on.
    """
    text, num, whole = casts.blank_to_null, casts.try_double, casts.try_int
    typed = raw.select(
        casts.surrogate_key(*REVIEW_KEY).alias("review_id"),
        F.trim("author_id").alias("author_id"),
        F.trim("product_id").alias("product_id"),
        whole("rating").alias("rating"),
        casts.double_flag("is_recommended").alias("is_recommended"),
        num("helpfulness").alias("helpfulness"),
        whole("total_feedback_count").alias("total_feedback_count"),
        whole("total_neg_feedback_count").alias("total_neg_feedback_count"),
        whole("total_pos_feedback_count").alias("total_pos_feedback_count"),
        casts.leading_date("submission_time").alias("review_date"),
        text("review_title").alias("review_title"),
        text("review_text").alias("review_text"),
        casts.empty_to_null("skin_tone").alias("skin_tone"),
        casts.empty_to_null("skin_type").alias("skin_type"),
        casts.empty_to_null("eye_color").alias("eye_color"),
        casts.empty_to_null("hair_color").alias("hair_color"),
        num("price_usd").alias("price_usd_at_review"),
        F.col("load_date").cast("date").alias("load_date"),
        F.col("_batch_id").alias("batch_id"),
        *extra,
    )
    # The list is one test; a range would evaluate the pushed-down cast twice.
    return typed.where("product_id is not null and rating in (1, 2, 3, 4, 5) and review_date is not null")


def stg_reviews(raw: DataFrame, stored: bool = False) -> DataFrame:
    """One typed row per review: the copy that landed first.

    ``stored`` rows are cheap to read again: they are read three times, and only reviews that may have landed more than
    once are shuffled and sorted.
    """
    if not stored:
        return keep_first(typed_reviews(raw), ["review_id"], ["load_date"])
    # The text that the key is the md5 of.
    once, again = split_repeated(raw, F.expr(f"concat_ws('|', {', '.join(REVIEW_KEY)})"))
    return typed_reviews(once).unionByName(keep_first(typed_reviews(again), ["review_id"], ["load_date"]))


def dim_brands(products: DataFrame) -> DataFrame:
    """Brand name, product count, median price, mean rating and total loves."""
    branded = products.where("brand_id is not null")
    totals = branded.groupBy("brand_id").agg(
        F.min("brand_name").alias("brand_name"),
        F.count("*").alias("n_products"),
        F.round(F.avg("catalog_rating"), 3).alias("avg_catalog_rating"),
        F.sum("loves_count").alias("total_loves"),
    )
    medians = exact_median(branded, ["brand_id"], "price_usd", "median")
    return totals.join(medians, "brand_id", "left").select(
        "brand_id",
        "brand_name",
        "n_products",
        F.round("median", 2).alias("median_price_usd"),
        "avg_catalog_rating",
        "total_loves",
    )


def dim_products(
    products: DataFrame,
    cuts: Sequence[tuple[float, str]] = tuple(PRICE_CUTS),
    top: str = TOP_PRICE,
    exclusive_flag: str = EXCLUSIVE_FLAG,
) -> DataFrame:
    """Products with a price band."""
    return products.select(
        "product_id",
        "product_name",
        "brand_id",
        "primary_category",
        "secondary_category",
        "tertiary_category",
        "price_usd",
        casts.band("price_usd", list(cuts), top).alias("price_band"),
        "size",
        "catalog_rating",
        "catalog_review_count",
        "loves_count",
        "is_limited_edition",
        "is_new",
        "is_online_only",
        f"is_{exclusive_flag}",
        "snapshot_date",
    )


FACT_COLUMNS = [
    "review_id", "product_id", "brand_id", "author_id", "review_date", "rating", "is_recommended",
    "helpfulness", "total_feedback_count", "total_pos_feedback_count", "total_neg_feedback_count",
    "price_usd_at_review", "skin_type", "skin_tone", "review_title", "review_text", "load_date", "batch_id",
]


def fct_reviews(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews of known products, with the brand taken from the product.

    The join has no hint: the runtime broadcasts the products when they measure
    small, and otherwise splits the partitions of hot products.
    """
    return reviews.join(products.select("product_id", "brand_id"), "product_id").select(*FACT_COLUMNS)


FILES = "file string, bytes long, modified long, load_date date, run int, gone boolean"


RawFile = tuple[str, int, int, date]


def _raw_files(spark: SparkSession, raw_base: str) -> set[RawFile]:
    """Files of a landed table (file, bytes, modified, load_date), as Spark's own listing holds on the driver.

    A stream's output is taken from its commit log.
    """
    if not exists(spark, raw_base):
        return set()
    states = file_states(spark, spark.read.schema(RAW_REVIEW).parquet(raw_base).inputFiles())
    return {(f, *s, date.fromisoformat(f.rsplit("/load_date=", 1)[1].split("/")[0])) for f, s in states.items()}


CHANGED = "review_id string, prior date, date date"


def _file_name(raw_file: RawFile) -> str:
    """How the key directory calls a raw file: load date and name."""
    return f"{raw_file[3]}/{raw_file[0].rsplit('/', 1)[1]}"


def _filed_reviews(spark: SparkSession, raw_base: str, paths: list[str]) -> DataFrame:
    """Rows of raw files, with the file each comes from.

    Landed values are text, so the schema is known and no footer is read for it.
    """
    if not paths:
        return spark.createDataFrame([], f"{RAW_REVIEW}, _file string")
    raw = spark.read.schema(RAW_REVIEW).option("basePath", raw_base).parquet(*paths)
    return raw.withColumn("_file", F.concat(F.col("load_date").cast("string"), F.lit("/"), F.col("_metadata.file_name")))


def _hashes(keys: DataFrame) -> DataFrame:
    return keys.select(F.xxhash64("key").alias("_hash"))


def extend_staged_reviews(spark: SparkSession, raw_base: str, path: str) -> list[str]:
    """Bring the staged reviews up to the landed files; returns the load dates with new, changed or gone files.

    Raw files are compared one by one with those staged before, so rows that reach an older
    date, replace a partition or come from a stream's next run are staged too. Of all copies
    of a review the earliest landed stays, whatever the order of arrival.

    A key directory holds the load date and file of every copy, so neither staged rows nor their keys
    are searched: the keys of new and gone files are looked up there, and raw files are read again
    only where they hold the copies that now come first. It counts copies too, so rows of reviews with
    one copy are staged as they are read, without a shuffle. The keys that changed, with the date they
    were staged under and the new one, are kept for ``extend_fact``; the file log is written
    last, so a run that dies is repeated.
    """
    log = read_or_empty(spark, f"{path}_files", FILES)
    newest = keep_last(log, ["file", "bytes", "modified"], ["run"]).collect()
    done = max((r["run"] for r in newest), default=0)
    arrived = {(r["file"], r["bytes"], r["modified"], r["load_date"]): r["run"] for r in newest if not r["gone"]}
    now = _raw_files(spark, raw_base)
    fresh, gone = sorted(now - arrived.keys()), sorted(arrived.keys() - now)
    if not fresh and not gone:
        return []
    run = done + 1
    directory = KeyDirectory(spark, f"{path}_directory", entry=COUNTED)
    raw = _filed_reviews(spark, raw_base, [f for f, *_ in fresh])
    # Read again for the rows: the keys alone first, which is less than to write all rows and read them back.
    entries = typed_reviews(raw, F.col("_file")).select(
        F.col("review_id").alias("key"), "load_date", F.col("_file").alias("file"), F.lit(run).alias("arrived"), F.lit(1).alias("copies")
    )
    directory.add(entries, run, distinct=True)
    if not done:
        counted = directory.arrivals([run]).groupBy("key").agg(F.sum("copies").alias("copies"))
        again, once = split_marked(raw, casts.surrogate_key(*REVIEW_KEY), _hashes(counted.where("copies > 1")))
        first = typed_reviews(once).unionByName(keep_first(typed_reviews(again), ["review_id"], ["load_date"]))
        first.write.mode("overwrite").option("compression", "zstd").partitionBy("load_date").parquet(path)
    else:
        _restage(spark, raw_base, path, raw, directory, run, arrived, set(gone))
    logged = [(*f, run, files is gone) for files in (fresh, gone) for f in files]
    spark.createDataFrame(logged, FILES).coalesce(1).write.mode("append").parquet(f"{path}_files")
    return sorted({str(d) for *_, d in [*fresh, *gone]})


def _restage(
    spark: SparkSession,
    raw_base: str,
    path: str,
    raw: DataFrame,
    directory: KeyDirectory,
    run: int,
    arrived: dict[RawFile, int],
    gone: set[RawFile],
) -> None:
    """Replace the staged rows of keys whose first copy changed.

    A new review with one copy, none of it staged before, has won as it is. Only other rows are ranked, and stored for it.
    """
    work = f"{path}_run"
    left_path = f"{path}_keys/run={run}"
    # Keys that a run which died may have changed already are settled again.
    left = read_or_empty(spark, left_path, CHANGED).select(F.col("review_id").alias("key")).distinct()
    known = spark.createDataFrame([(_file_name(f), n, f in gone) for f, n in arrived.items()], "file string, arrived int, gone boolean")
    lost = directory.arrivals(sorted({n for f, n in arrived.items() if f in gone}))
    lost = lost.join(known.where("gone"), ["file", "arrived"], "left_semi").select("key")
    mine = directory.arrivals([run])
    keys = store(mine.select("key").unionByName(lost).unionByName(left).distinct(), f"{work}/keys")
    old = directory.lookup(keys).where(F.col("arrived") < run).join(known, ["file", "arrived"]).select("key", "load_date", "file", "gone")
    old = store(old, f"{work}/old")
    delete(spark, f"{work}/keys")
    day, no = F.col("load_date"), F.lit(False)
    none = F.lit(None).cast("int").alias("copies")
    copies = old.select("key", "load_date", none, "gone", no.alias("fresh"), no.alias("again"))
    copies = copies.unionByName(mine.select("key", "load_date", "copies", no.alias("gone"), F.lit(True).alias("fresh"), no.alias("again")))
    copies = copies.unionByName(left.select("key", F.lit(None).cast("date").alias("load_date"), none, no.alias("gone"), no.alias("fresh"), F.lit(True).alias("again")))
    dates = copies.groupBy("key").agg(
        F.min(F.when(~F.col("fresh"), day)).alias("prior"),
        F.min(F.when(F.col("gone"), day)).alias("lost_day"),
        F.min(F.when(~F.col("fresh") & ~F.col("gone"), day)).alias("old_day"),
        F.min(F.when(F.col("fresh"), day)).alias("new_day"),
        F.sum("copies").alias("copies"),
        F.max("again").alias("again"),
    )
    # The staged row may be gone, or may have been changed by a run that died.
    unsure = F.coalesce(F.col("lost_day") <= F.col("old_day"), no) | F.col("again")
    is_first = F.col("new_day").isNull() | (F.col("old_day") <= F.col("new_day"))
    reread = F.col("old_day").isNotNull() & is_first & (unsure | F.coalesce(F.col("old_day") == F.col("new_day"), no))
    taken = F.col("new_day").isNotNull() & (F.col("old_day").isNull() | (F.col("new_day") <= F.col("old_day")))
    alone = F.col("new_day").isNotNull() & F.col("old_day").isNull() & (F.col("copies") == 1)
    dates = dates.select("key", "prior", "old_day", "new_day", unsure.alias("unsure"), reread.alias("reread"), taken.alias("taken"), alone.alias("alone"))
    dates = store(dates, f"{work}/dates")

    rivals, single = split_marked(raw, casts.surrogate_key(*REVIEW_KEY), _hashes(dates.where("new_day is not null and not alone")))
    single = typed_reviews(single)
    columns = single.columns
    # Rows are dealt by the review alone, for the joins and for the ranks: a difference of days, and a list of files, are no join keys.
    won = dates.where("taken").select(F.col("key").alias("review_id"), F.col("new_day").alias("_day"), F.col("prior").alias("_prior"), F.col("alone").alias("_alone"))
    rows = typed_reviews(rivals).join(won, "review_id").where(F.date_diff("load_date", "_day") == 0)
    rows = rows.select(*columns, "_prior", "_alone", F.lit(1).alias("_write"))
    again = dates.where("reread").select("key", F.col("old_day").alias("load_date"), "prior", "unsure")
    places = old.where("not gone").join(again, ["key", "load_date"])
    places = store(places.select(F.col("key").alias("review_id"), F.col("file").alias("_file"), F.col("prior").alias("_prior"), "unsure"), f"{work}/places")
    delete(spark, f"{work}/old")
    wanted = {r["_file"] for r in places.select("_file").distinct().collect()}
    paths = sorted(f[0] for f in arrived if f not in gone and _file_name(f) in wanted)
    if paths:
        # A row that stays as it is staged competes, but need not be written.
        files = places.groupBy("review_id", "_prior", "unsure").agg(F.collect_set("_file").alias("_files"))
        held = _filed_reviews(spark, raw_base, paths)
        held = split_marked(held, casts.surrogate_key(*REVIEW_KEY), _hashes(places.select(F.col("review_id").alias("key"))))[0]
        held = typed_reviews(held, F.col("_file")).join(files, "review_id").where(F.array_contains("_files", F.col("_file")))
        rows = rows.unionByName(held.select(*columns, "_prior", no.alias("_alone"), F.col("unsure").cast("int").alias("_write")))
    winners = store(keep_first(rows, ["review_id"], ["load_date"]).where("_write = 1").drop("_write"), f"{work}/winners")
    # A row alone that met a marked bit by chance is told by its key as well.
    settled = winners.where("not _alone").select("review_id", F.col("_prior").alias("prior"), F.col("load_date").alias("date"))
    settled = settled.unionByName(dates.where("alone").select(F.col("key").alias("review_id"), "prior", F.col("new_day").alias("date")))
    # Where neither day is known no copy is left.
    ended = dates.where("old_day is null and new_day is null").select(F.col("key").alias("review_id"), "prior", F.lit(None).cast("date").alias("date"))
    settled.unionByName(ended).write.mode("append").option("compression", "zstd").parquet(left_path)
    changed = spark.read.schema(CHANGED).parquet(left_path)
    within = {str(r[0]) for r in changed.select(F.explode(F.array("prior", "date"))).distinct().collect() if r[0]}
    batch = single.unionByName(winners.select(*columns))
    apply_delete_insert(spark, path, batch, "review_id", keys=changed.select("review_id"), within=within)
    delete(spark, work)


def extend_fact(
    spark: SparkSession, staged_path: str, products: DataFrame, path: str, reprocess_orphans: bool = False
) -> list[str]:
    """Bring the stored fact table up to the staged reviews; returns the partitions written.

    Takes the keys of all staging runs that are not applied yet, and replaces the fact's rows
    of those keys in one write. A review whose product only shows up in a later catalogue
    stays out, unless ``reprocess_orphans`` looks for staged reviews that the fact lacks.
    """
    log = read_or_empty(spark, f"{staged_path}_files", FILES)
    newest = log.agg(F.max("run")).first()[0]
    if newest is None or not partition_values(spark, staged_path, "load_date"):
        return []
    staged = spark.read.parquet(staged_path)
    applied = f"{path}_applied"
    done = read_or_empty(spark, applied, "run int").agg(F.max("run")).first()[0]
    # A first build that did not finish left no mark and is done again in full.
    if done is None or not exists(spark, path):
        batch = fct_reviews(staged, products)
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", "zstd")
            .partitionBy("load_date")
            .parquet(path)
        )
        written = partition_values(spark, path, "load_date")
    elif reprocess_orphans:
        lacking = staged.join(spark.read.parquet(path).select("review_id"), "review_id", "left_anti")
        found = store(fct_reviews(lacking, products), f"{path}_run")
        # What follows the fact table has to hear of these keys too.
        run = 1 + sum(n.startswith("run=") for n in file_names(spark, f"{path}_orphans"))
        told = found.select("review_id", F.lit(None).cast("date").alias("prior"), F.col("load_date").alias("date"))
        told.write.mode("overwrite").parquet(f"{path}_orphans/run={run}")
        appended = append_partitions(found, path)
        delete(spark, f"{path}_run")
        return appended
    elif done == newest:
        return []
    else:
        runs = [f"{staged_path}_keys/run={r}" for r in range(done + 1, newest + 1)]
        changed = spark.read.schema(CHANGED).parquet(*runs)
        # Only partitions that hold such keys now, or held them, are read.
        days = changed.agg(F.collect_set("date"), F.collect_set("prior")).first()
        keys = changed.select("review_id").distinct()
        batch = fct_reviews(split_by_keys(staged.where(F.col("load_date").isin(days[0])), "review_id", keys)[0], products)
        within = {str(d) for d in [*days[0], *days[1]]}
        written = apply_delete_insert(spark, path, batch, "review_id", keys=keys, within=within)
    spark.createDataFrame([(newest,)], "run int").coalesce(1).write.mode("append").parquet(applied)
    return written


def reload_fact(spark: SparkSession, reviews: DataFrame, products: DataFrame, path: str) -> list[str]:
    """Delete the fact rows whose key is in ``reviews`` and insert the new ones.

    For stored reviews that were landed again with other values or under another date.
    """
    return apply_delete_insert(spark, path, fct_reviews(reviews, products), "review_id")


def complaint_counts(tags: DataFrame, facts: DataFrame) -> DataFrame:
    """Tagged reviews per brand, labeler and complaint type."""
    keyed = tags.select("review_id", "labeler", "sentiment", "complaint_type").join(
        facts.select("review_id", "brand_id"), "review_id"
    )
    return keyed.groupBy("brand_id", "labeler", "complaint_type").agg(
        F.count("*").alias("n_reviews"),
        F.count_if(F.col("sentiment") == "negative").alias("n_negative"),
    )


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, total: str, share: str) -> DataFrame:
    """Add the group total of ``value`` and each row's share of it."""
    whole = F.sum(value).over(Window.partitionBy(*keys))
    return df.withColumn(total, whole).withColumn(share, F.round(F.col(value) / F.col(total), 4))


def mart_brand_complaints(tags: DataFrame, facts: DataFrame, brands: DataFrame) -> DataFrame:
    """Complaint mix per brand and labeler.

    Tags are counted first; brand names join the few counted rows.
    """
    counted = share_of_total(
        complaint_counts(tags, facts), ["brand_id", "labeler"], "n_reviews", "n_tagged_for_brand",
        "share_of_brand_reviews",
    )
    return counted.join(brands.select("brand_id", "brand_name"), "brand_id").select(
        "brand_id", "brand_name", "labeler", "complaint_type", "n_reviews", "n_negative",
        "n_tagged_for_brand", "share_of_brand_reviews",
    )
