"""Delivery status: status table, planning and published codes in one overview, and its KPIs.

"Latest" and "first" rows are taken with ``max_by``/``min_by``, which combine before the
shuffle; no window ever gathers all rows of one code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import dates, labels, text
from tidegate.operators.paging import Pages
from tidegate.operators.references import prefixes_of

DELIVERED, NOT_DELIVERED = "delivered", "not_delivered"
PUBLISHED, NOT_PUBLISHED = "published", "not_published"

# Spellings of the status columns, first filled one wins.
SPELLINGS = {
    "databundelcode": ("databundelcode", "data_bundle_code", "Data Bundle Code"),
    "krmcriterium": ("krmcriterium", "krm_criterium", "KRM Criterium"),
    "last_updated": ("last_updated", "updated", "Last Updated"),
}


def parse_status(df: DataFrame) -> DataFrame:
    """Status rows with validation and approval as booleans; rows without a code are dropped."""
    pick = lambda name: text.first_filled(
        *[F.col(f"`{c}`") for c in SPELLINGS[name] if c in df.columns], F.lit("")
    )
    sentence = F.col("status") if "status" in df.columns else F.lit(None).cast("string")

    def flag(name: str, label: str) -> Column:
        told = text.flag_from_status(sentence, label)
        return text.flag_from_text(name) if name in df.columns else told

    valid, approved = flag("validation", "validatie"), flag("approval", "akkoord file")
    word = lambda c: F.when(c, "true").otherwise("false")
    parsed = df.select(
        pick("databundelcode").alias("databundelcode"),
        pick("krmcriterium").alias("krmcriterium"),
        (F.col("last_updated") if "last_updated" in df.columns else pick("last_updated")).alias("last_updated"),
        valid.alias("validation"),
        approved.alias("approval"),
        F.coalesce(
            F.nullif(sentence, F.lit("")),
            F.concat(F.lit("Validatie: "), word(valid), F.lit(", Akkoord: "), word(approved)),
        ).alias("status"),
        (F.col("akkoord_reden") if "akkoord_reden" in df.columns else F.lit(None).cast("string")).alias("akkoord_reden"),
        "ord",
    )
    return parsed.where(F.col("databundelcode") != "")


def _latest(df: DataFrame, keys: list[str], when: Column, payload: list[str], order: str) -> DataFrame:
    """Per key the row with the latest ``when``, first on ties.

    Comparing with an unreadable date is never true, so an unreadable first row stays
    and an unreadable later row never wins.
    """
    row = F.struct(*payload)
    readable = df.withColumn("_when", when)
    best = F.max_by(
        F.when(F.col("_when").isNotNull(), row), F.when(F.col("_when").isNotNull(), F.struct("_when", -F.col(order)))
    )
    found = readable.groupBy(*keys).agg(
        F.min_by(F.struct(F.col("_when").alias("w"), row.alias("row")), order).alias("_first"),
        best.alias("_best"),
        F.min(order).alias("first_ord"),
    )
    winner = F.when(F.col("_first.w").isNull(), F.col("_first.row")).otherwise(F.col("_best"))
    return found.select(*keys, winner.alias("_row"), "first_ord").select(*keys, "_row.*", "first_ord")


def dedupe_planning(planning: DataFrame) -> DataFrame:
    """One row per bundle code with the latest delivery date, at the place of the code's first row."""
    complete = planning.where(
        (F.coalesce("databundelcode", F.lit("")) != "")
        & (F.coalesce("criteria", F.lit("")) != "")
        & (F.coalesce("leverdatum", F.lit("")) != "")
    )
    latest = _latest(
        complete, ["databundelcode"], dates.planning_day("leverdatum"), ["criteria", "leverdatum"], "ord"
    )
    return latest.withColumnRenamed("first_ord", "ord")


def latest_deliveries(status: DataFrame) -> DataFrame:
    """The latest delivery per base code; a missing time counts as 1970."""
    epoch = F.lit("1970-01-01").cast("timestamp")
    if dict(status.dtypes)["last_updated"] == "string":
        blank = F.coalesce("last_updated", F.lit("")) == ""
        when = F.when(blank, epoch).otherwise(F.col("last_updated").try_cast("timestamp"))
    else:
        when = F.coalesce(F.col("last_updated").cast("timestamp"), epoch)
    based = status.withColumn("base_databundelcode", text.base_code("databundelcode"))
    payload = [c for c in status.columns if c != "ord"] + ["ord"]
    return _latest(based, ["base_databundelcode"], when, payload, "ord").drop("first_ord")


def published_flags(codes: DataFrame, published: DataFrame) -> DataFrame:
    """The distinct values of ``code`` that some published code starts with.

    Each published code becomes a row for every length, which no estimate of its size counts, so the join is told
    not to broadcast them.
    """
    wanted = codes.select("code").distinct().withColumn("_norm", text.plus_for_blanks("code"))
    lengths = wanted.agg(F.array_sort(F.collect_set(F.length("_norm"))))
    done = published.where(F.coalesce("databundelcode", F.lit("")) != "").select(
        text.plus_for_blanks("databundelcode").alias("_done")
    ).distinct()
    starts = (
        done.withColumn("_lengths", lengths.scalar())
        .select(F.explode(prefixes_of(F.col("_done"), F.col("_lengths"))).alias("_norm"))
        .distinct()
    )
    return wanted.join(starts.hint("merge"), "_norm", "left_semi").select("code")


def status_overview(status: DataFrame, planning: DataFrame, published: DataFrame) -> DataFrame:
    """Every planned delivery with its state, and the deliveries nobody planned.

    ``planning`` is deduplicated and ``status`` parsed already. Of several planning rows with
    one base code only the first takes the delivery; the others count as not delivered.
    """
    latest = latest_deliveries(status)
    carried = [c for c in latest.columns if c not in ("base_databundelcode", "ord")]
    planned = planning.withColumn("_base", text.base_code("databundelcode"))
    firsts = planned.groupBy("_base").agg(F.min("ord").alias("_first"))

    # Both sides hold a base code once, so this join cannot be skewed; nor can the
    # next, whose key (base, place) is unique.
    taken = firsts.join(latest, F.col("_base") == F.col("base_databundelcode"))
    taken = taken.select(
        F.col("_base"),
        F.col("_first").alias("ord"),
        F.struct(*carried).alias("_delivery"),
    )
    merged = planned.join(taken, ["_base", "ord"], "left")
    has = F.col("_delivery").isNotNull()

    def delivery(name: str) -> Column:
        return F.col(f"_delivery.{name}")

    rows = merged.select(
        F.when(has, delivery("databundelcode")).otherwise(F.col("databundelcode")).alias("databundelcode"),
        F.when(has & (F.coalesce("criteria", F.lit("")) == ""), delivery("krmcriterium"))
        .otherwise(F.col("criteria"))
        .alias("krmcriterium"),
        delivery("last_updated").alias("last_updated"),
        F.coalesce(delivery("validation"), F.lit(False)).alias("validation"),
        F.coalesce(delivery("approval"), F.lit(False)).alias("approval"),
        delivery("status").alias("status"),
        delivery("akkoord_reden").alias("akkoord_reden"),
        "leverdatum",
        has.alias("_delivered"),
        F.col("databundelcode").alias("validation_databundelcode"),
        F.when(has, F.col("databundelcode")).alias("code"),
    )
    left_over = latest.join(
        firsts, F.col("base_databundelcode") == F.col("_base"), "left_anti"
    ).select(
        *carried,
        F.lit(None).cast("string").alias("leverdatum"),
        F.lit(True).alias("_delivered"),
        F.lit(None).cast("string").alias("validation_databundelcode"),
        F.col("databundelcode").alias("code"),
    )
    both = rows.unionByName(left_over.select(*rows.columns))
    live = published_flags(both.where(F.col("code").isNotNull()), published).select(
        F.col("code").alias("_live")
    )
    # A row that was not delivered has no code to look up; those rows must not share one key.
    key = F.coalesce("code", F.concat(F.lit("\u0000"), F.col("databundelcode")))
    flagged = both.withColumn("_key", key).join(live, F.col("_key") == F.col("_live"), "left")
    return flagged.select(
        "databundelcode",
        "krmcriterium",
        "last_updated",
        "validation",
        "approval",
        "status",
        "akkoord_reden",
        "leverdatum",
        F.when(F.col("_delivered"), DELIVERED).otherwise(NOT_DELIVERED).alias("delivery_status"),
        F.when(F.col("_live").isNotNull(), PUBLISHED).otherwise(NOT_PUBLISHED).alias("publication_status"),
        labels.combined_status("validation", "approval", "_delivered").alias("combined_status"),
        "validation_databundelcode",
    )


def filter_overview(
    overview: DataFrame,
    criterium: str | None = None,
    status: str | None = None,
    delivery: str | None = None,
    publication: str | None = None,
    year: int | None = None,
) -> DataFrame:
    """The overview rows that pass every filter that is set."""
    out = overview
    if criterium:
        out = out.where(F.col("krmcriterium") == criterium)
    if status:
        out = out.where(F.col("combined_status") == status)
    if delivery is not None:
        out = out.where(F.col("delivery_status") == delivery)
    if publication is not None:
        out = out.where(F.col("publication_status") == publication)
    if year is not None:
        out = out.where(dates.delivery_year("leverdatum") == year)
    return out


# The columns of the status table on screen.
TABLE_COLUMNS = (
    "databundelcode",
    "krmcriterium",
    "last_updated",
    "leverdatum",
    "combined_status",
    "delivery_status",
    "publication_status",
)


def search_overview(overview: DataFrame, query: str | None) -> DataFrame:
    """Rows with the query text in any shown column, in any case."""
    if not query:
        return overview
    cells = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TABLE_COLUMNS])
    return overview.where(F.exists(cells, lambda c: F.lower(c).contains(query.lower())))


def page(overview: DataFrame, sort_by: str, descending: bool = False, number: int = 0, size: int = 10) -> DataFrame:
    """One page of the sorted table (ties in code order)."""
    first = F.col(sort_by).desc() if descending else F.col(sort_by).asc()
    ties = [c for c in ("databundelcode", "validation_databundelcode") if c != sort_by]
    return overview.orderBy(first, *ties).offset(number * size).limit(size)


def pages(overview: DataFrame, sort_by: str, descending: bool = False, ranges: int | None = None) -> Pages:
    """All pages of the sorted table, in the order of ``page``; for tables that are looked through."""
    return Pages(overview, sort_by, descending, ("databundelcode", "validation_databundelcode"), ranges)


def kpis(overview: DataFrame) -> DataFrame:
    status = F.col("combined_status")
    return overview.agg(
        F.count("*").alias("total_bundles"),
        F.count_if(F.col("delivery_status") == DELIVERED).alias("delivered_bundles"),
        F.count_if("validation").alias("valid_bundles"),
        F.count_if(F.col("publication_status") == PUBLISHED).alias("published_bundles"),
        F.count_if(status.isin(labels.COMPLIES, labels.DEVIATES)).alias("compliant_bundles"),
        F.countDistinct(F.coalesce("krmcriterium", F.lit("\u0000"))).alias("unique_criteria"),
    )


def criterium_options(overview: DataFrame) -> DataFrame:
    return overview.select("krmcriterium").distinct().orderBy("krmcriterium")


def year_options(overview: DataFrame, current_year: int) -> DataFrame:
    """Delivery years in the data and those around the current one, newest first."""
    spark = overview.sparkSession
    around = spark.range(current_year - 2, current_year + 2).select(F.col("id").cast("int").alias("year"))
    found = overview.select(dates.delivery_year("leverdatum").alias("year")).where(F.col("year").isNotNull())
    return found.distinct().unionByName(around).distinct().orderBy(F.col("year").desc())


def pick_layers(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Best catalog layer for every criterion of every request.

    ``requests`` is ``(krmcriterium, publication_status)``; ``catalog`` is ``(id, criterium, name)``
    in the order of ``id``. Published criteria take the first current layer, else the first of
    all; unpublished ones take the first test layer or none.
    """
    name = F.lower("name")
    row = F.struct("id", "name")
    current = name.contains("actueel") | name.contains("current")
    best = catalog.groupBy("criterium").agg(
        F.min(F.when(current, row)).alias("_current"),
        F.min(row).alias("_any"),
        F.min(F.when(name.contains("tst_actueel_indicator"), row)).alias("_test"),
    )
    wanted = requests.select(
        F.explode(text.criteria_list("krmcriterium")).alias("criterium"), "publication_status"
    ).distinct()
    picked = F.when(F.col("publication_status") == NOT_PUBLISHED, F.col("_test")).otherwise(
        F.coalesce("_current", "_any")
    )
    return wanted.join(best, "criterium", "left").select(
        "criterium", "publication_status", picked["id"].alias("layer_id"), picked["name"].alias("layer_name")
    )
