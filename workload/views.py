"""The library's inputs, expressed over the given tables.

Every view is lazy and scales with its tables.  Views take only the columns a
query needs; in particular the part table is joined only when lineages are
wanted, and the order side is narrowed to places before line items meet it, so
line items are shuffled once.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidewatch.functions.lineages import lineage_family
from tidewatch.functions.text import lookup

AS_OF = dt.date(2001, 8, 2)
LAST = AS_OF - dt.timedelta(days=1)
FIRST = dt.date(1995, 1, 1)
SNAPSHOT_SHIFT = 8216          # days between the event days and the order days
HOME, NEIGHBOUR = "N00", "N03"
SERIES_CODES = ("N00", "N07", "N11")

# Dirty spellings by nation key, for the location operators.
SPELLINGS = (
    "usa", "Puerto Rico", "guam", "Czech Republic", "Antigua",
    "democratic republic of the congo", "Republic of the Congo", "Faroe Islands",
    "Guinea Bissau", "Niogeria", "Bosni and Herzegovina", "England", "The Bahamas",
    "Cote d'Ivoire", "Jerusalem", "germany", "Denmark", "South africa", "Kosovo",
    "Timor", "Czech republic", "Jonavos apskritis", "Usa", "Cote dIvoire", "canada",
)

# The same nations as other files write them, for the lookup by words.
WRITTEN = (
    "United States of America", "Puerto Rico", "U.S. Virgin Islands", "Czechia", "Antigua & Barbuda",
    "Dem. Rep. Congo", "Congo (Brazzaville)", "Faeroe Islands", "Guinea Bissau", "Niger", "Bosnia",
    "UK", "Bahamas, The", "Côte d’Ivoire", "Republic of Korea", "Iran (Islamic Republic of)", "Laos",
    "Syria", "Russian Federation", "Cape Verde", "Burma", "Swaziland", "Macedonia", "Réunion (France)",
    "Nowhere Land",
)

# Lineage groups over the brand names; `Brand#2*` is a prefix of Brand#2, #20 ...
GROUPS = {
    "who_first": ("Brand#1",),
    "who_second": ("Brand#2*",),
    "who_third": ("Brand#3", "Brand#4", "Brand#5"),
}
KEY_PATTERNS = ["Brand#1", "Brand#2*", "Brand#3", "Brand#4", "Brand#5", "Brand#7"]


# A view is a lazy plan; building it once per session and folder saves driver time.
view = functools.lru_cache(maxsize=None)

_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table.  Its schema is looked up once, not by a job per read."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spelling(key):
    return F.get(F.array(*(F.lit(x) for x in SPELLINGS)), key)


def written(key):
    return F.get(F.array(*(F.lit(x) for x in WRITTEN)), key)


@view
def nations(spark, sf) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
        .alias("code"))


@view
def order_places(spark, sf) -> DataFrame:
    """Orders with the customer's nation.

    Nations are few, so Spark broadcasts them.  Orders, customers and line
    items all grow with the data and meet in merge joins.
    """
    places = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    places = places.join(
        nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.to_date("o_orderdate").alias("collection_date"))
    return orders.hint("merge").join(places, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "collection_date", "o_totalprice", "n_nationkey", "country", "region",
        "code", F.col("c_mktsegment").alias("division"))


def accession():
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")


@view
def line_list(spark, sf, lineage: bool = False) -> DataFrame:
    """One row per line item: the sequence line list."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        accession().alias("accession_id"), F.to_date("l_shipdate").alias("submission_date"))
    rows = items.hint("merge").join(
        order_places(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    if lineage:
        part = table(spark, sf, "part").select(
            "p_partkey", F.col("p_brand").alias("pango_lineage"))
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return rows


@view
def clean_list(spark, sf, lineage: bool = True) -> DataFrame:
    """Line list in the shape the wide-table job reads."""
    keep = ["accession_id", "country", "region", "collect_date", "submit_date"]
    return line_list(spark, sf, lineage).withColumnsRenamed(
        {"collection_date": "collect_date", "submission_date": "submit_date"}
    ).select(*keep, *(["pango_lineage"] if lineage else [])).withColumn(
        "lag_days", F.datediff("submit_date", "collect_date"))


@view
def metadata(spark, sf) -> DataFrame:
    """The 22-column metadata extract, with gaps and partial dates."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", accession().alias("Accession ID"),
        F.concat(F.lit("hCoV-19/"), accession()).alias("Virus name"),
        F.to_date("l_shipdate").cast("string").alias("Submission date"),
        F.floor("l_extendedprice").alias("Sequence length"),
        F.when(F.col("l_tax") != 0.08, F.col("l_tax")).alias("N-Content"),
        F.when(F.col("l_discount") != 0.1, F.col("l_discount") * 4).alias("GC-Content"),
        F.when(F.col("l_linestatus") == "F", "Human").otherwise("Other").alias("Host"),
        F.col("l_linenumber").alias("_line"))
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("Pango lineage"))
    places = order_places(spark, sf).withColumn("_raw", spelling(F.col("n_nationkey")))
    day = F.col("collection_date").cast("string")
    rows = items.hint("merge").join(places, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey"))
    two = F.concat_ws(" / ", "region", "_raw")
    filler = F.lit(None).cast("string")
    return rows.select(
        "Virus name", F.lit("betacoronavirus").alias("Type"), "Accession ID",
        F.when(F.col("_line") == 7, F.substring(day, 1, 7)).otherwise(day)
        .alias("Collection date"),
        F.when(F.col("_line") == 6, two).otherwise(F.concat_ws(" / ", two, "division"))
        .alias("Location"),
        filler.alias("Additional location information"), "Sequence length", "Host",
        filler.alias("Patient age"), filler.alias("Gender"), filler.alias("Clade"),
        "Pango lineage", filler.alias("Pangolin version"), filler.alias("Variant"),
        filler.alias("AA Substitutions"), "Submission date",
        filler.alias("Is reference?"), filler.alias("Is complete?"),
        filler.alias("Is high coverage?"), filler.alias("Is low coverage?"),
        "N-Content", "GC-Content")


@view
def exclusion_lines(spark, sf) -> DataFrame:
    """Lines of an exclusion list: names, comments and blanks."""
    line = F.col("l_linenumber")
    return table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.when(line <= 3, accession()).when(line <= 5, F.concat(F.lit("# "), accession()))
        .otherwise("").alias("value"))


@view
def populations(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(
        (F.count("*") * 1000).cast("double").alias("population"))


REGION_CODES = {"AFRICA": "OWID_AFR", "AMERICA": "OWID_NAM", "ASIA": "OWID_ASI",
                "EUROPE": "OWID_EUR", "MIDDLE EAST": "OWID_OCE"}


@view
def case_series(spark, sf, aggregates: bool = True) -> DataFrame:
    """Country rows plus regional and world aggregates, as the case feed has them."""
    place = ["n_nationkey", "country", "code", "region"]
    daily = order_places(spark, sf).groupBy(
        *place, F.col("collection_date").alias("date"),
    ).agg(F.count("*").alias("_new"),
          F.sum(F.floor("o_totalprice")).alias("_vax"),
          F.sum(F.floor(F.col("o_totalprice") / 2)).alias("_full"))
    if aggregates:
        c = F.col
        daily = daily.groupingSets(
            [[*map(c, place), c("date")], [c("region"), c("date")], [c("date")]],
            *place, "date",
        ).agg(*(F.sum(m).alias(m) for m in ("_new", "_vax", "_full")))
    of_region = lookup(F.col("region"), REGION_CODES)
    is_country, is_region = F.col("code").isNotNull(), F.col("region").isNotNull()
    rows = daily.join(
        populations(spark, sf), F.col("n_nationkey") == F.col("c_nationkey"), "left",
    ).select(
        "date", F.coalesce("country", "region", F.lit("World")).alias("location"),
        F.coalesce("code", of_region, F.lit("OWID_WRL")).alias("iso_code"),
        F.when(is_country & is_region, F.col("region")).alias("continent"),
        F.coalesce("population", F.lit(5000000.0)).alias("population"),
        "_new", "_vax", "_full")
    w = Window.partitionBy("iso_code").orderBy("date").rowsBetween(
        Window.unboundedPreceding, 0)
    seen = F.dayofyear("date") % 7 != 0
    rows = rows.withColumns({
        "total_cases": F.sum("_new").over(w), "_cv": F.sum("_vax").over(w),
        "_cf": F.sum("_full").over(w)})
    hundred = lambda c: F.round(F.col(c) / (F.col("population") / 100), 2)
    return rows.select(
        "iso_code", "continent", "location", "date",
        F.col("total_cases").cast("double").alias("total_cases"),
        F.col("_new").cast("double").alias("new_cases"),
        F.round(F.col("_new") / 7, 3).alias("new_cases_smoothed"),
        F.floor(F.col("total_cases") / 50).cast("double").alias("total_deaths"),
        (F.col("_new") % 3).cast("double").alias("new_deaths"), "population",
        F.when(seen, F.col("_cv").cast("double")).alias("people_vaccinated"),
        F.when(seen, F.col("_cf").cast("double")).alias("people_fully_vaccinated"),
        F.when(seen, hundred("_cv")).alias("people_vaccinated_per_hundred"),
        F.when(seen, hundred("_cf")).alias("people_fully_vaccinated_per_hundred"))


@view
def testing(spark, sf) -> DataFrame:
    """Testing series: submissions per nation and day, plus regional rows.

    Regions appear a second time as countries that no dimension has a code for.
    """
    daily = line_list(spark, sf).groupBy(
        "n_nationkey", "country", "code", "region", F.col("submission_date").alias("time"),
    ).agg(F.count("*").alias("_n"))
    country = daily.join(
        populations(spark, sf), F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("country").alias("name"), F.col("code").alias("unit"),
        F.lit("country").alias("set"), "time", "_n", "population", "n_nationkey")
    region = daily.groupBy("region", "time").agg(F.sum("_n").alias("_n")).select(
        F.col("region").alias("name"), F.col("region").alias("unit"),
        F.lit("region").alias("set"), "time", "_n",
        F.lit(5000000.0).alias("population"), F.lit(0).alias("n_nationkey"))
    w = Window.partitionBy("set", "unit").orderBy("time").rowsBetween(
        Window.unboundedPreceding, 0)
    uncoded = region.withColumns({
        "name": F.concat(F.lit("Greater "), "name"), "set": F.lit("country")})
    rows = country.unionByName(region).unionByName(uncoded).withColumns({
        "_cum": F.sum("_n").over(w), "pop_100k": F.col("population") / 100000})
    factor = F.when(F.col("n_nationkey") % 5 == 0, F.lit(200)).otherwise(F.lit(30))
    return rows.select(
        "name", "unit", "set", "time", "pop_100k",
        (F.col("_n") / F.col("pop_100k")).alias("cap_new_tests"),
        (F.col("_cum") / F.col("pop_100k")).alias("cap_cum_tests"),
        F.col("_n").cast("double").alias("all_new_tests"),
        F.col("_cum").cast("double").alias("all_cum_tests"),
        F.floor(F.col("_cum") * factor / 100).cast("double").alias("all_cum_cases"))


@view
def snapshots(spark, sf) -> DataFrame:
    """Hourly scrapes of a case tracker, on the order calendar."""
    key = F.col("user_id") % 25
    code = F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0"))
    whole = F.col("value").cast("bigint")
    return table(spark, sf, "events").groupBy(
        F.date_trunc("hour", F.col("ts") - F.expr(f"interval {SNAPSHOT_SHIFT} days"))
        .cast("timestamp_ntz").alias("timestamp"), code.alias("code"),
    ).agg(
        F.sum(F.when(F.col("event_type") != "error", whole)).alias("confirmed"),
        F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("probable"),
    ).withColumn("location", F.concat(F.lit("place "), "code"))


@view
def feed_counts(spark, sf) -> DataFrame:
    """Submissions per country and day, without the days nobody submitted."""
    return line_list(spark, sf).groupBy("country", "code", "submission_date").agg(
        F.count("*").alias("n"))


@view
def country_dimension(spark, sf) -> DataFrame:
    return nations(spark, sf).select("country", "code")


@view
def geometry(spark, sf) -> DataFrame:
    n = nations(spark, sf).filter(F.col("n_nationkey") % 6 != 0)
    return n.select(
        F.concat(F.lit("POLYGON "), F.col("n_nationkey").cast("string")).alias("geometry"),
        F.col("country").alias("Name"), F.col("code").alias("country_code"))


@view
def lat_long(spark, sf) -> DataFrame:
    """Coordinates; one country is listed twice."""
    n = nations(spark, sf).select(
        F.col("code").alias("country_code"), (F.col("n_nationkey") * 1.5).alias("latitude"),
        (F.col("n_nationkey") * -2.25).alias("longitude"))
    return n.unionByName(n.filter(F.col("country_code") == HOME))


@view
def regions(spark, sf) -> DataFrame:
    return nations(spark, sf).filter(F.col("n_nationkey") < 24).select(
        F.col("country").alias("Entity"), F.col("region").alias("WHO region"))


def families():
    """Lineage families over brands: an exact one and two by substring."""
    c = F.col("pango_lineage")
    return {
        "fam_1": lineage_family(c, ["Brand#1"], "exact"),
        "fam_2": lineage_family(c, ["Brand#2"]),
        "fam_4_5": lineage_family(c, ["Brand#4", "Brand#5"]),
    }


@view
def coded_list(spark, sf, lineage: bool = True) -> DataFrame:
    keep = ["code", "country", "collection_date", "submission_date"]
    return line_list(spark, sf, lineage).select(
        *keep, *(["pango_lineage"] if lineage else []))


@view
def flows(spark, sf) -> DataFrame:
    """Weekly flows between places, keys packed in text."""
    day = F.to_date("l_shipdate")
    monday = F.date_trunc("week", day).cast("date")
    text = lambda d: d.cast("string")
    return table(spark, sf, "lineitem").groupBy(
        F.concat_ws("_", text(monday), text(F.date_add(monday, 6))).alias("Group.1"),
        F.concat_ws(" ", "l_suppkey", "l_partkey").alias("Group.2"),
    ).agg(F.sum("l_quantity").alias("x"))


@view
def state_table(spark, sf) -> DataFrame:
    """State table as published: counts as text with separators."""
    ll = line_list(spark, sf)
    items = ll.groupBy("country").agg(
        F.count("*").alias("_n"),
        F.percentile(F.datediff("submission_date", "collection_date"), F.lit(0.5))
        .cast("int").alias("Median days to deposition"))
    orders = order_places(spark, sf).groupBy("country").agg(F.count("*").alias("_c"))
    return items.join(orders, "country").select(
        F.col("country").alias("State"),
        F.format_number("_n", 0).alias("Genomes shared"),
        F.format_number("_c", 0).alias("Reported COVID-19 cases"),
        F.round(F.lit(100.0) * F.col("_n") / F.col("_c"), 3)
        .alias("% of cases sequenced and shared"),
        "Median days to deposition")


@view
def tracker_pages(spark, sf) -> DataFrame:
    """One scraped page per document: its words as table cells.

    Every seventh-column second and fourth cell is a number with separators; the
    page ends at a marker cell, if it has one.
    """
    words = F.split("text", " ")
    cell = lambda w, i: F.when(w == "und", "total (worldwide)").when(
        (i % 7 == 1) | (i % 7 == 3), F.concat(
            F.length(w).cast("string"), F.lit(","),
            F.lpad((i % 1000).cast("string"), 3, "0"))).otherwise(w)
    return table(spark, sf, "documents").select(
        "doc_id", F.transform(words, cell).alias("cells"))
