"""The parcel domain: features and marts built from the clean tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.functions.casting import year_start
from civiclake.functions.columns import ColumnLike, as_column
from civiclake.functions.dates import years_between
from civiclake.functions.geometry import feature_json, point
from civiclake.functions.text import joined_skipping_nulls
from civiclake.operators.history import latest_per, with_previous
from civiclake.operators.spatial import Layer, join_layers, polygon_parts
from civiclake.plans.classes import CLASS_DESCRIPTIONS

SHORTEST_HOLDING = 1.0 / 12  # fixed value: gaps under a month give no annual figure


def code_lookup(
    df: DataFrame, code: str, descriptions: dict[str, str], name: str
) -> DataFrame:
    """Add the description of a code, NULL when unknown. The code list is part of the program,
    so the small side of the join has a fixed size."""
    spark: SparkSession = df.sparkSession
    table = spark.createDataFrame(list(descriptions.items()), f"__code string, `{name}` string")
    return df.join(F.broadcast(table), F.col(code) == F.col("__code"), "left").drop("__code")


def same_or_null(a: ColumnLike, b: ColumnLike) -> Column:
    """True when equal, false when different, NULL when either is missing."""
    a, b = as_column(a), as_column(b)
    return F.when(a == b, True).when((a != b) & a.isNotNull() & b.isNotNull(), False)


def annualized_return(change: Column, before: Column, years: Column) -> Column:
    """Percent per year that turns the previous price into the current one over ``years``.

    NULL without a previous price, after a price of zero, or where the total loss makes the
    power undefined.
    """
    growth = 1 + change / F.nullif(before, F.lit(0.0))
    return (F.pow(growth, 1 / years) - 1) * 100


def sale_features(
    sales: DataFrame,
    entity: str = "pin",
    day: str = "sale_date",
    price: str = "sale_price",
    sale_id: str = "parcel_sale_id",
    also_previous: dict[str, str] | None = None,
    class_column: str | None = "class",
    hot_limit: int | None = None,
) -> DataFrame:
    """Previous sale of the same parcel, price change, years between, annualized return.

    Sales of one day are ordered by their id. All previous values share one window.
    """
    if also_previous is None:
        also_previous = {
            "last_sale_was_multisale": "is_multisale",
            "num_parcels_last_sale": "num_parcels_sale",
        }
    previous = {f"last_{day}": day, f"last_{price}": price, **also_previous}
    out = with_previous(sales, [entity], [day, sale_id], previous, hot_limit)
    if class_column is not None:
        out = code_lookup(out, class_column, CLASS_DESCRIPTIONS, "class_descr")
    change = F.col(price).cast("double") - F.col(f"last_{price}").cast("double")
    out = out.withColumns(
        {
            "price_change_since_last_sale": F.col(price) - F.col(f"last_{price}"),
            "years_since_last_sale": years_between(day, f"last_{day}"),
        }
    )
    years = F.col("years_since_last_sale")
    trimmed = F.when(years >= SHORTEST_HOLDING, years)
    return out.withColumn(
        "annualized_roi", annualized_return(change, F.col(f"last_{price}").cast("double"), trimmed)
    )


SALE_FEATURE_COLUMNS = [
    "parcel_sale_id",
    "pin",
    "class",
    "class_descr",
    "sale_price",
    "sale_date",
    "is_multisale",
    "num_parcels_sale",
    "last_sale_price",
    "last_sale_date",
    "last_sale_was_multisale",
    "num_parcels_last_sale",
    "price_change_since_last_sale",
    "years_since_last_sale",
    "annualized_roi",
]


def parcel_sales_feature(sales_clean: DataFrame) -> DataFrame:
    return sale_features(sales_clean).select(*SALE_FEATURE_COLUMNS)


def latest_buyer(sales: DataFrame, pin: str = "pin", day: str = "sale_date",
                 buyer: str = "sale_buyer_name", tie: str = "parcel_sale_id") -> DataFrame:
    """The buyer of each parcel's latest sale (an undated sale counts as latest)."""
    newest = latest_per(sales.select(pin, day, buyer, tie), [pin], [day, tie])
    return newest.select(pin, F.col(buyer).alias("owner_name"))


def parcel_locations_feature(
    locations_clean: DataFrame,
    sales_clean: DataFrame,
    districts_clean: DataFrame,
    beats_clean: DataFrame,
    areas_clean: DataFrame,
    city: str = "CHICAGO",
) -> DataFrame:
    """Neighbourhood code, owner occupancy, owner, and the police and community areas around.

    Parcels never sold have no owner and drop out, as in the marts built on this. Only parcels
    of ``city`` take part in the spatial joins; the others keep NULL areas.
    """
    parcels = locations_clean.select(
        "pin",
        "property_city",
        joined_skipping_nulls("township", "nbhd").alias("town_nbhd"),
        same_or_null("property_address", "mailing_address").alias("owner_occupied"),
        F.col("longitude").alias("__x"),
        F.col("latitude").alias("__y"),
        point("longitude", "latitude").alias("geometry"),
    )
    owned = parcels.join(latest_buyer(sales_clean), "pin", "inner")
    inside_city = F.col("property_city") == city
    located = owned.withColumns(
        {c: F.when(inside_city, F.col(c)) for c in ("__x", "__y")}
    )
    layers = [
        Layer(districts_clean, {"dist_num": "cpd_district"}),
        Layer(beats_clean, {"beat_num": "cpd_beat"}),
        Layer(areas_clean, {"community": "chicago_community"}),
    ]
    located = join_layers(located, layers, "__x", "__y")
    return located.select(
        "pin",
        "town_nbhd",
        "owner_occupied",
        "owner_name",
        "cpd_beat",
        "cpd_district",
        "chicago_community",
        "geometry",
    )


LOCATION_DIM_COLUMNS = [
    "pin",
    "town_nbhd",
    "property_address",
    "property_apt_no",
    "property_city",
    "property_zip",
    "owner_occupied",
    "owner_name",
    "cpd_beat",
    "cpd_district",
    "chicago_community",
    "nbhd",
    "township",
    "township_name",
    "municipality",
    "municipality_fips",
    "ward",
    "tract_geoid",
    "ohare_noise",
    "floodplain",
    "fs_flood_factor",
    "fs_flood_risk_direction",
    "withinmr100",
    "withinmr101300",
    "longitude",
    "latitude",
    "geometry",
]


def _columns_of(df: DataFrame, wanted: list[str], *, but: tuple[str, ...] = ()) -> list[str]:
    return [c for c in wanted if c in df.columns and c not in but]


def parcel_locations_dim(locations_clean: DataFrame, locations_feature: DataFrame) -> DataFrame:
    ours = _columns_of(locations_feature, LOCATION_DIM_COLUMNS)
    theirs = _columns_of(locations_clean, LOCATION_DIM_COLUMNS, but=tuple(ours[1:]))
    joined = locations_clean.select(*theirs).join(locations_feature.select(*ours), "pin", "inner")
    return joined.select(*LOCATION_DIM_COLUMNS)


def parcel_owner_fact(locations_clean: DataFrame, locations_feature: DataFrame) -> DataFrame:
    mail = locations_clean.select(
        "pin", "mailing_address", "mailing_city", "mailing_zip", "mailing_state"
    )
    return locations_feature.select("pin", "owner_occupied").join(mail, "pin", "inner")


SALE_DETAIL_COLUMNS = [
    "sale_document_num",
    "is_mydec_date",
    "sale_deed_type",
    "sale_type",
    "township_code",
    "sale_seller_name",
    "sale_buyer_name",
    "source_data_updated",
    "ingestion_check_time",
]


def full_join_keeping_left_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join; rows found only on the right carry NULL in the key column."""
    other = right.withColumnRenamed(key, "__right_key")
    return left.join(other, F.col(key) == F.col("__right_key"), "full").drop("__right_key")


def parcel_sales_fact(sales_feature: DataFrame, sales_clean: DataFrame) -> DataFrame:
    details = sales_clean.select("parcel_sale_id", *SALE_DETAIL_COLUMNS)
    joined = full_join_keeping_left_key(sales_feature, details, "parcel_sale_id")
    features = [c for c in SALE_FEATURE_COLUMNS if c not in ("parcel_sale_id", "pin")]
    return joined.select(
        "parcel_sale_id", "pin", "sale_document_num", *features, *SALE_DETAIL_COLUMNS[1:]
    )


ASSESSED = [
    f"{stage}_{part}"
    for stage in ("mailed", "certified", "board")
    for part in ("bldg", "land", "tot")
]


def parcel_value_assessments_fact(assessments_clean: DataFrame) -> DataFrame:
    """Assessed values with their change since the parcel's assessment before."""
    order = ["tax_year", "parcel_assessment_id"]
    out = with_previous(
        assessments_clean,
        ["pin"],
        order,
        {"class_last_assessment": "class", **{f"__last_{c}": c for c in ASSESSED}},
    )
    return out.select(
        "parcel_assessment_id",
        "pin",
        year_start("tax_year").alias("tax_year"),
        "class",
        "class_last_assessment",
        "township_code",
        "township_name",
        *ASSESSED,
        *[(F.col(c) - F.col(f"__last_{c}")).alias(f"{c}_change") for c in ASSESSED],
    )


MART_PARCEL_COLUMNS = [
    "pin",
    "chicago_community",
    "cpd_beat",
    "cpd_district",
    "property_address",
    "ward",
    "tract_geoid",
    "ohare_noise",
    "floodplain",
    "fs_flood_factor",
    "fs_flood_risk_direction",
    "withinmr100",
    "withinmr101300",
]
MART_SALE_COLUMNS = [
    "parcel_sale_id",
    "class",
    "class_descr",
    "is_multisale",
    "num_parcels_sale",
    "sale_price",
    "sale_date",
    "last_sale_price",
    "last_sale_date",
    "price_change_since_last_sale",
    "years_since_last_sale",
    "last_sale_was_multisale",
    "num_parcels_last_sale",
    "sale_document_num",
    "is_mydec_date",
    "sale_deed_type",
    "sale_type",
    "township_code",
    "sale_seller_name",
    "sale_buyer_name",
]


def boundary_texts(areas: DataFrame, area: str = "community", dissolve: bool = False) -> DataFrame:
    """One boundary text per part of each area: an area of k parts multiplies the rows it is
    joined to by k. ``dissolve`` gives one row per area with all its parts in a list instead."""
    parts = polygon_parts(areas.select(area, "geometry_parts"), "geometry_parts")
    texts = parts.select(area, feature_json("part").alias("chi_nbhd_boundary"))
    if not dissolve:
        return texts
    whole = areas.select(area, F.transform("geometry_parts", feature_json).alias("__parts"))
    joined = F.concat(F.lit("["), F.array_join("__parts", ", "), F.lit("]"))
    return whole.select(area, joined.alias("chi_nbhd_boundary"))


def chicago_parcel_sales_mart(
    locations_dim: DataFrame, sales_fact: DataFrame, areas_clean: DataFrame, dissolve: bool = False
) -> DataFrame:
    """Every sale of a parcel inside a community area with the parcel's attributes and the area's
    boundary text."""
    parcels = locations_dim.select(*MART_PARCEL_COLUMNS).where(
        F.col("chicago_community").isNotNull()
    )
    # the long texts are joined last, so they never take part in the shuffle on pin
    sold = parcels.join(sales_fact.select("pin", *MART_SALE_COLUMNS), "pin", "inner")
    texts = boundary_texts(areas_clean, dissolve=dissolve).withColumnRenamed("community", "__area")
    return sold.join(texts, F.col("chicago_community") == F.col("__area"), "left").drop("__area")
