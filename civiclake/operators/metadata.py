"""Facts about source tables, from their landed metadata documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.functions.dates import published_timestamp

# fixed values: column types that make a table geospatial
GEO_DATATYPES = (
    "Line",
    "Location",
    "MultiLine",
    "MultiPoint",
    "MultiPolygon",
    "Point",
    "Polygon",
)
# fixed values: accepted download formats, and how each is written in a download address
DOWNLOAD_FORMATS = {
    "csv": "csv",
    "tsv": "tsv",
    "shp": "Shapefile",
    "shapefile": "Shapefile",
    "geojson": "GeoJSON",
    "kmz": "KMZ",
    "kml": "KML",
}
METADATA_TYPE = (
    "struct<_id:string,time_of_collection:string,"
    "resource:struct<name:string,metadata_updated_at:string,data_updated_at:string,"
    "columns_name:array<string>,columns_field_name:array<string>,"
    "columns_datatype:array<string>,columns_description:array<string>,"
    "lens_view_type:string,lens_display_type:string>,"
    "classification:struct<domain_metadata:array<struct<key:string,value:string>>>,"
    "metadata:struct<domain:string>>"
)


def parsed_metadata(docs: DataFrame, doc: str = "metadata_json") -> DataFrame:
    return docs.withColumn("meta", F.from_json(doc, METADATA_TYPE))


def is_geospatial(meta: Column) -> Column:
    """A geospatial column, or no columns at all behind a geo view or a map."""
    r = meta.resource
    typed = F.arrays_overlap(r.columns_datatype, F.array(*[F.lit(g) for g in GEO_DATATYPES]))
    bare = F.coalesce(F.size(r.columns_name) <= 0, F.lit(True))
    shown = F.coalesce(r.lens_view_type == "geo", F.lit(False)) | F.coalesce(
        r.lens_display_type == "map", F.lit(False)
    )
    return F.coalesce(typed, F.lit(False)) | (bare & shown)


def has_geo_view(meta: Column) -> Column:
    return F.coalesce(meta.resource.lens_view_type == "geo", F.lit(False))


def has_map_display(meta: Column) -> Column:
    return F.coalesce(meta.resource.lens_display_type == "map", F.lit(False))


def has_data_columns(meta: Column) -> Column:
    return F.coalesce(F.size(meta.resource.columns_name) > 0, F.lit(False))


def download_format(geospatial: Column, requested: Column | None = None) -> Column:
    """The requested format as an address spells it; unsupported ones raise."""
    default = F.when(geospatial, "GeoJSON").otherwise("csv")
    if requested is None:
        return default
    known = F.create_map(*[F.lit(x) for kv in DOWNLOAD_FORMATS.items() for x in kv])
    found = F.try_element_at(known, F.lower(requested))
    bad = F.raise_error(F.concat(F.lit("unsupported download format "), requested))
    return F.when(requested.isNull(), default).otherwise(F.coalesce(found, bad.cast("string")))


def download_url(domain: Column, table_id: Column, geospatial: Column, fmt: Column) -> Column:
    gis = F.format_string(
        "https://%s/api/geospatial/%s?method=export&format=%s", domain, table_id, fmt
    )
    flat = F.format_string(
        "https://%s/api/views/%s/rows.%s?accessType=DOWNLOAD", domain, table_id, fmt
    )
    return F.when(geospatial, gis).otherwise(flat)


def domain_metadata(meta: Column) -> Column:
    """Key/value list to a map; the last value of a repeated key counts."""
    pairs = meta.classification.domain_metadata
    firsts = F.filter(
        pairs,
        lambda p, i: ~F.exists(
            F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q.key == p.key
        ),
    )
    return F.map_from_entries(firsts)


def table_name_from_title(title: Column) -> Column:
    """Words of a title, lower-cased and joined by '_'."""
    words = F.regexp_replace(F.lower(title), r"[^0-9a-z]+", " ")
    return F.replace(F.trim(words), F.lit(" "), F.lit("_"))


def check_records(docs: DataFrame, doc: str = "metadata_json", table_name: str | None = None):
    """One check record per landed metadata document, flags still open."""
    meta = F.col("meta")
    geo = is_geospatial(meta)
    fmt = download_format(geo)
    name = F.col(table_name) if table_name else table_name_from_title(meta.resource["name"])
    return parsed_metadata(docs, doc).select(
        meta["_id"].alias("table_id"),
        name.alias("table_name"),
        fmt.alias("download_format"),
        geo.alias("is_geospatial"),
        download_url(meta.metadata.domain, meta["_id"], geo, fmt).alias("data_download_url"),
        F.date_trunc("second", published_timestamp(meta.resource.data_updated_at)).alias(
            "source_data_last_updated"
        ),
        F.date_trunc("second", published_timestamp(meta.resource.metadata_updated_at)).alias(
            "source_metadata_last_updated"
        ),
        F.lit(None).cast("boolean").alias("updated_data_available"),
        F.lit(None).cast("boolean").alias("updated_metadata_available"),
        F.lit(None).cast("boolean").alias("data_pulled_this_check"),
        published_timestamp(meta.time_of_collection).alias("time_of_check"),
        F.col(doc).alias("metadata_json"),
    )


def stamped(rows: DataFrame, check: DataFrame, columns: list[str]) -> DataFrame:
    """Attach the one-row check record's columns to every metadata row; several records raise."""
    several = F.raise_error(F.lit("more than one check record to stamp rows with"))
    one = check.agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in columns]).where("__n > 0")
    picked = one.select(*[F.when(F.col("__n") == 1, F.col(c)).otherwise(several).alias(c) for c in columns])
    return rows.crossJoin(F.broadcast(picked))
