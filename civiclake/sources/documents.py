"""Reshaping landed JSON and HTML documents, many at a time, into rows.

Every function takes a DataFrame with the document text in one column and keeps the other
columns, so a folder of documents is one distributed scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: fields of a published data catalog and the columns they become
CATALOG_TOP = {
    "@context": "metadata_context",
    "@id": "metadata_catalog_id",
    "@type": "metadata_type",
    "conformsTo": "conforms_to_schema",
    "describedBy": "data_schema_dictionary",
}
CATALOG_DATASET = {
    "identifier": "identifier",
    "title": "title",
    "description": "description",
    "modified": "modified",
    "c_vintage": "vintage",
    "c_geographyLink": "geography_link",
    "c_variablesLink": "variables_link",
    "c_tagsLink": "tags_link",
    "c_examplesLink": "examples_link",
    "c_groupsLink": "groups_link",
    "c_sorts_url": "sorts_url",
    "c_dataset": "dataset",
    "spatial": "spatial",
    "temporal": "temporal",
    "bureauCode": "bureau_code",
    "programCode": "program_code",
    "keyword": "keyword",
    "c_isMicrodata": "is_microdata",
    "c_isAggregate": "is_aggregate",
    "c_isCube": "is_cube",
    "c_isAvailable": "is_available",
    "c_isTimeseries": "is_timeseries",
    "accessLevel": "access_level",
    "license": "license",
    "@type": "dataset_type",
    "references": "reference_docs",
    "c_documentationLink": "documentation_link",
}
CATALOG_DISTRIBUTION = {
    "accessURL": "dataset_base_url",
    "@type": "distribution_type",
    "mediaType": "distribution_media_type",
    "description": "distribution_description",
    "format": "distribution_format",
    "title": "distribution_title",
}
CATALOG_NESTED = {
    "contactPoint.fn": "contact_point_fn",
    "contactPoint.hasEmail": "contact_point_email",
    "publisher.name": "publisher_name",
    "publisher.@type": "publisher_type",
    "publisher.subOrganizationOf.@type": "publisher_suborg_of_type",
    "publisher.subOrganizationOf.name": "publisher_suborg_of_name",
    "publisher.subOrganizationOf.subOrganizationOf.@type": "publisher_suborg_of_suborg_of_type",
    "publisher.subOrganizationOf.subOrganizationOf.name": "publisher_suborg_of_suborg_of_name",
}
CATALOG_LISTS = ("c_dataset", "bureauCode", "programCode", "keyword", "references")
CATALOG_FLAGS = ("is_microdata", "is_aggregate", "is_cube", "is_available", "is_timeseries")
# fixed values: fields of published variable documents and the columns they become
VARIABLE_FIELDS = {
    "label": "label",
    "concept": "concept",
    "predicateType": "predicate_type",
    "group": "dataset_group",
    "limit": "limit_call",
    "predicateOnly": "predicate_only",
    "hasGeoCollectionSupport": "has_geo_collection_support",
    "attributes": "attributes",
    "required": "required",
    "values": "values",
    "datetime": "datetime",
    "is-weight": "is_weight",
    "suggested-weight": "suggested_weight",
}
VARIABLE_FLAGS = ("predicate_only", "has_geo_collection_support", "is_weight")
# fixed values: fields of published geography documents and the columns they become
GEOGRAPHY_FIELDS = {
    "name": "name",
    "geoLevelDisplay": "geo_level",
    "referenceDate": "reference_date",
    "requires": "requires",
    "wildcard": "wildcard",
    "optionalWithWCFor": "optional_with_wildcard_for",
}
# fixed values: fields of published group documents and the columns they become
GROUP_FIELDS = {
    "name": "group_name",
    "description": "group_description",
    "variables": "group_variables",
    "universe": "universe",
}
# fixed values: what stands for a document without groups or tags
NO_GROUPS, NO_TAGS = "no_groups", "no_tags"


def _field(path: Column, dotted: str) -> Column:
    for name in dotted.split("."):
        path = path.getField(name)
    return path


def _catalog_schema() -> str:
    def org(inner: str) -> str:
        return f"struct<name:string,`@type`:string{inner}>"

    publisher = org(f",subOrganizationOf:{org(',subOrganizationOf:' + org(''))}")
    dataset = [
        f"`{f}`:{'array<string>' if f in CATALOG_LISTS else 'int' if f == 'c_vintage' else 'boolean' if f.startswith('c_is') else 'string'}"
        for f in CATALOG_DATASET
    ]
    spots = ",".join(f"`{f}`:string" for f in CATALOG_DISTRIBUTION)
    dataset += [
        f"distribution:array<struct<{spots}>>",
        "contactPoint:struct<fn:string,hasEmail:string>",
        f"publisher:{publisher}",
    ]
    top = [f"`{f}`:string" for f in CATALOG_TOP]
    return f"struct<{','.join(top)},dataset:array<struct<{','.join(dataset)}>>>"


def catalog_datasets(docs: DataFrame, doc: str, newest_first: bool = False) -> DataFrame:
    """One row per dataset of each data catalog, first distribution and catalog fields attached."""
    parsed = docs.withColumn("__doc", F.from_json(doc, _catalog_schema()))
    rows = parsed.withColumn("__d", F.explode("__doc.dataset"))
    d, first = F.col("__d"), F.get(F.col("__d.distribution"), 0)
    out = {n: first.getField(f) for f, n in CATALOG_DISTRIBUTION.items()}
    out |= {n: d.getField(f) for f, n in CATALOG_DATASET.items()}
    out |= {n: _field(d, f) for f, n in CATALOG_NESTED.items()}
    out |= {n: F.col("__doc").getField(f) for f, n in CATALOG_TOP.items()}
    out["distribution"] = F.to_json(d.getField("distribution"))
    out["modified"] = F.to_timestamp(out["modified"])
    out |= {n: F.coalesce(out[n], F.lit(False)) for n in CATALOG_FLAGS}
    kept = [c for c in docs.columns if c != doc]
    flat = rows.select(*kept, *[c.alias(n) for n, c in out.items()])
    return flat.orderBy(F.col("modified").desc_nulls_last()) if newest_first else flat


def table_rows(docs: DataFrame, doc: str, columns: list[str] | None = None) -> DataFrame:
    """Array-of-arrays documents: the first inner array names the columns, the others are rows.

    Values are matched by name, so documents may order their columns differently. ``columns``
    defaults to those of all documents, by their first place in a header, then by name.
    """
    parsed = docs.withColumn("__rows", F.from_json(doc, "array<array<string>>"))
    if columns is None:
        heads = parsed.where(F.size("__rows") > 0).select(F.posexplode(F.get("__rows", 0)).alias("at", "name"))
        places = heads.groupBy("name").agg(F.min("at").alias("at"))  # one row per column name
        columns = [r.name for r in places.where("name IS NOT NULL").orderBy("at", "name").collect()]
    kept = [c for c in docs.columns if c != doc]
    body = F.slice("__rows", 2, F.greatest(F.size("__rows") - 1, F.lit(0)))
    rows = parsed.select(*kept, F.get("__rows", 0).alias("__head"), F.explode(body).alias("__row"))
    named = F.map_from_arrays("__head", "__row")
    return rows.withColumn("__named", named).select(
        *kept, *[F.get(F.array(F.col("__named")[c]), 0).alias(c) for c in columns]
    )


def variable_rows(docs: DataFrame, doc: str) -> DataFrame:
    """{"variables": {name: {...}}} documents: one row per variable, missing flags false."""
    types = {"limit": "bigint", "predicateOnly": "boolean", "is-weight": "boolean"}
    types |= {"hasGeoCollectionSupport": "boolean"}
    fields = ",".join(f"`{f}`:{types.get(f, 'string')}" for f in VARIABLE_FIELDS)
    parsed = F.from_json(doc, f"struct<variables:map<string,struct<{fields}>>>")
    kept = [c for c in docs.columns if c != doc]
    rows = docs.select(*kept, F.explode(parsed.getField("variables")).alias("variable", "__v"))
    out = {n: F.col("__v").getField(f) for f, n in VARIABLE_FIELDS.items()}
    out |= {n: F.coalesce(out[n], F.lit(False)) for n in VARIABLE_FLAGS}
    return rows.select(*kept, "variable", *[c.alias(n) for n, c in out.items()])


def geography_rows(docs: DataFrame, doc: str) -> DataFrame:
    """{"fips": [...]} documents: one row per geography level; a missing list is an empty one."""
    lists = ("requires", "wildcard")
    fields = ",".join(
        f"`{f}`:{'array<string>' if f in lists else 'string'}" for f in GEOGRAPHY_FIELDS
    )
    parsed = F.from_json(doc, f"struct<fips:array<struct<{fields}>>>")
    kept = [c for c in docs.columns if c != doc]
    rows = docs.select(*kept, F.explode(parsed.getField("fips")).alias("__g"))
    out = {n: F.col("__g").getField(f) for f, n in GEOGRAPHY_FIELDS.items()}
    out |= {n: F.coalesce(out[n], F.array().cast("array<string>")) for n in lists}
    return rows.select(*kept, *[c.alias(n) for n, c in out.items()])


def group_rows(docs: DataFrame, doc: str) -> DataFrame:
    """{"groups": [...]} documents; a document without groups gives one row of a fixed word."""
    # published documents write the last key with a trailing space at times
    fields = ",".join(f"`{f}`:string" for f in [*GROUP_FIELDS, "universe "])
    parsed = F.from_json(doc, f"struct<groups:array<struct<{fields}>>>")
    kept = [c for c in docs.columns if c != doc]
    rows = docs.select(*kept, F.explode_outer(parsed.getField("groups")).alias("__g"))
    g = F.col("__g")
    out = {n: g.getField(f) for f, n in GROUP_FIELDS.items()}
    out["universe"] = F.coalesce(out["universe"], g.getField("universe "))
    return rows.select(
        *kept, *[F.when(g.isNull(), NO_GROUPS).otherwise(c).alias(n) for n, c in out.items()]
    )


def tag_rows(docs: DataFrame, doc: str) -> DataFrame:
    """{"tags": [...]} documents; a document without tags gives one row of a fixed word."""
    parsed = F.from_json(doc, "struct<tags:array<string>>")
    kept = [c for c in docs.columns if c != doc]
    rows = docs.select(*kept, F.explode_outer(parsed.getField("tags")).alias("tag_name"))
    return rows.withColumn("tag_name", F.coalesce("tag_name", F.lit(NO_TAGS)))


# fixed values: the entities directory pages use
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def _up_to(tag: str) -> str:
    """Pattern for everything before a closing tag, without backtracking."""
    return rf"[^<]*+(?:<(?!{tag}>)[^<]*+)*+"


def _plain_text(cell: Column) -> Column:
    """Text of a table cell; the costly steps run only where there is something to do."""
    bare = F.regexp_replace(cell, r"<[^>]*>", "")
    decoded = bare
    for entity, char in ENTITIES.items():
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    text = F.when(F.contains(cell, F.lit("&")), decoded).otherwise(
        F.when(F.contains(cell, F.lit("<")), bare).otherwise(cell)
    )
    return F.btrim(text, F.lit(" \t\r\n\u00a0"))


def listing_rows(pages: DataFrame, html: str, url: str) -> DataFrame:
    """Directory-listing pages: one row per listed file or folder (the parent link is dropped)."""
    kept = [c for c in pages.columns if c not in (html, url)]
    listed_on = F.lower(F.col(html)).contains("<table")
    # from the first table on, up to its end
    table = F.regexp_extract(F.col(html), rf"(?i)<table\b{_up_to('/table')}", 0)
    trs = F.split(table, r"(?i)<tr\b[^>]*>")
    # no filter of its own, which would have the page worked out once for the filter and once for its rows
    rows = pages.select(
        *kept, F.col(url).alias("__url"), F.explode(F.when(listed_on, trs)).alias("__tr")
    )
    cells = F.regexp_extract_all("__tr", F.lit(rf"(?i)<td\b[^>]*>({_up_to('/td')})"), 1)
    # no or one array per table row, so header rows vanish without a second look at the text
    some = F.when(F.lower("__tr").contains("<td"), F.array(cells))
    rows = rows.select(*kept, "__url", F.explode(some).alias("__cells"))
    # the texts as one struct, worked out once; a lambda over the cells would not be compiled
    texts = F.struct(
        *[
            _plain_text(F.get("__cells", i)).alias(n)
            for i, n in enumerate(("name", "last_modified", "size", "description"), 1)
        ]
    )
    rows = rows.select(*kept, "__url", F.explode(F.array(texts)).alias("__c"))
    name = F.col("__c.name")
    base = F.rtrim(F.trim("__url"), F.lit("/"))
    listed = rows.select(
        *kept,
        name.alias("name"),
        F.try_to_timestamp("__c.last_modified", F.lit("yyyy-MM-dd HH:mm")).alias("last_modified"),
        F.col("__c.size").alias("size"),
        F.col("__c.description").alias("description"),
        name.endswith("/").alias("is_dir"),
        F.when(name.endswith("/"), F.substring(name, F.lit(1), F.length(name) - 1))
        .otherwise(name)
        .alias("clean_name"),
        base.alias("__base"),
    )
    is_file = ~F.col("is_dir") & (F.col("clean_name") != "Parent Directory")
    return (
        listed.withColumn("is_file", is_file)
        .where(F.col("is_file") | F.col("is_dir"))
        .withColumn("metadata_url", F.concat_ws("/", "__base", "clean_name"))
        .drop("__base")
    )


def geography_pattern(
    listing: DataFrame, states: str | list[str] | None = None, county: str | None = None
) -> str:
    """The part of a file name that picks a geography, from the naming a listing uses."""
    name = F.col("name")
    us, by_county, by_state = listing.agg(
        F.count_if(name.rlike(r"_\d{4}_us_")),
        F.count_if(name.rlike(r"_\d{4}_\d{5}_")),
        F.count_if(name.rlike(r"_\d{4}_\d{2}_")),
    ).first()
    if us == 1:
        return "_us_"
    if states is None:
        raise ValueError("this listing is split by state: say which")
    if isinstance(states, list):
        return "_" + "*_|_".join(states) + "*_"
    if by_county > 0 and by_state == 0:
        return f"_{states}{county}_"
    return f"_{states}_"


def chosen_files(listing: DataFrame, pattern: str) -> DataFrame:
    return listing.where(F.col("name").rlike(pattern))
