"""JSON as published: arrays of objects, GeoJSON, data packages, datastore pages and package listings.

The operators work on rows (file, body), one for each document, so that they
apply to files and to captured bodies alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import decode_bytes, first_text

TEXT_LIST = "array<string>"


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """(file, body) of whole files; bytes that are no UTF-8 are read as Windows-1252."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), decode_bytes(F.col("content")).alias("body"))


def json_objects(bodies: DataFrame) -> DataFrame:
    """(file, position, object) of documents that are an array of objects or one object; JSON Lines and other documents are an error."""
    whole = F.trim("body")
    listed = F.when(whole.startswith("["), whole).when(whole.startswith("{"), F.concat(F.lit("["), whole, F.lit("]")))
    items = F.try_parse_json(listed)
    checked = F.coalesce(items, F.raise_error(F.concat(F.col("file"), F.lit(" is no JSON document"))).cast("variant"))
    rows = bodies.select("file", F.expr("1").alias("one"), checked.alias("v")).select("file", F.to_json("v").alias("text"))
    return rows.select("file", F.posexplode(F.from_json("text", TEXT_LIST)).alias("position", "object"))


def object_schema(objects: Column, df: DataFrame) -> T.StructType:
    """Common schema of JSON objects over all rows; fields of mixed kinds and fields that are always null are text."""
    from ..operators.schema import _rebuilt

    found = df.agg(F.schema_of_variant_agg(F.parse_json(objects))).first()[0]
    kind = T._parse_datatype_string(found.replace("OBJECT<", "STRUCT<"))
    fix = lambda k: T.StringType() if isinstance(k, (T.NullType, T.VariantType)) else T.DoubleType() if isinstance(k, T.DecimalType) else k
    return _rebuilt(kind, list, fix)


def scan_json(bodies: DataFrame) -> DataFrame:
    """One row an object, with inferred columns; no object at all is an error."""
    rows = json_objects(bodies)
    if rows.isEmpty():
        raise ValueError("the documents have no rows")
    schema = object_schema(F.col("object"), rows)
    return rows.select(F.from_json("object", schema).alias("row")).select("row.*")


def scan_geojson(bodies: DataFrame) -> DataFrame:
    """One row a feature: its properties, its geometry as GeoJSON text, and the geometry's type.

    A feature without properties has null ones; a property named geometry is an error.
    """
    features = bodies.select("file", F.posexplode(F.from_json(F.get_json_object("body", "$.features"), TEXT_LIST)).alias("position", "feature"))
    parts = features.select("file", "position", F.get_json_object("feature", "$.properties").alias("properties"), F.get_json_object("feature", "$.geometry").alias("geometry"))
    schema = object_schema(F.coalesce("properties", F.lit("{}")), parts)
    if any(f.name.lower() == "geometry" for f in schema.fields):
        raise ValueError("a property is named geometry")
    kind = F.get_json_object("geometry", "$.type")
    return parts.select(F.from_json("properties", schema).alias("p"), "geometry", kind.alias("geometry_type")).select("p.*", "geometry", "geometry_type")


PACKAGE_TEXTS = ("name", "title", "description", "path", "url", "format", "mediatype", "encoding", "hash", "profile", "schema", "created", "modified")


def package_resource(r: Column) -> dict[str, Column]:
    """Columns of a data package's resource, given as JSON text."""
    texts = {c: F.get_json_object(r, f"$.{c}") for c in PACKAGE_TEXTS}
    sources = F.from_json(F.get_json_object(r, "$.sources"), "array<struct<title:string,path:string,email:string>>")
    licenses = F.from_json(F.get_json_object(r, "$.licenses"), "array<struct<name:string,path:string,title:string>>")
    return {**texts, "sources": sources, "licenses": licenses, "bytes": F.get_json_object(r, "$.bytes").try_cast("long")}


def scan_datapackage(bodies: DataFrame, package_id: str) -> DataFrame:
    """One row a resource of data packages: text fields (other values as JSON), sources, licenses, bytes and package_id.

    The file must be named datapackage.json and list resources.
    """
    named = F.when(F.col("file").rlike(r"(^|/)datapackage\.json$"), F.col("body")).otherwise(F.raise_error(F.concat(F.col("file"), F.lit(" is no datapackage.json"))))
    listed = F.get_json_object(named, "$.resources")
    checked = F.when(F.coalesce(F.json_array_length(listed), F.lit(0)) > 0, listed).otherwise(F.raise_error(F.lit("the package has no resources")))
    rows = bodies.select(F.posexplode(F.from_json(checked, TEXT_LIST)).alias("position", "r"))
    return rows.select(*[c.alias(name) for name, c in package_resource(F.col("r")).items()], F.lit(package_id).alias("package_id"))


def scan_datastore_pages(pages: DataFrame) -> DataFrame:
    """Rows of datastore pages (start, body), all as text, in the columns of the page with the smallest start.

    A null or missing cell is an empty text.  Pages from the first empty one on
    don't count.
    """
    parsed = pages.select("start", F.from_json(F.get_json_object("body", "$.fields"), "array<struct<id:string>>").alias("fields"), F.from_json(F.get_json_object("body", "$.records"), "array<array<string>>").alias("records"))
    first = parsed.orderBy("start").select("fields").first()
    if first is None:
        raise ValueError("there are no pages")
    names = [f["id"] for f in first["fields"]]
    stop = parsed.filter(F.size("records") == 0).agg(F.min("start")).first()[0]
    live = parsed if stop is None else parsed.filter(F.col("start") < stop)
    rows = live.select("start", F.posexplode("records").alias("i", "r"))
    return rows.select(*[F.coalesce(F.get("r", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])


# The fields of a portal's packages, resources and what they hold.
EXTRA = "key:string,value:string"
GROUP = "description:string,display_name:string,id:string,image_display_url:string,name:string,title:string"
ORGANIZATION = "id:string,name:string,title:string,type:string,description:string,image_url:string,created:string,is_organization:boolean,approval_status:string,state:string"
TAG = "display_name:string,id:string,name:string,state:string,vocabulary_id:string"
PACKAGE = (
    "author:string,author_email:string,creator_user_id:string,id:string,isopen:boolean,license_id:string,license_title:string,license_url:string,maintainer:string,maintainer_email:string,"
    "metadata_created:string,metadata_modified:string,name:string,notes:string,num_resources:bigint,num_tags:bigint,owner_org:string,private:boolean,state:string,title:string,type:string,url:string,version:string,"
    f"extras:array<struct<{EXTRA}>>,groups:array<struct<{GROUP}>>,organization:struct<{ORGANIZATION}>,tags:array<struct<{TAG}>>"
)
RESOURCE = (
    "cache_last_updated:string,cache_url:string,ckan_url:string,created:string,datastore_active:boolean,datastore_contains_all_records_of_source_file:boolean,description:string,format:string,hash:string,id:string,"
    "ignore_hash:boolean,key:string,last_modified:string,metadata_modified:string,mimetype:string,mimetype_inner:string,name:string,original_url:string,package_id:string,position:bigint,resource_id:string,"
    "resource_type:string,set_url_type:boolean,size:bigint,state:string,task_created:string,title:string,tries:string,url:string,url_type:string"
)


def _known_only(c: Column, schema: T.StructType, what: str) -> Column:
    """A JSON object as a struct; a field that the schema doesn't have is an error."""
    extra = F.array_except(F.json_object_keys(c), F.array(*[F.lit(f.name) for f in schema.fields]))
    return F.when(F.size(extra) > 0, F.raise_error(F.concat(F.lit(f"unknown fields of a {what}: "), F.array_join(extra, ", "))).cast(schema)).otherwise(F.from_json(c, schema))


def scan_packages(pages: DataFrame, portal_url: str) -> tuple[DataFrame, DataFrame]:
    """(packages, resources) of listing pages (start, body), each an array of packages; unknown fields of either and no package at all are errors."""
    package, resource = (T._parse_datatype_string(f"struct<{x}>") for x in (f"{PACKAGE},resources:string", RESOURCE))
    rows = pages.select(F.explode(F.from_json("body", TEXT_LIST)).alias("p"))
    if rows.isEmpty():
        raise ValueError("the listing has no packages")
    parsed = rows.select(_known_only(F.col("p"), package, "package").alias("p"), F.from_json(F.get_json_object("p", "$.resources"), TEXT_LIST).alias("rs")).select("p.*", "rs").drop("resources")
    resources = parsed.select(F.col("id").alias("parent"), F.explode("rs").alias("r")).select(_known_only(F.col("r"), resource, "resource").alias("r"), "parent").select("r.*", "parent")
    return parsed.drop("rs"), resources.withColumn("package_id", F.coalesce("package_id", "parent")).drop("parent").withColumn("ckan_url", F.lit(portal_url))


def discover_resources(packages: DataFrame, resources: DataFrame, source: str, portal_url: str) -> DataFrame:
    """Catalogue rows: a collection for each package, a file or (with an active datastore) an endpoint for each resource.

    The version is the first of last_modified, metadata_modified and the
    package's; the title falls back to the name and the id; formats are in upper case.
    """
    from ..functions.scalars import dataset_url, resource_url

    base = F.lit(portal_url)
    top = packages.select(F.lit(source).alias("source_id"), "id", F.lit(None).cast("string").alias("parent_id"), F.lit("collection").alias("kind"), first_text(F.col("title"), F.col("name"), F.col("id")).alias("title"), F.col("metadata_modified").alias("version"), F.lit(None).cast("string").alias("format"), dataset_url(base, F.col("name")).alias("page_url"), F.lit(None).cast("string").alias("content_url"))
    parents = packages.select(F.col("id").alias("package_id"), F.col("name").alias("package"), F.col("metadata_modified").alias("package_modified"))
    low = resources.join(parents, "package_id").select(
        F.lit(source).alias("source_id"),
        "id",
        F.col("package_id").alias("parent_id"),
        F.when(F.col("datastore_active"), "endpoint").otherwise("file").alias("kind"),
        first_text(F.col("name"), F.col("id")).alias("title"),
        first_text(F.col("last_modified"), F.col("metadata_modified"), F.col("package_modified")).alias("version"),
        F.upper("format").alias("format"),
        resource_url(base, F.col("package"), F.col("id")).alias("page_url"),
        F.col("url").alias("content_url"),
    )
    return top.unionByName(low)
