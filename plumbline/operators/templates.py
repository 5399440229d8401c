"""Template documents to relational rows, and the nine template summaries.

A template corpus is ``(template_id, template)``: one JSON document per row. A template too large for one document
may span several rows with the same ``template_id``, as linked templates do; an optional ``part`` column orders
them and only the first needs the ``parameters`` member.

Member lookup is inner: a resource without the member a summary looks into has no row there.

Resources come in two forms. Shredding gives ``properties`` as JSON text, which every query parses again.
``store_resources`` keeps them as VARIANT in shredded files, where a query reads just the members it names, as columns.
Elements of an array can't be read one by one from a VARIANT, so the activities of pipelines are a typed column beside
it. All operators take either form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, VariantType

from plumbline.functions.constants import KINDS, TYPE_PREFIX
from plumbline.functions.text import array_length, clean_name, cut_name, first_upper, replace_ci
from plumbline.session import SMALL_TASKS, settings

RESOURCES_DDL = (
    "resources ARRAY<STRUCT<name STRING, type STRING, apiVersion STRING, dependsOn ARRAY<STRING>, properties STRING>>"
)
# batchCount and isSequential are read as text: an odd value must not void the whole activity.
ACTIVITY_DDL = (
    "STRUCT<name STRING, type STRING, description STRING,"
    " dependsOn ARRAY<STRUCT<activity STRING, dependencyConditions ARRAY<STRING>>>,"
    " policy STRUCT<timeout STRING>, typeProperties STRUCT<isSequential STRING, batchCount STRING>>"
)


def kind_of(type_name: Column) -> Column:
    """Lower-case kind of the known resource types, null for any other type."""
    lowered = F.lower(type_name)
    known = [TYPE_PREFIX.lower() + k.lower() for k in KINDS]
    return F.when(lowered.isin(known), F.substring_index(lowered, "/", -1))


def unparsable_documents(templates: DataFrame) -> DataFrame:
    """Documents that are null or no JSON object, without their text."""
    parsed = F.from_json("template", "MAP<STRING, STRING>")
    return templates.filter(parsed.isNull()).drop("template")


def shred_resources(templates: DataFrame, strict: bool = True) -> DataFrame:
    """One row per element of ``resources``; ``properties`` stays JSON text.

    A malformed document fails the job. With ``strict`` off it has no rows; ``unparsable_documents`` names it.
    """
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    part = F.col("part") if "part" in templates.columns else F.lit(0).cast("bigint")
    rows = templates.select(
        "template_id",
        part.alias("part"),
        F.posexplode(F.from_json("template", RESOURCES_DDL, mode)["resources"]).alias("ordinal", "r"),
    )
    return rows.select(
        "template_id",
        "part",
        "ordinal",
        F.col("r.name").alias("name"),
        F.col("r.type").alias("type"),
        kind_of(F.col("r.type")).alias("kind"),
        F.col("r.apiVersion").try_cast("date").alias("apiVersion"),
        F.col("r.dependsOn").alias("dependsOn"),
        F.col("r.properties").alias("properties"),
    )


def resources_of_type(resources: DataFrame, *kinds: str) -> DataFrame:
    """Keep some kinds, ignoring case. The filter is pushed into a scan of stored resources."""
    return resources.filter(F.col("kind").isin([k.lower() for k in kinds]))


def is_stored(resources: DataFrame) -> bool:
    """Whether ``properties`` is a VARIANT, as ``store_resources`` writes it."""
    return isinstance(resources.schema["properties"].dataType, VariantType)


def with_variant(resources: DataFrame) -> DataFrame:
    """``properties`` as VARIANT, null where the JSON text is no object, and ``activities`` of pipelines as typed column."""
    activities = F.from_json("properties", f"activities ARRAY<{ACTIVITY_DDL}>")["activities"]
    variant = F.when(F.startswith(F.ltrim("properties"), F.lit("{")), F.try_parse_json("properties"))
    return resources.withColumns({"activities": F.when(F.col("kind") == "pipelines", activities), "properties": variant})


# VARIANT columns are written as the columns that their values turn out to have.
_SHREDDING = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


def store_resources(resources: DataFrame, path: str) -> DataFrame:
    """Write shredded resources with VARIANT properties and read them back.

    Rows are sorted by kind inside each task, so a filter on kind skips pages and row groups without a folder per kind,
    which would leave many small files, and values of one shape lie together. A VARIANT keeps the members of an object by
    name: where the text as it was written matters, read the shredded resources themselves. The sort holds the rows of a
    task, about thirty times what it reads, so tasks read little at a time and nothing is spilled.
    """
    spark = resources.sparkSession
    with settings(spark, _SHREDDING | SMALL_TASKS):
        with_variant(resources).sortWithinPartitions("kind").write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def with_properties(resources: DataFrame, ddl: str) -> DataFrame:
    """Replace the properties by a struct ``p`` holding just the declared members; ``p`` is null without properties."""
    if not is_stored(resources):
        return resources.withColumn("p", F.from_json("properties", ddl)).drop("properties")
    members = []
    for member in StructType.fromDDL(ddl):
        if member.name == "activities":
            value = F.col("activities")
        else:
            value = F.try_variant_get("properties", F.lit(f"$.{member.name}"), member.dataType.simpleString())
        members.append(value.alias(member.name))
    return resources.withColumn("p", F.when(F.col("properties").isNotNull(), F.struct(*members))).drop("properties", "activities")


def properties_text(resources: DataFrame) -> Column:
    """Properties as JSON text."""
    return F.to_json("properties") if is_stored(resources) else F.col("properties")


def shred_activities(resources: DataFrame) -> DataFrame:
    """One row per top-level activity of a pipeline; activities nested in containers are not visited."""
    pipelines = with_properties(resources_of_type(resources, "pipelines"), f"activities ARRAY<{ACTIVITY_DDL}>")
    rows = pipelines.select(
        "template_id", F.col("name").alias("resource_name"), F.posexplode("p.activities").alias("position", "a")
    )
    return rows.select(
        "template_id",
        cut_name("resource_name").alias("BelongsToPipeline"),
        clean_name("resource_name").alias("PipelineName"),
        "position",
        F.col("a.name").alias("name"),
        F.col("a.type").alias("type"),
        F.col("a.description").alias("description"),
        F.col("a.dependsOn").alias("dependsOn"),
        F.col("a.policy").alias("policy"),
        F.struct(
            F.col("a.typeProperties.isSequential").try_cast("boolean").alias("isSequential"),
            F.col("a.typeProperties.batchCount").try_cast("int").alias("batchCount"),
        ).alias("typeProperties"),
    )


def t_factory_name(templates: DataFrame) -> DataFrame:
    ddl = "parameters STRUCT<factoryName STRUCT<type STRING, metadata STRING, defaultValue STRING>>"
    factory = F.from_json("template", ddl)["parameters"]["factoryName"]
    return (
        templates.select("template_id", factory.alias("factory"))
        .filter(F.col("factory").isNotNull())
        .select("template_id", F.col("factory.defaultValue").alias("DataFactoryName"))
    )


def t_component_summary(resources: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """Resources by type plus the number of activities, per template.

    The activity row is there even at 0. A template without any resource is invisible in ``resources``; pass
    ``templates`` too to give it its activity row. One wide aggregate with map-side combine does the work; what
    follows sees one row per template and type.
    """
    named = F.filter("p.activities", lambda a: a["name"].isNotNull())
    activities = F.when(F.col("kind") == "pipelines", array_length(named)).otherwise(0)
    counts = with_properties(resources, "activities ARRAY<STRUCT<name STRING>>").groupBy("template_id", "type").agg(
        F.count("*").alias("n"), F.sum(activities.cast("bigint")).alias("activities")
    )
    label = first_upper(replace_ci("type", TYPE_PREFIX, ""))
    # Rows per type are components, the second element sums to the activity row.

    def entry(activity: bool, name: Column, count: str) -> Column:
        return F.struct(F.lit(activity).alias("activity"), name.alias("ComponentType"), F.col(count).alias("Count"))

    entries = F.array(entry(False, label, "n"), entry(True, F.lit("Activities"), "activities"))
    rows = counts.select("template_id", F.inline(entries))
    if templates is not None:
        rows = rows.unionByName(
            templates.select(
                "template_id",
                F.lit(True).alias("activity"),
                F.lit("Activities").alias("ComponentType"),
                F.lit(0).cast("bigint").alias("Count"),
            )
        )
    # Types that differ only in case are one group; any spelling of the type may name it.
    folded = rows.groupBy("template_id", "activity", F.lower("ComponentType").alias("k")).agg(
        F.min("ComponentType").alias("ComponentType"), F.sum("Count").alias("Count")
    )
    return folded.select("template_id", "ComponentType", "Count").distinct()


def t_pipeline_info(resources: DataFrame) -> DataFrame:
    """Activity count per pipeline; pipelines without a folder or without activities are absent.

    Activities are counted inside their pipeline row, so only one narrow row per pipeline is shuffled. Grouping
    ignores case.
    """
    ddl = "description STRING, folder STRUCT<name STRING>, activities ARRAY<STRUCT<name STRING>>"
    p = with_properties(resources_of_type(resources, "pipelines"), ddl).filter(
        F.col("p.folder").isNotNull() & (array_length("p.activities") > 0)
    )
    rows = p.select(
        "template_id",
        "name",
        F.col("p.description").alias("Description"),
        F.col("p.folder.name").alias("FolderName"),
        array_length(F.filter("p.activities", lambda a: a["name"].isNotNull())).cast("bigint").alias("n"),
    )
    lowered = [F.lower(c).alias(f"lower_{c}") for c in ("name", "Description", "FolderName")]
    grouped = rows.groupBy("template_id", *lowered).agg(
        F.min("name").alias("name"),
        F.min("Description").alias("Description"),
        F.min("FolderName").alias("FolderName"),
        F.sum("n").alias("ActivityCount"),
    )
    return grouped.select(
        "template_id", cut_name("name").alias("PipelineName"), "Description", "FolderName", "ActivityCount"
    )


def t_activity_info(resources: DataFrame) -> DataFrame:
    ddl = "activities ARRAY<STRUCT<name STRING, type STRING, description STRING>>"
    pipelines = with_properties(resources_of_type(resources, "pipelines"), ddl)
    return pipelines.select("template_id", "name", F.explode("p.activities").alias("a")).select(
        "template_id",
        F.col("a.name").alias("ActivityName"),
        F.col("a.type").alias("Type"),
        F.col("a.description").alias("Description"),
        cut_name("name").alias("BelongsToPipeline"),
    )


def t_linked_service_info(resources: DataFrame) -> DataFrame:
    """A Key Vault secret anywhere in the properties text counts, whatever its case."""
    vault = F.contains(F.lower(properties_text(resources)), F.lit("azurekeyvaultsecret"))
    rows = resources_of_type(resources, "linkedServices").filter(F.col("properties").isNotNull())
    rows = with_properties(rows.withColumn("vault", vault), "type STRING")
    return rows.select(
        "template_id",
        cut_name("name").alias("LinkedServiceName"),
        F.col("p.type").alias("Type"),
        F.when(F.col("vault"), "Yes").otherwise("No").alias("UsingKeyVault"),
    )


def t_dataset_info(resources: DataFrame) -> DataFrame:
    ddl = "type STRING, folder STRUCT<name STRING>, linkedServiceName STRUCT<referenceName STRING>"
    rows = with_properties(resources_of_type(resources, "datasets"), ddl)
    return rows.filter(F.col("p.folder").isNotNull() & F.col("p.linkedServiceName").isNotNull()).select(
        "template_id",
        cut_name("name").alias("DatasetName"),
        F.col("p.type").alias("Type"),
        F.col("p.folder.name").alias("FolderName"),
        F.col("p.linkedServiceName.referenceName").alias("ConnectedToLinkedService"),
    )


def _name_and_type(resources: DataFrame, kind: str, label: str, ddl: str = "type STRING", **more: str) -> DataFrame:
    rows = with_properties(resources_of_type(resources, kind), ddl).filter(F.col("p").isNotNull())
    extra = [F.col(f"p.{member}").alias(alias) for alias, member in more.items()]
    return rows.select("template_id", cut_name("name").alias(label), F.col("p.type").alias("Type"), *extra)


def t_integration_runtime_info(resources: DataFrame) -> DataFrame:
    return _name_and_type(resources, "integrationRuntimes", "IntegrationRuntimeName")


def t_dataflow_info(resources: DataFrame) -> DataFrame:
    return _name_and_type(resources, "dataflows", "DataFlowName")


def t_trigger_info(resources: DataFrame) -> DataFrame:
    ddl = "type STRING, runtimeState STRING"
    return _name_and_type(resources, "triggers", "TriggerName", ddl, Status="runtimeState")
