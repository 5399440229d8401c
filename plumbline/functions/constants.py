"""Texts, names and limits that decide results and therefore must not change."""

# Fixed value: prefix of every resource type.
TYPE_PREFIX = "Microsoft.DataFactory/factories/"

# Resource kinds, as spelled after the prefix.
KINDS = (
    "linkedServices",
    "datasets",
    "pipelines",
    "dataflows",
    "triggers",
    "integrationRuntimes",
)

# Fixed value: characters kept of a resource name in the summaries.
NAME_CUT = 50

# Severities in rising order.
SEVERITIES = ("Low", "Medium", "High")

# The 21 checks as (number, component, severity, summary text, detail text).
CHECKS = (
    (1, "Pipeline", "Medium", "Pipeline(s) without any triggers attached. Directly or indirectly.", "Does not any triggers attached."),
    (2, "Pipeline", "High", "Pipeline(s) with an impossible AND/OR activity execution chain.", "Has an impossible AND/OR activity execution chain."),
    (3, "Pipeline", "Low", "Pipeline(s) without a description value.", "Does not have a description."),
    (4, "Pipeline", "Low", "Pipeline(s) not organised into folders.", "Not organised into a folder."),
    (5, "Pipeline", "Low", "Pipeline(s) without annotations.", "Does not have any annotations."),
    (6, "Data Flow", "Low", "Data Flow(s) without a description value.", "Does not have a description."),
    (7, "Activity", "High", "Activitie(s) with timeout values still set to the service default value of 7 days.", "Timeout policy still set to the service default value of 7 days."),
    (8, "Activity", "Low", "Activitie(s) without a description value.", "Does not have a description."),
    (9, "Activity", "High", "Activitie(s) ForEach iteration without a batch count value set.", "ForEach does not have a batch count value set."),
    (10, "Activity", "Medium", "Activitie(s) ForEach iteration with a batch count size that is less than the service maximum.", "ForEach has a batch size that is less than the service maximum."),
    (11, "Linked Service", "High", "Linked Service(s) not using Azure Key Vault to store credentials.", "Not using Key Vault to store credentials."),
    (12, "Linked Service", "Medium", "Linked Service(s) not used by any other resource.", "Not used by any other resource."),
    (13, "Linked Service", "Low", "Linked Service(s) without a description value.", "Does not have a description."),
    (14, "Linked Service", "Low", "Linked Service(s) without annotations.", "Does not have any annotations."),
    (15, "Dataset", "Medium", "Dataset(s) not used by any other resource.", "Not used by any other resource."),
    (16, "Dataset", "Low", "Dataset(s) without a description value.", "Does not have a description."),
    (17, "Dataset", "Low", "Dataset(s) not organised into folders.", "Not organised into a folder."),
    (18, "Dataset", "Low", "Dataset(s) without annotations.", "Does not have any annotations."),
    (19, "Trigger", "Medium", "Trigger(s) not used by any other resource.", "Not used by any other resource."),
    (20, "Trigger", "Low", "Trigger(s) without a description value.", "Does not have a description."),
    (21, "Trigger", "Low", "Trigger(s) without annotations.", "Does not have any annotations."),
)

# Limits the checks compare with.
DEFAULT_TIMEOUT = "7.00:00:00"
FOREACH_BATCH_MAXIMUM = 50

# Run statuses that mean "not finished", and the status that means success.
RUNNING = ("InProgress", "Queued")
SUCCEEDED = "Succeeded"

# Fixed value: what the gate says about a pipeline that still runs; # stands for its name.
STILL_RUNNING = (
    "Provided pipeline name (#) still has a run in progress or queued given the query range parameters set in the"
    " properties table."
)
UNKNOWN_PIPELINE = "Provided pipeline name (#) is not known."

# Notebook language to file extension and export format.
LANGUAGE_EXTENSION = {"SCALA": ".scala", "PYTHON": ".ipynb", "SQL": ".sql", "R": ".r"}
LANGUAGE_FORMAT = {"SCALA": "SOURCE", "PYTHON": "JUPYTER", "SQL": "SOURCE", "R": "SOURCE"}

# Autoscale formula.
SCALE_START, SCALE_CAP, SCALE_MIN_PERCENT, SCALE_WINDOW = 1, 25, 70, "180 seconds"

# Fixed value: rows per batch of a bulk database write.
BULK_BATCH = 10_000

# Parameter names whose values are never shown.
SECRET_KEYS = "(?i)(password|secret(?!name)|accountkey|principalkey|token)"
