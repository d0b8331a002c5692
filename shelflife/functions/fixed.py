"""Values that decide results and are therefore fixed."""

# Activities that read an item without modifying it.
READ_ONLY_ACTIVITIES = [
    "ViewReport", "ViewDashboard", "ViewDataset", "ViewDataflow",
    "ViewUsageMetrics", "ViewUsageMetricsReport", "ViewArtifact",
    "GetReport", "GetDashboard", "GetDataset", "GetDatasources",
    "GetRefreshHistory", "GetRefreshSchedule", "GetGroupUsers",
    "GetWorkspaces", "GetWorkspace", "GetSnapshots",
    "GetArtifactAccessRequestsResponseList",
    "ExportReport", "ExportDataflow", "ExportArtifact",
    "ExportActivityEvents", "DownloadReport",
    "ShareReport", "ShareDashboard",
    "PrintReport", "GenerateScreenshot",
    "GenerateCustomVisualAADAccessToken",
    "AnalyzeInExcel", "AnalyzedByExternalApplication",
    "DiscoverSuggestedPeople", "DiscoverSuggestedArtifacts",
]

# Retention days of every type, and of the types that differ.
DEFAULT_RETENTION_DAYS = 10
RETENTION_DAYS = {"Report": 20, "SemanticModel": 20}

# Item types that other operators select or produce.
WORKSPACE = "Workspace"
LAKEHOUSE = "Lakehouse"
WAREHOUSE = "Warehouse"
LAKEHOUSE_TABLE = "LakehouseTable"
LAKEHOUSE_FILE = "LakehouseFile"
WAREHOUSE_TABLE = "WarehouseTable"
WAREHOUSE_VIEW = "WarehouseView"
SUB_ITEM_TYPES = [LAKEHOUSE_TABLE, LAKEHOUSE_FILE, WAREHOUSE_TABLE, WAREHOUSE_VIEW]

# Spellings of one event field, in order of preference.
ACTIVITY_KEYS = ["Activity", "activity"]
TIME_KEYS = ["CreationTime", "creationTime"]
DIRECT_ID_KEYS = ["ArtifactId", "artifactId"]
OTHER_ID_KEYS = ["ItemId", "itemId", "DatasetId", "ReportId", "DashboardId", "DataflowId"]
OBJECT_URL_KEYS = ["ObjectId", "objectId"]
NAME_KEYS = [
    "ArtifactName", "artifactName", "ObjectDisplayName", "DisplayName", "displayName",
    "ItemName", "itemName", "ObjectName", "objectName",
]
TYPE_KEYS = ["ItemType", "itemType", "ArtifactType", "artifactType"]
WORKSPACE_ID_KEYS = ["WorkSpaceId", "workSpaceId", "WorkspaceId"]
WORKSPACE_NAME_KEYS = ["WorkspaceName", "workspaceName"]
USER_KEYS = ["UserId", "userId"]

# Where an item's dates came from.
SOURCE_SCANNER = "pbi_scanner"
SOURCE_ACTIVITY = "activity_events"
SOURCE_NAME_MATCH = "activity_name_match"
SOURCE_DERIVED = "derived_from_items"
SOURCE_LISTED_TABLE = "lakehouse_tables_api"
SOURCE_PATH_TABLE = "onelake_dfs_tables"
SOURCE_PATH_FILE = "onelake_dfs"
SOURCE_CATALOG = "warehouse_sys_metadata"
SOURCE_NONE = "none"
SOURCE_ID_MATCH = "activity_id_match"
SOURCE_INVENTORY = "fabric_api"
SOURCE_CREATED = "created_date"

# Readiness verdicts.
STATUS_NO_DATE = "⚪ No date — cannot assess"
STATUS_EXCEEDS = "🔴 EXCEEDS RETENTION"
STATUS_WITHIN = "🟢 Within retention"

# Names, labels and patterns.
UNKNOWN = "Unknown"
PERSONAL_LABEL = "My workspace"
POLICY_ACTION = "flag_only"
RESERVED_NAMES = ["Files", "Tables", "TableMaintenance"]
NOISE_TABLE_PATTERN = "/(Files|Tables|TableMaintenance)$"
NOISE_FILE_PATTERN = "/Files/Tables/"
GUID_PATTERN = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"

# Names and descriptions of sub-items and policy rows.
SUB_ITEM_NAME = "{}/{}"
OBJECT_NAME = "{}/{}.{}"
LISTED_TABLE_TEXT = "Table in {} ({}, {})"
PATH_TABLE_TEXT = "Table in {} (DFS discovered)"
FILE_TEXT = "File in {}"
OBJECT_TEXT = "{} in {}.{}"
POLICY_TEXT = "Retain {} items for {} day(s)"
