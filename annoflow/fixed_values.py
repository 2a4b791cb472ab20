"""Fixed values.

Names, defaults and patterns that outside data and existing job settings
depend on. They are matched literally, so they are stated here and nowhere else.
"""

# --- fixed values: web archives -------------------------------------------
DEFAULT_EXCLUDE_STATUS = "[345].*"
UNKNOWN_STATUS = "_not_found_"
UNKNOWN_MIME = "_not_found_"
HTTP_RESPONSE_RECORD = r"(?i)application/http;\s*msgtype=response"
CHARSET_IN_CONTENT_TYPE = r"charset=(['\"]?)([a-zA-Z0-9_-]+)\1"
DEFAULT_ARCHIVE_ENCODING = "windows-1252"
NULL_HEADER_VALUE = "_null_"
ARCHIVE_HEADER_PREFIX = "arc_header_"
HTTP_HEADER_PREFIX = "http_header_"
RECORD_OFFSET = "recordOffset"
RECORD_LENGTH = "recordLength"
RECORD_POSITION = "recordPosition"
RECORD_URL = "url"

# --- fixed values: file naming --------------------------------------------
DEFAULT_NUMBER_PATTERN = "3/3"
URL_WITHOUT_SCHEME_QUERY_FRAGMENT = r"^(?:.*?://)?(.*?)(?:\?.*)?(?:#.*)?$"
NON_ASCII_RUN = r"[^\p{ASCII}]+"
NOT_IN_FILE_NAME = r"[/:\\]"
DEFAULT_CHUNK_PATTERN = "part-%03d"
DEFAULT_CHUNK_BYTES = 99_000_000

# --- fixed values: settings written as text -------------------------------
TRUE_WORDS = ("true", "yes", "on")

# --- fixed values: JSON output --------------------------------------------
DEFAULT_SET_LABEL = "default"

# --- fixed values: XCES vocabulary ----------------------------------------
XCES_VERSION = "1.0"
XCES_NAMESPACE = "http://www.xces.org/schema/2003"
XCES_ROOT = "cesAna"
XCES_ANNOTATION = "struct"
XCES_FEATURE = "feat"

# --- fixed values: elements of XML reports, with the columns they hold ----
REPORT_ROOT = "cloudReport"
REPORT_DOCUMENTS = "documents"
REPORT_ENTRY = "processResult"
REPORT_ENTRY_NUMBERS = (
    ("fileSize", "file_size"),
    ("documentLength", "document_length"),
    ("executionTime", "execution_ms"),
)
REPORT_STATISTICS = "statistics"
REPORT_COUNT = "annotationCount"
REPORT_ERROR = "errorDescription"
REPORT_SUMMARY = "batchReport"
REPORT_SUMMARY_FIELDS = (
    ("finalBatchState", "final_state"),
    ("totalDocuments", "total_documents"),
    ("successfullyProcessed", "successfully_processed"),
    ("withError", "with_error"),
    ("totalBytes", "total_bytes"),
    ("totalCharacters", "total_characters"),
    ("executionTime", "execution_ms"),
)

# --- fixed values: paths left out of directory listings by default --------
# (the documented default excludes of Apache Ant file sets)
DEFAULT_EXCLUDES = (
    "**/*~",
    "**/#*#",
    "**/.#*",
    "**/%*%",
    "**/._*",
    "**/CVS",
    "**/CVS/**",
    "**/.cvsignore",
    "**/SCCS",
    "**/SCCS/**",
    "**/vssver.scc",
    "**/.svn",
    "**/.svn/**",
    "**/.DS_Store",
    "**/.git",
    "**/.git/**",
    "**/.gitattributes",
    "**/.gitignore",
    "**/.gitmodules",
    "**/.hg",
    "**/.hg/**",
    "**/.hgignore",
    "**/.hgsub",
    "**/.hgsubstate",
    "**/.hgtags",
    "**/.bzr",
    "**/.bzr/**",
    "**/.bzrignore",
)
