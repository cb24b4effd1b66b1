"""Word lists, lookup tables and constants the results depend on.

Everything here is a fixed value, stated as text in its natural order. The
harvest's dictionaries of description and search terms are not part of the
code: they are tables the caller supplies (`sources.landing.read_terms`).
"""


def search_terms(seeds, heads=(), evidence=()) -> list[str]:
    """Ordered distinct search terms: the seeds, then every head with every evidence word."""
    return list(dict.fromkeys([*seeds, *(f"{h} {e}" for h in heads for e in evidence)]))


# File extensions that count as qualitative evidence.
QUALITATIVE_EXTENSIONS = [
    "qdpx", "nvpx", "nvp", "atlproj", "atlasproj", "mx", "mx2", "mx3", "mx4", "mx5", "mx11",
    "mx12", "mx18", "mx20", "mx22", "mx24", "mx24bac", "mex22", "mex24", "mqda", "mqbac",
    "mqex", "mqmtr", "mqtc", "mtr", "ppj", "pprj", "qdc", "qlt", "qpd", "f4p", "hpr7", "loa",
    "m2k", "mc24", "mod", "sea", "bwf", "mxf", "mka", "flac", "opus", "wav", "mp3", "aac",
    "m4a", "aiff", "aif", "ogg", "mkv", "mp4", "m4v", "mpg", "mpeg", "m2v", "avi", "mov", "qt",
    "txt", "odt", "pdf", "docx", "doc", "rtf", "xml", "html", "md", "sav", "por", "sps", "dta",
    "jasp", "7dat", "sd2", "tpt", "csv",
]

# File-name terms.
FILENAME_TERMS = [
    "qualitative", "interview", "interviews", "transcript", "transcripts", "focus group",
    "focus groups", "fieldnotes", "field notes", "oral history", "narrative", "codebook",
    "coding", "coded", "memo", "observation", "ethnograph", "biography", "life story",
    "verbatim", "recording", "audio", "video", "NVivo", "ATLAS", "MAXQDA", "CAQDAS",
    "kwalitatief", "kwalitatieve", "transcriptie", "focusgroep", "focusgroepen",
    "veldnotities", "veldaantekeningen", "levensverhaal", "narratief", "codeboek", "codering",
    "observatie", "etnografie", "biografie", "opname", "geluidsopname", "dagboek",
    "topiclijst", "interviewleidraad",
]

# Phrases of the three page signals.
SUMMARY_PHRASES = [
    "qualitative", "qualitative interview", "interview", "focus group", "transcript",
    "semi structured interview", "unstructured interview", "in depth interview",
    "key informant interview", "field note", "participant observation", "ethnograph",
    "oral history", "life history", "narrative", "thematic analysis", "open ended response",
]
KIND_PHRASES = ["text", "textual", "qualitative", "transcript", "narrative text"]
COLLECTION_PHRASES = [
    "interview", "telephone interview", "in depth interview", "focus group", "observation",
    "participant observation", "ethnograph", "oral history",
]

# File and download states.
STATUSES = [
    "SUCCEEDED", "FAILED_SERVER_UNRESPONSIVE", "FAILED_LOGIN_REQUIRED", "FAILED_TOO_LARGE",
]
UNRESPONSIVE = "FAILED_SERVER_UNRESPONSIVE"
STATUS_BUCKETS = {
    "SUCCEEDED": "download_succeeded",
    "FAILED_LOGIN_REQUIRED": "download_failed_login_required",
    "FAILED_SERVER_UNRESPONSIVE": "download_failed_server_unresponsive",
    "FAILED_TOO_LARGE": "download_failed_too_large",
}
MAX_DOWNLOAD_BYTES = 5 * 1024**3
BUCKETS = [
    "identified_qualitative_with_files", "identified_qualitative_with_no_files",
    "identified_non_qualitative_with_files", "identified_non_qualitative_with_no_files",
]

# Page types, their key digit, file-name prefix and repository.
PAGE_TYPES = {"icpsr": 1, "openicpsr": 2, "datalumos": 3}
PACKAGE_PREFIX = {"icpsr": "ICPSR", "openicpsr": "OpenICPSR", "datalumos": "DataLumos"}
REPOSITORY_NAME = {"icpsr": "ICPSR", "openicpsr": "openICPSR", "datalumos": "DataLumos"}
REPOSITORY_URL = {
    "icpsr": "https://www.icpsr.umich.edu",
    "openicpsr": "https://www.openicpsr.org",
    "datalumos": "https://www.datalumos.org",
}
PAGE_TYPE_MARKERS = {
    "datalumos": "datalumos.org/datalumos/project/",
    "openicpsr": "openicpsr.org/openicpsr/project/",
    "icpsr": "icpsr.umich.edu/web/icpsr/studies/",
}
STUDY_URL = "https://www.icpsr.umich.edu/web/ICPSR/studies/"
STUDY_SUBPAGES = [
    "summary", "datadocumentation", "variables", "publications", "export", "terms",
]
SCHEMA_VERSION = "1.0.0"
# Script variables that count whatever the inline metadata says.
INLINE_NAMES = ["studyId", "versionLabel", "restrictedDataTypes", "title", "versionNumber"]
# How a record names its parser and its own identifier.
PARSER_VERSION = {
    "icpsr": "2.3.0-datadoc-render-fallback", "openicpsr": "1.0.0", "datalumos": "1.0.0"}
IDENTIFIER_TYPE = {
    "icpsr": "ICPSR study_id", "openicpsr": "openICPSR project_id", "datalumos": "DataLumos project_id"}

# Licence spellings.
LICENSES = {
    "cc-by-4.0": "CC BY 4.0",
    "cc-by-sa-4.0": "CC BY-SA 4.0",
    "cc-by-nc-4.0": "CC BY-NC 4.0",
    "cc-by-nd-4.0": "CC BY-ND 4.0",
    "cc-by-nc-nd-4.0": "CC BY-NC-ND 4.0",
    "cc-by-nc-sa-4.0": "CC BY-NC-SA 4.0",
    "cc0-1.0": "CC0 1.0",
    "creativecommons.org/licenses/by/4.0": "CC BY 4.0",
    "creativecommons.org/licenses/by-sa/4.0": "CC BY-SA 4.0",
    "creativecommons.org/licenses/by-nc/4.0": "CC BY-NC 4.0",
    "creativecommons.org/licenses/by-nd/4.0": "CC BY-ND 4.0",
    "creativecommons.org/licenses/by-nc-sa/4.0": "CC BY-NC-SA 4.0",
    "creativecommons.org/licenses/by-nc-nd/4.0": "CC BY-NC-ND 4.0",
    "creativecommons.org/share-your-work/public-domain/pdm": "CC0 1.0",
    "cc by 4.0": "CC BY 4.0",
    "cc by-sa 4.0": "CC BY-SA 4.0",
    "cc by-nc 4.0": "CC BY-NC 4.0",
    "cc by-nd 4.0": "CC BY-ND 4.0",
    "cc by-nc-nd 4.0": "CC BY-NC-ND 4.0",
    "cc by-nc-sa 4.0": "CC BY-NC-SA 4.0",
    "cc0 1.0": "CC0 1.0",
}

# Organisation display names.
ORGANISATIONS = {
    "inter-university consortium for political and social research":
        "Inter-university Consortium for Political and Social Research (ICPSR)",
    "inter-university consortium for political and social research (icpsr)":
        "Inter-university Consortium for Political and Social Research (ICPSR)",
    "icpsr": "Inter-university Consortium for Political and Social Research (ICPSR)",
    "datalumos": "DataLumos",
}

# MIME types by extension, one table per page type.
_OFFICE = "application/vnd.openxmlformats-officedocument."
_BINARY = "application/octet-stream"
MIME_TYPES = {
    "icpsr": {
        "pdf": "application/pdf", "txt": "text/plain", "tsv": "text/tab-separated-values",
        "csv": "text/csv", "xml": "application/xml", "json": "application/json",
        "zip": "application/zip", "gz": "application/gzip",
        "xlsx": _OFFICE + "spreadsheetml.sheet", "xls": "application/vnd.ms-excel",
        "sas": _BINARY, "spss": _BINARY, "stata": _BINARY, "ascii": "text/plain",
        "delimited": "text/plain", "r": _BINARY, "qda": "application/zip",
        "sps": "text/plain", "do": "text/plain",
    },
    "openicpsr": {
        "pdf": "application/pdf", "txt": "text/plain", "tsv": "text/tab-separated-values",
        "csv": "text/csv", "xml": "application/xml", "json": "application/json",
        "xlsx": _OFFICE + "spreadsheetml.sheet", "xls": "application/vnd.ms-excel",
        "docx": _OFFICE + "wordprocessingml.document", "doc": "application/msword",
        "zip": "application/zip", "gz": "application/gzip", "rda": _BINARY, "sav": _BINARY,
        "dta": _BINARY, "sas": "text/plain", "sps": "text/plain", "dct": "text/plain",
        "do": "text/plain",
    },
    "datalumos": {
        "pdf": "application/pdf", "zip": "application/zip",
        "xlsx": _OFFICE + "spreadsheetml.sheet", "xls": "application/vnd.ms-excel",
        "csv": "text/csv", "tsv": "text/tab-separated-values", "txt": "text/plain",
        "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif",
        "json": "application/json", "xml": "application/xml", "sav": _BINARY, "dta": _BINARY,
        "sas7bdat": _BINARY, "rdata": _BINARY, "rda": _BINARY,
    },
}

# File category by extension, one table per page type.
CATEGORY_BY_EXTENSION = {
    "openicpsr": {
        "pdf": "documentation", "doc": "documentation", "docx": "documentation",
        "txt": "data", "csv": "data", "tsv": "data", "xlsx": "data", "xls": "data",
        "zip": "data", "sav": "data", "dta": "data", "rda": "data",
        "sas": "setup", "sps": "setup", "dct": "setup", "do": "setup",
    },
    "datalumos": {
        "pdf": "documentation", "doc": "documentation", "docx": "documentation",
        "txt": "data", "csv": "data", "tsv": "data", "xlsx": "data", "xls": "data",
        "zip": "data", "sav": "data", "dta": "data", "sas7bdat": "data", "rdata": "data",
        "rda": "data", "json": "data", "xml": "data",
    },
}
CATEGORY_PRIORITY = {"data": 1, "setup": 2, "documentation": 3, "other": 4}

# Labels of the study download menus.
BRACKET_EXTENSIONS = {
    "pdf": "pdf", "excel 2007 spreadsheet": "xlsx", "excel spreadsheet": "xlsx",
    "excel": "xlsx", "csv": "csv", "text": "txt", "txt": "txt", "zip": "zip",
}
LABEL_FORMATS = {
    "stata": "stata", "spss": "spss", "sas": "sas", "r": "r", "ascii": "ascii",
    "delimited": "delimited", "qualitative data": "qda", "documentation only": "zip",
}
SETUP_FORMATS = {"stata setup": "do", "spss setup": "sps", "sas setup": "sas"}
METRICS_NAMES = ["metrics", "usage_report", "usage-report"]
DOC_PREFIXES = [
    "documentation", "questionnaire", "frequencies", "manual", "flashcards", "description",
    "readme", "reference", "supplements", "flowchart", "report",
]
PACKAGE_FORMATS = [
    "Qualitative Data", "Stata", "SPSS", "SAS", "R", "ASCII", "Delimited", "Documentation Only",
]

# Export formats and the patterns that reveal them.
EXPORT_FORMATS = {
    "Dublin Core": r"\bdublin core\b|\boai[_-]?dc\b",
    "DDI 2.5": r"\bddi\s*2\.5\b|\boai[_-]?ddi25\b|\bddi25\b",
    "DATS 2.2 (JSON)": r"\bdats\s*2\.2\b|\bdats\b",
    "DCAT-US 1.1 (beta)": r"\bdcat[- ]us\s*1\.1\b|\bdcat-us\b",
}

# Words that decide what a project file holds, first rule first.
OPEN_CONTENT_RULES = [
    ("Codebook", ["codebook"]),
    ("Questionnaire", ["questionnaire", "survey instrument"]),
    ("Documentation", ["readme", "documentation", "manual", "guide"]),
    ("Setup", ["setup", "dictionary"]),
    ("Data", ["transcript", "interview", "focus group"]),
]
OPEN_CONTENT_EXTENSIONS = [
    ("Data", ["sav", "dta", "rda", "csv", "tsv", "txt", "zip", "xlsx", "xls"]),
    ("Setup", ["sas", "sps", "dct", "do"]),
    ("Documentation", ["pdf", "doc", "docx"]),
]
FOLDER_CONTENT_RULES = [
    ("Codebook", ["codebook"]),
    ("Questionnaire", [
        "questionnaire", "data-collection-instruments", "interview", "consentform", "manual",
        "worksheet", "brochure", "postcard", "script", "privacypledge",
    ]),
    ("Setup", ["setup", "dictionary"]),
    ("Documentation", [
        "documentation", "faq", "background", "summary findings", "overview",
        "revision history", "research projects and publications", "user guide",
        "variable-list", "variable list",
    ]),
]
FOLDER_DATA_EXTENSIONS = [
    "zip", "csv", "tsv", "sav", "dta", "sas7bdat", "rdata", "rda", "json", "xml",
]

# Links that are never files, and the shape of those that are.
FILE_LINK_SKIP = [
    "download detailed metrics", "usage/download", "/metrics/", "cite", "citation", "endnote",
    "bibtex", "dublin core", "ddi 2.5", "dats 2.2", "dcat-us", "export metadata", "mailto:",
    "javascript:",
]
FILE_LINK_ACCEPT = (
    r"type=file|/file/|/files/|download|\.pdf\b|\.docx?\b|\.zip\b|\.csv\b|\.txt\b|\.xlsx?\b"
    r"|\.sav\b|\.dta\b|\.rda\b"
)

# Markers of search, inventory, degraded, terms and login pages.
SEARCH_MARKERS = [
    "searchResults : ", "searchResults: ", "searchResults = ", '"searchResults":',
    '"searchResults" :', "window.searchResults = ", "window.searchResults= ",
]
INVENTORY_MARKERS = [
    'id="data-doc"', "id='data-doc'", "download-link-menu", "documentation [pdf]",
    "questionnaire [pdf]",
]
DEGRADED_MARKERS = [
    "error loading remote resources", "please enable javascript in your browser",
    "javascript is required to use the core functionality", "chrome-error://chromewebdata/",
]
TERMS_MARKERS = [
    "terms of use", "if you agree to them", "by clicking on the",
    "you agree to the following conditions", "\nagree\n", "disagree",
]
LOGIN_MARKERS = ["login", "signin", "sign-in", "openid-connect", "oauth", "realms/icpsr"]

# List entries that carry no information.
DROPPED_VALUES = ["", "hide", "null", "none", "view help"]
