"""Fixed names, table schemas and options."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime, timedelta

# ---------------------------------------------------------------------------
# MIME types of natively stored (not binary) files.
NATIVE_PREFIX = "application/vnd.google-apps."
FOLDER_MIME = "application/vnd.google-apps.folder"
SCRIPT_EXPORT_MIME = "application/vnd.google-apps.script+json"
NATIVE_MIMES = {
    "documents": "application/vnd.google-apps.document",
    "spreadsheets": "application/vnd.google-apps.spreadsheet",
    "drawings": "application/vnd.google-apps.drawing",
    "presentations": "application/vnd.google-apps.presentation",
    "appsScripts": "application/vnd.google-apps.script",
}
FILE_TYPES = ("binary", *NATIVE_MIMES)

# Allowed export formats of native files; the first is the default.
EXPORT_FORMATS = {
    "documents": (
        "text/plain", "text/html", "application/zip", "application/rtf",
        "application/vnd.oasis.opendocument.text", "application/pdf",
        "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
        "application/epub+zip",
    ),
    "spreadsheets": (
        "text/csv", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
        "application/x-vnd.oasis.opendocument.spreadsheet", "application/pdf",
        "text/tab-separated-values", "application/zip",
    ),
    "drawings": ("image/svg+xml", "image/jpeg", "image/png", "application/pdf"),
    "presentations": (
        "text/plain", "application/vnd.openxmlformats-officedocument.presentationml.presentation",
        "application/vnd.oasis.opendocument.presentation", "application/pdf",
    ),
}

# File metadata properties and their types.
FILE_FIELDS = {
    **dict.fromkeys(
        ("id", "name", "mimeType", "driveId", "originalFilename", "fullFileExtension",
         "md5Checksum", "description"), "string"),
    "size": "bigint",
    **dict.fromkeys(("starred", "trashed", "explicitlyTrashed"), "boolean"),
    **dict.fromkeys(("trashedTime", "createdTime", "modifiedTime"), "timestamp"),
    **dict.fromkeys(("parents", "spaces"), "array<string>"),
    "properties": "map<string,string>",
}
IMAGE_FIELDS = {
    **dict.fromkeys(("width", "height", "rotation", "isoSpeed", "subjectDistance"), "int"),
    **dict.fromkeys(
        ("time", "cameraMake", "cameraModel", "meteringMode", "sensor", "exposureMode",
         "colorSpace", "whiteBalance", "lens"), "string"),
    **dict.fromkeys(
        ("exposureTime", "aperture", "focalLength", "exposureBias", "maxApertureValue"), "float"),
    "flashUsed": "boolean",
}
LOCATION_FIELDS = dict.fromkeys(("latitude", "longitude", "altitude"), "double")
VIDEO_FIELDS = {"width": "int", "height": "int", "durationMillis": "bigint"}

# Fixed value: a usable column title.
COLUMN_TITLE = r"^[A-Za-z_][A-Za-z0-9_-]*\z"

# ---------------------------------------------------------------------------
# Tables. `cells` stays long and sparse until rows are built from it.
SHEET_KEY = ["spreadsheet_id", "sheet_id"]
ROW_KEY = [*SHEET_KEY, "row_idx"]

CELL_FIELDS = {
    "formatted": "string", "eff_num": "double", "eff_bool": "boolean", "user_num": "double",
    "user_str": "string", "user_bool": "boolean", "user_formula": "string", "num_format": "string",
    "non_empty": "boolean",  # false for a cell object without any property
}
CELL_VALUES = list(CELL_FIELDS)
CELL_VALUE_DDL = ", ".join(f"{name} {kind}" for name, kind in CELL_FIELDS.items())
CELL_STRUCT = "struct<" + ", ".join(f"{name}: {kind}" for name, kind in CELL_FIELDS.items()) + ">"
CELLS_DDL = "spreadsheet_id string, sheet_id bigint, row_idx bigint, col_idx int, " + CELL_VALUE_DDL
SHEETS_DDL = (
    "spreadsheet_id string, spreadsheet_name string, sheet_id bigint, sheet_index int, "
    "sheet_title string, row_count bigint, col_count int"
)
MERGES_DDL = (
    "spreadsheet_id string, sheet_id bigint, start_row bigint, end_row bigint, start_col int, end_col int"
)


# ---------------------------------------------------------------------------
def _choice(label: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"'{value}' is not a value of {label}. Allowed: {', '.join(allowed)}")


def _moment(label: str, text: str | None) -> datetime:
    """The moment a custom date names, for comparing two of them; zones left out read as UTC."""
    from foldergrid.functions.dates import DATE_STRING  # that package imports this module

    if text is None:
        raise ValueError(f"A custom date range needs a {label} date.")
    match = re.fullmatch(DATE_STRING.removesuffix(r"\z"), text)
    try:
        if not match:
            raise ValueError
        day, _, time = text.upper().partition("T")
        year, month, date = day.split("-")
        clock = re.fullmatch(r"(\d\d):(\d\d):(\d\d)(?:\.(\d+))?(Z|[+-]\d\d:\d\d)?", time) if time else None
        if time and not clock:
            raise ValueError
        hour, minute, second, fraction, zone = clock.groups() if clock else (0, 0, 0, None, None)
        shift = timedelta()
        if zone and zone != "Z":
            shift = timedelta(hours=int(zone[1:3]), minutes=int(zone[4:])) * (-1 if zone[0] == "-" else 1)
        micros = int((fraction or "0")[:6].ljust(6, "0"))
        return datetime(int(year), int(month), int(date), int(hour), int(minute), int(second), micros) - shift
    except (ValueError, OverflowError):
        raise ValueError(f"The {label} date '{text}' is no date, or not written as in 2019-09-19T19:52:13.456Z.") from None


@dataclass(frozen=True)
class FileSourceOptions:
    """How to read a folder of files."""

    folder: str | None = None
    file_id: str | None = None            # single-file mode: every filter below is ignored
    filter: str | None = None             # a Spark SQL predicate over the catalogue
    date_range: str = "lifetime"
    start_date: str | None = None
    end_date: str | None = None
    file_types: tuple[str, ...] = ()
    properties: tuple[str, ...] = ()
    max_part_bytes: int = 0               # 0: never split
    body_format: str = "bytes"
    export_formats: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if (self.folder is None) == (self.file_id is None):
            raise ValueError("Give either a folder or a file identifier.")
        for kind in self.file_types:
            _choice("file types", kind, FILE_TYPES)
        _choice("body format", self.body_format.lower(), ("bytes", "string"))
        if self.max_part_bytes < 0:
            raise ValueError("A part cannot have fewer than 0 bytes.")
        if self.file_id is None and self.date_range == "custom":
            bounds = [_moment(label, text) for label, text in (("start", self.start_date), ("end", self.end_date))]
            if bounds[0] > bounds[1]:
                raise ValueError(f"The custom date range ends ({self.end_date}) before it starts ({self.start_date}).")
        for kind, mime in self.export_formats.items():
            _choice("export types", kind, tuple(EXPORT_FORMATS))
            _choice(f"{kind} export formats", mime, EXPORT_FORMATS[kind])


@dataclass(frozen=True)
class SheetSourceOptions:
    """How to read spreadsheets. Row and column numbers are 1-based; 0 means not set."""

    sheets_to_pull: str = "all"           # all | numbers | titles
    sheet_identifiers: tuple = ()
    column_names: str = "first_row"       # no_column_names | first_row | custom_row
    names_row: int = 1
    auto_detect: bool = True
    last_column: int = 0
    last_row: int = 0
    formatting: str = "values_only"       # values_only | formatted
    skip_empty: bool = False
    add_names: bool = False
    spreadsheet_field: str = "spreadsheet"
    sheet_field: str = "sheet"
    extract_metadata: bool = False
    metadata_field: str = "metadata"
    first_header_row: int = 0
    last_header_row: int = 0
    first_footer_row: int = 0
    last_footer_row: int = 0
    metadata_cells: str = ""
    read_buffer_rows: int = 100
    day_micros: int = 86_400_000_000

    def __post_init__(self):
        _choice("sheets to pull", self.sheets_to_pull, ("all", "numbers", "titles"))
        _choice("column names", self.column_names, ("no_column_names", "first_row", "custom_row"))
        _choice("formatting", self.formatting, ("values_only", "formatted"))
        if self.sheets_to_pull != "all" and not self.sheet_identifiers:
            raise ValueError("Name the sheets to pull, or pull all of them.")
        if not self.auto_detect and (self.last_column <= 0 or self.last_row <= 0):
            raise ValueError("The last data column and row should be greater than 0.")
        if self.add_names and not (self.spreadsheet_field and self.sheet_field):
            raise ValueError("Spreadsheet and sheet field names cannot be empty.")

    @property
    def has_names(self) -> bool:
        return self.column_names != "no_column_names"

    @property
    def header_row(self) -> int:
        """1-based row of the column names."""
        return self.names_row if self.column_names == "custom_row" else 1

    def first_data_row(self, header_rows: int) -> int:
        """1-based; `header_rows` is 2 when any column has sub-columns."""
        first = 1
        if self.extract_metadata and self.last_header_row > 0:
            first = self.last_header_row + 1
        return max(first, self.header_row + header_rows) if self.has_names else first

    @property
    def fixed_last_row(self) -> int | None:
        """1-based last data row known without the sheet's own row count."""
        bounds = [] if self.auto_detect else [self.last_row]
        if self.extract_metadata and self.first_footer_row > 0:
            bounds.append(self.first_footer_row - 1)
        return min(bounds) if bounds else None


@dataclass(frozen=True)
class SheetSinkOptions:
    """How to lay records out as grid rows."""

    spreadsheet_name: str = "Spreadsheet"
    sheet_name: str = "Sheet"
    spreadsheet_field: str | None = None
    sheet_field: str | None = None
    skip_name_fields: bool = False
    write_schema: bool = True
    merge_data_cells: bool = False
    max_buffer: int = 50                  # records per update batch
    max_batch_rows: int = 10_000          # grid rows per update document
    min_extension: int = 1000
    initial_rows: int = 1000
    initial_columns: int = 26
    day_micros: int = 86_400_000_000
    # integer fields that hold a time of day: name -> "millis" | "micros"
    time_fields: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if not self.spreadsheet_name or not self.sheet_name:
            raise ValueError("Default spreadsheet and sheet names cannot be empty.")
        for name in ("max_buffer", "max_batch_rows", "min_extension"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} should be greater than 0.")
