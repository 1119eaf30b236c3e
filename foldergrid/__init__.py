"""foldergrid: folders of files and spreadsheet grids as Spark DataFrames."""

from foldergrid.model import FileSourceOptions, SheetSinkOptions, SheetSourceOptions
from foldergrid.plans.file_source import read_files
from foldergrid.plans.sheet_source import documents_in_folder, read_documents_rows, read_sheets
from foldergrid.sinks.files import file_rows, write_files
from foldergrid.sinks.sheets import write_sheets, write_update_documents
from foldergrid.sources.documents import read_documents
from foldergrid.sources.folder import list_folder, read_parts
from foldergrid.sources.folder_files import read_folder, use_folder_files
from foldergrid.sources.large_documents import read_large_documents

__version__ = "0.1.0"

__all__ = [
    "FileSourceOptions", "SheetSinkOptions", "SheetSourceOptions", "documents_in_folder", "file_rows",
    "list_folder", "read_documents", "read_documents_rows", "read_files", "read_folder", "read_large_documents",
    "read_parts", "read_sheets", "use_folder_files", "write_files", "write_sheets", "write_update_documents",
]
