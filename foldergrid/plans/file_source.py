"""Folder -> file records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from foldergrid.model import FileSourceOptions
from foldergrid.operators.bodies import cut_bodies, read_bodies
from foldergrid.operators.catalogue import select_files
from foldergrid.operators.metadata import project_metadata


def read_files(
    files: DataFrame,
    options: FileSourceOptions,
    renditions: DataFrame | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Records of a catalogue that carries its bodies: filter, cut, export, project.

    One lazy plan; nothing is collected, and a read of binary files only is not shuffled.
    """
    chosen = select_files(files, options, now)
    if options.file_id is None and options.file_types == ("binary",):
        parts = cut_bodies(chosen, options.max_part_bytes)
    else:
        parts = read_bodies(chosen, options.max_part_bytes, renditions, options.export_formats)
    return project_metadata(parts, options.properties, options.body_format)
