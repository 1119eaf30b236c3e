"""Projecting files to the requested metadata columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.model import FILE_FIELDS, IMAGE_FIELDS, LOCATION_FIELDS, VIDEO_FIELDS
from foldergrid.operators.bodies import body_column

IMAGE, VIDEO, LOCATION = "imageMediaMetadata", "videoMediaMetadata", "location"


def _typed(source: str, name: str, kind: str) -> Column:
    value = F.col(f"{source}{name}").cast(kind)
    return (F.date_trunc("MILLISECOND", value) if kind == "timestamp" else value).alias(name)


def _struct(source: str, columns: list[Column]) -> Column:
    """A struct of the requested parts, null where the source struct is null."""
    return F.when(F.col(source).isNotNull(), F.struct(*columns))


def _known(name: str, kinds: dict[str, str], label: str) -> str:
    if name not in kinds:
        raise ValueError(f"There is no {label} property '{name}'. Known: {', '.join(kinds)}")
    return kinds[name]


def metadata_columns(properties: list[str] | tuple[str, ...], body_format: str, available: list[str]) -> list[Column]:
    """Requested properties in order, body, offset, image struct (location last), video struct."""
    top, image, location, video = [], [], [], []
    for name in properties:
        group, _, rest = name.partition(".")
        if group == IMAGE and rest.startswith(f"{LOCATION}."):
            part = rest[len(LOCATION) + 1:]
            location.append(_typed(f"{IMAGE}.{LOCATION}.", part, _known(part, LOCATION_FIELDS, "location")))
        elif group == IMAGE and rest:
            image.append(_typed(f"{IMAGE}.", rest, _known(rest, IMAGE_FIELDS, "image media metadata")))
        elif group == VIDEO and rest:
            video.append(_typed(f"{VIDEO}.", rest, _known(rest, VIDEO_FIELDS, "video media metadata")))
        else:
            kind = _known(name, FILE_FIELDS, "top level")
            # a catalogue without the property has it nowhere set
            top.append(_typed("", name, kind) if name in available else F.lit(None).cast(kind).alias(name))
    columns = [*top, body_column(body_format).alias("body"), F.col("offset").cast("bigint").alias("offset")]
    if location:
        image.append(_struct(f"{IMAGE}.{LOCATION}", location).alias(LOCATION))
    if image:
        columns.append(_struct(IMAGE, image).alias(IMAGE))
    if video:
        columns.append(_struct(VIDEO, video).alias(VIDEO))
    return columns


def project_metadata(parts: DataFrame, properties, body_format: str = "bytes") -> DataFrame:
    """File records with the requested metadata; unknown property names are an error."""
    return parts.select(*metadata_columns(properties, body_format, parts.columns))
