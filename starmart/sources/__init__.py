from .files import (
    AIRPORT_SCHEMA, CITY_SCHEMA, IMMIGRATION_SCHEMA, SOURCE_FILES, TEMPERATURE_SCHEMA, apply_schema,
    land, land_apart, local_table, read_csv, read_source, read_table, source_path,
)
from .labels import LABEL_SECTIONS, LabelSection, label_rejects, parse_labels, read_lines, rejects
from .sas import read_sas

__all__ = [
    "AIRPORT_SCHEMA", "CITY_SCHEMA", "IMMIGRATION_SCHEMA", "SOURCE_FILES", "TEMPERATURE_SCHEMA",
    "apply_schema", "land", "land_apart", "local_table", "read_csv", "read_source", "read_table", "source_path",
    "LABEL_SECTIONS", "LabelSection", "label_rejects", "parse_labels", "read_lines", "rejects",
    "read_sas",
]
