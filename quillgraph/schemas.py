"""Labels and edge types of the graph: columns, keys and confidence."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Label:
    """key identifies a node; numbers are text, since .01 and 2.10 must survive."""

    key: tuple[str, ...]
    columns: str


@dataclass(frozen=True)
class EdgeType:
    """From one label to another; merged: one edge for each pair of ends."""

    source: str
    target: str
    confidence: float = 1.0
    merged: bool = False


LABELS = {
    "Package": Label(("name",), "name string, directory string, prefixes array<string>, vdl_id string, files_low string, files_high string, file_numbers array<string>"),
    "File": Label(("number",), "number string, name string, global_root string, parent_file string, is_subfile boolean"),
    "Field": Label(("file_number", "number", "line_no"), "file_number string, number string, line_no bigint, name string, data_type string, required boolean, is_pointer boolean, is_computed boolean, is_multiple boolean, target_file string"),
    "CrossReference": Label(("xref_id",), "xref_id string, name string, file_number string, field_number string, xref_type string, xref_number string, set_logic string, kill_logic string, execution string"),
    "Routine": Label(("name",), "name string, package_name string, prefix string, lines_of_code bigint, version string, patches array<string>, description string"),
    "Label": Label(("label_id",), "label_id string, name string, routine_name string, line_number int, is_entry_point boolean, is_function boolean, parameters array<string>, comment string"),
}
EDGE_TYPES = {
    "CONTAINS_FILE": EdgeType("Package", "File", 0.8),
    "CONTAINS_FIELD": EdgeType("File", "Field"),
    "POINTS_TO": EdgeType("Field", "File"),
    "COMPUTED_FROM": EdgeType("Field", "Field", 0.8),
    "SUBFILE_OF": EdgeType("File", "File", merged=True),
    "INDEXED_BY": EdgeType("Field", "CrossReference", merged=True),
    "VARIABLE_POINTER": EdgeType("Field", "File"),
    "CONTAINS_LABEL": EdgeType("Routine", "Label"),
    "OWNS_ROUTINE": EdgeType("Package", "Routine"),
    "CALLS": EdgeType("Label", "Label"),
}


def edge_type(name: str) -> EdgeType:
    if name not in EDGE_TYPES:
        raise ValueError(f"unknown edge type {name}")
    return EDGE_TYPES[name]


def label(name: str) -> Label:
    if name not in LABELS:
        raise ValueError(f"unknown label {name}")
    return LABELS[name]
