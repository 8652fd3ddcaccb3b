from tallyline.sources.dump import load_tuple_dump, parse_tuple_dump
from tallyline.sources.sinks import append_literal_rows, append_rows, discard, materialise, replace_table, scratch_path, stored
from tallyline.sources.tables import SCHEMAS, literal_table, parts_of, read_table

__all__ = [
    "SCHEMAS",
    "append_literal_rows",
    "append_rows",
    "discard",
    "literal_table",
    "load_tuple_dump",
    "materialise",
    "parse_tuple_dump",
    "parts_of",
    "read_table",
    "replace_table",
    "scratch_path",
    "stored",
]
