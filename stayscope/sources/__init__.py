"""Tables in and out, and the shared folder for intermediate results."""

from stayscope.sources.checkpoints import cut_lineage, load_checkpoint, save_checkpoint, shared_folder
from stayscope.sources.tables import column_types, even_rows, head_rows, in_file_order, read_table, shape, spread_rows

__all__ = [
    "column_types",
    "cut_lineage",
    "even_rows",
    "head_rows",
    "in_file_order",
    "load_checkpoint",
    "read_table",
    "save_checkpoint",
    "shape",
    "shared_folder",
    "spread_rows",
]
