"""tableferry: move warehouse tables between systems with Spark DataFrames."""

from tableferry.specs import IncrementalSpec, LoadSpec, SourceColumn, TableSpec

__all__ = ["IncrementalSpec", "LoadSpec", "SourceColumn", "TableSpec"]
