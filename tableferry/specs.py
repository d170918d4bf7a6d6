"""What to move and how to load it.  Plain metadata: no Spark objects, no rows."""

from __future__ import annotations

import logging
from dataclasses import dataclass

log = logging.getLogger(__name__)

# Fixed value: the target keeps at most this many sort keys unless a table says otherwise.
MAX_SORT_KEYS = 2
# Fixed value: how long a table keeps its partitions unless it says otherwise.
DEFAULT_LIFECYCLE_DAYS = 366


@dataclass(frozen=True)
class SourceColumn:
    """A column as the source system declares it, e.g. ``("L_PARTKEY", "INT UNSIGNED", 10)``."""

    name: str
    declared: str
    precision: int = 0
    scale: int = 0


@dataclass(frozen=True)
class TableSpec:
    """A source table: its dialect, declared columns, keys and partition columns.

    ``max_sort_keys`` of the indexed columns become sort keys; those left out are logged.  ``interleaved`` gives
    them equal weight.
    ``time_zone`` is that of the clocks by which instants (zoned timestamps) become dates, times without zone and text.
    """

    name: str
    dialect: str
    columns: tuple[SourceColumn, ...]
    primary_key: tuple[str, ...] = ()
    indexed: tuple[str, ...] = ()
    dist_key: str | None = None
    partition_columns: tuple[str, ...] = ()
    external: bool = False
    comment: str = ""
    lifecycle_days: int = DEFAULT_LIFECYCLE_DAYS
    max_sort_keys: int = MAX_SORT_KEYS
    interleaved: bool = False
    time_zone: str = "UTC"

    def __post_init__(self) -> None:
        seen: dict[str, str] = {}
        for c in self.columns:
            other = seen.setdefault(c.name.lower(), c.name)
            if other != c.name or [x.name for x in self.columns].count(c.name) > 1:
                raise ValueError(f"{self.name}: columns {other!r} and {c.name!r} collide in lower case")

    def _known(self, names: tuple[str, ...]) -> tuple[str, ...]:
        """The given names in lower case, without repeats and without unknown columns."""
        have = {c.name.lower() for c in self.columns}
        return tuple(dict.fromkeys(n.lower() for n in names if n.lower() in have))

    @property
    def key(self) -> tuple[str, ...]:
        """Primary-key columns that exist in the table."""
        return self._known(self.primary_key)

    @property
    def sort_keys(self) -> tuple[str, ...]:
        """The first indexed columns: they become the sort order of the target."""
        known = self._known(self.indexed)
        if len(known) > self.max_sort_keys:
            log.warning("%s: sorted by %s, not by %s", self.name, known[:self.max_sort_keys], known[self.max_sort_keys:])
        return known[:self.max_sort_keys]

    @property
    def distribution_key(self) -> str | None:
        """The configured key, else a single-column primary key, else none (automatic)."""
        if self.dist_key:
            return self.dist_key.lower()
        return self.key[0] if len(self.key) == 1 else None


@dataclass(frozen=True)
class IncrementalSpec:
    """How an increment is cut out of the source and put into the target.

    ``where`` is a Spark SQL condition on the source.  ``merge_key`` defaults to the primary key.
    ``select_from_staging`` holds select expressions applied to the increment before the load.
    ``append_only`` forbids a merge even where ``merge`` is set.
    ``custom_fields`` are columns that only the target has and that are kept on purpose.
    ``rewrite`` says what a merge writes: ``table``, a new version that appears at once, or the ``files`` that
    hold staged keys, in place.
    ``on_gone`` says what happens when the increment lacks other columns of the target: ``fail``, or
    ``drop`` them from the table.
    """

    where: str
    merge: bool = False
    merge_key: tuple[str, ...] | None = None
    compact_after_load: bool = False
    select_from_staging: tuple[str, ...] = ()
    append_only: bool = False
    custom_fields: tuple[str, ...] = ()
    on_gone: str = "fail"
    rewrite: str = "table"

    def __post_init__(self) -> None:
        if self.rewrite not in ("table", "files"):
            raise ValueError(f"rewrite must be table or files, not {self.rewrite!r}")
        if self.on_gone not in ("fail", "drop"):
            raise ValueError(f"on_gone must be fail or drop, not {self.on_gone!r}")
        if not self.where.strip():
            raise ValueError("an incremental load needs a where condition")


@dataclass(frozen=True)
class LoadSpec:
    """Load settings of one table.

    ``read_partitions`` is the parallelism of the source read, ``write_partitions`` that of the
    write; equal values save the shuffle between the two.
    """

    split: bool = True
    overwrite: bool | None = None
    incremental: IncrementalSpec | None = None
    read_partitions: int | None = None
    write_partitions: int | None = None

    @property
    def mode(self) -> str:
        """An explicit ``overwrite`` wins; otherwise only full loads overwrite."""
        overwrite = self.incremental is None if self.overwrite is None else self.overwrite
        return "overwrite" if overwrite else "append"

    def action(self, spec: TableSpec) -> str:
        """``overwrite``, ``append`` or ``merge`` for this table."""
        inc = self.incremental
        if self.mode == "overwrite" or inc is None or inc.append_only or not inc.merge:
            return self.mode
        if not self.merge_key(spec):
            raise ValueError(f"{spec.name}: a merge needs a merge key or a primary key")
        return "merge"

    def merge_key(self, spec: TableSpec) -> tuple[str, ...]:
        given = self.incremental.merge_key if self.incremental else None
        return tuple(k.lower() for k in given) if given else spec.key
