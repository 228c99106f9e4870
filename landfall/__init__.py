"""landfall: a metadata-driven ELT toolkit on Spark DataFrames.

* ``functions``  – column-level helpers (snake_case, run window, lists, typed decode)
* ``operators``  – DataFrame operators (upsert, renames, validation, paging)
* ``sources``    – JDBC and catalog-table sources, staged batches, snapshot writes
* ``plans``      – the pipelines: init, land, stage, audit log, control listing
* ``streaming``  – the incremental load driven by a change stream
* ``domains``    – per-domain transforms, control seeds and routing
"""

from . import functions, operators, plans, sources, streaming  # noqa: F401
from .operators import upsert  # noqa: F401
from .session import build_session, ensure_checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
