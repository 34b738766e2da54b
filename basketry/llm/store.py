"""Where jobs keep intermediate tables: the shared folder named in ``spark.checkpoint.dir``."""

from __future__ import annotations

from basketry.sources.scratch import dropped
from basketry.sources.scratch import written as kept

__all__ = ["dropped", "kept"]
