"""Makes this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers once an application, unless they find it by PYTHONPATH or as an installed one."""
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if _ROOT in paths or "site-packages" in _ROOT or context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="tidewire-")
    target = os.path.join(folder, "tidewire.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for where, _, names in os.walk(os.path.join(_ROOT, "tidewire")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    z.write(full, os.path.relpath(full, _ROOT))
    context.addPyFile(target)
    _shipped[context.applicationId] = target
