"""One thread for numpy's matrix products: tasks share their cores, and on a busy machine the library's waiting threads can stall."""

from __future__ import annotations

import ctypes
from pathlib import Path

import numpy as np


def one_thread() -> bool:
    """True if the bundled library took the setting; where there is none, OMP_NUM_THREADS has to be set outside."""
    for path in (Path(np.__file__).parent.parent / "numpy.libs").glob("*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                return True
    return False


one_thread()
