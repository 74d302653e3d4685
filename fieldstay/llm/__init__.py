"""Operators that prepare text for model training: quality, safety, de-duplication, packing and files."""

import os

# Spark deals out the cores; linear algebra inside a task or beside the driver's JVM keeps to one thread.
for _name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
    os.environ.setdefault(_name, "1")
