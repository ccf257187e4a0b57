"""Operators for preparing training text. Nothing else in the library imports this package."""

import pyarrow

# Workers give memory back as soon as a batch is done; the default pool would keep it.
pyarrow.set_memory_pool(pyarrow.system_memory_pool())
