"""Make the package importable in Python workers, wherever the driver was started."""

from recensio.session import ship

__all__ = ["ship"]
