"""Give Python workers this package; the general helper under the name used here."""

from retailtide.workers import ship

__all__ = ["ship"]
