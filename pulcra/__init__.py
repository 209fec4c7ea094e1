"""pulcra: data-quality operators for related tables, as Spark DataFrame plans."""

from pulcra.config import Settings

__all__ = ["Settings"]
