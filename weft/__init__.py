"""weft: retrieval, routing and refinement over tables of text, as Spark DataFrame operators."""

__version__ = "0.1.0"
