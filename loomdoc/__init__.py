"""loomdoc: document preparation and chunk analytics expressed as Spark plans."""

__version__ = "0.1.0"
