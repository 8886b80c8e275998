from monthwise.sources.tables import SCHEMAS, Sources

__all__ = ["SCHEMAS", "Sources"]
