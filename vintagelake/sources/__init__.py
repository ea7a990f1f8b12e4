from vintagelake.sources import dims, payloads, tables

__all__ = ["dims", "payloads", "tables"]
