from vintagelake.operators import aggregate, calendar, combine, horizon, joins, limits, reshape, rollup

__all__ = ["aggregate", "calendar", "combine", "horizon", "joins", "limits", "reshape", "rollup"]
