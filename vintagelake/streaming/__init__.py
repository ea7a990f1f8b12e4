from vintagelake.streaming.landing import compact, land, land_keyed, landed_days, landed_keys, payload_stream, read_landed

__all__ = ["compact", "land", "land_keyed", "landed_days", "landed_keys", "payload_stream", "read_landed"]
