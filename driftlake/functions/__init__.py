from driftlake.functions.casts import epoch_millis, lenient_bigint, lenient_cast
from driftlake.functions.payload import normalize_value, pack_record

__all__ = ["epoch_millis", "lenient_bigint", "lenient_cast", "normalize_value", "pack_record"]
