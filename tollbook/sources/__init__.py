"""Sources."""

from .files import check_paytype_map, read_cdr, read_cdr_stream, read_paytype_map
from .object_store import s3a_conf
from .paytype_map import PaytypeMaps
from .schema import CDR_SCHEMA

__all__ = ["CDR_SCHEMA", "PaytypeMaps", "check_paytype_map", "read_cdr", "read_cdr_stream", "read_paytype_map", "s3a_conf"]
