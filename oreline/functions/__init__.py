from oreline.functions.dates import int_date, int_date_between
from oreline.functions.envelope import decode_envelope, image_columns, stamp, to_bronze, undecodable, with_event_date
from oreline.functions.labels import grade_band

__all__ = [
    "decode_envelope",
    "grade_band",
    "image_columns",
    "int_date",
    "int_date_between",
    "stamp",
    "to_bronze",
    "undecodable",
    "with_event_date",
]
