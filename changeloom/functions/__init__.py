from changeloom.functions.columns import evaluated_once
from changeloom.functions.time import TIMESTAMP_FORMAT, change_order, with_date

__all__ = ["TIMESTAMP_FORMAT", "change_order", "evaluated_once", "with_date"]
