from monthlake.functions.dates import EVENT_DATE_FORMAT, event_time, falls_in

__all__ = ["EVENT_DATE_FORMAT", "event_time", "falls_in"]
