from marketpulse.sinks.append import land_bronze, land_quarantine, read_folders
from marketpulse.sinks.audit import append_audit, audit_by_day
from marketpulse.sinks.daily import read_days, replace_days, replace_folders

__all__ = [
    "append_audit", "audit_by_day", "land_bronze", "land_quarantine", "read_days", "read_folders",
    "replace_days", "replace_folders",
]
