"""Numbers, times and codes as the text a dashboard shows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code -> display text, and the text for a missing code.
RUNTIME_STATUS = {
    "running": "RUNNING",
    "stopped": "STOPPED",
    "stopping": "STOPPING",
    "error": "ERROR",
}
LABEL = {"normal": "Normal", "suspect": "Suspect"}
SEVERITY = {
    "critical": "Critique",
    "high": "Elevee",
    "medium": "Moyenne",
    "low": "Faible",
    "normal": "Normale",
    "info": "Info",
    "warning": "Avertissement",
}
ACTION = {
    "allow": "Autoriser",
    "alert_only": "Alerte",
    "block_dry_run": "Blocage",
    "block_system_stub": "Blocage",
    "block_enforce": "Blocage",
    "block": "Blocage",
    "observe": "Observation",
}
EVENT_STATUS = {
    "open": "Ouverte",
    "closed": "Fermee",
    "blocked": "Bloquee",
    "executed": "Executee",
    "simulated": "Simulee",
    "alert_only": "Alerte",
    "escalated": "Escaladee",
}
MISSING = {
    "runtime_status": "INCONNU",
    "label": "Inconnu",
    "severity": "Inconnue",
    "action": "-",
    "event_status": "-",
    "protocol": "-",
}


def _named(value: Column, names: dict[str, str], missing: str, otherwise: Column) -> Column:
    table = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    found = F.try_element_at(table, F.lower(F.trim(value)))
    return F.when(value.isNull(), missing).otherwise(F.coalesce(found, otherwise))


def runtime_status(value: Column) -> Column:
    return _named(value, RUNTIME_STATUS, MISSING["runtime_status"], F.upper(value))


def label(value: Column) -> Column:
    return _named(value, LABEL, MISSING["label"], value)


def severity(value: Column) -> Column:
    return _named(value, SEVERITY, MISSING["severity"], value)


def action(value: Column) -> Column:
    return _named(value, ACTION, MISSING["action"], value)


def event_status(value: Column) -> Column:
    return _named(value, EVENT_STATUS, MISSING["event_status"], value)


def protocol(value: Column) -> Column:
    return F.coalesce(F.upper(value), F.lit(MISSING["protocol"]))


def _fixed(value: Column, digits: int) -> Column:
    """Rounds the binary value half to even, without thousands separators."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def compact_number(value: Column) -> Column:
    whole = value.cast("string").try_cast("long")
    return F.coalesce(F.replace(F.format_number(whole, 0), F.lit(","), F.lit(" ")), F.lit("0"))


def percent(part: Column, whole: Column) -> Column:
    part, whole = part.try_cast("double"), whole.try_cast("double")
    text = F.replace(_fixed(part / whole * 100, 1), F.lit("."), F.lit(","))
    return F.concat(F.when(whole > 0, F.coalesce(text, F.lit("0,0"))).otherwise("0,0"), F.lit(" %"))


def score(value: Column) -> Column:
    return F.coalesce(_fixed(value.try_cast("double"), 2), F.lit("-"))


def clock(micros: Column) -> Column:
    """Time of day in UTC; needs a UTC session."""
    return F.coalesce(F.date_format(F.timestamp_micros(micros), "HH:mm:ss"), F.lit("-"))


def duration(seconds: Column) -> Column:
    total = seconds.try_cast("double").try_cast("long")
    hours = F.lpad((total / 3600).cast("long").cast("string"), 2, "0")
    wide = F.when(total >= 360_000, (total / 3600).cast("long").cast("string")).otherwise(hours)
    minutes = F.lpad(((total % 3600) / 60).cast("long").cast("string"), 2, "0")
    rest = F.lpad((total % 60).cast("string"), 2, "0")
    return F.coalesce(F.concat_ws(":", wide, minutes, rest), F.lit("-"))
