"""User agents and peers: what their texts say, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest number of minutes, for peers that do not say when they were seen, and the version from which records are served.
NEVER, SERVES = 2**31 - 1, 1.041


def agent_location(agent: Column) -> Column:
    """What stands last in the first brackets of an agent, after the last semicolon; all of the brackets if that comes later; without brackets what follows the semicolon, or all."""
    opened, closed = F.instr(agent, "("), F.instr(agent, ")")
    semicolon = F.when(F.instr(agent, ";") == 0, 0).otherwise(F.length(agent) - F.instr(F.reverse(agent), ";") + 1)
    within = lambda a: F.when(closed > a, F.substring(agent, a + 1, closed - a - 1)).otherwise(F.substring(agent, a + 1, F.length(agent)))
    return F.when(semicolon < closed, F.trim(within(semicolon))).otherwise(F.trim(within(opened)))


def peer_version(version: Column) -> Column:
    """The number before the slash; 0 if there is none."""
    return F.when(F.instr(version, "/") > 0, F.coalesce(F.trim(F.split_part(version, F.lit("/"), F.lit(1))).try_cast("float"), F.lit(0.0).cast("float"))).otherwise(F.lit(0.0).cast("float"))


def serves_records(version: Column) -> Column:
    return peer_version(version) >= F.lit(SERVES).cast("float")


def minutes_unseen(lastseen: Column) -> Column:
    return F.coalesce(F.when(lastseen.rlike(r"^[+-]?[0-9]+$"), lastseen.try_cast("int")), F.lit(NEVER))


def seen_at(now: Column, lastseen: Column) -> Column:
    """The time when a peer was last seen, of the time at which it said so."""
    return F.timestamp_seconds(F.unix_timestamp(now) - minutes_unseen(lastseen).cast("long") * 60)
