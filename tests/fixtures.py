"""Hand-built rows."""

from __future__ import annotations

from datetime import date

from playlens import schemas

DAY = date(2024, 1, 10)


def traffic(received):
    return (1, 1.0, received, received)


def routes(source, p2p):
    return (traffic(source), traffic(p2p))


def report(
    customer="C1", client="U1", server=1_704_880_000_000, count=1, ms=1000, source=600, p2p=400, levels=("720p",),
    content="V1", agent=None, day=DAY, rescued=None,
):
    spread = {name: routes(source, p2p) for name in levels} if levels is not None else None
    return (customer, content, client, (server, agent), (count, ms), routes(source, p2p), spread, day, rescued)


def bronze(spark, *reports):
    return spark.createDataFrame(list(reports), schemas.BRONZE)


def silver_row(client="U1", server=1, level="720p", count=1, ms=1000, source=1024, p2p=0, agent=None, day=DAY, content="V1"):
    mb = (source + p2p) / 1048576.0
    return ("C1", content, client, server, agent, count, ms, ms / 1000.0, level, 1, source, 1, p2p, mb, source, p2p, mb, day)


def silver(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SILVER)


SIGNAL_DDL = (
    "playbackSessionId string, sequenceNumber bigint, event_timestamp bigint, eventType string, bitrateBps bigint,"
    " resolution string, droppedFrames bigint, currentTimeSec double, bytes bigint"
)


def signals(spark, *marks, session="s"):
    """(type, timestamp[, bitrate, dropped]) in order; the sequence number is the position."""
    rows = []
    for seq, mark in enumerate(marks):
        kind, at, *more = mark
        bitrate, dropped = (more + [None, None])[:2]
        rows.append((session, seq, at, kind, bitrate, f"{bitrate}p" if bitrate else None, dropped, 10.0, 100))
    return spark.createDataFrame(rows, SIGNAL_DDL)
