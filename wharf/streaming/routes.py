"""Bridge and relay as streaming queries.

A micro-batch's offsets are committed only after its sink has finished: publish, then ack.
What was not committed is read again after a restart, so delivery is at least once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wharf.operators import routing
from wharf.session import settle

# A sink makes a writer from (messages, checkpoint folder).
Sink = Callable[[DataFrame, str], DataStreamWriter]


def intake(
    trigger_seconds: float | None = None,
    max_offsets: int | None = None,
    max_files: int | None = None,
) -> tuple[dict[str, str], dict[str, object]]:
    """Source options and trigger arguments that bound what one micro-batch takes in.

    Without ``trigger_seconds`` the query works through what is there and stops.
    """
    options = {}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if max_files is not None:
        options["maxFilesPerTrigger"] = str(max_files)
    if trigger_seconds is None:
        return options, {"availableNow": True}
    return options, {"processingTime": f"{trigger_seconds} seconds"}


def _start(
    messages: DataFrame, sink: Sink, checkpoint: str, name: str, trigger: Mapping[str, object]
) -> StreamingQuery:
    return sink(messages, checkpoint).queryName(name).trigger(**trigger).start()


def bridge_together(
    messages: DataFrame,
    routes: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: Mapping[str, object],
    name: str = "bridge",
) -> StreamingQuery:
    """All bridge routes of one source in one query (stream-static join).

    The routes are settled at the start, so no micro-batch plans their checks again; a changed
    route takes effect when the query is started again.
    """
    return _start(routing.fan_in(messages, settle(routes)), sink, checkpoint, name, trigger)


def bridge_each(
    source: Callable[[str], DataFrame],
    routes: Iterable[Row],
    sink: Sink,
    checkpoint: str,
    trigger: Mapping[str, object],
) -> list[StreamingQuery]:
    """One query per route, each with its own checkpoint, so a failing one stops alone.

    ``source`` gives the message stream of a source topic.
    """
    started = []
    for route in routes:
        stamped = routing.stamp_bridge(
            source(route.source_topic),
            F.lit(route.source_id),
            F.lit(route.channel),
            F.lit(route.source_topic),
            F.lit(route.target_topic),
        )
        folder = f"{checkpoint}/{route.target_topic}"
        started.append(_start(stamped, sink, folder, f"bridge {route.target_topic}", trigger))
    return started


def relay_each(
    source: Callable[[str], DataFrame],
    routes: Iterable[Row],
    sink: Callable[[Row], Sink],
    checkpoint: str,
    trigger: Mapping[str, object],
) -> list[StreamingQuery]:
    """One query per destination route; a slow destination does not hold up the others."""
    started = []
    for route in routes:
        stamped = routing.stamp_relay(
            source(route.source_topic),
            F.lit(route.destination_id),
            F.lit(route.source_topic),
            F.lit(route.downstream_topic),
        )
        label = f"{route.destination_id}/{route.source_topic}"
        started.append(
            _start(stamped, sink(route), f"{checkpoint}/{label}", f"relay {label}", trigger)
        )
    return started


def finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait for queries that stop by themselves; the first failure is raised."""
    for query in queries:
        query.awaitTermination()
