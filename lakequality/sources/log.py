"""Message logs as streams."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)


def kafka_options(
    servers: str,
    topic: str,
    *,
    starting: str = "latest",
    max_offsets: int | None = None,
    consumer_group: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source: where to start and how much to take per batch."""
    if starting not in ("latest", "earliest") and not starting.startswith("{"):
        raise ValueError("starting must be 'latest', 'earliest' or offsets as JSON")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if consumer_group:
        options["kafka.group.id"] = consumer_group
    return {**options, **(extra or {})}


def read_log(
    spark: SparkSession,
    options: Mapping[str, str] | Sequence[Mapping[str, str]],
    format: str = "kafka",
) -> DataFrame:
    """The log as a stream; with several option sets, the first that the source accepts."""
    candidates = [options] if isinstance(options, Mapping) else list(options)
    for position, candidate in enumerate(candidates):
        try:
            return spark.readStream.format(format).options(**candidate).load()
        except AnalysisException as refused:
            logger.warning("option set %d was refused: %s", position, refused)
            if position == len(candidates) - 1:
                raise
    raise ValueError("no options given")
