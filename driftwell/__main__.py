"""Run the ingest and gold streams: ``python -m driftwell --source kafka --servers ... --root ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from driftwell.session import configure
from driftwell.sources.streams import (
    dead_letters_to_kafka,
    file_messages,
    kafka_messages,
    new_event_stream,
    silver_stream,
)
from driftwell.sources.tables import Tables
from driftwell.streaming.alerts import STREAMS, start_alert
from driftwell.streaming.ingest import start_ingest
from driftwell.streaming.windows import start_gold, start_panes


def main(argv: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(prog="driftwell", description="Telemetry streams into tables.")
    options.add_argument("--source", choices=["files", "kafka"], default="files")
    options.add_argument("--path", help="folder of message files")
    options.add_argument("--servers", help="Kafka bootstrap servers")
    options.add_argument("--topic", help="Kafka topic")
    options.add_argument("--dead-letter-topic", help="Kafka topic that also gets the quarantine messages")
    options.add_argument("--root", required=True, help="folder of the result tables")
    options.add_argument("--checkpoints", required=True, help="folder of the stream checkpoints")
    options.add_argument("--once", action="store_true", help="process what is there, then stop")
    options.add_argument("--debug", action="store_true", help="write the debug tables too")
    chosen = options.parse_args(argv)

    spark = configure(SparkSession.builder.appName("driftwell").getOrCreate())
    tables = Tables(spark, chosen.root).create(chosen.debug)
    if chosen.source == "kafka":
        messages = kafka_messages(spark, chosen.servers, chosen.topic)
    else:
        messages = file_messages(spark, chosen.path)
    trigger = {"availableNow": True} if chosen.once else {"processingTime": "1 minute"}
    send = dead_letters_to_kafka(chosen.servers, chosen.dead_letter_topic) if chosen.dead_letter_topic else None
    ingest = start_ingest(
        messages,
        tables,
        f"{chosen.checkpoints}/ingest",
        debug=chosen.debug,
        send_dead_letters=send,
        **trigger,
    )
    if chosen.once:
        ingest.awaitTermination()
    started = [
        start_gold(silver_stream(spark, tables.path("silver")), tables, f"{chosen.checkpoints}/gold", **trigger),
        start_panes(new_event_stream(spark, tables.path("new_events")), tables, f"{chosen.checkpoints}/panes", **trigger),
        *[start_alert(name, tables, f"{chosen.checkpoints}/{name}", **trigger) for name in STREAMS],
    ]
    if chosen.once:
        for query in started:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
