"""Command line: ``spark-submit`` or ``python -m retailloom <command> settings.json``.

Commands: ``intake`` takes new invoices, orders, finance rows and movements to landing files, ``batch [step ...]``
runs the batch (all steps, or the named ones), ``publish`` sends files of sales and movements to their topics, ``land``
takes what the topics have got since to landing files, ``late`` shows stored days whose sales changed, ``repair`` makes the
periods that hold such days anew, ``rebuild`` all periods and cubes, ``reset`` empties the warehouse, ``dashboard`` and
``alerts`` run the live jobs.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from datetime import date

from retailloom.plans import jobs
from retailloom.plans.publish import InVietnamese
from retailloom.schemas import INVENTORY_TOPIC, LANDING, MOVEMENT_LANDING, SALES_TOPIC
from retailloom.session import session
from retailloom.sinks.stores import Jdbc, Lake
from retailloom.sources.kafka import topic_stream
from retailloom.streaming import intake
from retailloom.streaming.ingest import land_topic, rebuild_cubes
from retailloom.streaming.live import LOSS_THRESHOLD, start_alerts, start_dashboard, watched


def target(settings: dict | None):
    """``{"lake": folder}`` or ``{"jdbc": url, "properties": {...}}``."""
    if not settings:
        return None
    if "lake" in settings:
        return Lake(settings["lake"])
    return Jdbc(settings["jdbc"], settings.get("properties", {}), settings.get("connections", 8))


def read_settings(path: str) -> tuple[jobs.Config, dict]:
    """The warehouse's places, and the ``live`` settings of the streaming jobs."""
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    live = settings.pop("live", {})
    settings["target"] = target(settings.get("target"))
    settings["snapshot_date"] = date.fromisoformat(settings.get("snapshot_date") or date.today().isoformat())
    return jobs.Config(**settings), live


def take_all(spark, cfg: jobs.Config, live: dict) -> None:
    """``live["intake"]`` names the invoices' folder as ``tills``, or the database as ``jdbc`` and ``properties``."""
    places, marks = live["intake"], Lake(cfg.lake)
    if "tills" in places:
        intake.take_invoices(spark, places["tills"], cfg.landing, f"{cfg.checkpoint}/tills", cfg.files_per_batch)
    if "jdbc" in places:
        for name, normalise in intake.NORMALISED.items():
            feed = intake.database_table(spark, name, places["jdbc"], places.get("properties", {}), normalise)
            intake.take_table(spark, feed, cfg.movements if name == "kho_chuyendong" else cfg.landing, marks)


def publish_all(spark, cfg: jobs.Config, live: dict) -> None:
    """``live["outbox"]`` names the folders of clean ``sales`` and ``movements``."""
    for name, schema in (("sales", LANDING), ("movements", MOVEMENT_LANDING)):
        if name in live["outbox"]:
            intake.publish_folder(spark, live["outbox"][name], schema, live["servers"], f"{cfg.checkpoint}/publish-{name}",
                                  cfg.files_per_batch)


def land_all(spark, cfg: jobs.Config, live: dict) -> None:
    for topic, folder in ((SALES_TOPIC, cfg.landing), (INVENTORY_TOPIC, cfg.movements)):
        messages = topic_stream(spark, live["servers"], topic, "earliest")
        land_topic(messages, folder, f"{cfg.checkpoint}/land-{topic}").awaitTermination()


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="retailloom", description=__doc__)
    parser.add_argument("command", choices=(
        "intake", "batch", "publish", "land", "late", "repair", "rebuild", "reset", "dashboard", "alerts"))
    parser.add_argument("settings")
    parser.add_argument("steps", nargs="*")
    given = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    cfg, live = read_settings(given.settings)
    spark = session()
    if given.command == "intake":
        take_all(spark, cfg, live)
        return 0
    if given.command in ("publish", "land"):
        (publish_all if given.command == "publish" else land_all)(spark, cfg, live)
        return 0
    if given.command == "batch":
        results = jobs.run(spark, cfg, given.steps or None)
        for name, result in results.items():
            print(name, "ok" if result.ok else f"failed: {result.error}", result.rows)
        return 0 if all(result.ok for result in results.values()) else 1
    if given.command == "late":
        jobs.late_days(spark, cfg).orderBy("period").show()
    elif given.command == "repair":
        print("repaired", jobs.repair_periods(spark, cfg))
    elif given.command == "rebuild":
        rebuild_cubes(spark, cfg.table("sales"), Lake(cfg.lake))
        jobs.rebuild_periods(spark, cfg)
    elif given.command == "reset":
        jobs.reset(spark, cfg)
    else:
        messages = topic_stream(spark, live["servers"])
        threshold = live.get("threshold", LOSS_THRESHOLD)
        if given.command == "dashboard":
            shown = InVietnamese(cfg.target) if cfg.in_vietnamese else cfg.target
            query = start_dashboard(messages, shown, f"{cfg.checkpoint}/dashboard", threshold)
        else:
            query = start_alerts(messages, f"{cfg.checkpoint}/alerts", threshold)
        with watched(spark) as pace:
            try:
                query.awaitTermination()
            finally:
                logging.info("pace of the stream: %s", pace.summary())
    return 0


if __name__ == "__main__":
    sys.exit(main())
