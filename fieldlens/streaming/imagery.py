"""New imagery watcher: an area whose two dates are both present (or one of them newly replaced) is due."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fieldlens.schemas import MANIFEST
from fieldlens.session import ship_package

PAIRS = "aoi STRING, t0_item STRING, t1_item STRING"
_STATE = "t0 STRING, t1 STRING, done STRING"


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(MANIFEST).json(path)


def _pair_up(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """State per area: the item of each date and the pair last reported."""
    held = dict(zip(("t0", "t1", "done"), state.get)) if state.exists else {"t0": "", "t1": "", "done": ""}
    for pdf in batches:
        for label, item in zip(pdf["t_label"], pdf["stac_item_id"]):
            if label in ("t0", "t1"):
                held[label] = item or "?"
    pair = f"{held['t0']}|{held['t1']}"
    due = bool(held["t0"] and held["t1"]) and pair != held["done"]
    if due:
        held["done"] = pair
    state.update((held["t0"], held["t1"], held["done"]))
    if due:
        yield pd.DataFrame({"aoi": [key[0]], "t0_item": [held["t0"]], "t1_item": [held["t1"]]})


def complete_pairs(manifests: DataFrame) -> DataFrame:
    """Each newly completed pair of dates once."""
    ship_package(manifests.sparkSession)
    return (
        manifests.select("aoi", "t_label", "stac_item_id").groupBy("aoi")
        .applyInPandasWithState(_pair_up, PAIRS, _STATE, "append", GroupStateTimeout.NoTimeout)
    )


def start_watcher(
    manifests: DataFrame, on_pairs: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Call ``on_pairs`` with the due areas of every micro-batch (detection then emits its event)."""
    writer = complete_pairs(manifests).writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_pairs)
    return (writer.trigger(availableNow=True) if once else writer).start()
