"""Seen-state per entity over a stream of updates, with finalisation."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kinlink.sources import tables

UPDATES = "s1 string, cand string, cycle int, accepted boolean, init boolean, finalize boolean, seq long"
OUT = "s1 string, event string, cand string, cycle int, accepted boolean, state string"
STATE = "cands array<string>, cycles array<int>, verdicts array<boolean>, phase string"
ACTIVE, FINAL = "active", "final"


class AlreadyActiveError(RuntimeError):
    """An entity was started that is under way."""


class AlreadyFinalizedError(RuntimeError):
    """An update came after its entity was finalised."""


def source(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """A stream of updates from the Parquet files that arrive in folder, some files to a micro-batch; UPDATES are its columns."""
    return spark.readStream.schema(UPDATES).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _line(key: str, seen: dict[str, tuple]) -> str:
    """An entity's finished state as a line of the state log: sorted ids, and ids by cycle as they came."""
    per_cycle: dict[str, list[str]] = {}
    for cand, (cycle, _) in seen.items():
        per_cycle.setdefault(str(cycle), []).append(cand)
    pick = lambda verdict: sorted(c for c, (_, v) in seen.items() if v == verdict)
    return json.dumps({key: {"accepted": pick(True), "rejected": pick(False), "per_cycle": per_cycle}}, ensure_ascii=False)


def _updates(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    cands, cycles, verdicts, phase = state.get if state.exists else ([], [], [], "")
    seen = {c: (n, v) for c, n, v in zip(cands or (), cycles or (), verdicts or (), strict=True)}
    out = []
    # all of the micro-batch's updates, in order: it may come in several pieces
    for u in pd.concat(list(batches)).sort_values("seq", kind="stable").itertuples():
        value = lambda x, of: None if pd.isna(x) else of(x)
        told = (value(u.cand, str), value(u.cycle, int), value(u.accepted, bool))
        if phase == FINAL:
            out.append((key[0], "late", *told, None))
        elif value(u.init, bool):
            if phase == ACTIVE:
                out.append((key[0], "active", None, None, None, None))
            phase = ACTIVE
        elif value(u.finalize, bool):
            out.append((key[0], "finalized", None, None, None, _line(key[0], seen)))
            phase, seen = FINAL, {}  # only the flag stays, so that late updates are told apart
        elif None in told:
            out.append((key[0], "malformed", *told, None))
        else:
            phase = ACTIVE
            if told[0] not in seen:
                seen[told[0]] = told[1:]
                out.append((key[0], "seen", *told, None))
    state.update((list(seen), [n for n, _ in seen.values()], [v for _, v in seen.values()], phase))
    yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")], dtype=object)


def track(updates: DataFrame) -> DataFrame:
    """Stream of (s1, event, cand, cycle, accepted, state).

    updates: UPDATES, of which init may be absent. Events: 'seen' for the first update of a candidate, within and across
    micro-batches, which starts an entity too; 'finalized' with the entity's state as a line of the state log; 'late' for
    whatever comes after that; 'active' for an init of an entity under way; 'malformed' for an update with a null candidate,
    cycle or verdict. Repeated updates give none. State and output commit together through the checkpoint.
    """
    if "init" not in updates.columns:
        updates = updates.withColumn("init", F.lit(False))
    return updates.groupBy("s1").applyInPandasWithState(_updates, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def raise_late(events: DataFrame) -> None:
    """For foreachBatch: fail the batch if it has late updates, entities started twice or malformed updates."""
    kinds = {"late": AlreadyFinalizedError, "active": AlreadyActiveError, "malformed": TypeError}
    wrong = events.where(F.col("event").isin(*kinds)).select("event", "s1").first()
    if wrong:
        raise kinds[wrong[0]](wrong[1])


def keep(events: DataFrame, log: str, checkpoint: str, strict: bool = True) -> StreamingQuery:
    """Start writing finished states to the log; each micro-batch has a file set of its own, so a replayed one replaces it. strict: errors end the stream."""

    def each(batch: DataFrame, number: int) -> None:
        if strict:
            raise_late(batch)
        lines = batch.where("event = 'finalized'").select(F.col("state").alias("value"))
        tables.written(lambda: lines.write.mode("overwrite").text(f"{log}/batch={number}"), log)

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
