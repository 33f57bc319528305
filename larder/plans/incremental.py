"""Gold from silver increments: only the movement folders that are new since the last run are read.

Silver movements are a versioned table that grows by data folders
(``streaming.silver`` or ``sources.tables.append_table``). Beside the gold table
stands the movement state, one row a product and 64-day word; its manifest
names the silver folders it has taken in, in the same switch as its rows, so a
run that dies anywhere is simply run again. If silver was replaced (a folder
the state knows is gone) the state is built anew from all folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.operators import features as G
from larder.sources import tables

STATE = "movement_state"
#: Property of the state: the silver folders it holds.
TAKEN = "taken"


def new_folders(spark: SparkSession, moves: str, state: str) -> tuple[list[str], list[str], bool]:
    """Silver folders to read, all silver folders, and whether the written state is kept."""
    version = tables.current(spark, moves)
    if version is None:
        raise ValueError(f"{moves} is not a versioned table")
    before = tables.current(spark, state)
    taken = before.properties.get(TAKEN, []) if before else []
    kept = before is not None and set(taken) <= set(version.folders)
    return [f for f in version.folders if not (kept and f in taken)], list(version.folders), kept


def fresh_state(spark: SparkSession, moves: str, folders: list[str], inventory: DataFrame) -> DataFrame:
    """The movement state of some silver folders (the plan scans those alone)."""
    trx = tables.read_table(spark, moves, folders=tuple(folders))
    return G.movement_state(G.gold_movements(G.prepare_inputs(trx, inventory, inventory)))


def update_state(spark: SparkSession, moves: str, state: str, inventory: DataFrame) -> DataFrame:
    """Bring the written state up to the silver movements and return it."""
    folders, names, kept = new_folders(spark, moves, state)
    if folders:
        merged = G.merge_states(fresh_state(spark, moves, folders, inventory),
                                *([tables.read_table(spark, state)] if kept else []))
        tables.replace_table(merged, state, {TAKEN: names})
    return tables.read_table(spark, state)


def incremental_gold(spark: SparkSession, silver: str, gold: str) -> DataFrame:
    """The gold feature table from the up-to-date state; equal to a full run over all silver movements."""
    silver, gold = silver.rstrip("/"), gold.rstrip("/")
    inv, sup = (tables.read_table(spark, f"{silver}/{n}") for n in ("grocery_inventory", "suppliers"))
    state = update_state(spark, f"{silver}/stock_transactions", f"{gold}/{STATE}", inv)
    trx = tables.read_table(spark, f"{silver}/stock_transactions")
    return G.gold_features(trx, inv, sup, summary=G.summary_from_state(state))

