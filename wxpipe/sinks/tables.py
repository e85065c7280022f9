"""Full refresh of stored tables: write beside the target, then swap."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..staging import Staging
from ..storage import add_text, delete, exists, make_folder, move, names_in, read_text

_JOURNAL = "_swap."


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put the finished folder ``staged`` in the place of ``target``."""
    swap_all(spark, {staged: target})


def swap_all(spark: SparkSession, moves: Mapping[str, str]) -> None:
    """Put finished folders (keys) in the places of others (values), all or none.

    All targets lie in one folder, on one file system. Before anything is moved, what will move
    where is written to a journal beside the targets, in one piece: from then on the swap counts
    as done. :func:`current` gives readers the new content although it may not be in place yet,
    and :func:`recover` (which every later swap calls) finishes what a dead process left. Old
    content is set aside, not deleted, until the last new one is in place; if a move fails while
    this process lives, all of it comes back and the journal goes. Where a rename copies, as on
    object stores, a swap is not quick.
    """
    moves = {k.rstrip("/"): v.rstrip("/") for k, v in moves.items()}
    parents = {target.rsplit("/", 1)[0] for target in moves.values()}
    if len(parents) > 1:
        raise ValueError(f"targets of one swap must share a folder: {sorted(parents)}")
    if not moves:
        return
    parent = parents.pop()
    recover(spark, moves.values())
    absent = [staged for staged in moves if not exists(spark, staged)]
    if absent:
        raise FileNotFoundError(f"nothing to swap in at {absent}")
    make_folder(spark, parent)
    replaced = [target for target in moves.values() if exists(spark, target)]
    if not replaced and len(moves) == 1:
        for staged, target in moves.items():
            move(spark, staged, target)
        return

    mark = uuid.uuid4().hex
    plan = []
    for staged, target in moves.items():
        # Readers skip names that start with "_" and hold no "=": what was set aside is not
        # taken for a table or a partition.
        name = target.rsplit("/", 1)[1].replace("=", "-")
        plan.append([staged, target, f"{parent}/_old-{mark}-{name}"])
    journal = f"{parent}/{_JOURNAL}{mark}"
    add_text(spark, journal, json.dumps(plan))
    try:
        _forward(spark, plan)
    except BaseException:
        _undo(spark, plan)
        delete(spark, journal)
        raise
    _finish(spark, plan, journal)


def _forward(spark: SparkSession, plan: list[list[str]]) -> None:
    """Carry out what is left of a plan, whatever part of it was done before."""
    for staged, target, aside in plan:
        if exists(spark, staged):
            if exists(spark, target):
                move(spark, target, aside)
            move(spark, staged, target)
        elif not exists(spark, target) and exists(spark, aside):
            move(spark, aside, target)


def _undo(spark: SparkSession, plan: list[list[str]]) -> None:
    for staged, target, aside in reversed(plan):
        if not exists(spark, staged):
            move(spark, target, staged)
        if exists(spark, aside):
            move(spark, aside, target)


def _finish(spark: SparkSession, plan: list[list[str]], journal: str) -> None:
    for _, _, aside in plan:
        if exists(spark, aside):
            delete(spark, aside)
    delete(spark, journal)


def _journals(spark: SparkSession, targets: Iterable[str]) -> Iterable[tuple[str, list]]:
    wanted = {target.rstrip("/") for target in targets}
    for parent in {target.rsplit("/", 1)[0] for target in wanted}:
        for name in names_in(spark, parent):
            if name.startswith(_JOURNAL):
                plan = json.loads(read_text(spark, f"{parent}/{name}"))
                if wanted & {target for _, target, _ in plan}:
                    yield f"{parent}/{name}", plan


def recover(spark: SparkSession, targets: Iterable[str]) -> int:
    """Finish interrupted swaps of ``targets``; how many there were.

    For the writer of the targets, of which there is one at a time.
    """
    found = list(_journals(spark, targets))
    for journal, plan in found:
        _forward(spark, plan)
        _finish(spark, plan, journal)
    return len(found)


def current(spark: SparkSession, target: str) -> str:
    """Where the content of ``target`` is now: elsewhere only in the middle of a swap."""
    for _, plan in _journals(spark, [target]):
        for staged, place, _ in plan:
            if place == target.rstrip("/") and exists(spark, staged):
                return staged
    return target


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> None:
    """Refresh the tables below ``folder`` together.

    Every table is written in full before the first is swapped, so a failing job leaves all
    old tables as they were, and so does a failing swap. First runs, with nothing to replace,
    are no special case.
    """
    folder = folder.rstrip("/")
    recover(spark, [f"{folder}/{name}" for name in tables])
    with Staging(spark, folder) as staging:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(staging.path(name))
        swap_all(spark, {staging.path(n): f"{folder}/{n}" for n in tables})
