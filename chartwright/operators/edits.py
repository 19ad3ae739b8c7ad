"""What turns one list into another, in order, and replays of it.

A list is at most a few thousand rows, so a group holds one list; lists are
spread over tasks by ``(market, playlist)``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartwright.operators.playlists import LIST_KEY

SCRIPT = "market string, playlist string, step int, op string, track_uri string, from_position int, to_position int"
LIST = "market string, playlist string, position int, track_uri string"


class ScriptError(ValueError):
    """A script does not fit the list that it is replayed on."""


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Indices of a longest increasing run of the (distinct) values, by patience piles."""
    tops: list[int] = []   # the last value of each pile
    piles: list[int] = []  # and its index
    below: list[int] = []  # for each value the top of the pile before, when it was laid
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        below.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[pile], piles[pile] = v, i
    run, i = [], piles[-1] if piles else -1
    while i >= 0:
        run.append(i)
        i = below[i]
    return run[::-1]


def _occurrences(uris: Sequence[str]) -> list[tuple[str, int]]:
    """Each track with which of its occurrences in the list it is."""
    seen: dict[str, int] = defaultdict(int)
    out = []
    for uri in uris:
        out.append((uri, seen[uri]))
        seen[uri] += 1
    return out


def script(old: Sequence[str], new: Sequence[str]) -> list[tuple[str, str, int | None, int | None]]:
    """(op, uri, from, to) steps that turn ``old`` into ``new``, with the fewest moves.

    Positions count from 1 and hold when the step is done.  Removals come
    first, from the end.  Tracks on a longest increasing run of old positions
    stay where they are; every other one goes right behind its predecessor.
    """
    before, after = _occurrences(old), _occurrences(new)
    place = {x: i for i, x in enumerate(before)}
    wanted = set(after)
    steps: list[tuple[str, str, int | None, int | None]] = []
    now = list(before)
    for i in range(len(now) - 1, -1, -1):
        if now[i] not in wanted:
            steps.append(("remove", now.pop(i)[0], i + 1, None))
    common = [x for x in after if x in place]
    stay = {common[i] for i in longest_increasing([place[x] for x in common])}
    previous = None
    for x in after:
        if x not in stay:
            if x in place:
                at = now.index(x)
                now.pop(at)
            to = now.index(previous) + 1 if previous is not None else 0
            now.insert(to, x)
            steps.append(("move", x[0], at + 1, to + 1) if x in place else ("add", x[0], None, to + 1))
        previous = x
    return steps


def replay(old: Sequence[str], steps: Sequence[tuple[str, str, int | None, int | None]]) -> list[str]:
    """The list after the steps."""
    now = list(old)
    for op, uri, start, to in steps:
        if op != "add" and (start is None or not 1 <= start <= len(now) or now.pop(int(start) - 1) != uri):
            raise ScriptError(f"{uri} is not at position {start}")
        if op != "remove":
            now.insert(int(to) - 1, uri)
    return now


def _lists(lists: DataFrame, uri_col: str) -> DataFrame:
    return lists.select(*LIST_KEY, F.col("position").cast("int").alias("position"), F.col(uri_col).alias("track_uri"))


def _key(*frames: pd.DataFrame) -> tuple:
    for frame in frames:
        if len(frame):
            return tuple(frame.iloc[0][list(LIST_KEY)])
    return (None, None)


def playlist_edit_script(old: DataFrame, new: DataFrame, uri_col: str = "track_uri") -> DataFrame:
    """Per list the removals, moves and additions, in order, that turn ``old`` into ``new``."""

    def edits(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        steps = script(*(list(f.sort_values("position")["track_uri"]) for f in (left, right)))
        rows = [(*_key(left, right), i, *s) for i, s in enumerate(steps, 1)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCRIPT.split(", ")], dtype=object)

    return _lists(old, uri_col).groupBy(*LIST_KEY).cogroup(_lists(new, uri_col).groupBy(*LIST_KEY)).applyInPandas(edits, SCRIPT)


def replay_script(old: DataFrame, steps: DataFrame, uri_col: str = "track_uri") -> DataFrame:
    """The lists (market, playlist, position, track_uri) that the script makes of ``old``."""

    def made(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        own = right.sort_values("step")
        todo = [(op, uri, *(None if pd.isna(x) else int(x) for x in ends)) for op, uri, *ends in
                own[["op", "track_uri", "from_position", "to_position"]].itertuples(index=False)]
        uris = replay(list(left.sort_values("position")["track_uri"]), todo)
        market, playlist = _key(left, right)
        rows = [(market, playlist, i, uri) for i, uri in enumerate(uris, 1)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in LIST.split(", ")], dtype=object)

    return _lists(old, uri_col).groupBy(*LIST_KEY).cogroup(steps.groupBy(*LIST_KEY)).applyInPandas(made, LIST)


def replay_batches(batches: DataFrame) -> DataFrame:
    """The lists (market, playlist, position, track_uri) that publishing the batches builds.

    A batch goes in at ``insert_at`` of the list as it is then.  Batches sent
    later at position 0 push earlier ones down, so a batch ends up behind the
    sizes of all later ones: a prefix sum in reverse sending order, over one
    row a batch.
    """
    if batches.filter(F.coalesce(F.col("insert_at") != 0, F.lit(True))).limit(1).count():
        raise ScriptError("batches are replayed at position 0 only")
    later = Window.partitionBy(*LIST_KEY).orderBy(F.desc("send_order")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = batches.select(*LIST_KEY, "uris", F.coalesce(F.sum(F.size("uris")).over(later), F.lit(0)).alias("_before"))
    return sizes.select(*LIST_KEY, "_before", F.posexplode("uris").alias("_at", "track_uri")).select(
        *LIST_KEY, (F.col("_before") + F.col("_at") + 1).cast("int").alias("position"), "track_uri")
