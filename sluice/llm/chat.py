"""Chat formatting: minimum-cost repair of roles by dynamic programming over legal turns.

Legal conversations: a system turn or none, then user and assistant in turn, the user first. Each turn
is kept, given another role, or merged into the turn before it; empty turns may be inserted
before it and behind the last one. The cheapest way is found over the states "nothing yet", "system
spoke", "user spoke", "assistant spoke" and then rendered. Of ways that cost the same, the one with fewer
insertions, then keeping before merging before relabelling, then the earlier state counts.

Turns are dealt in ranges of conversation and turn, so a task holds its share of the turns however
many one conversation has. A conversation cut by such ranges is repaired in pieces: each piece is
summed up as the least cost from any state to any other, these are chained from the first
piece on, and from the last one back, which gives the same way as in one piece.

Turns are in the order of ``turn`` (NULL last), then of a hash of role and text. Roles are compared in
lower case without blanks around; other roles and NULL are unknown and must get one. NULL texts are empty.
A row without ``conv_id`` is a conversation of its own. Repeated rows are turns each. Markers in
texts are broken by a blank, so that they cannot open or end a turn. Texts are rendered whole, of any length. An
empty table gives no rows; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored

ROLES = ("system", "user", "assistant")
#: The state behind a turn is the place of its role, from 1; 0 is the start.
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
ENDS = (2, 3)
MERGE, RELABEL, NAME, INSERT = 1, 2, 1, 3
KEPT, MERGED, RELABELLED = "keep", "merge", "relabel"
ORDER = (KEPT, MERGED, RELABELLED)
FAR = 1 << 40
OUT = (
    "conv_id long, turn long, position long, role string, action string, new_role string,"
    " inserted array<string>, inserted_behind array<string>, rendered string"
)


def inserted() -> dict[tuple[int, int], tuple[int, ...]]:
    """The shortest insertions that lead from a state to another (none where that is the same)."""
    ways: dict[tuple[int, int], tuple[int, ...]] = {(s, s): () for s in NEXT}
    for _ in range(len(NEXT)):
        for (a, b), way in list(ways.items()):
            for c in NEXT[b]:
                if (a, c) not in ways:
                    ways[a, c] = (*way, c)
    return ways


INSERTED = inserted()


def steps(role: int) -> dict[tuple[int, int], tuple[int, tuple[int, ...], str]]:
    """For a turn of this role (0: unknown): the cheapest (cost, insertions, action) between states."""
    best: dict = {}
    change = RELABEL if role else NAME

    def offer(a: int, b: int, cost: int, way: tuple, action: str) -> None:
        old = best.get((a, b))
        new = (cost + INSERT * len(way), way, action)
        if old is None or (new[0], len(way), ORDER.index(action)) < (old[0], len(old[1]), ORDER.index(old[2])):
            best[a, b] = new

    for (a, middle), way in INSERTED.items():
        for b in NEXT[middle]:
            offer(a, b, 0 if b == role else change, way, KEPT if b == role else RELABELLED)
        if middle:
            offer(a, middle, MERGE + (0 if middle == role else change), way, MERGED)
    return best


STEPS = [steps(role) for role in range(len(ROLES) + 1)]
COSTS = np.full((len(STEPS), len(NEXT), len(NEXT)), FAR, np.int64)
for _role, _steps in enumerate(STEPS):
    for (_a, _b), _step in _steps.items():
        COSTS[_role, _a, _b] = _step[0]
#: What it costs to end in a state.
LAST = np.array([min(INSERT * len(INSERTED[s, e]) for e in ENDS if (s, e) in INSERTED) for s in NEXT], np.int64)
START = np.array([0, FAR, FAR, FAR], np.int64)


def role_of(role: str | None) -> int:
    name = role.strip().lower() if isinstance(role, str) else ""
    return ROLES.index(name) + 1 if name in ROLES else 0


def forward(roles: list[int], costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The costs of all states behind the turns, and for every turn the state before by that behind."""
    back = np.zeros((len(roles), len(NEXT)), np.int8)
    for place, role in enumerate(roles):
        ways = costs[:, None] + COSTS[role]
        back[place] = ways.argmin(axis=0)
        costs = np.minimum(ways.min(axis=0), FAR)
    return costs, back


def chained(roles: list[int]) -> np.ndarray:
    """The least cost from every state to every other over the turns."""
    return np.array([forward(roles, np.where(np.arange(len(NEXT)) == s, 0, FAR))[0] for s in NEXT])


def backward(back: np.ndarray, state: int) -> list[int]:
    """The states before, between and behind the turns that end in ``state``."""
    way = [state]
    for row in back[::-1]:
        way.append(int(row[way[-1]]))
    return way[::-1]


def end_of(costs: np.ndarray) -> int:
    return int((costs + LAST).argmin())


def turn_text(state: int, text: str) -> str:
    return f"<|{ROLES[state - 1]}|>\n{text.replace('<|', '< |')}"


def rendered(roles: list[int], way: list[int], texts: list[str], first: bool, last: bool) -> Iterator[tuple]:
    """For each turn its action, new role, insertions before and behind, and the text that it adds."""
    for place, (role, text) in enumerate(zip(roles, texts)):
        a, b = way[place], way[place + 1]
        _, before, action = STEPS[role][a, b]
        opened = [turn_text(s, "") for s in before]
        if action == MERGED:
            body = f"\n{text.replace('<|', '< |')}"
            if opened:
                body = "\n<|end|>\n" + "\n<|end|>\n".join(opened) + body
        else:
            body = "\n<|end|>\n".join([*opened, turn_text(b, text)])
            if not (first and place == 0):
                body = "\n<|end|>\n" + body
        behind: tuple = ()
        if last and place == len(roles) - 1:
            behind = INSERTED[b, min((e for e in ENDS if (b, e) in INSERTED), key=lambda e: len(INSERTED[b, e]))]
            body += "\n<|end|>\n" + "".join(f"{turn_text(s, '')}\n<|end|>\n" for s in behind)
        yield action, ROLES[b - 1], [ROLES[s - 1] for s in before], [ROLES[s - 1] for s in behind], body


def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The runs of equal (``key``, ``part``) in sorted rows."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        new = (batch["key"] != batch["key"].shift()) | (batch["part"] != batch["part"].shift())
        starts = np.flatnonzero(new.to_numpy())
        for a, b in zip(starts[:-1], starts[1:]):
            yield batch.iloc[a:b]
        rest = batch.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def gathered(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "part").sortWithinPartitions("key", "part", *SORTED)


SORTED = ("no_turn", "turn", "mark", "number")


def dealt(df: DataFrame) -> DataFrame:
    """The turns with the number ``part`` of the range they are in."""
    number = F.monotonically_increasing_id()
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        number.alias("number"),
    )
    rows = rows.withColumns(
        {
            "key": F.coalesce(F.col("conv_id").cast("string"), F.concat(F.lit("row "), F.col("number").cast("string"))),
            "no_turn": F.col("turn").isNull(),
            "mark": F.xxhash64("role", "text"),
        }
    )
    return stored(rows.repartitionByRange("key", *SORTED).withColumn("part", F.spark_partition_id()))


def cut_conversations(rows: DataFrame) -> DataFrame:
    """``key``, ``part``, ``entry`` (costs), ``exit`` (state), ``first``, ``last`` of every piece of the
    conversations that are cut: two of each range of turns at most."""
    pieces = rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    cut = stored(rows.join(F.broadcast(pieces.select("key")), "key"))

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches):
            costs = chained([role_of(r) for r in run["role"]])
            yield pd.DataFrame({"key": [run["key"].iloc[0]], "part": [run["part"].iloc[0]], "costs": [costs.ravel().tolist()]})

    def enter(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        costs, entries = START, []
        for piece in group["costs"]:
            entries.append(costs.tolist())
            costs = np.minimum((costs[:, None] + np.reshape(piece, (len(NEXT), -1))).min(axis=0), FAR)
        return pd.DataFrame({"key": group["key"], "part": group["part"], "entry": entries, "ending": end_of(costs)})

    def lead_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches):
            back = forward([role_of(r) for r in run["role"]], np.array(run["entry"].iloc[0], np.int64))[1]
            out = {c: [run[c].iloc[0]] for c in ("key", "part", "entry", "ending")}
            yield pd.DataFrame(out | {"back": [[backward(back, s)[0] for s in NEXT]]})

    def leave(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        state, exits = int(group["ending"].iloc[0]), []
        for back in group["back"].iloc[::-1]:
            exits.append(state)
            state = int(back[state])
        out = group[["key", "part", "entry"]].assign(exit=exits[::-1], first=False, last=False)
        out.iloc[0, out.columns.get_loc("first")] = True
        out.iloc[-1, out.columns.get_loc("last")] = True
        return out

    kind = "key string, part int, entry array<long>"
    sums = gathered(cut).mapInPandas(sum_up, "key string, part int, costs array<long>")
    # Per conversation as many rows as there are ranges it lies in.
    entries = stored(sums.groupBy("key").applyInPandas(enter, f"{kind}, ending int"))
    backs = gathered(cut.join(entries, ["key", "part"])).mapInPandas(lead_back, f"{kind}, ending int, back array<int>")
    return stored(backs.groupBy("key").applyInPandas(leave, f"{kind}, exit int, first boolean, last boolean"))


def repair(df: DataFrame) -> DataFrame:
    """One row for every turn of ``df`` (``conv_id``, ``turn``, ``role``, ``text``): the action, the new
    role, roles of empty turns inserted before it and behind it, and its part of the rendered
    conversation, which is all parts in the order of ``position``."""
    rows = dealt(df)
    pieces = cut_conversations(rows)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []

        def frame() -> pd.DataFrame:
            made = pd.DataFrame(out, columns=[c.strip().split()[0] for c in OUT.split(",")])
            out.clear()
            return made.astype({"conv_id": "Int64", "turn": "Int64"})

        for run in runs(batches):
            roles = [role_of(r) for r in run["role"]]
            whole = not isinstance(run["entry"].iloc[0], (list, np.ndarray))
            entry = START if whole else np.array(run["entry"].iloc[0], np.int64)
            costs, back = forward(roles, entry)
            way = backward(back, end_of(costs) if whole else int(run["exit"].iloc[0]))
            ends = (True, True) if whole else (bool(run["first"].iloc[0]), bool(run["last"].iloc[0]))
            made = rendered(roles, way, run["text"].tolist(), *ends)
            base = int(run["part"].iloc[0]) << 32
            for place, (conv_id, turn, role, new) in enumerate(zip(run["conv_id"], run["turn"], run["role"], made)):
                conv_id, turn = (None if pd.isna(x) else int(x) for x in (conv_id, turn))
                out.append((conv_id, turn, base + place, role, new[0], new[1], *new[2:]))
            if len(out) >= 5000:
                yield frame()
        yield frame()

    # Two pieces of each range of turns at most.
    marked = rows.join(F.broadcast(pieces), ["key", "part"], "left")
    return gathered(marked).mapInPandas(write, OUT)
