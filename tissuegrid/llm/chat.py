"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn, ending with the assistant. For every turn
a dynamic programme over the automaton of the last role chooses to keep it, relabel it, merge it into the turn before, or
put an empty turn in front; the cheapest repair is rendered.

A stretch of turns acts on the automaton as a matrix of costs from state to state, and such matrices multiply (least sum)
in any grouping. So a long conversation is worked on in stretches: matrices of the stretches, the states between them, then
the choices inside each; no task holds a whole conversation of unbounded length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.llm.mixing import numbered_within
from tissuegrid.runtime import cut_lineage

#: States: nothing yet, and the role of the last turn of the repaired conversation.
STATES = ("", "system", "user", "assistant")
ROLES = STATES[1:]
#: Legal next roles of each state.
NEXT = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
#: Costs: calling a turn by another role, taking a role that is not known as one, joining two turns, adding an empty turn.
RELABEL, ADOPT, MERGE, INSERT = 4.0, 1.0, 1.0, 3.0
#: Turns that a task works on together.
STRETCH = 512


def _known(role):
    r = F.lower(F.trim(F.col(role).cast("string")))
    return F.when(r.isin("human", "prompter"), "user").when(r.isin("gpt", "bot", "model", "ai"), "assistant").otherwise(r)


def _label_cost(role: str | None, target: str) -> float:
    return 0.0 if role == target else RELABEL if role in ROLES else ADOPT


def _steps() -> dict[str | None, list[tuple[float, int, int, str]]]:
    """For each kind of role the moves (cost, state before, state after, action) in order of preference for equal costs.

    Actions: "role" takes the turn as that role, "+added role" puts an empty turn in front, "&" merges it into the last turn.
    """
    out = {}
    for role in (*ROLES, None):
        moves = []
        for a, before in enumerate(STATES):
            for target in ROLES:
                cost, b = _label_cost(role, target), STATES.index(target)
                if target in NEXT[before]:
                    moves.append((cost, a, b, target))
                for added in NEXT[before]:
                    if target in NEXT[added]:
                        moves.append((cost + INSERT, a, b, f"+{added} {target}"))
            if before:
                moves.append((_label_cost(role, before) + MERGE, a, a, "&"))
        out[role] = moves
    return out


MOVES = _steps()


def _matrix(roles: list[str | None]) -> np.ndarray:
    """Least cost from each state before the turns to each state behind them."""
    best = np.where(np.eye(len(STATES), dtype=bool), 0.0, np.inf)
    for role in roles:
        new = np.full_like(best, np.inf)
        for cost, a, b, _ in MOVES[role]:
            np.minimum(new[:, b], best[:, a] + cost, out=new[:, b])
        best = new
    return best


#: What the end costs in each state: a user or system turn at the end gets an empty answer.
END = np.array([0.0, 2 * INSERT, INSERT, 0.0])


def _choices(roles: list[str | None], first: int, last: int) -> list[str]:
    """Actions of the cheapest way from state ``first`` to state ``last``."""
    cost, back = np.where(np.arange(len(STATES)) == first, 0.0, np.inf), []
    for role in roles:
        new, how = np.full(len(STATES), np.inf), [None] * len(STATES)
        for c, a, b, action in MOVES[role]:
            if cost[a] + c < new[b]:
                new[b], how[b] = cost[a] + c, (a, action)
        cost = new
        back.append(how)
    out, state = [], last
    for how in reversed(back):
        state, action = how[state]
        out.append(action)
    return out[::-1]


def _split(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, at, role, text, draw, place, stretch, whole): turns in order are the stretches in order, each sorted by place, at and draw.

    Conversations of more than STRETCH rows are numbered by turn number, nulls last, then draw, and cut every STRETCH
    places. The numbers come from a range-partitioned sort and the counts before each partition, so that no task has to
    hold a conversation, whatever its turn numbers are; equal rows may go to several partitions.
    """
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("at"), _known(role).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.xxhash64(F.col(role).cast("string"), F.col(text).cast("string")).alias("draw"),
    )
    rows = rows.withColumn("role", F.when(F.col("role").isin(*ROLES), F.col("role")))
    long = rows.groupBy("conv").agg(F.count("*").alias("rows")).where(F.col("rows") > STRETCH).withColumnRenamed("conv", "of")
    rows = rows.join(long, F.col("conv").eqNullSafe(F.col("of")), "left")
    # The salt tells equal rows apart; it is written before the rows are dealt out by it.
    rows = cut_lineage(rows.select("conv", "at", "role", "text", "draw", F.col("rows").isNull().alias("whole"), F.monotonically_increasing_id().alias("salt")))
    short = rows.where("whole").withColumns({"place": F.lit(None).cast("long"), "stretch": F.lit(0).cast("long")})
    columns = ["conv", "at", "role", "text", "draw", "place", "stretch", "whole"]
    split = rows.where("not whole")
    if split.isEmpty():
        return short.select(columns)
    placed = numbered_within(split, "conv", [F.col("at").asc_nulls_last(), F.col("draw").asc(), F.col("salt").asc()])
    placed = placed.withColumn("stretch", F.floor(F.col("place") / STRETCH).cast("long"))
    return short.select(columns).unionByName(placed.select(columns))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", start: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """Rows (conv, stretch, n_turns, n_out, actions, cost, rendered); a conversation's text is its rows in order of stretch.

    n_turns counts the turns read, n_out those rendered; actions has one entry per turn read ("user": kept or relabelled,
    "+assistant user": an empty turn in front, "&": merged into the one before by a line break) and "+assistant" for an
    empty turn at the end; cost is the least cost of the whole conversation, on its last stretch, 0 on the others.

    Turns are ordered by number, nulls last; equal numbers by a hash of role and text, so repeated rows and reruns agree.
    An unknown or null role may become any; a null text is an empty one. A null id is a conversation of its own. A turn's
    text that holds the marks is rendered with a blank after their first character, so that it cannot close its turn.
    Other columns are not looked at; an empty table gives an empty result; texts count whole.
    """
    id_type = turns.schema[conv].dataType.simpleString()
    rows = cut_lineage(_split(turns, conv, turn, role, text))

    def cost_of(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        roles = [r if isinstance(r, str) else None for r in group["role"]]
        return pd.DataFrame({"conv": group["conv"].iloc[:1], "stretch": group["stretch"].iloc[:1], "matrix": [_matrix(roles).ravel().tolist()]})

    long = rows.where("not whole").select("conv", "stretch", "place", "role")
    costs = cut_lineage(long.groupBy("conv", "stretch").applyInPandas(cost_of, f"conv {id_type}, stretch long, matrix array<double>"))

    def between(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("stretch")
        matrices = [np.array(m).reshape(len(STATES), -1) for m in group["matrix"]]
        ahead, best, states = [], np.where(np.arange(len(STATES)) == 0, 0.0, np.inf), [0]
        for m in matrices:
            ahead.append((best[:, None] + m).argmin(axis=0))
            best = (best[:, None] + m).min(axis=0)
        state = int((best + END).argmin())
        whole = float((best + END).min())
        states = [state]
        for how in reversed(ahead):
            states.append(int(how[states[-1]]))
        states = states[::-1]
        n = len(group)
        return pd.DataFrame({"conv": group["conv"], "stretch": group["stretch"], "first": states[:-1], "last": states[1:], "final": [k == n - 1 for k in range(n)], "cost": [whole if k == n - 1 else 0.0 for k in range(n)]})

    # One small row per stretch of a long conversation: a matrix of 16 numbers for about STRETCH turns.
    states = costs.groupBy("conv").applyInPandas(between, f"conv {id_type}, stretch long, first int, last int, final boolean, cost double")
    states = cut_lineage(states.withColumnsRenamed({"conv": "of", "stretch": "number"}))
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("stretch") == F.col("number"))
    joined = rows.join(states, same, "left").select("conv", "stretch", "first", "last", "final", "cost", "role", "text", "place", "at", "draw")

    def rendered(key, group: list[tuple]) -> tuple:
        roles = [row[6] for row in group]
        first, last, final, cost = group[0][2:6]
        if first is None:  # a whole conversation
            ends = _matrix(roles)[0] + END
            first, last, final, cost = 0, int(ends.argmin()), True, float(ends.min())
        actions, out, opened, n_out = _choices(roles, first, last), [], first != 0, 0
        for action, row in zip(actions, group):
            words = row[7].replace(start, start[0] + " " + start[1:]).replace(end, end[0] + " " + end[1:])
            if action == "&":
                out.append("\n" + words)
                continue
            if opened:
                out.append(f"{end}\n")
            if action.startswith("+"):
                added, action = action[1:].split()
                out.append(f"{start}{added}\n{end}\n")
                n_out += 1
            out.append(f"{start}{action}\n{words}")
            opened, n_out = True, n_out + 1
        if final:
            out.append(f"{end}\n")
            for added in {"system": ["user", "assistant"], "user": ["assistant"]}.get(STATES[last], []):
                out.append(f"{start}{added}\n{end}\n")
                actions.append(f"+{added}")
                n_out += 1
        return (*key, len(group), n_out, actions, cost, "".join(out))

    fields = [("n_turns", pa.int64()), ("n_out", pa.int64()), ("actions", pa.list_(pa.string())), ("cost", pa.float64()), ("rendered", pa.string())]

    def render(batches):
        key, group = None, []

        def table(done, like):
            columns = list(zip(*done)) or [()] * 7
            arrays = [pa.array(columns[0], like.column(0).type), pa.array(columns[1], pa.int64()), *(pa.array(c, kind) for c, (_, kind) in zip(columns[2:], fields))]
            return pa.RecordBatch.from_arrays(arrays, names=["conv", "stretch", *(name for name, _ in fields)])

        for batch in batches:
            done = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[:2] != key:
                    done.append(rendered(key, group))
                    group = []
                key = row[:2]
                group.append(row)
            yield table(done, batch)
        if group:
            yield table([rendered(key, group)], batch)

    shape = f"conv {id_type}, stretch long, n_turns long, n_out long, actions array<string>, cost double, rendered string"
    # Rows of a stretch lie together and in order; tasks stream over them and hold one stretch at a time.
    dealt = joined.repartition("conv", "stretch").sortWithinPartitions("conv", "stretch", "place", F.col("at").asc_nulls_last(), "draw")
    return dealt.mapInArrow(render, shape)
