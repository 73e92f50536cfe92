"""Chat formatting with the cheapest repair of roles.

A legal conversation is an optional system turn, then user and assistant in turn, user first.
Each given turn keeps its role or is relabelled, starts a new turn or is merged into the last
one, and empty turns may be inserted; dynamic programming over the automaton's states finds the
cheapest way. A step of it is a matrix over (min, +), so a conversation of any length is worked
on in fragments: turns are range-sorted, each task reduces its fragments, the few fragments of
a conversation are folded, and tasks then write out their parts of the path.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from parcelle.llm.common import cut

# Roles, other names for them, and the template's marks.
ROLES = ("system", "user", "assistant")
ALIASES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

#: Costs of changes: merging into the last turn, an empty turn, another role (to or from system is dearer), an unknown role.
MERGE, INSERT, RELABEL, RELABEL_SYSTEM, UNKNOWN = 1, 2, 3, 4, 1
NEVER = 1 << 40
#: States are the role of the last turn so far; 0 is the start.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Cost of a turn of the state in the column after the state in the row.
LINK = (
    (NEVER, 0, 0, INSERT),
    (NEVER, MERGE, 0, INSERT),
    (NEVER, NEVER, MERGE, 0),
    (NEVER, NEVER, 0, MERGE),
)
END = (0, INSERT, 0, 0)


def relabel_cost(given: int, to: int) -> int:
    if given == to:
        return 0
    if not given:
        return UNKNOWN if to != SYSTEM else RELABEL_SYSTEM
    return RELABEL_SYSTEM if SYSTEM in (given, to) else RELABEL


#: For each given state the costs of a step, from each state to each state.
STEPS = [[[min(NEVER, LINK[s][q] + relabel_cost(g, q)) if q else NEVER for q in range(4)] for s in range(4)] for g in range(4)]


def times(left: list[list[int]], right: list[list[int]]) -> list[list[int]]:
    return [[min(min(left[i][k] + right[k][j] for k in range(4)), NEVER) for j in range(4)] for i in range(4)]


def forward(costs: list[int], given: list[int]) -> list[tuple]:
    """For each turn the best state before it, for each state after it; ties go to the first state."""
    back = []
    for g in given:
        step = STEPS[g]
        best = [min((costs[s] + step[s][q], s) for s in range(4)) for q in range(4)]
        costs = [min(c, NEVER) for c, _ in best]
        back.append(tuple(s for _, s in best))
    return back


def path(back: list[tuple], last: int) -> list[int]:
    """States before and after each turn, to the state ``last``."""
    states = [last]
    for before in reversed(back):
        states.append(before[states[-1]])
    return states[::-1]


def new_turns(states: list[int]) -> int:
    """Turns that a path starts, inserted ones counted."""
    return sum((a != b) + inserts(a, b) for a, b in zip(states, states[1:]))


def inserts(a: int, b: int) -> bool:
    return b == ASSISTANT and a in (START, SYSTEM)


def _runs(rows: DataFrame, keys: int, finish, schema: str) -> DataFrame:
    """Rows that ``finish`` makes of each run of rows with equal first ``keys`` columns; it gets the run's columns.

    Runs come from sorted tasks, so equal keys are next to each other; what is made of the
    runs that end in a batch leaves the task together.
    """
    types = rows.sparkSession.createDataFrame([], schema).schema
    names, kinds = types.names, [to_arrow_type(f.dataType) for f in types]

    def run(batches):
        now, held, made = None, [], []

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)], names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:keys] != now:
                    if held:
                        made += finish(list(zip(*held)))
                    now, held = row[:keys], []
                held.append(row)
            if made:
                yield batch_of(made)
                made = []
        if held:
            yield batch_of(finish(list(zip(*held))))
    return rows.mapInArrow(run, schema)


def _matrix(run: list[tuple]) -> list[tuple]:
    """A fragment (conv, part, id, state) as its costs from each state to each state."""
    conv, part, _, given = run
    total = STEPS[given[0]]
    for g in given[1:]:
        total = times(total, STEPS[g])
    return [(conv[0], part[0], [c for row in total for c in row])]


def _entries(run: list[tuple]) -> list[tuple]:
    """Costs on entry to each fragment of a conversation (conv, part, costs), and its best last state."""
    conv, parts, matrices = run
    costs, entries = [0, NEVER, NEVER, NEVER], []
    for flat in matrices:
        entries.append(costs)
        costs = [min(min(costs[s] + flat[4 * s + q] for s in range(4)), NEVER) for q in range(4)]
    end = min(range(1, 4), key=lambda q: (costs[q] + END[q], q))
    return [(c, p, entry, end) for c, p, entry in zip(conv, parts, entries)]


def _backward(run: list[tuple]) -> list[tuple]:
    """For each last state of a fragment (conv, part, id, state, entry, end) the first one of the best path, and the turns it starts."""
    conv, part, _, given, entry, end = run
    back = forward(entry[0], given)
    ways = [path(back, q) for q in range(4)]
    return [(conv[0], part[0], [w[0] for w in ways], [new_turns(w) for w in ways], entry[0], end[0])]


def _exits(run: list[tuple]) -> list[tuple]:
    """Last state of each fragment of a conversation, the turns before it, and whether it is the last."""
    conv, parts, firsts, turns, entries, ends = run
    last, found = ends[0], []
    for k in reversed(range(len(parts))):
        found.append((conv[k], parts[k], entries[k], last, turns[k][last], k == len(parts) - 1))
        last = firsts[k][last]
    out, before = [], -1
    for c, p, entry, exit_state, count, final in reversed(found):
        out.append((c, p, entry, exit_state, before, final))
        before += count
    return out


def _decide(run: list[tuple]) -> list[tuple]:
    _, _, ids, given, entries, exits, befores, finals = run
    states, turn, out = path(forward(entries[0], given), exits[0]), befores[0], []
    for k, (a, b, g) in enumerate(zip(states, states[1:], given)):
        turn += (a != b) + inserts(a, b)
        action = " ".join(["relabel"] * (b != g) + ["merge"] * (a == b)) or "keep"
        out.append((ids[k], b, action, inserts(a, b), turn, finals[0] and k == len(given) - 1))
    return out


def repair_chats(turns: DataFrame) -> DataFrame:
    """The repaired turns of conversations (conv_id, turn, role, text), in parts.

    Each given row gives a row: ``conv_id``, ``out_turn`` (from 0), ``place`` in the conversation
    (its order among rows), ``role``, ``text``, ``action`` (keep, relabel, merge, relabel merge)
    and ``rendered``. A merged row belongs to the turn of the row before, and an inserted empty
    turn is a row with action ``insert``. ``rendered`` in the order of ``out_turn``, ``place`` is
    the chat. Rows of equal turn are ordered by role and a hash of the text; a missing turn comes first, a
    missing conversation id is a conversation, a missing or unknown role is given one, a
    missing text is empty. Marks of the template inside a text are broken by a blank. An empty
    table gives an empty result; other columns are ignored.
    """
    spark = turns.sparkSession
    role = F.lower(F.trim("role"))
    for name, known in ALIASES.items():
        role = F.when(role == name, known).otherwise(role)
    state = F.coalesce(*(F.when(role == name, i + 1) for i, name in enumerate(ROLES)), F.lit(0)).cast("long")
    rows = turns.select("conv_id", F.col("conv_id").cast("string").alias("conv"), F.col("turn").alias("given_turn"), "role", F.coalesce("text", F.lit("")).alias("text"), state.alias("state"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "given_turn", "role", "hash", "tie"]
    sorted_rows = (
        rows.withColumn("hash", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .select("conv_id", "conv", "text", "state", F.spark_partition_id().cast("long").alias("part"), F.monotonically_increasing_id().alias("id"))
    )
    rows = cut(sorted_rows)
    narrow = rows.select("conv", "part", "id", "state")

    def by_conversation(fragments: DataFrame) -> DataFrame:
        # A conversation has a row for each task of the sort at most.
        return fragments.repartition(parts, "conv").sortWithinPartitions("conv", "part")

    def with_fragment(more: DataFrame, *names: str) -> DataFrame:
        right = more.select(F.col("conv").alias("of_conv"), F.col("part").alias("of_part"), *names)
        same = [F.col("conv").eqNullSafe(F.col("of_conv")), F.col("part") == F.col("of_part")]
        joined = narrow.join(right, same).select("conv", "part", "id", "state", *names)
        # A fragment is what one task sorted before; it meets again in one task, in order.
        return joined.repartition(parts, "part").sortWithinPartitions("part", "id")

    costs = _runs(narrow, 2, _matrix, "conv string, part long, costs array<long>")
    entries = cut(_runs(by_conversation(costs), 1, _entries, "conv string, part long, entry array<long>, end long"))
    ways = _runs(with_fragment(entries, "entry", "end"), 2, _backward, "conv string, part long, firsts array<long>, turns array<long>, entry array<long>, end long")
    exits = cut(_runs(by_conversation(ways), 1, _exits, "conv string, part long, entry array<long>, exit long, before long, ends boolean"))
    decided = _runs(with_fragment(exits, "entry", "exit", "before", "ends"), 2, _decide, "id long, state long, action string, insert boolean, turn long, final boolean")

    name = F.element_at(F.array(*map(F.lit, ROLES)), F.col("now").cast("int"))
    safe = F.replace("text", F.lit("<|im_"), F.lit("<| im_"))
    # "before" closes the turn before; the last row of a conversation closes its own.
    closing = F.when(F.col("number") > 0, CLOSE).otherwise("")
    joined = rows.drop("state").join(decided.withColumnRenamed("state", "now"), "id")
    own = joined.withColumn("number", F.col("turn")).withColumn("merged", F.col("action").contains("merge"))
    ended = F.when(F.col("final"), CLOSE).otherwise("")
    piece = F.concat(F.when(F.col("merged"), F.lit("\n")).otherwise(F.concat(closing, F.lit(OPEN), name, F.lit("\n"))), safe, ended)
    inserted_before = F.struct(
        (F.col("turn") - 1).alias("out_turn"), F.lit("user").alias("role"), F.lit("").alias("text"), F.lit("insert").alias("action"),
        F.concat(F.when(F.col("turn") > 1, CLOSE).otherwise(""), F.lit(f"{OPEN}user\n")).alias("rendered"))
    given = F.struct(F.col("turn").alias("out_turn"), name.alias("role"), F.col("text"), F.col("action"), piece.alias("rendered"))
    inserted_after = F.struct(
        (F.col("turn") + 1).alias("out_turn"), F.lit("user").alias("role"), F.lit("").alias("text"), F.lit("insert").alias("action"),
        F.lit(f"{OPEN}user\n{CLOSE}").alias("rendered"))
    pieces = F.array_compact(F.array(
        F.when(F.col("insert"), inserted_before), given, F.when(F.col("final") & (F.col("now") == SYSTEM), inserted_after)))
    return own.select("conv_id", F.col("id").alias("place"), F.explode(pieces).alias("t")).select("conv_id", "t.out_turn", "place", "t.role", "t.text", "t.action", "t.rendered")


def op4_chat_repair(spark, sf_dir: str) -> DataFrame:
    return repair_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
